"""Audit of instruction-tuning corpora as Spark jobs."""

from chaffsieve.config import AuditConfig

__all__ = ["AuditConfig"]
