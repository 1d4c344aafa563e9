"""Operators that turn a crawled corpus into training data."""
