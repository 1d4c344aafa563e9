"""Row features on a stream.

Cleaning and features are stateless columns, so new rows of a corpus can get
them as they arrive.  Numbering, duplicates and fences need the whole corpus
and stay in the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chaffsieve.config import AuditConfig
from chaffsieve.operators.clean import clean, engineer
from chaffsieve.operators.quality import row_flags
from chaffsieve.schema import RAW


def enrich_stream(spark: SparkSession, folder: str, cfg: AuditConfig) -> DataFrame:
    raw = spark.readStream.schema(RAW).parquet(folder)
    return row_flags(engineer(clean(raw), cfg), cfg)
