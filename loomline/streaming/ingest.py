"""Records from a stream: the stateless steps, and the first of each content.

The adapters, predicates and modes are plain DataFrame functions, so they run
on a stream as on a table.  Exact duplicates need state: the first row of each
content within the watermark's delay is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dedup, normalize, quality, reasoning
from ..operators.render import record_text
from ..sources.catalog import Source


def record_stream(rows: DataFrame, source: Source, rank: int = 0) -> DataFrame:
    """Well-formed records with their reasoning mode, of raw rows that have ``idx``."""
    return reasoning.assign(quality.quality_filter(normalize.records(rows, source, rank)))


def first_seen(records: DataFrame, time: str, delay: str = "1 hour") -> DataFrame:
    """Records whose content was not seen within ``delay``."""
    keyed = records.withColumn("content_key", dedup.exact_key(record_text(F.col("messages"))))
    return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_key"])
