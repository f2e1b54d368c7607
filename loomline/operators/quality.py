"""Quality predicates of records and retention per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import count_of, text
from .normalize import has_text

MAX_CHARS = 200_000
MAX_REPLACED = 3
FENCE = "```"


def well_formed(messages: Column, domain: Column, max_chars: int = MAX_CHARS, max_replaced: int = MAX_REPLACED) -> Column:
    """A user and an assistant with a text; no message too long or with too many
    replacement characters; in code, fences of assistant contents in pairs."""
    both = F.transform(messages, lambda m: F.concat(text(m["content"]), text(m["reasoning"])))
    sound = F.forall(both, lambda b: (F.length(b) <= max_chars) & (count_of(b, "�") <= max_replaced))
    paired = F.forall(messages, lambda m: (m["role"] != "assistant") | (count_of(text(m["content"]), FENCE) % 2 == 0))
    return has_text(messages, "user") & has_text(messages, "assistant") & sound & ((domain != "code") | paired)


def quality_filter(records: DataFrame, **limits) -> DataFrame:
    return records.filter(well_formed(F.col("messages"), F.col("domain"), **limits))


def retention(records: DataFrame, by: str = "name", **limits) -> DataFrame:
    """Rows in and out per source, and their ratio."""
    flagged = records.select(by, well_formed(F.col("messages"), F.col("domain"), **limits).alias("ok"))
    out = flagged.groupBy(by).agg(F.count("*").alias("rows_in"), F.count_if("ok").alias("rows_out"))
    return out.withColumn("retention", F.col("rows_out") / F.greatest(F.col("rows_in"), F.lit(1)))
