"""Reasoning modes: on, off or clipped, by a stable hash of the record's id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import unit_hash

OFF, CLIPPED, CLIP_CHARS, LEAST_RATE = 0.10, 0.04, 6000, 0.5


def mode_label(key: Column, present: Column, seed: int = 42, off: float = OFF, clipped: float = CLIPPED) -> Column:
    """on, off, truncated, or off_nonreasoning where there is no reasoning."""
    u = unit_hash(seed, key)
    return F.when(~present, "off_nonreasoning").when(u < off, "off").when(u < off + clipped, "truncated").otherwise("on")


def stored_mode(label: Column) -> Column:
    """What a record keeps: a clipped one is on."""
    return F.when(label.isin("on", "truncated"), "on").otherwise("off")


def clip(reasoning: Column, chars: int = CLIP_CHARS) -> Column:
    """The first ``chars`` characters cut at the last space, if longer."""
    return F.when(F.length(reasoning) > chars, F.regexp_replace(F.substring(reasoning, 1, chars), "(?s) [^ ]*$", "")).otherwise(reasoning)


def assign(records: DataFrame, seed: int = 42, off: float = OFF, clipped: float = CLIPPED, chars: int = CLIP_CHARS) -> DataFrame:
    """Records with ``mode_label``, the mode in their metadata, and clipped traces."""
    label = F.col("mode_label")
    out = records.withColumn("mode_label", mode_label(F.col("id"), F.col("reasoning_present"), seed, off, clipped))
    cut = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), F.when(m["role"] == "assistant", clip(m["reasoning"], chars)).otherwise(m["reasoning"]).alias("reasoning")))
    out = out.withColumn("messages", F.when(label == "truncated", cut).otherwise(F.col("messages")))
    return out.withColumn("meta", F.col("meta").withField("reasoning_mode", stored_mode(label)))


def rates(records: DataFrame, by: str = "name") -> DataFrame:
    return records.groupBy(by).agg(F.count("*").alias("total"), F.count_if("reasoning_present").alias("present")).withColumn("rate", F.col("present") / F.col("total"))


def rate_gate(records: DataFrame, catalog: DataFrame, least: float = LEAST_RATE) -> DataFrame:
    """Rates of the sources that have to carry reasoning, and whether each has ``least``."""
    must = F.broadcast(catalog.filter("must_reason").select("name").distinct())
    return rates(records).join(must, "name").withColumn("passed", F.round("rate", 3) >= least)


def require_reasoning(records: DataFrame, catalog: DataFrame, least: float = LEAST_RATE) -> None:
    """Raise if a source that has to carry reasoning mostly doesn't."""
    bad = rate_gate(records, catalog, least).filter("NOT passed").collect()  # a row a source at most
    if bad:
        raise ValueError("sources without their reasoning: " + ", ".join(f"{r['name']} {r['rate']:.0%}" for r in sorted(bad)))
