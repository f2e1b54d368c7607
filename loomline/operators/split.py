"""A split into train and test that no row straddles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.storage import cut
from .mix import running_before


def row_key(*columns: str) -> Column:
    """A key of a row's content; equal rows have equal keys."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def train_test(df: DataFrame, key: str, groups: list[str] | None = None, share: float = 0.05, seed: int = 42) -> DataFrame:
    """``df`` with ``side``: all copies of a content on one side; of those in
    test one stays.  max(1, floor(contents * share)) contents are test."""
    groups = groups or ["_all"]
    df = df.withColumn("_all", F.lit(0)) if groups == ["_all"] else df
    df = cut(df)
    contents = cut(df.groupBy(*groups, key).agg(F.lit(1).alias("_one")).withColumn("_order", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key)), 256)))
    sizes = contents.groupBy(*groups).agg(F.count("*").alias("_n"))
    ranked = running_before(contents, groups, "_order", "_one", "_place").join(sizes, groups)
    test = cut(ranked.filter(F.col("_place") < F.greatest(F.lit(1), F.floor(F.col("_n") * share))).select(*groups, key))
    ours = df.join(test, [*groups, key], "left_semi").dropDuplicates([*groups, key])
    other = df.join(test, [*groups, key], "left_anti")
    return ours.withColumn("side", F.lit("test")).unionByName(other.withColumn("side", F.lit("train"))).drop("_all")


def leaks(split: DataFrame, key: str) -> DataFrame:
    """Contents on both sides (none, if the split is sound)."""
    return split.groupBy(key).agg(F.countDistinct("side").alias("sides")).filter("sides > 1")


def emptiness(df: DataFrame, column: str) -> DataFrame:
    """One row: rows, and rows whose conversation is null or empty."""
    return df.agg(F.count("*").alias("n_rows"), F.count_if(F.col(column).isNull() | (F.size(column) <= 0)).alias("n_empty"))


def require_rows(df: DataFrame, column: str, most_empty: float = 0.8) -> None:
    row = emptiness(df, column).first()
    if not row["n_rows"]:
        raise ValueError("no rows")
    if row["n_empty"] / row["n_rows"] > most_empty:
        raise ValueError(f"more than {most_empty:.0%} of rows are empty ({row['n_empty']} of {row['n_rows']})")
