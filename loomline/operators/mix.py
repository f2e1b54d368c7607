"""Token-budgeted mixing of domains into training stages.

A pool is taken in the order of a stable hash, repeated at most three times in
that same order, while the tokens before a row are below the target.  Running
sums are computed in buckets of the hash with a prefix sum over the buckets'
totals, so no task holds a domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import cut

MOST_REPEATS = 3


def order_key(seed: int, salt: str, *keys: str) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), F.lit(salt), *[F.col(k).cast("string") for k in keys]), 256)


#: Rows of a bucket of the hash, in expectation.
BUCKET_ROWS = 100_000


def digits_for(rows: int) -> int:
    """Leading hexadecimal digits that make buckets of about ``BUCKET_ROWS`` rows."""
    n = 2
    while 16**n * BUCKET_ROWS < rows:
        n += 1
    return n


def running_before(df: DataFrame, groups: list[str], key: str, value: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows of the group with a
    smaller ``key``, a hexadecimal hash.  Two levels: buckets of the first digits,
    as many as the number of rows asks for, then rows inside a bucket.
    ``df`` is read three times, so it should be written."""
    at = df.withColumn("_bucket", F.substring(key, 1, digits_for(df.count())))
    totals = at.groupBy(*groups, "_bucket").agg(F.sum(value).alias("_total"))  # a row for each bucket of a group
    before = F.sum("_total").over(Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(*groups, "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum(value).over(Window.partitionBy(*groups, "_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, -1))
    joined = at.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(totals, [*groups, "_bucket"])
    return joined.withColumn(out, F.col("_before") + F.col("_inside")).drop("_bucket", "_before", "_inside")


def budget_sample(pool: DataFrame, targets: DataFrame, group: str, key: str, tokens: str = "tokens") -> DataFrame:
    """Rows of ``pool`` per ``group``, with ``pass`` (0..2), whose tokens before
    are below the group's target.  ``targets``: group, target.

    A row of pass p has p times the pool's tokens before it besides its own
    prefix, so the pool is not repeated before it is summed.
    """
    small = F.broadcast(targets.filter("target > 0"))  # a row per domain of a recipe
    inside = cut(pool.join(small, group))
    total = inside.groupBy(group).agg(F.sum(tokens).alias("_all"))  # a row per domain
    summed = running_before(inside, [group], key, tokens, "_prefix").join(F.broadcast(total), group)
    repeats = F.explode(F.sequence(F.lit(0), F.lit(MOST_REPEATS - 1)))
    return summed.withColumn("pass", repeats).filter(F.col("pass") * F.col("_all") + F.col("_prefix") < F.col("target")).drop("_prefix", "_all", "target")


def domain_targets(spark, ratios: dict[str, float], budget: float) -> DataFrame:
    return spark.createDataFrame([(d, float(r * budget)) for d, r in ratios.items()], "domain string, target double")


def stage_mix(items: DataFrame, ratios: dict[str, float], budget: float, seed: int, salt: str) -> DataFrame:
    """Rows of a recipe's domains, each to its share of the budget."""
    keyed = items.withColumn("_key", order_key(seed, salt, "name", "idx"))
    return budget_sample(keyed, domain_targets(items.sparkSession, ratios, budget), "domain", "_key").drop("_key")


def replay(stage: DataFrame, budget: float, seed: int, salt: str = "replay") -> DataFrame:
    """A sample of a stage's rows, copies included, to a budget."""
    keyed = stage.withColumnRenamed("pass", "copy").withColumn("_key", order_key(seed, salt, "name", "idx", "copy")).withColumn("_g", F.lit(0))
    target = stage.sparkSession.createDataFrame([(0, float(budget))], "_g int, target double")
    return budget_sample(keyed, target, "_g", "_key").drop("_g", "_key")


def taken_in_order(pool: DataFrame, order: list, already: float, limit: float, tokens: str = "tokens") -> tuple[DataFrame, int]:
    """Rows in order while the tokens so far are below ``limit``, and what they add.

    The order is cut into ranges; each range sums its own, after a prefix sum
    over the ranges' totals.
    """
    parts = max(1, int(pool.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut(pool.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy("_range").agg(F.sum(tokens).alias("_total"))
    before = F.sum("_total").over(Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # a row per range
    totals = totals.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum(tokens).over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    out = ranged.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(totals), "_range")
    out = out.filter(F.col("_before") + F.col("_inside") + already < limit).drop("_range", "_before", "_inside")
    return out, out.agg(F.coalesce(F.sum(tokens), F.lit(0)).alias("n")).first()["n"]


def polish_stage(items: DataFrame, exclusive: list[str], longest_from: list[str], hardest_from: list[str], budget: float) -> DataFrame:
    """All rows of exclusive sources, then the lowest pass rates to half of what
    is left, then the longest reasoning to the budget; overshoot carries over."""
    own = items.filter(F.col("source").isin(exclusive)).withColumn("part", F.lit("exclusive"))
    so_far = own.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    half = so_far + 0.5 * (budget - so_far)
    hard = items.filter(F.col("source").isin(hardest_from) & F.col("difficulty").isNotNull())
    hard, more = taken_in_order(hard, ["difficulty", "source_rank", "idx"], so_far, half)
    long = items.filter(F.col("source").isin(longest_from))
    long, _ = taken_in_order(long, [F.col("rlen").desc(), F.col("source_rank"), F.col("idx")], so_far + more, budget)
    return own.unionByName(hard.withColumn("part", F.lit("hardest"))).unionByName(long.withColumn("part", F.lit("longest")))


def mixture_report(selected: DataFrame) -> DataFrame:
    """Per stage and domain: rows, distinct records, tokens, share of the stage's tokens."""
    by = selected.groupBy("stage", "domain").agg(F.count("*").alias("n_rows"), F.countDistinct("name", "idx").alias("unique_rows"), F.sum("tokens").alias("tokens"))
    total = by.groupBy("stage").agg(F.sum("tokens").alias("_all"))
    return by.join(F.broadcast(total), "stage").withColumn("token_share", F.col("tokens") / F.greatest(F.col("_all"), F.lit(1))).drop("_all")


def stage_report(selected: DataFrame) -> DataFrame:
    out = selected.groupBy("stage").agg(F.count("*").alias("n_rows"), F.countDistinct("name", "idx").alias("unique_rows"), F.sum("tokens").alias("tokens"))
    return out.withColumn("upsample_factor", F.col("n_rows") / F.greatest(F.col("unique_rows"), F.lit(1)))


def fidelity(report: DataFrame, recipes: dict[str, dict[str, float]], tolerance: float = 0.02) -> DataFrame:
    """Share against ratio for every domain of every recipe, missing ones as 0."""
    wanted = report.sparkSession.createDataFrame([(s, d, float(r)) for s, ratios in recipes.items() for d, r in ratios.items()], "stage string, domain string, ratio double")
    got = wanted.join(report.select("stage", "domain", "token_share"), ["stage", "domain"], "left").withColumn("token_share", F.coalesce("token_share", F.lit(0.0)))
    return got.withColumn("on_target", F.abs(F.col("token_share") - F.col("ratio")) <= tolerance)


def chunked(df: DataFrame, groups: list[str], key: str, rows: int) -> DataFrame:
    """``df`` with ``chunk``: slices of ``rows`` rows in the order of a hash key."""
    return running_before(cut(df.withColumn("_one", F.lit(1))), groups, key, "_one", "_place").withColumn("chunk", F.floor(F.col("_place") / rows).cast("long")).drop("_one", "_place")


def gathered(selected: DataFrame, records: DataFrame) -> DataFrame:
    """The selected rows with their records, a copy for each time selected."""
    return selected.join(records.drop("domain", "source", "source_rank"), ["name", "idx"])
