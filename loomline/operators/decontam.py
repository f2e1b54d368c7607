"""Decontamination: containment of a record's word runs in the benchmarks'.

Overlap is the share of the record's distinct runs that any benchmark has; a
record with ``threshold`` or more goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.storage import cut
from ..functions.text import bound, grams, plain_ascii

N, THRESHOLD = 8, 0.6
#: Bytes of benchmarks' runs up to which they are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 64 << 20


def gram_set(body: Column, n: int = N) -> Column:
    tokens = bound(plain_ascii(body), lambda plain: F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " ")))
    return bound(tokens, lambda t: grams(t, n))


def eval_index(items: DataFrame, question: str = "text", n: int = N) -> DataFrame:
    """The distinct runs of all benchmarks together."""
    return items.select(F.explode(gram_set(F.col(question), n)).alias("gram")).distinct()


def overlap(records: DataFrame, key: str, body: Column, index: DataFrame, n: int = N) -> DataFrame:
    """(key, n_grams, n_hit, overlap) of every record, by ``key``; one without runs has overlap 0."""
    marked = _small(index.withColumn("hit", F.lit(1)))
    runs = records.select(key, F.explode_outer(gram_set(body, n)).alias("gram"))
    out = runs.join(marked, "gram", "left").groupBy(key).agg(F.count("gram").alias("n_grams"), F.count("hit").alias("n_hit"))
    return out.withColumn("overlap", F.when(F.col("n_grams") > 0, F.col("n_hit") / F.col("n_grams")).otherwise(0.0))


def clean(records: DataFrame, key: str, body: Column, index: DataFrame, threshold: float = THRESHOLD, n: int = N) -> DataFrame:
    bad = overlap(records, key, body, index, n).filter(F.col("overlap") >= threshold).select(key)
    return records.join(bad, key, "left_anti")


def gate(records: DataFrame, key: str, body: Column, index: DataFrame, threshold: float = THRESHOLD, n: int = N) -> DataFrame:
    """One row: benchmark runs, records seen, records flagged, and whether the
    gate is passed: something on both sides, and nothing flagged."""
    seen = overlap(records, key, body, index, n).agg(F.count("*").alias("n_records"), F.count_if(F.col("overlap") >= threshold).alias("n_flagged"))
    both = index.agg(F.count("*").alias("n_eval")).crossJoin(seen)  # one row each
    return both.withColumn("passed", (F.col("n_eval") > 0) & (F.col("n_records") > 0) & (F.col("n_flagged") == 0))


def holding(records: DataFrame, body: Column, items: DataFrame, question: str = "text", n: int = N) -> DataFrame:
    """Records that hold a whole normalised question as a substring (opt-in).

    All tokens of a question but the first and last stand whole in a text that
    holds it.  A run of these finds the candidates, by an equi-join, and the
    substring is looked for in those only.  Questions of one or two tokens are
    looked up by their first three characters among all runs of three of the
    text.  Of shorter ones there are few, whatever the benchmarks (37 characters
    make 1406 strings), so they are conditions of the plan.
    """
    asked = items.select(plain_ascii(F.col(question)).alias("question")).filter("question <> ''").distinct()
    asked = cut(asked.withColumn("_t", F.split("question", " ")).withColumn("_m", F.least(F.size("_t") - 2, F.lit(n))))
    plain = records.withColumn("_plain", plain_ascii(body))
    tiny = [r["question"] for r in asked.filter(F.length("question") < 3).select("question").collect()]
    out = plain.filter(_any(F.contains("_plain", F.lit(q)) for q in tiny))
    sizes = sorted(r["_m"] for r in asked.filter("_m > 0").select("_m").distinct().collect())  # n at most
    short = asked.filter((F.col("_m") <= 0) & (F.length("question") >= 3)).select("question", F.substring("question", 1, 3).alias("_run"))
    keyed = asked.filter("_m > 0").select("question", F.expr("array_join(slice(_t, 2, _m), ' ')").alias("_run"))
    runs = [_runs(k) for k in sizes]
    for index, found in ((keyed, F.concat(*runs) if runs else None), (short, None if short.isEmpty() else _triples())):
        if found is not None:
            hit = plain.withColumn("_run", F.explode(F.array_distinct(found))).join(_small(index), "_run").filter(F.contains("_plain", "question"))
            out = out.unionByName(hit.drop("_run", "question"))
    return out.drop("_plain").distinct()


def _triples() -> Column:
    """All runs of three characters of the normalised text."""
    none = F.array().cast("array<string>")
    return F.when(F.length("_plain") >= 3, F.transform(F.sequence(F.lit(1), F.length("_plain") - 2), lambda i: F.substring(F.col("_plain"), i, F.lit(3)))).otherwise(none)


def _small(index: DataFrame) -> DataFrame:
    """``index``, broadcast if its strings take ``BROADCAST_BYTES`` at most."""
    size = index.agg(F.sum(sum((F.octet_length(c) for c, t in index.dtypes if t == "string"), F.lit(16)))).first()[0] or 0
    return F.broadcast(index) if size <= BROADCAST_BYTES else index


def _runs(k: int) -> Column:
    """All runs of ``k`` tokens of the normalised text."""
    none = F.array().cast("array<string>")
    return bound(
        F.split("_plain", " "), lambda t: F.when(F.size(t) >= k, F.transform(F.sequence(F.lit(1), F.size(t) - k + 1), lambda i: F.array_join(F.slice(t, i, F.lit(k)), " "))).otherwise(none)
    )


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
