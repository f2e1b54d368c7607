"""Quality rules as a short-circuit cascade, native DataFrame expressions only.

Base figures of every text are columns.  The method's rules stand in one CASE
expression, which evaluates a branch only if no earlier one rejected the row.
The order comes from a planning sample: each rule's cost (seconds a row) and
selectivity (share rejected) are measured there, and rules run by rejection
per cost, best first.  The order changes the time taken, never the verdict.

Defined results: a null or empty text has no words, so it fails the base rules
and is not kept.  Very long texts are judged whole, repeated rows one by one.
Only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

import functools
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of the contract.
SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """``rejects`` makes a condition of the columns that ``figures`` adds."""

    name: str
    rejects: Callable[[], Column]


def _share(pattern: str) -> Column:
    """Share of the text's characters that ``pattern`` (one class) matches."""
    return (F.length("q_text") - F.length(F.regexp_replace("q_text", pattern, ""))) / F.greatest(F.length("q_text"), F.lit(1))


def _words_with(pattern: str) -> Column:
    return F.size(F.filter("q_words", lambda w: w.rlike(pattern))) / F.greatest(F.size("q_words"), F.lit(1))


def _lines_with(pattern: str) -> Column:
    return F.size(F.filter("q_lines", lambda x: x.rlike(pattern))) / F.greatest(F.size("q_lines"), F.lit(1))


#: Thresholds are wide: ordinary prose of any language passes.
RULES = (
    Rule("word_length", lambda: ~(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))).between(2, 15)),
    Rule("symbols", lambda: F.col("n_symbols") > 0.25 * F.col("n_words")),
    Rule("duplicate_lines", lambda: F.col("n_dup_lines") > 0.5 * F.size("q_lines")),
    Rule("letters", lambda: _share(r"\p{L}") < 0.5),
    Rule("shouting", lambda: _share(r"\p{Lu}") > 0.5),
    Rule("word_letters", lambda: _words_with(r"\p{L}") < 0.6),
    Rule("ellipses", lambda: _lines_with(r"(?:\.\.\.|…)[\x20\x09-\x0D]*$") > 0.5),
    Rule("bullets", lambda: _lines_with(r"^[\x20\x09-\x0D]*[•*‣-][\x20\x09]") > 0.9),
)


def figures(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with the base figures and the working columns q_*.

    Words of a text that repeat are found by sorting its 3-word windows by
    hash within the row: no row leaves its task.
    """
    at = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("q_text"))
    at = at.select("*", F.array_remove(F.split("q_text", SPACE, -1), "").alias("q_words"))
    at = at.select("*", F.filter(F.split("q_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("q_lines"))
    word = lambda i: F.get("q_words", i)
    windows = F.transform(
        F.sequence(F.lit(0), F.size("q_words") - 3),
        lambda i: F.struct(F.xxhash64(word(i), word(i + 1), word(i + 2)).alias("h"), i.alias("i")),
    )
    at = at.select("*", F.sort_array(F.when(F.size("q_words") >= 3, windows).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))).alias("q_sorted"))
    hash_at = lambda k: F.get("q_sorted", k)["h"]
    twice = F.filter("q_sorted", lambda x, k: F.coalesce(hash_at(k - 1) == x["h"], F.lit(False)) | F.coalesce(hash_at(k + 1) == x["h"], F.lit(False)))
    at = at.select("*", F.sort_array(F.transform(twice, lambda x: x["i"])).alias("q_twice"))
    covered = F.aggregate(
        F.transform("q_twice", lambda v, k: F.least(F.lit(3), F.coalesce(F.get("q_twice", k + 1) - v, F.lit(3)))), F.lit(0), lambda a, x: a + x
    )
    return at.select(
        *keep,
        "q_text",
        "q_words",
        "q_lines",
        F.size("q_words").cast("long").alias("n_words"),
        F.length(F.array_join("q_words", "")).cast("long").alias("word_chars"),
        (F.length("q_text") - F.length(F.regexp_replace("q_text", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float


def estimate(sample: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, seconds: float = 0.25) -> list[Estimate]:
    """Cost and selectivity of each rule on ``sample``, best rejection per cost first.

    The sample is repeated until a job over it takes about ``seconds`` with all
    rules, and the time of a job with a constant rule is taken off: what is left
    is the rule's own cost, not that of starting a job.
    """
    ready = figures(sample, text, []).drop("q_sorted", "q_twice").persist()

    def timed(condition: Column, times: int) -> tuple[float, int]:
        many = ready.withColumn("q_again", F.explode(F.sequence(F.lit(1), F.lit(times)))) if times > 1 else ready
        took, hit = [], 0
        for _ in range(3):
            began = time.perf_counter()
            hit = many.agg(F.count_if(condition).alias("n")).first()["n"]
            took.append(time.perf_counter() - began)
        return min(took), hit

    try:
        n = max(1, ready.count())
        any_rule = F.greatest(*(r.rejects().cast("int") for r in rules)) == 1
        idle, _ = timed(F.lit(False), 1)
        alone, _ = timed(any_rule, 1)
        times = min(1000, max(1, int(seconds / max(alone - idle, seconds / 1000))))
        idle, _ = timed(F.col("n_words") < 0, times)
        out = []
        for rule in rules:
            took, hit = timed(rule.rejects(), times)
            out.append(Estimate(rule, max(took - idle, 1e-4) / (n * times), hit / (n * times)))
    finally:
        ready.unpersist()
    return sorted(out, key=lambda e: (-(e.rejected + 0.5 / n) / e.seconds, e.rule.name))


def planning_sample(docs: DataFrame, rows: int = 500, files: int = 4) -> DataFrame:
    """Up to ``rows`` rows, drawn from ``files`` input files spread over the table:
    enough to order rules by, and no scan of the table."""
    names = sorted(docs.inputFiles())
    if not names:
        return docs.limit(rows)
    chosen = names[:: max(1, len(names) // files)][:files]
    parts = [docs.sparkSession.read.schema(docs.schema).parquet(f).limit(-(-rows // len(chosen))) for f in chosen]
    return functools.reduce(DataFrame.unionByName, parts)


def judge(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES, sample: DataFrame | None = None) -> DataFrame:
    """``keep`` columns with the base figures, ``base_failed`` and ``kept``."""
    order = [e.rule for e in estimate(planning_sample(docs) if sample is None else sample, text, rules)]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    verdict = F.when(F.col("base_failed"), F.lit(False))
    for rule in order:
        verdict = verdict.when(rule.rejects(), F.lit(False))
    out = figures(docs, text, list(keep)).withColumn("base_failed", failed).withColumn("kept", verdict.otherwise(F.lit(True)))
    return out.drop("q_text", "q_words", "q_lines")
