"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams of lower-cased letters (everything else is a
space) per language; the matrix of log probabilities has a fixed number of
rows (``buckets``) and a column per language, so its size does not depend on
the corpus, and is broadcast.  Scoring treats a block of texts as a sparse
matrix (the n-gram positions of all its texts) and sums the rows that each
text selects with numpy.  The language is that of the greatest likelihood
times prior; the score is the posterior with at most ``evidence`` n-grams
counted as independent.  Neither depends on the other texts or their order.

Defined results: a null text, an empty text and a text without any letter get
``und`` and score 0; ties between languages go to the first in alphabetical
order; with no labelled row at all every text gets ``und``.  Repeated rows are
scored one by one and null labels are not learned from.  Only the columns
named in the call are read, so further columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import blocks, fresh, letter_table, release, small_batches, tidy

UNKNOWN = "und"
ORDERS = (1, 2, 3)
#: Multipliers of the n-gram hash, one per position.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def spaced_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points and the offsets of the texts (one
    more than there are texts).  Before and after each stand as many line feeds
    as an n-gram reads beyond its last letter, so none reads a neighbour."""
    gap = "\n" * (max(ORDERS) - 1)
    offsets = np.full(len(texts) + 1, len(gap), np.int64)
    offsets[1:] += np.cumsum(np.fromiter((len(t) + len(gap) for t in texts), np.int64, len(texts)))
    joined = gap + "".join(t + gap for t in texts)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), offsets


def ngram_buckets(low: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The bucket of the n-gram that ends at each position (the first ones wrap)."""
    h = (low + np.uint32(order * 7919)) * np.uint32(MULTIPLIERS[0])
    for k in range(1, order):
        h[k:] ^= ((low[:-k] + np.uint32(1)) * np.uint32(MULTIPLIERS[k])) >> np.uint32(k)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(32 - bits)


@dataclass(frozen=True)
class LanguageModel:
    """``log_prob`` is (buckets, languages); ``prior`` holds log priors."""

    languages: tuple[str, ...]
    log_prob: np.ndarray
    prior: np.ndarray
    bits: int
    #: n-grams of a text that count as independent evidence in the score.
    evidence: int = 64

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        n, k = len(texts), len(self.languages)
        names, scores = [UNKNOWN] * n, np.zeros(n)
        if not k:
            return names, scores
        table = letter_table()
        for first, run in blocks(texts):
            points, offsets = spaced_points(run)
            low = table[points]
            letters = np.add.reduceat((low != 32).astype(np.int64), offsets[:-1])
            total = np.zeros((len(run), k))
            # one piece of a very long block at a time bounds the gathered rows
            step = max(1 << 14, (1 << 20) // k)
            for at in range(0, len(low), step):
                lo = max(0, at - len(ORDERS))
                piece = low[lo : at + step]
                rows = np.zeros((len(piece) - (at - lo), k), np.float32)
                for order in ORDERS:
                    rows += self.log_prob[ngram_buckets(piece, order, self.bits)[at - lo :]]
                a, b = max(0, np.searchsorted(offsets, at, "right") - 1), np.searchsorted(offsets, at + len(rows), "left")
                cuts = np.maximum(offsets[a:b] - at, 0)
                total[a : a + len(cuts)] += np.add.reduceat(rows, cuts, axis=0, dtype=np.float64)
            length = np.diff(offsets)
            best = (total + self.prior).argmax(axis=1)
            scaled = total * (np.minimum(length, self.evidence) / length / len(ORDERS))[:, None] + self.prior
            odds = np.exp(scaled - scaled.max(axis=1, keepdims=True))
            share = odds[np.arange(len(run)), best] / odds.sum(axis=1)
            for i in np.flatnonzero(letters):
                names[first + i] = self.languages[best[i]]
                scores[first + i] = share[i]
        return names, scores


def count_ngrams(texts: pa.Array, bits: int) -> np.ndarray:
    counts = np.zeros(1 << bits, np.int64)
    table = letter_table()
    for _, run in blocks(texts.to_pylist()):
        points, offsets = spaced_points(run)
        for order in ORDERS:
            counts += np.bincount(ngram_buckets(table[points], order, bits)[offsets[0] :], minlength=1 << bits)
    return counts


def train(
    docs: DataFrame,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    bits: int = 15,
    sample_per_language: int = 20_000,
    smoothing: float = 0.5,
) -> LanguageModel:
    """Fit on the labelled rows of ``docs``.

    ``sample_per_language`` bounds the labelled texts used of each language:
    the rows with the smallest hashes of the key, in expectation that many.
    What comes to the driver is a count per language and bucket.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text"), F.col(label).cast("string").alias("lang"), F.col(key).cast("string").alias("key"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return LanguageModel((), np.zeros((1 << bits, 0), np.float32), np.zeros(0), bits)
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, min(1.0, sample_per_language / sizes[lang])).otherwise(share)
    draw = F.pmod(F.xxhash64("key"), F.lit(1_000_000)) / 1_000_000
    sample = rows.filter(F.coalesce(draw, F.lit(0.0)) < share).select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            by: dict[str, list[int]] = {}
            for i, lang in enumerate(langs):
                by.setdefault(lang, []).append(i)
            for lang, at in by.items():
                counts = count_ngrams(batch.column(1).take(pa.array(at)), bits)
                found[lang] = found[lang] + counts if lang in found else counts
        for lang, counts in found.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(counts[used])], schema=schema)

    counted = sample.mapInArrow(tidy(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    matrix = np.full((1 << bits, len(languages)), smoothing)
    columns = counted["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    matrix[counted["bucket"].to_numpy(np.int64), columns] += counted["n"].to_numpy(np.float64)
    # in steps of 2**-16, so that sums are exact and don't depend on how texts are dealt into blocks
    log_prob = (np.round(np.log(matrix / matrix.sum(axis=0)) * 65536) / 65536).astype(np.float32)
    total = np.array([sizes[x] for x in languages], float)
    return LanguageModel(languages, log_prob, np.log(total / total.sum()), bits)


def predictor(spark, model: LanguageModel):
    """A column function text -> struct<lang_pred, score>; the model is broadcast."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(kind)
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            for series in texts:
                names, scores = shared.value.predict(series.where(series.notna(), None).tolist())
                yield pd.DataFrame({"lang_pred": names, "score": scores})
        finally:
            release()

    return predict


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is in the held-out fold: crc32 of the id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with the columns ``lang_pred`` and ``score`` (replaced if there)."""
    at = fresh(docs, "predicted")
    out = docs.withColumn(at, predictor(docs.sparkSession, model)(F.col(text)))
    return out.withColumn("lang_pred", F.col(at)["lang_pred"]).withColumn("score", F.col(at)["score"]).drop(at)


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text", min_score: float = 0.5) -> DataFrame:
    """The rows whose language is known with ``min_score`` at least, all columns unchanged."""
    at = fresh(docs, "predicted")
    out = docs.withColumn(at, predictor(docs.sparkSession, model)(F.col(text)))
    return out.filter((F.col(at)["lang_pred"] != UNKNOWN) & (F.col(at)["score"] >= min_score)).drop(at)
