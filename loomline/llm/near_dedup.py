"""Near-duplicate classes: consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of its shingles, runs of five words (lower-cased
letters, digits and underscores; a shorter text is one shingle).  A shingle's
weight is its count in the text times one plus its inverse document frequency,
scaled to 0..1 by the logarithm of the number of documents.  Document
frequencies of shingles are counted over all documents into a fixed number of
buckets of their hash.  The one is there because the frequent shingles of a
corpus are above all those of its copies: with the bare inverse frequency a
large group's common text would weigh next to nothing against a small edit.

Improved consistent weighted sampling draws ``bands * rows`` samples; two
texts share a sample with the probability of their weighted Jaccard
similarity.  Bands of ``rows`` samples are hashed.  Texts that share a band
are candidates, and exact weighted Jaccard similarity decides each link.

Copies (equal word sequences) are collapsed first.  Within a bucket not all
pairs are made.  First each member is compared with one pivot, the member that
shares most buckets with others: of many edits of a text that is the text
itself or the least edited one.  Links are joined into components, and a bucket
whose members lie in one class is done.  In the others, members of different
classes are paired if 320 further samples say that they may be links and their
profiles allow it: the weights of a text's shingles, summed by groups of the
shingles' hashes.  Two texts have at most the lesser weight of each group in
common, so no link is lost by this, and of texts that are alike but under the
threshold few pairs are made.  These pairs are verified like the first.  So
links that would join two classes are found too, and a group of many copies
makes few pairs.

Defined results: null and empty texts are alone in their class; texts without
a word are equal only to the same text; very long texts are compared whole; a
row with a null id is in no class: its class is null, and it is kept; rows that repeat an id and a text are one document, and rows that
share an id alone stand or fall together; an empty table gives no row.  Further columns are passed through by ``keep_first``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import as_id, blocks, fresh, lower_words, mix64, small_batches, tidy, written
from .components import components, joined_further

#: Buckets of the table of document frequencies: its size is fixed.
SKETCH_BITS = 18

#: Least and greatest number of groups of a profile, as powers of two.
PROFILE_BITS = (6, 12)


@dataclass(frozen=True)
class Plan:
    threshold: float = 0.8
    shingle: int = 5
    bands: int = 16
    rows: int = 5
    seed: int = 11
    #: Further samples of texts in undecided buckets, and the least share of
    #: equal ones that a pair must show there: five standard deviations below the
    #: threshold, so that practically no link is lost here.
    fine: int = 320
    fine_least: float = 0.68


@dataclass(frozen=True)
class Frequencies:
    """Scaled inverse document frequency by bucket of a shingle's hash."""

    idf: np.ndarray

    def of(self, shingles: np.ndarray) -> np.ndarray:
        return self.idf[bucket_of(shingles)]


def bucket_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def shingles_of(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of fewer words, of all of them."""
    k = min(size, len(words))
    if not k:
        return np.zeros(0, np.uint64)
    n = len(words) - k + 1
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = (h ^ words[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return mix64(h)


def shingle_frequencies(docs: DataFrame, text: str = "text", size: int = Plan.shingle) -> Frequencies:
    """Document frequencies of all shingles of all documents, in fixed buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(1 << SKETCH_BITS, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, texts in blocks(batch.column(0).to_pylist()):
                words, first = lower_words(texts)
                length = np.diff(first)
                # runs that stay in their text, of all texts at once; texts of fewer words one by one
                long = shingles_of(words, size) if len(words) >= size else np.zeros(0, np.uint64)
                owner = np.repeat(np.arange(len(texts)), length)[: len(long)]
                own = np.flatnonzero(np.arange(len(long)) + size <= first[owner + 1])
                codes = [owner[own] << SKETCH_BITS | bucket_of(long[own])]
                short = np.flatnonzero((length > 0) & (length < size))
                codes += [np.array([i << SKETCH_BITS]) | bucket_of(shingles_of(words[first[i] : first[i + 1]], size)) for i in short]
                counts += np.bincount(np.unique(np.concatenate(codes)) & ((1 << SKETCH_BITS) - 1), minlength=1 << SKETCH_BITS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(counts[used], n))], ["bucket", "n"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(tidy(run), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = int(rows.loc[rows.bucket < 0, "n"].sum())
    df = np.ones(1 << SKETCH_BITS)
    rows = rows[rows.bucket >= 0]
    df[rows.bucket.to_numpy()] = rows.n.to_numpy()
    return Frequencies(np.clip(np.log((total + 1) / df) / np.log(total + 2), 0, 1).astype(np.float32))


def weighted_shingles(words: np.ndarray, frequencies: Frequencies, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of one text, by hash, and their weights."""
    unique, count = np.unique(shingles_of(words, size), return_counts=True)
    return unique, (count * (1 + frequencies.of(unique))).astype(np.float32)


def profile(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights of a text by group of its shingles' hashes; about as many groups as it weighs, a power of two."""
    groups = 1 << int(np.clip(np.ceil(np.log2(weights.sum(dtype=np.float64))), *PROFILE_BITS))
    return np.bincount((shingles & np.uint64(groups - 1)).astype(np.int64), weights, groups).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling, a sample for all texts of a block at a time.

    r and c are Gamma(2, 1) and beta is uniform, each read from a fixed table
    by 16 bits of the product of the shingle's hash and the sample's
    multiplier.  ln a = ln c - r (floor(ln w / r + beta) - beta + 1); the least
    one is the sample, and its bits name it.
    """

    def __init__(self, samples: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.r = np.maximum(rng.gamma(2, 1, 1 << 16), 1e-3).astype(np.float32)
        self.inverse = (1 / self.r).astype(np.float32)
        self.ln_c = np.log(rng.gamma(2, 1, 1 << 16)).astype(np.float32)
        self.beta = rng.random(1 << 16).astype(np.float32)
        self.multipliers = rng.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, shingles: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(samples, texts): sample names; ``first``: offset of each (non-empty) text."""
        out = np.empty((len(self.multipliers), len(first)), np.uint32)
        ln_w = np.log(weights)
        for k, m in enumerate(self.multipliers):
            bits = (shingles * m).view(np.uint16).reshape(-1, 4)
            i, beta = bits[:, 3], self.beta[bits[:, 1]]
            t = np.floor(ln_w * self.inverse[i] + beta)
            ln_a = self.ln_c[bits[:, 2]] - self.r[i] * (t - beta + np.float32(1))
            out[k] = np.minimum.reduceat(ln_a, first).view(np.uint32)
        return out


def band_hashes(samples: np.ndarray, plan: Plan) -> np.ndarray:
    """(texts, bands)"""
    out = np.empty((samples.shape[1], plan.bands), np.uint64)
    for b in range(plan.bands):
        h = np.full(samples.shape[1], np.uint64(b + 1))
        for s in samples[b * plan.rows : (b + 1) * plan.rows]:
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + s)
        out[:, b] = h
    return out


def text_key(words: np.ndarray, text: str) -> bytes:
    """128 bits that name a word sequence; of a text without words, the text."""
    raw = words.tobytes() if len(words) else b"\0" + text.encode("utf-8", "surrogatepass")
    return hashlib.blake2b(raw, digest_size=16).digest()


def signatures(docs: DataFrame, frequencies: Frequencies, text: str, key: str, plan: Plan) -> DataFrame:
    """(id, node, weight, bands) of every row with an id; node null for empty texts."""
    shared = docs.sparkSession.sparkContext.broadcast(frequencies)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(plan.bands * plan.rows, plan.seed)
        for batch in batches:
            ids = batch.column(0)
            for start, texts in blocks(batch.column(1).to_pylist()):
                words, first = lower_words(texts)
                sets = [weighted_shingles(words[first[i] : first[i + 1]], shared.value, plan.shingle) for i in range(len(texts))]
                size = np.array([len(s) for s, _ in sets])
                some = np.flatnonzero(size)
                bands: list = [[] for _ in texts]
                if len(some):
                    offsets = np.cumsum(size[some]) - size[some]
                    names = sampler(np.concatenate([sets[i][0] for i in some]), np.concatenate([sets[i][1] for i in some]), offsets)
                    for i, row in zip(some, band_hashes(names, plan).view(np.int64), strict=True):
                        bands[i] = row
                nodes = [text_key(words[first[i] : first[i + 1]], t) if t else None for i, t in enumerate(texts)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, len(texts)), pa.array(nodes, pa.binary()), pa.array([float(w.sum()) for _, w in sets]), pa.array(bands, pa.list_(pa.int64()))],
                    ["id", "node", "weight", "bands"],
                )

    rows = docs.select(as_id(key).alias("id"), F.col(text).cast("string").alias("text")).filter("id IS NOT NULL")
    return written(rows.mapInArrow(tidy(run), "id long, node binary, weight double, bands array<long>"), "signatures")


def weighted_jaccard(a: tuple, b: tuple) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64)) - both
    return both / total if total else 0.0


def _verified(pairs: DataFrame, texts: DataFrame, frequencies, plan: Plan) -> DataFrame:
    """The links (a, b, similarity) among candidate pairs (a, pivot)."""
    held = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    held = held.join(texts.select(F.col("node").alias("pivot"), F.col("text").alias("text_p")), "pivot").select("a", "pivot", "text_a", "text_p")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                a, p, ta, tp = (c.to_pylist() for c in part.columns)
                out = []
                for i in range(len(a)):
                    if p[i] != last:
                        last, known = p[i], weighted_shingles(lower_words([tp[i]])[0], frequencies.value, plan.shingle)
                    s = weighted_jaccard(weighted_shingles(lower_words([ta[i]])[0], frequencies.value, plan.shingle), known)
                    if s >= plan.threshold:
                        out.append((a[i], p[i], s))
                cols = list(zip(*out, strict=True)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.binary(), pa.binary(), pa.float64()), strict=True)], ["a", "b", "similarity"])

    return _few_files(held.mapInArrow(tidy(run), "a binary, b binary, similarity double"))


def _few_files(df: DataFrame) -> DataFrame:
    """``df``, a narrow table that a larger stage makes, dealt to a part for each core before it is written."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _texts(docs: DataFrame, nodes: DataFrame, text: str, key: str) -> DataFrame:
    """(node, text) of the nodes (node, rep), from the documents' own rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            right = [text_key(lower_words([t])[0], t) == n for n, t in zip(nodes, texts, strict=True)]
            yield batch.filter(pa.array(right, pa.bool_()))

    rows = docs.select(as_id(key).alias("rep"), F.col(text).cast("string").alias("text")).filter("text IS NOT NULL")
    return written(rows.join(nodes, "rep").select("node", "text").mapInArrow(tidy(run), "node binary, text string"), "candidate-texts")


def fine_sketches(texts: DataFrame, frequencies, plan: Plan) -> DataFrame:
    """(node, sketch, profile); sketch: four bits of each of ``fine`` further samples, 16 to a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(plan.fine, plan.seed + 1)
        for batch in batches:
            for start, run_of in blocks(batch.column(1).to_pylist()):
                words, first = lower_words(run_of)
                sets = [weighted_shingles(words[first[i] : first[i + 1]], frequencies.value, plan.shingle) for i in range(len(run_of))]
                some = np.flatnonzero([len(s) for s, _ in sets])
                if not len(some):
                    continue
                size = np.array([len(sets[i][0]) for i in some])
                names = sampler(np.concatenate([sets[i][0] for i in some]), np.concatenate([sets[i][1] for i in some]), np.cumsum(size) - size)
                nibbles = (mix64(names.astype(np.uint64)) >> np.uint64(60)).T.reshape(len(some), -1, 16)
                packed = (nibbles << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64)
                profiles = pa.array([profile(*sets[i]) for i in some], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(run_of)).take(pa.array(some)), pa.array(list(packed.view(np.int64)), pa.list_(pa.int64())), profiles], ["node", "sketch", "profile"])

    return texts.select("node", "text").mapInArrow(tidy(run), "node binary, sketch array<long>, profile array<float>")


def _differing(a: str, b: str, longs: int) -> str:
    """SQL: how many of the sketches' samples differ."""
    one = "bit_count(({y} | shiftrightunsigned({y}, 2)) & 1229782938247303441L)"
    each = []
    for i in range(longs):
        x = f"({a}[{i}] ^ {b}[{i}])"
        each.append(one.format(y=f"({x} | shiftrightunsigned({x}, 1))"))
    return " + ".join(each)


def _common_at_most(a: str, b: str) -> str:
    """SQL: a bound of the weight that two texts have in common, by their profiles.
    Weights within the threshold give equal numbers of groups or one twice the other, which is folded."""
    least = lambda x, y: f"aggregate(zip_with({x}, {y}, (p, q) -> least(p, q)), 0D, (s, v) -> s + v)"
    half = lambda x: f"shiftright(size({x}), 1)"
    folded = lambda x: f"zip_with(slice({x}, 1, {half(x)}), slice({x}, {half(x)} + 1, {half(x)}), (p, q) -> p + q)"
    return f"CASE WHEN size({a}) = size({b}) THEN {least(a, b)} WHEN size({a}) > size({b}) THEN {least(folded(a), b)} ELSE {least(a, folded(b))} END"


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", plan: Plan = Plan()) -> DataFrame:
    """A row for each row of ``docs``: id and class_id, the least id of its class."""
    spark = docs.sparkSession
    small_batches(spark)
    frequencies = shingle_frequencies(docs, text, plan.shingle)
    shared = spark.sparkContext.broadcast(frequencies)
    signed = signatures(docs, frequencies, text, key, plan)
    nodes = signed.filter("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("rep"), F.first("weight").alias("weight"), F.first("bands").alias("bands"))
    in_band = nodes.select("node", "rep", "weight", F.explode("bands").alias("band"))
    # what is joined by band is written first: adaptive execution can then split a band that many hold
    full = written(_few_files(in_band.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")), "buckets")
    members = written(in_band.join(full, "band"), "bucket-members")
    # a bound that holds exactly: the weights of two texts differ at most by the similarity
    like = lambda x, y: F.least(x, y) >= plan.threshold * F.greatest(x, y) * (1 - 1e-6)
    # the pivot of a bucket is its member with the most company over all its buckets: the least edited copy
    company = members.groupBy("node").agg(F.sum("n").alias("company"))
    pivots = written(_few_files(members.join(company, "node").groupBy("band").agg(F.max(F.struct("company", "node", "weight")).alias("p"))), "pivots")
    pairs = members.join(pivots, "band").filter((F.col("node") != F.col("p.node")) & like(F.col("weight"), F.col("p.weight")))
    pairs = pairs.select(F.col("node").alias("a"), F.col("p.node").alias("pivot")).distinct()
    texts = _texts(docs, members.select("node", "rep").distinct(), text, key)
    links = written(_verified(pairs, texts, shared, plan), "near-links")
    joined = components(links)
    # buckets whose members still lie apart: all pairs across classes whose sketches say they may be links
    now = members.select("band", "node", "weight").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = now.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")).filter("x <> y AND n > 2").select("band")
    apart = written(now.join(written(_few_files(mixed), "mixed"), "band"), "mixed-buckets")
    if not apart.isEmpty():
        some = apart.select("node").distinct()
        sketches = written(fine_sketches(texts.join(some, "node", "left_semi"), shared, plan), "fine-sketches")
        rows = written(apart.join(sketches, "node").join(nodes.select("node", "bands"), "node"), "sketched-members")
        other = rows.select(F.col("band").alias("o_band"), *(F.col(c).alias(f"o_{c}") for c in ("node", "weight", "component", "sketch", "profile", "bands")))
        most = int(plan.fine * (1 - plan.fine_least) * 15 / 16)
        close = F.expr(f"{_differing('sketch', 'o_sketch', plan.fine // 16)} <= {most}")
        across = (F.col("node") < F.col("o_node")) & (F.col("component") != F.col("o_component")) & like(F.col("weight"), F.col("o_weight")) & close
        # a pair is made in the first band it shares; in a bucket of two it was compared already
        across = across & (F.array_min(F.array_intersect("bands", "o_bands")) == F.col("band"))
        # the similarity is the common weight over the rest of both weights; single precision is allowed for
        across = across & (F.expr(_common_at_most("profile", "o_profile")) * (1 + plan.threshold) >= plan.threshold * (F.col("weight") + F.col("o_weight")) * (1 - 1e-5))
        more = rows.join(other, (F.col("band") == F.col("o_band")) & across).select(F.col("node").alias("a"), F.col("o_node").alias("pivot")).distinct()
        more = written(_verified(more, texts, shared, plan), "near-links")
        if not more.isEmpty():
            joined = joined_further(joined, more)
    of_class = joined.join(nodes.select("node", "rep"), "node").select("component", "rep")
    heads = nodes.select(F.col("node").alias("component"), "rep")
    ids = of_class.unionByName(heads.join(joined.select("component").distinct(), "component")).groupBy("component").agg(F.min("rep").alias("class"))
    named = nodes.select("node", "rep").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")).join(ids, "component", "left")
    named = named.select("node", F.coalesce("class", "rep").alias("class"))
    found = signed.select("id", "node").join(named, "node", "left").select("id", F.coalesce("class", "id").alias("class_id"))
    nameless = docs.select(as_id(key).alias("id")).filter("id IS NULL").select("id", F.lit(None).cast("long").alias("class_id"))
    return found.unionByName(nameless)


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id", plan: Plan = Plan()) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the document
    with the least id stays, all columns unchanged."""
    found = written(classes(docs, text, key, plan), "near-classes")
    at = fresh(docs, "dropped_id")
    kept = docs.join(found.filter("class_id < id").select(F.col("id").alias(at)).distinct(), F.col(key).cast("long") == F.col(at), "left_anti")
    repeated = written(found.filter("class_id = id").groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("id").alias(at)), "repeated-ids")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, F.col(key).cast("long") == F.col(at), "left_semi").dropDuplicates([key, text])
    return kept.join(repeated, F.col(key).cast("long") == F.col(at), "left_anti").unionByName(once)
