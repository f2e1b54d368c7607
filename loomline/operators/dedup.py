"""Exact and near duplicates of records, the first in priority order kept.

Near duplicates are records that collide in a band of MinHash values.  The
records kept are the lexicographically first maximal independent set of the
collision graph in priority order: what a serial pass keeps that inserts only
what it keeps.  It is found in rounds, per bucket, without making pairs.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.storage import cut
from ..functions.text import bound, once, shingles, words

BANDS, ROWS = 5, 11
PRIME = (1 << 31) - 1


def permutations(n: int = BANDS * ROWS, seed: int = 1) -> list[tuple[int, int]]:
    """(a, b) of the hash family (a x + b) mod (2**31 - 1)."""
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(n)]


def first_of_each(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each group of equal ``keys``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def exact_key(body: Column) -> Column:
    return F.md5(F.lower(body))


def shingle_set(body: Column, n: int = 5) -> Column:
    return bound(F.lower(body), lambda low: bound(words(low), lambda tokens: shingles(low, tokens, n)))


def shingle_counts(body: Column) -> Column:
    """struct<n, least> of a text's distinct shingles, made in its row: none is moved or sorted."""
    return bound(shingle_set(body), lambda g: F.struct(F.size(g).cast("long").alias("n"), F.array_min(g).alias("least")))


def shingle_hash(shingle: Column) -> Column:
    """The first 31 bits of a shingle's MD5, modulo the prime."""
    return F.pmod(F.shiftright(F.conv(F.substring(F.md5(shingle), 1, 8), 16, 10).cast("long"), 1), F.lit(PRIME))


#: Hashes that one numpy pass handles together, wherever texts begin and end.
PIECE = 1 << 16


def minima(lists: pa.ListArray, family: list[tuple[int, int]], piece: int = PIECE) -> pa.ListArray:
    """Per list of hashes its minima under the family; null for a list without any."""
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    some = size > 0
    ends = np.cumsum(size[some], dtype=np.int64)
    first = ends - size[some]
    values = lists.flatten().to_numpy(zero_copy_only=False)
    found = np.full((len(ends), len(family)), PRIME, np.int32)
    for at in range(0, len(values), piece):
        x = values[at : at + piece].astype(np.int64)
        lo, hi = np.searchsorted(ends, at, "right"), np.searchsorted(first, at + len(x))
        starts, rows = np.maximum(first[lo:hi] - at, 0), found[lo:hi]
        for j, (a, b) in enumerate(family):
            rows[:, j] = np.minimum(rows[:, j], np.minimum.reduceat((a * x + b) % PRIME, starts))
    offsets = np.concatenate([[0], np.cumsum(some * len(family))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.reshape(-1)), mask=pa.array(~some))


def signature(hashes: Column, n: int = BANDS * ROWS) -> Column:
    """Minima of the hash family over the hashes of a text's shingles; null for a text without any.

    Spark ends a batch at 10000 rows or 64 MB (its defaults), and Python reads it
    where it lies, a piece at a time, so a worker's memory doesn't follow the table.
    """
    family = permutations(n)

    @F.arrow_udf("array<int>")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield minima(lists, family)

    # so marked, it is neither moved into filters nor run twice
    return made.asNondeterministic()(hashes)


def signed(df: DataFrame, body: str, out: str) -> DataFrame:
    """``df`` with the signature of the text in column ``body``."""
    hashed = df.withColumn(out, once(F.transform(shingle_set(F.col(body)), lambda g: shingle_hash(g).cast("int"))))
    return hashed.withColumn(out, signature(F.col(out)))


def signed_firsts(df: DataFrame, body: Column, order: list, out: str) -> DataFrame:
    """(_key, the columns of ``order``, signature) of the first record of each distinct text.

    Copies are signed too: a signature is much narrower than a text, so no text
    is moved or sorted.
    """
    keyed = df.select(exact_key(body).alias("_key"), body.alias("_body"), *_names(order))
    return first_of_each(signed(keyed, "_body", out).drop("_body"), ["_key"], order)


def bands(values: Column) -> Column:
    """One key per band: its number and the MD5 of its minima."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.concat(i.cast("string"), F.lit(":"), F.md5(F.array_join(F.transform(F.slice(values, i * ROWS + 1, F.lit(ROWS)), lambda v: v.cast("string")), ",")))
    )


def partners(members: DataFrame, node: str, keys: str) -> DataFrame:
    """(node, n_partners): how many other nodes share a band with each, of
    ``members`` (node, array of one key per band), without making a pair.

    Nodes that share all bands of a set are counted for each set of bands; the
    sum over sets, with signs, counts each partner once.
    """
    sets = [[b for b in range(BANDS) if s >> b & 1] for s in range(1, 1 << BANDS)]
    rows = F.array(*(F.struct(F.lit(1 if len(s) % 2 else -1).alias("sign"), F.concat_ws("|", *(F.col(keys)[b] for b in s)).alias("shared")) for s in sets))
    each = members.select(node, F.inline(rows))
    sizes = cut(each.groupBy("shared").agg(F.count("*").alias("n")).filter("n > 1"))
    got = each.join(sizes, "shared").groupBy(node).agg(F.sum(F.col("sign") * (F.col("n") - 1)).alias("n_partners"))
    return members.select(node).join(got, node, "left").select(node, F.coalesce("n_partners", F.lit(0)).alias("n_partners"))


def keep_first(members: DataFrame) -> DataFrame:
    """Nodes (numbers in priority order) that are dropped, of ``members``
    (bucket, node).

    Each round keeps every node that is first among the undecided of all its
    buckets, and drops the others there.  Ends when nothing is undecided.
    """
    # aggregates are written before they are joined: adaptive execution can then split a bucket that many hold
    left = cut(members.join(cut(members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")), "bucket"))
    dropped = members.select("node").filter("false")
    while not left.isEmpty():
        seen = left.join(cut(left.groupBy("bucket").agg(F.min("node").alias("first"))), "bucket")
        kept = seen.groupBy("node").agg(F.min("first").alias("m")).filter("m = node").select("node")
        hit = seen.join(kept.withColumnRenamed("node", "first"), "first", "left_semi").filter("node <> first").select("node").distinct()
        decided = cut(kept.withColumn("gone", F.lit(False)).unionByName(hit.withColumn("gone", F.lit(True))))
        dropped = dropped.unionByName(decided.filter("gone").select("node"))
        left = cut(left.join(decided, "node", "left_anti"))
    return dropped


def near_duplicates(df: DataFrame, body: Column, order: list) -> DataFrame:
    """``df`` with ``dropped``: null if kept, else ``exact`` (a copy of a kept
    record) or ``near``.

    Copies share a signature, so they are decided with their first one.
    """
    keyed = df.withColumn("_key", exact_key(body))
    first = signed_firsts(df, body, order, "s")
    # the priority number orders nodes; it is a struct, so no global sort is needed
    node = cut(first.select("_key", F.struct(*_names(order)).alias("node"), "s"))
    members = cut(node.filter("s IS NOT NULL").select("node", F.explode(bands(F.col("s"))).alias("bucket")))
    gone = keep_first(members).withColumn("_near", F.lit(True))
    state = node.select("_key", "node").join(gone, "node", "left")
    out = keyed.join(state.select("_key", "node", "_near"), "_key")
    mine = F.struct(*_names(order)) == F.col("node")
    return out.withColumn("dropped", F.when(F.col("_near"), "near").when(~mine, "exact")).drop("_key", "_near", "node")


def survivors(df: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``df`` whose keys were kept, as a new table."""
    return df.join(kept.select(*keys).distinct(), keys, "left_semi")


def _names(order: list) -> list[str]:
    return [c if isinstance(c, str) else c._jc.toString() for c in order]
