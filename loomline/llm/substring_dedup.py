"""Exact removal of repeated word windows, by partitioned suffix trees.

A window is ``window`` consecutive words of one text.  A word is removed if a
window that covers it has the same words as a window elsewhere.

Only suffixes that start a window matter, to the depth of a window.  They are
split into memory-sized groups by a run of words in the window, which is
lengthened to the whole window where a group would be too large:

1. Every window holds a least run of ``gram`` words (by hash, the leftmost
   one).  Equal windows have the same run at the same place, so windows are
   grouped by it.  Neighbouring windows mostly share their run and travel
   together, once, as one stretch of words; a run that stands once in the whole
   corpus can't belong to a repeated window, and its stretch stays at home.
2. The stretches of a group form a subtree, held as a suffix array over their
   words, which are numbered exactly (no hash decides equality here): ranks of
   suffixes by doubling, then the neighbours in suffix order whose common
   prefix is a window deep.  Such deep internal nodes are the repeats, and
   runs of neighbouring windows under them the maximal ones.
3. A group of more than ``hot`` stretches is split by the longest prefix there
   is, the whole window (128 bits of it): its subtrees are leaves with a count,
   which Spark pre-aggregates before the shuffle, so no task gathers the group.

The texts themselves are written once under a row number and never shuffled:
what was found about rows is written by the part of the table that holds them,
in at most ``FOLDERS`` folders, and read there.

Defined results: null and empty texts have no word, and nothing is removed;
texts with fewer words than a window lose nothing; rows that repeat an id or a
text are rows of their own (and repeats of each other); an empty table gives no
row; a null id stays null.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import as_id, mix64, runs, shared_dir, small_batches, span_hashes, tidy, written

PART_BITS = 33
#: Folders of a side table; a folder holds every so many-th part, sorted by row.
FOLDERS = 2048


@dataclass(frozen=True)
class Plan:
    window: int = 35
    gram: int = 8
    #: Words of the stretches whose subtrees a task holds at a time.
    batch_words: int = 1 << 20
    #: Stretches of a group (some 60 words each) that still fit in such a batch.
    hot: int = 16_000


def byte_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the offset of each text's first word."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = (data > 32) | (data < 9) | ((data > 13) & (data < 32))
    starts, ends = runs(inside)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def byte_blocks(texts: list[bytes | None], size: int = 1 << 18) -> Iterator[tuple[int, list[bytes]]]:
    run: list[bytes] = []
    first = total = 0
    for i, t in enumerate(texts):
        t = t or b""
        if run and total + len(t) > size:
            yield first, run
            run, first, total = [], i, 0
        run.append(t)
        total += len(t) + 1
    if run:
        yield first, run


def exact_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all texts, equal for equal words only, and the
    offset of each text's first word."""
    known: dict[bytes, int] = defaultdict(itertools.count().__next__)
    split = [t.split() for t in texts]
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(s) for s in split], out=first[1:])
    return np.fromiter((known[w] for s in split for w in s), np.int64, int(first[-1])), first


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    n = max(0, len(words) - size + 1)
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = (h ^ words[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return mix64(h)


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """For each start, where the leftmost least of ``width`` values stands."""
    low, at, span = values, np.arange(len(values)), 1

    def merged(step: int) -> tuple[np.ndarray, np.ndarray]:
        right = low[step:] < low[: len(low) - step]
        return np.where(right, low[step:], low[: len(low) - step]), np.where(right, at[step:], at[: len(at) - step])

    while span * 2 <= width:
        low, at = merged(span)
        span *= 2
    if span < width:
        low, at = merged(width - span)
    return at


def stretches(words: np.ndarray, first: np.ndarray, plan: Plan) -> tuple[np.ndarray, ...]:
    """Runs of windows of a text that share their least run of words: text,
    first window (in its text), number of windows, hash of the run."""
    none = np.zeros(0, np.int64)
    if len(words) < plan.window:
        return none, none, none, none
    grams = gram_hashes(words, plan.gram)
    at = least_in_window(grams, plan.window - plan.gram + 1)
    count = np.maximum(np.diff(first) - plan.window + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    if not len(text):
        return none, none, none, none
    anchor = at[first[text] + start]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(text) != 0))))
    return text[new], start[new], np.diff(np.append(new, len(text))), grams[anchor[new]].view(np.int64)


def repeated_starts(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Whether another of the ``starts`` has the same ``depth`` words: suffix
    ranks by doubling, then neighbours in suffix order that agree that deep."""
    rank, span = np.unique(words, return_inverse=True)[1].astype(np.int64), 1

    def joined(shift: int) -> np.ndarray:
        later = np.concatenate([rank[shift:], np.zeros(min(shift, len(rank)), np.int64)])
        return rank * np.int64(len(words) + 1) + later

    while span * 2 <= depth:
        rank = np.unique(joined(span), return_inverse=True)[1].astype(np.int64)
        span *= 2
    final = (joined(depth - span) if span < depth else rank)[starts]
    order = np.argsort(final, kind="stable")
    same = final[order][1:] == final[order][:-1]
    out = np.zeros(len(starts), bool)
    out[order] = np.concatenate(([False], same)) | np.concatenate((same, [False]))
    return out


class SideTable:
    """Rows about the table's rows, written by part and read where the part is."""

    def __init__(self, df: DataFrame, what: str, columns: list[str]) -> None:
        self.folder, self.columns = shared_dir(df.sparkSession, what), columns
        parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        df = df.withColumn("folder", F.shiftright("row", PART_BITS) % FOLDERS).repartition(parts, "folder").sortWithinPartitions("folder", "row")
        df.write.partitionBy("folder").parquet(self.folder)

    def reader(self) -> Reader:
        return Reader(self.folder, self.columns)


class Reader:
    """Looks up the side rows of a table's row; keeps one part at a time."""

    def __init__(self, folder: str, columns: list[str]) -> None:
        self.folder, self.columns = folder, columns
        self.part, self.rows, self.values = -1, np.zeros(0, np.int64), []

    def __call__(self, row: int) -> list[np.ndarray] | None:
        if row >> PART_BITS != self.part:
            self.part = row >> PART_BITS
            fs, path = pyarrow.fs.FileSystem.from_uri(f"{self.folder}/folder={self.part % FOLDERS}")
            self.rows, self.values = np.zeros(0, np.int64), []
            if fs.get_file_info(path).type != pyarrow.fs.FileType.NotFound:
                files = [f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(path)) if f.path.endswith(".parquet")]
                row_of = pyarrow.dataset.field("row")
                mine = (row_of >= self.part << PART_BITS) & (row_of < self.part + 1 << PART_BITS)
                table = pyarrow.dataset.dataset(files, filesystem=fs, format="parquet").to_table(columns=["row", *self.columns], filter=mine)
                rows = table["row"].to_numpy()
                order = np.argsort(rows, kind="stable")
                self.rows, self.values = rows[order], [table[c].to_numpy()[order] for c in self.columns]
        a, b = np.searchsorted(self.rows, row, "left"), np.searchsorted(self.rows, row, "right")
        return [v[a:b] for v in self.values] if b > a else None


def _records(columns: list, kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _anchors(table: DataFrame, plan: Plan) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for at, texts in byte_blocks(batch.column(1).to_pylist()):
                text, start, n, gram = stretches(*byte_words(texts), plan)
                yield _records([gram, rows[at + text], start.astype(np.int32), n.astype(np.int32)], [pa.int64(), pa.int64(), pa.int32(), pa.int32()], ["gram", "row", "start", "n"])

    return written(table.select("row", F.col("text").cast("binary")).mapInArrow(tidy(run), "gram long, row long, start int, n int"), "anchors")


def _pieces(table: DataFrame, side: SideTable, plan: Plan, kinds: dict, cut) -> DataFrame:
    """Rows that ``cut`` makes of each stretch in the side table, from its words."""
    schema = pa.schema(list(kinds.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = side.reader()
        for batch in batches:
            out: list[tuple] = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = known(row)
                if found is None:
                    continue
                words = text.as_py().split()
                for gram, start, n in zip(*(x.tolist() for x in found), strict=True):
                    out += cut(gram, row, start, n, words[start : start + n + plan.window - 1])
                if len(out) > 5000:
                    yield _records(list(zip(*out, strict=True)), schema.types, schema.names)
                    out = []
            if out:
                yield _records(list(zip(*out, strict=True)), schema.types, schema.names)

    ddl = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}
    return table.select("row", F.col("text").cast("binary")).mapInArrow(tidy(run), ", ".join(f"{k} {ddl[t]}" for k, t in kinds.items()))


def _subtrees(table: DataFrame, side: SideTable, plan: Plan) -> DataFrame:
    """(row, start, stop): words covered by repeated windows of ordinary groups."""
    kinds = {"gram": pa.int64(), "row": pa.int64(), "start": pa.int32(), "n": pa.int32(), "words": pa.binary()}
    pieces = _pieces(table, side, plan, kinds, lambda gram, row, start, n, words: [(gram, row, start, n, b" ".join(words))])
    parts = max(1, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        words, first = exact_words([r[4] for r in rows])
        n = np.array([r[3] for r in rows], np.int64)
        owner = np.repeat(np.arange(len(rows)), n)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hit = repeated_starts(words, first[owner] + inner, plan.window)
        # neighbouring repeated windows of a stretch are one maximal repeat
        owner, inner = owner[hit], inner[hit]
        new = np.flatnonzero(np.concatenate(([True], (np.diff(owner) != 0) | (np.diff(inner) != 1)))) if len(owner) else np.zeros(0, np.int64)
        last = np.append(new[1:], len(owner)) - 1 if len(owner) else new
        row = np.array([r[1] for r in rows], np.int64)
        start = np.array([r[2] for r in rows], np.int64)
        who = owner[new]
        return _records([row[who], start[who] + inner[new], start[who] + inner[last] + plan.window], [pa.int64()] * 3, ["row", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words, gram = [], 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                for r in zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns), strict=True):
                    if words >= plan.batch_words and r[0] != gram:
                        yield solve(held)
                        held, words = [], 0
                    held.append(r)
                    words, gram = words + r[3] + plan.window - 1, r[0]
        if held:
            yield solve(held)

    return pieces.repartition(parts, "gram").sortWithinPartitions("gram").mapInArrow(tidy(run), "row long, start long, stop long")


def _leaves(table: DataFrame, side: SideTable, plan: Plan) -> DataFrame:
    """The same for groups that are too large: whole windows, counted."""
    kinds = {"key": pa.binary(), "row": pa.int64(), "start": pa.int64()}

    def windows_of(gram: int, row: int, start: int, n: int, words: list[bytes]) -> list[tuple]:
        return [(hashlib.blake2b(b" ".join(words[i : i + plan.window]), digest_size=16).digest(), row, start + i) for i in range(n)]

    windows = written(_pieces(table, side, plan, kinds, windows_of), "windows")
    twice = written(windows.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key"), "repeated-windows")
    return windows.join(twice, "key").select("row", "start", (F.col("start") + plan.window).alias("stop"))


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", plan: Plan = Plan()) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, and ``kept``, the remaining words
    joined by one space (UTF-8)."""
    small_batches(docs.sparkSession)
    table = docs.select(F.monotonically_increasing_id().alias("row"), as_id(key).alias("id"), F.col(text).cast("string").alias("text"))
    folder = shared_dir(docs.sparkSession, "numbered-texts")
    table.write.parquet(folder)
    table = docs.sparkSession.read.schema("row long, id long, text string").parquet(folder)
    anchors = _anchors(table, plan)
    counts = written(anchors.groupBy("gram").agg(F.count("*").alias("c")).filter("c > 1"), "repeated-runs")
    shared = anchors.join(counts.filter(F.col("c") <= plan.hot).select("gram"), "gram")
    found = _subtrees(table, SideTable(shared, "stretches", ["gram", "start", "n"]), plan)
    hot = counts.filter(F.col("c") > plan.hot).select("gram")
    if not hot.isEmpty():
        side = SideTable(anchors.join(hot, "gram"), "hot-stretches", ["gram", "start", "n"])
        found = found.unionByName(_leaves(table, side, plan))
    repeats = SideTable(found, "repeats", ["start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = repeats.reader()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                n_words, n_removed, kept = [], [], []
                for row, body in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True):
                    words = (body or b"").split()
                    n = len(words)
                    spans = known(row)
                    if spans is not None:
                        edge = np.zeros(n + 1, np.int64)
                        np.add.at(edge, spans[0], 1)
                        np.add.at(edge, spans[1], -1)
                        words = list(compress(words, (np.cumsum(edge)[:n] == 0).tolist()))
                    n_words.append(n)
                    n_removed.append(n - len(words))
                    kept.append(b" ".join(words))
                yield _records([part.column(1), n_words, n_removed, kept], [pa.int64(), pa.int64(), pa.int64(), pa.binary()], ["doc_id", "n_words", "n_removed", "kept"])

    return table.select("row", "id", F.col("text").cast("binary")).mapInArrow(tidy(run), "doc_id long, n_words long, n_removed long, kept binary")
