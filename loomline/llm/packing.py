"""Hierarchical multi-length packing of documents into training sequences.

Each document is tokenised and ended with ``end_id``.  Whole long windows are
cut off first; what is left of a document is routed to the smallest context
tier that holds it.  Tiers are packed from the longest to the shortest: the
largest remainder of the tier opens a window, the gap is filled by best fit
with remainders of the same and of shorter tiers, and only where none fits is
one cut to fill the window exactly.  A window that cannot be filled goes back
to the pool and waits for the documents that follow.  At the end of a
partition less than one long window is left; it is emitted as windows of
power-of-two lengths, so that no window is padded at all.

Windows of all tiers are dealt to step groups of about ``group_tokens`` tokens
so that each group holds the same mix of tiers.

Work is one pass without a shuffle; a task holds the ids of ``buffer_tokens``
tokens and of one batch of documents.  Sequence ids are unique over the whole
result and the same when a lost task runs again.

Defined results: a null or empty text has ``end_id`` alone; a null id stays
null; repeated rows are packed one by one; an empty table gives no row.  Only
the named columns are read.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ._common import as_id, small_batches, tidy
from .tokens import default_path, tokenizer

SCHEMA = "doc_id long, start long, length long, tokens binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
TIERS = (512, 1024, 2048, 4096)


class Packer:
    """Packs pieces (document number, start, length); says what each window holds."""

    def __init__(self, tiers: tuple[int, ...] = TIERS) -> None:
        self.tiers = tuple(sorted(tiers))
        self.pool: list[tuple[int, int, int]] = []  # (length, document, start), sorted
        self.windows: list[tuple[int, list[tuple[int, int, int]]]] = []

    @property
    def longest(self) -> int:
        return self.tiers[-1]

    def add(self, doc: int, n: int) -> None:
        """Route a document of ``n`` tokens: whole long windows, then the rest to its tier."""
        start = 0
        while n - start >= self.longest:
            self.windows.append((self.longest, [(doc, start, self.longest)]))
            start += self.longest
        if n > start:
            bisect.insort(self.pool, (n - start, doc, start))

    def _fitting(self, gap: int) -> int:
        """Place in the pool of the longest piece of at most ``gap`` tokens, or -1."""
        return bisect.bisect_right(self.pool, (gap, float("inf"), 0)) - 1

    def pack(self) -> None:
        """Fill windows tier by tier; the pool keeps what fills no window."""
        left = sum(p[0] for p in self.pool)
        for tier, below in zip(self.tiers[::-1], (*self.tiers[-2::-1], 0), strict=True):
            while left >= tier and self.pool and self.pool[-1][0] > below and (at := self._fitting(tier)) >= 0:
                if self.pool[at][0] <= below:
                    break
                length, doc, start = self.pool.pop(at)
                window, gap = [(doc, start, length)], tier - length
                while gap and self.pool:
                    at = self._fitting(gap)
                    if at >= 0:
                        length, doc, start = self.pool.pop(at)
                    else:  # nothing fits: cut the shortest piece
                        length, doc, start = self.pool.pop(0)
                        bisect.insort(self.pool, (length - gap, doc, start + gap))
                        length = gap
                    window.append((doc, start, length))
                    gap -= length
                self.windows.append((tier, window))
                left -= tier

    def flush(self) -> None:
        """Emit the rest of the pool as windows of power-of-two lengths."""
        self.pack()
        pieces = [(doc, start, length) for length, doc, start in self.pool]
        self.pool = []
        total = sum(p[2] for p in pieces)
        while total:
            size = min(self.longest, 1 << (total.bit_length() - 1))
            window, gap = [], size
            while gap:
                doc, start, length = pieces.pop()
                take = min(gap, length)
                window.append((doc, start, take))
                if take < length:
                    pieces.append((doc, start + take, length - take))
                gap -= take
            self.windows.append((size, window))
            total -= size


def step_groups(sizes: list[int], group_tokens: int) -> list[int]:
    """A group for each window: each group gets its share of every tier."""
    groups = max(1, round(sum(sizes) / group_tokens))
    by: dict[int, list[int]] = defaultdict(list)
    for i, size in enumerate(sizes):
        by[size].append(i)
    out, shift = [0] * len(sizes), 0
    for size in sorted(by, reverse=True):
        for k, i in enumerate(by[size]):
            out[i] = (k + shift) % groups
        shift += len(by[size])
    return out


def pack(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    tokenizer_path: str | None = None,
    end_id: int = 2,
    tiers: tuple[int, ...] = TIERS,
    buffer_tokens: int = 1 << 20,
    group_tokens: int = 1 << 16,
) -> DataFrame:
    """One row per piece; ``tokens`` holds its ids as little-endian unsigned 32-bit integers."""
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers are powers of two")
    small_batches(docs.sparkSession)
    path = tokenizer_path or default_path()
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("tokens", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()), ("step_group", pa.int64())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokenizer(path)
        base = TaskContext.get().partitionId() << 32
        packer, ids, names = Packer(tiers), {}, {}
        doc = sequence = group = held = 0

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, group
            windows, packer.windows = packer.windows, []
            dealt = step_groups([size for size, _ in windows], group_tokens)
            columns: list[list] = [[] for _ in fields]
            for (size, window), g in zip(windows, dealt, strict=True):
                offset = 0
                for d, start, length in window:
                    row = (names[d], start, length, ids[d][start : start + length].tobytes(), len(ids[d]), base | sequence, offset, size, base | (group + g))
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += length
                sequence += 1
            group += max(dealt, default=-1) + 1
            waiting = {d for _, d, _ in packer.pool}
            for d in [d for d in ids if d not in waiting]:
                del ids[d], names[d]
            for i in range(0, len(columns[0]), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 2000], f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for name, found in zip(part.column(0).to_pylist(), known.encode(part.column(1).to_pylist()), strict=True):
                    ids[doc], names[doc] = np.append(found, np.uint32(end_id)).astype("<u4"), name
                    packer.add(doc, len(ids[doc]))
                    held += len(ids[doc])
                    doc += 1
                if held >= buffer_tokens:
                    packer.pack()
                    yield from rows()
                    held = 0
        packer.flush()
        yield from rows()

    return docs.select(as_id(key), docs[text].cast("string")).mapInArrow(tidy(run), SCHEMA)
