"""Helpers that several operators share: names, shared storage, blocks of text."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import remove, shared_dir, written  # noqa: F401  shared with the operators

#: Code points of text that one numpy pass handles together; a longer text is a block of its own.
BLOCK_CHARS = 1 << 18


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet (names compare without case)."""
    used = {c.lower() for c in df.columns}
    name, n = base, 0
    while name.lower() in used:
        n += 1
        name = f"{base}_{n}"
    return name


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in batches of ``rows`` rows at most: a batch stands
    in memory several times (Arrow on both sides, Python strings)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if not 0 < now <= rows:
        spark.conf.set(name, str(rows))


def release() -> None:
    """Give memory that this process no longer uses back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library keeps its own books


def tidy(run):
    """``run`` for mapInArrow; its worker, which lives on, gives memory back after each partition."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def as_id(column: str):
    """The id as a long, whatever integer type the table has."""
    return F.col(column).cast("long")


def blocks(texts: Iterable[str | None], size: int = BLOCK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(index of the first text, texts) in runs of about ``size`` code points."""
    run: list[str] = []
    first = total = 0
    for i, text in enumerate(texts):
        text = text or ""
        if run and total + len(text) > size:
            yield first, run
            run, first, total = [], i, 0
        run.append(text)
        total += len(text) + 1
    if run:
        yield first, run


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points, each followed by a line feed, and
    the offsets of the texts (one more than there are texts)."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths + 1, out=offsets[1:])
    joined = "\n".join(texts) + "\n" if texts else ""
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), offsets


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            inverse = pow(self.BASE, -1, 1 << 64)
            self.up, self.down = (self._series(b, size) for b in (self.BASE, inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _series(base: int, size: int) -> np.ndarray:
        out, n = np.ones(size, np.uint64), 1
        while n < size:
            step = np.uint64(pow(base, n, 1 << 64))
            out[n : 2 * n] = out[:n] * step
            n *= 2
        return out


_powers = Powers()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[start:end]`` for many spans, by one prefix sum.

    The hash of a span does not depend on where it stands.
    """
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_tables: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """By code point: its lower-case form if it is a letter, else a space."""
    if "letter" not in _tables:
        out = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000 and (s := chr(c)).isalpha():
                low = s.lower()
                out[c] = ord(low[0])
        _tables["letter"] = out
    return _tables["letter"]


def word_table() -> np.ndarray:
    """By code point: its lower-case form if it is a letter, digit or underscore, else 0."""
    if "word" not in _tables:
        out = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000 and ((s := chr(c)).isalnum() or s == "_"):
                out[c] = ord(s.lower()[0])
        _tables["word"] = out
    return _tables["word"]


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def lower_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words (letters, digits, underscores) of all
    texts, and for each text the offset of its first word (one more at the end)."""
    points, offsets = code_points(texts)
    low = word_table()[points]
    starts, ends = runs(low != 0)
    return span_hashes(low, starts, ends), np.searchsorted(starts, offsets)


#: White space of the contracts: a word is a run of other characters.
SPACES = np.array([9, 10, 11, 12, 13, 32], np.uint32)


def space_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space: starts, ends (in the block's code points),
    the code points and the offset of each text's first word."""
    points, offsets = code_points(texts)
    inside = points > 32
    odd = np.flatnonzero(~inside)
    inside[odd] = ~np.isin(points[odd], SPACES)
    starts, ends = runs(inside)
    return starts, ends, points, np.searchsorted(starts, offsets)
