"""Benchmark decontamination by edit distance: CGK embedding and bit-sampling LSH.

The CGK random walk reads a character sequence x: at step t it outputs the
current character and moves on to the next one or not, as a random bit of
(t, character) says.  Sequences at a small edit distance fall into step again
soon after each edit, so their outputs have a small Hamming distance, and bit
sampling over the output steps makes equal keys likely.

A walk starts at every character of every document and of every item, so no
window is left out.  Of its ``steps`` outputs ``samples`` make a key.  One
walk over a whole item would keep no key once a fifth of it is edited; so the
walks are short, and an item-sized window is embedded by the walks from all
its characters: these are the repetitions.  Where equal keys name an item and
the place where it would begin, places within as many characters as edits are
allowed belong to one window, and a window with ``least_hits`` keys of the
item is a candidate.  That number lies at about a third of what a fifth of the
letters edited at random leaves, which sets the recall (tests and the README
have it for letter and word edits).

Items of at most ``SHORT`` characters are looked up without loss instead: with
at most k edits one of k + 1 pieces of the item stands in the document
unchanged, so each place of a piece is a candidate, which a bit-parallel
distance in numpy sifts.  Items too short for any edit match as whole words.

Each candidate is verified exactly: the least edit distance, in characters of
the normalised text, between the item and any substring of the region.
Indexes of items are broadcast in blocks of ``ITEM_BLOCK`` items and
``ITEM_CHARS`` characters at most; further blocks are further passes.

A document is contaminated by an item if that distance is at most
``1 - threshold`` of the item's length.  Words are lower-cased runs of
letters, digits and underscores, joined by one space.

Defined results: null and empty texts match nothing; items without a word
match nothing; repeated documents and items each get their own rows; of
several places of an item in a document that with the least distance counts,
of these the first; very long texts are searched whole, in blocks of their
own; an empty benchmark or table gives no row; a null id stays null.  Only the
named columns are read, and ``keep_clean`` passes all others on, whatever
their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import ClassVar

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import as_id, blocks, code_points, fresh, mix64, release, small_batches, tidy, word_table

#: Items, and characters of items, whose keys are broadcast together (some 20 bytes a character).
ITEM_BLOCK, ITEM_CHARS = 20_000, 6_000_000
WORD = re.compile(r"\w+")
#: Characters of the items that one machine word holds.
SHORT = 64
#: Hits of keys that are handled together, and walks that take their steps together (they fit a cache).
HITS, STRIDE = 1 << 21, 1 << 15


@dataclass(frozen=True)
class Plan:
    """Parameters of the search.  A walk of ``steps`` reads about two thirds as many characters."""

    threshold: float = 0.8
    steps: int = 16
    samples: int = 10
    seed: int = 2

    def sampled(self) -> list[int]:
        """The output steps that make a key."""
        return sorted(np.random.default_rng(self.seed).choice(self.steps, self.samples, replace=False).tolist())

    def least_hits(self, length: np.ndarray) -> np.ndarray:
        """Equal keys in a window that make a candidate."""
        return np.maximum(2, length // 28)


class Walks:
    """CGK walks over code points: one from every character."""

    def __init__(self, plan: Plan) -> None:
        self.plan, self.sampled = plan, set(plan.sampled())
        # one random bit per step and character: the bits of a hash of the character; but a
        # walk that stays in an even step moves on in the next, so that no key reads few characters
        random, even = mix64(np.arange(0x110000, dtype=np.uint64) + np.uint64(plan.seed << 24)), np.uint64(0x5555555555555555)
        self.bits = (random & even | (~random & even) << np.uint64(1)).view(np.int64)

    def __call__(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The key of the walk from each character, and where it ends; beyond
        the last character a walk reads blanks."""
        n = len(points)
        padded = np.concatenate([points, np.zeros(self.plan.steps, np.uint32)])
        bit, symbol = self.bits[padded], padded.astype(np.uint64) + np.uint64(1)
        keys, ends = np.zeros(n, np.uint64), np.empty(n, np.int64)
        multiplier = np.uint64(0x9E3779B97F4A7C15)
        for lo in range(0, n, STRIDE):
            at = np.arange(lo, min(n, lo + STRIDE))
            key, move, seen = keys[lo : lo + STRIDE], np.empty(len(at), np.int64), np.empty(len(at), np.uint64)
            for t in range(self.plan.steps):
                if t in self.sampled:
                    key ^= symbol.take(at, out=seen, mode="clip")
                    key *= multiplier
                bit.take(at, out=move, mode="clip")
                move >>= t
                move &= 1
                at += move
            ends[lo : lo + STRIDE] = at
        keys ^= keys >> np.uint64(29)
        keys *= multiplier
        return keys, ends


def normalised(text: str | None) -> str:
    """Words of the lower-cased text joined by spaces."""
    return " ".join(WORD.findall(_simple_lower(text or "")))


def _simple_lower(text: str) -> str:
    """One code point for one, as the tables of the word hashes do it."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower()[0] if c.isalnum() else c for c in text)


def allowed(length: int, plan: Plan) -> int:
    """The most edits of an item of ``length`` characters."""
    return int((1 - plan.threshold) * length + 1e-9)


def normal_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all normalised texts, a space before and after every word,
    and where each text begins (one more at the end)."""
    points, offsets = code_points(texts)
    low = word_table()[points]
    inside = low != 0
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    before = np.zeros(len(low) + 1, np.int64)
    np.cumsum(kept, out=before[1:])
    low[~inside] = 32
    return np.append(np.uint32(32), low[kept]), before[offsets] + 1


@dataclass
class Lookup:
    """Sorted keys with the item and the offset of each, and a filter of 2**bits slots before them."""

    keys: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    bits: int
    seen: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, item: np.ndarray, offset: np.ndarray) -> Lookup:
        order, bits = np.argsort(keys, kind="stable"), min(26, max(18, int(16 * len(keys)).bit_length()))
        out = cls(keys[order], item[order], offset[order], bits, np.zeros(1 << bits, bool))
        out.seen[out.slot(keys)] = True
        return out

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def hits(self, keys: np.ndarray, overlap: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(item, place where it would begin) of equal keys, ``keys`` being those
        of all places, in runs of about ``HITS``; a run begins ``overlap`` places
        before the end of the last one."""
        at = np.flatnonzero(self.seen[self.slot(keys)])
        found = keys[at]
        left = np.searchsorted(self.keys, found, "left")
        some = self.keys[np.minimum(left, len(self.keys) - 1)] == found
        at, left, found = at[some], left[some], found[some]
        count = np.searchsorted(self.keys, found, "right") - left
        sums, lo = np.cumsum(count), 0
        while lo < len(at):
            done = sums[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(sums, done + HITS, "right")), int(np.searchsorted(at, at[lo] + 2 * overlap, "right")))
            c = count[lo:hi]
            j = np.repeat(left[lo:hi] - (np.cumsum(c) - c), c) + np.arange(c.sum())
            yield self.item[j], np.repeat(at[lo:hi], c) - self.offset[j]
            lo = len(at) if hi >= len(at) else max(lo + 1, int(np.searchsorted(at, at[hi] - overlap)))


class Pieces:
    """Exact strings of items, a ``Lookup`` for each length."""

    BASE: ClassVar[int] = 0xD6E8FEB86659FD93

    def __init__(self, rows: list[tuple[int, int, str]]) -> None:
        """From (item, offset, string)."""
        self.by_length: dict[int, Lookup] = {}
        for n in sorted({len(g) for _, _, g in rows}):
            own = [r for r in rows if len(r[2]) == n]
            points = np.frombuffer("".join(g for _, _, g in own).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)
            keys = np.zeros(len(own), np.uint64)
            for j in range(n):
                keys = self.longer(keys, points[:, j])
            self.by_length[n] = Lookup.build(keys, np.array([r[0] for r in own]), np.array([r[1] for r in own]))

    @classmethod
    def longer(cls, keys: np.ndarray, points: np.ndarray) -> np.ndarray:
        return (keys + points.astype(np.uint64) + np.uint64(1)) * np.uint64(cls.BASE)

    @classmethod
    def rolled(cls, letters: np.ndarray, n: int) -> np.ndarray:
        """Keys of all strings of ``n`` from those of single letters, by doubling."""
        keys, size = letters, 1
        for bit in bin(n)[3:]:
            keys = keys[: len(keys) - size] * np.uint64(pow(cls.BASE, size, 1 << 64)) + keys[size:]
            size *= 2
            if bit == "1":
                keys = keys[: len(keys) - 1] * np.uint64(cls.BASE) + letters[size:]
                size += 1
        return keys

    def hits(self, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        letters = self.longer(np.zeros(len(points), np.uint64), points)
        for n, known in self.by_length.items():
            if len(points) >= n:
                yield from known.hits(self.rolled(letters, n))


@dataclass
class ShortItems:
    """The items of a block that fit a machine word."""

    pieces: Pieces
    letters: np.ndarray
    #: Bits of an item where a letter stands: (items, letters + 1); the last column is of other letters.
    bits: np.ndarray
    length: np.ndarray
    edits: np.ndarray

    @classmethod
    def build(cls, texts: list[str], plan: Plan) -> ShortItems:
        rows = []
        for i, t in enumerate(texts):
            k = allowed(len(t), plan)
            if len(t) <= SHORT and not k:
                rows.append((i, -1, f" {t} "))
            elif len(t) <= SHORT:
                edges = [len(t) * j // (k + 1) for j in range(k + 2)]
                rows += [(i, a, t[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        letters = np.unique(np.array([ord(c) for t in texts if len(t) <= SHORT for c in t], np.uint32))
        bits = np.zeros((len(texts) if rows else 0, len(letters) + 1), np.uint64)
        for i, t in enumerate(texts):
            if len(t) <= SHORT:
                for j, c in enumerate(t):
                    bits[i, np.searchsorted(letters, ord(c))] |= np.uint64(1 << j)
        return cls(Pieces(rows), letters, bits, np.array([len(t) for t in texts], np.int64), np.array([allowed(len(t), plan) for t in texts], np.int64))

    def near(self, points: np.ndarray) -> np.ndarray:
        """(item, begin, end) of the stretches that hold an item within its edits: (n, 3)."""
        if not self.pieces.by_length:
            return np.zeros((0, 3), np.int64)
        letter = np.searchsorted(self.letters, points)
        letter[letter == len(self.letters)] = 0
        letter[self.letters[letter] != points] = len(self.letters)
        out = [np.zeros((0, 3), np.int64)]
        for item, begin in self.pieces.hits(points):
            width = self.edits[item] + 1
            code = np.unique((item << 40) | (begin // width + (1 << 30)))
            item = code >> 40
            lo = ((code & ((1 << 40) - 1)) - (1 << 30)) * (self.edits[item] + 1) - self.edits[item]
            hi = lo + self.length[item] + 3 * self.edits[item]
            for a in range(0, len(item), 1 << 15):
                i, x, y = item[a : a + (1 << 15)], lo[a : a + (1 << 15)], hi[a : a + (1 << 15)]
                good = self._least(letter, i, x, y) <= self.edits[i]
                out.append(np.stack([i[good], x[good], y[good]], 1))
        return np.concatenate(out)

    def _least(self, letter: np.ndarray, item: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """``edit_distance_within`` of many items and stretches at once."""
        one, length = np.uint64(1), self.length[item]
        top = (length - 1).astype(np.uint64)
        pv, mv = np.full(len(item), ~np.uint64(0)), np.zeros(len(item), np.uint64)
        score = length.copy()
        best = score.copy()
        for j in range(int((hi - lo).max(initial=0))):
            at = lo + j
            inside = (at >= 0) & (at < np.minimum(hi, len(letter)))
            eq = np.where(inside, self.bits[item, letter[np.clip(at, 0, len(letter) - 1)]], np.uint64(0))
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | ~(xh | pv)
            mh = pv & xh
            score += ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64)
            ph, mh = ph << one, mh << one
            pv, mv = mh | ~(xv | ph), ph & xv
            best = np.minimum(best, score)
        return best


@dataclass
class LongItems:
    """Keys of the walks of the items that do not fit a machine word."""

    known: Lookup | None
    length: np.ndarray
    edits: np.ndarray

    @classmethod
    def build(cls, texts: list[str], plan: Plan, walks: Walks) -> LongItems:
        keys, item, offset = [], [], []
        for i, t in enumerate(texts):
            if len(t) > SHORT:
                own, ends = walks(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32))
                inside = np.flatnonzero(ends <= len(t))
                keys.append(own[inside])
                item.append(np.full(len(inside), i))
                offset.append(inside)
        known = Lookup.build(*map(np.concatenate, (keys, item, offset))) if keys else None
        return cls(known, np.array([len(t) for t in texts], np.int64), np.array([allowed(len(t), plan) for t in texts], np.int64))

    def near(self, points: np.ndarray, plan: Plan, walks: Walks) -> np.ndarray:
        """(item, begin, end) of the stretches that may hold an item: (n, 3)."""
        out = [np.zeros((0, 3), np.int64)]
        if self.known is None:
            return out[0]
        need, base = plan.least_hits(self.length), 1 << 30
        for item, begin in self.known.hits(walks(points)[0], 2 * int(self.length.max())):
            code = np.sort((item << 40) | (begin + base))
            item = code >> 40
            # hits of an item on neighbouring diagonals, the first of each window
            ahead = np.minimum(np.arange(len(code)) + need[item] - 1, len(code) - 1)
            first = np.flatnonzero((code[ahead] - code <= self.edits[item]) & (np.arange(len(code)) + need[item] <= len(code)))
            if not len(first):
                continue
            band = np.flatnonzero(np.concatenate(([True], code[first][1:] > code[first][:-1] + self.edits[item[first]][:-1])))
            at, to = first[band], first[np.append(band[1:], len(first)) - 1]
            k, begin = self.edits[item[at]], (code & ((1 << 40) - 1)) - base
            out.append(np.stack([item[at], begin[at] - k, begin[to] + self.length[item[at]] + 2 * k], 1))
        return np.concatenate(out)


def edit_distance_within(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance between ``pattern`` and any substring of ``text``,
    and where the first such substring ends (bit-parallel, exact)."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = ((((eq & pv) + pv) ^ pv) | eq) & full
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = mh | (full & ~(xv | ph)), ph & xv
        if score < best:
            best, end = score, j
    return best, end


@dataclass
class ItemIndex:
    """A block of items, short and long ones apart."""

    ids: list
    texts: list[str]
    short: ShortItems
    long: LongItems

    @classmethod
    def build(cls, rows: list[tuple], plan: Plan) -> ItemIndex:
        kept = [(i, t) for i, t in ((r[0], normalised(r[1])) for r in rows) if t]
        texts = [t for _, t in kept]
        return cls([i for i, _ in kept], texts, ShortItems.build(texts, plan), LongItems.build(texts, plan, walks_of(plan)))


_walks: dict[Plan, Walks] = {}


def walks_of(plan: Plan) -> Walks:
    """The walks' random bits, made once a process."""
    if plan not in _walks:
        _walks[plan] = Walks(plan)
    return _walks[plan]


def contaminations(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", plan: Plan = Plan()) -> DataFrame:
    """A row per document and item that it holds: doc_id, item_id, distance
    (characters), similarity, and char_end in the normalised text."""
    small_batches(docs.sparkSession)
    out = None
    for index in item_indexes(items, item_text, item_key, plan):
        part = docs.select(as_id(key), F.col(text).cast("string")).mapInArrow(tidy(_searcher(docs, index, plan)), "doc_id long, item_id long, distance int, similarity double, char_end long")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.select(as_id(key).alias("doc_id")).filter(F.lit(False)).selectExpr("doc_id", "0L item_id", "0 distance", "0D similarity", "0L char_end")
    return out


def item_indexes(items: DataFrame, item_text: str, item_key: str, plan: Plan) -> Iterator[ItemIndex]:
    """Indexes of the items in blocks of bounded size, whatever their number."""
    rows = items.select(as_id(item_key), F.col(item_text).cast("string"))
    block: list[tuple] = []
    chars = 0
    for row in rows.toLocalIterator():
        if block and (len(block) == ITEM_BLOCK or chars + len(row[1] or "") > ITEM_CHARS):
            yield ItemIndex.build(block, plan)
            block, chars = [], 0
        block.append((row[0], row[1]))
        chars += len(row[1] or "")
    if block:
        yield ItemIndex.build(block, plan)


def verify_at(pattern: str, norm: str, lo: int, hi: int, plan: Plan) -> tuple[int, int] | None:
    """Distance and end of ``pattern`` between ``lo`` and ``hi`` of a text, if within the threshold."""
    lo, most = max(0, lo), allowed(len(pattern), plan)
    if not most:
        at = f" {norm} ".find(f" {pattern} ", lo)
        return (0, at + len(pattern)) if 0 <= at <= hi else None
    distance, end = edit_distance_within(pattern, norm[lo:hi])
    return (distance, lo + end) if distance <= most else None


def _matches(index: ItemIndex, texts: list[str], plan: Plan) -> dict[tuple[int, int], tuple[int, int]]:
    """Best match of each (text, item) of a block of texts."""
    found: dict[tuple[int, int], tuple[int, int]] = {}
    points, start = normal_points(texts)
    places = []
    for item, lo, hi in np.concatenate([index.short.near(points), index.long.near(points, plan, walks_of(plan))]).tolist():
        # a stretch may reach over the end of a text: each text that it touches is looked at
        for i in range(max(0, int(np.searchsorted(start, lo, "right")) - 1), min(len(texts), int(np.searchsorted(start, hi, "left")))):
            if hi > int(start[i]):
                places.append((i, item, lo - int(start[i]), hi - int(start[i])))
    at, norm = -1, ""
    for i, item, a, b in sorted(places):
        if found.get((i, item), (1,))[0] == 0:
            continue
        if i != at:
            at, norm = i, normalised(texts[i])
        got = verify_at(index.texts[item], norm, a, b, plan)
        if got and ((i, item) not in found or got < found[i, item]):
            found[i, item] = got
    return found


def _searcher(docs: DataFrame, index: ItemIndex, plan: Plan):
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            names = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for start, texts in blocks(batch.column(1).to_pylist()):
                for (i, item), (distance, end) in _matches(items, texts, plan).items():
                    rows.append((names[start + i], items.ids[item], distance, 1 - distance / len(items.texts[item]), end))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "item_id", "distance", "similarity", "char_end"])

    return run


def _cleaner(docs: DataFrame, index: ItemIndex, plan: Plan):
    """A column function: whether a text holds no item of the index."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for series in batches:
                good = np.ones(len(series), bool)
                for start, texts in blocks(series.where(series.notna(), None).tolist()):
                    for i, _ in _matches(shared.value, texts, plan):
                        good[start + i] = False
                yield pd.Series(good)
        finally:
            release()

    return clean


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_key: str = "item_id", plan: Plan = Plan()) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns unchanged."""
    small_batches(docs.sparkSession)
    for index in item_indexes(items, item_text, item_key, plan):
        at = fresh(docs, "is_clean")
        docs = docs.withColumn(at, _cleaner(docs, index, plan)(F.col(text))).filter(F.col(at)).drop(at)
    return docs
