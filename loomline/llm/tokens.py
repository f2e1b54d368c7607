"""Exact tokenisation of blocks of texts with a memory of known words.

A text is cut at ASCII white space and between a letter and a following ASCII
character that is no letter.  No token of the word tokenizer crosses these
cuts, so the ids of a text are the ids of its pieces.  Pieces are hashed with
numpy and looked up in sorted arrays; only pieces not met before go through
the tokenizer.  Texts that hold a special token's string take the plain path,
and so do all texts where the tokenizer file is another one.
"""

from __future__ import annotations

import json
import os

import numpy as np

from ._common import blocks, code_points, runs, span_hashes

#: Pieces that a worker remembers: some 40 MB.  Beyond it the memory starts anew.
MEMORY = 1_500_000


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _classes() -> np.ndarray:
    """By code point: 0 white space, 1 ASCII but no letter, 2 letter, 3 other."""
    out = np.full(0x110000, 3, np.uint8)
    for c in range(0x3000):
        if chr(c).isalpha():
            out[c] = 2
        elif c < 128:
            out[c] = 1
    out[[9, 10, 11, 12, 13, 32]] = 0
    return out


#: Normaliser and pre-tokenizer under which no token crosses the cuts (fixed values of the word tokenizer's file).
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def _known_cuts(tokenizer) -> bool:
    """Whether texts may be cut into pieces, and pieces lower-cased: only where
    the normaliser and the pre-tokenizer are known to allow it."""
    spec = json.loads(tokenizer.to_str())
    return spec["normalizer"] == _NORMALIZER and spec["pre_tokenizer"] == _PRE_TOKENIZER


class WordTokenizer:
    """``encode(texts)`` gives all ids as one array and the offsets of the texts.

    ``specials_as_text``: strings of special tokens in a text are ordinary text.
    A null text has no ids.
    """

    def __init__(self, path: str, specials_as_text: bool = False, memory: int = MEMORY) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = specials_as_text
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.specials_as_text = specials_as_text
        self.cuts = _known_cuts(self.tokenizer)
        self.classes = _classes()
        self.lower = np.arange(0x110000, dtype=np.uint32)
        self.lower[65:91] += 32
        self.memory = memory
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.flat = np.zeros(0, np.uint32)

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        if len(self.keys) + len(keys) > self.memory:
            self._forget()
        ids: list[np.ndarray] = []
        for i in range(0, len(pieces), 10_000):
            ids += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(pieces[i : i + 10_000], add_special_tokens=False)]
        count = np.fromiter(map(len, ids), np.int32, len(ids))
        first = len(self.flat) + np.cumsum(count) - count
        at = np.searchsorted(self.keys, keys)
        self.keys, self.first, self.count = np.insert(self.keys, at, keys), np.insert(self.first, at, first), np.insert(self.count, at, count)
        self.flat = np.concatenate([self.flat, *ids])

    def _known(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, at, -1) if len(self.keys) else np.full(len(keys), -1)

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points, offsets = code_points(texts)
        kind = self.classes[points]
        starts, ends = runs(kind != 0)
        cut = np.flatnonzero((kind[:-1] == 2) & (kind[1:] == 1)) + 1
        if len(cut):
            starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        keys = span_hashes(self.lower[points], starts, ends)
        unique, example, inverse = np.unique(keys, return_index=True, return_inverse=True)
        at = self._known(unique)
        new = np.flatnonzero(at < 0)
        if len(new):
            if len(self.keys) + len(new) > self.memory:
                self._forget()
                new = np.arange(len(unique))
            s, e = starts[example[new]], ends[example[new]]
            raw = points.tobytes()
            self._learn(unique[new], [raw[4 * a : 4 * b].decode("utf-32-le", "surrogatepass") for a, b in zip(s.tolist(), e.tolist(), strict=True)])
            at = self._known(unique)
        at = at[inverse]
        count = self.count[at].astype(np.int64)
        ends_out = np.cumsum(count)
        position = np.arange(ends_out[-1] if len(count) else 0) + np.repeat(self.first[at] - (ends_out - count), count)
        bounds = np.concatenate([[0], ends_out])[np.searchsorted(starts, offsets)]
        return self.flat[position], bounds

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, as arrays of unsigned 32-bit integers."""
        out: list[np.ndarray] = []
        for _, run in blocks(texts):
            if not self.cuts:
                out += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(run, add_special_tokens=False)]
                continue
            odd = set() if self.specials_as_text else {i for i, t in enumerate(run) if "<|" in t and any(s in t for s in self.specials)}
            ids, bounds = self._block(["" if i in odd else t for i, t in enumerate(run)])
            out += [self.plain(run[i]) if i in odd else ids[bounds[i] : bounds[i + 1]] for i in range(len(run))]
        return out


_loaded: dict[tuple, WordTokenizer] = {}


def tokenizer(path: str, specials_as_text: bool = False) -> WordTokenizer:
    """One tokenizer for each worker process."""
    key = (path, specials_as_text)
    if key not in _loaded:
        _loaded[key] = WordTokenizer(path, specials_as_text)
    return _loaded[key]
