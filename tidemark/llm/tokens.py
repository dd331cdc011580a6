"""Words of whole texts as 64-bit hashes, for many texts at a time, inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time; one longer text is a piece of its own.
PIECE = 1 << 20
_ONE = np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise a 64-bit hash (multiply and shift, twice)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = _BYTE[_LOWER]  # A-Z hash as a-z
_BASE = 0x9DDFEA08EB382D69
_SPACE = np.ones(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = False
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
#: Bytes of words: all but ASCII white space; or ASCII letters, digits and everything beyond ASCII.
KINDS = {"space": _SPACE, "alnum": _ALNUM}


class Words:
    """Words of some texts in order: ``hash``; ``start``, ``end`` bytes in ``data``; ``first[k]:first[k+1]`` are text k's."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, kind: str):
        keep = KINDS[kind][data]
        n = len(data)
        begin = keep.copy()
        begin[1:] &= ~keep[:-1]
        inner = bounds[(bounds > 0) & (bounds < n)]
        begin[inner] = keep[inner]
        last = keep.copy()
        last[:-1] &= ~keep[1:]
        last[inner - 1] = keep[inner - 1]
        self.data, self.bounds = data, bounds
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, bounds)
        if not len(self.start):
            self.hash = np.empty(0, np.uint64)
            return
        size = self.end - self.start
        place = np.arange(n, dtype=np.int64)
        place -= np.repeat(self.start, np.diff(np.append(self.start, n))) if self.start[0] == 0 else np.concatenate(
            [np.zeros(self.start[0], np.int64), np.repeat(self.start, np.diff(np.append(self.start, n)))]
        )
        place[~keep] = 0
        powers = np.full(int(size.max()) + 1, _BASE, np.uint64)
        powers[0] = _ONE
        powers = np.multiply.accumulate(powers)
        values = _BYTE[data] * powers[np.where(keep, place, 0)]
        values[~keep] = 0
        self.hash = mix(np.add.reduceat(values, self.start) + size.astype(np.uint64))

    def text(self, k: int) -> str:
        return self.data[self.start[k] : self.end[k]].tobytes().decode("utf-8", "replace")


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, bounds) of some texts each; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if len(texts) and texts.buffers()[2] else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        yield at, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


def hash_words(words: list[str]) -> list[int]:
    """The hashes that :class:`Words` gives to these words."""
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    found = Words(data, np.array([0, len(data)]), "space")
    if len(found.hash) != len(words):
        raise ValueError("a word is empty or holds white space")
    return [int(h) for h in found.hash]
