"""Vectorised words and rolling hashes over a block of texts; runs inside Spark tasks.

A block holds about one megabyte of UTF-8 text (or one longer document), so memory per task does not
depend on the size of a partition. Words are the runs of bytes other than 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.default_rng(20240229)
_LETTER = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64."""
    out = _POWERS.get(base)
    if out is None or len(out) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        out, k = np.ones(size, np.uint64), 1
        while k < size:
            out[k:2 * k] = out[:k] * np.uint64(pow(base, k, 1 << 64))
            k *= 2
        if size <= 1 << 23:
            _POWERS[base] = out
    return out[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits of the value."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _prefix(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def _between(prefix: np.ndarray, base: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    back = powers(pow(base, -1, 1 << 64), len(prefix))
    return mixed((prefix[hi] - prefix[lo]) * back[lo])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i : i + width]) for every full window."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


class Block:
    """Texts laid end to end, each closed by a newline byte."""

    def __init__(self, texts: list[bytes | None]):
        self.texts = [t or b"" for t in texts]
        self.data = b"\n".join(self.texts) + b"\n"
        self.bytes = np.frombuffer(self.data, np.uint8)
        self.sizes = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        self.begin = np.concatenate(([0], np.cumsum(self.sizes + 1)))[:-1]
        self._byte_prefix = None

    def __len__(self) -> int:
        return len(self.texts)

    def split(self) -> None:
        """Sets start, end and doc of every word, and first[i] : first[i + 1], the words of text i."""
        inside = np.zeros(len(self.bytes) + 1, np.int8)
        inside[1:] = ~SPACE[self.bytes]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edges[0::2], edges[1::2]
        self.first = np.append(np.searchsorted(self.start, self.begin), len(self.start))
        self.n_words = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self)), self.n_words)

    def byte_hashes(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes of the byte runs [lo, hi)."""
        if self._byte_prefix is None:
            self._byte_prefix = _prefix(_LETTER[self.bytes], _BYTE_BASE)
        return _between(self._byte_prefix, _BYTE_BASE, lo, hi)

    def word_hashes(self) -> np.ndarray:
        return self.byte_hashes(self.start, self.end)

    def shingles(self, hashes: np.ndarray, k: int) -> np.ndarray:
        """Hash of the k words from each word on; the last k - 1 words have none."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        at = np.arange(n)
        return _between(_prefix(hashes, _WORD_BASE), _WORD_BASE, at, at + k)

    def joined(self, i: int) -> tuple[bytes, np.ndarray]:
        """The words of text i joined by one space, and where each begins (one more entry: the end + 1)."""
        lo, hi = self.first[i], self.first[i + 1]
        data = b" ".join(self.texts[i].split())
        at = np.zeros(hi - lo + 1, np.int64)
        np.cumsum(self.end[lo:hi] - self.start[lo:hi] + 1, out=at[1:])
        return data, at


def anchors(block: Block, k: int, window: int) -> np.ndarray:
    """Numbers of the words at which a selected k-word shingle starts (a window minimiser).

    Every run of ``window`` words inside one text has at least one selected shingle, and which of its
    shingles are selected for that run depends on the run's words alone.
    """
    grams = block.shingles(block.word_hashes(), k)
    return selected(grams, block.first, k, window)


def selected(grams: np.ndarray, first: np.ndarray, k: int, window: int,
             end: np.ndarray | None = None) -> np.ndarray:
    """Positions whose gram is the least of some window; windows lie inside [first[i], first[i + 1]).

    ``end`` gives other ends than first[i + 1].
    """
    width, n = window - k + 1, len(grams)
    if n < width:
        return np.zeros(0, np.int64)
    least = sliding_min(grams, width)
    inside = np.zeros(len(least) + 1, np.int64)
    for lo, hi in zip(first[:-1], first[1:] if end is None else end):
        if hi - lo >= window:
            inside[lo] += 1
            inside[hi - window + 1] -= 1
    least = np.where(np.cumsum(inside)[:-1] > 0, least, np.uint64(0))
    # The largest of the minima of the windows over a position equals its gram if it was selected.
    pad = np.zeros(width - 1, np.uint64)
    top = ~sliding_min(~np.concatenate((pad, least, pad)), width)
    return np.flatnonzero((top == grams) & (top != 0))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """The batches cut so that each part holds about ``limit`` bytes of text."""
    for batch in batches:
        texts = batch.column(column).cast(pa.binary()).to_pylist()
        lo, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t or b"") + 1
            if size >= limit or i == len(texts) - 1:
                yield batch.slice(lo, i + 1 - lo), Block(texts[lo:i + 1])
                lo, size = i + 1, 0


def stretches(at: np.ndarray, values: np.ndarray, allowed: np.ndarray, width: int
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of allowed window starts that have the same owner.

    A window owns the ``width`` positions from its start on; its owner is the position of ``at`` with the
    least value among them, and of equal ones the leftmost. Returns (index into ``at``, first start,
    last start) of each run, in order of place.
    """
    none = np.zeros(0, np.int64)
    field = np.full(len(allowed) + width - 1, np.iinfo(np.uint64).max, np.uint64)
    field[at] = values
    if len(at) == 0 or len(field) < width:
        return none, none, none
    least = sliding_min(field, width)
    starts = np.flatnonzero(allowed & (least != field.dtype.type(np.iinfo(np.uint64).max)))
    if len(starts) == 0:
        return none, none, none
    distinct, rank = np.unique(values, return_inverse=True)
    place = (rank.astype(np.int64) << 32) | at
    order = np.argsort(place)
    ask = (np.searchsorted(distinct, least[starts]).astype(np.int64) << 32) | starts
    owner = order[np.searchsorted(place[order], ask)]
    new = np.flatnonzero((owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    first, last = np.append(0, new), np.append(new, len(starts)) - 1
    return owner[first], starts[first], starts[last]


def lists(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    """A list column as one array per row."""
    column = batch.column(name)
    values, cut = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(cut[:-1], cut[1:])]
