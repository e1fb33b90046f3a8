"""Benchmark passages in documents, by seeds, edits of pieces, and exact edit distance.

An item with at most 20 % edits keeps runs of characters unchanged. In documents every character starts a
window, so words, their lengths and scripts do not matter.

- An item of fewer than 100 characters is cut into pieces of up to 32, which share its edits: if the item is
  held, some piece is within its own share, and of the piece's parts, one more than its edits, one is
  unchanged. These parts are the seeds, so no such item is missed.
- In a longer item any 8 characters are a seed. So are 5 and 5 characters around one edit, and 4, 4 and 4 around
  two, which edits leave that are spread so evenly that no 8 characters stay (every 5th to 8th). An edit may be a
  replaced, a missing or an added character. These seeds are numerous, so both sides use only those that a hash
  of their first 4 characters chooses, one in 4. Of the item's pieces, those around a seed may have 30 % edits.

Pieces around seeds are compared with the text for all seeds of a block at once (Myers' bit vectors); where one
is near, the whole item is verified by exact edit distance.

The items' seeds are sent to the tasks. The benchmark is taken in blocks of a bounded size, one pass over
the documents for each block, so their size is bounded whatever the benchmark's. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewick.llm.common import rows_with
from tidewick.llm.textblock import blocks

#: Part of an item's characters that may be edited.
EDITS = 0.2
#: Windows of items: characters of a piece, and of an item from which on any run of SEED characters is a seed.
PIECE, LONG, SEED = 32, 100, 8
#: Characters of each unchanged run of a seed around edits, and how many edits it spans.
SPLIT_SEEDS = ((5, 1), (4, 2))
#: Of these seeds those are used whose first characters hash to the first of so many classes.
CLASSES = 4
#: Part of a piece of a long item that may be edited: edits are not spread evenly over an item.
PIECE_EDITS = 0.3
#: Bits of a character that seeds and pieces compare; what differs in others only is told apart by the last check.
BITS = 7
#: Candidates compared at once.
AT_ONCE = 1 << 13
#: Matches of seeds taken together, about.
MATCHES = 1 << 20
#: Places of an alignment that are looked at together.
BAND = 8
#: Bytes of items that one pass looks for.
ITEM_BYTES = 1 << 20


def _normal(text: bytes | None) -> bytes:
    return b" ".join((text or b"").lower().split())


def _symbols(text: str) -> np.ndarray:
    return (np.frombuffer(text.encode("utf-32-le"), np.uint32) & ((1 << BITS) - 1)).astype(np.uint8)


def _grams(symbols: np.ndarray) -> np.ndarray:
    """The SEED symbols from each place on as one number, the first in the lowest bits."""
    grams, width = np.concatenate((symbols, np.zeros(SEED - 1, np.uint8))).astype(np.uint64), 1
    while width < SEED:
        grams, width = grams[:-width] | (grams[width:] << np.uint64(BITS * width)), 2 * width
    return grams


def _part(grams: np.ndarray, size: int) -> np.ndarray:
    return grams & np.uint64((1 << BITS * size) - 1)


def _slot(grams: np.ndarray, bits: int) -> np.ndarray:
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).view(np.int64)


def _chosen(grams: np.ndarray) -> np.ndarray:
    """Places whose first characters choose them for seeds around edits."""
    first = _part(grams, min(run for run, _ in SPLIT_SEEDS))
    first *= np.uint64(0x9E3779B97F4A7C15)
    return np.flatnonzero(first < np.uint64((1 << 64) // CLASSES))


def _around_edits(grams: np.ndarray, at: np.ndarray, run: int, steps: tuple[int, ...]) -> np.ndarray:
    """One number for the runs of characters that begin at the places and after each of the steps."""
    key = _part(grams.take(at), run)
    for step in steps:
        at = at + step
        key = key * np.uint64(0xD6E8FEB86659FD93) + _part(grams.take(at, mode="clip"), run)
    return key


def _edited_steps(run: int, edits: int) -> Iterator[tuple[tuple[int, ...], tuple[int, ...]]]:
    """(steps in the item, steps in a text) from run to run: characters replaced, missing or added."""
    for each in product(((run + 1, run + 1), (run + 1, run), (run, run + 1)), repeat=edits):
        yield tuple(i for i, _ in each), tuple(t for _, t in each)


class Seeds:
    """Seeds of a block of items, and the pieces of items around them."""

    def __init__(self, texts: list[str]):
        self.size, self.most, self.item, self.offset, peq = [], [], [], [], []
        found: dict[tuple[int, tuple[int, ...]], list[np.ndarray]] = {}
        for i, text in enumerate(texts):
            n, symbols = len(text), _symbols(text)
            if n == 0:
                continue
            grams, first, k = _grams(symbols), len(self.size), int(EDITS * n)
            if n < LONG:
                parts = -(-n // PIECE)
                cut = [n * x // parts for x in range(parts + 1)]
                pieces = [(a, b, k * (b - a) // n) for a, b in zip(cut, cut[1:])]
            else:
                pieces = [(min(a, n - PIECE), min(a, n - PIECE) + PIECE, int(PIECE_EDITS * PIECE))
                          for a in range(0, n, PIECE // 2) if a < n - PIECE // 2]
            for a, b, e in pieces:
                # A piece has the highest bits; those below it match everything, at no edits.
                row = np.full(1 << BITS, (1 << PIECE - (b - a)) - 1, np.uint32)
                np.bitwise_or.at(row, symbols[a:b], np.uint32(1) << np.arange(PIECE - (b - a), PIECE, dtype=np.uint32))
                peq.append(row)
                self.size.append(b - a), self.most.append(e), self.item.append(i), self.offset.append(a)
            if n < LONG:
                for p, (a, b, e) in enumerate(pieces, first):
                    cut = [a + (b - a) * x // (e + 1) for x in range(e + 2)]
                    for x, y in zip(cut, cut[1:]):
                        size = min(SEED, y - x)
                        found.setdefault((size, ()), []).append(np.array([[int(_part(grams[x:x + 1], size)[0]), p, x - a]], np.int64))
            else:
                begin = np.array([a for a, _, _ in pieces])

                def add(kind: tuple[int, tuple[int, ...]], x: np.ndarray, keys: np.ndarray, span: int) -> None:
                    p = np.minimum(np.maximum(0, x + span // 2 - PIECE // 4) // (PIECE // 2), len(pieces) - 1)
                    found.setdefault(kind, []).append(np.stack([keys.view(np.int64), first + p, x - begin[p]], axis=1))

                x = np.arange(n - SEED + 1)
                add((SEED, ()), x, grams[x], SEED)
                chosen = _chosen(grams)
                for run, edits in SPLIT_SEEDS:
                    for own, steps in _edited_steps(run, edits):
                        x = chosen[chosen <= n - sum(own) - run]
                        add((run, steps), x, _around_edits(grams, x, run, own), sum(own) + run)
        self.size, self.most, self.item, self.offset = (
            np.array(x, np.int64) for x in (self.size, self.most, self.item, self.offset))
        self.peq = np.stack(peq) if peq else np.zeros((0, 1 << BITS), np.uint32)
        #: (size of a seed or its runs, steps between these) -> (bits of a hash, which hashes occur, keys in order, first row of each, pieces, places in them)
        self.tables = {}
        for kind, rows in found.items():
            table = np.concatenate(rows)
            table = table[np.argsort(table[:, 0].view(np.uint64), kind="stable")]
            keys, first = np.unique(table[:, 0].view(np.uint64), return_index=True)
            # Few places pass by chance, as a search among the keys costs most; many keys share a smaller table each.
            bits = max(16, (16 * len(keys)).bit_length(), min(22, (64 * len(keys)).bit_length()))
            maybe = np.zeros(1 << bits, bool)
            maybe[_slot(keys, bits)] = True
            self.tables[kind] = bits, maybe, keys, np.append(first, len(table)), table[:, 1], table[:, 2]

    def hits(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, piece, where it should begin) of the pieces whose edits around a seed are few enough.

        ``starts`` has the first character of each text.
        """
        n = len(symbols)
        grams, out = _grams(symbols), [(np.zeros(0, np.int64),) * 3]
        chosen = _chosen(grams) if any(steps for _, steps in self.tables) else None
        for (size, steps), (bits, maybe, keys, first, pieces, places) in self.tables.items():
            gram = _around_edits(grams, chosen, size, steps) if steps else _part(grams, size)
            at = np.flatnonzero(maybe.take(_slot(gram, bits)))
            gram = gram[at]
            key = np.searchsorted(keys, gram)
            same = keys.take(key, mode="clip") == gram
            at, key = at[same], key[same]
            if steps:
                at = chosen[at]
            many = first[key + 1] - first[key]
            total = np.cumsum(many)
            cut = np.flatnonzero(np.diff(total // MATCHES)) + 1
            for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(at)]):
                n = many[lo:hi]
                row = np.repeat(first[key[lo:hi]] - np.cumsum(n) + n, n) + np.arange(n.sum())
                place = np.repeat(at[lo:hi], n)
                out += self._checked(symbols, np.searchsorted(starts, place, "right") - 1, pieces[row], place - places[row])
        return tuple(np.concatenate(x) for x in zip(*out))

    def _checked(self, symbols: np.ndarray, doc: np.ndarray, piece: np.ndarray, begin: np.ndarray
                 ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        # Neighbouring seeds of one alignment are looked at once, with a slack of a band's width.
        _, first = np.unique((piece << 44) + ((doc & 255) << 36) + (begin + PIECE) // BAND, return_index=True)
        doc, piece, begin = doc[first], piece[first], begin[first]
        order = np.argsort((self.size[piece] + 2 * self.most[piece]).astype(np.int16), kind="stable")
        for x in range(0, len(order), AT_ONCE):
            part = order[x:x + AT_ONCE]
            part = part[self._near(symbols, piece[part], begin[part])]
            yield doc[part], piece[part], begin[part]

    def _near(self, symbols: np.ndarray, piece: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Whether some part of the text around ``begin`` is within the edits of the piece (Myers' bit vectors)."""
        size, most = self.size[piece], self.most[piece]
        steps = int((size + 2 * most).max()) + BAND
        at = begin // BAND * BAND - most
        # All steps write into the same arrays; signs of 32-bit numbers are the last row's changes.
        pv = ((np.int64(1) << PIECE) - (np.int64(1) << PIECE - size)).astype(np.uint32)
        mv, eq, d, hp, hn = (np.zeros(len(piece), np.uint32) for _ in range(5))
        score, change = size.astype(np.int32), np.zeros(len(piece), np.int32)
        best = score.copy()
        peq, row, symbol, entry = self.peq.ravel(), piece << BITS, np.zeros(len(piece), np.uint8), np.zeros(len(piece), np.int64)
        for _ in range(steps):
            symbols.take(at, mode="clip", out=symbol)
            at += 1
            np.add(row, symbol, out=entry)
            peq.take(entry, mode="clip", out=eq)
            eq |= mv
            np.bitwise_and(eq, pv, out=d)
            d += pv
            d ^= pv
            d |= eq
            np.bitwise_and(pv, d, out=hn)
            np.bitwise_or(pv, d, out=hp)
            np.invert(hp, out=hp)
            hp |= mv
            np.right_shift(hp.view(np.int32), 31, out=change)
            score -= change
            np.right_shift(hn.view(np.int32), 31, out=change)
            score += change
            np.minimum(best, score, out=best)
            hp <<= 1
            hn <<= 1
            np.bitwise_and(hp, d, out=mv)
            np.bitwise_or(hp, d, out=pv)
            np.invert(pv, out=pv)
            pv |= hn
        return best <= most


class Items:
    """A block of items, ready for look-up."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.ids, self.texts = [i for i, _ in items], [_normal(t).decode() for _, t in items]
        self.seeds = Seeds(self.texts)

    def candidates(self, texts: list[str]) -> set[tuple[int, int, int]]:
        """(number of the text, item, character of the text at which the item should start), give or take the edits."""
        first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        doc, piece, begin = self.seeds.hits(_symbols("\n".join(texts) + "\n"), first[:-1])
        begin = begin - first[doc] - self.seeds.offset[piece]
        return set(zip(doc.tolist(), self.seeds.item[piece].tolist(), begin.tolist()))


def edit_distance_in(item: str, text: str, most: int) -> tuple[int, int]:
    """(least edits that turn the item into some part of the text, end of that part); most + 1 if more."""
    if (p := text.find(item)) >= 0:
        return 0, p + len(item)
    where: dict[str, int] = {}
    for n, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << n
    mask, top = (1 << len(item)) - 1, 1 << len(item) - 1
    pv, mv = mask, 0
    score = best = len(item)
    end = 0
    for n, c in enumerate(text, 1):  # Myers' bit vectors, as long as the item
        x = where.get(c, 0) | mv
        d = ((((x & pv) + pv) ^ pv) | x) & mask
        hn, hp = pv & d, mv | (mask & ~(pv | d))
        score += (hp & top > 0) - (hn & top > 0)
        if score < best:
            best, end = score, n
        hp = hp << 1 & mask
        mv = hp & d
        pv = hn << 1 & mask | mask & ~(hp | d)
    return (best, end) if best <= most else (most + 1, 0)


def _verified(items: Items, texts: list[str], found: set[tuple[int, int, int]]) -> dict[tuple[int, int], int]:
    """(text, item) -> least edits, of the candidates that hold the item."""
    best: dict[tuple[int, int], int] = {}
    last = None
    for d, i, begin in [*sorted(found), (-1, -1, 0)]:
        if last is not None and (last[0], last[1]) == (d, i) and begin - slack <= hi:
            hi = begin + size + slack
            continue
        if last is not None:
            edits, _ = edit_distance_in(items.texts[last[1]], texts[last[0]][lo:hi], most)
            if edits <= most:
                best[last[:2]] = min(edits, best.get(last[:2], edits))
        if d < 0:
            break
        last, size = (d, i), len(items.texts[i])
        most = int(EDITS * size)
        slack = most + BAND
        lo, hi = max(0, begin - slack), begin + size + slack
    return best


def _blocks_of_items(benchmark: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    part, size = [], 0
    rows = benchmark.select("item_id", "text").filter("text IS NOT NULL").orderBy("item_id", "text")
    for r in rows.toLocalIterator():
        part.append((r["item_id"], r["text"].encode()))
        size += len(part[-1][1])
        if size >= ITEM_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, _row, item_id, edits, similarity) for every document and item that it holds nearly.

    An item is held if some part of the document is within 20 % of the item's characters in edits, white
    space runs and the case of ASCII letters aside; the least number of edits of all places counts. An item of
    fewer than 5 characters must occur unchanged.
    ``_row`` is a hash of (doc_id, text), so that rows without a doc_id can be told apart. Empty or null items
    and texts match nothing. Repeated rows and items give repeated results. No benchmark gives no rows; other columns are ignored.
    """
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (benchmark, "item_id"))]
    schema = f"doc_id {kinds[0]}, _row long, item_id {kinds[1]}, edits int, similarity double"
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_row"), "text")
    out = rows.select("doc_id", "_row", F.lit(None).cast(kinds[1]).alias("item_id"), F.lit(0).alias("edits"),
                      F.lit(0.0).alias("similarity")).limit(0)
    for part in _blocks_of_items(benchmark):
        out = out.union(rows.mapInArrow(_finder(part), schema))
    return out


def _finder(part: list[tuple[int, bytes]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(part)
        for batch, block in blocks(batches):
            texts = [_normal(t).decode() for t in block.texts]
            best = _verified(items, texts, items.candidates(texts))
            rows = pa.array([d for d, _ in best], pa.int64())
            yield pa.record_batch(
                [batch.column("doc_id").take(rows), batch.column("_row").take(rows),
                 pa.array([items.ids[i] for _, i in best], pa.int64()), pa.array(list(best.values()), pa.int32()),
                 pa.array([1.0 - e / len(items.texts[i]) for (_, i), e in best.items()], pa.float64())],
                ["doc_id", "_row", "item_id", "edits", "similarity"])
    return run


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold an item of the benchmark nearly."""
    bad = leaks(docs, benchmark).select("_row").distinct()
    return rows_with(docs, bad, "left_anti", F.xxhash64("doc_id", "text")).select("_whole.*")
