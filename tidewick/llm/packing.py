"""Token sequences of a fixed length, packed by bin completion.

Texts become token ids, over-long ones are cut into pieces of ``capacity`` tokens, and the pieces are
packed in groups of a bounded size, in parallel. A group starts from the best-fit solution as incumbent
and looks for fewer sequences by branch and bound: the largest piece left is completed by fillings that
no other filling dominates, exact ones first, and a branch ends once its waste exceeds what an
improvement on the incumbent may waste. Sequences that are full stay; the pieces of the others meet
those of other groups in the next round, until one group holds what is left. So the loss does not grow
with the number of groups.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewick.llm.common import kept

#: Pieces that one group packs; a group is one task's work.
GROUP = 8192
#: Branches a group may open beyond one for each sequence.
BRANCHES = 2000
#: Words whose ids a worker remembers.
REMEMBERED = 1 << 18
_CODERS: dict[str, Coder] = {}

#: Pre-tokenizers that keep runs of letters, single digits and runs of other signs apart, and drop space.
_WORDWISE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Words for which the rule above can be written without character properties.
_PLAIN = re.compile("[!-~\u00c0-\u00ff]+\\Z")
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PARTS = re.compile(f"'(?:re|ve|ll|[stmd])|[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+")


def _byte_letters() -> list[str]:
    """The characters that stand for bytes in byte-level models: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


class Coder:
    """Texts to ids; a tokenizer that never joins across white space is asked once for each word part."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(Path(path).read_text())
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.wordwise = bool(steps) and steps[0].get("pattern") == {"Regex": _WORDWISE} and \
            [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def texts(self, texts: list[bytes | None], end: int) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers, closed by ``end``."""
        close = np.array([end], "<u4").tobytes()
        if not self.wordwise:
            coded = self.tokenizer.encode_batch_fast([(t or b"").decode() for t in texts], add_special_tokens=False)
            return [np.array(e.ids, "<u4").tobytes() + close for e in coded]
        known, out = self.known, []
        if len(known) > REMEMBERED:
            known.clear()
        if len(self.parts) > REMEMBERED:
            self.parts.clear()
        for text in texts:
            words = (text or b"").split()
            for w in words:
                if w not in known:
                    known[w] = self.word(w)
            out.append(b"".join([known[w] for w in words]) + close)
        return out

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        if not _PLAIN.match(text) or "<|" in text:  # may hold signs that change in context, or a special token
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join([self.parts.get(p) or self.part(p) for p in _PARTS.findall(text.lower())])

    def part(self, part: str) -> bytes:
        spelled = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(spelled)])
        self.parts[part] = ids
        return ids


def token_bytes(texts: list[bytes | None], path: str, end: int) -> list[bytes]:
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path].texts(texts, end)


def _pieces(path: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                rows, piece, start, length, crc = [], [], [], [], []
                ids = token_bytes(batch.column("text").cast(pa.binary()).to_pylist(), path, end)
                for i, data in enumerate(ids):
                    for n, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at:at + 4 * capacity]
                        rows.append(i)
                        piece.append(n)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                yield pa.record_batch(
                    [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                     *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


class Pack:
    """Lengths left and the sequences made of them; lengths are at most ``capacity``."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.capacity = capacity
        self.count = np.bincount(lengths, minlength=capacity + 1)
        self.total = int(lengths.sum())
        self.bound = max(-(-self.total // capacity), int((lengths > capacity // 2).sum()))

    def best_fit(self) -> list[list[int]]:
        """Largest piece first, each into the fullest sequence that has room."""
        rooms: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        open_rooms = np.zeros(self.capacity + 1, bool)
        out: list[list[int]] = []
        for length in np.flatnonzero(self.count)[::-1].tolist():
            for _ in range(int(self.count[length])):
                at = length + int(np.argmax(open_rooms[length:]))
                if open_rooms[at]:
                    b = rooms[at].pop()
                    open_rooms[at] = bool(rooms[at])
                else:
                    b, at = len(out), self.capacity
                    out.append([])
                out[b].append(length)
                if left := at - length:
                    rooms[left].append(b)
                    open_rooms[left] = True
        return out

    def fillings(self, gap: int, most: int) -> Iterator[list[int]]:
        """Undominated fillings of ``gap`` from the lengths left that waste at most ``most``, best first.

        A single piece that fits exactly dominates everything else; otherwise few large pieces come
        before many small ones, because small ones still fit elsewhere.
        """
        count = self.count
        if gap == 0 or count[gap]:
            yield [gap] if gap else []
            return
        have = count[:gap + 1] > 0
        lengths = np.flatnonzero(have)[::-1]
        if len(lengths) == 0:
            if gap <= most:
                yield []
            return
        shown = 0
        for chosen in self._exact(gap, lengths, have):
            shown += 1
            yield chosen
            if shown == 4:
                break
        seen = set()
        for first in lengths[:4].tolist():  # the fullest that start with each of the largest pieces
            chosen, rest, used = [first], gap - first, {first: 1}
            while rest:
                fit = np.flatnonzero(count[:rest + 1] > 0)[::-1]
                nxt = next((x for x in fit.tolist() if count[x] > used.get(x, 0)), 0)
                if not nxt:
                    break
                chosen.append(nxt)
                used[nxt] = used.get(nxt, 0) + 1
                rest -= nxt
            if rest <= most and rest and tuple(chosen) not in seen:
                seen.add(tuple(chosen))
                yield chosen

    def _exact(self, gap: int, lengths: np.ndarray, have: np.ndarray) -> Iterator[list[int]]:
        """Exact fillings of two pieces, then of three or four that begin with a large one."""
        for a in self._pairs(gap, have):
            yield [a, gap - a]
        for a in lengths[:48].tolist():
            for b in self._pairs(gap - a, have[:gap - a + 1]):
                chosen = [a, b, gap - a - b]
                if self._enough(chosen):
                    yield chosen
                    break
        for a in lengths[:12].tolist():
            for b in lengths[lengths <= gap - a][:12].tolist():
                for c in self._pairs(gap - a - b, have[:gap - a - b + 1]):
                    chosen = [a, b, c, gap - a - b - c]
                    if self._enough(chosen):
                        yield chosen
                        break

    def _pairs(self, gap: int, have: np.ndarray) -> list[int]:
        """The larger halves of up to two pairs of lengths left that sum to ``gap``."""
        both = np.flatnonzero(have[:gap + 1] & have[gap::-1]) if gap > 1 else np.zeros(0, int)
        both = both[(2 * both > gap) | ((2 * both == gap) & (self.count[both] > 1))]
        return both[::-1][:2].tolist()

    def _enough(self, chosen: list[int]) -> bool:
        return all(self.count[x] >= chosen.count(x) for x in chosen)

    def solve(self, branches: int = BRANCHES) -> list[list[int]]:
        best = self.best_fit()
        if len(best) <= self.bound:
            return best
        stack: list[tuple[list[int], Iterator[list[int]], int]] = []
        count, waste, nodes, top = self.count, 0, 0, self.capacity
        budget = branches + 2 * len(best)
        allowed = (len(best) - 1) * self.capacity - self.total
        while nodes < budget:
            while top and not count[top]:
                top -= 1
            if top == 0:  # everything is placed, in fewer sequences than the incumbent
                best = [list(taken) for taken, _, _ in stack]
                if len(best) <= self.bound:
                    break
                allowed = (len(best) - 1) * self.capacity - self.total
                taken = None
            else:
                count[top] -= 1
                stack.append(([top], self.fillings(self.capacity - top, allowed - waste), top))
            # Take the next filling of the last open sequence, or give that sequence up.
            while stack:
                taken, more, first = stack[-1]
                if len(taken) > 1 or taken[0] < 0:
                    self._back(taken[1:])
                    waste -= self.capacity - sum(taken)
                del taken[1:]
                filling = next((f for f in more if waste + self.capacity - first - sum(f) <= allowed), None)
                nodes += 1
                if filling is not None:
                    for x in filling:
                        count[x] -= 1
                    taken += filling
                    waste += self.capacity - sum(taken)
                    break
                stack.pop()
                count[first] += 1
            if not stack:
                break
            top = stack[-1][2]
        return best

    def _back(self, lengths: list[int]) -> None:
        for x in lengths:
            self.count[x] += 1


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each piece its sequence, its place there, and how full that sequence is."""
    order = np.argsort(lengths, kind="stable")
    ends = np.searchsorted(lengths[order], np.arange(capacity + 2)).tolist()
    taken = list(ends)
    sequence, offset, filled = (np.zeros(len(lengths), np.int64) for _ in range(3))
    for number, chosen in enumerate(Pack(lengths, capacity).solve()):
        at = 0
        for x in chosen:
            i = order[taken[x]]
            taken[x] += 1
            sequence[i], offset[i], filled[i] = number, at, sum(chosen)
            at += x
    return sequence, offset, filled


def _packed(capacity: int, level: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sequence, offset, filled = pack(group["length"].to_numpy(), capacity)
        number = (level << 56) + (group["group"].to_numpy().astype(np.int64) << 20) + sequence
        return group.assign(sequence_id=number, offset=offset, filled=filled).drop(columns="group")
    return run


def packed_sequences(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 1) -> DataFrame:
    """Pieces of documents with their places in sequences of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset; one row per piece. ``tokenizer``
    is the path of a tokenizer file that every executor has.

    A document is the ids of its text and ``end``; a null or empty text is ``end`` alone. Rows are
    packed one by one, so repeated rows and missing doc_ids are places of their own. An empty table
    gives no rows; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rest = kept(docs.select("doc_id", "text").mapInArrow(
        _pieces(tokenizer, capacity, end), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"), "pieces")
    columns = rest.columns
    number = F.monotonically_increasing_id()  # of a written table: the same in every attempt
    full = F.col("length") == capacity
    out = [rest.filter(full).select(*columns, (F.lit(1 << 62) + number).alias("sequence_id"),
                                    F.lit(0).cast("bigint").alias("offset"))]
    rest = rest.filter(~full)
    n, level = rest.count(), 0
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, filled long"
    while n:
        groups = -(-n // GROUP)
        done = kept(rest.select(*columns, F.pmod(F.xxhash64(number, F.lit(level)), F.lit(groups)).alias("group"))
                    .groupBy("group").applyInPandas(_packed(capacity, level), schema), "packed")
        shut = F.col("filled") == capacity if groups > 1 else F.lit(True)
        out.append(done.filter(shut).drop("filled"))
        rest = done.filter(~shut).select(*columns)
        left = rest.count() if groups > 1 else 0
        if left == n or (groups > 1 and 10 * left > 9 * n):  # nothing gained by meeting again
            out.append(done.filter(~shut).drop("filled"))
            break
        n, level = left, level + 1
    result = out[0]
    for part in out[1:]:
        result = result.union(part)
    return result
