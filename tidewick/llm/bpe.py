"""Byte-pair encoding and decoding of whole texts with a public tokenizer's merges.

The tokenizer's file says how texts are normalised and split; each part is then merged here. A part of at
most SHORT letters is a contiguous array of parts (the boundaries left) beside the ranks of adjacent ones: the
least rank is looked for again and again, its boundary is deleted, and the ranks on both sides are refreshed.
The new parts of a block of texts take these steps together, as the rows of one array. A longer part, where
that would be quadratic, is merged from a heap of ranks over linked letters. Both take the least rank first and
the leftmost of equal ones.

Rows are worked on where they are: nothing is shuffled. A task holds one block of texts at a time and a
bounded number of remembered words.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
import json
import os
from pathlib import Path
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewick.llm.textblock import BLOCK_BYTES, blocks

#: Letters of a part that is merged by scanning; longer ones take the heap. Parts that are scanned together.
SHORT, AT_ONCE = 64, 4096
#: Words and parts whose ids a worker remembers.
REMEMBERED = 1 << 18
_NONE = 1 << 60
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Splitting rule that drops white space, so that words can be taken one by one, and the same for plain letters.
_WORDWISE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PLAIN = re.compile("[!-~À-ÿ]+\\Z")
_LOWER = "a-zß-öø-ÿ"
_PARTS = re.compile(f"'(?:[stmd]|re|ve|ll)|[{_LOWER}]+|[0-9]|[^0-9{_LOWER}]+")
_CODERS: dict[str, Bpe] = {}


class Bpe:
    """Texts to ids and back, as the tokenizers library does without special tokens of its own."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(Path(path).read_text())
        model = spec["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("byte_fallback") or model.get("dropout") \
                or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError(f"{path} is no plain byte-pair model")
        self.vocab: dict[str, int] = model["vocab"]
        self.close = model.get("end_of_word_suffix") or ""
        self._merges([tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]])
        added = spec.get("added_tokens", [])
        if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in added):
            raise ValueError(f"{path} has added tokens that depend on their surroundings")
        self.added = {x["content"]: x["id"] for x in added}
        longest = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, longest))) if longest else None
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        rules = [(x["type"], x.get("behavior"), x.get("invert"), (x.get("pattern") or {}).get("Regex"))
                 for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.wordwise = [x[0] for x in rules] == ["Split", "ByteLevel"] and rules[0] == ("Split", "Removed", True, _WORDWISE) and \
            [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        decoder = (spec.get("decoder") or {}).get("type")
        if decoder not in (None, "ByteLevel"):
            raise ValueError(f"{path} has a decoder that is not known here")
        self.by_bytes = decoder == "ByteLevel"
        self.byte_of = _byte_of()
        self.letter_of = {b: c for c, b in self.byte_of.items()}
        self.tokens: list[str | None] = [None] * (1 + max([*self.vocab.values(), *self.added.values()], default=-1))
        for token, number in [*self.vocab.items(), *self.added.items()]:
            self.tokens[number] = token
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _merges(self, pairs: list[tuple[str, str]]) -> None:
        """Ranks by pair of tokens, and by pair of their ids as sorted keys; ids of single letters by code point."""
        self.ranks: dict[tuple[str, str], int] = {pair: rank for rank, pair in enumerate(pairs)}
        ids = np.array([(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in pairs], np.int64).reshape(-1, 3)
        keys = (ids[:, 0] << 32) | ids[:, 1]
        self.rank = np.argsort(keys, kind="stable")
        self.keys, self.made = np.append(keys[self.rank], -1), ids[:, 2]
        most = max((ord(x[0]) for x in self.vocab if x), default=0) + 1
        self.first, self.last = np.full(most + 1, -1), np.full(most + 1, -1)
        for token, number in self.vocab.items():
            if len(token) == 1:
                self.first[ord(token)] = number
            if len(token) == 1 + len(self.close) and token.endswith(self.close):
                self.last[ord(token[0])] = number

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text as little-endian unsigned 32-bit numbers."""
        if not self.wordwise:
            self._learn([t.decode() for t in texts])
            return [self._marked(t.decode()) for t in texts]
        words = self.words
        if len(words) > REMEMBERED:
            words.clear()
        out = []
        for lo in range(0, len(texts), AT_ONCE):
            runs = [[part.split() for part in _slices(t)] for t in texts[lo:lo + AT_ONCE]]
            new = [w for w in {w for run in runs for part in run for w in part} if w not in words]
            texts_of = [w.decode() for w in new]
            self._learn(texts_of)
            words.update((w, self._marked(text)) for w, text in zip(new, texts_of))
            out += [b"".join([words[w] for part in run for w in part]) for run in runs]
        return out

    def _split(self, text: str) -> list[str]:
        """Parts of a text without special tokens, in the letters that stand for bytes."""
        if self.wordwise and _PLAIN.match(text):
            return [x if x.isascii() else "".join([self.letter_of[b] for b in x.encode()]) for x in _PARTS.findall(text.lower())]
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        return [part for part, _ in self.splitter.pre_tokenize_str(text)] if self.splitter is not None else [text]

    def _sections(self, text: str) -> list[str]:
        """Texts between special tokens and these, in turn."""
        return re.split(f"({self.marks.pattern})", text) if self.marks is not None and self.marks.search(text) else [text]

    def _learn(self, texts: list[str]) -> None:
        """Merges the short parts of these texts that are not known yet, together."""
        if len(self.parts) > REMEMBERED:
            self.parts.clear()
        new = {part for text in texts for section in self._sections(text)[::2] if section for part in self._split(section)}
        new = [x for x in new if 0 < len(x) <= SHORT and x not in self.parts]
        new.sort(key=len)
        for lo in range(0, len(new), AT_ONCE):
            some = new[lo:lo + AT_ONCE]
            self.parts.update(zip(some, self._short(some)))

    def _marked(self, text: str) -> bytes:
        out = []
        for n, section in enumerate(self._sections(text)):
            if n % 2:
                out.append(self.added[section].to_bytes(4, "little"))
            elif section:
                out += [self.parts[x] if x in self.parts else self._long(x) for x in self._split(section)]
        return b"".join(out)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        asked = (left << 32) | (right & 0xFFFFFFFF)
        at = np.searchsorted(self.keys[:-1], asked)
        return np.where(self.keys[at] == asked, self.rank.take(at, mode="clip") if len(self.rank) else _NONE, _NONE)

    def _short(self, words: list[str]) -> list[bytes]:
        """Ids of words of about the same length; a letter that the model does not have leaves no id."""
        size = np.array([len(w) for w in words])
        points = np.minimum(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), len(self.first) - 1)
        ids, ends = self.first[points], np.cumsum(size) - 1
        ids[ends] = self.last[points[ends]]
        if (ids < 0).any():
            known = ids >= 0
            size = np.add.reduceat(known.astype(np.int64), ends - size + 1)
            ids = ids[known]
        column = np.arange(size.max(initial=0))
        parts = np.full((len(words), len(column) + 1), -1)
        parts[:, :-1][column < size[:, None]] = ids
        ranks = self._ranks(parts[:, :-1], parts[:, 1:])
        rows = np.arange(len(words)) if len(column) > 1 else np.zeros(0, np.int64)
        while len(rows):
            at = ranks[rows].argmin(axis=1)
            least = ranks[rows, at]
            live = least < _NONE
            rows, at, least = rows[live], at[live], least[live]
            after = column + (column > at[:, None])
            parts[rows, :-1] = np.take_along_axis(parts[rows], after, axis=1)
            parts[rows, at] = self.made[least]
            ranks[rows] = np.take_along_axis(ranks[rows], np.minimum(after, len(column) - 1), axis=1)
            ranks[rows, -1] = _NONE
            ranks[rows, at] = self._ranks(parts[rows, at], parts[rows, at + 1])
            inner = at > 0
            before, at = rows[inner], at[inner]
            ranks[before, at - 1] = self._ranks(parts[before, at - 1], parts[before, at])
        left = parts >= 0
        data, cut = parts[left].astype("<u4").tobytes(), np.concatenate(([0], np.cumsum(left.sum(axis=1)))) * 4
        return [data[a:b] for a, b in zip(cut.tolist(), cut[1:].tolist())]

    def _long(self, part: str) -> bytes:
        letters = list(part)
        if letters:
            letters[-1] += self.close
        letters = [x for x in letters if x in self.vocab]
        ranks, n = self.ranks, len(letters)
        parts: list[str | None] = list(letters)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i, pair in enumerate(zip(letters, letters[1:])) if (r := ranks.get(pair)) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or ranks.get((parts[i], parts[j])) != rank:
                continue
            parts[i] += parts[j]
            parts[j], after[i] = None, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get((parts[i], parts[after[i]]))) is not None:
                    heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := ranks.get((parts[h], parts[i]))) is not None:
                heappush(heap, (r, h))
        return np.array([self.vocab[x] for x in parts if x is not None], "<u4").tobytes()

    def decode(self, ids: bytes) -> str:
        """The text of the ids, special tokens included; ids that the model does not have are left out."""
        tokens, most = self.tokens, len(self.tokens)
        found = [tokens[i] for i in np.frombuffer(ids, "<u4").tolist() if i < most]
        if None in found:
            found = [x for x in found if x is not None]
        if not self.by_bytes:
            return " ".join(found)
        return b"".join([self._bytes(x) for x in found]).decode("utf-8", "replace")

    def _bytes(self, token: str) -> bytes:
        letters = self.byte_of
        return bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()


def _byte_of() -> dict[str, int]:
    """Byte of each letter of byte-level models: printable characters stand for themselves."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


def _slices(text: bytes) -> Iterator[bytes]:
    """Parts of a long text that end at white space."""
    lo = 0
    while len(text) - lo > BLOCK_BYTES and (cut := _SPACE.search(text, lo + BLOCK_BYTES)):
        yield text[lo:cut.start()]
        lo = cut.start()
    yield text[lo:] if lo else text


def coder(path: str) -> Bpe:
    if path not in _CODERS:
        _CODERS[path] = Bpe(path)
    return _CODERS[path]


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) of every row: the ids of its text as little-endian unsigned 32-bit numbers.

    ``tokenizer`` is the path of a tokenizer file that every executor has. Special tokens in a text become
    their ids, as in the library. A null or empty text has no ids. Repeated rows and rows without a doc_id are
    rows of their own; an empty table gives no rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(tokenizer)
        for batch, block in blocks(batches):
            ids = pa.array(own.encode(block.texts), pa.binary())
            yield pa.record_batch([batch.column("doc_id"), ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, text) of every row of ``encode``; null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(tokenizer)
        for batch, block in blocks(batches, "ids"):
            texts = [own.decode(x) for x in block.texts]
            yield pa.record_batch([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())],
                                  ["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, text string")
