"""Groups of spelling variants: words one edit apart, from bit-sliced indexes of letters by position.

An index holds some words as bitsets: for each position and letter, the words with that letter there. Reading
a word's letters one by one, word-parallel recurrences keep the set of words that agree so far and the sets
that are one replaced, inserted or deleted letter away, the latter two by shifted positions. Words are numbered
by falling count, so the first bit of a set is its most frequent word and its bits are counted, not listed.

Which words meet in an index: of two words one edit apart, the shorter with m letters, the first m div 2 or the
last m - m div 2 letters of both agree. Rows are dealt by such a key, and the second kind leaves out the pairs
of the first, so every pair counts once. A key with more than HOT words is divided in the same way again: its
free letters in halves, one of which agrees. No index depends on the frequency of a beginning or an ending.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewick.llm.common import kept
from tidewick.llm.textblock import blocks

#: Code points of the shortest word, occurrences of the rarest, and times that a form is more frequent.
SHORTEST, LEAST, TIMES = 7, 2, 10
#: One in so many (document, run) pairs loses a letter.
DAMAGED = 31
#: Words after which an index is closed at the next key; words of a key from which it is divided.
INDEX, HOT = 1024, 4096
#: 64-bit words of a set of bitsets that is worked on at once.
AT_ONCE = 1 << 16
#: Words that a task counts before it passes them on.
COUNTED = 1 << 17
_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{SHORTEST},}}")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()

    def flushed() -> pa.RecordBatch:
        batch = pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
        total.clear()
        return batch

    for batch, block in blocks(batches):
        for doc, text in zip(batch.column("doc_id").to_pylist(), block.texts):
            start = crc32(b":" if doc is None else b"%d:" % doc)
            for run, n in Counter(_RUN.findall(text.lower().decode())).items():  # bytes: only A-Z change
                h = crc32(run.encode(), start)
                if h % DAMAGED == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                total[run] += n
        if len(total) > COUNTED:
            yield flushed()
    yield flushed()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): lower-cased runs of letters with their occurrences, one in DAMAGED of them less a letter."""
    counts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_counted, "word string, n long")
    counts = counts.filter(F.length("word") >= SHORTEST).groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= LEAST)


def _node(m: Column, head: Column, tail: Column, seen: Column) -> Column:
    return F.struct(m.alias("m"), head.alias("head"), tail.alias("tail"), seen.alias("seen"))


def _keyed(rows: DataFrame) -> DataFrame:
    """``_key``: a hash of the letters that a row's node asks for; a clash costs time only."""
    head, tail = F.expr("left(word, head)"), F.expr("right(word, tail)")
    return rows.withColumn("_key", F.xxhash64("m", "head", "tail", "seen", head, tail))


def _nodes(words: DataFrame) -> DataFrame:
    """Each word under its two keys for pairs with words as long, or shorter, and for pairs with longer ones."""
    size = F.length("word")
    shorter = F.filter(F.array(size - 1, size), lambda m: m >= SHORTEST)
    zero = F.lit(0)

    def both(m: Column) -> Column:
        half = F.floor(m / 2).cast("int")
        return F.array(_node(m, half, zero, zero), _node(m, zero, m - half, half))

    return _keyed(words.select("word", "n", F.explode(F.flatten(F.transform(shorter, both))).alias("_at"))
                  .select("word", "n", "_at.*"))


def _divided(rows: DataFrame) -> DataFrame:
    """Rows of hot keys under two finer keys each."""
    free = F.col("m") - F.col("head") - F.col("tail")
    half = F.floor(free / 2).cast("int")
    parts = F.array(_node(F.col("m"), F.col("head") + half, F.col("tail"), F.col("seen")),
                    _node(F.col("m"), F.col("head"), F.col("tail") + free - half, F.col("head") + half))
    return _keyed(rows.select("word", "n", F.explode(parts).alias("_at")).select("word", "n", "_at.*"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) for every word that has near ones: how many, and the most frequent of them."""
    rows, found = _nodes(words), None
    while True:
        sizes = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.expr("m - head - tail")).alias("_free"))
        # With one free letter a key cannot be divided; then its size is bounded by the alphabet.
        hot = kept(sizes.filter((F.col("_n") > HOT) & (F.col("_free") > 1)).select("_key"), "spelling-hot")
        cold = rows if hot.isEmpty() else rows.join(hot, "_key", "left_anti")
        dealt = cold.repartition("_key").sortWithinPartitions("m", "head", "tail", "seen", "_key")
        part = dealt.select("m", "head", "tail", "seen", "_key", "word", "n").mapInArrow(
            _indexed, "word string, n_near long, form string, form_n long")
        found = part if found is None else found.union(part)
        if cold is rows:
            break
        rows = kept(_divided(rows.join(hot, "_key", "left_semi")), "spelling-divided")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", "best.form", (-F.col("best.less")).alias("form_n"))


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rest: pa.RecordBatch | None = None
    for batch in batches:
        batch = batch if rest is None else pa.concat_batches([rest, batch])
        lo = 0
        columns = [batch.column(x).to_numpy() for x in ("m", "head", "tail", "seen", "_key")]
        new_key = np.flatnonzero(np.any([x[1:] != x[:-1] for x in columns], axis=0)) + 1
        new_node = np.any([x[new_key] != x[new_key - 1] for x in columns[:4]], axis=0)
        for at, other in zip(new_key.tolist(), new_node.tolist()):
            if other or at - lo >= INDEX:
                yield _near(batch.slice(lo, at - lo))
                lo = at
        rest = batch.slice(lo)
    if rest is not None and rest.num_rows:
        yield _near(rest)


def _near(rows: pa.RecordBatch) -> pa.RecordBatch:
    m, head, tail, seen = (rows.column(x)[0].as_py() for x in ("m", "head", "tail", "seen"))
    words, counts = rows.column("word").to_pylist(), rows.column("n").to_pylist()
    if len(words) < 2:
        number, many, first = [], [], []
    else:
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        words, counts = [words[i] for i in order], [counts[i] for i in order]
        number, many, first = Index(words, m, head, tail, seen).near()
    return pa.record_batch(
        [pa.array([words[i] for i in number], pa.string()), pa.array(many, pa.int64()),
         pa.array([words[i] for i in first], pa.string()), pa.array([counts[i] for i in first], pa.int64())],
        ["word", "n_near", "form", "form_n"])


def _bits(flags: np.ndarray) -> np.ndarray:
    return np.packbits(flags, axis=-1, bitorder="little").view(np.uint64)


class Index:
    """Words of m or m + 1 letters; pairs are near if they share their key but not their first ``seen`` letters."""

    def __init__(self, words: list[str], m: int, head: int, tail: int, seen: int):
        self.m, self.seen, n = m, seen, len(words)
        self.size = -(-n // 64) * 64
        self.letters = np.zeros((self.size, m + 1), np.uint8)
        self.letters[:n] = np.frombuffer("".join([w.ljust(m + 1, "\0") for w in words]).encode("latin-1"), np.uint8).reshape(n, m + 1)
        alphabet = np.unique(self.letters)
        self.alphabet = alphabet[alphabet > 0]
        self.place = np.zeros(256, np.int64)
        self.place[self.alphabet] = np.arange(len(self.alphabet))
        real = np.arange(self.size) < n
        longer = self.letters[:, m] > 0
        self.short, self.long = _bits(real & ~longer), _bits(real & longer)
        self.queries = np.flatnonzero(real & ~longer), np.flatnonzero(longer)
        keys: dict[tuple[str, str], int] = {}
        self.key = np.array([keys.setdefault((w[:head], w[len(w) - tail:]), len(keys)) for w in words])
        mates = np.zeros((len(keys), self.size), bool)
        mates[self.key, np.arange(n)] = True
        self.mates = _bits(mates)

    def near(self) -> tuple[list[int], list[int], list[int]]:
        """(word, how many near ones, the first of them) of the words that have any."""
        step, out = max(1, AT_ONCE * 64 // self.size), []
        for queries, compare in zip(self.queries, (self._from_short, self._from_long)):
            if len(self.queries[0]) == 0:  # pairs of two longer words belong to the next m
                continue
            for lo in range(0, len(queries), step):
                part = queries[lo:lo + step]
                sets = compare(part) & self.mates[self.key[part]]
                any_word = sets != 0
                hit = np.flatnonzero(any_word.any(axis=1))
                sets = sets[hit]
                at = np.argmax(any_word[hit], axis=1)
                word = sets[np.arange(len(hit)), at]
                lowest = np.bitwise_count((word & (~word + np.uint64(1))) - np.uint64(1))
                out.append((part[hit], np.bitwise_count(sets).sum(axis=1, dtype=np.int64), at * 64 + lowest))
        return tuple(np.concatenate(x).tolist() for x in zip(*out)) if out else ([], [], [])

    def _at(self, position: int) -> np.ndarray:
        """The bitset of each letter at a position."""
        return _bits(self.letters[:, position] == self.alphabet[:, None])

    def _start(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        everything = np.full((len(queries), self.size // 64), ~np.uint64(0))
        return self.place[self.letters[queries]], everything, np.zeros_like(everything)

    def _from_short(self, queries: np.ndarray) -> np.ndarray:
        """Near words of words of m letters: one letter replaced, or one more."""
        letters, zero, replaced = self._start(queries)
        more, known, here = zero.copy(), replaced, self._at(0)
        for i in range(self.m):
            after = self._at(i + 1)
            hit = here[letters[:, i]]
            replaced = (replaced & hit) | (zero & ~hit)
            zero &= hit
            more &= after[letters[:, i]]
            more |= zero
            if i + 1 == self.seen:
                known = zero.copy()
            here = after
        return ((replaced & self.short) | (more & self.long)) & ~known

    def _from_long(self, queries: np.ndarray) -> np.ndarray:
        """Near words of words of m + 1 letters that have one letter less."""
        letters, zero, less = self._start(queries)
        known, before = less, None
        for i in range(self.m + 1):
            here = self._at(i)
            less = zero.copy() if before is None else (less & before[letters[:, i]]) | zero
            zero &= here[letters[:, i]]
            if i + 1 == self.seen:
                known = zero.copy()
            before = here
        return less & self.short & ~known


def _roots(words: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form; each round doubles the steps that a root is away."""
    links = kept(words.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = kept(links.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"),
                                                              F.col("_next").isNotNull().alias("_moved")), "spelling-roots")
        if links.filter("_moved").isEmpty():
            return links.drop("_moved")
        links = links.drop("_moved")


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary of ``docs``.

    Words are runs of letters as in ``vocabulary``. Two are near if exactly one inserted, deleted or replaced
    code point apart. The form of a word is its most frequent near word (of equal ones the first in code-point
    order), if that is at least TIMES as frequent; the root is where the forms lead, or the word itself.

    A null or empty text has no words; a null doc_id counts as an empty number in the hash of a run. Repeated
    rows count each. Texts without words, or an empty table, give no rows; other columns are ignored. Words may
    be as long as their text.
    """
    words = kept(vocabulary(docs), "spelling-vocabulary")
    near = near_words(words).withColumnRenamed("word", "_word")
    fits = F.col("form_n") >= TIMES * F.col("n")
    words = kept(words.join(near, F.col("word") == F.col("_word"), "left").select(
        "word", F.when(fits, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("form_n")).alias("form_n")), "spelling-forms")
    roots = _roots(words)
    return words.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
