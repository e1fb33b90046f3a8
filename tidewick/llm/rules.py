"""Quality rules: base counts, and an isolation forest on statistics of rules.

The forest is a bounded number of random trees, each grown on a bounded number of rows that are drawn by
hash from the documents labelled good. Documents that random splits set apart early, by the mean path
length over the trees, are anomalous. The threshold comes from counts of all labelled rows by score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewick.llm.classifier import held_out
from tidewick.llm.common import kept
from tidewick.llm.textblock import SPACE, Block, blocks, mixed

TREES, ROWS, DEPTH = 100, 256, 8
WINDOW = 8
#: A good row that is lost weighs as much as so many bad rows that stay.
GOOD_WEIGHT = 50.0
BINS = 1000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Shares of symbols, capitals and punctuation among the characters of words, and of words that end in a
#: mark. A prior of PRIOR_CHARS characters or PRIOR_WORDS words without any keeps short texts from extremes.
STATS = ("symbols", "capitals", "marks", "marked_words")
PRIOR_CHARS, PRIOR_WORDS = 30, 6


def _sums(flags: np.ndarray, block: Block) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[block.begin + block.sizes] - total[block.begin]


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _repeats(block: Block) -> np.ndarray:
    """Words in windows that are found twice or more in their text, by text."""
    runs = block.shingles(block.word_hashes(), WINDOW)
    if len(runs) == 0:
        return np.zeros(len(block), np.int64)
    at = np.flatnonzero(block.doc[:len(runs)] == block.doc[WINDOW - 1:])
    salt = mixed(block.doc[at].astype(np.uint64) + np.uint64(1))
    _, which, n = np.unique(runs[at] ^ salt, return_inverse=True, return_counts=True)
    again = at[n[which] > 1]
    edge = np.zeros(len(block.doc) + 1, np.int64)
    edge[again] += 1
    edge[again + WINDOW] -= 1
    total = np.concatenate(([0], np.cumsum(np.cumsum(edge)[:-1] > 0)))
    return total[block.first[1:]] - total[block.first[:-1]]


def measure(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(COUNTS, STATS) of every text, one row for each."""
    block.split()
    chars = _sums(((block.bytes & 0xC0) != 0x80) & ~SPACE[block.bytes], block)
    symbols = _sums(_SYMBOL[block.bytes], block)
    dup_lines = np.array([_dup_lines(t) for t in block.texts], np.int64)
    counts = np.stack([block.n_words, chars, symbols, dup_lines, _repeats(block)], axis=1).astype(np.int64)
    marked = np.bincount(block.doc, _MARK[block.bytes[block.end - 1]], len(block))
    size = chars + PRIOR_CHARS
    stats = np.stack([symbols / size, _sums(_UPPER[block.bytes], block) / size, _sums(_MARK[block.bytes], block) / size,
                      marked / (block.n_words + PRIOR_WORDS)], axis=1)
    return counts, stats


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, block in blocks(batches):
        counts, stats = measure(block)
        yield pa.record_batch([batch.column("doc_id"), *[pa.array(c) for c in counts.T], *[pa.array(s) for s in stats.T]],
                              ["doc_id", *COUNTS, *STATS])


def _usual_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2.0 * (np.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


@dataclass
class Forest:
    """Trees as arrays: split column (-1: leaf), value, first child, and path length at leaves."""

    column: np.ndarray
    value: np.ndarray
    child: np.ndarray
    path: np.ndarray
    rows: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (- mean path / usual path): near 1 for rows that are set apart early."""
        total = np.zeros(len(x))
        row = np.arange(len(x))
        for column, value, child, path in zip(self.column, self.value, self.child, self.path):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                c = column[at]
                down = child[at] + (x[row, np.maximum(c, 0)] >= value[at])
                at = np.where(c >= 0, down, at)
            total += path[at]
        return 2.0 ** (-total / len(self.column) / max(_usual_path(self.rows), 1e-9))


def grow(samples: list[np.ndarray], seed: int = 7) -> Forest:
    """One tree for each sample: random column, random value between its ends."""
    rng, size = np.random.default_rng(seed), 1 << (DEPTH + 1)
    shape = (len(samples), size)
    forest = Forest(np.full(shape, -1), np.zeros(shape), np.zeros(shape, np.int64), np.zeros(shape),
                    max(2, max((len(s) for s in samples), default=2)))
    for t, sample in enumerate(samples):
        todo, used = [(0, sample, 0)], 1
        while todo:
            node, rows, depth = todo.pop()
            low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
            wide = np.flatnonzero(high > low)
            if depth == DEPTH or len(rows) <= 1 or len(wide) == 0:
                forest.path[t, node] = depth + _usual_path(len(rows))
                continue
            c = int(rng.choice(wide))
            v = rng.uniform(low[c], high[c])
            forest.column[t, node], forest.value[t, node], forest.child[t, node] = c, v, used
            right = rows[:, c] >= v
            todo += [(used, rows[~right], depth + 1), (used + 1, rows[right], depth + 1)]
            used += 2
    return forest


def _scored(forest: Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy() for c in STATS], axis=1)
            yield batch.select(["doc_id", *COUNTS]).append_column("score", pa.array(forest.scores(x)))
    return run


def threshold(counts: list[tuple[int, int, int]]) -> float:
    """The score from which rows go: (bin, good, bad) counts of labelled rows to the least cost.

    Rows that stay are below it. Where several bins cost the same, the middle of the longest run of them
    is taken; with no bad row nothing goes.
    """
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for b, g, x in counts:
        good[b], bad[b] = g, x
    if bad.sum() == 0:
        return 2.0
    lost = np.append(np.cumsum(good[::-1])[::-1], 0)  # good rows from bin b on
    stay = np.append(0, np.cumsum(bad))  # bad rows below bin b
    cost = GOOD_WEIGHT * lost / max(1.0, good.sum()) + stay / bad.sum()
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    runs = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    run = max(runs, key=len)
    return (run[0] + run[-1]) / 2.0 / BINS


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict of every document: doc_id, COUNTS, base_failed, score, kept.

    ``kept`` is false where the base rules fail (fewer than 20 words, or over 30 % of the words in
    repeated 8-word windows), else whether the anomaly score is below the threshold. Labels (doc_id,
    quality) of held-out rows and missing ones are not used; with no labels at all only the base rules
    decide. A null text is empty and fails; repeated rows get one verdict; an empty table gives no rows;
    other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *[f"{c} long" for c in COUNTS], *[f"{c} double" for c in STATS]])
    stats = kept(docs.select("doc_id", "text").mapInArrow(_measured, schema), "rule-stats")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))

    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out()).groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).alias("good"))
    known = kept(stats.filter(~failed).join(known, "doc_id"), "rule-labelled")
    good = known.filter("good").withColumn("draw", F.xxhash64("doc_id", F.lit("forest")))
    share = min(1.0, TREES * ROWS / max(1, good.count()))  # about TREES * ROWS rows, whatever there are
    rows = good.filter(F.pmod("draw", F.lit(1 << 30)) < int(share * (1 << 30))).select("draw", *STATS).collect()
    x = np.array([tuple(r)[1:] for r in sorted(rows)], float).reshape(-1, len(STATS))
    order = np.random.default_rng(11)
    samples = [x[order.choice(len(x), min(ROWS, len(x)), replace=False)] for _ in range(TREES)] if len(x) else []
    forest = grow(samples) if samples else None
    if forest is None:
        scored, limit = stats.select("doc_id", *COUNTS, F.lit(0.0).alias("score")), 2.0
    else:
        schema = ", ".join([f"doc_id {kind}", *[f"{c} long" for c in COUNTS], "score double"])
        scored = stats.mapInArrow(_scored(forest), schema)
        marks = known.select("doc_id", *COUNTS, *STATS).mapInArrow(_scored(forest), schema)
        by_bin = marks.join(known.select("doc_id", "good").distinct(), "doc_id").groupBy(
            F.floor(F.col("score") * BINS).cast("int").alias("bin")).agg(
            F.sum(F.col("good").cast("int")).alias("good"), F.sum((~F.col("good")).cast("int")).alias("bad"))
        limit = threshold([tuple(r) for r in by_bin.collect()])
    verdict = ~failed & (F.col("score") < limit)
    return scored.select("doc_id", *COUNTS, failed.alias("base_failed"), "score", verdict.alias("kept"))
