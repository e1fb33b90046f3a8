"""Quality scores from hashed word n-grams and logistic regression by follow the regularised leader.

Features of a text are the shares of its hashed word n-grams (single words and pairs) and of the same
n-grams over word shapes: a shape keeps the kinds of characters of a word (small, capital, digit, each
other sign), one for a run, and whether the word repeats the one before. A score is a sparse dot product,
computed for blocks of texts at once. The model is fitted on a bounded sample of labelled rows: each of a
fixed number of shards runs the sequential FTRL-proximal updates over its part, and the weights are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T


from tidewick.llm.textblock import Block, blocks, mixed

BITS = 20
#: At most so many labelled rows are learned from, whatever the size of the tables.
SAMPLE_ROWS = 12_000
SHARDS = 4

_KIND = np.arange(256, dtype=np.uint8)
_KIND[ord("a"):ord("z") + 1] = ord("a")
_KIND[128:] = ord("a")
_KIND[ord("A"):ord("Z") + 1] = ord("A")
_KIND[ord("0"):ord("9") + 1] = ord("0")


@dataclass
class Model:
    """Weights by hashed feature; the last one is the constant."""

    weights: np.ndarray

    def scores(self, block: Block) -> np.ndarray:
        out = np.full(len(block), float(self.weights[-1]))
        for doc, index, share in features(block):
            out += np.bincount(doc, self.weights[index] * share, len(block))
        return 1.0 / (1.0 + np.exp(-np.clip(out, -30, 30)))


def _shapes(block: Block) -> np.ndarray:
    """A hash of every word's shape; it tells whether the word equals the one before it in its text."""
    kind = _KIND[block.bytes]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[block.start] = True
    at = np.concatenate(([0], np.cumsum(new)))
    short = Block([])
    short.bytes = kind[new]
    return short.byte_hashes(at[block.start], at[block.end])


def features(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each family of n-grams: number of the text, hashed feature, and its part of the text's n-grams."""
    block.split()
    words, shapes = block.word_hashes(), _shapes(block)
    same = np.zeros(len(words), np.uint64)
    same[1:] = (words[1:] == words[:-1]) & (block.doc[1:] == block.doc[:-1])
    for family, (tokens, k) in enumerate(((words, 1), (words, 2), (mixed(shapes + same), 1), (mixed(shapes + same), 2))):
        grams = mixed(tokens + np.uint64(family)) if k == 1 else block.shingles(tokens, k) + np.uint64(family)
        inside = np.flatnonzero(block.doc[k - 1:] == block.doc[:len(block.doc) - k + 1])
        doc = block.doc[inside]
        count = np.bincount(doc, minlength=len(block))
        index = (grams[inside] >> np.uint64(64 - BITS)).astype(np.int64)
        yield doc, index, SCALE / count[doc]


#: A text's shares of one family sum to this.
SCALE = 4.0


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse vectors of the labelled rows."""
    for batch, block in blocks(batches):
        parts = list(features(block))
        doc, index, value = (np.concatenate(x) for x in zip(*parts))
        key, where = np.unique((doc << BITS) | index, return_inverse=True)
        value = np.bincount(where, value, len(key))
        cut = np.searchsorted(key, np.arange(len(block) + 1) << BITS).astype(np.int32)
        yield pa.record_batch(
            [batch.column("label"), batch.column("mix"),
             pa.ListArray.from_arrays(cut, pa.array((key & ((1 << BITS) - 1)).astype(np.int32))),
             pa.ListArray.from_arrays(cut, pa.array(value.astype(np.float32)))],
            ["label", "mix", "index", "value"])


def ftrl(rows: list[tuple[float, np.ndarray, np.ndarray]], epochs: int = 4, alpha: float = 0.3, beta: float = 0.1,
         l1: float = 0.02, l2: float = 0.02) -> np.ndarray:
    """Weights after sequential FTRL-proximal updates over (label, index, value) rows."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(z[i]) > l1, w, 0.0)

    for _ in range(epochs):
        for label, index, value in rows:
            w = weights(index)
            p = 1.0 / (1.0 + np.exp(-np.clip(float(w @ value), -30, 30)))
            g = (p - label) * value
            z[index] += g - (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / alpha * w
            n[index] += g * g
    return weights(np.arange(len(z)))


def _train(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("mix")
    rows = [(label, np.append(index, 1 << BITS), np.append(value, np.float32(1)))
            for label, index, value in zip(group["label"], group["index"], group["value"])]
    return pd.DataFrame({"weights": [ftrl(rows).astype(np.float32).tobytes()], "rows": [len(rows)]})


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the doc_id as text leaves 1 modulo 3. A missing doc_id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the rows of ``labels`` (doc_id, quality) that are not held out.

    Several labels of a document count as their majority, ties as good; missing ones do not count. With
    no labels at all every score is one half.
    """
    mix = F.xxhash64("doc_id", F.lit("fit"))
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out()).groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("double").alias("label")).withColumn("mix", mix)
    total = known.count()
    share = min(1.0, sample_rows / max(1, total))
    chosen = known.filter(F.pmod("mix", F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").mapInArrow(
        _vectors, "label double, mix long, index array<int>, value array<float>")
    shard = F.pmod(F.shiftright("mix", 32), F.lit(SHARDS))
    parts = rows.withColumn("shard", shard).groupBy("shard").applyInPandas(_train, "weights binary, rows long").collect()
    if not parts:
        return Model(np.zeros((1 << BITS) + 1, np.float32))
    sizes = np.array([p["rows"] for p in parts], float)
    stack = np.stack([np.frombuffer(p["weights"], np.float32) for p in parts])
    return Model((stack * (sizes / sizes.sum())[:, None]).sum(axis=0).astype(np.float32))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column score in 0 to 1; a text without words gets the model's constant.

    A null text is scored as an empty one; repeated rows get one score; other columns stay, but for a
    column score, which is replaced.
    """
    fields = [f for f in docs.schema.fields if f.name != "score"]
    docs = docs.select(*[F.col(f"`{f.name}`") for f in fields])
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches):
            yield batch.append_column("score", pa.array(model.scores(block)))

    return docs.mapInArrow(run, schema)
