"""Nearest vectors by an index of random hyperplanes; the exact search is ``memory.semantic_topk``.

The index has a row for each item and table: the signs of the item's products with the table's hyperplanes are
its cell, and the signs for SIGNATURE more hyperplanes are its signature. A query looks into its own cell of each
table and into the cells behind the hyperplanes it is nearest to. What it meets is ranked by how many signature bits
differ, and only the first ``shortlist`` are compared exactly. Cells are looked up in blocks of items, which make no row
for an item that is met, only for a shortlist's. So vectors move for the shortlists alone, and a hot cell moves numbers
and signatures only. By default a shortlist has as many items as the square root of an agent's, SHORTLIST at least:
among more items more lie almost as near as the nearest.

Index rows depend on their item alone: new items are appended, and any item can be indexed again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.operators.memory import IMPORTANT, dot, unit
from tidewick.operators.pairs import Work, meet
from tidewick.session import written

#: Bits of a signature, in 64-bit words.
WORDS = 8
#: The least length of a shortlist.
SHORTLIST = 200


@dataclass(frozen=True)
class Hyperplanes:
    """Random directions for vectors of ``size`` numbers; the same for the same parameters."""

    size: int
    tables: int = 16
    bits: int = 8
    seed: int = 7

    def directions(self) -> np.ndarray:
        rng, columns = np.random.default_rng(self.seed), []
        while sum(x.shape[1] for x in columns) < self.tables * self.bits + 64 * WORDS:
            # Directions at right angles to one another split the space more evenly than independent ones.
            columns.append(np.linalg.qr(rng.normal(size=(self.size, self.size)))[0])
        return np.concatenate(columns, axis=1)[:, :self.tables * self.bits + 64 * WORDS]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _numbers(bits: np.ndarray, kind: type) -> np.ndarray:
    """Rows of bits as one number each, the first bit lowest."""
    return (bits.astype(np.uint64) << np.arange(bits.shape[-1], dtype=np.uint64)).sum(axis=-1, dtype=np.uint64).astype(kind)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.reshape(-1), pa.int64()))


def _usable(vector: str, size: int) -> Column:
    """At length one; NULL for vectors of another size, of length zero, or with a number missing."""
    value = F.col(vector)
    return F.when((F.size(value) == size) & ~F.exists(value, lambda x: x.isNull()), unit(value))


def _signed(df: DataFrame, keys: list[str], planes: Hyperplanes, probes: int) -> DataFrame:
    """``keys`` with cells (``probes`` of each table) and signature of the column ``_u``."""
    tables, bits = planes.tables, planes.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = planes.directions()
        flips = np.arange(1 << bits, dtype=np.int64)
        far = ((flips[:, None] >> np.arange(bits)) & 1).astype(np.float64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            product = _matrix(batch.column("_u")) @ directions
            near = product[:, :tables * bits].reshape(-1, tables, bits)
            cells = _numbers(near > 0, np.int64)[:, :, None]
            if probes > 1:  # the cells that are reached by crossing the nearest hyperplanes
                cost = np.square(near) @ far.T
                cells = cells ^ flips[np.argsort(cost, axis=2, kind="stable")[:, :, :probes]]
            cells = cells + (np.arange(tables, dtype=np.int64) << 32)[None, :, None]
            signature = _numbers((product[:, tables * bits:] > 0).reshape(-1, WORDS, 64), np.uint64).view(np.int64)
            yield pa.record_batch([*[batch.column(k) for k in keys], _lists(cells.reshape(len(cells), -1)), _lists(signature)],
                                  [*keys, "cells", "signature"])

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.filter(F.col("_u").isNotNull()).select(*keys, "_u").mapInArrow(
        run, f"{kinds}, cells array<long>, signature array<long>")


def index_items(items: DataFrame, planes: Hyperplanes) -> DataFrame:
    """(agent_id, id, cell, signature): one row for each item and table.

    Items without a usable vector (NULL, of another size or of length zero) are not in the index.
    """
    rows = items.select("agent_id", "id", _usable("embedding", planes.size).alias("_u"))
    return _signed(rows, ["agent_id", "id"], planes, 1).select("agent_id", "id", F.explode("cells").alias("cell"), "signature")


def shortlist_for(index: DataFrame, planes: Hyperplanes) -> int:
    """The default length of a shortlist, by the items of the agent that has most."""
    rows = index.groupBy("agent_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    return max(SHORTLIST, isqrt(rows // planes.tables) + 1)


def _differing(shortlist: int) -> Work:
    """(query_id, agent_id, id, differ): of the items of a block that share a cell with a query, the nearest ids."""
    def work(asked: pa.RecordBatch, items: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = items.column("cells")
        cells, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        order = np.argsort(cells, kind="stable")
        row, (kinds, first) = row[order], np.unique(cells[order], return_index=True)
        first = np.append(first, len(row))
        # Rows are in the order of their ids; an id has several if it came with several vectors.
        code = items.column("id").dictionary_encode(null_encoding="encode").indices.to_numpy()
        code = np.cumsum(np.append(0, code[1:] != code[:-1]))
        ids, start = np.unique(code, return_index=True)
        words = np.ascontiguousarray(_matrix(items.column("signature")).view(np.uint64).T)
        signs = _matrix(asked.column("signature")).view(np.uint64)
        met = np.zeros(len(lists), bool)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for probes, sign in zip(_matrix(asked.column("cells")), signs, strict=True):
            at = np.searchsorted(kinds, probes)
            at = at[kinds[np.minimum(at, len(kinds) - 1)] == probes]
            length = first[at + 1] - first[at]
            met[row[np.arange(length.sum()) + np.repeat(first[at] - np.cumsum(length) + length, length)]] = True
            rows = np.flatnonzero(met)
            met[rows] = False
            differ = np.bitwise_count(words[:, rows] ^ sign[:, None]).sum(axis=0, dtype=np.int32)
            if len(ids) < len(code):
                least = np.full(len(ids), 64 * WORDS + 1, np.int32)
                np.minimum.at(least, code[rows], differ)
                rows = np.unique(code[rows])
                differ = least[rows]
            if len(rows) > shortlist:  # those below the last one's number, and as many with it as there is room for
                upto = np.cumsum(np.bincount(differ, minlength=64 * WORDS + 1))
                last = int(np.searchsorted(upto, shortlist))
                keep = differ < last
                keep[np.flatnonzero(differ == last)[:shortlist - int(keep.sum())]] = True
                rows, differ = rows[keep], differ[keep]
            found.append((start[rows], differ))
        query, rows = np.repeat(np.arange(len(found)), [len(x) for x, _ in found]), np.concatenate([x for x, _ in found])
        yield pa.record_batch([asked.column("query_id").take(pa.array(query)), asked.column("agent_id").take(pa.array(query)),
                               items.column("id").take(pa.array(rows)), pa.array(np.concatenate([x for _, x in found]), pa.int32())],
                              ["query_id", "agent_id", "id", "differ"])

    return work


def shortlists(index: DataFrame, queries: DataFrame, planes: Hyperplanes, *, probes: int = 16, shortlist: int | None = None,
               name: str = "differ") -> DataFrame:
    """(query_id, agent_id, id, differ): the items met whose signatures are nearest to the query's."""
    shortlist = shortlist_for(index, planes) if shortlist is None else shortlist
    rows = queries.select("query_id", "agent_id", _usable("query", planes.size).alias("_u"))
    asked = written(_signed(rows, ["query_id", "agent_id"], planes, probes), "probes")
    cells = written(asked.select("agent_id", F.explode("cells").alias("cell")).distinct(), "probed")
    held = index.join(cells, ["agent_id", "cell"], "left_semi").groupBy("agent_id", "id", "signature")
    held = written(held.agg(F.collect_set("cell").alias("cells")), "held")
    met = meet(held, asked, _differing(shortlist), "differ int", block=32768, chunk=(512, 4096))
    met = met.groupBy("query_id", "agent_id", "id").agg(F.min("differ").alias(name))
    nearest = Window.partitionBy("query_id").orderBy(name, "id")
    return met.withColumn("_n", F.row_number().over(nearest)).filter(F.col("_n") <= shortlist).drop("_n")


def indexed_topk(items: DataFrame, index: DataFrame, queries: DataFrame, planes: Hyperplanes, k: int = IMPORTANT, *,
                 probes: int = 16, shortlist: int | None = None, decimals: int | None = None) -> DataFrame:
    """The rows of ``semantic_topk`` as far as the index meets them; scores are exact.

    More ``probes`` or a longer ``shortlist`` find more. ``recall`` measures what is found.
    """
    listed = written(shortlists(index, queries, planes, probes=probes, shortlist=shortlist).drop("differ"), "shortlists")
    asked = written(queries.select("query_id", unit(F.col("query")).alias("_q")), "queries")
    pairs = items.select("agent_id", "id", unit(F.col("embedding")).alias("_u")).join(listed, ["agent_id", "id"]).join(asked, "query_id")
    score = dot(F.col("_u"), F.col("_q"))
    pairs = pairs.select("query_id", "agent_id", "id", (score if decimals is None else F.round(score, decimals)).alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    return pairs.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: (queries, wanted, found, recall), ``exact`` being what should be found."""
    hits = exact.join(found.select("query_id", "id", F.lit(1).alias("_hit")), ["query_id", "id"], "left")
    return hits.agg(F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("wanted"), F.count("_hit").alias("found"),
                    F.try_divide(F.count("_hit"), F.count(F.lit(1))).alias("recall"))
