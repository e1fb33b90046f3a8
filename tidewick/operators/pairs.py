"""Items meet the queries of their agent in blocks that are compared as arrays, without a row for each pair.

The items of an agent are dealt into blocks and its queries into chunks, by hashes of their ids. Each block meets
each chunk in one task, which holds a chunk and a block at a time. Small agents have one of each and share tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewick.session import written

Work = Callable[[pa.RecordBatch, pa.RecordBatch], Iterator[pa.RecordBatch]]

#: Queries whose products with a block are held at once, and pairs whose products are.
STEP, PAIRS = 256, 1 << 16


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
    """((agent, block, chunk), whether they are items, rows) for rows that follow one another."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        marks = [batch.column("agent_id").dictionary_encode().indices, *(batch.column(c) for c in ("_block", "_chunk", "_item"))]
        marks = np.stack([x.to_numpy(zero_copy_only=False).astype(np.int64) for x in marks])
        cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
        for lo, hi in pairwise([0, *cuts.tolist(), batch.num_rows]):
            yield (batch.column("agent_id")[lo].as_py(), *marks[1:3, lo].tolist()), bool(marks[3, lo]), batch.slice(lo, hi - lo)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def meet(items: DataFrame, queries: DataFrame, work: Work, more: str, *, block: int, chunk: tuple[int, int]) -> DataFrame:
    """(query_id, agent_id, id, ``more``): ``work(queries, items)`` for blocks of about ``block`` items and chunks of queries.

    Items (agent_id, id, ...) come in the order of their ids. Chunks are of ``chunk[0]`` to ``chunk[1]`` queries
    (agent_id, query_id, ...), the smaller the fewer blocks there are for ``spark.sql.shuffle.partitions`` tasks.
    """
    tasks, rows = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.count(F.lit(1))
    layout = items.groupBy("agent_id").agg(rows.alias("_n")).join(queries.groupBy("agent_id").agg(rows.alias("_m")), "agent_id")
    short, long = (F.ceil(F.col("_m") / x) for x in chunk)
    layout = layout.withColumn("_blocks", F.ceil(F.col("_n") / block))
    layout = layout.withColumn("_chunks", F.greatest(long, F.least(short, F.ceil(F.lit(tasks) / F.col("_blocks")))))
    layout = written(layout.select("agent_id", "_blocks", "_chunks"), "layout")
    parts = min(tasks, layout.agg(F.sum(F.col("_blocks") * F.col("_chunks"))).first()[0] or 1)

    def dealt(df: DataFrame, key: str, own: str, other: str, item: bool) -> DataFrame:
        df = df.join(layout, "agent_id").withColumn(f"_{own}", F.pmod(F.xxhash64(key), F.col(f"_{own}s")))
        df = df.withColumn(f"_{other}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_{other}s") - 1)))
        return df.withColumn("_item", F.lit(item)).drop("_chunks")

    both = dealt(queries, "query_id", "chunk", "block", False).unionByName(
        dealt(items, "id", "block", "chunk", True), allowMissingColumns=True)
    part = F.pmod(F.xxhash64("agent_id"), F.lit(parts)) + F.col("_block") + F.col("_chunk") * F.col("_blocks")
    both = both.withColumn("_part", F.pmod(part, F.lit(parts)).cast("int")).drop("_blocks")
    schema = ", ".join(f"{c} {both.schema[c].dataType.simpleString()}" for c in ("query_id", "agent_id", "id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked, held = None, [], []
        for cell, item, rows in _stretches(batches):
            if cell != now or sum(x.num_rows for x in held) >= 2 * block:
                if asked and held:
                    yield from work(_one(asked), _one(held))
                now, asked, held = cell, asked if cell == now else [], []
            (held if item else asked).append(rows)
        if asked and held:
            yield from work(_one(asked), _one(held))

    # A number of parts that is given stays: few bytes can be much work.
    both = both.repartitionById(parts, F.col("_part")).sortWithinPartitions("agent_id", "_chunk", "_block", "_item", "id")
    return both.drop("_part").mapInArrow(run, f"{schema}, {more}")


def _lengths(column: pa.ListArray) -> np.ndarray:
    """Of NULL: -1."""
    return column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)


def _matrix(column: pa.ListArray, lengths: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The vectors of the rows, which all have ``size`` numbers."""
    held = np.maximum(lengths, 0).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False)[(np.cumsum(held) - held)[rows][:, None] + np.arange(size)]


def _top(asked: np.ndarray, items: np.ndarray, k: int, slack: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, item, score) of all pairs that can be among a query's first k; scores add up in the order of ``memory.dot``."""
    slack += 4 * items.shape[1] * np.finfo(float).eps  # a product of matrices adds up in another order
    for lo in range(0, len(asked), STEP):
        some = asked[lo:lo + STEP]
        near = some @ items.T
        least = np.partition(near, -k, axis=1)[:, -k] if len(items) > k else np.full(len(some), -np.inf)
        a, i = np.nonzero(near >= (least - slack)[:, None])
        score = np.empty(len(a))
        for at in range(0, len(a), PAIRS):
            one = slice(at, at + PAIRS)
            score[one] = np.cumsum(some[a[one]] * items[i[one]], axis=1)[:, -1] + 0.0
        order = np.lexsort((i, score, a))  # of equal scores, the k smallest ids do
        a, i, score = a[order], i[order], score[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (score[1:] != score[:-1])
        place = np.arange(len(a))
        keep = place - np.maximum.accumulate(np.where(new, place, 0)) < k
        yield lo + a[keep], i[keep], score[keep]


def nearest(k: int, slack: float) -> Work:
    """(query_id, agent_id, id, score): pairs of a chunk and a block that can be among a query's k highest scores.

    ``score`` is the product of the vectors ``_v``, NULL if one is NULL or their lengths differ. Scores within
    ``slack`` of the k-th are kept too, as rounding can make them equal to it.
    """
    def work(asked: pa.RecordBatch, items: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        def pairs(a: np.ndarray, i: np.ndarray, score: pa.Array) -> pa.RecordBatch:
            a, i = pa.array(a), pa.array(i)
            return pa.record_batch([asked.column("query_id").take(a), asked.column("agent_id").take(a), items.column("id").take(i), score],
                                   ["query_id", "agent_id", "id", "score"])

        def every(queries: np.ndarray, some: np.ndarray, score: float | None) -> Iterator[pa.RecordBatch]:
            """All of one score, so that the first k do."""
            a, i = np.repeat(queries, len(some[:k])), np.tile(some[:k], len(queries))
            if len(a):
                yield pairs(a, i, pa.array([score] * len(a), pa.float64()))

        theirs, lengths = _lengths(asked.column("_v")), _lengths(items.column("_v"))
        for size in np.unique(theirs):
            queries, some = np.flatnonzero(theirs == size), np.flatnonzero((lengths == size) & (size >= 0))
            yield from every(queries, np.flatnonzero((lengths != size) | (size < 0)), None)
            if not len(some):
                continue
            q, u = _matrix(asked.column("_v"), theirs, queries, size), _matrix(items.column("_v"), lengths, some, size)
            odd, strange = np.isnan(q).any(axis=1), np.isnan(u).any(axis=1)
            yield from every(queries[odd], some, float("nan"))
            yield from every(queries[~odd], some[strange], float("nan"))
            queries, some = queries[~odd], some[~strange]
            if len(queries) and len(some):
                for a, i, score in _top(q[~odd], u[~strange], k, slack):
                    yield pairs(queries[a], some[i], pa.array(score))

    return work
