"""Hard negatives of anchors: the best rows of another label near each positive, by pruned inner products.

Rows are dealt by a hash into groups and anchors into blocks, both of a bounded size; each block of anchors meets
each group once, in a task of its own. A group is cut into buckets of rows of like length, longest first, and a
bucket holds its unit vectors' coordinates as sorted lists. An anchor's threshold (its fifth-best score so far,
or the least score a positive allows) divided by the lengths is a least cosine, which bounds the bucket's
coordinates: for the anchor's largest ones (focus coordinates) the rows inside their ranges are read off the
sorted lists and intersected. What is left is verified by exact integer inner products. A bucket whose longest
row cannot reach the threshold is left out whole; one whose coordinates all lie inside the ranges is verified
as a whole.

Each group passes on its best few rows for an anchor or a positive, and a window takes the best of all.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.llm.common import kept

#: Rows of a group, anchors of a block, rows of a bucket, focus coordinates.
GROUP, BLOCK, BUCKET, FOCUS = 1 << 13, 1 << 11, 1 << 10, 4
#: Rounding errors of cosines and unit coordinates stay below this.
SLACK = 1e-9
_LONG = (1 << 63) - 1


def _whole(x: Column) -> Column:
    """floor(x) as a double; doubles from 2**53 on are whole, and an overflow becomes the largest double."""
    floor = F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double")).otherwise(x)
    return F.greatest(F.least(floor, F.lit(sys.float_info.max)), F.lit(-sys.float_info.max))


def vectors(rows: DataFrame) -> DataFrame:
    """(id, label, vector, _row): rows with a label and finite components, components in whole numbers."""
    scaled = F.transform("embedding", lambda x: _whole(F.lit(256.0) * x.cast("double")))
    sound = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    moved = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    taken = rows.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
    taken = kept(taken.select(F.col("vec_id").cast("bigint").alias("id"), moved.cast("bigint").alias("label"), scaled.alias("vector")), "vectors")
    return taken.withColumn("_row", F.monotonically_increasing_id())  # of a written table: the same in every attempt


def _dealt(count: int, size: int, salt: int) -> tuple[Column, int]:
    parts = max(1, -(-count // size))
    return F.pmod(F.xxhash64("_row", F.lit(salt)), F.lit(parts)).cast("int"), parts


def _matrix(column: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows by dimension: (row numbers, matrix); vectors of different dimensions have no inner product."""
    column = column.combine_chunks()
    sizes, values = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)
    at = column.offsets.to_numpy()[:-1] - column.offsets[0].as_py()
    return [(rows := np.flatnonzero(sizes == d), values[at[rows][:, None] + np.arange(d)]) for d in np.unique(sizes)]


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; those that no 64-bit number holds become the nearest one that does."""
    most = [float(np.abs(x).max(initial=0)) for x in (left, right)]
    if most[0] * most[1] * left.shape[1] < 2.0 ** 53:  # every partial sum is exact in doubles
        return (left @ right.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape) for x in (left, right)]
    return np.array([[max(-_LONG, min(_LONG, sum(a * b for a, b in zip(x, y)))) for y in whole[1]] for x in whole[0]],
                    np.int64).reshape(len(left), len(right))


class Bucket:
    """Rows of like length with the sorted lists of their unit coordinates."""

    def __init__(self, matrix: np.ndarray, lengths: np.ndarray, rows: np.ndarray):
        self.matrix, self.rows = matrix, rows
        self.longest = float(lengths.max())
        unit = matrix / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.order = np.argsort(unit, axis=0)
        self.lists = np.take_along_axis(unit, self.order, axis=0)

    def candidates(self, anchor: np.ndarray, cosine: float, focus: np.ndarray) -> np.ndarray | None:
        """Rows that lie in the ranges of all focus coordinates of a unit anchor; None if all may do."""
        q = anchor[focus]
        away = np.sqrt(max(0.0, 1.0 - cosine * cosine) * np.maximum(0.0, 1.0 - q * q))
        low = np.where(q >= -cosine, q * cosine - away, -1.0) - SLACK
        high = np.where(q <= cosine, q * cosine + away, 1.0) + SLACK
        n, tally, asked = len(self.rows), None, 0
        for f, lo, hi in zip(focus.tolist(), low.tolist(), high.tolist()):
            column = self.lists[:, f]
            if lo <= column[0] and column[-1] <= hi:
                continue
            a, b = np.searchsorted(column, lo, "left"), np.searchsorted(column, hi, "right")
            if tally is None:
                tally = np.zeros(n, np.int8)
            tally[self.order[a:b, f]] += 1
            asked += 1
        return None if tally is None else np.flatnonzero(tally == asked)


def buckets(matrix: np.ndarray) -> list[Bucket]:
    lengths = np.sqrt(np.square(matrix).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    return [Bucket(matrix[part], lengths[part], part) for part in np.split(order, range(BUCKET, len(order), BUCKET))]


class Anchors:
    """Unit anchors with their focus coordinates."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.length = np.sqrt(np.square(matrix).sum(axis=1))
        self.unit = matrix / np.where(self.length > 0, self.length, 1.0)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :FOCUS]

    def verified(self, bucket: Bucket, least: np.ndarray):
        """(anchors, rows of the bucket or None for all, scores) of what may reach the anchors' least scores."""
        reach = self.length * bucket.longest * (1 + SLACK)
        open_ = np.flatnonzero((least <= 0) | (reach >= least))
        pruned = []
        for i in open_.tolist():
            rows = None
            if least[i] > 0:
                rows = bucket.candidates(self.unit[i], min(1.0, least[i] / reach[i]), self.focus[i])
            if rows is not None:
                pruned.append(i)
                if len(rows):
                    yield np.array([i]), rows, exact_products(self.matrix[i:i + 1], bucket.matrix[rows])
        whole = np.setdiff1d(open_, pruned)
        if len(whole):
            yield whole, None, exact_products(self.matrix[whole], bucket.matrix)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by (score falling, id rising)."""
    if len(scores) > 8 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers for comparison; a missing one comes last."""
    return column.fill_null(_LONG).to_numpy()


def _positives(anchors: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    out = []
    if anchors.num_rows and rows.num_rows:
        label, own, ids = (rows.column(x).to_numpy() for x in ("label", "_row", "_row"))
        ids = _ids(rows.column("id"))
        a_label, a_row = anchors.column("label").to_numpy(), anchors.column("_row").to_numpy()
        by_size = {m.shape[1]: (n, m) for n, m in _matrix(rows.column("vector"))}
        for a_number, a_matrix in _matrix(anchors.column("vector")):
            number, matrix = by_size.get(a_matrix.shape[1], (None, None))
            if number is None:
                continue
            for value in np.unique(a_label[a_number]).tolist():  # rows of one label have lists of their own
                mine, theirs = a_number[a_label[a_number] == value], number[label[number] == value]
                if len(theirs):
                    out += _best_of(Anchors(a_matrix[a_label[a_number] == value]), mine, matrix[label[number] == value], theirs,
                                    a_row, own, ids, k)
    return pa.table([anchors.column("_row").take(pa.array([x for x, _, _ in out], pa.int64())) if out else pa.array([], pa.int64()),
                     rows.column("id").take(pa.array([y for _, y, _ in out], pa.int64())) if out else pa.array([], pa.int64()),
                     rows.column("_row").take(pa.array([y for _, y, _ in out], pa.int64())) if out else pa.array([], pa.int64()),
                     pa.array([s for _, _, s in out], pa.int64())], ["anchor_row", "positive_id", "positive_row", "positive_score"])


def _best_of(anchors: Anchors, mine: np.ndarray, matrix: np.ndarray, theirs: np.ndarray, a_row: np.ndarray, own: np.ndarray,
             ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(anchor, row, score) of the k best rows of each anchor, itself aside."""
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(mine)
    least = np.full(len(mine), -np.inf)
    for bucket in buckets(matrix):
        for some, part, scores in anchors.verified(bucket, least):
            numbers = theirs[bucket.rows if part is None else bucket.rows[part]]
            for i, found in zip(some.tolist(), scores):
                at = np.flatnonzero((found >= least[i]) & (own[numbers] != a_row[mine[i]]))
                number, score = np.append(best[i][0], numbers[at]), np.append(best[i][1], found[at])
                top = _best(score, ids[number], k)
                best[i] = number[top], score[top]
                if len(top) == k:
                    least[i] = score[top[-1]]
    return [(int(mine[i]), int(n), int(s)) for i, pair in enumerate(best) for n, s in zip(*pair)]


def _negatives(wanted: pa.Table, rows: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """The k best rows of another label within each positive's scores; ``wanted`` has a row for each positive."""
    out = []
    if wanted.num_rows and rows.num_rows:
        label, ids = rows.column("label").to_numpy(), _ids(rows.column("id"))
        w_label, w_row, w_score = (wanted.column(x).to_numpy() for x in ("label", "anchor_row", "positive_score"))
        by_size = {m.shape[1]: (n, m) for n, m in _matrix(rows.column("vector"))}
        for w_number, w_matrix in _matrix(wanted.column("vector")):
            number, matrix = by_size.get(w_matrix.shape[1], (None, None))
            if number is None:
                continue
            _, first, group = np.unique(w_row[w_number], return_index=True, return_inverse=True)
            mine = [w_number[group == i] for i in range(len(first))]
            # The least whole score that some positive of the anchor allows; no score fits a negative positive.
            floors = np.array([min(-(-low * int(s) // 100) if s >= 0 else _LONG for s in w_score[x]) for x in mine], float)
            usable = np.flatnonzero(floors < float(_LONG))
            anchors, best = Anchors(w_matrix[first[usable]]), {}
            for bucket in buckets(matrix):
                for some, part, scores in anchors.verified(bucket, floors[usable] * (1 - SLACK)):
                    numbers = number[bucket.rows if part is None else bucket.rows[part]]
                    for i, found in zip(some.tolist(), scores):
                        positives = mine[usable[i]]
                        fit = np.flatnonzero((found >= floors[usable[i]] * (1 - SLACK)) & (label[numbers] != w_label[positives[0]]))
                        near, score = numbers[fit], found[fit]
                        for p in positives.tolist():
                            s = int(w_score[p])
                            # 100 * score may pass 64 bits, so the bounds are divided: whole scores from a on, up to b.
                            a, b = -(-low * s // 100), high * s // 100
                            at = np.flatnonzero((score >= a) & (score <= b))
                            n0, s0 = best.get(p, (near[:0], score[:0]))
                            n1, s1 = np.append(n0, near[at]), np.append(s0, score[at])
                            top = _best(s1, ids[n1], k)
                            best[p] = n1[top], s1[top]
            out += [(p, int(n), int(s)) for p, pair in best.items() for n, s in zip(*pair)]
    number = pa.array([x for x, _, _ in out], pa.int64())
    taken = [wanted.column(x).take(number) for x in ("anchor_row", "positive_row")]
    return pa.table([*taken, rows.column("id").take(pa.array([y for _, y, _ in out], pa.int64())),
                     rows.column("_row").take(pa.array([y for _, y, _ in out], pa.int64())),
                     pa.array([s for _, _, s in out], pa.int64())],
                    ["anchor_row", "positive_row", "negative_id", "negative_row", "negative_score"])


def _met(anchors: DataFrame, rows: DataFrame, blocks: int, groups: int, work, schema: str) -> DataFrame:
    """``work`` on each block of anchors with each group of rows; both sides of a task are bounded."""
    left = anchors.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return left.groupBy("_block", "_group").cogroup(right.groupBy("_block", "_group")).applyInArrow(
        lambda key, a, b: work(a, b), schema)


def hard_negatives(rows: DataFrame, *, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80,
                   high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose vec_id is divisible by ``every``; their positives the ``positives`` other rows of
    their label with the highest scores; and for each, the ``negatives`` highest of the rows of another label whose
    score is ``low`` to ``high`` percent of the positive's. Ties go to the smaller vec_id. A negative positive score
    allows none, a zero one allows zero.

    Rows with a null label or vector, or a null or non-finite component, take no part. A row without a vec_id is
    no anchor and loses ties. Repeated rows are rows of their own: another row with an anchor's vec_id may be its
    positive. Vectors of different dimensions never meet. Scores beyond 64 bits become the nearest 64-bit number.
    An empty table gives no rows; other columns are ignored.
    """
    table = vectors(rows)
    is_anchor = F.coalesce(F.col("id") % every == 0, F.lit(False))
    counted = table.agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_anchor).alias("anchors")).first()
    group, groups = _dealt(counted["rows"], GROUP, 1)
    block, blocks = _dealt(counted["anchors"], BLOCK, 2)
    dealt = table.withColumn("_group", group)
    anchors = table.filter(is_anchor).withColumn("_block", block)

    found = _met(anchors, dealt, blocks, groups, lambda a, b: _positives(a, b, positives),
                 "anchor_row long, positive_id long, positive_row long, positive_score long")
    first = Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "positive_row")
    best = found.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= positives).drop("_n")
    best = kept(anchors.withColumnRenamed("_row", "anchor_row").join(best, "anchor_row"), "positives")

    wanted = best.select("anchor_row", "positive_row", "label", "vector", "positive_score", "_block")
    near = _met(wanted, dealt, blocks, groups, lambda a, b: _negatives(a, b, negatives, low, high),
                "anchor_row long, positive_row long, negative_id long, negative_row long, negative_score long")
    order = Window.partitionBy("anchor_row", "positive_row").orderBy(
        F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative_row")
    near = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return best.drop("vector").join(near, ["anchor_row", "positive_row"]).select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
