"""A reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered by a hash of (doc_id, text); equal pairs are counted first and numbered as a run. The
numbers come from bucket counts, so no task sees all rows. A generalised Feistel network permutes a
rectangle a x b that holds the n numbers with fewer than a to spare; a number that leaves the range walks
on along its cycle until it is back. Shard and slot are remainder and quotient of the permuted number, so
they can be computed from the row number alone, and shard sizes differ by one row at most.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.llm.common import kept, row_key

ROUNDS = 6
#: Distinct rows that one bucket numbers.
BUCKET = 20_000


def _network(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the permutation of 0 .. a * b - 1."""
    def turn(state: Column, i: Column) -> Column:
        left, right = state["left"], state["right"]
        hop = F.xxhash64(F.lit(seed), i, F.when(i % 2 == 0, right).otherwise(left))
        return F.struct(
            F.when(i % 2 == 0, F.pmod(left + F.pmod(hop, F.lit(a)), F.lit(a))).otherwise(left).alias("left"),
            F.when(i % 2 == 1, F.pmod(right + F.pmod(hop, F.lit(b)), F.lit(b))).otherwise(right).alias("right"))

    state = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
                        F.struct(_div(x, b).alias("left"), F.pmod(x, F.lit(b)).alias("right")), turn)
    return state["left"] * F.lit(b) + state["right"]


def _div(x: Column, by: int) -> Column:
    return F.call_function("div", x, F.lit(by))


def permuted(x: Column, n: int, seed: int = 1) -> Column:
    """A permutation of 0 .. n - 1 applied to ``x``.

    The numbers outside the range are fewer than the rectangle's side, so no walk is longer than that;
    only the rows that leave the range walk.
    """
    if n <= 1:
        return F.lit(0).cast("bigint") + x * 0
    a = isqrt(n - 1) + 1
    b = -(-n // a)
    first = _network(x.cast("bigint"), a, b, seed)
    spare = a * b - n
    if spare == 0:
        return first
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(spare)), first,
                       lambda y, _: F.when(y < n, y).otherwise(_network(y, a, b, seed)))
    return F.when(first < n, first).otherwise(walk)


def shards(docs: DataFrame, count: int = 40, seed: int = 1) -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), number, shard, slot and grown_shard (null) of every row.

    Size is the text's UTF-8 bytes plus 16. A null text is empty; rows without a doc_id and repeated rows
    are placed like any other, and rows that agree in doc_id and text are interchangeable. The same rows
    get the same places whatever the files or partitions they come from. An empty table gives no rows;
    other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), row_key().alias("_hash"))
    same = ["_hash", "doc_id", "size", "text_crc32"]
    rows = kept(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("_copies")), "shard-rows")
    n, distinct = rows.agg(F.coalesce(F.sum("_copies"), F.lit(0)), F.count(F.lit(1))).first()
    bits = max(0, (distinct // BUCKET).bit_length())
    bucket = F.shiftrightunsigned("_hash", 64 - bits) if bits else F.lit(0).cast("bigint")
    rows = rows.withColumn("_bucket", bucket)
    totals = rows.groupBy("_bucket").agg(F.sum("_copies").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_bucket").orderBy(*same).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(starts, "_bucket")
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)).alias("_copy")
    rows = rows.select(*same, (F.col("_start") + F.col("_before")).alias("_first"), copy)
    rows = rows.withColumn("number", F.col("_first") + F.col("_copy"))
    place = rows.withColumn("_place", permuted(F.col("number"), int(n), seed))
    return place.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "number",
        F.pmod("_place", F.lit(count)).cast("int").alias("shard"), _div(F.col("_place"), count).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
