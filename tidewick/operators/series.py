"""Ordered series without one-task-per-key windows.

A key (symbol, account) may own any share of the rows, so no window here is partitioned by the key
alone. Rows are grouped into calendar buckets; the bucket table (one row per key and bucket) carries
the running totals, and the detail rows are windowed per bucket or per block of buckets.

Keys, order columns and buckets must not be NULL (drop or fill them first). ``bucket`` must not
decrease along the order; choose it so that one key's rows of one bucket fit a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.session import written

BLOCK_ROWS = 16384
HALO_ROWS = 4096


def _bucket_table(df: DataFrame, keys: Sequence[str], bucket: Column,
                  aggs: Sequence[Column]) -> DataFrame:
    return df.groupBy(*keys, bucket.alias("_bucket")).agg(*aggs)


def _before(keys: Sequence[str]) -> Window:
    return (Window.partitionBy(*keys).orderBy("_bucket")
            .rowsBetween(Window.unboundedPreceding, -1))


def day_of(time: str) -> Column:
    return F.date_trunc("day", F.col(time))


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], *,
                bucket: Column, name: str = "pos") -> DataFrame:
    """0-based position of each row in its key's order.

    Costs one small aggregation and one shuffle on (keys, bucket).
    """
    counts = _bucket_table(df, keys, bucket, [F.count(F.lit(1)).alias("_n")])
    counts = written(counts, "bucket-counts")
    base = counts.select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(_before(keys)), F.lit(0)).alias("_base"))
    local = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    joined = df.withColumn("_bucket", bucket).join(base, [*keys, "_bucket"])
    return (joined.withColumn(name, F.col("_base") + F.row_number().over(local) - 1)
            .drop("_bucket", "_base"))


def ranges_of(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with ``_range``: rows are dealt into ranges of the order, whose ends Spark samples, and written.

    Written, because ranges that are sampled again could end elsewhere. Ranges are even whatever the values'
    distribution; rows that agree in all columns of the order share one.
    """
    return written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")


def global_positions(df: DataFrame, order: Sequence[str], *, name: str = "pos") -> DataFrame:
    """0-based position over the whole table in the given order, plus the table size ``_total``.

    Needs no bucket: a position is the rows of all earlier ranges plus the place in its range. Rows that agree in
    all columns of the order may take their places in any order.
    """
    ranged = ranges_of(df, order)
    counts = written(ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")), "range-counts")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task
    base = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
                         F.sum("_n").over(Window.partitionBy()).alias("_total"))
    local = Window.partitionBy("_range").orderBy(*order)
    return (ranged.join(base, "_range").withColumn(name, F.col("_base") + F.row_number().over(local) - 1)
            .drop("_range", "_base"))


def blocked(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, bucket: Column,
            rows_per_block: int = BLOCK_ROWS, halo: int = HALO_ROWS) -> DataFrame:
    """Cut each series into blocks that also hold (at least) the ``halo`` rows before them.

    Adds ``_blk``, ``_own`` (false on copied rows) and ``pos``. Whole buckets go to a block, chosen
    from the bucket table's running row counts, so the detail is shuffled once, on (keys, _blk).
    A bucket is copied to every block that starts within ``halo`` rows of its end.
    """
    counts = written(_bucket_table(df, keys, bucket, [F.count(F.lit(1)).alias("_n")]),
                     "bucket-counts")
    base = F.coalesce(F.sum("_n").over(_before(keys)), F.lit(0))
    blocks = counts.select(*keys, "_bucket", "_n", base.alias("_base")).select(
        *keys, "_bucket", "_base",
        F.expr(f"_base div {rows_per_block}").alias("_home"),
        F.expr(f"(_base + _n - 1 + {halo}) div {rows_per_block}").alias("_last"))
    spread = (df.withColumn("_bucket", bucket)
              .join(blocks, [*keys, "_bucket"])
              .withColumn("_blk", F.explode(F.sequence("_home", "_last")))
              .withColumn("_own", F.col("_blk") == F.col("_home")))
    w = Window.partitionBy(*keys, "_blk").orderBy(*order)
    return (spread.withColumn("pos", F.first("_base").over(w) + F.row_number().over(w) - 1)
            .drop("_bucket", "_base", "_home", "_last"))


def block_window(keys: Sequence[str], order: Sequence[str] = ("pos",)) -> Window:
    return Window.partitionBy(*keys, "_blk").orderBy(*order)


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  values: dict[str, Column], *, bucket: Column) -> DataFrame:
    """Inclusive running sums over each key's whole order: bucket totals first, then local sums."""
    totals = written(_bucket_table(df, keys, bucket, [v.alias(n) for n, v in _sums(values)]),
                     "bucket-totals")
    base = totals.select(*keys, "_bucket", *[
        F.coalesce(F.sum(n).over(_before(keys)), F.lit(0)).alias(f"_b_{n}") for n in values])
    local = (Window.partitionBy(*keys, "_bucket").orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, 0))
    joined = df.withColumn("_bucket", bucket).join(base, [*keys, "_bucket"])
    return (joined.withColumns({n: F.col(f"_b_{n}") + F.sum(v).over(local)
                                for n, v in values.items()})
            .drop("_bucket", *[f"_b_{n}" for n in values]))


def _sums(values: dict[str, Column]):
    return [(n, F.sum(v)) for n, v in values.items()]
