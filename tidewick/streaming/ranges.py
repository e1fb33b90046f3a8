"""Event-time ranges: bars of a stream are worked on once the watermark has passed them.

A feed arrives in any order and in any split into triggers. Each trigger's bars join the held ones; the mark is
the latest time seen minus ``delay``. The held bars up to the mark form a closed range that is worked on with
batch operators, after the last ``keep`` bars of each symbol before it; those and the waiting bars are held on. So
the answer depends on the bars alone, and one symbol's range can span tasks.

A bar at or before the mark of an earlier trigger comes too late: it goes to the ``late`` table and is
not used. A bar that is delivered again while it waits counts once: the delivery with the greatest values,
field by field, stays. Every trigger writes its tables into folders of its own, from those of the trigger
before, so a retried trigger replaces its output and a restarted stream goes on. Folders of old triggers
can be dropped by a retention rule, but for those of the last two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidewick.operators.indicators import CARRIED, averages_before, indicator_panel


class ClosedRanges:
    """A ``foreachBatch`` step; ``finish`` works on what still waits when the feed has ended."""

    def __init__(self, root: str, work: Callable[[DataFrame], DataFrame], *, keep: int, delay: str,
                 key: str = "symbol", time: str = "timestamp"):
        self.root, self.work, self.keep, self.delay, self.key, self.time = root, work, keep, delay, key, time

    def _path(self, name: str, trigger: int) -> str:
        return f"{self.root}/{name}/trigger={trigger}"

    def _read(self, spark: SparkSession, name: str, trigger: int, like: DataFrame) -> DataFrame:
        if trigger < 0:
            return like.limit(0)
        return spark.read.schema(like.schema).parquet(self._path(name, trigger))

    def _mark(self, spark: SparkSession, trigger: int):
        return spark.read.parquet(self._path("mark", trigger)).first()["mark"] if trigger >= 0 else None

    def __call__(self, batch: DataFrame, trigger: int) -> None:
        spark = batch.sparkSession
        before = self._mark(spark, trigger - 1)
        if before is not None:
            late = F.unix_micros(self.time) <= before
            batch.filter(late).write.mode("overwrite").parquet(self._path("late", trigger))
            batch = batch.filter(~late)
        newest = batch.agg(F.unix_micros(F.max(self.time) - F.expr(f"INTERVAL {self.delay}")).alias("mark")).first()["mark"]
        mark = max((x for x in (before, newest) if x is not None), default=None)
        waiting, passed = self._held(spark, trigger - 1, before, batch)
        self._once(waiting.unionByName(batch)).unionByName(passed).write.mode("overwrite").parquet(self._path("held", trigger))
        spark.createDataFrame([(mark,)], "mark long").coalesce(1).write.mode("overwrite").parquet(self._path("mark", trigger))
        if mark is not None and mark != before:
            known = self._read(spark, "held", trigger, batch).filter(F.unix_micros(self.time) <= mark)
            self._close(known, before, trigger, trigger - 1)
        else:
            self._keep_state(spark, trigger, trigger - 1)

    def _held(self, spark: SparkSession, trigger: int, mark: int | None, like: DataFrame) -> tuple[DataFrame, DataFrame]:
        """What a trigger leaves behind: the bars that its mark has not passed, and each symbol's last ones before it."""
        held = self._read(spark, "held", trigger, like)
        if mark is None:
            return held, held.limit(0)
        newest = Window.partitionBy(self.key).orderBy(F.col(self.time).desc())
        passed = held.filter(F.unix_micros(self.time) <= mark).withColumn("_k", F.row_number().over(newest))
        return held.filter(F.unix_micros(self.time) > mark), passed.filter(F.col("_k") <= self.keep).drop("_k")

    def _once(self, bars: DataFrame) -> DataFrame:
        rest = [c for c in bars.columns if c not in (self.key, self.time)]
        kept = F.max(F.struct(*rest)).alias("_kept")
        return bars.groupBy(self.key, self.time).agg(kept).select(
            *[F.col(f"_kept.{c}") if c in rest else F.col(c) for c in bars.columns])

    def _keep_state(self, spark: SparkSession, trigger: int, last: int) -> None:
        """Nothing: what a range needs of the past are the held bars."""

    def _close(self, known: DataFrame, before: int | None, trigger: int, last: int) -> None:
        self._write(self.work(known), before, trigger)

    def _write(self, out: DataFrame, before: int | None, trigger: int) -> None:
        if before is not None:  # the bars before it were held for their values only
            out = out.filter(F.unix_micros(self.time) > before)
        out.write.mode("overwrite").parquet(self._path("out", trigger))

    def finish(self, spark: SparkSession, schema) -> None:
        """Closes the range of all waiting bars; call it once, after the last trigger."""
        triggers = spark.read.option("basePath", f"{self.root}/mark").parquet(f"{self.root}/mark")
        last = triggers.agg(F.max("trigger")).first()[0]
        mark = self._mark(spark, last)
        waiting, passed = self._held(spark, last, mark, spark.createDataFrame([], schema))
        self._close(waiting.unionByName(passed), mark, last + 1, last)

    def results(self, spark: SparkSession) -> DataFrame:
        """The output of all ranges; there is none before the first range has closed."""
        return spark.read.parquet(f"{self.root}/out").drop("trigger")


class CarriedRanges(ClosedRanges):
    """Ranges over the indicator panel, whose averages are carried as a few numbers for each key.

    ``work`` gets the panel of a range and of the ``keep`` bars before it. Without carried numbers the held bars would
    have to cover all that the slowest average remembers.
    """

    def _state(self, spark: SparkSession, trigger: int) -> DataFrame | None:
        if trigger < 0:
            return None
        columns = ", ".join(f"{x} double" for x in CARRIED)
        return spark.read.schema(f"{self.key} string, rows long, {columns}").parquet(self._path("state", trigger))

    def _keep_state(self, spark: SparkSession, trigger: int, last: int) -> None:
        state = self._state(spark, last)
        if state is None:
            columns = ", ".join(f"{x} double" for x in CARRIED)
            state = spark.createDataFrame([], f"{self.key} string, rows long, {columns}")
        state.coalesce(1).write.mode("overwrite").parquet(self._path("state", trigger))

    def _close(self, known: DataFrame, before: int | None, trigger: int, last: int) -> None:
        history = self._state(known.sparkSession, last)
        panel = indicator_panel(known, keys=[self.key], time=self.time, history=history)
        panel.write.mode("overwrite").parquet(self._path("panel", trigger))
        panel = known.sparkSession.read.schema(panel.schema).parquet(self._path("panel", trigger))
        averages_before(panel, history, self.keep, keys=[self.key]).coalesce(1).write.mode("overwrite").parquet(self._path("state", trigger))
        self._write(self.work(panel), before, trigger)
