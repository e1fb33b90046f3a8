"""Stored tables that change in part: rows by key in buckets, and series that are appended to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewick.operators.memory import upsert_latest

_SETTINGS = "_settings"


# --- rows by key ---------------------------------------------------------------------------------

class KeyedStore:
    """One row per key, the newest version, in a folder of Parquet buckets by a hash of the key.

    ``upsert`` replaces the buckets that its rows fall into and no others. ``append`` adds files beside them, for
    many small changes; ``read`` merges what a bucket's files say, and ``compact`` folds the buckets that have many.
    A key's rows are in one bucket, and a bucket holds one row per key when folded, so buckets are even. There is one
    writer at a time; replaced buckets are moved into place when all are written.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        row = spark.read.json(f"{path}/{_SETTINGS}").first()
        self.key, self.version, self.buckets = list(row["key"]), row["version"], row["buckets"]
        self.schema = f"{row['columns']}, bucket int"

    @classmethod
    def create(cls, rows: DataFrame, path: str, key: Sequence[str], version: str, buckets: int = 256) -> KeyedStore:
        """Choose ``buckets`` so that one fits a task when the store is at its largest."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        settings = rows.sparkSession.createDataFrame([(list(key), version, buckets, columns)],
                                                     "key array<string>, version string, buckets int, columns string")
        settings.coalesce(1).write.json(f"{path}/{_SETTINGS}")
        store = cls(rows.sparkSession, path)
        store._replace(upsert_latest(store._placed(rows), store._placed(rows.limit(0)), [*store.key, "bucket"], version))
        return store

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))

    def _files(self) -> DataFrame:
        """The stored rows of all files, with their bucket."""
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _replace(self, rows: DataFrame) -> None:
        (rows.repartition("bucket").sortWithinPartitions("bucket", *self.key).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path))

    def upsert(self, incoming: DataFrame) -> list[int]:
        """Rewrites the buckets of the incoming rows, whose numbers it returns; of equal versions the incoming wins."""
        incoming = self._placed(incoming)
        touched = sorted(r[0] for r in incoming.select("bucket").distinct().collect())  # at most ``buckets`` numbers
        if touched:
            stored = self._files().filter(F.col("bucket").isin(touched))
            self._replace(upsert_latest(stored, incoming, [*self.key, "bucket"], self.version))
        return touched

    def append(self, incoming: DataFrame) -> None:
        """Adds rows as files of their buckets; of versions that are equal in one key, any may stay."""
        (self._placed(incoming).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(self.path))

    def read(self) -> DataFrame:
        """One row per key, whatever was appended."""
        rows = self._files()
        return upsert_latest(rows, rows.limit(0), [*self.key, "bucket"], self.version).drop("bucket")

    def file_counts(self) -> DataFrame:
        """(bucket, files), from a listing."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{self.path}/bucket=*")
        bucket = F.regexp_extract("path", "/bucket=([0-9]+)/", 1).cast("int").alias("bucket")
        return files.groupBy(bucket).agg(F.count(F.lit(1)).alias("files"))

    def compact(self, most: int = 1) -> list[int]:
        """Folds the buckets that have more than ``most`` files into one file each; returns their numbers."""
        many = sorted(r[0] for r in self.file_counts().filter(F.col("files") > most).select("bucket").collect())
        if many:
            rows = self._files().filter(F.col("bucket").isin(many))
            self._replace(upsert_latest(rows, rows.limit(0), [*self.key, "bucket"], self.version))
        return many


# --- series --------------------------------------------------------------------------------------

class SeriesStore:
    """A series by key that grows at its end, one folder for each load, with the last times of each load beside it.

    An append reads these summaries, not the series. A load whose summary is missing, as after a failure between the
    two, is summarised from its own files at the next append.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "product_id", time: str = "timestamp"):
        self.spark, self.path, self.key, self.time = spark, path, key, time
        self.schema = f"{schema}, load long"

    def _loads(self, folder: str) -> DataFrame:
        """Numbers of the loads below a folder, from a listing."""
        reader = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        number = F.regexp_extract("path", "/load=([0-9]+)/", 1).try_cast("long").alias("load")
        return reader.load(folder).select(number).filter("load IS NOT NULL").distinct()

    def _data(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _summarise(self, load: int) -> None:
        rows = self._data().filter(F.col("load") == load)
        last = rows.groupBy(self.key).agg(F.max(self.time).alias("last"))
        last.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_last/load={load}")

    def create(self) -> SeriesStore:
        """An empty series: load 0 has no rows."""
        self._data_frame().write.parquet(f"{self.path}/load=0")
        self._summarise(0)
        return self

    def _data_frame(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema).drop("load")

    def last_times(self) -> DataFrame:
        """(key, last) over all loads, from the summaries alone."""
        kind = self._data_frame().schema
        schema = f"`{self.key}` {kind[self.key].dataType.simpleString()}, last {kind[self.time].dataType.simpleString()}, load long"
        return self.spark.read.schema(schema).parquet(f"{self.path}/_last").groupBy(self.key).agg(F.max("last").alias("last"))

    def append(self, incoming: DataFrame) -> int:
        """Adds the rows that are later than the last of their key, as one more load, whose number it returns."""
        loads = self._loads(self.path)
        for row in loads.join(self._loads(f"{self.path}/_last"), "load", "left_anti").collect():  # at most one, after a failure
            self._summarise(row["load"])
        number = (loads.agg(F.max("load")).first()[0] or 0) + 1
        last = self.last_times().withColumnRenamed("last", "_last")
        new = incoming.join(last, self.key, "left").filter(F.col("_last").isNull() | (F.col(self.time) > F.col("_last"))).drop("_last")
        new.write.parquet(f"{self.path}/load={number}")
        self._summarise(number)
        return number

    def read(self) -> DataFrame:
        return self._data().drop("load")
