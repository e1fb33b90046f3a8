"""Row keys and helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewick.session import scratch_path

#: Pseudo numbers of rows without a doc_id start here, so they come after every ordinary doc_id.
NO_ID = 1 << 62


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def order_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """doc_id; for a row without one, a number from its text that is larger than any doc_id."""
    pseudo = F.xxhash64(F.col(text)).bitwiseAND(NO_ID - 1) + F.lit(NO_ID)
    return F.coalesce(F.col(doc_id).cast("bigint"), pseudo)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """One number for a (doc_id, text) pair; rows that agree in both are treated alike."""
    return F.xxhash64(F.col(doc_id).cast("bigint"), F.col(text).isNull(), F.col(text))


def rows_with(df: DataFrame, keys: DataFrame, how: str, key: Column) -> DataFrame:
    """``df`` joined to the one column of ``keys`` by ``key``: 'left_semi' or 'left_anti'; any column names may be taken."""
    whole = df.select(F.struct("*").alias("_whole"), key.alias("_of_row"))
    return whole.join(keys.toDF("_of_row"), "_of_row", how)


#: Drops the shuffle files of an execution when it ends; a written table has no need of them.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts lineage, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _cleaned(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``kept``, in buckets of ``key``: later joins on it move the other side only."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = re.sub("[^0-9a-z]", "_", path.rsplit("/", 1)[-1].lower())
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _cleaned(spark):
        df.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)
