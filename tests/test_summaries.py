"""Sketches of chunks that merge."""

from pyspark.sql import functions as F

from tidewick.sources import summaries


def test_merged_counts_and_error(spark, tmp_path):
    path = str(tmp_path / "chunks")
    df = spark.range(40000).select("id", (F.col("id") % 700).cast("string").alias("some"), F.lit("x").alias("one"),
                                   F.when(F.col("id") % 4 > 0, F.col("id") / 8).alias("part"), F.array("id").alias("list"))
    df.filter("id < 30000").repartition(3).write.parquet(path)
    summaries.add_summaries(spark, path)
    first = {r.column: r for r in summaries.merged(spark, path).collect()}
    assert set(first) == {"id", "some", "one", "part"} and first["id"].chunks == 3 and first["id"].rows == 30000
    df.filter("id >= 30000").coalesce(1).write.mode("append").parquet(path)
    summaries.add_summaries(spark, path)
    summaries.add_summaries(spark, path)  # nothing new: nothing counted twice
    got = {r.column: r for r in summaries.merged(spark, path).collect()}
    for column, exact in (("id", 40000), ("some", 700), ("one", 1), ("part", 30000)):
        assert abs(got[column].distinct / exact - 1) < 0.05 and got[column].rows == 40000 and got[column].chunks == 4
    assert got["part"].present == 30000
    assert {r.column for r in summaries.low_cardinality(spark, path).filter("low_cardinality").collect()} == {"some", "one"}
    assert all("/_summaries/" in f for f in summaries.merged(spark, path).inputFiles())
    assert spark.read.parquet(path).count() == 40000


def test_empty_dataset(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.range(0).write.parquet(path)
    summaries.add_summaries(spark, path, ["id"])
    assert summaries.merged(spark, path).collect() == []
