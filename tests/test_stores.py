"""Stored tables that change in part."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidewick.sources.stores import KeyedStore, SeriesStore

SCHEMA = "id string, v int, t int"


def _files(path, sub="bucket="):
    return {f"{d}/{x}": os.stat(f"{d}/{x}").st_mtime_ns for d, _, names in os.walk(path) for x in names if sub in d and x.endswith(".parquet")}


def test_only_touched_buckets_change(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [(f"k{i}", i, 1) for i in range(200)]
    store = KeyedStore.create(spark.createDataFrame(rows, SCHEMA), path, ["id"], "t", buckets=16)
    before = _files(path)
    assert len(before) == 16
    touched = store.upsert(spark.createDataFrame([("k3", 1000, 2), ("new", 1, 1), ("k5", 1, 0), ("k7", 77, 1)], SCHEMA))
    after = _files(path)
    changed = {int(f[0].split("bucket=")[1].split("/")[0]) for f in set(before.items()) ^ set(after.items())}
    assert changed == set(touched) and 1 <= len(touched) <= 4 and len(after) == 16
    want = {k: v for k, v, _ in rows} | {"k3": 1000, "new": 1, "k7": 77}
    assert {r.id: r.v for r in store.read().collect()} == want and store.read().count() == 201
    assert store.upsert(spark.createDataFrame([], SCHEMA)) == [] and _files(path) == after
    assert {r.id: r.v for r in KeyedStore(spark, path).read().collect()} == want  # settings are stored


def test_appends_are_merged_and_folded(spark, tmp_path):
    path, rng, want = str(tmp_path / "store"), random.Random(3), {}
    store = KeyedStore.create(spark.createDataFrame([], SCHEMA), path, ["id"], "t", buckets=4)
    assert store.read().count() == 0
    for t in range(1, 6):
        batch = {f"k{rng.randint(0, 30)}": rng.randint(0, 99) for _ in range(15)}
        want |= batch
        (store.append if t % 2 else store.upsert)(spark.createDataFrame([(k, v, t) for k, v in batch.items()], SCHEMA))
        assert {r.id: r.v for r in store.read().collect()} == want
    many = {r.bucket for r in store.file_counts().collect() if r.files > 1}
    assert many and set(store.compact()) == many and store.compact() == []
    assert all(r.files == 1 for r in store.file_counts().collect())
    assert {r.id: r.v for r in store.read().collect()} == want


def test_two_column_keys_and_nulls(spark, tmp_path):
    schema = "a string, b int, t int, tags array<string>"
    store = KeyedStore.create(spark.createDataFrame([("x", 1, 1, ["p"]), (None, 1, 1, None)], schema), str(tmp_path / "s"), ["a", "b"], "t", 3)
    store.upsert(spark.createDataFrame([(None, 1, 2, ["q"]), ("x", 2, 1, [])], schema))
    assert sorted(map(tuple, store.read().collect()), key=repr) == sorted([("x", 1, 1, ["p"]), (None, 1, 2, ["q"]), ("x", 2, 1, [])], key=repr)


def _series(spark, rows):
    return spark.createDataFrame(rows, "product_id string, timestamp long, x int").withColumn("timestamp", F.timestamp_seconds("timestamp"))


def test_series_appends_read_summaries_only(spark, tmp_path):
    path = str(tmp_path / "series")
    store = SeriesStore(spark, path, "product_id string, timestamp timestamp, x int").create()
    assert store.append(_series(spark, [("A", 10, 1), ("A", 20, 2), ("B", 5, 3)])) == 1
    assert store.append(_series(spark, [("A", 20, 9), ("A", 30, 4), ("B", 5, 9), ("C", 1, 5)])) == 2
    assert store.append(_series(spark, [("A", 30, 9)])) == 3  # nothing new
    assert store.append(_series(spark, [("A", 25, 9), ("B", 6, 6)])) == 4
    assert sorted(r.x for r in store.read().collect()) == [1, 2, 3, 4, 5, 6]
    assert all("/_last/" in f for f in store.last_times().inputFiles())
    scanned = _series(spark, []).unionByName(store.read()).groupBy("product_id").agg(F.max("timestamp").alias("last"))
    assert sorted(map(tuple, store.last_times().collect())) == sorted(map(tuple, scanned.collect()))


def test_series_after_a_failure(spark, tmp_path):
    """A load that was written but not summarised counts at the next append."""
    path = str(tmp_path / "series")
    store = SeriesStore(spark, path, "product_id string, timestamp timestamp, x int").create()
    store.append(_series(spark, [("A", 10, 1)]))
    _series(spark, [("A", 40, 2)]).write.parquet(f"{path}/load=2")
    assert store.append(_series(spark, [("A", 30, 9), ("A", 41, 3)])) == 3
    assert sorted(r.x for r in store.read().collect()) == [1, 2, 3]
