"""As-of joins against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from tidewick.operators.asof import as_of

BASE, FEED = "symbol string, timestamp timestamp, close double", "symbol string, timestamp timestamp, id long, price double"


def _times(spark, rows, schema):
    names = [x.split()[0] for x in schema.split(", ")]
    raw = schema.replace("timestamp timestamp", "timestamp long")
    return spark.createDataFrame(rows, raw).withColumn("timestamp", F.timestamp_seconds("timestamp")).select(*names)


def _plain(base, feeds, n):
    out = []
    for symbol, at, close in base:
        lists = []
        for rows in feeds:
            fit = sorted((t, i) for s, t, i, _ in rows if symbol is not None and at is not None and s == symbol and t is not None and t <= at)
            lists.append(tuple(i for _, i in fit[-n:]))
        out.append((symbol, at, close, *lists))
    return sorted(out, key=repr)


def _got(df):
    rows = df.select("symbol", F.unix_timestamp("timestamp").alias("at"), "close", F.transform("quotes", lambda x: x["id"]).alias("q"),
                     F.transform("trades", lambda x: x["id"]).alias("t")).collect()
    return sorted(((r.symbol, r.at, r.close, tuple(r.q), tuple(r.t)) for r in rows), key=repr)


@pytest.mark.parametrize("n,rows_per_block", [(1, 20), (3, 20), (4, 7), (3, 100000)])
def test_against_loops(spark, n, rows_per_block):
    """One symbol over many blocks; a dense feed, a rare one, rows without a key or time."""
    rng = random.Random(n * rows_per_block)
    base = [(rng.choice("AAAB"), rng.randint(0, 4000), float(i)) for i in range(150)] + [("C", 5, 0.0), (None, 7, 1.0), ("A", None, 2.0)]
    quotes = [(rng.choice("AAAB"), rng.randint(500, 4000), i, 1.0) for i in range(300)] + [(None, 3, 900, 1.0), ("A", None, 901, 1.0)]
    trades = [("A", rng.choice([600, 610, 3900]), i, 1.0) for i in range(9)] + [("B", 100, 50, 1.0)]
    got = as_of(_times(spark, base, BASE), {"quotes": _times(spark, quotes, FEED), "trades": _times(spark, trades, FEED)}, n=n,
                ties={"quotes": ["id"], "trades": ["id"]}, rows_per_block=rows_per_block)
    assert _got(got) == _plain(base, [quotes, trades], n)


def test_one_symbol_runs_in_many_tasks(spark):
    base = [("A", i * 60, 1.0) for i in range(2000)]
    feed = _times(spark, [("A", i * 60 + 1, i, 1.0) for i in range(2000)], FEED)
    df = as_of(_times(spark, base, BASE), {"quotes": feed, "trades": feed.limit(0)}, n=2, rows_per_block=200)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() >= 4
    finally:
        spark.conf.set(coalesce, before)
    rows = df.select(F.size("quotes").alias("q"), F.size("trades").alias("t")).groupBy("q", "t").count().collect()
    assert {(r.q, r.t): r["count"] for r in rows} == {(0, 0): 1, (1, 0): 1, (2, 0): 1998}


def test_empty_tables(spark):
    base, feed = _times(spark, [("A", 1, 1.0)], BASE), _times(spark, [("A", 1, 1, 1.0)], FEED)
    assert _got(as_of(base.limit(0), {"quotes": feed, "trades": feed}, n=2)) == []
    assert _got(as_of(base, {"quotes": feed.limit(0), "trades": feed}, n=2)) == [("A", 1, 1.0, (), (1,))]
