"""Positions, blocks and running totals against brute force on a skewed key."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewick.operators.performance import (backtest_performance, continuity_check, drawdown,
                                            next_trade_exit, performance_metrics)
from tidewick.operators.series import (blocked, day_of, global_positions, number_rows, ranges_of,
                                       running_total)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 4000
    key = np.where(rng.random(n) < 0.6, "hot", rng.choice(list("abcd"), n))
    pdf = pd.DataFrame({
        "k": key, "id": np.arange(n),
        "timestamp": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 40, n) * 7, "h"),
        "pnl": rng.normal(0, 10, n).round(3)})
    return pdf, spark.createDataFrame(pdf).cache()


def test_number_rows(rows):
    pdf, df = rows
    got = number_rows(df, ["k"], ["timestamp", "id"], bucket=day_of("timestamp")).toPandas()
    want = pdf.sort_values(["timestamp", "id"])
    want["pos"] = want.groupby("k").cumcount()
    merged = got.merge(want, on="id")
    assert (merged.pos_x == merged.pos_y).all() and len(merged) == len(pdf)


def test_global_positions(rows):
    pdf, df = rows
    got = global_positions(df, ["k", "timestamp", "id"]).toPandas()
    want = pdf.sort_values(["k", "timestamp", "id"]).reset_index(drop=True).reset_index()
    merged = got.merge(want, on="id")
    assert (merged.pos == merged["index"]).all() and (got._total == len(pdf)).all()


@pytest.mark.parametrize("block,halo", [(64, 16), (300, 100), (17, 40)])
def test_blocks_hold_their_halo(rows, block, halo):
    """Also where one bucket is longer than a block and the halo spans several."""
    pdf, df = rows
    got = blocked(df, ["k"], ["timestamp", "id"], bucket=day_of("timestamp"),
                  rows_per_block=block, halo=halo).toPandas()
    own = got[got._own]
    assert len(own) == len(pdf)
    ordered = pdf.sort_values(["timestamp", "id"])
    for (k, _), g in got.groupby(["k", "_blk"]):
        if not g._own.any():
            continue
        first_own = g[g._own].pos.min()
        assert g.pos.min() <= max(0, first_own - halo)
        g = g.sort_values("pos")
        assert (np.diff(g.pos) == 1).all()
        whole = ordered[ordered.k == k].id.to_numpy()
        assert (whole[g.pos.to_numpy()] == g.id.to_numpy()).all()


def test_running_total(rows):
    pdf, df = rows
    got = running_total(df, ["k"], ["timestamp", "id"], {"cum": F.col("pnl"), "n": F.lit(1)},
                        bucket=day_of("timestamp")).toPandas().set_index("id")
    want = pdf.sort_values(["timestamp", "id"]).set_index("id")
    assert np.allclose(got.loc[want.index].cum, want.groupby("k").pnl.cumsum())
    assert (got.loc[want.index].n == want.groupby("k").cumcount() + 1).all()


def _drawdown(pnls):
    total = peak = worst = 0.0
    for p in pnls:
        total += p
        peak = max(peak, total)
        worst = max(worst, peak - total)
    return worst, (worst / max(peak, 1) * 100 if peak > 0 else 0.0)


def test_drawdown(rows):
    pdf, df = rows
    got = drawdown(df, ["k"], ["timestamp", "id"], bucket=day_of("timestamp")).toPandas()
    for r in got.itertuples():
        g = pdf[pdf.k == r.k].sort_values(["timestamp", "id"])
        assert np.allclose((r.max_drawdown, r.max_drawdown_pct), _drawdown(g.pnl))


def test_metrics_by_hand(spark):
    """Three trades worked through on paper."""
    df = spark.createDataFrame([("x", "2024-01-01 10:00:00", 1, 100.0),
                                ("x", "2024-01-01 11:00:00", 2, -50.0),
                                ("x", "2024-01-01 12:00:00", 3, 75.0)],
                               "k string, t string, id int, pnl double").withColumn(
        "timestamp", F.to_timestamp("t"))
    m = performance_metrics(df, ["k"], ["timestamp", "id"], bucket=day_of("timestamp")).first()
    assert m.asDict() == {
        "k": "x", "total_trades": 3, "winning_trades": 2, "losing_trades": 1, "win_rate": 66.67,
        "total_pnl": 125.0, "avg_win": 87.5, "avg_loss": -50.0, "max_drawdown": 50.0,
        "max_drawdown_pct": 40.0, "trades_per_hour": 1.5, "profit_factor": 1.75}


def test_zero_pnl_counts_as_loss_only_in_metrics(spark):
    df = spark.createDataFrame([("x", 1, 0.0, "buy", 1.0, 10.0), ("x", 2, 5.0, "buy", 1.0, 10.0),
                                ("x", 3, 1.0, "sell", 1.0, 11.0)],
                               "symbol string, id int, pnl double, action string, "
                               "confidence double, price double").withColumn(
        "timestamp", F.timestamp_seconds("id"))
    m = performance_metrics(df, ["symbol"], ["id"], bucket=day_of("timestamp")).first()
    assert (m.winning_trades, m.losing_trades) == (2, 1)
    closed = next_trade_exit(df, ["id"], bucket=day_of("timestamp"))
    b = backtest_performance(closed).first()
    assert (b.total_trades, b.winning_trades, b.losing_trades) == (2, 1, 0)
    assert b.total_pnl == 0.1 and b.avg_confidence == 1.0


def test_continuity(spark):
    stamps = [0, 60, 60, 180, 86400, 86460, 86460.5]
    df = spark.createDataFrame([("p", float(s)) for s in stamps], "p string, s double").select(
        F.col("p").alias("product_id"), F.timestamp_seconds("s").alias("timestamp"))
    r = continuity_check(df, "product_id").first()
    assert (r.rows, r.gaps, r.duplicates) == (7, 2, 2)


def test_positions_of_one_dense_day_run_in_even_ranges(spark):
    """All rows in one key and one day, most of them in one second; nulls come first."""
    df = spark.range(20000).select(F.lit("A").alias("k"), F.when(F.col("id") % 10 == 0, F.timestamp_seconds(F.col("id"))).otherwise(
        F.timestamp_seconds(F.lit(5))).alias("timestamp"), F.col("id"))
    df = df.unionByName(df.limit(0)).withColumn("timestamp", F.when(F.col("id") == 77, None).otherwise(F.col("timestamp"))).repartition(5)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ranges_of(df, ["k", "timestamp", "id"]).groupBy("_range").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    got = global_positions(df, ["k", "timestamp", "id"]).collect()
    want = sorted(df.collect(), key=lambda r: (r.k, r.timestamp is not None, r.timestamp or 0, r.id))
    assert [(r.id, r._total) for r in sorted(got, key=lambda r: r.pos)] == [(r.id, 20000) for r in want]
    assert global_positions(df.limit(0), ["k"]).collect() == []
