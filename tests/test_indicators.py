"""The panel against pandas rolling/ewm, across block edges and on awkward series."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewick.operators import indicators as ind
from tidewick.operators.indicators import full_panel, indicator_panel


def reference(g: pd.DataFrame) -> pd.DataFrame:
    c, h, l, v = g.close, g.high, g.low, g.volume
    out = {"change_1m": c.pct_change() * 100}
    for name, n in (("change_5m", 5), ("change_1h", 60), ("change_24h", 1440)):
        out[name] = ((c - c.shift(n)) / c.shift(n) * 100).fillna(0)
    for n in (5, 10, 20, 50, 100, 200):
        out[f"sma_{n}"] = c.rolling(n).mean()
        out[f"ema_{n}"] = c.ewm(span=n).mean()
    out["macd"] = c.ewm(span=12).mean() - c.ewm(span=26).mean()
    out["macd_signal"] = out["macd"].ewm(span=9).mean()
    d = c.diff()
    gain, loss = d.where(d > 0, 0).rolling(14).mean(), (-d.where(d < 0, 0)).rolling(14).mean()
    out["rsi"] = 100 - 100 / (1 + gain / loss)
    hi, lo = h.rolling(14).max(), l.rolling(14).min()
    out["stoch_k"] = 100 * (c - lo) / (hi - lo)
    out["stoch_d"] = out["stoch_k"].rolling(3).mean()
    out["williams_r"] = -100 * (hi - c) / (hi - lo)
    pc = c.shift()
    out["atr"] = np.maximum(h - l, np.maximum((h - pc).abs(), (l - pc).abs())).rolling(14).mean()
    out["volume_ratio"] = v / v.rolling(20).mean()
    out["volatility"] = c.rolling(20).std() / c.rolling(20).mean()
    out["resistance"], out["support"] = h.rolling(20).max(), l.rolling(20).min()
    out["volume_price_trend"] = (v * out["change_1m"]).cumsum()
    return pd.DataFrame(out).replace([np.inf, -np.inf], np.nan)


def series(symbol: str, n: int, seed: int, flat: slice | None = None, gaps: bool = False):
    rng = np.random.default_rng(seed)
    close = 100 + np.cumsum(rng.normal(0, 0.3, n)) % 50
    if flat:
        close[flat] = 77.0
    minutes = np.cumsum(rng.integers(1, 4, n)) if gaps else np.arange(n)
    high = close + rng.random(n)
    low = close - rng.random(n)
    if flat:
        high[flat] = low[flat] = 77.0
    return pd.DataFrame({
        "symbol": symbol, "timestamp": pd.Timestamp("2024-01-01") + pd.to_timedelta(minutes, "min"),
        "open": np.roll(close, 1), "high": high, "low": low, "close": close,
        "volume": np.where(rng.random(n) < 0.02, 0.0, rng.random(n) * 1000)})


def check(spark, pdf: pd.DataFrame):
    got = full_panel(spark.createDataFrame(pdf)).toPandas().sort_values(["symbol", "timestamp"])
    assert len(got) == len(pdf)
    for symbol, g in pdf.sort_values(["symbol", "timestamp"]).groupby("symbol"):
        q = got[got.symbol == symbol].reset_index(drop=True)
        assert (q.pos == np.arange(len(q))).all()
        for name, want in reference(g.reset_index(drop=True)).items():
            assert (q[name].isna() == want.isna()).all(), name
            err = ((q[name] - want).abs() / (1 + want.abs())).max()
            assert not err > 1e-8, (symbol, name, err)


def test_across_block_and_sub_block_edges(spark):
    # 4096, 16384 and 20480 are edges; one symbol owns almost all rows.
    check(spark, pd.concat([series("BIG", 21000, 1), series("SMALL", 150, 2, gaps=True)]))


@pytest.mark.parametrize("n", [1, 2, 13, 14, 15, 19, 20, 21])
def test_short_series(spark, n):
    check(spark, pd.concat([series("A", n, n), series("B", n + 1, n)]))


def test_flat_prices_are_null(spark):
    pdf = series("F", 120, 5, flat=slice(30, 100))
    row = indicator_panel(spark.createDataFrame(pdf)).filter("pos = 80").first()
    assert row.rsi is None and row.bb_position is None and row.stoch_k is None
    assert row.doji == 0


def test_only_rises_gives_rsi_100(spark):
    pdf = series("R", 40, 6)
    pdf["close"] = np.arange(40) + 10.0
    assert indicator_panel(spark.createDataFrame(pdf)).filter("pos = 30").first().rsi == 100.0


def test_empty(spark):
    pdf = series("E", 5, 7)
    assert indicator_panel(spark.createDataFrame(pdf).limit(0)).count() == 0


def test_carried_averages_equal_the_whole_series(spark):
    """Five ranges, each with few rows before it and a few numbers of the past, against pandas."""
    rng = np.random.default_rng(8)
    n, keep = 1500, 30
    close = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, (2, n)), axis=1))
    rows = [(s, i, float(close[k, i])) for k, s in enumerate("AB") for i in range(n if s == "A" else 700)]
    df = spark.createDataFrame(rows, "symbol string, i long, close double").withColumns({
        "timestamp": F.timestamp_seconds(F.col("i") * 60), **{x: F.col("close") for x in ("open", "high", "low")}, "volume": F.lit(1.0)}).cache()
    want = {}
    for k, s in enumerate("AB"):
        x = pd.Series(close[k][:n if s == "A" else 700])
        fast, slow = x.ewm(span=12).mean(), x.ewm(span=26).mean()
        for i in range(len(x)):
            want[s, i] = {}
        for span in ind.EMA_SPANS:
            for i, v in enumerate(x.ewm(span=span).mean()):
                want[s, i][f"ema_{span}"] = v
        for i, v in enumerate((fast - slow).ewm(span=9).mean()):
            want[s, i]["macd_signal"] = v
    history, seen = None, 0
    for lo, hi in ((0, 20), (20, 45), (45, 600), (600, 1100), (1100, 1500)):
        known = df.filter(f"i >= {max(0, lo - keep)} AND i < {hi}") if lo < 700 else df.filter(
            f"(symbol = 'A' AND i >= {lo - keep} AND i < {hi}) OR (symbol = 'B' AND i >= {700 - keep})")
        panel = ind.indicator_panel(known, history=history).cache()
        for r in panel.collect():
            for name in ind.CARRIED:
                assert abs(r[name] - want[r.symbol, r.i][name]) <= 1e-12 * max(1, abs(want[r.symbol, r.i]["ema_5"])), (r.symbol, r.i, name)
            seen += r.i >= lo
        history = spark.createDataFrame(ind.averages_before(panel, history, keep).collect(),
                                        "symbol string, rows long, " + ", ".join(f"{x} double" for x in ind.CARRIED))
        assert history.count() <= 2 and len(history.columns) == 2 + len(ind.CARRIED)
    assert seen == n + 700
    assert {r.symbol: r.rows for r in history.collect()} == {"A": n - keep, "B": 700 - keep}


def test_large_running_sums_do_not_depend_on_blocks(spark):
    """Printed to one decimal, a sum of large numbers shows how it was added up unless it is exact."""
    pdf = series("BIG", 3000, 11)
    pdf["volume"] = np.random.default_rng(12).integers(0, 10**10, len(pdf)).astype(float)
    step = [v * ((c / p - 1) * 100) for v, c, p in zip(pdf.volume[1:], pdf.close[1:], pdf.close)]
    want = [math.fsum(step[:n]) for n in range(1, len(pdf))]
    rows = spark.createDataFrame(pdf)
    for df in (full_panel(rows, rows_per_block=512),
               ind.volume_price_trend(rows, bucket=F.date_trunc("hour", "timestamp"), rows_per_block=128)):
        assert [r.volume_price_trend for r in df.orderBy("timestamp").collect()] == [None, *want]
