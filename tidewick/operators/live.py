"""Short-context indicators of the live path, in batch form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.functions.numeric import ladder, ratio, round_to
from tidewick.operators.asof import as_of
from tidewick.operators.series import block_window, blocked, day_of

CONTEXT_BARS, FEED_ROWS = 20, 10
CONTEXT_FIELDS = ("sma_5", "sma_20", "price_change", "price_change_pct", "volume_ratio", "volatility", "trend")


def _fold(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def context_indicators(closes: Column, volumes: Column, digits: int | None = 2) -> Column:
    """Struct of short-context indicators over an ascending window of at most 20 bars.

    NULL below two bars. ``volatility`` is the root mean square of the window's first nine returns
    (0 below ten bars), in percent.
    """
    n = F.size(closes)
    last, prev = F.element_at(closes, -1), F.try_element_at(closes, F.lit(-2))

    def sma(k: int) -> Column:
        return F.when(n >= k, _fold(F.slice(closes, -k, k)) / float(k)).otherwise(last)

    avg_volume = _fold(volumes) / n
    returns = F.zip_with(F.slice(closes, 2, 9), F.slice(closes, 1, 9),
                         lambda b, a: ratio(b - a, a))
    rms = F.sqrt(_fold(F.transform(returns, lambda r: r * r)) / F.size(returns)) * 100
    s5, s20 = F.when(n >= 5, _fold(F.slice(closes, -5, 5)) / 5.0).otherwise(last), sma(20)
    return F.when(n >= 2, F.struct(
        round_to(s5, digits).alias("sma_5"), round_to(s20, digits).alias("sma_20"),
        round_to(last - prev, digits).alias("price_change"),
        round_to(F.coalesce(ratio(last - prev, prev) * 100, F.lit(0.0)), digits)
        .alias("price_change_pct"),
        round_to(F.when(avg_volume > 0, F.element_at(volumes, -1) / avg_volume).otherwise(1.0), digits)
        .alias("volume_ratio"),
        round_to(F.when(n >= 10, rms).otherwise(0.0), digits).alias("volatility"),
        ladder([(s5 > s20, "bullish"), (s5 < s20, "bearish")], "neutral").alias("trend")))


def _windowed(bars: DataFrame, start: int, end: int, halo: int) -> DataFrame:
    df = blocked(bars, ["symbol"], ["timestamp"], bucket=day_of("timestamp"), halo=halo)
    w = block_window(["symbol"]).rowsBetween(start, end)
    both = F.collect_list(F.struct("close", "volume")).over(w)
    return df.withColumn("_w", both).filter("_own").withColumns({
        "_c": F.transform("_w", lambda x: x["close"]),
        "_v": F.transform("_w", lambda x: x["volume"])})


def recent_context(bars: DataFrame, digits: int | None = 2) -> DataFrame:
    """Indicators over each bar and the 19 before it."""
    df = _windowed(bars, -(CONTEXT_BARS - 1), 0, CONTEXT_BARS)
    return df.withColumn("indicators", context_indicators(F.col("_c"), F.col("_v"), digits)).select(
        *bars.columns, "pos", "indicators.*")


def backtest_context(bars: DataFrame, digits: int | None = 2) -> DataFrame:
    """Indicators over the 20 bars before each bar from position 20; price is the bar's close."""
    df = _windowed(bars, -CONTEXT_BARS, -1, CONTEXT_BARS).filter(F.col("pos") >= CONTEXT_BARS)
    return df.withColumn("indicators", context_indicators(F.col("_c"), F.col("_v"), digits)).select(
        "symbol", "timestamp", "pos", F.col("close").alias("latest_price"), "indicators.*")


def live_context(bars: DataFrame, quotes: DataFrame, trades: DataFrame, width: str, *, count: int = FEED_ROWS,
                 digits: int | None = 2) -> DataFrame:
    """What is known when a bar closes: its price and indicators, and the last quotes and trades up to then.

    A bar of ``width`` closes that long after its timestamp. ``quotes`` and ``trades`` become lists of structs, oldest
    first. Of trades of one time the order is by ``trade_id``; quotes of one time by their prices.
    """
    known = recent_context(bars, digits).withColumns({
        "_start": F.col("timestamp"), "timestamp": F.col("timestamp") + F.expr(f"INTERVAL {width}"), "latest_price": F.col("close")})
    joined = as_of(known, {"quotes": quotes, "trades": trades}, n=count,
                   ties={"quotes": [c for c in quotes.columns if c not in ("symbol", "timestamp")], "trades": ["trade_id"]})
    return joined.select("symbol", F.col("_start").alias("timestamp"), F.col("timestamp").alias("known_at"), "latest_price",
                         *CONTEXT_FIELDS, "quotes", "trades")


def momentum_verdict(recent: Column, older: Column) -> Column:
    return ladder([(recent > older * 1.02, "bullish"), (recent < older * 0.98, "bearish")], "none")


def momentum_5v5(bars: DataFrame, *more: Column) -> DataFrame:
    """Mean of the last five closes against the five before; NULL below ten bars. ``more`` columns can use ``pos``."""
    df = blocked(bars, ["symbol"], ["timestamp"], bucket=day_of("timestamp"), halo=10)
    w = block_window(["symbol"])
    df = df.withColumns({"recent_avg": F.avg("close").over(w.rowsBetween(-4, 0)),
                         "older_avg": F.avg("close").over(w.rowsBetween(-9, -5))}).filter("_own")
    ready = F.col("pos") >= 9
    return df.select("symbol", "timestamp", *more, *[F.when(ready, F.col(x)).alias(x)
                                                     for x in ("recent_avg", "older_avg")],
                     F.when(ready, momentum_verdict(F.col("recent_avg"), F.col("older_avg")))
                     .alias("momentum"))
