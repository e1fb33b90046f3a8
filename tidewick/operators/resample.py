"""Ticks to OHLCV bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewick.functions.numeric import finite, ratio

# Time-frame names and their widths; an unknown name means one minute.
TIMEFRAMES = {"1Min": "1 minute", "5Min": "5 minutes", "15Min": "15 minutes", "1Hour": "1 hour",
              "1Day": "1 day"}


def width_of(timeframe: str) -> str:
    return TIMEFRAMES.get(timeframe, TIMEFRAMES["1Min"])


def tick_order(time: str, tie: str) -> Column:
    """(time, tie) as one decimal, so first/last-by-order stays a hash aggregate.

    A struct would do as well, but aggregation buffers with structs force a sort of the input.
    """
    digits = F.lit("10000000000000000000").cast("decimal(20,0)")
    return (F.unix_micros(time).cast("decimal(17,0)") * digits + F.col(tie).cast("decimal(19,0)"))


def resample(ticks: DataFrame, timeframe: str = "1Min", *, watermark: str | None = None,
             time: str = "timestamp") -> DataFrame:
    """Tumbling bars per symbol with open/high/low/close, volume, trade_count and vwap.

    Works on batch and streaming input; pass ``watermark`` for a stream. Ticks whose price is missing or
    no finite number are left out; such a size is missing.
    """
    if watermark:
        ticks = ticks.withWatermark(time, watermark)
    order = tick_order(time, "trade_id")
    ticks = ticks.filter(finite(F.col("price").cast("double")).isNotNull())
    price, size = F.col("price"), finite(F.col("size").cast("double"))
    bars = ticks.groupBy("symbol", F.window(time, width_of(timeframe)).alias("_w")).agg(
        F.min_by(price, order).alias("open"), F.max(price).alias("high"),
        F.min(price).alias("low"), F.max_by(price, order).alias("close"),
        F.sum(size).alias("volume"), F.count(F.lit(1)).alias("trade_count"),
        F.sum(price * size).alias("_notional"))
    return bars.select(
        F.col("_w.start").alias("timestamp"), "symbol", "open", "high", "low", "close", "volume",
        "trade_count", ratio(F.col("_notional"), F.col("volume")).alias("vwap"))
