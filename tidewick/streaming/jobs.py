"""Structured Streaming counterparts of the live path."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidewick import schemas
from tidewick.functions.rules import with_signal_advanced
from tidewick.operators.indicators import indicator_panel
from tidewick.operators.live import (
    CONTEXT_BARS, CONTEXT_FIELDS, FEED_ROWS, context_indicators, momentum_5v5, momentum_verdict, recent_context)
from tidewick.operators.resample import resample
from tidewick.operators.risk import RiskLimits, prior_daily_counters, validate_signals
from tidewick.streaming.keyed import last_rows
from tidewick.streaming.ranges import CarriedRanges, ClosedRanges

FEEDS = {"bar": schemas.BARS, "quote": schemas.QUOTES, "trade": schemas.TRADES}
BUFFER_BARS, HISTORY_BARS = 1000, 100
#: The longest look-back; averages are carried.
DECISION_BARS = 1440


def stream_source(spark: SparkSession, path: str, feed: str | StructType, *,
                  symbols: Sequence[str] | None = None, fmt: str = "parquet",
                  files_per_trigger: int | None = None,
                  bytes_per_trigger: int = 1 << 30) -> DataFrame:
    """A file feed of bars, quotes or trades for a symbol list (a Kafka source fits the same way)."""
    schema = FEEDS[feed] if isinstance(feed, str) else feed
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    df = reader.load(path)
    return df.filter(F.col("symbol").isin(*symbols)) if symbols else df


def stream_ingest(raw: DataFrame, feed: str) -> DataFrame:
    """Cast a raw feed to its schema and drop rows without symbol or time."""
    fields = FEEDS[feed].fields
    return (raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
            .filter(F.col("symbol").isNotNull() & F.col("timestamp").isNotNull()))


def stream_bars(ticks: DataFrame, timeframe: str, watermark: str) -> DataFrame:
    return resample(ticks, timeframe, watermark=watermark)


def stream_dedup(bars: DataFrame, watermark: str, *keys: str) -> DataFrame:
    return bars.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(list(keys))


def momentum_of(bars: DataFrame, keep: int = HISTORY_BARS) -> DataFrame:
    """Momentum on every bar, with the number of bars it could look at."""
    at = F.col("pos") + 1
    return momentum_5v5(bars, F.col("close"), F.least(at, F.lit(keep)).alias("history"))


def stream_momentum(root: str, delay: str, keep: int = HISTORY_BARS) -> ClosedRanges:
    """Step that gives the momentum of every bar once the watermark has passed it."""
    return ClosedRanges(root, lambda bars: momentum_of(bars, keep), keep=max(keep, 10), delay=delay)


def last_n_of(bars: DataFrame, keep: int = BUFFER_BARS) -> DataFrame:
    """Newest price and the short-context indicators on every bar, and the number of bars in the buffer."""
    return recent_context(bars, digits=None).withColumns({
        "latest_price": F.col("close"), "bars": F.least(F.col("pos") + 1, F.lit(keep))}).select(
        "symbol", "timestamp", "latest_price", "bars", *CONTEXT_FIELDS)


def stream_last_n(root: str, delay: str, keep: int = BUFFER_BARS) -> ClosedRanges:
    """Step that gives the live context of every bar once the watermark has passed it."""
    return ClosedRanges(root, lambda bars: last_n_of(bars, keep), keep=max(keep, CONTEXT_BARS), delay=delay)


def live_context_of(rows: DataFrame) -> DataFrame:
    """The columns of ``live.live_context`` from the lists of ``keyed.last_rows`` (bar, quote, trade)."""
    closes, volumes = F.col("bar.close"), F.col("bar.volume")
    return rows.withColumn("_last", F.element_at("bar", -1)).select(
        F.col("key").alias("symbol"), F.col("_last.timestamp").alias("timestamp"), F.col("at").alias("known_at"),
        F.col("_last.close").alias("latest_price"), context_indicators(closes, volumes, None).alias("_c"),
        F.col("quote").alias("quotes"), F.col("trade").alias("trades")).select(
        "symbol", "timestamp", "known_at", "latest_price", *[f"_c.{x}" for x in CONTEXT_FIELDS], "quotes", "trades")


def keyed_context(bars: DataFrame, quotes: DataFrame, trades: DataFrame, width: str, delay: str, *,
                  heartbeats: DataFrame | None = None) -> DataFrame:
    """Stream of ``live.live_context`` rows, each symbol's last rows held as keyed state."""
    known = bars.withColumn("_known", F.col("timestamp") + F.expr(f"INTERVAL {width}"))
    rows = last_rows({"bar": known, "quote": quotes, "trade": trades}, "bar", {"bar": CONTEXT_BARS, "quote": FEED_ROWS, "trade": FEED_ROWS},
                     delay, times={"bar": "_known"}, ties={"trade": "trade_id"}, heartbeats=heartbeats)
    return live_context_of(rows)


def keyed_momentum(bars: DataFrame, delay: str, keep: int = HISTORY_BARS, *, heartbeats: DataFrame | None = None) -> DataFrame:
    """Stream of ``momentum_of`` rows, each symbol's last closes held as keyed state."""
    rows = last_rows({"bar": bars}, "bar", {"bar": keep}, delay, heartbeats=heartbeats, slot_hours=24)
    closes = F.col("bar.close")

    def mean(first: int) -> Column:
        return F.aggregate(F.slice(closes, first, 5), F.lit(0.0), lambda acc, x: acc + x) / 5.0

    ready = F.size("bar") >= 10
    rows = rows.select(F.col("key").alias("symbol"), F.col("at").alias("timestamp"), F.element_at("bar", -1)["close"].alias("close"),
                       F.size("bar").cast("long").alias("history"), F.when(ready, mean(-5)).alias("recent_avg"),
                       F.when(ready, mean(-10)).alias("older_avg"))
    return rows.withColumn("momentum", F.when(F.col("older_avg").isNotNull(), momentum_verdict(F.col("recent_avg"), F.col("older_avg"))))


def run_to_end(spark: SparkSession, build: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, beats: str,
               symbols: DataFrame, end: Column) -> None:
    """Runs a keyed stream of feeds that have ended, and lets everything that waits out.

    ``build`` gets the stream of heartbeats. After the feeds two heartbeats at ``end`` follow: the first moves the
    watermark, the second is a batch in which the timers find it moved.
    """
    beat = symbols.select("symbol", end.alias("timestamp"))
    beat.limit(0).write.mode("append").parquet(beats)
    stream = build(spark.readStream.schema("symbol string, timestamp timestamp").parquet(beats))
    run_available(stream, path, checkpoint)
    for _ in range(2):
        beat.write.mode("append").parquet(beats)
        run_available(stream, path, checkpoint)


def decide(bars: DataFrame, limits: RiskLimits, positions: DataFrame | None = None,
           executed: DataFrame | None = None) -> DataFrame:
    """Rule signal and risk verdict for each bar of one account.

    ``positions`` (symbol, qty) are the open ones, ``executed`` (timestamp, pnl) the trades done; the daily
    counters of a bar take the trades of its day before it.
    """
    return decide_panel(indicator_panel(bars), limits, positions, executed)


def decide_panel(panel: DataFrame, limits: RiskLimits, positions: DataFrame | None = None,
                 executed: DataFrame | None = None) -> DataFrame:
    """``decide`` from the indicator panel of the bars."""
    df = with_signal_advanced(panel).withColumn("action", F.expr(
        "CASE signal WHEN 'BUY' THEN 'buy' WHEN 'SELL' THEN 'sell' ELSE 'hold' END"))
    df = df.select("symbol", "timestamp", "close", "action", "confidence", "reasoning", F.lit(0).alias("account"))
    spark = panel.sparkSession
    if executed is None:
        executed = spark.createDataFrame([], "timestamp timestamp, pnl double")
    if positions is None:
        positions = spark.createDataFrame([], "symbol string, qty double")
    # Counters restart each day, so only the trades of the bars' days matter: a range of dates that reaches the scan.
    span = panel.agg(F.date_trunc("day", F.min("timestamp")).alias("lo"), F.max("timestamp").alias("hi")).first()
    if span["lo"] is not None:
        executed = executed.filter(F.col("timestamp").between(F.lit(span["lo"]), F.lit(span["hi"])))
    trades = executed.select("timestamp", "pnl", F.lit(1).alias("_done"))
    times = df.select("timestamp").distinct().select("timestamp", F.lit(0.0).alias("pnl"), F.lit(0).alias("_done"))
    counted = prior_daily_counters(trades.unionByName(times).withColumn("account", F.lit(0)), ["timestamp", "_done"],
                                   bucket=F.date_trunc("hour", "timestamp"), executed=F.col("_done") == 1)
    counted = counted.filter("_done = 0").select("timestamp", "daily_trades", "daily_pnl")
    judged = validate_signals(df.join(counted, "timestamp"), positions.withColumn("account", F.lit(0)), limits)
    return judged.select("symbol", "timestamp", "close", "action", "confidence", "reasoning", "is_valid", "reason")


def decide_step(root: str, limits: RiskLimits, delay: str, *, keep: int = DECISION_BARS,
                positions: Callable[[], DataFrame] | None = None,
                executed: Callable[[], DataFrame] | None = None) -> ClosedRanges:
    """Step that gives a verdict on every bar once the watermark has passed it.

    The kept bars cover the longest look-back; exponential averages are carried as a few numbers for each symbol. The
    account's tables are read anew for each range.
    """
    def work(panel: DataFrame) -> DataFrame:
        return decide_panel(panel, limits, positions and positions(), executed and executed())

    return CarriedRanges(root, work, keep=keep, delay=delay)


def run_ranges(bars: DataFrame, step: ClosedRanges, checkpoint: str) -> DataFrame:
    """Runs a feed that has ended through ``step`` and closes its last range."""
    run_batches(bars, step, checkpoint)
    step.finish(bars.sparkSession, bars.schema)
    return step.results(bars.sparkSession)


def run_available(df: DataFrame, path: str, checkpoint: str, *, fmt: str = "parquet",
                  mode: str = "append") -> None:
    """Process what is there, then stop; a rerun with the same checkpoint continues after it."""
    query = (df.writeStream.format(fmt).outputMode(mode).option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def run_batches(df: DataFrame, step: Callable[[DataFrame, int], Any], checkpoint: str) -> None:
    """``foreachBatch`` to completion; ``step`` gets each micro-batch as a plain DataFrame."""
    query = (df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def stream_log_sink(events: DataFrame, path: str, checkpoint: str) -> None:
    """Append envelope rows as JSON lines, one folder per type, exactly once."""
    query = (events.select("timestamp", "type", "data").writeStream.format("json")
             .partitionBy("type").option("path", path).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
