"""Market, trade, position and memory tables derived from the given parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewick.functions import rules
from tidewick.functions.text import token_count
from tidewick.operators.indicators import indicator_panel
from tidewick.operators.resample import resample
from tidewick.operators.risk import RiskLimits
from tidewick.operators.samples import label_samples

LIMITS = RiskLimits(symbols=("1-URGENT", "2-HIGH", "3-MEDIUM"), max_daily_trades=3,
                    max_daily_loss=200.0, max_open_positions=3, max_drawdown=0.03)
TARGETS = {"A": 0.4, "N": 0.3, "R": 0.3}


def trades_as_of() -> Column:
    return F.lit("1998-08-01 00:00:00").cast("timestamp")


def memory_as_of() -> Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(
        F.col("event_id").alias("trade_id"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("symbol"), F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("size"))


def bars(spark: SparkSession, sf: str, timeframe: str = "1Hour") -> DataFrame:
    return resample(ticks(spark, sf), timeframe)


def candles(spark: SparkSession, sf: str, timeframe: str = "1Hour") -> DataFrame:
    return bars(spark, sf, timeframe).drop("trade_count", "vwap")


def panel(spark: SparkSession, sf: str, timeframe: str = "1Hour") -> DataFrame:
    return indicator_panel(candles(spark, sf, timeframe))


def labelled(spark: SparkSession, sf: str, timeframe: str = "1Hour", variant: str = "advanced",
             price_trend: bool = False) -> DataFrame:
    """Labelled bars; the running price trend only where it is shown."""
    rows = indicator_panel(candles(spark, sf, timeframe), price_trend=price_trend)
    return label_samples(rows, variant)


def candle_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Vendor arrays; one row per bar."""
    return bars(spark, sf).select(
        F.col("symbol").alias("product_id"),
        F.array(F.unix_timestamp("timestamp").cast("double"), "low", "high", "open", "close",
                "volume").alias("c"))


def dirty_candles(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bars whose high/low miss some prices and whose volume can be negative."""
    return bars(spark, sf).select(
        "symbol", "timestamp", "open", F.greatest("open", "vwap").alias("high"),
        F.least("close", "vwap").alias("low"), "close", (F.col("volume") - 100.0).alias("volume"))


def redelivered(spark: SparkSession, sf: str) -> DataFrame:
    """Every hourly bar twice: as built, and redelivered later with the close at its vwap."""
    b = bars(spark, sf).select("symbol", "timestamp", "close", "volume", "vwap")
    first = b.select("symbol", "timestamp", "close", "volume", F.lit(0).alias("arrival"))
    again = b.select("symbol", "timestamp", F.coalesce("vwap", "close").alias("close"), "volume",
                     F.lit(1).alias("arrival"))
    return first.unionByName(again)


def trades(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as closed trades with a P&L."""
    key = F.col("o_orderkey")
    sign = F.when(key % 3 == 0, -1.0).otherwise(1.0)
    return read(spark, sf, "orders").select(
        key.alias("trade_id"), F.col("o_custkey").alias("account"),
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'sell' WHEN 'O' THEN 'buy' ELSE 'hold' END")
        .alias("action"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'rejected' END")
        .alias("status"),
        F.col("o_totalprice").alias("price"), (sign * F.col("o_totalprice") / 1000.0).alias("pnl"),
        ((key % 100) / 100.0).alias("confidence"),
        F.concat(F.lit("order "), F.col("o_orderstatus")).alias("reasoning"))


def day_bucket() -> Column:
    """Bucket of the (time, trade_id) order: from its first column, so it never decreases along the order."""
    return F.date_trunc("hour", F.col("timestamp"))


def positions(spark: SparkSession, sf: str) -> DataFrame:
    value = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    cost = F.sum("l_extendedprice")
    return (read(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("account"),
                                                F.col("l_returnflag").alias("symbol"))
            .agg(F.sum("l_quantity").alias("qty"), value.alias("market_value"),
                 cost.alias("cost_basis"))
            .withColumns({"side": F.lit("long"),
                          "unrealized_pl": F.col("market_value") - F.col("cost_basis"),
                          "unrealized_plpc": F.col("market_value") / F.col("cost_basis") - 1.0}))


def open_orders(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("id"),
        F.col("o_orderpriority").alias("symbol"),
        F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 'buy' ELSE 'sell' END").alias("side"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'pending' END")
        .alias("status"),
        F.col("o_totalprice").alias("limit_price"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"))


def memory_items(spark: SparkSession, sf: str) -> DataFrame:
    conv, turn = F.col("conv_id"), F.col("turn")
    kind = F.expr("CASE role WHEN 'user' THEN 'trade_result' WHEN 'assistant' THEN 'analysis' "
                  "ELSE 'system' END")
    at = F.timestamp_seconds(F.lit(1704067200) + (conv % 720) * 3600 + turn * 60)
    return read(spark, sf, "conversations").select(
        F.md5(F.concat_ws(":", conv.cast("string"), turn.cast("string"))).alias("id"),
        conv.cast("string").alias("agent_id"), F.col("text").alias("content"),
        kind.alias("memory_type"), at.alias("timestamp"),
        ((conv * 7 + turn * 13) % 100 / 100.0).alias("importance"),
        F.array(F.col("role")).alias("tags"),
        F.create_map(
            F.lit("signal"), F.expr("CASE turn % 3 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' "
                                    "ELSE 'HOLD' END"),
            F.lit("pnl"), ((conv * 3 + turn * 5) % 7 - 3).cast("string")).alias("metadata"),
        token_count(F.col("text")).alias("token_count"))


def agents(spark: SparkSession, sf: str) -> DataFrame:
    kinds = F.expr("CASE CAST(agent_id AS BIGINT) % 4 WHEN 0 THEN 'default' "
                   "WHEN 1 THEN 'conservative' WHEN 2 THEN 'aggressive' ELSE 'research' END")
    stats = memory_items(spark, sf).groupBy("agent_id").agg(
        F.min("timestamp").alias("created_at"), F.max("timestamp").alias("last_active"),
        F.sum("token_count").alias("total_tokens_used"), F.count(F.lit(1)).alias("memory_count"),
        F.avg((F.col("importance") > 0.5).cast("int")).alias("_win"),
        F.sum(F.try_element_at("metadata", F.lit("pnl")).cast("double")).alias("_pnl"),
        F.avg("importance").alias("_conf"))
    metrics = F.create_map(
        F.lit("total_trades"), (F.col("memory_count") * 2).cast("double"), F.lit("win_rate"),
        F.col("_win"), F.lit("total_pnl"), F.col("_pnl"), F.lit("avg_confidence"), F.col("_conf"))
    return stats.select("agent_id", kinds.alias("agent_type"), "created_at", "last_active",
                        "total_tokens_used", "memory_count",
                        metrics.alias("performance_metrics"),
                        (F.col("memory_count") > 4).alias("is_active"))


def successors(spark: SparkSession, sf: str) -> DataFrame:
    """Every agent with the id of its successor."""
    return (read(spark, sf, "conversations").select(F.col("conv_id").cast("string")
                                                    .alias("agent_id")).distinct()
            .withColumn("successor_id", F.concat("agent_id", F.lit("-next"))))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("agent_id"), "embedding")


def vector_queries(spark: SparkSession, sf: str) -> DataFrame:
    """One query per agent: its earliest vector."""
    return vectors(spark, sf).groupBy("agent_id").agg(
        F.min("id").alias("query_id"), F.min_by("embedding", "id").alias("query"))


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    """One decision of four steps per hourly bar, worded from the bar's labels."""
    df = labelled(spark, sf).withColumns({
        "mood": rules.fear_greed_simple(), "short": rules.reasoning_short(),
        "indicator_conf": rules.confidence_indicator()})
    regime = F.col("market_structure.rsi_regime")
    tall = F.col("volatility") > 0.03

    def step(kind: str, content: Column, confidence: Column) -> Column:
        return F.struct(F.lit(kind).alias("step_type"), content.alias("content"),
                        confidence.alias("confidence"), F.col("short").alias("reasoning"))

    steps = F.array(
        step("technical_analysis", F.concat(
            F.lit("RSI is "), regime, F.lit(" while MACD crossover is "),
            F.col("market_structure.momentum_direction"), F.lit("; trend "), F.col("trend"),
            F.lit(" with bollinger support. "), F.col("reasoning")),
            F.coalesce(F.col("rsi") / 100.0, F.lit(0.5))),
        step("risk_assessment", F.concat(
            F.col("volatility_regime"), F.lit(", volume "), F.col("volume_regime"),
            F.when(tall, ": low risk, small position, stop at ").otherwise(
                ": high risk, large position size, exit timing at "),
            F.coalesce("stop_loss", F.lit("market"))), F.coalesce(
                F.least(F.lit(1.0), F.col("volatility") * 2), F.lit(0.5))),
        step("market_context", F.concat(
            F.lit("Sentiment shows "), F.col("mood"), F.lit("; news and market cycle: "),
            F.col("trend")), F.col("indicator_conf")),
        step("signal_generation", F.concat(
            F.col("signal"), F.lit(" with confidence because "), F.lower("reasoning"),
            F.lit(" Risk target "), F.col("take_profit")), F.col("confidence")))
    return df.select(
        F.concat_ws("@", "symbol", F.unix_timestamp("timestamp").cast("string"))
        .alias("decision_id"),
        "symbol", "timestamp", "close", "high", "low", "volume", "change_24h", "rsi", "macd",
        "bb_position", "volatility", "fear_greed", "market_cap", "trend", steps.alias("steps"),
        (F.col("change_1m") / 100.0).alias("outcome"))


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Model responses in the SIGNAL / CONFIDENCE / REASONING form, one per hourly bar."""
    df = labelled(spark, sf)
    return df.select(
        "symbol", "timestamp",
        F.concat(F.lit("SIGNAL: "), F.col("signal"), F.lit("\nConfidence: "),
                 (F.col("confidence") * 2).cast("string"), F.lit("\nreasoning: "),
                 F.col("reasoning"), F.lit("\n  Based on "), F.col("trend"),
                 F.lit(" trend \nHeld.")).alias("text"))
