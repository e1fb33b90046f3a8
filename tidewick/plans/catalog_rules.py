"""Queries over labels: rule columns on the hourly panel, samples and their statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewick.functions import rules
from tidewick.operators import performance as perf, samples as smp
from tidewick.plans import sqltext as S, tables as t
from tidewick.plans.registry import query

KEY = ["symbol", "timestamp"]


def _label_query(name: str, column, sql: str, alias: str) -> None:
    @query(name, S.hourly(f"SELECT symbol, timestamp, {sql} AS {alias} FROM panel"))
    def run(spark, sf):
        return t.panel(spark, sf).select(*KEY, column().alias(alias))


def _num(sql: str) -> str:
    return f"round({sql} + 1e-9, 6)"


_label_query("fear_greed_simple", rules.fear_greed_simple, S.FEAR_GREED_SIMPLE, "fear_greed")
_label_query("fear_greed_score", rules.fear_greed_score, S.FEAR_GREED_SCORE, "fear_greed")
_label_query("trend_simple", rules.trend_simple, S.TREND_SIMPLE, "trend")
_label_query("trend_flags_label", rules.trend_flags_label, S.TREND_FLAGS, "trend")
_label_query("volatility_regime", rules.volatility_regime, S.VOLATILITY_REGIME, "regime")
_label_query("volume_regime", rules.volume_regime, S.VOLUME_REGIME, "regime")
_label_query("signal_basic", rules.signal_basic, """CASE
  WHEN b > s THEN 'BUY' WHEN s > b THEN 'SELL' ELSE 'HOLD' END""".replace(
    "b > s", "{b} > {s}").replace("s > b", "{s} > {b}").format(
    b="(CASE WHEN rsi < 30 THEN 2 ELSE 0 END + CASE WHEN macd > macd_signal THEN 1 ELSE 0 END"
      " + CASE WHEN bb_position < 0.2 THEN 1 ELSE 0 END)",
    s="(CASE WHEN rsi > 70 THEN 2 ELSE 0 END + CASE WHEN macd > macd_signal THEN 0 ELSE 1 END"
      " + CASE WHEN bb_position > 0.8 THEN 1 ELSE 0 END)"), "signal")
_label_query("confidence_indicator", rules.confidence_indicator, _num(S.CONFIDENCE_INDICATOR),
             "confidence")
_label_query("reasoning_short", rules.reasoning_short, S.REASONING_SHORT, "reasoning")
_label_query("market_cap", lambda: rules.market_cap(F.col("symbol"), F.col("close")),
             _num(S.MARKET_CAP), "market_cap")


@query("market_cap_join", S.with_(S.TICKS, S.bars(), """supply AS (
  SELECT symbol, CAST(max(trade_id) AS DOUBLE) AS multiplier FROM ticks WHERE symbol <> 'error' GROUP BY 1)""",
  select="""SELECT symbol, timestamp, round(close * coalesce(multiplier, 1000000.0) + 1e-9, 6) AS market_cap
  FROM bars LEFT JOIN supply USING (symbol)"""))
def market_cap_join(spark, sf):
    """The supply dimension is derived from the ticks; one symbol has no entry."""
    supply = (t.ticks(spark, sf).filter("symbol <> 'error'").groupBy("symbol")
              .agg(F.max("trade_id").cast("double").alias("multiplier")))
    return smp.market_cap_join(t.bars(spark, sf).select(*KEY, "close"), supply).drop("close")


@query("price_momentum", S.hourly(f"""SELECT symbol, timestamp, {S.r('change_1h', 'short_term')},
  {S.r('change_4h', 'medium_term')}, {S.r('change_24h', 'long_term')},
  {S.r('change_1h - change_4h', 'acceleration')}, {S.r('abs(change_24h)', 'strength')} FROM panel"""))
def price_momentum(spark, sf):
    return t.panel(spark, sf).select(*KEY, rules.price_momentum().alias("m")).select(*KEY, "m.*")


def _levels(up: str, low: str, mid: str) -> str:
    return S.hourly(f"""SELECT symbol, timestamp, {S.r(up, 'resistance_1')}, {S.r('close * 1.05', 'resistance_2')},
      {S.r(low, 'support_1')}, {S.r('close * 0.95', 'support_2')}, {S.r(mid, 'pivot')},
      {S.r(f'(({up}) - close) / close * 100', 'distance_to_resistance')},
      {S.r(f'(close - ({low})) / close * 100', 'distance_to_support')} FROM panel""")


@query("support_resistance_levels", _levels("bb_upper", "bb_lower", "bb_middle"))
def support_resistance_levels(spark, sf):
    return t.panel(spark, sf).select(
        *KEY, rules.support_resistance_levels().alias("m")).select(*KEY, "m.*")


@query("support_resistance_levels_percent", _levels("close * 1.02", "close * 0.98", "close"))
def support_resistance_levels_percent(spark, sf):
    return t.panel(spark, sf).select(
        *KEY, rules.support_resistance_levels("percent").alias("m")).select(*KEY, "m.*")


@query("market_structure", S.hourly(f"""SELECT symbol, timestamp, {S.r('abs(macd - macd_signal)', 'trend_strength')},
  CASE WHEN macd > macd_signal THEN 'bullish' ELSE 'bearish' END AS momentum_direction,
  CASE WHEN volatility > 0.03 THEN 'high' ELSE 'low' END AS volatility_level,
  CASE WHEN rsi < 30 THEN 'oversold' WHEN rsi > 70 THEN 'overbought' ELSE 'neutral' END AS rsi_regime,
  CASE WHEN bb_position > 0.8 THEN 'upper' WHEN bb_position < 0.2 THEN 'lower' ELSE 'middle' END AS bb_regime,
  (CASE WHEN macd > macd_signal THEN 1 ELSE 0 END + CASE WHEN rsi > 70 THEN 0 ELSE 1 END
   + CASE WHEN bb_position > 0.8 THEN 0 ELSE 1 END + trend_short) / 4.0 AS confluence_score FROM panel"""))
def market_structure(spark, sf):
    return t.panel(spark, sf).select(*KEY, rules.market_structure().alias("m")).select(*KEY, "m.*")


@query("signal_advanced", S.hourly("SELECT symbol, timestamp, signal FROM adv", S.ADVANCED))
def signal_advanced(spark, sf):
    return rules.with_signal_advanced(t.panel(spark, sf)).select(*KEY, "signal")


@query("confidence_score", S.hourly(f"SELECT symbol, timestamp, {S.r('confidence')} FROM adv", S.ADVANCED))
def confidence_score(spark, sf):
    return rules.with_signal_advanced(t.panel(spark, sf)).select(*KEY, "confidence")


@query("reasoning_long", S.hourly("SELECT symbol, timestamp, reasoning FROM adv", S.ADVANCED))
def reasoning_long(spark, sf):
    return rules.with_signal_advanced(t.panel(spark, sf)).select(*KEY, "reasoning")


_THRESHOLD = f"""t1 AS (SELECT *,
    CASE WHEN rsi < 30 THEN 2 ELSE 0 END + CASE WHEN macd > macd_signal AND macd > 0 THEN 1 ELSE 0 END
      + CASE WHEN bb_position < 0.2 THEN 1 ELSE 0 END AS b0,
    CASE WHEN rsi > 70 THEN 2 ELSE 0 END + CASE WHEN macd < macd_signal AND macd < 0 THEN 1 ELSE 0 END
      + CASE WHEN bb_position > 0.8 THEN 1 ELSE 0 END AS s0 FROM panel),
  t2 AS (SELECT *, b0 + CASE WHEN volume_ratio > 1.5 AND b0 > s0 THEN 1 ELSE 0 END
      + CASE WHEN change_24h > 5 THEN 1 ELSE 0 END AS b,
    s0 + CASE WHEN volume_ratio > 1.5 AND s0 > b0 THEN 1 ELSE 0 END
      + CASE WHEN change_24h < -5 THEN 1 ELSE 0 END AS s FROM t1),
  thr AS (SELECT symbol, timestamp,
    CASE WHEN b > s AND b >= 3 THEN 'BUY' WHEN s > b AND s >= 3 THEN 'SELL' ELSE 'HOLD' END AS signal,
    coalesce(nullif(concat_ws('. ',
      {S.words(("rsi < 30", "RSI indicates oversold conditions"), ("rsi > 70", "RSI indicates overbought conditions"))},
      {S.words(("macd > macd_signal AND macd > 0", "MACD shows bullish momentum"),
               ("macd < macd_signal AND macd < 0", "MACD shows bearish momentum"))},
      {S.words(("bb_position < 0.2", "Price near lower Bollinger Band"),
               ("bb_position > 0.8", "Price near upper Bollinger Band"))},
      {S.words(("volume_ratio > 1.5 AND b0 > s0", "High volume confirms buying pressure"),
               ("volume_ratio > 1.5 AND s0 > b0", "High volume confirms selling pressure"))},
      {S.words(("change_24h > 5", "Strong 24h uptrend"), ("change_24h < -5", "Strong 24h downtrend"))}), ''),
      'Mixed signals, maintaining current position') || '.' AS reasoning FROM t2)"""


@query("signal_threshold", S.minutely("SELECT symbol, timestamp, signal FROM thr", _THRESHOLD))
def signal_threshold(spark, sf):
    return rules.with_signal_threshold(t.panel(spark, sf, "1Min")).select(*KEY, "signal")


@query("reasoning_threshold", S.minutely("SELECT symbol, timestamp, reasoning FROM thr", _THRESHOLD))
def reasoning_threshold(spark, sf):
    return rules.with_signal_threshold(t.panel(spark, sf, "1Min")).select(*KEY, "reasoning")


def _sizes(conf: str, steps) -> str:
    return "CASE " + " ".join(
        f"WHEN {conf} > {limit}{' AND volatility < 0.03' if limit == 0.8 else ''} THEN '{text}'"
        for limit, text in steps[:-1]) + f" ELSE '{steps[-1][1]}' END"


_SIZE = [(0.8, "3-5%"), (0.7, "2-3%"), (0.6, "1-2%"), (0, "0.5-1%")]
_TAKE = [(0.8, "8-12%"), (0.7, "5-8%"), (0, "3-5%")]
_label_query("position_size_label", lambda: rules.position_size_label(rules.confidence_indicator()),
             _sizes(f"({S.CONFIDENCE_INDICATOR})", _SIZE), "position_size")
_label_query("take_profit_label", lambda: rules.take_profit_label(rules.confidence_indicator()),
             _sizes(f"({S.CONFIDENCE_INDICATOR})", _TAKE), "take_profit")


@query("stop_loss_label", S.hourly(f"""SELECT symbol, timestamp, {_num(S.STOP_LOSS_PCT)} AS stop_loss_pct,
  stop_text AS stop_loss FROM (SELECT *, CASE WHEN atr IS NULL THEN '3.0%' ELSE printf('%.1f%%', {S.STOP_LOSS_PCT}) END AS stop_text FROM panel)"""))
def stop_loss_label(spark, sf):
    return t.panel(spark, sf).select(
        *KEY, rules.stop_loss_pct().alias("stop_loss_pct"),
        rules.stop_loss_label().alias("stop_loss"))


@query("fill_indicator_defaults", S.hourly(f"""SELECT symbol, timestamp,
  {S.r('coalesce(rsi, 50)', 'rsi')}, {S.r('coalesce(sma_20, close)', 'sma_20')},
  {S.r('coalesce(sma_50, close)', 'sma_50')}, {S.r('coalesce(bb_position, 0.5)', 'bb_position')},
  {S.r('coalesce(volume_ratio, 1)', 'volume_ratio')}, {S.r('coalesce(volatility, 0)', 'volatility')} FROM panel"""))
def fill_indicator_defaults(spark, sf):
    return rules.fill_indicator_defaults(t.panel(spark, sf)).select(
        *KEY, "rsi", "sma_20", "sma_50", "bb_position", "volume_ratio", "volatility")


# --- samples -------------------------------------------------------------------------------------

_LAB = (S.ADVANCED, S.LABELLED)
_SMP = (*_LAB, S.SAMPLED)


@query("sample_every_n", S.minutely(f"SELECT symbol, timestamp, pos, {S.r6('rsi', 'macd', 'bb_position')} FROM sampled", *_SMP))
def sample_every_n(spark, sf):
    return smp.sample_every_n(t.panel(spark, sf, "1Min")).select(
        *KEY, "pos", "rsi", "macd", "bb_position")


_PRICE = ["open", "high", "low", "close", "volume", "change_1m", "change_24h"]


@query("build_sample", S.hourly(f"""SELECT symbol, strftime(timestamp, '%Y-%m-%dT%H:%M:%S') AS timestamp,
  round(volume_price_trend, 1) AS volume_price_trend, {S.r6(*_PRICE, 'rsi', 'macd_signal', 'ema_200', 'market_cap')}, hammer, trend_long,
  fear_greed, trend, volume_regime, CASE WHEN bb_position > 0.8 THEN 'upper' WHEN bb_position < 0.2 THEN 'lower'
  ELSE 'middle' END AS bb_regime, signal, {S.r('confidence')}, reasoning FROM lab""", *_LAB))
def build_sample(spark, sf):
    nested = smp.build_sample(t.labelled(spark, sf, price_trend=True))
    return nested.select(
        "symbol", "timestamp", *[f"price_data.{x}" for x in _PRICE],
        F.round("technical_indicators.volume_price_trend", 1).alias("volume_price_trend"),
        *[f"technical_indicators.{x}" for x in ("rsi", "macd_signal", "ema_200", "hammer",
                                                "trend_long")],
        *[f"market_context.{x}" for x in ("market_cap", "fear_greed", "trend", "volume_regime")],
        "market_context.market_structure.bb_regime", "signal", "confidence", "reasoning")


@query("flatten_nested", S.hourly(f"""SELECT symbol, strftime(timestamp, '%Y-%m-%dT%H:%M:%S') AS timestamp,
  {S.r('close', 'price_data_close')}, {S.r('rsi', 'technical_indicators_rsi')},
  {S.r('change_1h - change_4h', 'market_context_price_momentum_acceleration')},
  CASE WHEN volatility > 0.03 THEN 'high' ELSE 'low' END AS market_context_market_structure_volatility_level,
  signal FROM lab""", *_LAB))
def flatten_nested(spark, sf):
    flat = smp.flatten_nested(smp.build_sample(t.labelled(spark, sf)))
    return flat.select(
        "symbol", "timestamp", "price_data_close", "technical_indicators_rsi",
        "market_context_price_momentum_acceleration",
        "market_context_market_structure_volatility_level", "signal")


@query("label_samples_chunk", S.hourly(f"""SELECT symbol, timestamp, signal, {S.r(S.CONFIDENCE_INDICATOR, 'confidence')},
  {S.REASONING_SHORT} AS reasoning, {S.FEAR_GREED_SIMPLE} AS fear_greed, {S.TREND_SIMPLE} AS trend,
  {_sizes(f'({S.CONFIDENCE_INDICATOR})', _SIZE)} AS position_size,
  {_sizes(f'({S.CONFIDENCE_INDICATOR})', _TAKE)} AS take_profit FROM adv""", S.ADVANCED))
def label_samples_chunk(spark, sf):
    return t.labelled(spark, sf, variant="chunk").select(
        *KEY, "signal", "confidence", "reasoning", "fear_greed", "trend", "position_size",
        "take_profit")


_CAP = 100


@query("cap_per_symbol", S.hourly(f"""SELECT symbol, timestamp, signal FROM (SELECT *, row_number() OVER (
  PARTITION BY symbol ORDER BY timestamp) AS n FROM lab) WHERE n <= {_CAP}""", *_LAB))
def cap_per_symbol(spark, sf):
    return smp.cap_per_symbol(t.labelled(spark, sf), _CAP).select(
        *KEY, "signal")


_NUMBERED = "num AS (SELECT *, row_number() OVER (ORDER BY symbol, timestamp) - 1 AS n, count(*) OVER () AS total FROM bars)"


@query("positional_split", S.with_(S.TICKS, S.bars(), _NUMBERED, select="""SELECT symbol, timestamp, close,
  CASE WHEN n < floor(total * (1.0 - 0.1)) THEN 'train' ELSE 'test' END AS split FROM num"""))
def positional_split(spark, sf):
    return smp.positional_split(t.bars(spark, sf).select(*KEY, "close"), 0.1)


@query("peek_positions", S.with_(S.TICKS, S.bars(), _NUMBERED, select="""SELECT symbol, timestamp, close,
  n AS sample_pos FROM num WHERE n IN (0, 50, 100)"""))
def peek_positions(spark, sf):
    return smp.peek_positions(t.bars(spark, sf).select(*KEY, "close"))


@query("samples_to_decisions", S.hourly(f"""SELECT symbol, timestamp, {S.r('close')}, {S.r('change_24h')},
  signal AS final_signal, {S.r('confidence', 'final_confidence')}, reasoning AS final_reasoning FROM lab
  ORDER BY symbol, timestamp LIMIT 500""", *_LAB))
def samples_to_decisions(spark, sf):
    nested = smp.build_sample(t.labelled(spark, sf)).withColumn(
        "timestamp", F.to_timestamp("timestamp"))
    return smp.samples_to_decisions(nested, 500).select(
        *KEY, "market_data.close", "market_data.change_24h", "final_signal", "final_confidence",
        "final_reasoning")


@query("signal_distribution", S.hourly(f"""SELECT signal, n, {S.r('100.0 * n / sum(n) OVER ()', 'pct')}
  FROM (SELECT signal, count(*) AS n FROM adv GROUP BY 1)""", S.ADVANCED))
def signal_distribution(spark, sf):
    return perf.signal_distribution(rules.with_signal_advanced(t.panel(spark, sf)))


@query("confidence_stats", S.hourly("""SELECT round(min(confidence) + 1e-9, 6) AS min,
  round(max(confidence) + 1e-9, 6) AS max, round(avg(confidence) + 1e-9, 6) AS mean,
  round(median(confidence) + 1e-9, 6) AS median FROM adv""", S.ADVANCED))
def confidence_stats(spark, sf):
    return perf.confidence_stats(rules.with_signal_advanced(t.panel(spark, sf)))


@query("indicator_ranges", S.hourly("SELECT " + ", ".join(
    S.r(f"{f}({x})", f"{f}_{x}") for x in ("rsi", "macd", "close", "volume") for f in ("min", "max"))
    + " FROM panel"))
def indicator_ranges(spark, sf):
    return perf.indicator_ranges(t.panel(spark, sf))


@query("completeness", S.hourly("""SELECT count(*) AS rows,
  bool_and(symbol IS NOT NULL AND close IS NOT NULL AND timestamp IS NOT NULL) AS all_have_keys,
  count(*) FILTER (rsi IS NULL OR macd IS NULL OR bb_position IS NULL OR sma_200 IS NULL) AS rows_with_null_indicator
  FROM panel"""))
def completeness(spark, sf):
    return perf.completeness(t.panel(spark, sf), ["symbol", "close", "timestamp"],
                             ["rsi", "macd", "bb_position", "sma_200"])


@query("dataset_totals", S.with_(S.TICKS, S.bars(), select="""SELECT count(*) AS total_samples,
  count(DISTINCT date_trunc('day', timestamp)) AS total_chunks, count(DISTINCT symbol) AS total_symbols FROM bars"""))
def dataset_totals(spark, sf):
    return perf.dataset_totals(t.bars(spark, sf).withColumn("chunk", F.to_date("timestamp")))
