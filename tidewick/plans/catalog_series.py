"""Queries over bars: resampling, indicators, live context, cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewick.operators import indicators as ind, live, performance as perf, quality
from tidewick.operators.resample import TIMEFRAMES
from tidewick.operators.series import day_of, number_rows
from tidewick.plans import sqltext as S, tables as t
from tidewick.plans.registry import query

KEY = ["symbol", "timestamp"]

def _vpt():
    """One decimal: the running sum reaches eight digits."""
    return F.round("volume_price_trend", 1).alias("volume_price_trend")


# name -> panel columns; minute bars where the look-back needs them.
PANEL_QUERIES = {
    "change_1m": (["change_1m"], "1Hour"),
    "change_lags": (list(ind.CHANGE_LAGS), "1Min"),
    "sma": ([f"sma_{n}" for n in ind.AVERAGE_SPANS], "1Min"),
    "ema": ([f"ema_{n}" for n in ind.EMA_SPANS], "1Min"),
    "rsi": (["rsi"], "1Hour"),
    "macd": (["macd", "macd_signal", "macd_histogram"], "1Min"),
    "bollinger": (["bb_middle", "bb_upper", "bb_lower", "bb_width", "bb_position"], "1Hour"),
    "stochastic": (["stoch_k", "stoch_d"], "1Hour"),
    "williams_r": (["williams_r"], "1Hour"),
    "volume_ratio": (["volume_sma", "volume_ratio"], "1Hour"),
    "volatility": (["volatility"], "1Hour"),
    "atr": (["atr"], "1Hour"),
    "candle_patterns": (["doji", "hammer", "shooting_star"], "1Hour"),
    "trend_flags": (["trend_short", "trend_medium", "trend_long"], "1Hour"),
    "support_resistance": (["resistance", "support", "price_vs_resistance", "price_vs_support"],
                           "1Hour"),
}


def _panel_query(name: str, columns: list[str], frame: str) -> None:
    flags = set("doji hammer shooting_star trend_short trend_medium trend_long".split())
    shown = ", ".join(c if c in flags else S.r(c) for c in columns)
    make = S.hourly if frame == "1Hour" else S.minutely

    @query(name, make(f"SELECT symbol, timestamp, {shown} FROM panel"))
    def run(spark, sf):
        return t.panel(spark, sf, frame).select(*KEY, *columns)


for _name, (_columns, _frame) in PANEL_QUERIES.items():
    _panel_query(_name, _columns, _frame)


@query("volume_price_trend", S.minutely(f"SELECT symbol, timestamp, round(volume_price_trend, 1) AS volume_price_trend FROM panel"))
def volume_price_trend(spark, sf):
    return ind.volume_price_trend(t.candles(spark, sf, "1Min")).select(*KEY, _vpt())


_ALL = [c for c in ind.OUTPUT if c not in PANEL_QUERIES["candle_patterns"][0]
        + PANEL_QUERIES["trend_flags"][0]]


@query("indicator_panel", S.hourly(f"""SELECT symbol, timestamp, pos, doji, hammer, shooting_star,
  trend_short, trend_medium, trend_long, {S.r6(*_ALL)}, round(volume_price_trend, 1) AS volume_price_trend FROM panel"""))
def indicator_panel(spark, sf):
    return ind.full_panel(t.candles(spark, sf)).select(*KEY, "pos", *ind.OUTPUT, _vpt())


_SMALL = 512
_EDGE = ["change_4h", "sma_200", "ema_200", "macd", "macd_signal", "rsi", "bb_width", "atr", "volatility", "price_vs_resistance"]


@query("indicator_panel_blocks", S.minutely(f"""SELECT symbol, timestamp, pos, {S.r6(*_EDGE)},
  round(volume_price_trend, 1) AS volume_price_trend FROM panel"""))
def indicator_panel_blocks(spark, sf):
    """Minute bars in blocks of 512 rows and hourly buckets, so that every series crosses block edges."""
    bucket = F.date_trunc("hour", "timestamp")
    return ind.full_panel(t.candles(spark, sf, "1Min"), rows_per_block=_SMALL, bucket=bucket).select(
        *KEY, "pos", *_EDGE, _vpt())


@query("volume_price_trend_blocks", S.minutely("SELECT symbol, timestamp, round(volume_price_trend, 1) AS volume_price_trend FROM panel"))
def volume_price_trend_blocks(spark, sf):
    return ind.volume_price_trend(t.candles(spark, sf, "1Min"), rows_per_block=_SMALL).select(*KEY, _vpt())


@query("flagship", S.hourly(f"""SELECT symbol, timestamp, close, volume,
  {S.r6('change_1m', 'sma_20', 'rsi')} FROM panel"""))
def flagship(spark, sf):
    """Ticks to hourly bars with change, average and RSI."""
    return t.panel(spark, sf).select(*KEY, "close", "volume", "change_1m", "sma_20", "rsi")


_CHUNK = 500


@query("chunk_local_indicators", S.with_(
    S.TICKS, S.bars("1 minute", "raw"),
    f"""bars AS (SELECT * EXCLUDE (symbol), symbol AS sym, symbol || '/' || CAST(
      (row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1) // {_CHUNK} AS VARCHAR) AS symbol FROM raw)""",
    S.panel(), select=f"""SELECT sym AS symbol, CAST(split_part(symbol, '/', 2) AS BIGINT) AS chunk, timestamp, pos,
      {S.r6('change_1h', 'sma_200', 'ema_200', 'rsi', 'macd_signal', 'atr')}, round(volume_price_trend, 1) AS volume_price_trend FROM panel"""))
def chunk_local_indicators(spark, sf):
    return ind.chunk_local_panel(t.candles(spark, sf, "1Min"), _CHUNK).select(
        "symbol", "chunk", "timestamp", "pos", "change_1h", "sma_200", "ema_200", "rsi",
        "macd_signal", "atr", _vpt())


@query("row_position", S.with_(S.TICKS, S.bars("1 minute"), select="""SELECT symbol, timestamp,
  row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS pos FROM bars"""))
def row_position(spark, sf):
    bars = t.bars(spark, sf, "1Min").select(*KEY)
    return number_rows(bars, ["symbol"], ["timestamp"], bucket=day_of("timestamp"))


def _resample_query(frame: str, width: str, name: str) -> None:
    @query(name, S.with_(S.TICKS, S.bars(width), select=f"""SELECT symbol, timestamp, open, high, low,
      close, volume, trade_count, {S.r6('vwap')} FROM bars"""))
    def run(spark, sf):
        return t.bars(spark, sf, frame)


for _frame, _width in TIMEFRAMES.items():
    _resample_query(_frame, _width, "resample_bars" if _frame == "1Min"
                    else f"resample_bars_{_frame.lower()}")


# --- live context --------------------------------------------------------------------------------

def _context_sql(frame: str, where: str, extra: str) -> str:
    """Short-context indicators over list windows."""
    return S.with_(S.TICKS, S.bars(), "n AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS pos FROM bars)",
        f"""l AS (SELECT *, list(close) OVER w AS c, list(volume) OVER w AS v FROM n
          WINDOW w AS (PARTITION BY symbol ORDER BY pos ROWS BETWEEN {frame}))""",
        """m AS (SELECT *, len(c) AS k,
          CASE WHEN len(c) >= 5 THEN list_sum(c[-5:]) / 5 ELSE c[-1] END AS s5,
          CASE WHEN len(c) >= 20 THEN list_sum(c) / 20 ELSE c[-1] END AS s20,
          list_sum(v) / len(v) AS av,
          sqrt(list_sum(list_transform(range(2, 11), lambda i: pow((c[i] - c[i-1]) / c[i-1], 2))) / 9) * 100 AS rms
          FROM l)""",
        select=f"""SELECT symbol, timestamp, pos, {extra}
          CASE WHEN k >= 2 THEN round(s5 + 1e-9, 6) END AS sma_5, CASE WHEN k >= 2 THEN round(s20 + 1e-9, 6) END AS sma_20,
          CASE WHEN k >= 2 THEN round(c[-1] - c[-2] + 1e-9, 6) END AS price_change,
          CASE WHEN k >= 2 THEN round((c[-1] - c[-2]) / c[-2] * 100 + 1e-9, 6) END AS price_change_pct,
          CASE WHEN k >= 2 THEN round(CASE WHEN av > 0 THEN v[-1] / av ELSE 1 END + 1e-9, 6) END AS volume_ratio,
          CASE WHEN k >= 2 THEN round(CASE WHEN k >= 10 THEN rms ELSE 0 END + 1e-9, 6) END AS volatility,
          CASE WHEN k >= 2 THEN CASE WHEN s5 > s20 THEN 'bullish' WHEN s5 < s20 THEN 'bearish' ELSE 'neutral' END END AS trend
          FROM m {where}""")


_CONTEXT = ["sma_5", "sma_20", "price_change", "price_change_pct", "volume_ratio", "volatility",
            "trend"]


@query("recent_context_indicators", _context_sql("19 PRECEDING AND CURRENT ROW", "", ""))
def recent_context_indicators(spark, sf):
    return live.recent_context(t.candles(spark, sf), digits=None).select(*KEY, "pos", *_CONTEXT)


@query("backtest_context", _context_sql("20 PRECEDING AND 1 PRECEDING", "WHERE pos >= 20",
                                        "close AS latest_price,"))
def backtest_context(spark, sf):
    return live.backtest_context(t.candles(spark, sf), digits=None).select(
        *KEY, "pos", "latest_price", *_CONTEXT)


@query("momentum_5v5", S.with_(S.TICKS, S.bars(), """m AS (SELECT symbol, timestamp,
    row_number() OVER (PARTITION BY symbol ORDER BY timestamp) AS n,
    avg(close) OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ra,
    avg(close) OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 9 PRECEDING AND 5 PRECEDING) AS oa FROM bars)""",
    select="""SELECT symbol, timestamp, CASE WHEN n >= 10 THEN round(ra + 1e-9, 6) END AS recent_avg,
    CASE WHEN n >= 10 THEN round(oa + 1e-9, 6) END AS older_avg,
    CASE WHEN n >= 10 THEN CASE WHEN ra > oa * 1.02 THEN 'bullish' WHEN ra < oa * 0.98 THEN 'bearish' ELSE 'none' END END AS momentum
    FROM m"""))
def momentum_5v5(spark, sf):
    return live.momentum_5v5(t.candles(spark, sf))


# --- cleaning and checks -------------------------------------------------------------------------

_DIRTY = """dirty AS (SELECT symbol, timestamp, open, CASE WHEN vwap > open THEN vwap ELSE open END AS high,
  CASE WHEN vwap < close THEN vwap ELSE close END AS low, close, volume - 100.0 AS volume FROM bars)"""
_BAD = "high < low OR high < open OR high < close OR low > open OR low > close"
_OHLCV = f"symbol, timestamp, open, {S.r6('high', 'low')}, close, volume"


@query("valid_ohlc", S.with_(S.TICKS, S.bars(), _DIRTY,
                             select=f"SELECT {_OHLCV} FROM dirty WHERE NOT ({_BAD})"))
def valid_ohlc(spark, sf):
    return quality.valid_ohlc(t.dirty_candles(spark, sf))


@query("valid_volume", S.with_(S.TICKS, S.bars(), _DIRTY,
                               select=f"SELECT {_OHLCV} FROM dirty WHERE volume >= 0"))
def valid_volume(spark, sf):
    return quality.valid_volume(t.dirty_candles(spark, sf))


@query("rejected_counts", S.with_(S.TICKS, S.bars(), _DIRTY, select=f"""SELECT symbol, count(*) AS rows,
  count(*) FILTER ({_BAD}) AS invalid_ohlc,
  count(*) FILTER (NOT ({_BAD}) AND volume < 0) AS invalid_volume FROM dirty GROUP BY 1"""))
def rejected_counts(spark, sf):
    return quality.rejected_counts(t.dirty_candles(spark, sf), "symbol")


@query("dropna_any", S.with_(S.TICKS, S.bars("1 minute"), select="""SELECT symbol, timestamp, close,
  round(vwap + 1e-9, 6) AS vwap FROM bars WHERE vwap IS NOT NULL"""))
def dropna_any(spark, sf):
    return quality.dropna_any(t.bars(spark, sf, "1Min")).select(*KEY, "close", "vwap")


@query("require_columns", S.with_(S.TICKS, S.bars(), select="""SELECT symbol, timestamp, open, high, low,
  close, volume FROM bars"""))
def require_columns(spark, sf):
    return quality.require_columns(t.candles(spark, sf))


@query("tidy_series", S.with_(S.TICKS, S.bars(), select="SELECT symbol, timestamp, close, volume, 0 AS arrival FROM bars"))
def tidy_series(spark, sf):
    return quality.tidy_series(t.redelivered(spark, sf), "symbol", "timestamp", "arrival")


@query("continuity_check", S.with_(S.TICKS, S.bars("1 minute"), """two AS (
  SELECT symbol, timestamp FROM bars UNION ALL SELECT symbol, timestamp FROM bars WHERE volume > 50),
  d AS (SELECT symbol, coalesce(floor(epoch(timestamp - lag(timestamp) OVER (PARTITION BY symbol ORDER BY timestamp))), 60) AS d FROM two)""",
  select="""SELECT symbol, count(*) AS rows, count(*) FILTER (d > 60) AS gaps,
  count(*) FILTER (d = 0) AS duplicates FROM d GROUP BY 1"""))
def continuity_check(spark, sf):
    bars = t.bars(spark, sf, "1Min").select("symbol", "timestamp", "volume")
    return perf.continuity_check(bars.unionByName(bars.filter("volume > 50")), "symbol")


@query("coverage_pct", S.with_(S.TICKS, S.bars("1 minute"), """c AS (SELECT symbol, count(*) AS rows,
  CAST(ceil(epoch(max(timestamp) - min(timestamp)) / 60.0) AS BIGINT) AS expected FROM bars GROUP BY 1)""",
  select="SELECT symbol, rows, expected, round(least(1.0, rows / expected) + 1e-9, 6) AS coverage FROM c"))
def coverage_pct(spark, sf):
    return perf.coverage_pct(t.bars(spark, sf, "1Min"), "symbol")


@query("sort_combined", S.with_(S.TICKS, S.bars(), select="SELECT symbol, timestamp, open, close FROM bars ORDER BY symbol, timestamp"))
def sort_combined(spark, sf):
    return quality.sort_combined(t.bars(spark, sf).select(*KEY, "open", "close"), *KEY)


@query("union_assets", S.with_(S.TICKS, S.bars(), S.bars("1 day", "days"), select="""SELECT symbol, timestamp,
  close, volume FROM bars UNION ALL SELECT symbol, timestamp, close, volume FROM days"""))
def union_assets(spark, sf):
    cols = [*KEY, "close", "volume"]
    return quality.union_assets(t.bars(spark, sf).select(cols),
                                t.bars(spark, sf, "1Day").select(cols))


@query("symbol_filter", S.with_(S.TICKS, select="SELECT trade_id, symbol, timestamp, price, size FROM ticks WHERE symbol IN ('click', 'view')"))
def symbol_filter(spark, sf):
    return quality.symbol_filter(t.ticks(spark, sf), "click", "view")


def _last_n(name: str, source: str, cols: str, order: str) -> str:
    return S.with_(S.TICKS, S.bars(), select=f"""SELECT {cols} FROM (SELECT *, row_number() OVER (
      PARTITION BY symbol ORDER BY {order}) AS r FROM {source}) WHERE r <= 10""")


@query("last_n_bars", _last_n("bars", "bars", "symbol, timestamp, close, volume", "timestamp DESC"))
def last_n_bars(spark, sf):
    return quality.last_n(t.bars(spark, sf).select(*KEY, "close", "volume"), 10, ["timestamp"])


@query("last_n_trades", _last_n("ticks", "ticks", "symbol, timestamp, trade_id, price, size",
                                "timestamp DESC, trade_id DESC"))
def last_n_trades(spark, sf):
    return quality.last_n(t.ticks(spark, sf), 10, ["timestamp", "trade_id"])


_QUOTES = """quotes AS (SELECT symbol, timestamp, trade_id, round(price * 0.999 + 1e-9, 6) AS bid_price,
  round(price * 1.001 + 1e-9, 6) AS ask_price FROM ticks)"""


@query("last_n_quotes", S.with_(S.TICKS, _QUOTES, select="""SELECT symbol, timestamp, trade_id, bid_price, ask_price
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, trade_id DESC) AS r FROM quotes)
  WHERE r <= 10"""))
def last_n_quotes(spark, sf):
    quotes = t.ticks(spark, sf).select(
        *KEY, "trade_id", (F.col("price") * 0.999).alias("bid_price"),
        (F.col("price") * 1.001).alias("ask_price"))
    return quality.last_n(quotes, 10, ["timestamp", "trade_id"])


@query("latest_price", S.with_(S.TICKS, S.bars("1 minute"), select="SELECT symbol, arg_max(close, timestamp) AS latest_price FROM bars GROUP BY 1"))
def latest_price(spark, sf):
    return quality.latest_price(t.bars(spark, sf, "1Min"))


@query("latest_quote_proxy", S.with_(S.TICKS, S.bars("1 minute"), select="""SELECT symbol, arg_max(close, timestamp) AS price,
  max(timestamp) AS timestamp, arg_max(volume, timestamp) AS volume FROM bars GROUP BY 1"""))
def latest_quote_proxy(spark, sf):
    return quality.latest_quote_proxy(t.bars(spark, sf, "1Min"))
