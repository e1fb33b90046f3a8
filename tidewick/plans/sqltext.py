"""SQL building blocks for the SQL each query is compared with (DuckDB dialect)."""

from __future__ import annotations

TICKS = """ticks AS (
  SELECT event_id AS trade_id, ts AS timestamp, event_type AS symbol, value AS price,
         CAST(json_extract(props, '$.k') AS DOUBLE) AS size FROM events)"""


def bars(width: str = "1 hour", name: str = "bars") -> str:
    return f"""{name} AS (
  SELECT time_bucket(INTERVAL '{width}', timestamp, TIMESTAMP '2000-01-01') AS timestamp, symbol,
    arg_min(price, (timestamp, trade_id)) AS open, max(price) AS high, min(price) AS low,
    arg_max(price, (timestamp, trade_id)) AS close, sum(size) AS volume,
    count(*) AS trade_count,
    CASE WHEN sum(size) <> 0 THEN sum(price * size) / sum(size) END AS vwap
  FROM ticks GROUP BY 1, 2)"""


def _r(n: int) -> str:
    return f"OVER (PARTITION BY symbol ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _ewm(n: int, col: str, name: str) -> str:
    r = 1 - 2 / (n + 1)
    weight = f"pow({r!r}, a.pos - b.pos)"
    return f"sum(b.{col} * {weight}) / sum({weight}) AS {name}"


def panel(source: str = "bars") -> str:
    """CTEs p0..panel over a table with symbol, timestamp, open, high, low, close, volume."""
    w = "OVER (PARTITION BY symbol ORDER BY timestamp)"
    lags = {"change_5m": 5, "change_15m": 15, "change_1h": 60, "change_4h": 240, "change_24h": 1440}
    changes = ",\n    ".join(
        f"coalesce((close - lag(close, {n}) {w}) / nullif(lag(close, {n}) {w}, 0) * 100, 0) AS {k}"
        for k, n in lags.items())
    smas = ",\n    ".join(f"CASE WHEN pos >= {n - 1} THEN avg(close) {_r(n)} END AS sma_{n}"
                          for n in (5, 10, 20, 50, 100, 200))
    emas = ",\n    ".join(_ewm(n, "close", f"ema_{n}") for n in (5, 10, 20, 50, 100, 200, 12, 26))
    return f"""p0 AS (SELECT *, row_number() {w} - 1 AS pos, lag(close) {w} AS prev,
    (close / nullif(lag(close) {w}, 0) - 1) * 100 AS change_1m,
    {changes} FROM {source}),
p1 AS (SELECT *, greatest(coalesce(close - prev, 0), 0) AS gain,
    greatest(coalesce(prev - close, 0), 0) AS loss,
    CASE WHEN prev IS NOT NULL THEN greatest(high - low, abs(high - prev), abs(low - prev)) END AS tr
  FROM p0),
p2 AS (SELECT *, {smas},
    CASE WHEN pos >= 19 THEN stddev_samp(close) {_r(20)} END AS sd20,
    CASE WHEN pos >= 13 THEN avg(gain) {_r(14)} END AS ag,
    CASE WHEN pos >= 13 THEN avg(loss) {_r(14)} END AS al,
    CASE WHEN pos >= 14 THEN avg(tr) {_r(14)} END AS atr,
    CASE WHEN pos >= 13 THEN max(high) {_r(14)} END AS hi14,
    CASE WHEN pos >= 13 THEN min(low) {_r(14)} END AS lo14,
    CASE WHEN pos >= 19 THEN max(high) {_r(20)} END AS resistance,
    CASE WHEN pos >= 19 THEN min(low) {_r(20)} END AS support,
    CASE WHEN pos >= 19 THEN avg(volume) {_r(20)} END AS volume_sma,
    CASE WHEN pos > 0 THEN sum(volume * change_1m)
      OVER (PARTITION BY symbol ORDER BY pos ROWS UNBOUNDED PRECEDING) END AS volume_price_trend
  FROM p1),
p3 AS (SELECT *, 100 * (close - lo14) / nullif(hi14 - lo14, 0) AS stoch_k,
    -100 * (hi14 - close) / nullif(hi14 - lo14, 0) AS williams_r FROM p2),
ema AS (SELECT a.symbol, a.pos, {emas}
  FROM p0 a JOIN p0 b ON a.symbol = b.symbol AND b.pos <= a.pos GROUP BY 1, 2),
macd AS (SELECT *, ema_12 - ema_26 AS macd FROM ema),
msig AS (SELECT a.symbol, a.pos, {_ewm(9, "macd", "macd_signal")}
  FROM macd a JOIN macd b ON a.symbol = b.symbol AND b.pos <= a.pos GROUP BY 1, 2),
p4 AS (SELECT p3.*, macd.* EXCLUDE (symbol, pos), macd_signal, macd - macd_signal AS macd_histogram,
    CASE WHEN count(stoch_k) {_r(3).replace("symbol", "p3.symbol").replace("pos", "p3.pos")} = 3
      THEN avg(stoch_k) {_r(3).replace("symbol", "p3.symbol").replace("pos", "p3.pos")} END AS stoch_d,
    CASE WHEN al = 0 THEN CASE WHEN ag > 0 THEN 100.0 END ELSE 100 - 100 / (1 + ag / nullif(al, 0)) END AS rsi,
    sma_20 AS bb_middle, sma_20 + 2 * sd20 AS bb_upper, sma_20 - 2 * sd20 AS bb_lower,
    4 * sd20 / nullif(sma_20, 0) AS bb_width,
    (close - (sma_20 - 2 * sd20)) / nullif((sma_20 + 2 * sd20) - (sma_20 - 2 * sd20), 0) AS bb_position,
    volume / nullif(volume_sma, 0) AS volume_ratio, sd20 / nullif(sma_20, 0) AS volatility,
    CASE WHEN abs(open - close) / nullif(high - low, 0) < 0.1 THEN 1 ELSE 0 END AS doji,
    CASE WHEN (close - low) > 2 * (open - close) AND close > open THEN 1 ELSE 0 END AS hammer,
    CASE WHEN (high - close) > 2 * (close - open) AND close < open THEN 1 ELSE 0 END AS shooting_star,
    CASE WHEN close > sma_20 THEN 1 ELSE 0 END AS trend_short,
    CASE WHEN close > sma_50 THEN 1 ELSE 0 END AS trend_medium,
    CASE WHEN close > sma_200 THEN 1 ELSE 0 END AS trend_long,
    (close - resistance) / nullif(resistance, 0) AS price_vs_resistance,
    (close - support) / nullif(support, 0) AS price_vs_support
  FROM p3 JOIN macd USING (symbol, pos) JOIN msig USING (symbol, pos)),
panel AS (SELECT * FROM p4)"""


FEAR_GREED_SIMPLE = """CASE WHEN rsi < 30 AND bb_position < 0.3 THEN 'Extreme Fear' WHEN rsi < 40 THEN 'Fear'
  WHEN rsi > 70 AND bb_position > 0.7 THEN 'Extreme Greed' WHEN rsi > 60 THEN 'Greed' ELSE 'Neutral' END"""
_FG = """(CASE WHEN rsi < 20 THEN 3 WHEN rsi < 30 THEN 2 WHEN rsi > 80 THEN -3 WHEN rsi > 70 THEN -2 ELSE 0 END
  + CASE WHEN bb_position < 0.1 THEN 2 WHEN bb_position > 0.9 THEN -2 ELSE 0 END
  + CASE WHEN volume_ratio > 2 THEN 1 WHEN volume_ratio < 0.5 THEN -1 ELSE 0 END)"""
FEAR_GREED_SCORE = f"""CASE WHEN {_FG} >= 3 THEN 'Extreme Greed' WHEN {_FG} >= 1 THEN 'Greed'
  WHEN {_FG} <= -3 THEN 'Extreme Fear' WHEN {_FG} <= -1 THEN 'Fear' ELSE 'Neutral' END"""
TREND_SIMPLE = """CASE WHEN close > sma_20 AND close > sma_50 THEN 'Bullish'
  WHEN close < sma_20 AND close < sma_50 THEN 'Bearish' ELSE 'Sideways' END"""
TREND_FLAGS = """CASE WHEN trend_short + trend_medium + trend_long = 3 THEN 'Strong Bullish'
  WHEN trend_short + trend_medium = 2 THEN 'Bullish'
  WHEN trend_short + trend_medium + trend_long = 0 THEN 'Strong Bearish'
  WHEN trend_short + trend_medium = 0 THEN 'Bearish' ELSE 'Sideways' END"""
VOLATILITY_REGIME = """CASE WHEN volatility > 0.05 THEN 'High Volatility'
  WHEN volatility > 0.02 THEN 'Medium Volatility' ELSE 'Low Volatility' END"""
VOLUME_REGIME = """CASE WHEN volume_ratio > 2 THEN 'High Volume'
  WHEN volume_ratio > 1.5 THEN 'Above Average Volume' WHEN volume_ratio < 0.5 THEN 'Low Volume'
  ELSE 'Normal Volume' END"""
CONFIDENCE_INDICATOR = """least(0.95, 0.5
  + CASE WHEN rsi < 25 OR rsi > 75 THEN 0.3 WHEN rsi < 35 OR rsi > 65 THEN 0.2 ELSE 0.0 END
  + CASE WHEN bb_position < 0.1 OR bb_position > 0.9 THEN 0.2
         WHEN bb_position < 0.3 OR bb_position > 0.7 THEN 0.1 ELSE 0.0 END)"""
_RULE = """CASE WHEN {0} THEN '{1}' {2} END"""


def words(*options: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{t}'" for c, t in options) + " END"


REASONING_SHORT = ("coalesce(nullif(concat_ws('. ', " + ", ".join([
    words(("rsi < 30", "RSI indicates oversold conditions"),
          ("rsi > 70", "RSI indicates overbought conditions")),
    words(("bb_position < 0.2", "Price near lower Bollinger Band"),
          ("bb_position > 0.8", "Price near upper Bollinger Band")),
    words(("macd > macd_signal", "MACD shows bullish momentum"),
          ("macd < macd_signal", "MACD shows bearish momentum"))])
    + "), ''), 'Mixed technical signals') || '.'")
STOP_LOSS_PCT = """CASE WHEN volatility > 0.05 THEN least(5.0, atr * 2 / close * 100)
  ELSE least(3.0, atr * 1.5 / close * 100) END"""

# Advanced signal as a chain of CTEs ending in ``adv`` (signal, confidence, reasoning).
ADVANCED = f"""a1 AS (SELECT *,
    CASE WHEN rsi < 25 THEN 3 WHEN rsi < 35 THEN 2 ELSE 0 END
    + CASE WHEN macd > macd_signal AND macd > 0 THEN 2 WHEN macd < macd_signal AND macd < 0 THEN 0
           WHEN macd > macd_signal THEN 1 ELSE 0 END
    + CASE WHEN bb_position < 0.1 THEN 2 WHEN bb_position < 0.3 THEN 1 ELSE 0 END
    + CASE WHEN stoch_k < 20 AND stoch_k > stoch_d THEN 1 ELSE 0 END
    + CASE WHEN williams_r < -80 THEN 1 ELSE 0 END
    + CASE WHEN trend_short = 1 AND trend_medium = 1 THEN 2 ELSE 0 END AS b0,
    CASE WHEN rsi > 75 THEN 3 WHEN rsi > 65 THEN 2 ELSE 0 END
    + CASE WHEN macd < macd_signal AND macd < 0 THEN 2 WHEN macd < macd_signal THEN 1 ELSE 0 END
    + CASE WHEN bb_position > 0.9 THEN 2 WHEN bb_position > 0.7 THEN 1 ELSE 0 END
    + CASE WHEN stoch_k > 80 AND stoch_k < stoch_d THEN 1 ELSE 0 END
    + CASE WHEN williams_r > -20 THEN 1 ELSE 0 END
    + CASE WHEN trend_short = 0 AND trend_medium = 0 THEN 2 ELSE 0 END AS s0 FROM panel),
a2 AS (SELECT *,
    b0 + CASE WHEN volume_ratio > 1.5 AND b0 > s0 THEN 1 ELSE 0 END + hammer AS b,
    s0 + CASE WHEN volume_ratio > 1.5 AND s0 > b0 THEN 1 ELSE 0 END + shooting_star AS s FROM a1),
adv AS (SELECT * EXCLUDE (b0, s0, b, s),
    CASE WHEN b > s THEN 'BUY' WHEN s > b THEN 'SELL' ELSE 'HOLD' END AS signal,
    CASE WHEN b = s THEN 0.5 ELSE least(0.95, 0.5 + abs(b - s) / 10) END AS confidence,
    CASE WHEN b + s = 0 THEN 'Mixed signals with no clear direction' ELSE concat_ws('. ',
      {words(("rsi < 25", "RSI indicates extreme oversold conditions"),
             ("rsi < 35", "RSI indicates oversold conditions"),
             ("rsi > 75", "RSI indicates extreme overbought conditions"),
             ("rsi > 65", "RSI indicates overbought conditions"))},
      {words(("macd > macd_signal AND macd > 0", "MACD shows bullish momentum above zero line"),
             ("macd < macd_signal AND macd < 0", "MACD shows bearish momentum below zero line"),
             ("macd > macd_signal", "MACD shows bullish crossover"),
             ("macd < macd_signal", "MACD shows bearish crossover"))},
      {words(("bb_position < 0.1", "Price near lower Bollinger Band (oversold)"),
             ("bb_position > 0.9", "Price near upper Bollinger Band (overbought)"),
             ("bb_position < 0.3", "Price in lower half of Bollinger Bands"),
             ("bb_position > 0.7", "Price in upper half of Bollinger Bands"))},
      {words(("stoch_k < 20 AND stoch_k > stoch_d", "Stochastic shows oversold with bullish crossover"),
             ("stoch_k > 80 AND stoch_k < stoch_d", "Stochastic shows overbought with bearish crossover"))},
      {words(("williams_r < -80", "Williams %R indicates oversold conditions"),
             ("williams_r > -20", "Williams %R indicates overbought conditions"))},
      {words(("trend_short = 1 AND trend_medium = 1", "Strong bullish trend confirmed by moving averages"),
             ("trend_short = 0 AND trend_medium = 0", "Strong bearish trend confirmed by moving averages"))},
      {words(("volume_ratio > 1.5 AND b0 > s0", "High volume confirms buying pressure"),
             ("volume_ratio > 1.5 AND s0 > b0", "High volume confirms selling pressure"))},
      {words(("hammer = 1", "Hammer pattern detected (bullish reversal)"))},
      {words(("shooting_star = 1", "Shooting star pattern detected (bearish reversal)"))}) || '.' END AS reasoning
  FROM a2)"""

MARKET_CAP = """close * CASE symbol WHEN 'BTC-USD' THEN 21000000.0 WHEN 'ETH-USD' THEN 120000000.0
  WHEN 'SOL-USD' THEN 500000000.0 WHEN 'DOGE-USD' THEN 140000000000.0 ELSE 1000000.0 END"""

# Labelled rows (advanced variant) as CTE ``lab``.
LABELLED = f"""lab AS (SELECT *, {MARKET_CAP} AS market_cap, {FEAR_GREED_SCORE} AS fear_greed,
    {TREND_FLAGS} AS trend, {VOLATILITY_REGIME} AS volatility_regime,
    {VOLUME_REGIME} AS volume_regime, {STOP_LOSS_PCT} AS stop_pct FROM adv)"""

SAMPLED = """sampled AS (SELECT * FROM lab WHERE pos >= 200 AND (pos - 200) % 240 = 0
  AND rsi IS NOT NULL AND macd IS NOT NULL AND bb_position IS NOT NULL)"""

TRADES = """trades AS (SELECT o_orderkey AS trade_id, o_custkey AS account, o_orderpriority AS symbol,
    o_orderdate AS timestamp,
    CASE o_orderstatus WHEN 'F' THEN 'sell' WHEN 'O' THEN 'buy' ELSE 'hold' END AS action,
    CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE 'rejected' END AS status,
    o_totalprice AS price,
    CASE WHEN o_orderkey % 3 = 0 THEN -1.0 ELSE 1.0 END * o_totalprice / 1000.0 AS pnl,
    (o_orderkey % 100) / 100.0 AS confidence, 'order ' || o_orderstatus AS reasoning FROM orders)"""

POSITIONS = """positions AS (SELECT l_suppkey AS account, l_returnflag AS symbol, sum(l_quantity) AS qty,
    sum(l_extendedprice * (1 - l_discount)) AS market_value, sum(l_extendedprice) AS cost_basis,
    sum(l_extendedprice * (1 - l_discount)) / sum(l_extendedprice) - 1.0 AS unrealized_plpc
  FROM lineitem GROUP BY 1, 2)"""

TOKEN = (r"[^\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+")
MEMORY = f"""items AS (SELECT md5(conv_id || ':' || turn) AS id, CAST(conv_id AS VARCHAR) AS agent_id,
    text AS content,
    CASE role WHEN 'user' THEN 'trade_result' WHEN 'assistant' THEN 'analysis' ELSE 'system' END AS memory_type,
    TIMESTAMP '2024-01-01' + to_seconds((conv_id % 720) * 3600 + turn * 60) AS timestamp,
    ((conv_id * 7 + turn * 13) % 100) / 100.0 AS importance, role,
    CASE turn % 3 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' ELSE 'HOLD' END AS signal,
    (conv_id * 3 + turn * 5) % 7 - 3 AS pnl,
    len(regexp_extract_all(text, '{TOKEN}')) AS token_count FROM conversations)"""
AGENTS = """agents AS (SELECT agent_id,
    CASE CAST(agent_id AS BIGINT) % 4 WHEN 0 THEN 'default' WHEN 1 THEN 'conservative'
      WHEN 2 THEN 'aggressive' ELSE 'research' END AS agent_type,
    min(timestamp) AS created_at, max(timestamp) AS last_active, CAST(sum(token_count) AS BIGINT) AS total_tokens_used,
    count(*) AS memory_count, avg(CASE WHEN importance > 0.5 THEN 1.0 ELSE 0.0 END) AS win_rate,
    CAST(sum(pnl) AS DOUBLE) AS total_pnl, avg(importance) AS avg_confidence,
    count(*) > 4 AS is_active FROM items GROUP BY 1)"""


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def hourly(select: str, *more: str) -> str:
    """Over the hourly panel."""
    return with_(TICKS, bars(), panel(), *more, select=select)


def minutely(select: str, *more: str) -> str:
    return with_(TICKS, bars("1 minute"), panel(), *more, select=select)


def r(expr: str, name: str | None = None) -> str:
    """Rounded output column, with the same nudge as the Spark side."""
    return f"round({expr} + 1e-9, 6) AS {name or expr}"


def r6(*cols: str) -> str:
    return ", ".join(r(c) for c in cols)
