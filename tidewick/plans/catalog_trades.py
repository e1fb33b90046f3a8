"""Queries over trades, positions and orders: performance, alerts and risk."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewick.operators import performance as perf, risk
from tidewick.operators.quality import orders_filter
from tidewick.plans import sqltext as S, tables as t
from tidewick.plans.registry import query
from tidewick.sources import readers, writers

L = t.LIMITS
ORDER = ["timestamp", "trade_id"]
AS_OF = "TIMESTAMP '1998-08-01'"
W = "OVER (PARTITION BY symbol ORDER BY timestamp, trade_id ROWS UNBOUNDED PRECEDING)"

# Drawdown per symbol: running P&L, running peak from zero.
_CURVE = f"""c1 AS (SELECT *, sum(pnl) {W} AS cum FROM trades),
  c2 AS (SELECT *, greatest(0, max(cum) {W}) AS peak FROM c1),
  dd AS (SELECT symbol, max(peak - cum) AS max_drawdown, max(peak) AS final_peak FROM c2 GROUP BY 1)"""
_DD_PCT = "CASE WHEN final_peak > 0 THEN max_drawdown / greatest(final_peak, 1) * 100 ELSE 0 END"


@query("drawdown", S.with_(S.TRADES, _CURVE, select=f"""SELECT symbol, {S.r('max_drawdown')},
  {S.r(_DD_PCT, 'max_drawdown_pct')} FROM dd"""))
def drawdown(spark, sf):
    return perf.drawdown(t.trades(spark, sf), ["symbol"], ORDER, bucket=t.day_bucket())


_METRICS = f"""met AS (SELECT symbol, count(*) AS total_trades, count(*) FILTER (pnl > 0) AS winning_trades,
    count(*) FILTER (pnl <= 0) AS losing_trades, sum(pnl) AS total_pnl,
    coalesce(sum(pnl) FILTER (pnl > 0), 0) / greatest(count(*) FILTER (pnl > 0), 1) AS avg_win,
    coalesce(sum(pnl) FILTER (pnl < 0), 0) / greatest(count(*) FILTER (pnl <= 0), 1) AS avg_loss,
    count(*) / greatest(epoch(max(timestamp) - min(timestamp)) / 3600.0, 1) AS trades_per_hour
  FROM trades GROUP BY 1),
  metrics AS (SELECT *, 100.0 * winning_trades / total_trades AS win_rate, {_DD_PCT} AS max_drawdown_pct,
    CASE WHEN avg_loss <> 0 THEN abs(avg_win / avg_loss) ELSE 0 END AS profit_factor FROM met JOIN dd USING (symbol))"""


@query("performance_metrics", S.with_(S.TRADES, _CURVE, _METRICS, select=f"""SELECT symbol, total_trades,
  winning_trades, losing_trades, {S.r6('win_rate', 'total_pnl', 'avg_win', 'avg_loss', 'max_drawdown',
  'max_drawdown_pct', 'trades_per_hour', 'profit_factor')} FROM metrics"""))
def performance_metrics(spark, sf):
    return perf.performance_metrics(t.trades(spark, sf), ["symbol"], ORDER, bucket=t.day_bucket(),
                                    digits=None)


_WN = "OVER (PARTITION BY symbol ORDER BY timestamp, trade_id)"
_CLOSED = f"""closed AS (SELECT symbol, row_number() {_WN} - 1 AS trade_no, action, confidence, price,
  lead(price) {_WN} AS exit_price FROM trades QUALIFY exit_price IS NOT NULL)"""


@query("next_trade_exit", S.with_(S.TRADES, _CLOSED, select="SELECT symbol, trade_no, action, round(confidence + 1e-9, 6) AS confidence, price, exit_price FROM closed"))
def next_trade_exit(spark, sf):
    return perf.next_trade_exit(t.trades(spark, sf), ORDER, bucket=t.day_bucket())


@query("backtest_performance", S.with_(S.TRADES, _CLOSED, """p AS (SELECT confidence,
  CASE action WHEN 'buy' THEN (exit_price - price) / price WHEN 'sell' THEN (price - exit_price) / price ELSE 0 END
  * confidence AS pnl FROM closed),
  q AS (SELECT count(*) AS total_trades, count(*) FILTER (pnl > 0) AS winning_trades, count(*) FILTER (pnl < 0) AS losing_trades,
  sum(pnl) AS total_pnl, avg(pnl) AS avg_pnl, max(pnl) AS max_pnl, min(pnl) AS min_pnl, stddev_samp(pnl) AS sd,
  avg(confidence) AS avg_confidence FROM p)""", select=f"""SELECT total_trades, winning_trades, losing_trades,
  {S.r('100.0 * winning_trades / total_trades', 'win_rate')}, {S.r6('total_pnl', 'avg_pnl', 'max_pnl', 'min_pnl')},
  {S.r('CASE WHEN sd > 0 THEN avg_pnl / sd ELSE 0 END', 'sharpe_ratio')}, {S.r('avg_confidence')} FROM q"""))
def backtest_performance(spark, sf):
    closed = perf.next_trade_exit(t.trades(spark, sf), ORDER, bucket=t.day_bucket())
    return perf.backtest_performance(closed, exact=True)


@query("session_metrics", S.with_(S.TRADES, select=f"""SELECT account AS session, count(*) AS total_trades,
  count(*) FILTER (pnl > 0) AS profitable_trades, {S.r('sum(pnl)', 'total_pnl')},
  {S.r('epoch(max(timestamp) - min(timestamp)) / 3600.0', 'session_duration_hours')},
  {S.r('count(*) FILTER (pnl > 0) / count(*)', 'win_rate')} FROM trades GROUP BY 1"""))
def session_metrics(spark, sf):
    return perf.session_metrics(t.trades(spark, sf).withColumnRenamed("account", "session"),
                                "session")


@query("trade_status_counts", S.with_(S.TRADES, select="""SELECT count(*) AS total_trades,
  count(*) FILTER (action <> 'hold' AND status = 'filled') AS filled_trades,
  count(*) FILTER (action <> 'hold' AND status = 'rejected') AS rejected_trades,
  count(*) FILTER (action <> 'hold' AND confidence > 0.7) AS high_confidence_trades,
  count(*) FILTER (action <> 'hold' AND confidence <= 0.7) AS low_confidence_trades FROM trades"""))
def trade_status_counts(spark, sf):
    return perf.trade_status_counts(t.trades(spark, sf))


# --- logs ----------------------------------------------------------------------------------------

@query("log_type_filter", S.with_(S.TRADES, select=f"""SELECT trade_id, symbol, timestamp, action FROM trades
  WHERE timestamp > {AS_OF} - INTERVAL 720 HOURS"""))
def log_type_filter(spark, sf):
    return perf.recent(t.trades(spark, sf), t.trades_as_of(), 720).select(
        "trade_id", "symbol", "timestamp", "action")


@query("trade_summary", S.with_(S.TRADES, select=f"""SELECT coalesce(symbol, 'ALL') AS symbol, count(*) AS total_trades,
  count(*) FILTER (action = 'buy') AS buys, count(*) FILTER (action = 'sell') AS sells,
  count(*) FILTER (action = 'hold') AS holds FROM trades WHERE timestamp > {AS_OF} - INTERVAL 2160 HOURS
  GROUP BY ROLLUP (symbol)"""))
def trade_summary(spark, sf):
    return perf.trade_summary(perf.recent(t.trades(spark, sf), t.trades_as_of(), 2160))


@query("latest_performance", S.with_(S.TRADES, select="""SELECT arg_max(pnl_text, (timestamp, trade_id)) AS latest_performance,
  count(*) AS total_logs FROM (SELECT *, symbol || ':' || status AS pnl_text FROM trades)"""))
def latest_performance(spark, sf):
    log = t.trades(spark, sf).select(
        F.concat_ws(":", "symbol", "status").alias("data"),
        F.struct("timestamp", "trade_id").alias("timestamp"))
    return perf.latest_performance(log)


_ALERTS = """alerts AS (SELECT trade_id, timestamp, CASE WHEN pnl < -300 THEN 'drawdown_alert'
  WHEN confidence < 0.3 THEN 'low_win_rate' ELSE 'high_frequency' END AS type FROM trades
  WHERE pnl < -300 OR confidence < 0.3 OR pnl > 400)"""


@query("alert_summary", S.with_(S.TRADES, _ALERTS, select="""SELECT type, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS recent_alerts,
  (SELECT count(*) FROM alerts) AS total_alerts FROM (SELECT * FROM alerts ORDER BY timestamp DESC, trade_id DESC LIMIT 50) GROUP BY 1"""))
def alert_summary(spark, sf):
    kind = F.expr("CASE WHEN pnl < -300 THEN 'drawdown_alert' WHEN confidence < 0.3 "
                  "THEN 'low_win_rate' ELSE 'high_frequency' END")
    alerts = t.trades(spark, sf).filter("pnl < -300 OR confidence < 0.3 OR pnl > 400").select(
        "trade_id", "timestamp", kind.alias("type"))
    return perf.alert_summary(alerts, ORDER)


#: Added before values are printed, here and in the SQL: sums of decimals often lie on rounding ties.
_OFF_TIE = 1e-8


@query("performance_alerts", S.with_(S.TRADES, _CURVE, _METRICS, """off AS (SELECT symbol, max_drawdown + 1e-8 AS max_drawdown,
    win_rate + 1e-8 AS win_rate, trades_per_hour + 1e-8 AS trades_per_hour FROM metrics)""", select=f"""SELECT symbol, type, severity, message, {S.r('value')}, {S.r('threshold')} FROM (
  SELECT symbol, 'drawdown_alert' AS type, 'high' AS severity, printf('Drawdown exceeded threshold: %.2f%%', max_drawdown * 100) AS message,
    max_drawdown AS value, 900.0 AS threshold FROM off WHERE max_drawdown >= 900
  UNION ALL SELECT symbol, 'low_win_rate', 'medium', printf('Low win rate: %.2f%%', win_rate * 100), win_rate, 66.5 FROM off WHERE win_rate < 66.5
  UNION ALL SELECT symbol, 'high_frequency', 'medium', printf('High trading frequency: %.1f trades/hour', trades_per_hour), trades_per_hour, 0.05
    FROM off WHERE trades_per_hour > 0.05)"""))
def performance_alerts(spark, sf):
    metrics = perf.performance_metrics(t.trades(spark, sf), ["symbol"], ORDER,
                                       bucket=t.day_bucket(), digits=None)
    metrics = metrics.withColumns({x: F.col(x) + _OFF_TIE for x in ("max_drawdown", "win_rate", "trades_per_hour")})
    return risk.performance_alerts(metrics, ["symbol"], drawdown_threshold=900.0,
                                   win_rate_threshold=66.5, hourly_threshold=0.05)


# --- risk ----------------------------------------------------------------------------------------

_WD = "OVER (PARTITION BY account, day ORDER BY timestamp, trade_id ROWS UNBOUNDED PRECEDING)"
_DAILY = f"""daily AS (SELECT *, sum(pnl) {_WD} AS daily_pnl, count(*) {_WD} AS daily_trades
  FROM (SELECT *, CAST(timestamp AS DATE) AS day FROM trades))"""


def _daily(spark, sf):
    return risk.daily_risk_counters(t.trades(spark, sf), ORDER,
                                    bucket=t.day_bucket())


@query("daily_risk_counters", S.with_(S.TRADES, _DAILY, select=f"""SELECT trade_id, account, {S.r('daily_pnl')},
  daily_trades FROM daily"""))
def daily_risk_counters(spark, sf):
    return _daily(spark, sf).select("trade_id", "account", "daily_pnl", "daily_trades")


@query("emergency_stop", S.with_(S.TRADES, _DAILY, select="""SELECT trade_id, account,
  (daily_pnl <= -200 OR abs(daily_pnl) / 10000 >= 0.03) AS stop FROM daily"""))
def emergency_stop(spark, sf):
    return _daily(spark, sf).select("trade_id", "account", risk.emergency_stop(L).alias("stop"))


@query("risk_metrics", S.with_(S.TRADES, select="""SELECT account, CAST(max(day) AS VARCHAR) AS last_reset,
  round(arg_max(p, day) + 1e-9, 6) AS daily_pnl, arg_max(n, day) AS daily_trades, 3 AS max_daily_trades,
  CAST(200.0 AS DOUBLE) AS max_daily_loss, CAST(0.03 AS DOUBLE) AS max_drawdown, 3 AS max_open_positions FROM (
  SELECT account, CAST(timestamp AS DATE) AS day, sum(pnl) AS p, count(*) AS n FROM trades GROUP BY 1, 2) GROUP BY 1"""))
def risk_metrics(spark, sf):
    return risk.risk_metrics(risk.daily_totals(t.trades(spark, sf)), L).select(
        "account", F.col("last_reset").cast("string").alias("last_reset"), "daily_pnl", "daily_trades", "max_daily_trades", "max_daily_loss",
        "max_drawdown", "max_open_positions")


_WP = "OVER (PARTITION BY account, day ORDER BY timestamp, trade_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_PRIOR = f"""prior AS (SELECT *, coalesce(sum(pnl) FILTER (status = 'filled') {_WP}, 0) AS daily_pnl,
  count(*) FILTER (status = 'filled') {_WP} AS daily_trades FROM (SELECT *, CAST(timestamp AS DATE) AS day FROM trades))"""


def _prior(spark, sf):
    return risk.prior_daily_counters(t.trades(spark, sf), ORDER, bucket=t.day_bucket(),
                                     executed=F.col("status") == "filled")


@query("prior_daily_counters", S.with_(S.TRADES, _PRIOR, select=f"SELECT trade_id, account, {S.r('daily_pnl')}, daily_trades FROM prior"))
def prior_daily_counters(spark, sf):
    return _prior(spark, sf).select("trade_id", "account", "daily_pnl", "daily_trades")


# Signals: every trade, for the supplier account with the same number, in a position symbol.
_SIGNALS = """signals AS (SELECT trade_id, account, daily_pnl, daily_trades, action, symbol, reasoning,
  CASE WHEN confidence > 0.97 THEN confidence + 0.5 WHEN confidence < 0.02 THEN NULL ELSE confidence END AS confidence FROM prior),
  held AS (SELECT account, CASE symbol WHEN 'A' THEN '1-URGENT' WHEN 'N' THEN '2-HIGH' ELSE '3-MEDIUM' END AS symbol
  FROM positions WHERE qty <> 0 AND unrealized_plpc < -0.05),
  cnt AS (SELECT account, count(DISTINCT symbol) AS open_positions FROM held GROUP BY 1)"""
_KNOWN = "('1-URGENT', '2-HIGH', '3-MEDIUM')"
_FORMAT = f"coalesce(action IN ('buy', 'sell', 'hold') AND confidence BETWEEN 0 AND 1 AND symbol IN {_KNOWN} AND reasoning IS NOT NULL, false)"


def _signals(spark, sf):
    c = F.col("confidence")
    conf = F.when(c > 0.97, c + 0.5).when(c < 0.02, F.lit(None)).otherwise(c)
    return _prior(spark, sf).withColumn("confidence", conf).select(
        "trade_id", "account", "daily_pnl", "daily_trades", "action", "symbol", "reasoning",
        "confidence")


def _held(spark, sf):
    name = F.expr("CASE symbol WHEN 'A' THEN '1-URGENT' WHEN 'N' THEN '2-HIGH' ELSE '3-MEDIUM' END")
    return t.positions(spark, sf).filter("unrealized_plpc < -0.05").select(
        "account", name.alias("symbol"), "qty")


@query("signal_format", S.with_(S.TRADES, _PRIOR, S.POSITIONS, _SIGNALS, select=f"SELECT trade_id, {_FORMAT} AS ok FROM signals"))
def signal_format(spark, sf):
    return _signals(spark, sf).select("trade_id", risk.signal_format_ok(L).alias("ok"))


_LIMITS_OK = "(action = 'hold' OR (coalesce(open_positions, 0) < 3 AND h.account IS NULL))"
_JOINED = "FROM signals s LEFT JOIN cnt USING (account) LEFT JOIN held h ON s.account = h.account AND s.symbol = h.symbol"


@query("position_limits", S.with_(S.TRADES, _PRIOR, S.POSITIONS, _SIGNALS, select=f"""SELECT trade_id,
  coalesce(open_positions, 0) AS open_positions, h.account IS NOT NULL AS already_held, {_LIMITS_OK} AS ok {_JOINED}"""))
def position_limits(spark, sf):
    return risk.with_open_positions(_signals(spark, sf), _held(spark, sf)).select(
        "trade_id", "open_positions", "already_held", risk.within_position_limits(L).alias("ok"))


@query("open_position_semi", S.with_(S.TRADES, _PRIOR, S.POSITIONS, _SIGNALS, select="""SELECT trade_id, account, symbol
  FROM signals s WHERE EXISTS (SELECT 1 FROM held h WHERE h.account = s.account AND h.symbol = s.symbol)"""))
def open_position_semi(spark, sf):
    return risk.open_position_semi(_signals(spark, sf), _held(spark, sf)).select(
        "trade_id", "account", "symbol")


@query("validate_signals", S.with_(S.TRADES, _PRIOR, S.POSITIONS, _SIGNALS, f"""v AS (SELECT trade_id, CASE
  WHEN NOT {_FORMAT.replace('symbol', 's.symbol')} THEN 'invalid signal format' WHEN daily_trades >= 3 THEN 'daily trade limit reached'
  WHEN daily_pnl <= -200 THEN 'daily loss limit exceeded' WHEN NOT {_LIMITS_OK} THEN 'position limits exceeded'
  WHEN coalesce(confidence, 0) < 0.6 THEN 'signal confidence too low' END AS reason {_JOINED})""",
  select="SELECT trade_id, reason IS NULL AS is_valid, reason FROM v"))
def validate_signals(spark, sf):
    return risk.validate_signals(_signals(spark, sf), _held(spark, sf), L).select(
        "trade_id", "is_valid", "reason")


@query("position_size", S.with_(S.TRADES, S.POSITIONS, """e AS (SELECT account, sum(market_value) / 100000000.0 AS exposure FROM positions GROUP BY 1),
  z AS (SELECT trade_id, price, 1000.0 * least(confidence * 2, 1) * greatest(0.5, 1 - (price / 100000.0) / 10)
    * greatest(0.1, 1 - coalesce(exposure, 0)) AS v FROM trades LEFT JOIN e USING (account))""",
  select=f"SELECT trade_id, {S.r('CASE WHEN v < 10 THEN 0 WHEN price <= 0 THEN 0 ELSE v / price END', 'size')} FROM z"))
def position_size(spark, sf):
    exposure = risk.exposure(t.positions(spark, sf), 100_000_000.0)
    trades = t.trades(spark, sf).withColumn("volatility", F.col("price") / 100000.0)
    return trades.join(exposure, "account", "left").select(
        "trade_id", risk.position_size(L).alias("size"))


@query("exposure", S.with_(S.POSITIONS, select=f"SELECT account, {S.r('sum(market_value) / 50000000.0', 'exposure')} FROM positions GROUP BY 1"))
def exposure(spark, sf):
    return risk.exposure(t.positions(spark, sf), 50_000_000.0)


@query("validate_orders", S.with_(f"""o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS symbol,
  CASE o_orderstatus WHEN 'F' THEN 'sell' WHEN 'O' THEN 'buy' ELSE 'short' END AS side,
  CASE WHEN o_custkey % 7 = 0 THEN 0.0 ELSE o_totalprice - 100000.0 END AS quantity FROM orders),
  m AS (SELECT *, CASE WHEN symbol IS NULL OR quantity = 0 THEN 'Missing required order parameters'
  WHEN side NOT IN ('buy', 'sell') THEN 'Invalid order side' WHEN quantity <= 0 THEN 'Invalid quantity'
  WHEN symbol NOT IN {_KNOWN} THEN 'Unsupported symbol' ELSE 'Order validation passed' END AS message FROM o)""",
  select="SELECT id, message, message = 'Order validation passed' AS is_valid FROM m"))
def validate_orders(spark, sf):
    orders = t.read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("symbol"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'sell' WHEN 'O' THEN 'buy' ELSE 'short' END")
        .alias("side"),
        F.when(F.col("o_custkey") % 7 == 0, 0.0).otherwise(F.col("o_totalprice") - 100000.0)
        .alias("quantity"))
    return risk.validate_orders(orders, L).select("id", "message", "is_valid")


@query("stop_take_prices", S.with_(S.TRADES, select=f"""SELECT trade_id,
  {S.r("price * CASE WHEN action = 'buy' THEN 0.98 ELSE 1.02 END", 'stop')},
  {S.r("price * CASE WHEN action = 'buy' THEN 1.04 ELSE 0.96 END", 'take')} FROM trades"""))
def stop_take_prices(spark, sf):
    price, side = F.col("price"), F.col("action")
    return t.trades(spark, sf).select("trade_id", risk.stop_price(price, side, L).alias("stop"),
                                      risk.take_price(price, side, L).alias("take"))


@query("limit_price", S.with_(S.TRADES, select=f"""SELECT trade_id,
  {S.r("price * CASE WHEN action = 'buy' THEN 1.001 ELSE 0.999 END", 'limit_price')} FROM trades"""))
def limit_price(spark, sf):
    return t.trades(spark, sf).select(
        "trade_id", risk.limit_price(F.col("price"), F.col("action")).alias("limit_price"))


@query("position_alerts", S.with_(S.POSITIONS, select=f"""SELECT account, symbol,
  CASE WHEN p <= -0.05 THEN 'position_loss' ELSE 'position_gain' END AS type,
  CASE WHEN p <= -0.05 THEN 'warning' ELSE 'info' END AS severity, {S.r('p', 'unrealized_plpc')},
  printf('Position %s %s %.2f%%', symbol, CASE WHEN p <= -0.05 THEN 'down' ELSE 'up' END, p * 100) AS message
  FROM (SELECT *, unrealized_plpc + 0.06 * (account % 4) AS p FROM positions) WHERE qty <> 0 AND (p <= -0.05 OR p >= 0.10)"""))
def position_alerts(spark, sf):
    shifted = t.positions(spark, sf).withColumn(
        "unrealized_plpc", F.col("unrealized_plpc") + 0.06 * (F.col("account") % 4))
    return risk.position_alerts(shifted).select("account", "symbol", "type", "severity",
                                                "unrealized_plpc", "message")


@query("rebalance", S.with_(S.POSITIONS, """w AS (SELECT account, symbol, market_value / sum(market_value) OVER (PARTITION BY account) AS cur FROM positions),
  tg AS (SELECT * FROM (VALUES ('A', 0.4), ('N', 0.3), ('R', 0.3)) v(symbol, tgt)),
  g AS (SELECT a.account, tg.symbol, CAST(tgt AS DOUBLE) AS tgt, coalesce(cur, 0) AS cur FROM (SELECT DISTINCT account FROM positions) a
    JOIN tg ON true LEFT JOIN w ON w.account = a.account AND w.symbol = tg.symbol)""", select=f"""SELECT account, symbol,
  CASE WHEN tgt > cur THEN 'buy' ELSE 'sell' END AS action, {S.r('cur', 'current_allocation')},
  {S.r('tgt', 'target_allocation')}, {S.r('tgt - cur', 'difference')} FROM g WHERE abs(tgt - cur) > 0.05"""))
def rebalance(spark, sf):
    return risk.rebalance(t.positions(spark, sf), t.TARGETS)


@query("positions_scan", S.with_(S.POSITIONS, select=f"""SELECT account, symbol, qty, 'long' AS side, {S.r('market_value')},
  {S.r('cost_basis')}, {S.r('market_value - cost_basis', 'unrealized_pl')}, {S.r('unrealized_plpc')} FROM positions"""))
def positions_scan(spark, sf):
    """Text fields, as a broker delivers them, to the typed projection."""
    raw = t.positions(spark, sf)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return readers.positions_scan(text, "account").withColumn("account",
                                                              F.col("account").cast("bigint"))


_ORDERS = """open_orders AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS id, o_orderpriority AS symbol,
  CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'pending' END AS status,
  o_totalprice AS limit_price, o_orderdate AS created_at FROM orders)"""


@query("orders_filter", S.with_(_ORDERS, select="SELECT * FROM open_orders WHERE status = 'open' ORDER BY created_at DESC, id DESC LIMIT 50"))
def orders_filter_query(spark, sf):
    return orders_filter(t.open_orders(spark, sf), "open", 50).select(
        "id", "symbol", "status", "limit_price", "created_at")


@query("append_event_log", S.with_(S.TRADES, select="""SELECT type, count(*) AS n, count(DISTINCT symbol) AS symbols FROM (
  SELECT symbol, CASE action WHEN 'hold' THEN 'signal_generation' ELSE 'trade_execution' END AS type FROM trades) GROUP BY 1"""))
def append_event_log(spark, sf):
    """Two event types appended to one JSONL log, read back and counted."""
    from tidewick.session import scratch_path

    path = scratch_path(spark, "event-log")
    trades = t.trades(spark, sf)
    at, data = F.col("timestamp"), F.struct("symbol", "action", "price")
    for kind, rows in (("trade_execution", trades.filter("action <> 'hold'")),
                       ("signal_generation", trades.filter("action = 'hold'"))):
        writers.append_event_log(rows.select(*writers.log_event(kind, data, at)), path)
    log = readers.event_log(spark, path)
    return log.groupBy("type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(F.get_json_object("data", "$.symbol")).alias("symbols"))
