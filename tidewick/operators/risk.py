"""Risk checks, sizing and portfolio actions. Every threshold is a parameter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.functions.numeric import ladder, ratio
from tidewick.operators.series import running_total


@dataclass(frozen=True)
class RiskLimits:
    symbols: tuple[str, ...]
    max_daily_trades: int = 50
    max_daily_loss: float = 500.0
    max_open_positions: int = 5
    max_drawdown: float = 0.1
    max_position_size: float = 0.1
    min_trade_amount: float = 10.0
    stop_loss_pct: float = 0.02
    take_profit_pct: float = 0.04
    min_confidence: float = 0.6
    volatility_threshold: float = 0.05
    account_value: float = 10_000.0
    drawdown_base: float = 10_000.0
    targets: Mapping[str, float] = field(default_factory=dict)


def signal_format_ok(limits: RiskLimits) -> Column:
    conf = F.col("confidence")
    ok = (F.col("action").isin("buy", "sell", "hold") & (conf >= 0) & (conf <= 1)
          & F.col("symbol").isin(*limits.symbols) & F.col("reasoning").isNotNull())
    return F.coalesce(ok, F.lit(False))


def held_positions(positions: DataFrame) -> DataFrame:
    return positions.filter(F.col("qty") != 0)


def with_open_positions(signals: DataFrame, positions: DataFrame) -> DataFrame:
    """Adds ``open_positions`` of the account and ``already_held`` for the signal's symbol.

    One row per account with its set of symbols, which is as small as the symbol list.
    """
    held = held_positions(positions).groupBy("account").agg(F.collect_set("symbol").alias("_held"))
    symbols = F.coalesce("_held", F.array().cast("array<string>"))
    return (signals.join(held, "account", "left")
            .withColumns({"open_positions": F.size(symbols).cast("bigint"),
                          "already_held": F.coalesce(F.array_contains(symbols, F.col("symbol")), F.lit(False))})
            .drop("_held"))


def within_position_limits(limits: RiskLimits) -> Column:
    return (F.col("action") == "hold") | (
        (F.col("open_positions") < limits.max_open_positions) & ~F.col("already_held"))


def open_position_semi(signals: DataFrame, positions: DataFrame) -> DataFrame:
    """Signals whose symbol the account already holds."""
    return signals.join(held_positions(positions), ["account", "symbol"], "left_semi")


def validate_signals(signals: DataFrame, positions: DataFrame, limits: RiskLimits) -> DataFrame:
    """First failed check in order becomes ``reason``.

    Needs ``daily_trades`` and ``daily_pnl`` of what was executed before the signal (``prior_daily_counters``).
    """
    df = with_open_positions(signals, positions)
    conf = F.coalesce("confidence", F.lit(0.0))
    # The checks in order.
    reason = ladder([
        (~signal_format_ok(limits), "invalid signal format"),
        (F.col("daily_trades") >= limits.max_daily_trades, "daily trade limit reached"),
        (F.col("daily_pnl") <= -limits.max_daily_loss, "daily loss limit exceeded"),
        (~within_position_limits(limits), "position limits exceeded"),
        (conf < limits.min_confidence, "signal confidence too low"),
    ], F.lit(None).cast("string"))
    return df.withColumn("reason", reason).withColumn("is_valid", F.col("reason").isNull())


def position_size(limits: RiskLimits) -> Column:
    """Units to trade from confidence, volatility, exposure and price columns."""
    value = (F.lit(limits.account_value * limits.max_position_size)
             * F.least(F.coalesce("confidence", F.lit(0.5)) * 2, F.lit(1.0))
             * F.greatest(F.lit(0.5), 1.0 - F.coalesce("volatility", F.lit(0.0)) / 10)
             * F.greatest(F.lit(0.1), 1.0 - F.coalesce("exposure", F.lit(0.0))))
    price = F.coalesce("price", F.lit(0.0))
    return ladder([(value < limits.min_trade_amount, 0.0), (price <= 0, 0.0)],
                  ratio(value, price))


def exposure(positions: DataFrame, account_value: float) -> DataFrame:
    """Market value of open positions over the account value; 0 for an account without any."""
    held = F.sum(F.when(F.col("qty") != 0, F.col("market_value")).otherwise(0.0))
    share = held / account_value if account_value > 0 else F.lit(0.0)
    return positions.groupBy("account").agg(share.alias("exposure"))


def daily_risk_counters(trades: DataFrame, order: Sequence[str], *, bucket: Column,
                        time: str = "timestamp") -> DataFrame:
    """Running P&L and trade count per account and day, up to and including each trade.

    ``bucket`` splits a busy day; it must not decrease along ``order``.
    """
    dated = trades.withColumn("day", F.to_date(time))
    return running_total(dated, ["account", "day"], order,
                         {"daily_pnl": F.col("pnl"), "daily_trades": F.lit(1)}, bucket=bucket)


def prior_daily_counters(trades: DataFrame, order: Sequence[str], *, bucket: Column, executed: Column,
                         time: str = "timestamp") -> DataFrame:
    """P&L and number of the account's executed trades of the day strictly before each row.

    A signal is judged by what was done before it: neither its own result nor rejected rows count.
    """
    won, done = F.when(executed, F.col("pnl")).otherwise(0.0), F.when(executed, 1).otherwise(0)
    upto = running_total(trades.withColumn("day", F.to_date(time)), ["account", "day"], order,
                         {"daily_pnl": won, "daily_trades": done}, bucket=bucket)
    return upto.withColumns({"daily_pnl": F.col("daily_pnl") - won, "daily_trades": F.col("daily_trades") - done})


def emergency_stop(limits: RiskLimits) -> Column:
    pnl = F.col("daily_pnl")
    return (pnl <= -limits.max_daily_loss) | (
        F.abs(pnl) / limits.drawdown_base >= limits.max_drawdown)


def risk_metrics(day_totals: DataFrame, limits: RiskLimits) -> DataFrame:
    """Latest day per account next to the limits."""
    latest = day_totals.groupBy("account").agg(
        F.max_by(F.struct("daily_pnl", "daily_trades"), "day").alias("_v"),
        F.max("day").alias("last_reset"))
    return latest.select(
        "account", "last_reset", "_v.daily_pnl", "_v.daily_trades",
        *[F.lit(getattr(limits, n)).alias(n) for n in (
            "max_daily_trades", "max_daily_loss", "max_drawdown", "max_position_size",
            "max_open_positions", "volatility_threshold")])


def daily_totals(trades: DataFrame, time: str = "timestamp") -> DataFrame:
    return trades.groupBy("account", F.to_date(time).alias("day")).agg(
        F.sum("pnl").alias("daily_pnl"), F.count(F.lit(1)).alias("daily_trades"))


def validate_orders(orders: DataFrame, limits: RiskLimits) -> DataFrame:
    missing = (F.coalesce("symbol", F.lit("")) == "") | (F.coalesce("side", F.lit("")) == "") | (
        F.coalesce("quantity", F.lit(0.0)) == 0)
    # Messages in check order.
    message = ladder([
        (missing, "Missing required order parameters"),
        (~F.col("side").isin("buy", "sell"), "Invalid order side"),
        (F.col("quantity") <= 0, "Invalid quantity"),
        (~F.col("symbol").isin(*limits.symbols), "Unsupported symbol"),
    ], "Order validation passed")
    return orders.withColumn("message", message).withColumn(
        "is_valid", F.col("message") == "Order validation passed")


def stop_price(price: Column, side: Column, limits: RiskLimits) -> Column:
    s = limits.stop_loss_pct
    return F.when(side == "buy", price * (1 - s)).otherwise(price * (1 + s))


def take_price(price: Column, side: Column, limits: RiskLimits) -> Column:
    t = limits.take_profit_pct
    return F.when(side == "buy", price * (1 + t)).otherwise(price * (1 - t))


def limit_price(price: Column, side: Column) -> Column:
    return F.when(side == "buy", price * 1.001).otherwise(price * 0.999)


def position_alerts(positions: DataFrame) -> DataFrame:
    pl = F.col("unrealized_plpc")
    kind = ladder([(pl <= -0.05, "position_loss"), (pl >= 0.10, "position_gain")],
                  F.lit(None).cast("string"))
    loss = F.col("type") == "position_loss"
    return (held_positions(positions).withColumn("type", kind).filter(F.col("type").isNotNull())
            .withColumn("severity", F.when(loss, "warning").otherwise("info"))
            .withColumn("message", F.format_string(
                "Position %s %s %.2f%%", "symbol",
                F.when(loss, "down").otherwise("up"), pl * 100)))


def rebalance(positions: DataFrame, targets: Mapping[str, float],
              threshold: float = 0.05) -> DataFrame:
    """Target minus held weight per account and target symbol, kept where it exceeds the threshold.

    ``targets`` is configuration, exploded from a literal on each account row.
    """
    held = held_positions(positions).groupBy("account", "symbol").agg(
        F.sum("market_value").alias("_value"))
    totals = held.groupBy("account").agg(F.sum("_value").alias("_total"))
    wanted = F.explode(F.array(*[F.struct(F.lit(s).alias("symbol"), F.lit(float(t)).alias("target"))
                                 for s, t in targets.items()]))
    grid = totals.withColumn("_t", wanted).select(
        "account", "_total", F.col("_t.symbol").alias("symbol"),
        F.col("_t.target").alias("target_allocation"))
    weight = F.when(F.col("_total") > 0, F.col("_value") / F.col("_total")).otherwise(
        F.col("_value"))
    diff = F.col("target_allocation") - F.col("current_allocation")
    return (grid.join(held, ["account", "symbol"], "left")
            .withColumn("current_allocation", F.coalesce(weight, F.lit(0.0)))
            .withColumn("difference", diff).filter(F.abs("difference") > threshold)
            .withColumn("action", F.when(F.col("difference") > 0, "buy").otherwise("sell"))
            .select("account", "symbol", "action", "current_allocation", "target_allocation",
                    "difference"))


def performance_alerts(metrics: DataFrame, keys: Sequence[str], *, drawdown_threshold: float,
                       win_rate_threshold: float = 0.3, hourly_threshold: float = 10.0
                       ) -> DataFrame:
    """Zero to three alerts per metrics row. The win rate is compared in the unit it comes in."""
    rules = [
        ("drawdown_alert", "high", F.coalesce("max_drawdown", F.lit(0.0)), drawdown_threshold,
         "ge", "Drawdown exceeded threshold: %.2f%%", 100),
        ("low_win_rate", "medium", F.coalesce("win_rate", F.lit(0.0)), win_rate_threshold, "lt",
         "Low win rate: %.2f%%", 100),
        ("high_frequency", "medium", F.coalesce("trades_per_hour", F.lit(0.0)), hourly_threshold,
         "gt", "High trading frequency: %.1f trades/hour", 1)]
    test = {"ge": lambda v, t: v >= t, "lt": lambda v, t: v < t, "gt": lambda v, t: v > t}
    alerts = F.array_compact(F.array(*[
        F.when(test[op](value, limit), F.struct(
            F.lit(kind).alias("type"), F.lit(severity).alias("severity"),
            F.format_string(text, value * scale).alias("message"), value.alias("value"),
            F.lit(float(limit)).alias("threshold")))
        for kind, severity, value, limit, op, text, scale in rules]))
    return metrics.select(*keys, F.explode(alerts).alias("_a")).select(*keys, "_a.*")
