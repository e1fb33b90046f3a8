"""Trade performance, alerts, and data-set statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.functions.numeric import ladder, ratio, round_to
from tidewick.operators.series import block_window, blocked, running_total
from tidewick.session import written


# --- data-set statistics -------------------------------------------------------------------------

def signal_distribution(samples: DataFrame) -> DataFrame:
    """Rows and share per signal; the share's total is taken over the grouped rows."""
    counts = samples.groupBy("signal").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))


def confidence_stats(samples: DataFrame) -> DataFrame:
    """Least, largest, mean and exact median, from counts of the distinct values.

    The counts are written once and cumulated over ranges of a hundredth, so no task sees all values.
    """
    x = F.col("confidence")
    counts = written(samples.filter(x.isNotNull()).groupBy(x.alias("value")).agg(F.count(F.lit(1)).alias("n")),
                     "value-counts")
    value, n = F.col("value"), F.col("n")
    upto = running_total(counts.withColumn("_all", F.lit(0)), ["_all"], ["value"], {"upto": n},
                         bucket=F.floor(value * 100))

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("upto") >= place) & (F.col("upto") - n < place), value))

    upto = upto.withColumn("_rows", counts.agg(F.sum("n")).scalar())
    middle = (at(F.floor((F.col("_rows") + 1) / 2)) + at(F.floor((F.col("_rows") + 2) / 2))) / 2
    return upto.agg(F.min(value).alias("min"), F.max(value).alias("max"),
                    (F.sum(value * n) / F.sum(n)).alias("mean"), middle.alias("median"))


def indicator_ranges(rows: DataFrame, columns=("rsi", "macd", "close", "volume")) -> DataFrame:
    return rows.agg(*[f(x).alias(f"{n}_{x}") for x in columns
                      for n, f in (("min", F.min), ("max", F.max))])


def completeness(rows: DataFrame, required: Sequence[str], indicators: Sequence[str]) -> DataFrame:
    has_all = F.lit(True)
    for x in required:
        has_all = has_all & F.col(x).isNotNull()
    any_null = F.lit(False)
    for x in indicators:
        any_null = any_null | F.col(x).isNull()
    return rows.agg(F.count(F.lit(1)).alias("rows"),
                    F.bool_and(has_all).alias("all_have_keys"),
                    F.count_if(any_null).alias("rows_with_null_indicator"))


def dataset_totals(samples: DataFrame, chunk: str = "chunk") -> DataFrame:
    return samples.agg(F.count(F.lit(1)).alias("total_samples"),
                       F.count_distinct(chunk).alias("total_chunks"),
                       F.count_distinct("symbol").alias("total_symbols"))


def continuity_check(candles: DataFrame, key: str, time: str = "timestamp", *,
                     step: int = 60) -> DataFrame:
    """Per key: steps longer than ``step`` seconds and repeated time stamps.

    Differences are taken inside each (key, day); the day table then supplies the one difference
    that crosses into each day, so no window spans a whole key.
    """
    day = Window.partitionBy(key, "_day").orderBy(time)
    seconds = F.floor((F.unix_micros(time) - F.unix_micros(F.lag(time).over(day))) / 1_000_000)
    days = (candles.withColumn("_day", F.date_trunc("day", time)).withColumn("_diff", seconds)
            .groupBy(key, "_day").agg(
                F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_diff") > step).alias("_gaps"),
                F.count_if(F.col("_diff") == 0).alias("_dups"),
                F.min(time).alias("_first"), F.max(time).alias("_last")))
    before = F.lag("_last").over(Window.partitionBy(key).orderBy("_day"))
    jump = F.floor((F.unix_micros("_first") - F.unix_micros(before)) / 1_000_000)
    return (days.withColumn("_jump", jump).groupBy(key).agg(
        F.sum("_n").alias("rows"),
        (F.sum("_gaps") + F.count_if(F.col("_jump") > step)).alias("gaps"),
        (F.sum("_dups") + F.count_if(F.col("_jump") == 0)).alias("duplicates")))


def coverage_pct(candles: DataFrame, key: str, time: str = "timestamp", *,
                 step: int = 60) -> DataFrame:
    """min(1, rows / ceil(span / step)) per key, the span taken from the data."""
    out = candles.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.ceil((F.unix_micros(F.max(time)) - F.unix_micros(F.min(time))) / (step * 1_000_000.0))
        .alias("expected"))
    share = F.when(F.col("expected") > 0, F.least(F.lit(1.0), F.col("rows") / F.col("expected")))
    return out.withColumn("coverage", F.coalesce(share, F.lit(1.0)))


# --- logs ----------------------------------------------------------------------------------------

def recent(log: DataFrame, as_of, hours: int, time: str = "timestamp") -> DataFrame:
    """Rows newer than ``as_of`` - ``hours`` (``as_of`` a Column or a timestamp literal)."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return log.filter(F.col(time) > as_of - F.expr(f"INTERVAL {int(hours)} HOURS"))


def trade_summary(trades: DataFrame) -> DataFrame:
    """Counts per symbol and for the whole table (symbol ``ALL``), split by action."""
    symbol = F.coalesce("symbol", F.lit("unknown"))
    action = F.col("action")
    return (trades.withColumn("_s", symbol).rollup("_s").agg(
        F.count(F.lit(1)).alias("total_trades"),
        *[F.count_if(action == a).alias(f"{a}s") for a in ("buy", "sell", "hold")])
        .select(F.coalesce("_s", F.lit("ALL")).alias("symbol"), "total_trades", "buys", "sells",
                "holds"))


def latest_performance(log: DataFrame) -> DataFrame:
    return log.agg(F.max_by("data", "timestamp").alias("latest_performance"),
                   F.count(F.lit(1)).alias("total_logs"))


def alert_summary(alerts: DataFrame, order: Sequence[str], last: int = 50) -> DataFrame:
    """Total alerts, and counts by type among the newest ``last`` (a top-k, not a full sort).

    Without alerts there is one row of zeros, whose type is NULL.
    """
    total = alerts.agg(F.count(F.lit(1)).alias("total_alerts"))
    newest = alerts.orderBy(*[F.col(o).desc() for o in order]).limit(last)
    by_type = newest.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    # The total is one row; it rides on the (few) types as a scalar subquery.
    counted = by_type.select("type", "n", F.sum("n").over(Window.partitionBy()).alias("recent_alerts"),
                             total.scalar().alias("total_alerts"))
    zero = F.lit(0).cast("long")
    none = total.filter("total_alerts = 0").select(
        F.lit(None).cast(by_type.schema["type"].dataType).alias("type"), zero.alias("n"), zero.alias("recent_alerts"), "total_alerts")
    return counted.unionByName(none)


def trade_status_counts(trades: DataFrame) -> DataFrame:
    live = F.col("action").isin("buy", "sell")
    conf = F.col("confidence")
    return trades.agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.count_if(live & (F.col("status") == "filled")).alias("filled_trades"),
        F.count_if(live & (F.col("status") == "rejected")).alias("rejected_trades"),
        F.count_if(live & (conf > 0.7)).alias("high_confidence_trades"),
        F.count_if(live & (conf <= 0.7)).alias("low_confidence_trades"))


# --- profit and loss -----------------------------------------------------------------------------

def pnl_leaves(trades: DataFrame, keys: Sequence[str], order: Sequence[str], *,
               bucket: Column, time: str) -> DataFrame:
    """One row per (key, bucket) holding everything drawdown and totals need.

    The detail rows are shuffled once; the key-wide running total and peak are then taken over these
    rows, with ``base`` the P&L before the bucket and ``peak`` the highest point before it.
    """
    w = (Window.partitionBy(*keys, "_bucket").orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, 0))
    pnl = F.col("pnl")
    rows = (trades.withColumn("_bucket", bucket).withColumn("_cum", F.sum(pnl).over(w))
            .withColumn("_top", F.max("_cum").over(w)))
    leaves = rows.groupBy(*keys, "_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(pnl > 0).alias("wins"),
        F.sum(pnl).alias("pnl"), F.sum(F.when(pnl > 0, pnl).otherwise(0.0)).alias("won"),
        F.sum(F.when(pnl < 0, pnl).otherwise(0.0)).alias("lost"),
        F.max("_cum").alias("_hi"), F.min("_cum").alias("_lo"),
        F.max(F.col("_top") - F.col("_cum")).alias("_dd"),
        F.min(time).alias("first_at"), F.max(time).alias("last_at"))
    before = (Window.partitionBy(*keys).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    leaves = leaves.withColumn("base", F.coalesce(F.sum("pnl").over(before), F.lit(0.0)))
    return leaves.withColumn("peak", F.greatest(
        F.lit(0.0), F.coalesce(F.max(F.col("base") + F.col("_hi")).over(before), F.lit(0.0))))


def drawdown_columns() -> list[Column]:
    worst = F.greatest(F.col("_dd"), F.col("peak") - F.col("base") - F.col("_lo"), F.lit(0.0))
    return [F.max(worst).alias("max_drawdown"),
            F.greatest(F.lit(0.0), F.max(F.col("base") + F.col("_hi"))).alias("final_peak")]


def _drawdown_pct() -> Column:
    return F.when(F.col("final_peak") > 0, F.col("max_drawdown") * 100
                  / F.greatest(F.col("final_peak"), F.lit(1.0))).otherwise(0.0)


def drawdown(trades: DataFrame, keys: Sequence[str], order: Sequence[str], *, bucket: Column,
             time: str = "timestamp") -> DataFrame:
    """Largest fall from the running peak (which starts at 0), and its share of the final peak."""
    leaves = pnl_leaves(trades, keys, order, bucket=bucket, time=time)
    return (leaves.groupBy(*keys).agg(*drawdown_columns())
            .withColumn("max_drawdown_pct", _drawdown_pct()).drop("final_peak"))


def performance_metrics(trades: DataFrame, keys: Sequence[str], order: Sequence[str], *,
                        bucket: Column, time: str = "timestamp",
                        digits: int | None = 2) -> DataFrame:
    """Win/loss totals, drawdown and trade frequency per key. A zero P&L counts as a loss."""
    leaves = pnl_leaves(trades, keys, order, bucket=bucket, time=time)
    t = leaves.groupBy(*keys).agg(
        F.sum("n").alias("total_trades"), F.sum("wins").alias("winning_trades"),
        F.sum("pnl").alias("total_pnl"), F.sum("won").alias("won"), F.sum("lost").alias("lost"),
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"),
        *drawdown_columns())
    t = t.withColumn("losing_trades", F.col("total_trades") - F.col("winning_trades"))
    hours = (F.unix_micros("last_at") - F.unix_micros("first_at")) / 3_600_000_000.0
    t = t.withColumns({
        "avg_win": F.col("won") / F.greatest(F.col("winning_trades"), F.lit(1)),
        "avg_loss": F.col("lost") / F.greatest(F.col("losing_trades"), F.lit(1)),
        "win_rate": F.col("winning_trades") * 100.0 / F.col("total_trades"),
        "max_drawdown_pct": _drawdown_pct(),
        "trades_per_hour": F.col("total_trades") / F.greatest(hours, F.lit(1.0)),
    })
    factor = F.coalesce(F.abs(ratio(F.col("avg_win"), F.col("avg_loss"))), F.lit(0.0))
    t = t.withColumn("profit_factor", factor)
    rounded = ("win_rate total_pnl avg_win avg_loss max_drawdown max_drawdown_pct trades_per_hour "
               "profit_factor").split()
    return t.select(*keys, "total_trades", "winning_trades", "losing_trades",
                    *[round_to(F.col(x), digits).alias(x) for x in rounded])


def next_trade_exit(trades: DataFrame, order: Sequence[str], *, bucket: Column,
                    key: str = "symbol") -> DataFrame:
    """Closed trades: entry from the previous row, exit at the current one, per symbol.

    The last trade of a symbol has no exit and is left out.
    """
    df = blocked(trades, [key], order, bucket=bucket, halo=1)
    w = block_window([key])
    entry = {x: F.lag(x).over(w) for x in ("action", "confidence", "price")}
    closed = (df.withColumn("exit_price", F.col("price")).withColumns(
        {f"_{x}": e for x, e in entry.items()})
        .filter(F.col("_own") & (F.col("pos") > 0)))
    return closed.select(
        key, (F.col("pos") - 1).alias("trade_no"), F.col("_action").alias("action"),
        F.col("_confidence").alias("confidence"), F.col("_price").alias("price"), "exit_price")


def backtest_performance(closed: DataFrame, keys: Sequence[str] = (), *, exact: bool = False
                         ) -> DataFrame:
    """Return x confidence per closed trade, summarised; zero returns are neither won nor lost.

    ``exact`` leaves the figures unrounded.
    """
    move = ratio(F.col("exit_price") - F.col("price"), F.col("price"))
    pnl = ladder([(F.col("action") == "buy", move), (F.col("action") == "sell", -move)], 0.0)
    rows = closed.withColumn("_pnl", pnl * F.col("confidence"))
    t = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.count_if(F.col("_pnl") > 0).alias("winning_trades"),
        F.count_if(F.col("_pnl") < 0).alias("losing_trades"),
        F.sum("_pnl").alias("total_pnl"), F.max("_pnl").alias("max_pnl"),
        F.min("_pnl").alias("min_pnl"), F.stddev_samp("_pnl").alias("_sd"),
        F.avg("confidence").alias("avg_confidence"))
    t = t.filter(F.col("total_trades") > 0).withColumns({
        "win_rate": F.col("winning_trades") * 100.0 / F.col("total_trades"),
        "avg_pnl": F.col("total_pnl") / F.col("total_trades")})
    sharpe = F.when(F.col("_sd") > 0, F.col("avg_pnl") / F.col("_sd")).otherwise(0.0)
    two, four = (None, None) if exact else (2, 4)
    return t.select(
        *keys, "total_trades", "winning_trades", "losing_trades",
        round_to(F.col("win_rate"), two).alias("win_rate"),
        *[round_to(F.col(x), four).alias(x)
          for x in ("total_pnl", "avg_pnl", "max_pnl", "min_pnl")],
        round_to(sharpe, four).alias("sharpe_ratio"),
        round_to(F.col("avg_confidence"), two).alias("avg_confidence"))


def session_metrics(results: DataFrame, session: str = "session", *,
                    time: str = "timestamp") -> DataFrame:
    t = results.groupBy(session).agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.count_if(F.col("pnl") > 0).alias("profitable_trades"),
        F.sum("pnl").alias("total_pnl"),
        ((F.unix_micros(F.max(time)) - F.unix_micros(F.min(time))) / 3_600_000_000.0)
        .alias("session_duration_hours"))
    return t.withColumn("win_rate", F.col("profitable_trades")
                        / F.greatest(F.col("total_trades"), F.lit(1)))
