"""The technical-indicator panel (trailing windows, exponential averages, patterns, flags).

Input rows must be non-null and unique per (keys, time). All windows run on (keys, _blk) after one
shuffle; their order columns (_s4, _s1, pos) make the three partition specs below share one sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.functions.numeric import finite, flag, pct, ratio
from tidewick.operators.series import BLOCK_ROWS, HALO_ROWS, block_window, blocked, day_of, number_rows
from tidewick.session import written

# Look-backs of the panel.
CHANGE_LAGS = {"change_5m": 5, "change_15m": 15, "change_1h": 60, "change_4h": 240,
               "change_24h": 1440}
AVERAGE_SPANS = (5, 10, 20, 50, 100, 200)
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
EMA_SPANS = (*AVERAGE_SPANS, MACD_FAST, MACD_SLOW)

OUTPUT = (
    ["change_1m", *CHANGE_LAGS]
    + [f"sma_{n}" for n in AVERAGE_SPANS] + [f"ema_{n}" for n in EMA_SPANS]
    + ["rsi", "macd", "macd_signal", "macd_histogram",
       "bb_middle", "bb_upper", "bb_lower", "bb_width", "bb_position",
       "stoch_k", "stoch_d", "williams_r", "volume_sma", "volume_ratio", "volatility", "atr",
       "doji", "hammer", "shooting_star", "trend_short", "trend_medium", "trend_long",
       "resistance", "support", "price_vs_resistance", "price_vs_support"])

#: Averages that remember the whole series: all that a series' past is needed for beyond its last rows.
CARRIED = (*[f"ema_{n}" for n in EMA_SPANS], "macd_signal")

_SUB_SMALL, _SUB_LARGE = 1024, 4096


class _Ewm:
    """sum((1-a)^i x) / sum((1-a)^i) as running sums inside sub-blocks plus one carried value.

    A sub-block is long enough that (1-a)^length < 1e-17 yet (1-a)^-length is a finite double, so
    the value at the end of the previous sub-block is all the history a row needs.
    """

    def __init__(self, span: int, keys: Sequence[str]):
        self.span = span
        self.decay = -math.log(1.0 - 2.0 / (span + 1.0))
        self.small = span < 20
        self.length = _SUB_SMALL if self.small else _SUB_LARGE
        self.k = F.col("pos") % self.length
        parts = [*keys, "_blk", "_s4", "_s1"] if self.small else [*keys, "_blk", "_s4"]
        order = ["pos"] if self.small else ["_s1", "pos"]
        self.sub = (Window.partitionBy(*parts).orderBy(*order)
                    .rowsBetween(Window.unboundedPreceding, 0))
        self.past = (block_window(keys, ["_s4", "_s1", "pos"])
                     .rowsBetween(Window.unboundedPreceding, -1))

    def weighted(self, x: Column) -> Column:
        return F.sum(x * F.exp(self.k * self.decay)).over(self.sub) * F.exp(-self.k * self.decay)

    def carried(self, local: str) -> Column:
        at_end = F.when(self.k == self.length - 1, F.col(local))
        return F.coalesce(F.last(at_end, ignorenulls=True).over(self.past), F.lit(0.0))

    def mean(self, local: str, carry: str, past: Column | None = None) -> Column:
        """The average; ``past`` is its value at the last of ``_rows`` rows that came before these."""
        top = F.col(local) + F.col(carry) * F.exp(-(self.k + 1) * self.decay)
        step, seen = 1.0 - math.exp(-self.decay), F.col("pos") + 1
        if past is not None:
            before = F.coalesce("_rows", F.lit(0))
            sums = F.coalesce(past, F.lit(0.0)) * (1.0 - F.exp(-before * self.decay)) / step
            top, seen = top + sums * F.exp(-seen * self.decay), seen + before
        return top * step / (1.0 - F.exp(-seen * self.decay))


def one_row_change(now: Column, before: Column) -> Column:
    return (ratio(now, before) - 1.0) * 100.0


def _trailing(w: Window, n: int) -> Window:
    return w.rowsBetween(-(n - 1), 0)


def _from(pos: int, x: Column) -> Column:
    return F.when(F.col("pos") >= pos, x)


def indicator_panel(candles: DataFrame, *, keys: Sequence[str] = ("symbol",),
                    time: str = "timestamp", bucket: Column | None = None,
                    price_trend: bool = False, rows_per_block: int = BLOCK_ROWS,
                    halo: int = HALO_ROWS, history: DataFrame | None = None) -> DataFrame:
    """All columns of ``OUTPUT`` next to the input columns, plus ``pos``.

    ``halo`` is at least the longest look-back and what the slowest average remembers. ``history`` (keys, rows and
    the columns of ``CARRIED``) says how many rows came before a key's first one here, and the averages at the last
    of them: then the averages are those of the whole series.

    Select what is needed: unused windows are pruned by the optimizer. ``price_trend`` adds
    ``volume_price_trend``, whose block totals cost a second, narrower pass.
    """
    keys = list(keys)
    df = blocked(candles, keys, [time], bucket=day_of(time) if bucket is None else bucket,
                 rows_per_block=rows_per_block, halo=halo)
    totals = _trend_totals(df, keys) if price_trend else None
    past = {x: None for x in CARRIED}
    if history is not None:
        past = {x: F.col(f"_past_{x}") for x in CARRIED}
        df = df.join(history.select(*keys, F.col("rows").alias("_rows"), *[F.col(x).alias(f"_past_{x}") for x in CARRIED]), keys, "left")
    df = df.withColumns({"_s4": F.expr(f"pos div {_SUB_LARGE}"),
                         "_s1": F.expr(f"pos div {_SUB_SMALL}")})
    w = block_window(keys, ["_s4", "_s1", "pos"])
    o, h, l, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    ewm = {n: _Ewm(n, keys) for n in (*EMA_SPANS, MACD_SIGNAL)}

    df = df.withColumns({
        "_prev": F.lag(c, 1).over(w),
        **{f"_lag{n}": F.lag(c, n).over(w) for n in CHANGE_LAGS.values()},
        **{f"_sum{n}": F.sum(c).over(_trailing(w, n)) for n in (5, 10, 20)},
        "_sd20": F.stddev_samp(c).over(_trailing(w, 20)),
        "_vol20": F.avg(v).over(_trailing(w, 20)),
        "_hi14": F.max(h).over(_trailing(w, 14)),
        "_lo14": F.min(l).over(_trailing(w, 14)),
        **{f"_loc{n}": ewm[n].weighted(c) for n in EMA_SPANS},
    })
    delta = c - F.col("_prev")
    df = df.withColumns({
        "_gain": F.when(delta > 0, delta).otherwise(0.0),
        "_loss": F.when(delta < 0, -delta).otherwise(0.0),
        "_tr": F.when(F.col("_prev").isNotNull(), F.greatest(
            h - l, F.abs(h - F.col("_prev")), F.abs(l - F.col("_prev")))),
        "stoch_k": _from(13, 100.0 * ratio(c - F.col("_lo14"), F.col("_hi14") - F.col("_lo14"))),
        "williams_r": _from(13, -100.0 * ratio(F.col("_hi14") - c,
                                               F.col("_hi14") - F.col("_lo14"))),
    })
    # Longer sums and extremes are put together from shifted shorter ones.
    df = df.withColumns({
        "_sum50": F.col("_sum20") + F.lag("_sum20", 20).over(w) + F.lag("_sum10", 40).over(w),
        "_hi20": F.greatest("_hi14", F.lag("_hi14", 6).over(w)),
        "_lo20": F.least("_lo14", F.lag("_lo14", 6).over(w)),
        "_gain14": F.avg("_gain").over(_trailing(w, 14)),
        "_loss14": F.avg("_loss").over(_trailing(w, 14)),
        "_tr14": F.avg("_tr").over(_trailing(w, 14)),
        "_d3": F.avg("stoch_k").over(_trailing(w, 3)),
        "_dn": F.count("stoch_k").over(_trailing(w, 3)),
        **{f"_car{n}": ewm[n].carried(f"_loc{n}") for n in EMA_SPANS},
    })
    if price_trend:
        own = F.when(F.col("_own"), v * one_row_change(c, F.col("_prev")))
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        df = df.withColumn("_vpt", own).withColumns({
            f"_local_{x}": F.sum(v).over(upto) for x, v in _parts(F.col("_vpt")).items()})
    df = df.withColumns({f"ema_{n}": ewm[n].mean(f"_loc{n}", f"_car{n}", past[f"ema_{n}"]) for n in EMA_SPANS})
    df = df.withColumns({"macd": F.col(f"ema_{MACD_FAST}") - F.col(f"ema_{MACD_SLOW}")})
    df = df.withColumns({
        "_sum100": F.col("_sum50") + F.lag("_sum50", 50).over(w),
        "_locS": ewm[MACD_SIGNAL].weighted(F.col("macd")),
    })
    df = df.withColumns({
        "_sum200": F.col("_sum100") + F.lag("_sum100", 100).over(w),
        "_carS": ewm[MACD_SIGNAL].carried("_locS"),
    }).filter("_own")

    df = df.withColumns({
        "change_1m": one_row_change(c, F.col("_prev")),
        **{name: F.coalesce(pct(c, F.col(f"_lag{n}")), F.lit(0.0))
           for name, n in CHANGE_LAGS.items()},
        **{f"sma_{n}": _from(n - 1, F.col(f"_sum{n}") / float(n)) for n in AVERAGE_SPANS},
        "rsi": _from(13, F.when(F.col("_loss14") == 0, F.when(F.col("_gain14") > 0, 100.0))
                     .otherwise(100.0 - 100.0 / (1.0 + ratio(F.col("_gain14"),
                                                             F.col("_loss14"))))),
        "macd_signal": ewm[MACD_SIGNAL].mean("_locS", "_carS", past["macd_signal"]),
        "_sd20": _from(19, F.col("_sd20")),
        "stoch_d": F.when(F.col("_dn") == 3, F.col("_d3")),
        "volume_sma": _from(19, F.col("_vol20")),
        "atr": _from(14, F.col("_tr14")),
        "resistance": _from(19, F.col("_hi20")),
        "support": _from(19, F.col("_lo20")),
    })
    df = df.withColumns({
        "macd_histogram": F.col("macd") - F.col("macd_signal"),
        "bb_middle": F.col("sma_20"),
        "bb_upper": F.col("sma_20") + 2.0 * F.col("_sd20"),
        "bb_lower": F.col("sma_20") - 2.0 * F.col("_sd20"),
        "volume_ratio": ratio(v, F.col("volume_sma")),
        "volatility": ratio(F.col("_sd20"), F.col("sma_20")),
        "trend_short": flag(c > F.col("sma_20")),
        "trend_medium": flag(c > F.col("sma_50")),
        "trend_long": flag(c > F.col("sma_200")),
        "price_vs_resistance": ratio(c - F.col("resistance"), F.col("resistance")),
        "price_vs_support": ratio(c - F.col("support"), F.col("support")),
        **candle_patterns(o, h, l, c),
    })
    df = df.withColumns({
        "bb_width": ratio(F.col("bb_upper") - F.col("bb_lower"), F.col("bb_middle")),
        "bb_position": ratio(c - F.col("bb_lower"), F.col("bb_upper") - F.col("bb_lower")),
    })
    if price_trend:
        df = df.join(totals, [*keys, "_blk"]).withColumn("volume_price_trend", _trend())
    return df.select(*candles.columns, "pos", *OUTPUT,
                     *(["volume_price_trend"] if price_trend else []))


def averages_before(panel: DataFrame, history: DataFrame | None, keep: int, *, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """``history`` for the last ``keep`` rows of each key in ``panel``, which was made with ``history``.

    A few numbers for each key: the averages at the row before those kept. A key with no more than ``keep`` rows
    keeps its history.
    """
    keys = list(keys)
    last = panel.groupBy(*keys).agg((F.max("pos") - keep).alias("_at"))
    at = panel.select(*keys, "pos", *CARRIED).join(last, keys).filter(F.col("pos") == F.col("_at"))
    if history is None:
        return at.select(*keys, (F.col("pos") + 1).alias("rows"), *CARRIED)
    before = history.select(*keys, F.col("rows").alias("_rows"), *[F.col(x).alias(f"_{x}") for x in CARRIED])
    both = at.join(before, keys, "full")
    moved = F.col("pos").isNotNull()
    return both.select(*keys, F.when(moved, F.coalesce("_rows", F.lit(0)) + F.col("pos") + 1).otherwise(F.col("_rows")).alias("rows"),
                       *[F.when(moved, F.col(x)).otherwise(F.col(f"_{x}")).alias(x) for x in CARRIED])


def candle_patterns(o: Column, h: Column, l: Column, c: Column) -> dict[str, Column]:
    return {
        "doji": flag(ratio(F.abs(o - c), h - l) < 0.1),
        "hammer": flag(((c - l) > 2.0 * (o - c)) & (c > o)),
        "shooting_star": flag(((h - c) > 2.0 * (c - o)) & (c < o)),
    }


def _trend_steps(df: DataFrame, keys: list[str]) -> DataFrame:
    w = block_window(keys)
    return df.withColumn("_vpt", F.col("volume") * one_row_change(
        F.col("close"), F.lag("close").over(w))).filter("_own")


def _parts(value: Column) -> dict[str, Column]:
    """The value as a whole number and the rest.

    Whole numbers below 2**53 add up without rounding, and the rests stay small: sums of large numbers
    come out alike in any order and however the blocks are cut.
    """
    whole = F.rint(value)
    return {"whole": whole, "rest": F.when(F.abs(value) < 2.0 ** 52, value - whole).when(value.isNotNull(), 0.0)}


def _trend_totals(df: DataFrame, keys: list[str]) -> DataFrame:
    """Per block, the sum of all earlier blocks of the key (one row per block), in parts."""
    parts = _parts(F.col("_vpt"))
    blocks = written(_trend_steps(df, keys).groupBy(*keys, "_blk").agg(
        *[F.sum(v).alias(f"_sum_{x}") for x, v in parts.items()]), "block-totals")
    before = (Window.partitionBy(*keys).orderBy("_blk")
              .rowsBetween(Window.unboundedPreceding, -1))
    return blocks.select(*keys, "_blk", *[
        F.coalesce(F.sum(f"_sum_{x}").over(before), F.lit(0.0)).alias(f"_before_{x}") for x in parts])


def _trend() -> Column:
    def total(part: str) -> Column:
        return F.col(f"_before_{part}") + F.coalesce(f"_local_{part}", F.lit(0.0))

    return F.when(F.col("pos") > 0, total("whole") + total("rest"))


def volume_price_trend(candles: DataFrame, *, keys: Sequence[str] = ("symbol",),
                       time: str = "timestamp", bucket: Column | None = None,
                       rows_per_block: int = BLOCK_ROWS) -> DataFrame:
    """Running sum of volume x one-row change over the whole series, as ``volume_price_trend``.

    Each block sums its own rows; the block table gives every block the total before it.
    """
    keys = list(keys)
    df = blocked(candles, keys, [time], bucket=day_of(time) if bucket is None else bucket, halo=1,
                 rows_per_block=rows_per_block)
    totals = _trend_totals(df, keys)
    upto = block_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    local = {f"_local_{x}": F.sum(v).over(upto) for x, v in _parts(F.col("_vpt")).items()}
    return (_trend_steps(df, keys).withColumns(local).join(totals, [*keys, "_blk"])
            .withColumn("volume_price_trend", _trend())
            .select(*candles.columns, "pos", "volume_price_trend"))


def full_panel(candles: DataFrame, *, keys: Sequence[str] = ("symbol",),
               time: str = "timestamp", bucket: Column | None = None,
               rows_per_block: int = BLOCK_ROWS) -> DataFrame:
    """``indicator_panel`` with ``volume_price_trend``."""
    return indicator_panel(candles, keys=keys, time=time, bucket=bucket, price_trend=True,
                           rows_per_block=rows_per_block)


def chunk_local_panel(candles: DataFrame, chunk_rows: int, *, time: str = "timestamp") -> DataFrame:
    """The panel restarted every ``chunk_rows`` rows of a symbol, running sums included."""
    numbered = number_rows(candles, ["symbol"], [time], bucket=day_of(time), name="_row")
    chunked = numbered.withColumn("chunk", F.expr(f"_row div {chunk_rows}")).drop("_row")
    return full_panel(chunked, keys=["symbol", "chunk"], time=time)


def clean_prices(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({x: finite(F.col(x)) for x in columns})
