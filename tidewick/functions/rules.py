"""Rule-based labels over panel columns, as Column expressions.

Inputs are flat panel columns by name (``close``, ``rsi``, ...). A comparison with NULL never holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewick.functions.numeric import ladder, ratio, total

# Circulating-supply multipliers by symbol and the default.
SUPPLY = {"BTC-USD": 21_000_000, "ETH-USD": 120_000_000, "SOL-USD": 500_000_000,
          "DOGE-USD": 140_000_000_000}
SUPPLY_SHORT = {s: SUPPLY[s] for s in ("BTC-USD", "ETH-USD", "SOL-USD")}
SUPPLY_DEFAULT = 1_000_000

# Phrases of the advanced signal, in rule order.
ADVANCED_PHRASES = {
    "rsi_buy3": "RSI indicates extreme oversold conditions",
    "rsi_buy2": "RSI indicates oversold conditions",
    "rsi_sell3": "RSI indicates extreme overbought conditions",
    "rsi_sell2": "RSI indicates overbought conditions",
    "macd_buy2": "MACD shows bullish momentum above zero line",
    "macd_sell2": "MACD shows bearish momentum below zero line",
    "macd_buy1": "MACD shows bullish crossover",
    "macd_sell1": "MACD shows bearish crossover",
    "bb_buy2": "Price near lower Bollinger Band (oversold)",
    "bb_sell2": "Price near upper Bollinger Band (overbought)",
    "bb_buy1": "Price in lower half of Bollinger Bands",
    "bb_sell1": "Price in upper half of Bollinger Bands",
    "stoch_buy": "Stochastic shows oversold with bullish crossover",
    "stoch_sell": "Stochastic shows overbought with bearish crossover",
    "williams_buy": "Williams %R indicates oversold conditions",
    "williams_sell": "Williams %R indicates overbought conditions",
    "trend_buy": "Strong bullish trend confirmed by moving averages",
    "trend_sell": "Strong bearish trend confirmed by moving averages",
    "volume_buy": "High volume confirms buying pressure",
    "volume_sell": "High volume confirms selling pressure",
    "hammer": "Hammer pattern detected (bullish reversal)",
    "shooting_star": "Shooting star pattern detected (bearish reversal)",
    "none": "Mixed signals with no clear direction",
}
# Phrases of the threshold signal.
THRESHOLD_PHRASES = {
    "rsi_buy": "RSI indicates oversold conditions",
    "rsi_sell": "RSI indicates overbought conditions",
    "macd_buy": "MACD shows bullish momentum",
    "macd_sell": "MACD shows bearish momentum",
    "bb_buy": "Price near lower Bollinger Band",
    "bb_sell": "Price near upper Bollinger Band",
    "volume_buy": "High volume confirms buying pressure",
    "volume_sell": "High volume confirms selling pressure",
    "day_buy": "Strong 24h uptrend",
    "day_sell": "Strong 24h downtrend",
    "none": "Mixed signals, maintaining current position",
}
# Phrases of the short reasoning.
SHORT_PHRASES = {
    "rsi_buy": "RSI indicates oversold conditions",
    "rsi_sell": "RSI indicates overbought conditions",
    "bb_buy": "Price near lower Bollinger Band",
    "bb_sell": "Price near upper Bollinger Band",
    "macd_buy": "MACD shows bullish momentum",
    "macd_sell": "MACD shows bearish momentum",
    "none": "Mixed technical signals",
}

c = F.col


def market_cap(symbol: Column, close: Column, variant: str = "full") -> Column:
    """The handful of fixed multipliers is an inline lookup; see ``market_cap_join`` for a table."""
    table = SUPPLY if variant == "full" else SUPPLY_SHORT
    lookup = F.create_map(*[F.lit(x) for s, m in table.items() for x in (s, float(m))])
    return close * F.coalesce(F.try_element_at(lookup, symbol), F.lit(float(SUPPLY_DEFAULT)))


def fear_greed_simple() -> Column:
    rsi, bb = c("rsi"), c("bb_position")
    return ladder([((rsi < 30) & (bb < 0.3), "Extreme Fear"), (rsi < 40, "Fear"),
                   ((rsi > 70) & (bb > 0.7), "Extreme Greed"), (rsi > 60, "Greed")], "Neutral")


def fear_greed_score() -> Column:
    rsi, bb, vol = c("rsi"), c("bb_position"), c("volume_ratio")
    score = total([
        ladder([(rsi < 20, 3), (rsi < 30, 2), (rsi > 80, -3), (rsi > 70, -2)], 0),
        ladder([(bb < 0.1, 2), (bb > 0.9, -2)], 0),
        ladder([(vol > 2, 1), (vol < 0.5, -1)], 0)])
    return ladder([(score >= 3, "Extreme Greed"), (score >= 1, "Greed"),
                   (score <= -3, "Extreme Fear"), (score <= -1, "Fear")], "Neutral")


def trend_simple() -> Column:
    close, s20, s50 = c("close"), c("sma_20"), c("sma_50")
    return ladder([((close > s20) & (close > s50), "Bullish"),
                   ((close < s20) & (close < s50), "Bearish")], "Sideways")


def trend_flags_label() -> Column:
    s, m, l = (c(f"trend_{x}") == 1 for x in ("short", "medium", "long"))
    return ladder([(s & m & l, "Strong Bullish"), (s & m, "Bullish"),
                   (~s & ~m & ~l, "Strong Bearish"), (~s & ~m, "Bearish")], "Sideways")


def volatility_regime() -> Column:
    v = c("volatility")
    return ladder([(v > 0.05, "High Volatility"), (v > 0.02, "Medium Volatility")],
                  "Low Volatility")


def volume_regime() -> Column:
    r = c("volume_ratio")
    return ladder([(r > 2, "High Volume"), (r > 1.5, "Above Average Volume"),
                   (r < 0.5, "Low Volume")], "Normal Volume")


def price_momentum() -> Column:
    return F.struct(
        c("change_1h").alias("short_term"), c("change_4h").alias("medium_term"),
        c("change_24h").alias("long_term"),
        (c("change_1h") - c("change_4h")).alias("acceleration"),
        F.abs("change_24h").alias("strength"))


def support_resistance_levels(variant: str = "bands") -> Column:
    """``bands`` uses the Bollinger columns; ``percent`` uses close +/- 2 %."""
    close = c("close")
    if variant == "bands":
        up, low, mid = c("bb_upper"), c("bb_lower"), c("bb_middle")
    else:
        up, low, mid = close * 1.02, close * 0.98, close
    return F.struct(
        up.alias("resistance_1"), (close * 1.05).alias("resistance_2"),
        low.alias("support_1"), (close * 0.95).alias("support_2"), mid.alias("pivot"),
        (ratio(up - close, close) * 100).alias("distance_to_resistance"),
        (ratio(close - low, close) * 100).alias("distance_to_support"))


def market_structure() -> Column:
    rsi, bb = c("rsi"), c("bb_position")
    bullish = F.coalesce(c("macd") > c("macd_signal"), F.lit(False))
    rsi_regime = ladder([(rsi < 30, "oversold"), (rsi > 70, "overbought")], "neutral")
    bb_regime = ladder([(bb > 0.8, "upper"), (bb < 0.2, "lower")], "middle")
    agree = total([bullish.cast("int"), (rsi_regime != "overbought").cast("int"),
                   (bb_regime != "upper").cast("int"), c("trend_short")])
    return F.struct(
        F.abs(c("macd") - c("macd_signal")).alias("trend_strength"),
        F.when(bullish, "bullish").otherwise("bearish").alias("momentum_direction"),
        F.when(c("volatility") > 0.03, "high").otherwise("low").alias("volatility_level"),
        rsi_regime.alias("rsi_regime"), bb_regime.alias("bb_regime"),
        (agree / 4.0).alias("confluence_score"))


def _larger(buy: Column, sell: Column) -> Column:
    return ladder([(buy > sell, "BUY"), (sell > buy, "SELL")], "HOLD")


def signal_basic() -> Column:
    rsi, bb = c("rsi"), c("bb_position")
    bullish = F.coalesce(c("macd") > c("macd_signal"), F.lit(False))
    buy = total([ladder([(rsi < 30, 2)], 0), bullish.cast("int"), ladder([(bb < 0.2, 1)], 0)])
    sell = total([ladder([(rsi > 70, 2)], 0), (~bullish).cast("int"),
                  ladder([(bb > 0.8, 1)], 0)])
    return _larger(buy, sell)


def _vote(rules: list[tuple[Column, str, int]], words: dict[str, str]) -> tuple[Column, Column]:
    """One exclusive rule group: points (+ buy, - sell) and phrase of the first rule that holds."""
    points = ladder([(cond, n) for cond, _, n in rules], 0)
    phrase = ladder([(cond, words[key]) for cond, key, _ in rules], F.lit(None).cast("string"))
    return points, phrase


def _signal_of(net: Column) -> Column:
    """SELL / HOLD / BUY by sign; ``net`` is referenced once, which keeps inlined filters small."""
    names = F.array(F.lit("SELL"), F.lit("HOLD"), F.lit("BUY"))
    return F.element_at(names, F.signum(net).cast("int") + 2)


def with_signal_advanced(df: DataFrame) -> DataFrame:
    """Adds ``signal``, ``confidence`` and ``reasoning``.

    Each rule group speaks for one side only, so buy minus sell score is one signed sum.
    """
    rsi, macd, sig, bb = c("rsi"), c("macd"), c("macd_signal"), c("bb_position")
    k, d, wr = c("stoch_k"), c("stoch_d"), c("williams_r")
    up = (c("trend_short") == 1) & (c("trend_medium") == 1)
    down = (c("trend_short") == 0) & (c("trend_medium") == 0)
    groups = [_vote(g, ADVANCED_PHRASES) for g in (
        [(rsi < 25, "rsi_buy3", 3), (rsi < 35, "rsi_buy2", 2), (rsi > 75, "rsi_sell3", -3),
         (rsi > 65, "rsi_sell2", -2)],
        [((macd > sig) & (macd > 0), "macd_buy2", 2), ((macd < sig) & (macd < 0), "macd_sell2", -2),
         (macd > sig, "macd_buy1", 1), (macd < sig, "macd_sell1", -1)],
        [(bb < 0.1, "bb_buy2", 2), (bb > 0.9, "bb_sell2", -2), (bb < 0.3, "bb_buy1", 1),
         (bb > 0.7, "bb_sell1", -1)],
        [((k < 20) & (k > d), "stoch_buy", 1), ((k > 80) & (k < d), "stoch_sell", -1)],
        [(wr < -80, "williams_buy", 1), (wr > -20, "williams_sell", -1)],
        [(up, "trend_buy", 2), (down, "trend_sell", -2)])]
    df = df.withColumn("_net", total([points for points, _ in groups]))
    # The volume group adds a point to the side leading so far.
    loud = c("volume_ratio") > 1.5
    volume = _vote([(loud & (c("_net") > 0), "volume_buy", 1),
                    (loud & (c("_net") < 0), "volume_sell", -1)], ADVANCED_PHRASES)
    hammer = _vote([(c("hammer") == 1, "hammer", 1)], ADVANCED_PHRASES)
    star = _vote([(c("shooting_star") == 1, "shooting_star", -1)], ADVANCED_PHRASES)
    df = df.withColumns({
        "_score": total([c("_net"), volume[0], hammer[0], star[0]]),
        "_words": F.concat_ws(". ", *[phrase for _, phrase in (*groups, volume, hammer, star)])})
    return df.withColumns({
        "signal": _signal_of(c("_score")),
        "confidence": confidence_score(c("_score")),
        "reasoning": F.when(c("_words") == "", ADVANCED_PHRASES["none"])
        .otherwise(F.concat(c("_words"), F.lit("."))),
    }).drop("_net", "_score", "_words")


def confidence_score(net: Column) -> Column:
    """From buy minus sell points."""
    return F.least(F.lit(0.95), 0.5 + F.abs(net) / 10.0)


def with_signal_threshold(df: DataFrame) -> DataFrame:
    """Adds ``signal`` (needs three points) and ``reasoning``."""
    rsi, macd, sig, bb = c("rsi"), c("macd"), c("macd_signal"), c("bb_position")
    groups = [_vote(g, THRESHOLD_PHRASES) for g in (
        [(rsi < 30, "rsi_buy", 2), (rsi > 70, "rsi_sell", -2)],
        [((macd > sig) & (macd > 0), "macd_buy", 1), ((macd < sig) & (macd < 0), "macd_sell", -1)],
        [(bb < 0.2, "bb_buy", 1), (bb > 0.8, "bb_sell", -1)])]
    bought, sold = _sides([points for points, _ in groups])
    df = df.withColumns({"_buy": bought, "_sell": sold})
    loud = c("volume_ratio") > 1.5
    volume = _vote([(loud & (c("_buy") > c("_sell")), "volume_buy", 1),
                    (loud & (c("_sell") > c("_buy")), "volume_sell", -1)], THRESHOLD_PHRASES)
    day = _vote([(c("change_24h") > 5, "day_buy", 1), (c("change_24h") < -5, "day_sell", -1)],
                THRESHOLD_PHRASES)
    bought, sold = _sides([volume[0], day[0]])
    df = df.withColumns({
        "_buy": c("_buy") + bought, "_sell": c("_sell") + sold,
        "_words": F.concat_ws(". ", *[phrase for _, phrase in (*groups, volume, day)])})
    return df.withColumns({
        "signal": ladder([((c("_buy") > c("_sell")) & (c("_buy") >= 3), "BUY"),
                          ((c("_sell") > c("_buy")) & (c("_sell") >= 3), "SELL")], "HOLD"),
        "reasoning": F.concat(F.when(c("_words") == "", THRESHOLD_PHRASES["none"])
                              .otherwise(c("_words")), F.lit(".")),
    }).drop("_buy", "_sell", "_words")


def _sides(points: list[Column]) -> tuple[Column, Column]:
    return (total([F.greatest(p, F.lit(0)) for p in points]),
            total([F.greatest(-p, F.lit(0)) for p in points]))


def confidence_indicator() -> Column:
    rsi, bb = c("rsi"), c("bb_position")
    return F.least(F.lit(0.95), total([
        F.lit(0.5),
        ladder([((rsi < 25) | (rsi > 75), 0.3), ((rsi < 35) | (rsi > 65), 0.2)], 0.0),
        ladder([((bb < 0.1) | (bb > 0.9), 0.2), ((bb < 0.3) | (bb > 0.7), 0.1)], 0.0)]))


def position_size_label(confidence: Column) -> Column:
    """Pass ``lit(0.5)`` for the variant that never sees a confidence."""
    return ladder([((confidence > 0.8) & (c("volatility") < 0.03), "3-5%"),
                   (confidence > 0.7, "2-3%"), (confidence > 0.6, "1-2%")], "0.5-1%")


def take_profit_label(confidence: Column) -> Column:
    return ladder([((confidence > 0.8) & (c("volatility") < 0.03), "8-12%"),
                   (confidence > 0.7, "5-8%")], "3-5%")


def stop_loss_pct() -> Column:
    move = ratio(c("atr"), c("close"))
    return F.when(c("volatility") > 0.05, F.least(F.lit(5.0), move * 2 * 100)).otherwise(
        F.least(F.lit(3.0), move * 1.5 * 100))


def stop_loss_label() -> Column:
    return F.format_string("%.1f%%", stop_loss_pct())


def reasoning_short() -> Column:
    rsi, bb, macd, sig = c("rsi"), c("bb_position"), c("macd"), c("macd_signal")
    none = F.lit(None).cast("string")
    words = F.concat_ws(
        ". ",
        ladder([(rsi < 30, SHORT_PHRASES["rsi_buy"]), (rsi > 70, SHORT_PHRASES["rsi_sell"])], none),
        ladder([(bb < 0.2, SHORT_PHRASES["bb_buy"]), (bb > 0.8, SHORT_PHRASES["bb_sell"])], none),
        ladder([(macd > sig, SHORT_PHRASES["macd_buy"]), (macd < sig, SHORT_PHRASES["macd_sell"])],
               none))
    return F.concat(F.when(words == "", SHORT_PHRASES["none"]).otherwise(words), F.lit("."))


def fill_indicator_defaults(df: DataFrame) -> DataFrame:
    # Defaults for missing indicators.
    constant = {"rsi": 50.0, "macd": 0.0, "macd_signal": 0.0, "bb_position": 0.5,
                "volume_ratio": 1.0, "volatility": 0.0}
    return df.fillna(constant).withColumns(
        {x: F.coalesce(c(x), c("close")) for x in ("sma_20", "sma_50")})
