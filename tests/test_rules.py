"""Rule boundaries and text functions by hand."""

import pytest
from pyspark.sql import functions as F

from tidewick.functions import rewards as rw, rules, text as tx
from tidewick.operators import risk

LIMITS = risk.RiskLimits(symbols=("BTC/USD",))


def one(spark, expr, **values):
    cols = [F.lit(v).cast("double") if isinstance(v, (int, float)) else
            (F.lit(v) if v is not None else F.lit(None).cast("double")) for v in values.values()]
    df = spark.range(1).select(*[c.alias(n) for n, c in zip(values, cols)])
    return df.select(expr).first()[0]


@pytest.mark.parametrize("symbol,want", [("BTC-USD", 21e6), ("ETH-USD", 120e6), ("SOL-USD", 500e6),
                                         ("DOGE-USD", 140e9), ("X", 1e6)])
def test_market_cap(spark, symbol, want):
    assert one(spark, rules.market_cap(F.lit(symbol), F.lit(1.0)), x=1) == want


def test_short_market_cap_table_lacks_doge(spark):
    assert one(spark, rules.market_cap(F.lit("DOGE-USD"), F.lit(2.0), "short"), x=1) == 2e6


@pytest.mark.parametrize("v,want", [(0.05, "Medium Volatility"), (0.051, "High Volatility"),
                                    (0.02, "Low Volatility"), (None, "Low Volatility")])
def test_volatility_regime(spark, v, want):
    assert one(spark, rules.volatility_regime(), volatility=v) == want


@pytest.mark.parametrize("rsi,bb,vol,want", [
    (19, .05, 3, "Extreme Greed"), (30, .5, 1, "Neutral"), (29, .5, 1, "Greed"),
    (81, .95, .4, "Extreme Fear"), (50, .95, 1, "Fear"), (None, None, None, "Neutral")])
def test_fear_greed_score(spark, rsi, bb, vol, want):
    assert one(spark, rules.fear_greed_score(), rsi=rsi, bb_position=bb, volume_ratio=vol) == want


@pytest.mark.parametrize("rsi,bb,want", [(29, .2, "Extreme Fear"), (29, .3, "Fear"),
                                         (71, .8, "Extreme Greed"), (71, .7, "Greed"),
                                         (60, .9, "Neutral")])
def test_fear_greed_simple(spark, rsi, bb, want):
    assert one(spark, rules.fear_greed_simple(), rsi=rsi, bb_position=bb) == want


def test_advanced_signal_volume_confirms_leader_only(spark):
    base = dict(rsi=20.0, macd=1.0, macd_signal=0.5, bb_position=0.05, stoch_k=10.0, stoch_d=5.0,
                williams_r=-90.0, volume_ratio=2.0)
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in base.items()],
                               *[F.lit(1).alias(x) for x in ("trend_short", "trend_medium")],
                               F.lit(0).alias("hammer"), F.lit(0).alias("shooting_star"))
    r = rules.with_signal_advanced(df).first()
    assert (r.signal, r.confidence) == ("BUY", 0.95)
    assert "High volume confirms buying pressure" in r.reasoning and r.reasoning.endswith(".")
    quiet = df.withColumns({"rsi": F.lit(50.0), "macd": F.lit(0.5), "bb_position": F.lit(0.5),
                            "stoch_k": F.lit(50.0), "williams_r": F.lit(-50.0),
                            "trend_medium": F.lit(0)})
    r = rules.with_signal_advanced(quiet).first()
    assert (r.signal, r.confidence, r.reasoning) == (
        "HOLD", 0.5, "Mixed signals with no clear direction")


def test_confidence_and_labels(spark):
    assert one(spark, rules.confidence_indicator(), rsi=24, bb_position=.05) == 0.95
    assert one(spark, rules.confidence_indicator(), rsi=34, bb_position=.29) == pytest.approx(.8)
    assert one(spark, rules.stop_loss_label(), volatility=.06, atr=10, close=100) == "5.0%"
    assert one(spark, rules.stop_loss_label(), volatility=.05, atr=1, close=100) == "1.5%"
    assert one(spark, rules.position_size_label(F.lit(.81)), volatility=.03) == "2-3%"
    assert one(spark, rules.take_profit_label(F.lit(.81)), volatility=.02) == "8-12%"


@pytest.mark.parametrize("s", ["", "   ", " a  b ", "a\x1cb", "x y　z", "one\ttwo\nthree",
                               "a​b", " lead"])
def test_token_count_is_python_split(spark, s):
    assert one(spark, tx.token_count(F.lit(s)), x=1) == len(s.split())
    assert one(spark, tx.truncate_tokens(F.lit(s), 2), x=1) == " ".join(s.split()[:2])


def test_parse_signal(spark):
    p = tx.parse_signal(F.lit("I would BUY or SELL. Confidence: 1.7\nreasoning: rising"))
    r = spark.range(1).select(*[c.alias(n) for n, c in p.items()]).first()
    assert (r.action, r.confidence, r.reasoning) == ("buy", 1.0, "reasoning: rising")
    p = tx.parse_signal(F.lit("nothing here"))
    r = spark.range(1).select(*[c.alias(n) for n, c in p.items()]).first()
    assert (r.action, r.confidence, r.reasoning) == ("hold", 0.5, "nothing here")


def test_extract_reasoning(spark):
    text = "x\n  Because of A \nDue to B\ny"
    assert one(spark, tx.extract_reasoning(F.lit(text)), x=1) == "Because of A Due to B"
    assert one(spark, tx.extract_reasoning(F.lit("z" * 300)), x=1) == "z" * 200


def test_render_defaults_and_missing(spark):
    df = spark.range(1)
    cols = {k: F.lit(None).cast("double" if isinstance(v, float) else "string")
            for k, v in tx.TEXT_DEFAULTS.items()}
    text = df.select(tx.render(tx.SFT_TEXT, cols, tx.TEXT_DEFAULTS)).first()[0]
    assert "- Symbol: UNKNOWN\n- Close: $0.00" in text and "SIGNAL: HOLD\nCONFIDENCE: 0.50" in text
    assert df.select(tx.render(tx.SFT_TEXT, cols)).first()[0] is None


@pytest.mark.parametrize("outcome,want", [(0.06, .5), (0.05, 0), (-0.06, -.3), (0.009, .2),
                                          (None, 0)])
def test_outcome_reward(spark, outcome, want):
    assert one(spark, rw.outcome_reward(F.col("o")), o=outcome) == want


def test_step_quality_caps_at_one(spark):
    text = "RSI oversold, MACD crossover, trend, support, volume, bollinger"
    assert one(spark, rw.step_quality(F.lit(rw.TECHNICAL), F.lit(text)), x=1) == 1.0
    assert one(spark, rw.step_quality(F.lit(rw.TECHNICAL), F.lit("rsi")), x=1) == 0.0


def test_reward_label_clamped(spark):
    label = rw.reward_label(F.lit(rw.SIGNAL), F.lit("buy"), F.lit(True), F.lit(.9), F.lit(.1))
    assert one(spark, label, x=1) == 1.0


def test_position_size_floor_and_price(spark):
    size = risk.position_size(LIMITS)
    assert one(spark, size, confidence=.5, volatility=0, exposure=0, price=100) == 10.0
    assert one(spark, size, confidence=.5, volatility=0, exposure=5, price=100) == 1.0
    assert one(spark, size, confidence=.001, volatility=0, exposure=0, price=100) == 0.0
    assert one(spark, size, confidence=.5, volatility=0, exposure=0, price=0) == 0.0


def test_gain_alert(spark):
    df = spark.createDataFrame([("a", 1.0, .1), ("b", 1.0, .099), ("c", 0.0, -.9), ("d", 2.0, -.05)],
                               "symbol string, qty double, unrealized_plpc double")
    got = {r.symbol: (r.type, r.message) for r in risk.position_alerts(df).collect()}
    assert got == {"a": ("position_gain", "Position a up 10.00%"),
                   "d": ("position_loss", "Position d down -5.00%")}


def test_alert_summary_without_alerts(spark):
    from tidewick.operators.performance import alert_summary

    none = spark.createDataFrame([], "type string, timestamp timestamp, trade_id long")
    assert [tuple(r) for r in alert_summary(none, ["timestamp", "trade_id"]).collect()] == [(None, 0, 0, 0)]
    some = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "type string, trade_id long")
    assert sorted(map(tuple, alert_summary(some, ["trade_id"], last=2).collect())) == [("a", 1, 2, 3), ("b", 1, 2, 3)]


def test_retention_counts_what_it_removes(spark):
    from tidewick.operators.memory import retention, retention_report

    items = spark.createDataFrame([(1, "2023-01-01", 0.1), (2, "2023-01-01", 0.9), (3, "2024-01-30", 0.1), (4, None, 0.1), (5, "2023-01-01", None)],
                                  "id int, at string, importance double").withColumn("timestamp", F.to_timestamp("at"))
    as_of = F.lit("2024-02-01").cast("timestamp")
    assert sorted(r.id for r in retention(items, as_of).collect()) == [2, 3, 4, 5]
    assert tuple(retention_report(items, as_of).first()) == (1, 4)
