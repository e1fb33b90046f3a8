"""Step scoring rules: keyword quality, correctness, rewards and feedback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.functions.numeric import ladder, total
from tidewick.functions.text import extract_signal

# The four step types.
TECHNICAL, RISK, CONTEXT, SIGNAL = ("technical_analysis", "risk_assessment", "market_context",
                                    "signal_generation")
# Keyword groups, one quality point each.
QUALITY_WORDS = {
    TECHNICAL: [["trend", "momentum", "direction"], ["support", "resistance", "level"],
                ["volume", "liquidity", "activity"], ["bollinger", "band", "channel"]],
    RISK: [["volatility", "risk", "uncertainty"], ["position", "size", "allocation"],
           ["stop", "loss", "exit"], ["timing", "entry", "exit"],
           ["correlation", "diversification"], ["scenario", "stress", "test"]],
    CONTEXT: [["sentiment", "mood", "feeling"], ["news", "event", "announcement"],
              ["macro", "economic", "policy"], ["seasonal", "cycle", "pattern"],
              ["institutional", "retail", "flow"], ["regulatory", "compliance", "legal"]],
    SIGNAL: [["buy", "sell", "hold"], ["confidence", "probability", "certainty"],
             ["reasoning", "because", "due to"], ["risk", "management", "protection"],
             ["target", "profit", "objective"], ["timeframe", "duration", "period"]],
}
# Patterns that make an RSI or MACD mention count. "." does not cross lines.
RSI_PATTERNS = [r"rsi.*(?:overbought|oversold|neutral)", r"(?:overbought|oversold).*rsi",
                r"rsi.*(?:above|below).*\d+", r"rsi.*(?:divergence|convergence)"]
MACD_PATTERNS = [r"macd.*(?:crossover|cross)", r"(?:crossover|cross).*macd",
                 r"macd.*(?:above|below).*zero", r"macd.*(?:divergence|convergence)"]
# Quality criteria per step type in the shipped configuration.
CRITERIA = 4
# Rewards.
CORRECT, INCORRECT, CONFIDENT_CORRECT, CAUTIOUS_INCORRECT = 0.5, -0.2, 0.3, 0.1
PROFITABLE, LOSING, AVOIDED = 0.5, -0.3, 0.2
STEP_BONUS = {
    TECHNICAL: [(["rsi"], 0.1), (["macd"], 0.1), (["bollinger"], 0.1),
                (["support", "resistance"], 0.1)],
    RISK: [(["volatility"], 0.1), (["stop", "loss"], 0.1), (["position", "size"], 0.1),
           (["timing"], 0.1)],
    CONTEXT: [(["sentiment"], 0.1), (["news"], 0.1), (["trend", "cycle"], 0.1),
              (["condition"], 0.1)],
    SIGNAL: [(["buy", "sell", "hold"], 0.2), (["confidence"], 0.1),
             (["reasoning", "because"], 0.1), (["risk"], 0.1)],
}
QUALITY_BONUS = 0.1
# Feedback phrases for a missing word.
HINTS = {
    TECHNICAL: [(["rsi"], "Consider mentioning RSI analysis"), (["trend"], "Include trend analysis")],
    RISK: [(["volatility"], "Consider volatility assessment"),
           (["position"], "Include position sizing")],
    CONTEXT: [(["sentiment"], "Consider market sentiment"), (["news"], "Include news analysis")],
    SIGNAL: [(["buy", "sell", "hold"], "Provide clear trading signal"),
             (["confidence"], "Include confidence level")],
}
# Words of the clamped reward label.
LABEL_WORDS = {TECHNICAL: ["rsi", "macd", "bollinger", "support", "resistance"],
               RISK: ["volatility", "stop loss", "position size", "risk"]}


def _any(low: Column, words: list[str]) -> Column:
    out = low.contains(words[0])
    for word in words[1:]:
        out = out | low.contains(word)
    return out


def _by_step(step: Column, per_type: dict[str, Column], otherwise) -> Column:
    return ladder([(step == t, v) for t, v in per_type.items()], otherwise)


def step_quality(step: Column, content: Column, criteria: int = CRITERIA, *,
                 low: Column | None = None) -> Column:
    """``low`` is the lower-case content, here and below, where the caller has it already."""
    low = F.lower(content) if low is None else low

    def points(kind: str) -> Column:
        hits = [_any(low, words) for words in QUALITY_WORDS[kind]]
        if kind == TECHNICAL:
            hits += [low.rlike("|".join(RSI_PATTERNS)), low.rlike("|".join(MACD_PATTERNS))]
        return total([h.cast("int") for h in hits])

    score = _by_step(step, {k: points(k) for k in QUALITY_WORDS}, 0)
    return F.least(F.lit(1.0), score / float(criteria))


def step_correctness(step: Column, content: Column, *, rsi: Column, change_24h: Column,
                     volatility: Column, fear_greed: Column, outcome: Column,
                     low: Column | None = None) -> Column:
    low = F.lower(content) if low is None else low
    rsi, change = F.coalesce(rsi, F.lit(50.0)), F.coalesce(change_24h, F.lit(0.0))
    vol, mood = F.coalesce(volatility, F.lit(0.02)), F.coalesce(fear_greed, F.lit("Neutral"))
    over, under = low.contains("overbought"), low.contains("oversold")
    bad_rsi = low.contains("rsi") & (((rsi > 70) & under) | ((rsi < 30) & over)
                                     | (rsi.between(30, 70) & (over | under)))
    bad_trend = low.contains("trend") & (((change > 0) & low.contains("bearish"))
                                         | ((change < 0) & low.contains("bullish")))
    bad_risk = (((vol > 0.05) & low.contains("low risk"))
                | ((vol < 0.01) & low.contains("high risk"))
                | ((vol > 0.03) & low.contains("large position"))
                | ((vol < 0.01) & low.contains("small position")))
    bad_mood = (((mood == "Extreme Fear") & low.contains("greed"))
                | ((mood == "Extreme Greed") & low.contains("fear")))
    verdict = extract_signal(content)
    good_signal = outcome.isNull() | ladder(
        [(verdict == "BUY", outcome > 0), (verdict == "SELL", outcome < 0)],
        F.abs(outcome) < 0.01)
    return _by_step(step, {TECHNICAL: ~(bad_rsi | bad_trend), RISK: ~bad_risk,
                           CONTEXT: ~bad_mood, SIGNAL: good_signal}, True)


def base_reward(correct: Column, confidence: Column) -> Column:
    return F.when(correct, F.lit(CORRECT) + F.when(confidence > 0.7, CONFIDENT_CORRECT)
                  .otherwise(0.0)).otherwise(
        F.lit(INCORRECT) + F.when(confidence < 0.3, CAUTIOUS_INCORRECT).otherwise(0.0))


def step_specific_reward(step: Column, content: Column, quality: Column, *,
                         low: Column | None = None) -> Column:
    low = F.lower(content) if low is None else low
    bonus = {k: total([F.when(_any(low, words), amount).otherwise(0.0) for words, amount in rules])
             for k, rules in STEP_BONUS.items()}
    return _by_step(step, bonus, 0.0) + quality * QUALITY_BONUS


def outcome_reward(outcome: Column) -> Column:
    return ladder([(outcome > 0.05, PROFITABLE), (outcome < -0.05, LOSING),
                   (F.abs(outcome) < 0.01, AVOIDED)], 0.0)


def step_feedback(step: Column, content: Column, quality: Column, correct: Column, *,
                  low: Column | None = None) -> Column:
    low = F.lower(content) if low is None else low
    hints = [_by_step(step, {k: F.when(~_any(low, rules[i][0]), rules[i][1])
                             for k, rules in HINTS.items()}, F.lit(None).cast("string"))
             for i in range(2)]
    return F.concat_ws(
        "; ", F.when(correct, "✓ Correct analysis").otherwise("✗ Incorrect analysis"),
        ladder([(quality > 0.8, "High quality analysis"), (quality > 0.5, "Good analysis")],
               "Analysis needs improvement"), *hints)


def evaluate_steps(steps: DataFrame) -> DataFrame:
    """Needs step_type, content, confidence, the market columns and ``outcome``."""
    step, content, low = F.col("step_type"), F.col("content"), F.col("_low")
    df = steps.withColumn("_low", F.lower(content)).withColumns({
        "quality_score": step_quality(step, content, low=low),
        "correctness": step_correctness(
            step, content, rsi=F.col("rsi"), change_24h=F.col("change_24h"),
            volatility=F.col("volatility"), fear_greed=F.col("fear_greed"),
            outcome=F.col("outcome"), low=low),
    })
    df = df.withColumns({
        "base_reward": base_reward(F.col("correctness"), F.col("confidence")),
        "step_reward": step_specific_reward(step, content, F.col("quality_score"), low=low),
        "outcome_reward": outcome_reward(F.col("outcome")),
        "feedback": step_feedback(step, content, F.col("quality_score"), F.col("correctness"),
                                  low=low),
    })
    return df.drop("_low").withColumn("reward", F.col("base_reward") + F.col("step_reward")
                         + F.col("outcome_reward"))


def reward_label(step: Column, content: Column, correct: Column, confidence: Column,
                 outcome: Column) -> Column:
    """The 0..1 reward of a labelled step."""
    low, up = F.lower(content), F.upper(content)
    signal = step == SIGNAL
    value = total([
        F.when(correct, 0.5).otherwise(0.0),
        ladder([(correct & (confidence > 0.7), 0.2), (~correct & (confidence < 0.3), 0.1)], 0.0),
        ladder([(signal & (outcome > 0) & up.isin("BUY", "SELL"), 0.3),
                (signal & (outcome <= 0) & (up == "HOLD"), 0.2)], 0.0),
        ladder([((step == k) & _any(low, words), 0.1) for k, words in LABEL_WORDS.items()], 0.0)])
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))


def explode_steps(decisions: DataFrame, *parent: str) -> DataFrame:
    """One row per step with its decision's columns alongside (no shuffle).

    The outer explode keeps the optimizer from adding a filter that would inline the whole step
    wording below the projections.
    """
    rows = decisions.select(*parent, F.posexplode_outer("steps").alias("step_no", "_s"))
    return rows.filter(F.col("_s").isNotNull()).select(*parent, "step_no", "_s.*")


def step_accuracy(evaluated: DataFrame) -> DataFrame:
    """Mean correctness per step type, and average reward per decision over all steps.

    Decisions are counted by their first step (``step_no`` 0). One rollup pass gives both; its total row is then spread over the few step types.
    """
    t = evaluated.rollup("step_type").agg(
        F.avg(F.col("correctness").cast("int")).alias("accuracy"),
        (F.sum("reward") / F.count_if(F.col("step_no") == 0)).alias("_per_decision"),
        F.grouping("step_type").alias("_total"))
    overall = F.max(F.when(F.col("_total") == 1, F.col("_per_decision"))).over(
        Window.partitionBy())
    return (t.withColumn("average_reward", overall).filter(F.col("_total") == 0)
            .select("step_type", "accuracy", "average_reward"))
