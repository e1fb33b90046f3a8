"""Row-level text data sets: training text rows, chat texts, live prompts, step prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewick import schemas
from tidewick.functions import text as tx
from tidewick.operators.quality import last_n

FLAT_NAMES = {
    **{x: f"price_data_{x}" for x in schemas.PRICE_FIELDS},
    **{x: f"technical_indicators_{x}" for x in (
        *schemas.INDICATOR_FIELDS, *schemas.FLAG_FIELDS, *schemas.DISTANCE_FIELDS)},
    **{x: f"market_context_{x}" for x in ("market_cap", "fear_greed", "trend", "volatility_regime",
                                          "volume_regime")}}


def flat_columns(df: DataFrame) -> dict[str, Column]:
    """Slot name -> column of a flattened sample (plain names where the prefixed one is absent)."""
    out = {}
    for slot in {**FLAT_NAMES, **dict.fromkeys(tx.TEXT_DEFAULTS)}:
        name = FLAT_NAMES.get(slot, slot)
        if name in df.columns:
            out[slot] = F.col(name)
        elif slot in df.columns:
            out[slot] = F.col(slot)
        elif slot in tx.TEXT_DEFAULTS:
            out[slot] = F.lit(tx.TEXT_DEFAULTS[slot])
    return out


def dataset_rows(df: DataFrame, template: str = tx.SFT_TEXT, *, row_id: Column) -> DataFrame:
    """text, sample_id, original_signal, original_confidence; rows that cannot be rendered drop."""
    cols = flat_columns(df)
    rows = df.select(
        tx.render(template, cols, tx.TEXT_DEFAULTS if template == tx.SFT_TEXT else {})
        .alias("text"), row_id.alias("sample_id"), cols["signal"].alias("original_signal"),
        cols["confidence"].alias("original_confidence"))
    return rows.filter(F.col("text").isNotNull())


#: Every indicator of a sample in its order, with its format.
ALL_INDICATORS = {x: "%d" if x in schemas.FLAG_FIELDS else "%.4f"
                  for x in (*schemas.INDICATOR_FIELDS, *schemas.FLAG_FIELDS, *schemas.DISTANCE_FIELDS)}


def chat_analysis(df: DataFrame, indicators: dict[str, str] | None = None) -> Column:
    """Chat text with one line for every indicator, or those given as a column and its printf format."""
    indicators = ALL_INDICATORS if indicators is None else indicators

    def text_of(name: str) -> Column:
        return F.coalesce(tx.number_text(F.col(name)), F.lit("N/A"))

    extra = {x: F.coalesce(F.col(x), F.lit(d)) if x in df.columns else F.lit(d)
             for x, d in tx.CHAT_DEFAULTS.items()}
    return tx.render(tx.CHAT_ANALYSIS, {
        "indicator_lines": tx.indicator_lines(indicators), "rsi_text": text_of("rsi"),
        "macd_signal_text": text_of("macd_signal"), **extra})


def _listing(header: str, lines: Column) -> Column:
    return F.when(F.size(lines) > 0, F.concat(
        F.lit(header), F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")))


def live_prompts(requests: DataFrame, bars: DataFrame, positions: DataFrame, as_of: str
                 ) -> DataFrame:
    """One prompt per (account, symbol) request: the symbol's last five bars, the account's positions."""
    bar_line = F.format_string(
        "Time: %s, Open: %s, High: %s, Low: %s, Close: %s, Volume: %s",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"),
        *[F.col(x).cast("string") for x in ("open", "high", "low", "close", "volume")])
    newest = last_n(bars, 5, ["timestamp"]).groupBy("symbol").agg(
        F.array_sort(F.collect_list(F.struct("timestamp", bar_line.alias("line")))).alias("_b"))
    held_line = F.format_string("Symbol: %s, Qty: %s, Side: %s, P&L: %s", "symbol",
                                F.col("qty").cast("string"), F.col("side"),
                                F.col("unrealized_pl").cast("string"))
    # One line per symbol an account holds, so the list is as long as the symbol set.
    held = positions.groupBy("account").agg(
        F.array_sort(F.collect_list(F.struct("symbol", held_line.alias("line")))).alias("_p"))
    df = requests.join(newest, "symbol", "left").join(held, "account", "left")
    texts = {
        "bars_text": F.coalesce(_listing("Recent Price Bars:\n", F.transform(
            "_b", lambda x: x["line"])), F.lit("")),
        "positions_text": F.coalesce(_listing("Current Positions:\n", F.transform(
            "_p", lambda x: x["line"])), F.lit("")),
        "as_of": F.lit(as_of)}
    return df.select("account", "symbol", tx.render(tx.LIVE_PROMPT, texts).alias("prompt"))


def step_prompts(decisions: DataFrame) -> DataFrame:
    """The four chained prompts of a decision, from its market columns and steps."""
    def content(i: int) -> Column:
        return F.coalesce(F.try_element_at("steps", F.lit(i + 1))["content"], F.lit(""))

    summary = F.array_join(F.transform("steps", lambda s: F.concat(
        s["step_type"], F.lit(": "), s["content"])), "\n")
    texts = {"technical_analysis": content(0), "risk_assessment": content(1),
             "analysis_summary": summary}
    return decisions.select("decision_id", *[
        tx.render(template, texts).alias(name) for name, template in (
            ("technical_prompt", tx.STEP_TECHNICAL), ("risk_prompt", tx.STEP_RISK),
            ("context_prompt", tx.STEP_CONTEXT), ("signal_prompt", tx.STEP_SIGNAL))])


def step_scoring_prompts(steps: DataFrame) -> DataFrame:
    """The scoring prompt of each exploded step."""
    return steps.select("decision_id", "step_no", tx.render(tx.STEP_SCORING).alias("prompt"))
