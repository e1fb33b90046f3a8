"""Queries that render, parse and score text."""

from __future__ import annotations

import re

from pyspark.sql import functions as F, types as T

from tidewick.functions import rewards as rw, text as tx
from tidewick.functions.rules import stop_loss_pct
from tidewick.operators import performance as perf, texts
from tidewick.plans import sqltext as S, tables as t
from tidewick.plans.registry import query

KEY = ["symbol", "timestamp"]
_LAB = (S.ADVANCED, S.LABELLED)

# Numbers are put just off rounding ties before they are printed, alike in Spark and SQL.
_SHOWN = ["close", "high", "low", "volume", "change_24h", "rsi", "macd", "macd_signal",
          "bb_position", "volume_ratio", "stoch_k", "williams_r", "volatility", "market_cap", "atr",
          "sma_200"]
_TX = "tx AS (SELECT * REPLACE (" + ", ".join(
    f"round({c} + 1e-9, 6) + 1e-7 AS {c}" for c in _SHOWN) + ") FROM lab)"


def _off_ties(df):
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 6) + 1e-7 for c in _SHOWN})


def _rows(spark, sf):
    """Labelled rows with ``_stop_pct`` from the untouched columns."""
    return _off_ties(t.labelled(spark, sf).withColumn("_stop_pct", stop_loss_pct()))


def _sql_text(template: str, defaults: dict | None = None, **columns: str) -> str:
    """The template as one printf call."""
    args = []
    for name, fmt in re.findall(r"\{(\w+):(%[^}]*)\}", template):
        expr = columns.get(name, name)
        if name in (defaults or {}):
            d = defaults[name]
            expr = f"coalesce({expr}, {d!r})"
        if fmt == "%s" and name == "confidence":
            expr = f"CAST({expr} AS VARCHAR)"
        args.append(f"format('{{:,}}', CAST(round({expr}) AS BIGINT))" if "," in fmt else expr)
    pattern = re.sub(r"\{\w+:(%[^}]*)\}", lambda m: "%s" if "," in m[1] else m[1], template)
    return "printf('" + pattern.replace("'", "''") + "', " + ", ".join(args) + ")"


def _not_null(template: str, *but: str) -> str:
    names = sorted({n for n, _ in re.findall(r"\{(\w+):(%[^}]*)\}", template)} - set(but))
    return " AND ".join(f"{n} IS NOT NULL" for n in names)


def _text_query(name: str, template: str, defaults=None) -> None:
    text = _sql_text(template, defaults)
    if not defaults:  # a text with a missing value is NULL, as a row
        text = f"CASE WHEN {_not_null(template)} THEN {text} END"

    @query(name, S.hourly(f"SELECT symbol, timestamp, {text} AS text FROM tx", *_LAB, _TX)
           if "{position_size" not in template else S.hourly(
        f"SELECT symbol, timestamp, {text} AS text FROM txf",
        *_LAB, _TX, """txf AS (SELECT *, '0.5-1%' AS position_size, '3-5%' AS take_profit,
          printf('%.1f%%', stop_pct + 1e-7) AS stop_loss FROM tx)"""))
    def run(spark, sf):
        df = _rows(spark, sf)
        df = df.withColumn("stop_loss", F.format_string("%.1f%%", F.col("_stop_pct") + 1e-7))
        return df.select(*KEY, tx.render(template, texts.flat_columns(df) | {
            x: F.col(x) for x in ("position_size", "stop_loss", "take_profit")}, defaults or {})
            .alias("text"))


_text_query("render_sft_text", tx.SFT_TEXT, tx.TEXT_DEFAULTS)
_text_query("render_sft_text_full", tx.SFT_TEXT_FULL)
_text_query("render_sft_text_mid", tx.SFT_TEXT_MID)
_text_query("render_sft_text_compact", tx.SFT_TEXT_COMPACT)

def _number(col: str) -> str:
    plain = f"CAST(CAST({col} AS DECIMAL(38, 12)) AS VARCHAR)"
    return rf"coalesce(regexp_replace({plain}, '(\.[0-9]+?)0+$', '\1'), 'N/A')"


_LINES_SQL = "concat_ws(chr(10), " + ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN printf('- {c}: {f}', {c}) END" for c, f in texts.ALL_INDICATORS.items()) + ")"
#: Off rounding ties, as above; the running price trend, a sum of large numbers, agrees to one decimal.
_ALL_SHOWN = {c: "round({}, 1) + 1e-7" if c == "volume_price_trend" else "round({} + 1e-9, 6) + 1e-7"
              for c in dict.fromkeys([*_SHOWN, *[x for x, f in texts.ALL_INDICATORS.items() if f != "%d"]])}
_TX_ALL = "tx AS (SELECT * REPLACE (" + ", ".join(f"{e.format(c)} AS {c}" for c, e in _ALL_SHOWN.items()) + ") FROM lab)"


@query("render_chat_analysis", S.hourly(
    "SELECT symbol, timestamp, " + _sql_text(
        tx.CHAT_ANALYSIS, indicator_lines=_LINES_SQL, rsi_text=_number("rsi"),
        macd_signal_text=_number("macd_signal"), position_size="'2-5%'",
        stop_loss="'2-3%'", take_profit="'5-10%'") + " AS text FROM tx", *_LAB, _TX_ALL))
def render_chat_analysis(spark, sf):
    df = t.labelled(spark, sf, price_trend=True).drop("position_size", "stop_loss", "take_profit")
    df = df.withColumns({c: F.expr(e.format(c)) for c, e in _ALL_SHOWN.items()})
    return df.select(*KEY, texts.chat_analysis(df).alias("text"))


@query("render_instruction", S.hourly(
    "SELECT symbol, timestamp, " + _sql_text(
        tx.INSTRUCTION, instruction="'Assess ' || symbol", input="printf('close %.2f', close)",
        output="reasoning") + " AS text FROM tx", *_LAB, _TX))
def render_instruction(spark, sf):
    return _rows(spark, sf).select(*KEY, tx.render(tx.INSTRUCTION, {
        "instruction": F.concat(F.lit("Assess "), "symbol"),
        "input": F.format_string("close %.2f", "close"), "output": F.col("reasoning")})
        .alias("text"))


@query("dataset_rows", S.hourly(
    "SELECT " + _sql_text(tx.SFT_TEXT, tx.TEXT_DEFAULTS) + f""" AS text, symbol || '_' || pos AS sample_id,
    signal AS original_signal, {S.r('confidence', 'original_confidence')} FROM tx""", *_LAB, _TX))
def dataset_rows(spark, sf):
    return texts.dataset_rows(_rows(spark, sf), row_id=F.concat_ws("_", "symbol", "pos"))


_SYMBOLS = ("click", "error", "purchase", "signup", "view")


@query("render_live_prompt", S.with_(S.TICKS, S.bars(), S.POSITIONS, """b AS (SELECT symbol, 'Recent Price Bars:' || chr(10) || string_agg(
    'Time: ' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S') || ', Open: ' || open || ', High: ' || high || ', Low: ' || low
    || ', Close: ' || close || ', Volume: ' || volume || chr(10), '' ORDER BY timestamp) AS bars_text
    FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) AS r FROM bars) WHERE r <= 5 GROUP BY 1),
  h AS (SELECT account, 'Current Positions:' || chr(10) || string_agg('Symbol: ' || symbol || ', Qty: ' || qty
    || ', Side: long, P&L: ' || round(unrealized_plpc + 1e-9, 4) || chr(10), '' ORDER BY symbol) AS positions_text FROM positions GROUP BY 1),
  q AS (SELECT account, ['click', 'error', 'purchase', 'signup', 'view'][account % 5 + 1] AS symbol FROM (SELECT DISTINCT account FROM positions)),
  f AS (SELECT account, symbol, coalesce(bars_text, '') AS bars_text, positions_text, '2024-02-01T00:00:00' AS as_of FROM q LEFT JOIN b USING (symbol) JOIN h USING (account))""",
  select="SELECT account, symbol, " + _sql_text(tx.LIVE_PROMPT) + " AS prompt FROM f"))
def render_live_prompt(spark, sf):
    held = t.positions(spark, sf).withColumn(
        "unrealized_pl", F.round(F.col("unrealized_plpc") + 1e-9, 4))
    names = F.array(*[F.lit(s) for s in _SYMBOLS])
    requests = held.select("account").distinct().withColumn(
        "symbol", F.element_at(names, (F.col("account") % 5 + 1).cast("int")))
    return texts.live_prompts(requests, t.candles(spark, sf), held, "2024-02-01T00:00:00")


# --- decisions and steps -------------------------------------------------------------------------

_DECISIONS = f"""dec AS (SELECT *, symbol || '@' || CAST(epoch(timestamp) AS BIGINT) AS decision_id, {S.FEAR_GREED_SIMPLE} AS mood,
    {S.REASONING_SHORT} AS short, {S.CONFIDENCE_INDICATOR} AS indicator_conf,
    CASE WHEN rsi < 30 THEN 'oversold' WHEN rsi > 70 THEN 'overbought' ELSE 'neutral' END AS regime,
    change_1m / 100.0 AS outcome, CASE WHEN stop_pct IS NULL THEN 'null%' ELSE printf('%.1f%%', stop_pct) END AS stop_loss FROM lab),
  dec4 AS (SELECT *,
    'RSI is ' || regime || ' while MACD crossover is ' || CASE WHEN macd > macd_signal THEN 'bullish' ELSE 'bearish' END
      || '; trend ' || trend || ' with bollinger support. ' || reasoning AS c0,
    volatility_regime || ', volume ' || volume_regime || CASE WHEN volatility > 0.03 THEN ': low risk, small position, stop at '
      ELSE ': high risk, large position size, exit timing at ' END || stop_loss AS c1,
    'Sentiment shows ' || mood || '; news and market cycle: ' || trend AS c2,
    signal || ' with confidence because ' || lower(reasoning) || ' Risk target 3-5%' AS c3 FROM dec),
  steps AS (SELECT *, c0 AS content, 0 AS step_no, 'technical_analysis' AS step_type, coalesce(rsi / 100.0, 0.5) AS conf FROM dec4
    UNION ALL SELECT *, c1, 1, 'risk_assessment', coalesce(least(1.0, volatility * 2), 0.5) FROM dec4
    UNION ALL SELECT *, c2, 2, 'market_context', indicator_conf FROM dec4
    UNION ALL SELECT *, c3, 3, 'signal_generation', confidence FROM dec4)"""


def _has(*words: str) -> str:
    return "(" + " OR ".join(f"contains(lc, '{w}')" for w in words) + ")"


def _points(*groups) -> str:
    return " + ".join(f"CAST({_has(*g)} AS INT)" for g in groups)


_QUALITY = f"""q AS (SELECT *, lower(content) AS lc FROM steps),
  qq AS (SELECT *, least(1.0, CASE step_type
    WHEN 'technical_analysis' THEN {_points(*rw.QUALITY_WORDS[rw.TECHNICAL])}
      + CAST(regexp_matches(lc, 'rsi.*(overbought|oversold|neutral)|(overbought|oversold).*rsi|rsi.*(above|below).*[0-9]+|rsi.*(divergence|convergence)') AS INT)
      + CAST(regexp_matches(lc, 'macd.*cross|cross.*macd|macd.*(above|below).*zero|macd.*(divergence|convergence)') AS INT)
    WHEN 'risk_assessment' THEN {_points(*rw.QUALITY_WORDS[rw.RISK])}
    WHEN 'market_context' THEN {_points(*rw.QUALITY_WORDS[rw.CONTEXT])}
    ELSE {_points(*rw.QUALITY_WORDS[rw.SIGNAL])} END / 4.0) AS quality_score FROM q),
  ev AS (SELECT *, CASE step_type
    WHEN 'technical_analysis' THEN NOT (
      ({_has('rsi')} AND ((coalesce(rsi, 50) > 70 AND {_has('oversold')}) OR (coalesce(rsi, 50) < 30 AND {_has('overbought')})
        OR (coalesce(rsi, 50) BETWEEN 30 AND 70 AND {_has('overbought', 'oversold')})))
      OR ({_has('trend')} AND ((coalesce(change_24h, 0) > 0 AND {_has('bearish')}) OR (coalesce(change_24h, 0) < 0 AND {_has('bullish')}))))
    WHEN 'risk_assessment' THEN NOT ((coalesce(volatility, 0.02) > 0.05 AND {_has('low risk')})
      OR (coalesce(volatility, 0.02) < 0.01 AND {_has('high risk')}) OR (coalesce(volatility, 0.02) > 0.03 AND {_has('large position')})
      OR (coalesce(volatility, 0.02) < 0.01 AND {_has('small position')}))
    WHEN 'market_context' THEN NOT ((fear_greed = 'Extreme Fear' AND {_has('greed')}) OR (fear_greed = 'Extreme Greed' AND {_has('fear')}))
    ELSE outcome IS NULL OR CASE WHEN {_has('buy')} THEN outcome > 0 WHEN {_has('sell')} THEN outcome < 0 ELSE abs(outcome) < 0.01 END
    END AS correctness FROM qq),
  rewards AS (SELECT *,
    CASE WHEN correctness THEN 0.5 + CASE WHEN conf > 0.7 THEN 0.3 ELSE 0 END ELSE -0.2 + CASE WHEN conf < 0.3 THEN 0.1 ELSE 0 END END AS base_reward,
    CASE step_type
      WHEN 'technical_analysis' THEN 0.1 * ({_points(['rsi'], ['macd'], ['bollinger'], ['support', 'resistance'])})
      WHEN 'risk_assessment' THEN 0.1 * ({_points(['volatility'], ['stop', 'loss'], ['position', 'size'], ['timing'])})
      WHEN 'market_context' THEN 0.1 * ({_points(['sentiment'], ['news'], ['trend', 'cycle'], ['condition'])})
      ELSE 0.2 * CAST({_has('buy', 'sell', 'hold')} AS INT) + 0.1 * ({_points(['confidence'], ['reasoning', 'because'], ['risk'])}) END
      + 0.1 * quality_score AS step_reward,
    CASE WHEN outcome > 0.05 THEN 0.5 WHEN outcome < -0.05 THEN -0.3 WHEN abs(outcome) < 0.01 THEN 0.2 ELSE 0 END AS outcome_reward,
    concat_ws('; ', CASE WHEN correctness THEN '✓ Correct analysis' ELSE '✗ Incorrect analysis' END,
      CASE WHEN quality_score > 0.8 THEN 'High quality analysis' WHEN quality_score > 0.5 THEN 'Good analysis' ELSE 'Analysis needs improvement' END,
      CASE step_type WHEN 'technical_analysis' THEN CASE WHEN NOT {_has('rsi')} THEN 'Consider mentioning RSI analysis' END
        WHEN 'risk_assessment' THEN CASE WHEN NOT {_has('volatility')} THEN 'Consider volatility assessment' END
        WHEN 'market_context' THEN CASE WHEN NOT {_has('sentiment')} THEN 'Consider market sentiment' END
        ELSE CASE WHEN NOT {_has('buy', 'sell', 'hold')} THEN 'Provide clear trading signal' END END,
      CASE step_type WHEN 'technical_analysis' THEN CASE WHEN NOT {_has('trend')} THEN 'Include trend analysis' END
        WHEN 'risk_assessment' THEN CASE WHEN NOT {_has('position')} THEN 'Include position sizing' END
        WHEN 'market_context' THEN CASE WHEN NOT {_has('news')} THEN 'Include news analysis' END
        ELSE CASE WHEN NOT {_has('confidence')} THEN 'Include confidence level' END END) AS feedback FROM ev)"""
_STEPS = (*_LAB, _DECISIONS)
_REWARDS = (*_STEPS, _QUALITY)
_MARKET = ["symbol", "timestamp", "close", "volume", "change_24h", "rsi", "macd", "volatility",
           "fear_greed", "outcome"]


def _evaluated(spark, sf):
    steps = rw.explode_steps(t.decisions(spark, sf), "decision_id", *_MARKET)
    return rw.evaluate_steps(steps)


@query("explode_steps", S.hourly(f"SELECT decision_id, step_no, step_type, content, {S.r('conf', 'confidence')}, short AS reasoning, {S.r('close')} FROM steps", *_STEPS))
def explode_steps(spark, sf):
    return rw.explode_steps(t.decisions(spark, sf), "decision_id", "close")


@query("steps_market_data", S.hourly(f"SELECT decision_id, step_no, step_type, {S.r6('rsi', 'change_24h', 'volatility')}, fear_greed FROM steps", *_STEPS))
def steps_market_data(spark, sf):
    return rw.explode_steps(t.decisions(spark, sf), "decision_id", "rsi", "change_24h",
                            "volatility", "fear_greed").drop("content", "confidence", "reasoning")


def _reward_query(name: str, column: str, numeric: bool = True) -> None:
    shown = S.r(column) if numeric else column

    @query(name, S.hourly(f"SELECT decision_id, step_no, step_type, {shown} FROM rewards", *_REWARDS))
    def run(spark, sf):
        return _evaluated(spark, sf).select("decision_id", "step_no", "step_type", column)


_reward_query("step_quality", "quality_score")
_reward_query("step_correctness", "correctness", numeric=False)
_reward_query("step_base_reward", "base_reward")
_reward_query("step_specific_reward", "step_reward")
_reward_query("outcome_reward", "outcome_reward")
_reward_query("step_feedback", "feedback", numeric=False)


@query("evaluate_steps", S.hourly(f"""SELECT decision_id, step_no, step_type, content, {S.r('conf', 'confidence')}, {S.r('quality_score')},
  correctness, {S.r('base_reward + step_reward + outcome_reward', 'reward')}, feedback FROM rewards""", *_REWARDS))
def evaluate_steps(spark, sf):
    return _evaluated(spark, sf).select(
        "decision_id", "step_no", "step_type", "content", "confidence", "quality_score",
        "correctness", "reward", "feedback")


@query("reward_label", S.hourly(f"""SELECT decision_id, step_no, step_type, {S.r('''least(1.0, greatest(0.0,
  CASE WHEN correctness THEN 0.5 ELSE 0 END
  + CASE WHEN correctness AND conf > 0.7 THEN 0.2 WHEN NOT correctness AND conf < 0.3 THEN 0.1 ELSE 0 END
  + CASE WHEN step_type = 'signal_generation' AND outcome > 0 AND signal IN ('BUY', 'SELL') THEN 0.3
         WHEN step_type = 'signal_generation' AND outcome <= 0 AND signal = 'HOLD' THEN 0.2 ELSE 0 END
  + CASE WHEN step_type = 'technical_analysis' AND (contains(lc, 'rsi') OR contains(lc, 'macd') OR contains(lc, 'bollinger') OR contains(lc, 'support') OR contains(lc, 'resistance')) THEN 0.1
         WHEN step_type = 'risk_assessment' AND (contains(lc, 'volatility') OR contains(lc, 'stop loss') OR contains(lc, 'position size') OR contains(lc, 'risk')) THEN 0.1 ELSE 0 END))''', 'reward')}
  FROM rewards""", *_REWARDS))
def reward_label(spark, sf):
    """The signal step's content is the bare verdict here, as the label rule expects."""
    steps = _evaluated(spark, sf)
    verdict = F.when(F.col("step_type") == rw.SIGNAL, F.split("content", " ")[0]).otherwise(
        F.col("content"))
    return steps.select("decision_id", "step_no", "step_type", rw.reward_label(
        F.col("step_type"), verdict, F.col("correctness"), F.col("confidence"),
        F.col("outcome")).alias("reward"))


@query("step_accuracy", S.hourly(f"""SELECT step_type, {S.r('avg(CAST(correctness AS INT))', 'accuracy')},
  round((SELECT sum(base_reward + step_reward + outcome_reward) / count(DISTINCT decision_id) FROM rewards) + 1e-9, 6) AS average_reward
  FROM rewards GROUP BY 1""", *_REWARDS))
def step_accuracy(spark, sf):
    return rw.step_accuracy(_evaluated(spark, sf))


_TXD = "txd AS (SELECT * REPLACE (" + ", ".join(
    f"round({c} + 1e-9, 6) + 1e-7 AS {c}" for c in _SHOWN if c not in (
        "stoch_k", "williams_r", "atr", "sma_200", "volume_ratio", "macd_signal")) + ") FROM dec4)"
_PROMPTS = {"technical_prompt": tx.STEP_TECHNICAL, "risk_prompt": tx.STEP_RISK,
            "context_prompt": tx.STEP_CONTEXT, "signal_prompt": tx.STEP_SIGNAL}
_SUMMARY = ("'technical_analysis: ' || c0 || chr(10) || 'risk_assessment: ' || c1 || chr(10) || "
            "'market_context: ' || c2 || chr(10) || 'signal_generation: ' || c3")


def _decision_rows(spark, sf):
    df = t.decisions(spark, sf)
    return df.withColumns({c: F.round(F.col(c) + 1e-9, 6) + 1e-7 for c in _SHOWN
                           if c in df.columns})


@query("render_step_prompts", S.hourly("SELECT decision_id, " + ", ".join(
    f"CASE WHEN {_not_null(tpl, 'technical_analysis', 'risk_assessment', 'analysis_summary')} THEN "
    + _sql_text(tpl, technical_analysis="c0", risk_assessment="c1", analysis_summary=_SUMMARY)
    + f" END AS {name}" for name, tpl in _PROMPTS.items()) + " FROM txd", *_STEPS, _TXD))
def render_step_prompts(spark, sf):
    return texts.step_prompts(_decision_rows(spark, sf))


@query("render_step_scoring", S.hourly("SELECT decision_id, step_no, CASE WHEN rsi IS NOT NULL THEN " + _sql_text(
    tx.STEP_SCORING, reasoning="short", confidence="(round(conf + 1e-9, 6) + 1e-7)") + " END AS prompt FROM stx",
    *_STEPS, "stx AS (SELECT * REPLACE (" + ", ".join(
        f"round({c} + 1e-9, 6) + 1e-7 AS {c}" for c in ("close", "change_24h", "volume", "rsi", "macd"))
    + ") FROM steps)"))
def render_step_scoring(spark, sf):
    steps = rw.explode_steps(_decision_rows(spark, sf), "decision_id", *_MARKET[:8])
    return texts.step_scoring_prompts(steps.withColumn(
        "confidence", F.round(F.col("confidence") + 1e-9, 6) + 1e-7))


# --- parsing -------------------------------------------------------------------------------------

_RESPONSES = """resp AS (SELECT symbol, timestamp, 'SIGNAL: ' || signal || chr(10) || 'Confidence: ' || CAST(confidence * 2 AS VARCHAR)
  || chr(10) || 'reasoning: ' || reasoning || chr(10) || '  Based on ' || trend || ' trend ' || chr(10) || 'Held.' AS text FROM lab)"""


@query("parse_signal", S.hourly(r"""SELECT symbol, timestamp,
  CASE WHEN contains(lower(text), 'buy') THEN 'buy' WHEN contains(lower(text), 'sell') THEN 'sell' ELSE 'hold' END AS action,
  round(least(greatest(coalesce(TRY_CAST(nullif(regexp_extract(lower(text), 'confidence[:\s]*([0-9]*\.?[0-9]+)', 1), '') AS DOUBLE), 0.5), 0), 1) + 1e-9, 6) AS confidence,
  trim(substr(text, CASE WHEN strpos(text, 'reasoning') > 0 THEN strpos(text, 'reasoning') ELSE 1 END, 200), ' ' || chr(10)) AS reasoning FROM resp""",
  *_LAB, _RESPONSES))
def parse_signal(spark, sf):
    parsed = tx.parse_signal(F.col("text"))
    return t.responses(spark, sf).select(*KEY, *[c.alias(n) for n, c in parsed.items()])


@query("extract_reasoning", S.hourly(r"""SELECT symbol, timestamp, array_to_string(list_transform(list_filter(
  string_split(text, chr(10)), lambda x: regexp_matches(lower(x), 'reasoning|because|due to|based on')), lambda x: trim(x)), ' ') AS reasoning
  FROM resp""", *_LAB, _RESPONSES))
def extract_reasoning(spark, sf):
    return t.responses(spark, sf).select(*KEY, tx.extract_reasoning(F.col("text"))
                                         .alias("reasoning"))


@query("extract_signal", """SELECT doc_id, CASE WHEN contains(upper(text), 'BUY') THEN 'BUY'
  WHEN contains(upper(text), 'SELL') THEN 'SELL' ELSE 'HOLD' END AS signal FROM documents""")
def extract_signal(spark, sf):
    return t.read(spark, sf, "documents").select("doc_id", tx.extract_signal(F.col("text"))
                                                 .alias("signal"))


@query("token_count", f"SELECT doc_id, len(regexp_extract_all(text, '{S.TOKEN}')) AS tokens FROM documents")
def token_count(spark, sf):
    return t.read(spark, sf, "documents").select("doc_id", tx.token_count(F.col("text"))
                                                 .alias("tokens"))


@query("truncate_tokens", f"""SELECT doc_id, array_to_string(regexp_extract_all(text, '{S.TOKEN}')[:512], ' ') AS text FROM documents""")
def truncate_tokens(spark, sf):
    return t.read(spark, sf, "documents").select("doc_id", tx.truncate_tokens(F.col("text"), 512)
                                                 .alias("text"))


@query("json_roundtrip", S.with_(S.TRADES, select="SELECT trade_id, symbol, action, price, confidence FROM trades"))
def json_roundtrip(spark, sf):
    trades = t.trades(spark, sf).select("trade_id", "symbol", "action", "price", "confidence")
    row = F.from_json(F.to_json(F.struct(*trades.columns)), T.StructType(trades.schema.fields))
    return trades.select(row.alias("_r")).select("_r.*")


# --- memory sentences ----------------------------------------------------------------------------

@query("memory_text", S.with_(
    S.TICKS, S.bars(), S.panel(), *_LAB, _TX, S.TRADES, """ses AS (SELECT account, count(*) AS n,
      count(*) FILTER (pnl > 0) / count(*) AS wr, sum(pnl) AS p, epoch(max(timestamp) - min(timestamp)) / 3600.0 AS h FROM trades GROUP BY 1)""",
    select="""SELECT 'market_data' AS kind, symbol || '/' || pos AS id, 'Market data for ' || symbol || ': Price: $' || printf('%.2f', close)
      || ', Change: ' || printf('%+.2f', change_24h) || '%, Volume: ' || format('{:,}', CAST(round(volume) AS BIGINT)) AS text FROM tx
    UNION ALL SELECT 'analysis', symbol || '/' || pos, 'Analysis: ' || signal || ' signal with ' || printf('%.2f', confidence)
      || ' confidence. Reasoning: ' || reasoning FROM tx
    UNION ALL SELECT 'trade_decision', CAST(trade_id AS VARCHAR), 'Trade decision: ' || action || ' ' || symbol || ' at $' || printf('%.2f', price) || ' with 1 units' FROM trades
    UNION ALL SELECT 'trade_result', CAST(trade_id AS VARCHAR), 'Trade result: ' || status || ' - P&L: $' || printf('%.2f', pnl + 1e-7)
      || ' (' || printf('%+.2f', pnl + 1e-7) || '%)' || CASE action WHEN 'hold' THEN '' ELSE ' Lessons: ' || reasoning END FROM trades
    UNION ALL SELECT 'session_summary', CAST(account AS VARCHAR), 'Trading session summary: ' || n || ' trades, ' || printf('%.1f', wr * 100 + 1e-7)
      || '% win rate, $' || printf('%.2f', p + 1e-7) || ' P&L, Duration: ' || printf('%.1f', h + 1e-7) || ' hours' FROM ses"""))
def memory_text(spark, sf):
    rows, trades = _rows(spark, sf), t.trades(spark, sf)
    rows = rows.withColumn("id", F.concat_ws("/", "symbol", "pos"))
    trades = trades.withColumns({
        "id": F.col("trade_id").cast("string"), "quantity": F.lit(1),
        "pnl": F.col("pnl") + 1e-7,
        "lessons_learned": F.when(F.col("action") != "hold", F.col("reasoning"))})
    sessions = perf.session_metrics(t.trades(spark, sf).withColumnRenamed("account", "session"),
                                    "session").withColumns({
        "id": F.col("session").cast("string"), "win_rate": F.col("win_rate") + 1e-9,
        "total_pnl": F.col("total_pnl") + 1e-7,
        "session_duration_hours": F.col("session_duration_hours") + 1e-7})
    parts = [(rows, "market_data", tx.market_memory()), (rows, "analysis", tx.analysis_memory()),
             (trades, "trade_decision", tx.decision_memory()),
             (trades, "trade_result", tx.result_memory()),
             (sessions, "session_summary", tx.session_memory())]
    out = None
    for df, kind, text in parts:
        part = df.select(F.lit(kind).alias("kind"), "id", text.alias("text"))
        out = part if out is None else out.unionByName(part)
    return out
