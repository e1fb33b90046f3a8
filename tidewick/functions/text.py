"""Text rendering and parsing as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tidewick.functions.numeric import ladder

_SLOT = re.compile(r"\{(\w+):(%[^}]*)\}")

# The characters str.split() treats as white space are Unicode white space and the four
# information separators. The Unicode flag keeps the class one cheap test per character.
WHITESPACE = r"\s\x1C-\x1F"
_TOKEN = f"(?U)[^{WHITESPACE}]+"

# The text templates. ``{name:format}`` slots take printf formats.
_HEAD = "Analyze the following cryptocurrency market data and provide a trading signal:\n\n"
_TAIL = "\n\nBased on this analysis, provide your trading recommendation:"
_VERDICT = "\nSIGNAL: {signal:%s}\nCONFIDENCE: {confidence:%.2f}\nREASONING: {reasoning:%s}"
_FORMAT_LINES = ("Respond EXACTLY in this format:\nSIGNAL: <BUY|SELL|HOLD>\n"
                 "CONFIDENCE: <0.00-1.00>\nREASONING: <1-3 concise sentences>.")

SFT_TEXT = (
    _HEAD + "PRICE DATA:\n- Symbol: {symbol:%s}\n- Close: ${close:%.2f}\n- Volume: {volume:%.0f}\n"
    "- Change 24h: {change_24h:%+.2f}%%\n\nTECHNICAL INDICATORS:\n- RSI: {rsi:%.1f}\n"
    "- MACD: {macd:%.3f}\n- MACD Signal: {macd_signal:%.3f}\n"
    "- Bollinger Position: {bb_position:%.2f}\n- Volume Ratio: {volume_ratio:%.2f}\n\n"
    "MARKET CONTEXT:\n- Market Cap: ${market_cap:%.0f}\n- Fear & Greed: {fear_greed:%s}\n"
    "- Trend: {trend:%s}" + _TAIL + _VERDICT + "\n\n" + _FORMAT_LINES + "\n")
SFT_TEXT_FULL = (
    _HEAD + "PRICE DATA:\n- Symbol: {symbol:%s}\n- Close: ${close:%.2f}\n- Volume: {volume:%.0f}\n"
    "- High: ${high:%.2f}\n- Low: ${low:%.2f}\n\nTECHNICAL INDICATORS:\n- RSI: {rsi:%.1f}\n"
    "- MACD: {macd:%.3f}\n- MACD Signal: {macd_signal:%.3f}\n"
    "- Bollinger Position: {bb_position:%.2f}\n- Stochastic K: {stoch_k:%.1f}\n"
    "- Williams %%R: {williams_r:%.1f}\n- Volume Ratio: {volume_ratio:%.2f}\n\n"
    "MARKET CONTEXT:\n- Market Cap: ${market_cap:%.0f}\n- Fear & Greed: {fear_greed:%s}\n"
    "- Trend: {trend:%s}\n- Volatility: {volatility_regime:%s}\n"
    "- Volume Regime: {volume_regime:%s}" + _TAIL + _VERDICT
    + "\nPOSITION SIZE: {position_size:%s}\nSTOP LOSS: {stop_loss:%s}\n"
    "TAKE PROFIT: {take_profit:%s}")
SFT_TEXT_MID = (
    _HEAD + "PRICE DATA:\n- Symbol: {symbol:%s}\n- Close: ${close:%.2f}\n- Volume: {volume:%.0f}\n"
    "- High: ${high:%.2f}\n- Low: ${low:%.2f}\n\nTECHNICAL INDICATORS:\n- RSI: {rsi:%.1f}\n"
    "- MACD: {macd:%.3f}\n- MACD Signal: {macd_signal:%.3f}\n"
    "- Bollinger Position: {bb_position:%.2f}\n\nMARKET CONTEXT:\n"
    "- Market Cap: ${market_cap:%.0f}\n- Trend: {trend:%s}" + _TAIL + _VERDICT + "\n"
    + _FORMAT_LINES)
SFT_TEXT_COMPACT = (
    "<|im_start|>system\nAnalyze BTC market data and provide trading signal.<|im_end|>\n"
    "<|im_start|>user\nPrice: ${close:%.2f}, RSI:{rsi:%.1f} MACD:{macd:%.2f} "
    "BB:{bb_position:%.2f}, Market: {trend:%s} {volatility_regime:%s}<|im_end|>\n"
    "<|im_start|>assistant\nSignal: {signal:%s}, Confidence: {confidence:%s}, "
    "Reasoning: {reasoning:%s}<|im_end|>")
CHAT_ANALYSIS = (
    "<|im_start|>system\nYou are an expert cryptocurrency trading analyst. Analyze the given market "
    "data and provide trading signals with clear reasoning.\n\n<|im_start|>user\n"
    "Analyze this {symbol:%s} trading data:\n\nCurrent Price: ${close:%.2f}\n"
    "24h Change: {change_24h:%.2f}%%\nVolume: {volume:%,.0f}\n\nTechnical Indicators:\n"
    "{indicator_lines:%s}\n\nMarket Context:\n- Market Cap: ${market_cap:%,.0f}\n"
    "- Fear & Greed Index: {fear_greed:%s}\n- Market Trend: {trend:%s}\n\n\n"
    "What trading action should I take and why?<|im_end|>\n\n<|im_start|>assistant\n"
    "Based on my analysis of the {symbol:%s} market data:\n\n**Trading Signal: {signal:%s}**\n\n"
    "**Reasoning:**\n{reasoning:%s}\n\n**Key Factors:**\n"
    "- Price Action: {close:%.2f} ({change_24h:%+.2f}%%)\n"
    "- Technical Analysis: {rsi_text:%s} RSI, {macd_signal_text:%s} MACD\n"
    "- Market Sentiment: {fear_greed:%s} ({trend:%s} trend)\n\n**Risk Assessment:**\n"
    "- Position Size: {position_size:%s} of portfolio\n- Stop Loss: {stop_loss:%s} below entry\n"
    "- Take Profit: {take_profit:%s} above entry\n\nThis analysis is based on current market "
    "conditions and technical indicators. Always consider your risk tolerance and portfolio "
    "allocation before trading.<|im_end|>")
INSTRUCTION = (
    "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nYou are an expert "
    "cryptocurrency trading agent. Analyze market data and provide trading signals with clear "
    "reasoning.\n\n<|eot_id|><|start_header_id|>user<|end_header_id|>\n\n{instruction:%s}\n\n"
    "Market Data:\n{input:%s}\n\n<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"
    "{output:%s}<|eot_id|>")
LIVE_PROMPT = (
    "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nYou are an expert "
    "cryptocurrency trading agent. Analyze the provided market data and generate a trading signal "
    "with clear reasoning.\n\nTrading Rules:\n- Only trade BTC/USD, ETH/USD, or SOL/USD\n"
    "- Maximum position size: 10%% of portfolio\n- Consider risk management and market "
    "volatility\n- Provide clear reasoning for your decision\n\n"
    "<|eot_id|><|start_header_id|>user<|end_header_id|>\n\n"
    "Analyze the following market data for {symbol:%s} and provide a trading signal:\n\n"
    "{bars_text:%s}\n\n{positions_text:%s}\n\nCurrent Market Context:\n- Symbol: {symbol:%s}\n"
    "- Analysis Time: {as_of:%s}\n\nPlease provide:\n1. Trading action (buy/sell/hold)\n"
    "2. Confidence level (0-1)\n3. Reasoning for the decision\n4. Risk assessment\n\n"
    "<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n")
_STEP_DATA = ("Price: ${close:%.2f} ({change_24h:%+.2f}%%)\nVolume: {volume:%,.0f}\n"
              "RSI: {rsi:%.1f}\nMACD: {macd:%.2f}\n")
STEP_SCORING = (
    "<|im_start|>system\nYou are an expert cryptocurrency trading analyst. Analyze the given market "
    "data step by step.\n\n<|im_start|>user\nAnalyze this {symbol:%s} trading data:\n\n"
    + _STEP_DATA + "\nCurrent step: {step_type:%s}\n<|im_end|>\n\n<|im_start|>assistant\n"
    "{content:%s}\n\nReasoning: {reasoning:%s}\nConfidence: {confidence:%.2f}\n<|im_end|>")
STEP_TECHNICAL = (
    "<|im_start|>system\nYou are a technical analysis expert. Analyze the given crypto market data "
    "and provide detailed technical analysis.\n\n<|im_start|>user\n"
    "Analyze the technical indicators for {symbol:%s}:\n\n" + _STEP_DATA
    + "Bollinger Position: {bb_position:%.2f}\n\nProvide detailed technical analysis focusing on:\n"
    "1. Trend analysis\n2. Momentum indicators\n3. Support and resistance levels\n"
    "4. Volume analysis\n<|im_end|>\n\n<|im_start|>assistant\n")
STEP_RISK = (
    "<|im_start|>system\nYou are a risk management expert. Assess the trading risks based on the "
    "technical analysis.\n\n<|im_start|>user\nBased on this technical analysis:\n"
    "{technical_analysis:%s}\n\nAssess the risks for trading {symbol:%s}:\n\n"
    "Current volatility: {volatility:%.3f}\n24h range: ${low:%.2f} - ${high:%.2f}\n\n"
    "Provide risk assessment covering:\n1. Volatility risks\n2. Position sizing recommendations\n"
    "3. Stop loss levels\n4. Market timing risks\n<|im_end|>\n\n<|im_start|>assistant\n")
STEP_CONTEXT = (
    "<|im_start|>system\nYou are a market sentiment analyst. Analyze the broader market context and "
    "sentiment.\n\n<|im_start|>user\nBased on this analysis:\nTechnical: {technical_analysis:%s}\n"
    "Risk: {risk_assessment:%s}\n\nAnalyze the market context for {symbol:%s}:\n\n"
    "Market cap: ${market_cap:%,.0f}\nFear & Greed: {fear_greed:%s}\nTrend: {trend:%s}\n\n"
    "Provide market context analysis covering:\n1. Market sentiment\n2. Broader market trends\n"
    "3. News and events impact\n4. Seasonal factors\n<|im_end|>\n\n<|im_start|>assistant\n")
STEP_SIGNAL = (
    "<|im_start|>system\nYou are a trading decision maker. Synthesize all analysis into a final "
    "trading decision.\n\n<|im_start|>user\nBased on this comprehensive analysis:\n"
    "{analysis_summary:%s}\n\nMake a final trading decision for {symbol:%s}:\n\n"
    "Current price: ${close:%.2f}\n\nProvide:\n1. Trading signal (BUY/SELL/HOLD)\n"
    "2. Confidence level (0-1)\n3. Detailed reasoning\n4. Position size recommendation\n"
    "5. Stop loss and take profit levels\n<|im_end|>\n\n<|im_start|>assistant\n")

# What a renderer prints for a missing field.
TEXT_DEFAULTS = {
    "symbol": "UNKNOWN", "close": 0.0, "volume": 0.0, "change_24h": 0.0, "rsi": 50.0, "macd": 0.0,
    "macd_signal": 0.0, "bb_position": 0.5, "volume_ratio": 1.0, "market_cap": 0.0,
    "fear_greed": "Neutral", "trend": "Sideways", "signal": "HOLD", "confidence": 0.5,
    "reasoning": "No reasoning provided"}
CHAT_DEFAULTS = {"position_size": "2-5%", "stop_loss": "2-3%", "take_profit": "5-10%"}


def render(template: str, columns: dict[str, Column] | None = None,
           defaults: dict[str, object] | None = None) -> Column:
    """Fill a template's slots from columns of the same name (or the given ones).

    NULL when a slot without a default is missing.
    """
    columns, defaults = columns or {}, defaults or {}

    def value(name: str) -> Column:
        col = columns.get(name, F.col(name))
        return F.coalesce(col, F.lit(defaults[name])) if name in defaults else col

    slots = [value(name) for name, _ in _SLOT.findall(template)]
    present = F.lit(True)
    for slot in slots:
        present = present & slot.isNotNull()
    return F.when(present, F.format_string(_SLOT.sub(lambda m: m[2], template), *slots))


def indicator_lines(fields: dict[str, str]) -> Column:
    """``- name: value`` per indicator in the given order (name -> printf format).

    A NULL indicator has no line.
    """
    return F.concat_ws("\n", *[
        F.when(F.col(x).isNotNull(), F.format_string(f"- {x}: {fmt}", F.col(x)))
        for x, fmt in fields.items()])


def number_text(x: Column) -> Column:
    """A double in plain notation, up to twelve decimals, without trailing zeros."""
    return F.regexp_replace(x.cast("decimal(38,12)").cast("string"), r"(\.[0-9]+?)0+$", "$1")


def token_count(text: Column) -> Column:
    """White-space separated tokens, 0 for a blank text."""
    return F.regexp_count(text, F.lit(_TOKEN))


def truncate_tokens(text: Column, limit: int) -> Column:
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    return F.array_join(F.slice(tokens, 1, limit), " ")


def extract_signal(text: Column) -> Column:
    up = F.upper(text)
    return ladder([(up.contains("BUY"), "BUY"), (up.contains("SELL"), "SELL")], "HOLD")


# The pattern for a stated confidence, and the words that mark a reasoning line.
CONFIDENCE_PATTERN = r"confidence[:\s]*([0-9]*\.?[0-9]+)"
REASONING_WORDS = ("reasoning", "because", "due to", "based on")
REASONING_CHARS = 200


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")


def parse_signal(text: Column) -> dict[str, Column]:
    """action / confidence / reasoning of one response (response only, without its prompt)."""
    low = F.lower(text)
    found = F.regexp_extract(low, CONFIDENCE_PATTERN, 1)
    conf = F.coalesce(F.when(found != "", found.cast("double")), F.lit(0.5))
    at = F.instr(text, "reasoning")
    start = F.when(at > 0, at).otherwise(1)
    return {
        "action": ladder([(low.contains("buy"), "buy"), (low.contains("sell"), "sell")], "hold"),
        "confidence": F.least(F.greatest(conf, F.lit(0.0)), F.lit(1.0)),
        "reasoning": strip(F.substring(text, start, F.lit(REASONING_CHARS))),
    }


def extract_reasoning(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.lower(line).rlike(
        "|".join(REASONING_WORDS)))
    return F.when(F.size(lines) > 0, F.array_join(F.transform(lines, strip), " ")).otherwise(
        F.substring(text, 1, REASONING_CHARS))


# --- memory sentences ----------------------------------------------------------------------------

def market_memory() -> Column:
    return F.format_string("Market data for %s: Price: $%.2f, Change: %+.2f%%, Volume: %,.0f",
                           F.coalesce("symbol", F.lit("unknown")), *[
                               F.coalesce(x, F.lit(0.0)) for x in ("close", "change_24h",
                                                                   "volume")])


def analysis_memory() -> Column:
    return F.format_string("Analysis: %s signal with %.2f confidence. Reasoning: %s",
                           F.coalesce("signal", F.lit("HOLD")),
                           F.coalesce("confidence", F.lit(0.0)),
                           F.coalesce("reasoning", F.lit("No reasoning provided")))


def decision_memory() -> Column:
    return F.format_string("Trade decision: %s %s at $%.2f with %s units",
                           F.coalesce("action", F.lit("HOLD")),
                           F.coalesce("symbol", F.lit("unknown")),
                           F.coalesce("price", F.lit(0.0)),
                           F.coalesce(F.col("quantity").cast("string"), F.lit("0")))


def result_memory() -> Column:
    pnl = F.coalesce("pnl", F.lit(0.0))
    text = F.format_string("Trade result: %s - P&L: $%.2f (%+.2f%%)",
                           F.coalesce("status", F.lit("unknown")), pnl, pnl)
    lessons = F.when(F.coalesce("lessons_learned", F.lit("")) != "",
                     F.concat(F.lit(" Lessons: "), "lessons_learned")).otherwise("")
    return F.concat(text, lessons)


def session_memory() -> Column:
    return F.format_string(
        "Trading session summary: %d trades, %.1f%% win rate, $%.2f P&L, Duration: %.1f hours",
        F.col("total_trades"), F.col("win_rate") * 100, F.col("total_pnl"),
        F.col("session_duration_hours"))


def performance_text(metrics: Column) -> Column:
    """``metrics`` is a map<string,double>; absent keys are left out."""
    def part(fmt: str, key: str, scale: float = 1.0) -> Column:
        v = F.try_element_at(metrics, F.lit(key))
        return F.when(v.isNotNull(), F.format_string(fmt, v * scale))

    trades = F.try_element_at(metrics, F.lit("total_trades"))
    text = F.concat_ws(
        ", ",
        F.when(trades.isNotNull(), F.concat(F.lit("Total trades: "),
                                            trades.cast("bigint").cast("string"))),
        part("Win rate: %.1f%%", "win_rate", 100.0), part("Total P&L: $%.2f", "total_pnl"),
        part("Avg confidence: %.2f", "avg_confidence"))
    return F.when(text == "", "No performance data available").otherwise(text)


def parent_insight_text(metrics: Column) -> Column:
    """Sentence handed to a successor agent; NULL when no metric is positive."""
    def part(fmt: str, key: str, scale: float = 1.0) -> Column:
        v = F.try_element_at(metrics, F.lit(key))
        return F.when(v > 0, F.format_string(fmt, v * scale))

    text = F.concat_ws(
        "; ", part("Parent agent achieved %.1f%% win rate", "win_rate", 100.0),
        part("Parent agent generated $%.2f profit", "total_pnl"),
        part("Parent agent average confidence: %.2f", "avg_confidence"),
        part("Parent agent max drawdown: %.1f%%", "max_drawdown", 100.0))
    return F.when(text != "", F.concat(F.lit("Performance insights from parent agent: "), text))
