"""Schemas of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


D, S, I, L, TS = T.DoubleType(), T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()

CANDLES = _struct(timestamp=TS, open=D, high=D, low=D, close=D, volume=D, product_id=S)
CANDLE_ARRAYS = _struct(product_id=S, c=T.ArrayType(D))
BARS = _struct(timestamp=TS, symbol=S, open=D, high=D, low=D, close=D, volume=D,
               trade_count=L, vwap=D)
QUOTES = _struct(timestamp=TS, symbol=S, bid_price=D, ask_price=D, bid_size=D, ask_size=D)
TRADES = _struct(timestamp=TS, symbol=S, price=D, size=D, trade_id=L)
EVENT_LOG = _struct(timestamp=S, type=S, data=S)
POSITIONS = _struct(symbol=S, qty=D, side=S, market_value=D, cost_basis=D, unrealized_pl=D,
                    unrealized_plpc=D)
ACCOUNT = _struct(account_id=S, equity=D, cash=D, buying_power=D, portfolio_value=D,
                  trading_blocked=T.BooleanType(), pattern_day_trader=T.BooleanType())
ORDERS = _struct(id=S, symbol=S, side=S, qty=D, filled_qty=D, order_type=S, status=S,
                 created_at=TS, filled_at=TS, limit_price=D)
MEMORY_ITEMS = _struct(id=S, agent_id=S, content=S, memory_type=S, timestamp=TS, importance=D,
                       tags=T.ArrayType(S), metadata=T.MapType(S, S), token_count=I,
                       embedding=T.ArrayType(T.FloatType()))
AGENTS = _struct(agent_id=S, agent_type=S, created_at=TS, last_active=TS, total_tokens_used=L,
                 context_tokens=I, memory_items=T.ArrayType(S),
                 performance_metrics=T.MapType(S, D), is_active=T.BooleanType())

PRICE_FIELDS = ("open high low close volume change_1m change_5m change_15m change_1h change_4h "
                "change_24h").split()
INDICATOR_FIELDS = (
    "rsi macd macd_signal macd_histogram sma_5 sma_10 sma_20 sma_50 sma_100 sma_200 ema_5 ema_10 "
    "ema_20 ema_50 ema_100 ema_200 bb_position bb_width bb_upper bb_middle bb_lower stoch_k "
    "stoch_d williams_r volume_ratio volume_price_trend volatility atr").split()
FLAG_FIELDS = "doji hammer shooting_star trend_short trend_medium trend_long".split()
DISTANCE_FIELDS = "price_vs_resistance price_vs_support".split()

SAMPLE = _struct(
    symbol=S, timestamp=S,
    price_data=_struct(**{f: D for f in PRICE_FIELDS}),
    technical_indicators=_struct(**{f: D for f in INDICATOR_FIELDS}, **{f: I for f in FLAG_FIELDS},
                                 **{f: D for f in DISTANCE_FIELDS}),
    market_context=_struct(
        market_cap=D, fear_greed=S, trend=S, volatility_regime=S, volume_regime=S,
        price_momentum=_struct(short_term=D, medium_term=D, long_term=D, acceleration=D,
                               strength=D),
        support_resistance=_struct(resistance_1=D, resistance_2=D, support_1=D, support_2=D,
                                   pivot=D, distance_to_resistance=D, distance_to_support=D),
        market_structure=_struct(trend_strength=D, momentum_direction=S, volatility_level=S,
                                 rsi_regime=S, bb_regime=S, confluence_score=D)),
    signal=S, confidence=D, reasoning=S, position_size=S, stop_loss=S, take_profit=S)
REQUIRED_SAMPLE_KEYS = ("symbol signal confidence reasoning price_data technical_indicators "
                        "market_context").split()
