"""Labelled samples: sampling positions, nesting, caps and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewick import schemas
from tidewick.functions import rules
from tidewick.operators.series import day_of, global_positions, number_rows


def sample_every_n(panel: DataFrame, step: int = 240, start: int = 200) -> DataFrame:
    """Positions start, start+step, ... with the critical indicators present."""
    return panel.filter(
        (F.col("pos") >= start) & ((F.col("pos") - start) % step == 0)
        & F.col("rsi").isNotNull() & F.col("macd").isNotNull() & F.col("bb_position").isNotNull())


def label_samples(panel: DataFrame, variant: str = "advanced") -> DataFrame:
    """Flat labelled rows. ``advanced`` carries scored confidence, ``chunk`` the indicator one."""
    chunk = variant == "chunk"
    df = rules.with_signal_advanced(panel)
    if chunk:
        df = df.withColumns({"confidence": rules.confidence_indicator(),
                             "reasoning": rules.reasoning_short()})
    sized_by = F.col("confidence") if chunk else F.lit(0.5)
    return df.withColumns({
        "market_cap": rules.market_cap(F.col("symbol"), F.col("close"),
                                       "short" if chunk else "full"),
        "fear_greed": rules.fear_greed_simple() if chunk else rules.fear_greed_score(),
        "trend": rules.trend_simple() if chunk else rules.trend_flags_label(),
        "volatility_regime": rules.volatility_regime(),
        "volume_regime": rules.volume_regime(),
        "price_momentum": rules.price_momentum(),
        "support_resistance": rules.support_resistance_levels("bands" if chunk else "percent"),
        "market_structure": rules.market_structure(),
        "position_size": rules.position_size_label(sized_by),
        "stop_loss": rules.stop_loss_label(),
        "take_profit": rules.take_profit_label(sized_by),
    })


def build_sample(labelled: DataFrame) -> DataFrame:
    """Nest labelled rows into price_data / technical_indicators / market_context."""
    present = set(labelled.columns)

    def group(name: str) -> Column:
        fields = schemas.SAMPLE[name].dataType.fieldNames()
        return F.struct(*[f for f in fields if f in present]).alias(name)

    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")
    return labelled.select(
        "symbol", stamp, group("price_data"), group("technical_indicators"),
        group("market_context"), "signal", "confidence", "reasoning", "position_size",
        "stop_loss", "take_profit")


def flatten_nested(df: DataFrame, sep: str = "_") -> DataFrame:
    """Structs become parent_child columns at every depth; arrays and maps stay."""
    from pyspark.sql.types import StructType

    def leaves(schema: StructType, path: tuple[str, ...] = ()):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, StructType):
                yield from leaves(field.dataType, here)
            else:
                yield here

    return df.select([F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path))
                      for path in leaves(df.schema)])


def cap_per_symbol(samples: DataFrame, limit: int = 5000, *, time: str = "timestamp") -> DataFrame:
    """First ``limit`` rows per symbol. Uses bucketed positions: no symbol-wide window."""
    numbered = number_rows(samples, ["symbol"], [time], bucket=day_of(time), name="_n")
    return numbered.filter(F.col("_n") < limit).drop("_n")


def positional_split(samples: DataFrame, test: float = 0.1, *,
                     time: str = "timestamp") -> DataFrame:
    """Adds ``split``: the first int(total x (1-test)) rows in (symbol, time) order are train."""
    ordered = global_positions(samples, ["symbol", time], name="_n")
    cut = F.floor(F.col("_total") * (1.0 - test))
    return ordered.withColumn("split", F.when(F.col("_n") < cut, "train").otherwise("test")).drop(
        "_n", "_total")


def peek_positions(samples: DataFrame, positions=(0, 50, 100), *,
                   time: str = "timestamp") -> DataFrame:
    ordered = global_positions(samples, ["symbol", time], name="sample_pos")
    return ordered.filter(F.col("sample_pos").isin(*positions)).drop("_total")


def samples_to_decisions(samples: DataFrame, n: int | None, *,
                         time: str = "timestamp") -> DataFrame:
    """Nested samples to decision rows (market data, final verdict, no steps yet).

    ``n`` keeps the first n in (symbol, time) order; None keeps all.
    """
    if n is not None:
        samples = samples.orderBy("symbol", time).limit(n)
    steps = F.lit(None).cast(
        "array<struct<step_type:string,content:string,confidence:double,reasoning:string>>")
    return samples.select(
        "symbol", time, F.col("price_data").alias("market_data"), steps.alias("steps"),
        F.col("signal").alias("final_signal"), F.col("confidence").alias("final_confidence"),
        F.col("reasoning").alias("final_reasoning"), F.lit(None).cast("double")
        .alias("actual_outcome"))


def market_cap_join(bars: DataFrame, supply: DataFrame) -> DataFrame:
    """``supply`` is a (symbol, multiplier) dimension; the planner sizes the join itself."""
    mult = F.coalesce(F.col("multiplier"), F.lit(float(rules.SUPPLY_DEFAULT)))
    return (bars.join(supply, "symbol", "left").withColumn("market_cap", F.col("close") * mult)
            .drop("multiplier"))
