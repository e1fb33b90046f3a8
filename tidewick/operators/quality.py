"""Cleaning, checking and narrowing candle and sample tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

CANDLE_COLUMNS = ("timestamp", "open", "high", "low", "close", "volume")


def require_columns(df: DataFrame, required: Sequence[str] = CANDLE_COLUMNS) -> DataFrame:
    missing = [x for x in required if x not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def dropna_any(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def bad_ohlc() -> Column:
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    return (h < l) | (h < o) | (h < c) | (l > o) | (l > c)


def valid_ohlc(df: DataFrame) -> DataFrame:
    return df.filter(~bad_ohlc())


def valid_volume(df: DataFrame) -> DataFrame:
    return df.filter(F.col("volume") >= 0)


def rejected_counts(df: DataFrame, key: str) -> DataFrame:
    """How many rows the two filters drop, in the order they run."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(bad_ohlc()).alias("invalid_ohlc"),
        F.count_if(~bad_ohlc() & (F.col("volume") < 0)).alias("invalid_volume"))


def tidy_series(df: DataFrame, key: str, time: str, arrival: str) -> DataFrame:
    """One row per (key, time), the first to arrive (``arrival`` unique per stamp).

    A hash aggregation that reduces copies before the shuffle, so a stamp delivered very many times
    is not gathered in one task.
    """
    rest = [x for x in df.columns if x not in (key, time)]
    return df.groupBy(key, time).agg(*[F.min_by(x, arrival).alias(x) for x in rest])


def sort_combined(df: DataFrame, *order: str) -> DataFrame:
    return df.orderBy(*order)


def union_assets(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


# --- types ---------------------------------------------------------------------------------------

_INTS = [("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64)]
_FLOAT_MAX = 3.4028234663852886e38


def _numeric(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def infer_narrow_schema(df: DataFrame) -> DataFrame:
    """(column, current_type, narrow_type) per column from one pass of whole-column bounds."""
    nums = _numeric(df)
    bounds = df.agg(F.count(F.lit(1)).alias("_n"), *[
        f(x.name).cast("double" if isinstance(x.dataType, T.FractionalType) else "bigint")
        .alias(f"{tag}{i}") for i, x in enumerate(nums) for tag, f in (("lo", F.min),
                                                                      ("hi", F.max))])
    position = {x.name: i for i, x in enumerate(nums)}

    def proposal(field: T.StructField) -> Column:
        current = field.dataType.simpleString()
        narrow = F.lit(current)
        if field.name in position:
            lo, hi = F.col(f"lo{position[field.name]}"), F.col(f"hi{position[field.name]}")
            if isinstance(field.dataType, T.FractionalType):
                fits = F.abs(lo).between(0, _FLOAT_MAX) & F.abs(hi).between(0, _FLOAT_MAX)
                narrow = F.when(fits, "float").otherwise(current)
            else:
                narrow = F.lit(current)
                for name, bits in reversed(_INTS):
                    inside = (lo >= -(2 ** (bits - 1))) & (hi <= 2 ** (bits - 1) - 1)
                    narrow = F.when(inside, name).otherwise(narrow)
        return F.struct(F.lit(field.name).alias("column"), F.lit(current).alias("current_type"),
                        narrow.alias("narrow_type"))

    return bounds.select(F.explode(F.array(*[proposal(f) for f in df.schema.fields]))
                         .alias("_p")).select("_p.*")


def narrow_types(df: DataFrame, proposal: DataFrame | None = None) -> DataFrame:
    """Cast numeric columns to the proposed types. The proposal has one row per column."""
    plan = {r["column"]: r["narrow_type"] for r in (proposal or infer_narrow_schema(df)).collect()}
    return df.select(*[F.col(f.name).cast(plan[f.name]).alias(f.name)
                       if isinstance(f.dataType, T.NumericType) else F.col(f.name)
                       for f in df.schema.fields])


def numeric_string_columns(df: DataFrame) -> DataFrame:
    """(column, values, parsed, numeric): numeric when every present value of a string parses."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counts = df.agg(*[e for i, x in enumerate(names) for e in (
        F.count(x).alias(f"n{i}"), F.count(F.col(x).try_cast("double")).alias(f"p{i}"))])
    return counts.select(F.explode(F.array(*[F.struct(
        F.lit(x).alias("column"), F.col(f"n{i}").alias("values"), F.col(f"p{i}").alias("parsed"),
        ((F.col(f"n{i}") == F.col(f"p{i}")) & (F.col(f"n{i}") > 0)).alias("numeric"))
        for i, x in enumerate(names)])).alias("_c")).select("_c.*")


def coerce_numeric_strings(df: DataFrame) -> DataFrame:
    numeric = {r["column"] for r in numeric_string_columns(df).filter("numeric").collect()}
    return df.withColumns({x: F.col(x).try_cast("double") for x in numeric}) if numeric else df


def low_cardinality_columns(df: DataFrame, share: float = 0.5, *, exact: bool = False
                            ) -> DataFrame:
    """(column, rows, distinct, low_cardinality) per string column.

    One approximate pass by default; ``exact`` counts go over md5 digests, so that long texts are not
    shuffled, but every row meets the shuffle once for each column.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]

    def count(x: str) -> Column:
        return F.count_distinct(F.md5(x)) if exact else F.approx_count_distinct(x)

    counts = df.agg(F.count(F.lit(1)).alias("_n"),
                    *[count(x).alias(f"d{i}") for i, x in enumerate(names)])
    return counts.select(F.explode(F.array(*[F.struct(
        F.lit(x).alias("column"), F.col("_n").alias("rows"), F.col(f"d{i}").alias("distinct"),
        (F.col(f"d{i}") / F.col("_n") < share).alias("low_cardinality"))
        for i, x in enumerate(names)])).alias("_c")).select("_c.*")


def stringify_all(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(x).cast("string").alias(x) for x in df.columns])


# --- newest rows ---------------------------------------------------------------------------------

def last_n(df: DataFrame, n: int, order: Sequence[str], key: str = "symbol") -> DataFrame:
    """Newest n rows per key; Spark limits each task to n rows per key before the shuffle."""
    w = Window.partitionBy(key).orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def latest_price(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(F.max_by("close", "timestamp").alias("latest_price"))


def latest_quote_proxy(bars: DataFrame) -> DataFrame:
    """Newest bar per symbol as a quote."""
    return bars.groupBy("symbol").agg(
        F.max_by("close", "timestamp").alias("price"), F.max("timestamp").alias("timestamp"),
        F.max_by("volume", "timestamp").alias("volume"))


def orders_filter(orders: DataFrame, status: str = "all", limit: int = 50) -> DataFrame:
    """Newest ``limit`` orders with a status (a top-k)."""
    if status != "all":
        orders = orders.filter(F.col("status") == status)
    return orders.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(limit)


def symbol_filter(df: DataFrame, *symbols: str) -> DataFrame:
    return df.filter(F.col("symbol").isin(*symbols))
