"""Name -> (Spark query, SQL to compare with)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidewick.session import prepare_session

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(prepare_session(spark), sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


# Added before rounding, here and in the SQL: sums in another order differ in the last bits, and a
# value that sits on a rounding tie would otherwise fall to either side.
NUDGE = 1e-9


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name) + NUDGE, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name) for f in df.schema.fields])
