"""Arithmetic under the library's rule that a missing value is NULL, never NaN or infinity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def ratio(num: Column, den: Column) -> Column:
    """Division that is NULL for a zero denominator."""
    return F.try_divide(num, den)


def pct(now: Column, before: Column) -> Column:
    return ratio(now - before, before) * 100.0


def finite(x: Column) -> Column:
    """NaN and the infinities become NULL; apply to doubles at ingest."""
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def ladder(steps: list[tuple[Column, object]], otherwise: object) -> Column:
    """First matching condition wins; a NULL condition does not match."""
    (cond, value), *rest = steps
    out = F.when(cond, value)
    for cond, value in rest:
        out = out.when(cond, value)
    return out.otherwise(otherwise)


def flag(cond: Column) -> Column:
    """1/0 with NULL read as 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def round_to(x: Column, digits: int | None) -> Column:
    return x if digits is None else F.round(x, digits)
