"""What several feeds last said, at each row of a base table.

A feed may be far rarer or denser than the base, and one key may own any share of all rows. The rows of the base
and of all feeds are one series, cut into blocks of about as many rows each; inside a block a row takes the last
``n`` rows of each feed before it. What a block's first rows miss is carried over from earlier blocks: the last
``n`` rows of each block and feed, a small table, are run through the same windows by key alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.operators.series import BLOCK_ROWS, blocked
from tidewick.session import written


def _united(base: DataFrame, feeds: Mapping[str, DataFrame], keys: Sequence[str], time: str, ties: Mapping[str, Sequence[str]]
            ) -> DataFrame:
    """All rows with ``_kind`` (the base last), ``_tie`` and one struct column for each table."""
    structs = {name: F.struct(*[c for c in df.columns if c not in keys]) for name, df in {**feeds, "_row": base}.items()}
    kinds = {name: df.select(structs[name].alias("x")).schema["x"].dataType for name, df in {**feeds, "_row": base}.items()}
    out = None
    for number, (name, df) in enumerate({**feeds, "_row": base}.items()):
        tie = F.to_json(F.struct(*ties[name])) if ties.get(name) else F.lit("")
        if ties.get(name) and len(ties[name]) == 1 and kinds[name][ties[name][0]].dataType.typeName() in ("long", "integer"):
            tie = F.format_string("%020d", F.col(ties[name][0]))
        row = df.select(*keys, F.col(time).alias("_time"), F.lit(number).alias("_kind"), tie.alias("_tie"),
                        *[(structs[n] if n == name else F.lit(None).cast(kinds[n])).alias(n) for n in kinds])
        out = row if out is None else out.unionByName(row)
    return out


def _last(df: DataFrame, part: Sequence[str], names: Sequence[str], n: int) -> DataFrame:
    """``<name>_last`` of every row: the last n of the feed's structs at or before it, oldest first."""
    own = Window.partitionBy(*part, "_kind").orderBy("_at").rowsBetween(-(n - 1), 0)
    so_far = Window.partitionBy(*part).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    tails = {f"_tail_{i}": F.when(F.col("_kind") == i, F.collect_list(x).over(own)) for i, x in enumerate(names)}
    return df.withColumns(tails).withColumns(
        {f"{x}_last": F.last(f"_tail_{i}", ignorenulls=True).over(so_far) for i, x in enumerate(names)}).drop(*tails)


def as_of(base: DataFrame, feeds: Mapping[str, DataFrame], *, keys: Sequence[str] = ("symbol",), time: str = "timestamp",
          n: int = 1, bucket: Column | None = None, ties: Mapping[str, Sequence[str]] | None = None,
          rows_per_block: int = BLOCK_ROWS) -> DataFrame:
    """``base`` with a column for each feed: the last ``n`` of its rows (structs, oldest first) at or before the row.

    A feed's row at the very time of a base row counts as before it. ``ties`` names the columns that order a
    table's rows of one time; of rows that agree in these too, any may come first. A base row without any feed row
    before it has empty lists. Rows of the base or a feed whose key or time is NULL have no place: those of feeds
    are left out, those of the base get empty lists. Feed names must not be names of base columns.

    ``bucket`` (of the column ``_time``) must not decrease with time, and a key's rows of one bucket should fit a
    task; the default is a minute.
    """
    names, ties = list(feeds), dict(ties or {})
    placed = F.lit(True)
    for c in (*keys, time):
        placed = placed & F.col(c).isNotNull()
    united = _united(base.filter(placed), {x: df.filter(placed) for x, df in feeds.items()}, keys, time,
                     {**ties, "_row": ties.get("base", ())})
    order = ["_time", "_kind", "_tie"]
    # Blocks are cut by row counts, without copied rows: what comes before a block is carried over below.
    rows = blocked(united, keys, order, bucket=F.date_trunc("minute", "_time") if bucket is None else bucket,
                   rows_per_block=rows_per_block, halo=0).filter("_own").drop("_own").withColumn("_at", F.col("pos") * 2 + 1)

    newest = Window.partitionBy(*keys, "_blk", "_kind").orderBy(F.col("_at").desc())
    ends = rows.filter(F.col("_kind") < len(names)).withColumn("_k", F.row_number().over(newest)).filter(F.col("_k") <= n)
    starts = rows.groupBy(*keys, "_blk").agg((F.min("_at") - 1).alias("_at"))
    few = ends.select(*keys, "_blk", "_kind", "_at", *names).unionByName(
        starts.withColumn("_kind", F.lit(len(names))), allowMissingColumns=True)
    carried = _last(few, keys, names, n).filter(F.col("_kind") == len(names))
    carried = written(carried.select(*keys, "_blk", *[F.col(f"{x}_last").alias(f"_{x}_before") for x in names]), "as-of-carried")

    inside = _last(rows, [*keys, "_blk"], names, n).filter(F.col("_kind") == len(names))
    joined = inside.join(carried, [*keys, "_blk"], "left")
    rest = [c for c in base.columns if c not in keys]
    out = joined.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in base.columns],
                        *[_newest(_all(joined, x), n).alias(x) for x in names])
    lost = base.filter(~placed)
    empty = [F.array().cast(out.schema[x].dataType).alias(x) for x in names]
    return out.unionByName(lost.select(*keys, *rest, *empty))


def _all(df: DataFrame, name: str) -> Column:
    none = F.array().cast(df.schema[f"{name}_last"].dataType)
    return F.concat(F.coalesce(f"_{name}_before", none), F.coalesce(f"{name}_last", none))


def _newest(rows: Column, n: int) -> Column:
    return F.slice(rows, F.greatest(F.size(rows) - n + 1, F.lit(1)), F.lit(n))
