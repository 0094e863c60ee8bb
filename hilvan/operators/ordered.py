"""Windows over ordered rows, cut into chunks so that a long sequence spans many tasks.

``chunk`` columns never decrease along ``order`` (a line-number range, a day). Each chunk
is windowed on its own; what flows across chunks comes from a slim table with one row per
(key, chunk). Keys and chunks must not be null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hilvan.operators.groups import in_chunks, order_struct


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    chunk: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    before: Mapping[str, Column] | None = None,
    whole: Column | None = None,
) -> DataFrame:
    """Last non-null value of each expression.

    ``values`` include the row itself, ``before`` only earlier rows. ``whole`` marks rows of
    keys that lie in one chunk (which may be null there): nothing is carried to them, so
    the ends of chunks are taken of the other rows alone.
    """
    before = before or {}
    marked = df.withColumns({f"_v_{n}": c for n, c in {**values, **before}.items()})
    names = [*values, *before]
    at = order_struct([F.col(c) for c in order])
    ends = (marked if whole is None else marked.filter(~whole)).groupBy(*keys, *chunk).agg(
        *[F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(f"_e_{n}") for n in names]
    )
    earlier = Window.partitionBy(*keys).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *keys, *chunk, *[F.last(f"_e_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in names]
    )
    inside = Window.partitionBy(*keys, *chunk).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    prior = inside.rowsBetween(Window.unboundedPreceding, -1)
    # The chunk's carried values are joined behind the window: its sort holds the rows alone, and
    # leaves them in the order that the join needs.
    windowed = marked.withColumns(
        {n: F.last(f"_v_{n}", ignorenulls=True).over(upto if n in values else prior) for n in names}
    ).drop(*[f"_v_{n}" for n in names])
    return windowed.join(carried, [*keys, *chunk], "inner" if whole is None else "left").withColumns(
        {n: F.coalesce(n, f"_c_{n}") for n in names}
    ).drop(*[f"_c_{n}" for n in names])


def previous_value(
    df: DataFrame, keys: Sequence[str], chunk: Sequence[str], order: Sequence[str],
    value: Column, name: str, whole: Column | None = None,
) -> DataFrame:
    """Value of the row before, null values included; null for the first row."""
    wrapped = carry_forward(df, keys, chunk, order, {}, {name: F.struct(value.alias("v"))}, whole)
    return wrapped.withColumn(name, F.col(name)["v"])


def running_total(
    df: DataFrame, keys: Sequence[str], chunk: Sequence[str], order: Sequence[str],
    value: Column, name: str,
) -> DataFrame:
    """Sum of ``value`` up to and including the row."""
    marked = df.withColumn("_v", value)
    earlier = Window.partitionBy(*keys).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(*keys, *chunk)
        .agg(F.sum("_v").alias("_s"))
        .select(*keys, *chunk, F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_c"))
    )
    inside = (
        Window.partitionBy(*keys, *chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        marked.join(offsets, [*keys, *chunk])
        .withColumn(name, F.col("_c") + F.sum("_v").over(inside))
        .drop("_v", "_c")
    )


def collapse_repeats(
    df: DataFrame, keys: Sequence[str], chunk: Sequence[str], order: Sequence[str],
    columns: Sequence[str], whole: Column | None = None,
) -> DataFrame:
    """Drop rows that equal the row before in ``columns``; the first row stays."""
    row = F.struct(*columns)
    return (
        previous_value(df, keys, chunk, order, row, "_prev", whole)
        .filter(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(row))
        .drop("_prev")
    )


def first_open_block(
    df: DataFrame, keys: Sequence[str], chunk: Sequence[str], order: Sequence[str],
    element: str, is_open: Column,
) -> DataFrame:
    """Open rows of the block that starts at the first open row.

    The block runs on while ``element`` keeps the value of its first row; rows in it that
    are not open are passed over. Two aggregates give the start and the end, so no
    ordered window is needed.
    """
    at = order_struct([F.col(c) for c in order])
    rows = df.withColumn("_at", at).withColumn("_open", F.coalesce(is_open, F.lit(False)))
    start = rows.filter("_open").groupBy(*keys).agg(
        F.min("_at").alias("_start"), F.min_by(F.struct(element), F.col("_at")).alias("_first")
    )
    placed = rows.join(start, list(keys)).filter("_at >= _start")
    other = ~F.col(element).eqNullSafe(F.col("_first")[element])
    end = placed.filter(other).groupBy(*keys).agg(F.min("_at").alias("_end"))
    return (
        placed.join(end, list(keys), "left")
        .filter(F.col("_open") & (F.col("_end").isNull() | (F.col("_at") < F.col("_end"))))
        .drop("_at", "_open", "_start", "_first", "_end")
    )


def as_of(
    objects: DataFrame, versions: DataFrame, keys: Sequence[str], at: str,
    values: Sequence[str], order: Sequence[str] = (),
) -> DataFrame:
    """For each object the values of the greatest version not above its own.

    Both tables have the key columns (there may be none) and ``at``. Objects keep all their
    rows; versions with equal ``at`` give the first by ``order``. Rows of both tables are
    merged, cut into chunks along (keys, version) by Spark's range partitioner, and the last
    version is carried forward inside a chunk and, by one row per chunk, across: no range
    join, and neither one dataset nor one version is a hot key.
    """
    unique = versions.groupBy(*keys, at).agg(
        F.min_by(F.struct(*values), order_struct([F.col(c) for c in (order or values)])).alias("_value")
    )
    own = [c for c in objects.columns if c not in (*keys, at)]
    merged = objects.select(
        *keys, at, F.struct(*own).alias("_object"), F.lit(1).alias("_kind"), F.xxhash64(*own).alias("_spread")
    ).unionByName(unique.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    # Rows without a key or version match nothing.
    usable = F.col(at).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    along = [at, "_kind", "_spread"]
    chunked = in_chunks(merged.filter(usable).na.fill(0, ["_spread"]), keys, along)
    carried = carry_forward(chunked, keys, ["_chunk"], along, {"_found": F.col("_value")})
    found = carried.filter("_kind = 1").select(
        *keys, at, "_object.*", *[F.col("_found")[v].alias(v) for v in values]
    )
    lost = objects.filter(~F.coalesce(usable, F.lit(False)))
    return found.unionByName(lost, allowMissingColumns=True)
