"""Checks of numbered sequences: repeats, gaps, and state along the numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hilvan.operators.groups import order_struct

# Numbers per window when looking for gaps. Numbers are unique by then, so this also
# bounds the rows that one task holds for a group.
NUMBERS_PER_CHUNK = 100_000


def first_two(
    df: DataFrame, group: Sequence[str], number: str, order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """One row per (group, number): ``first`` and ``second`` row, ``repeated`` flag.

    The rank limit is applied in every map task before the shuffle, so a number that is
    repeated endlessly sends two rows per task.
    """
    ranked = (
        df.select(*group, number, *order, *[F.col(v).alias(f"v_{v}") for v in values])
        .withColumn("_rank", F.row_number().over(Window.partitionBy(*group, number).orderBy(*order)))
        .filter("_rank <= 2")
    )
    entry = F.struct(*[F.col(f"v_{v}").alias(v) for v in values])
    return ranked.groupBy(*group, number).agg(
        F.min_by(entry, "_rank").alias("first"),
        F.max_by(entry, F.when(F.col("_rank") == 2, 2)).alias("second"),
        (F.max("_rank") == 2).alias("repeated"),
    )


def distinct_numbers(
    df: DataFrame, group: Sequence[str], number: str, order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """One row per (group, number): ``first`` row and ``repeated`` flag; an aggregate only."""
    return df.groupBy(*group, number).agg(
        F.min_by(F.struct(*values), order_struct([F.col(c) for c in order])).alias("first"),
        (F.count(F.lit(1)) > 1).alias("repeated"),
    )


def repeated_numbers(pairs: DataFrame) -> DataFrame:
    """Numbers carried by several rows, from :func:`first_two`."""
    return pairs.filter("repeated")


def sequence_gaps(
    pairs: DataFrame, group: Sequence[str], number: str, per_chunk: int = NUMBERS_PER_CHUNK
) -> DataFrame:
    """Gaps between successive numbers, from :func:`distinct_numbers` or :func:`first_two`.

    A group with any repeated number is left out. Yields the last row before the gap,
    ``following`` and the ``missing`` text: up to three numbers listed, more as a range.
    """
    rows = pairs.withColumn("_chunk", F.floor(F.col(number) / per_chunk))
    whole = Window.partitionBy(*group)
    chunks = (
        rows.groupBy(*group, "_chunk")
        .agg(F.min(number).alias("_low"), F.bool_or("repeated").alias("_rep"))
        .withColumn("_next_low", F.lead("_low").over(whole.orderBy("_chunk")))
        .withColumn("_any_rep", F.bool_or("_rep").over(whole))
        .filter(~F.col("_any_rep"))
        .drop("_low", "_rep", "_any_rep")
    )
    inside = Window.partitionBy(*group, "_chunk").orderBy(number)
    return (
        rows.join(chunks, [*group, "_chunk"])
        .withColumn("following", F.coalesce(F.lead(number).over(inside), "_next_low"))
        .filter(F.col("following") - F.col(number) >= 2)
        .withColumn("missing", missing_text(F.col(number) + 1, F.col("following") - 1))
        .drop("_chunk", "_next_low", "second", "repeated")
    )


def missing_text(low: Column, high: Column) -> Column:
    """'_4, _5' for up to three numbers, '_4 al _9' for more."""
    listed = F.array_join(
        F.transform(F.sequence(low, F.least(high, low + 2)), lambda n: F.concat(F.lit("_"), n.cast("string"))),
        ", ",
    )
    return F.when(high - low <= 2, listed).otherwise(
        F.concat(F.lit("_"), low.cast("string"), F.lit(" al _"), high.cast("string"))
    )


def state_sequence(
    df: DataFrame, group: Sequence[str], number: str, order: Sequence[str],
    in_service: Column, values: Sequence[str],
) -> DataFrame:
    """Rows that break the rule 'in service first, spare after' per group.

    A group without any row in service reports its lowest row; otherwise every row not
    in service below the last one in service. ``last_number`` is null in the first case.
    Both ends are aggregates, so a hot group needs no ordered window.
    """
    slim = df.select(
        *group, number, *order, *values, F.coalesce(in_service, F.lit(False)).alias("_on"),
        order_struct([F.col(number), *[F.col(c) for c in order]]).alias("_at"),
    )
    ends = slim.groupBy(*group).agg(
        F.max(F.when(F.col("_on"), F.col("_at"))).alias("_last"), F.min("_at").alias("_lowest")
    )
    return (
        slim.join(ends, list(group))
        .filter(
            ~F.col("_on")
            & F.when(F.col("_last").isNull(), F.col("_at") == F.col("_lowest")).otherwise(
                F.col("_at") < F.col("_last")
            )
        )
        .select(*group, number, *order, *values, F.col("_last")["o0"].alias("last_number"))
    )
