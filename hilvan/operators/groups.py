"""Group operators that stay safe when one group holds a large share of all rows.

Counts, winners and first/last values are plain aggregates, so every map task reduces
its rows before the shuffle. A text that lists the entries of a group is the one result
that grows with the group; it has a table of its own, see :func:`ordered_text`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hilvan.functions.text import as_column, comparison_key, normalise_id, strip
from hilvan.session import cut_lineage, stored

# Bytes of a list after which its next part begins.
PART_BYTES = 1 << 20
# Sums of bytes of lists that share a hash, to see that none is long.
SUMS = 1 << 16


def nulls_last(*columns: Column | str) -> list[Column]:
    """Ascending sort fields with nulls last; as maximum: descending with nulls first."""
    out = []
    for c in map(as_column, columns):
        out += [c.isNull(), c]
    return out


def order_struct(order: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])


def last_wins(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], values: Sequence[str]
) -> DataFrame:
    """One row per key: the values of its last row, as when a lookup is overwritten."""
    return _pick(df, keys, order, values, F.max_by)


def first_wins(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], values: Sequence[str]
) -> DataFrame:
    """One row per key: the values of its first row."""
    return _pick(df, keys, order, values, F.min_by)


def _pick(df, keys, order, values, pick) -> DataFrame:
    at = order_struct([as_column(c) for c in order])
    picked = df.groupBy(*keys).agg(pick(F.struct(*values), at).alias("_picked"))
    return picked.select(*keys, *[F.col("_picked")[v].alias(v) for v in values])


def majority(
    df: DataFrame, group: Sequence[str], value: str, order: Sequence[Column | str]
) -> DataFrame:
    """Most frequent value per group; ties go to the value that appeared first.

    Yields the group columns, ``majority``, ``votes``, ``total`` and ``kinds``.
    """
    if len(order) == 1:
        # As the least struct of one field, in which null comes first, but without a sort.
        only = as_column(order[0])
        least = F.struct(~F.bool_or(only.isNull()), F.when(~F.bool_or(only.isNull()), F.min(only)))
    else:
        least = F.min(order_struct([as_column(c) for c in order]))
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"), least.alias("_first"))
    return counts.groupBy(*group).agg(
        F.min_by(value, F.struct(-F.col("_n"), F.col("_first"))).alias("majority"),
        F.max("_n").alias("votes"),
        F.sum("_n").alias("total"),
        F.count(F.lit(1)).alias("kinds"),
    )


def minority_rows(
    df: DataFrame, group: Sequence[str], value: str, order: Sequence[Column | str]
) -> DataFrame:
    """Rows whose value differs from the majority of their group.

    The join key is the group, so a hot group is skewed on the row side only; adaptive
    execution splits that side.
    """
    return (
        df.join(majority(df, group, value, order).filter("kinds > 1"), list(group))
        .filter(~F.col(value).eqNullSafe(F.col("majority")))
    )


def pooled_majority(
    df: DataFrame, group: Sequence[str], values: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Majority over several columns at once; '' and null are not counted.

    Adds ``percent``, the share of the winner among the counted values.
    """
    at = [as_column(c) for c in order]
    pooled = df.select(
        *group, *[c.alias(f"_o{i}") for i, c in enumerate(at)],
        F.posexplode(F.array(*values)).alias("_which", "_value"),
    ).filter(F.coalesce(F.col("_value").cast("string"), F.lit("")) != "")
    won = majority(pooled, group, "_value", [f"_o{i}" for i in range(len(at))] + ["_which"])
    return won.withColumn("percent", F.col("votes") / F.col("total") * 100)


def position_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Column, name: str
) -> DataFrame:
    """1-based position of each row in its group, without one task per group.

    ``bucket`` never decreases along the order (a day, an id range). Rows are ranked per
    (group, bucket); the rows of earlier buckets are added from a slim table of counts.
    """
    rows = df.withColumn("_b", bucket)
    before = (
        Window.partitionBy(*keys).orderBy(*nulls_last("_b")).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy(*keys, "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
        .withColumnsRenamed({k: f"_k_{k}" for k in keys} | {"_b": "_k_b"})
    )
    same = F.col("_b").eqNullSafe(F.col("_k_b"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = Window.partitionBy(*keys, "_b").orderBy(*order)
    return (
        rows.join(offsets, same)
        .withColumn(name, F.col("_before") + F.row_number().over(inside))
        .drop("_b", "_before", "_k_b", *[f"_k_{k}" for k in keys])
    )


def in_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "_chunk") -> DataFrame:
    """Adds ``name``, a chunk number that never decreases along (keys, order).

    Spark's range partitioner draws the chunks from a sample, also in the middle of a group
    or of a day, so one hot key is as good as many. They are written once, because a second
    run of the partitioner could draw them elsewhere. Rows with equal keys and order share
    a chunk: end the order with a column that tells them apart.
    """
    return cut_lineage(df.repartitionByRange(*keys, *order).withColumn(name, F.spark_partition_id()))


def running_bytes(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: str, name: str) -> DataFrame:
    """Sum of ``size`` over the rows of the group that come earlier, without one task per group.

    Rows are summed inside their chunk (:func:`in_chunks`), and a slim table with one row
    per group and chunk carries the sums across.
    """
    chunked = in_chunks(df, keys, order)
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        chunked.groupBy(*keys, "_chunk").agg(F.sum(size).alias("_sum"))
        .select(
            *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_chunk").alias("_k_chunk"),
            F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carried"),
        )
    )
    same = F.col("_chunk") == F.col("_k_chunk")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        chunked.join(sums, same)
        .withColumn(name, F.col("_carried") + F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .drop("_chunk", "_k_chunk", "_carried", *[f"_k_{k}" for k in keys])
    )


def ordered_text(
    df: DataFrame,
    keys: Sequence[str],
    entry: Column,
    order: Sequence[Column],
    separator: str | Column,
    part_bytes: int = PART_BYTES,
    name: str = "text",
    written: bool = False,
    spread: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """List table: keys, ``part``, ``entries`` and ``name``, the entries joined in order.

    A cell cannot hold a third of all rows, so a list continues in rows with part 1, 2, ...
    An entry belongs to the part in which its first byte lies, counting the bytes of all
    entries and separators before it; it is never divided, and a part that lies within one
    long entry is absent. The texts of the parts, joined with the separator, are the whole
    list whatever ``part_bytes``. Null entries are left out, and a group of nulls has no row.
    ``written`` says that ``df`` is read from a stored table, which needs no further copy.
    ``spread`` makes several lists of each row of ``df``, adding the keys that ``df`` lacks:
    rows are then stored and dealt out as ``df`` has them, once for all their lists.
    """
    between = F.lit(separator) if isinstance(separator, str) else separator
    at = [*[f"_o{i}" for i in range(len(order))], "_entry"]
    slim = lambda rows: rows.select(
        *keys, entry.alias("_entry"), *[c.alias(f"_o{i}") for i, c in enumerate(order)]
    )
    lists = slim if spread is None else lambda rows: slim(spread(rows))
    if spread is None and not written:
        df, lists = slim(df), lambda rows: rows
    sized = lambda rows: lists(rows).filter("_entry IS NOT NULL").withColumn(
        "_size", (F.octet_length("_entry") + F.octet_length(between)).cast("bigint")
    )
    # Written once: the sizes and the lists are taken from it.
    df = df if written else stored(df)
    dealt = [k for k in keys if k in df.columns]
    listed = lambda *by: [
        F.count(F.lit(1)).alias("entries"), F.sort_array(F.collect_list(F.struct(*by))).alias("_list")
    ]
    shown = [*keys, "part", "entries", F.call_function("array_join", F.col("_list._entry"), between).alias(name)]
    cut = lambda rows: rows.groupBy(*keys, F.expr(f"_start div {part_bytes}").alias("part")).agg(
        *listed("_start", "_entry")
    ).select(*shown)

    def gathered(rows: DataFrame, most: int) -> DataFrame:
        """Lists of rows that are dealt by their keys; ``most`` is a bound of their bytes."""
        if most <= part_bytes:
            whole = rows.groupBy(*keys).agg(*listed(*at))
            return whole.withColumn("part", F.lit(0).cast("bigint")).select(*shown)
        earlier = Window.partitionBy(*keys).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
        return cut(rows.withColumn("_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0).cast("bigint"))))

    # A list is at most as long as all lists that share its hash, of which there are few sums.
    shared = F.pmod(F.xxhash64(*keys), F.lit(SUMS))
    most = (
        sized(df).groupBy(shared.alias("_sum_of")).agg(F.sum("_size").alias("_bytes"))
        .agg(F.max("_bytes")).first()[0] or 0
    )
    # The lists of a row's size fit a task each; only longer ones are cut into chunks first.
    longest = max(part_bytes, PART_BYTES)
    if most <= longest:
        return gathered(sized(df.repartition(*dealt)), most)
    every = sized(df)
    long = cut_lineage(every.groupBy(*keys).agg(F.sum("_size").alias("_bytes")).filter(F.col("_bytes") > longest))
    long = long.select(*[F.col(k).alias(f"_l_{k}") for k in keys], F.lit(True).alias("_long"))
    if long.isEmpty():
        return gathered(sized(df.repartition(*dealt)), longest)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_l_{k}"))
    marked = every.join(long, same, "left")
    short = gathered(marked.filter("_long IS NULL").select(every.columns).repartition(*dealt), longest)
    placed = running_bytes(marked.filter("_long").select(every.columns), keys, at, "_size", "_start")
    return short.unionByName(cut(placed))


def first_part(lists: DataFrame) -> DataFrame:
    """The cells of a list table that fit a table with one row per key: each list's part 0."""
    return lists.filter("part = 0").drop("part", "entries")


def duplicate_keys(
    df: DataFrame, key: str, id_column: str, order: Sequence[Column], separator: str = " , ",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """List table of the keys carried by several rows: key, part, ids in row order, total.

    Keys are counted first and only the repeated ones keep their ids.
    """
    repeated = (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("total")).filter("total > 1")
    )
    rows = df.join(repeated.select(key), key, "left_semi")
    ids = ordered_text(rows, [key], F.col(id_column).cast("string"), order, separator, part_bytes, "ids")
    return ids.drop("entries").join(repeated, key)


def similar_names(
    df: DataFrame, name: str, id_column: str, order: Sequence[str], part_bytes: int = PART_BYTES
) -> DataFrame:
    """Names that differ from the best spelling only by case, marks or spaced letters.

    Best: most rows, then the tidiest spelling, then the first seen. A list table: ``name``,
    ``best``, ``part`` and ``ids``.
    """
    rows = df.select(
        strip(name).alias("name"), normalise_id(F.col(id_column).cast("string")).alias("_id"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
    ).filter("_id <> '' AND name <> ''")
    at = [F.col(f"_o{i}") for i in range(len(order))]
    low = F.lower("name")
    spellings = (
        rows.groupBy("name")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(order_struct(at)).alias("_first"))
        .withColumn("_key", comparison_key("name"))
        .filter(
            (F.col("_key") != "")
            & ~(low.contains("subred") | low.contains("sede") | low.startswith("ant cm"))
        )
        .withColumn("_score", spelling_score("name"))
    )
    best = (
        spellings.groupBy("_key")
        .agg(
            F.min_by("name", F.struct(-F.col("_n"), -F.col("_score"), F.col("_first"))).alias("best"),
            F.count(F.lit(1)).alias("_spellings"),
        )
        .filter("_spellings > 1")
        .drop("_spellings")
    )
    others = spellings.join(best, "_key").filter("name <> best").select("name", "best")
    ids = ordered_text(rows.join(others, "name"), ["name", "best"], F.col("_id"), at, ", ", part_bytes, "ids")
    return ids.drop("entries")


def spelling_score(name: Column | str) -> Column:
    """0 to 4 points for a tidy spelling."""
    name = as_column(name)
    upper = F.upper(name)
    spaces = F.length(name) - F.length(F.replace(name, F.lit(" "), F.lit("")))
    points = [
        ~name.contains("."),
        ~name.contains("  ") & (spaces < 3),
        strip(name) == name,
        ~(upper.startswith("C.C") | upper.startswith("NODO")) & (name == upper),
    ]
    return sum((p.cast("int") for p in points), F.lit(0))
