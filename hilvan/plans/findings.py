"""Common parts of the audits: usable rows, owners, findings tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hilvan.functions.text import normalise_id, null_if_empty, strip, text_or_empty
from hilvan.operators.groups import last_wins
from hilvan.session import stored

NO_OWNER = "-"
NO_BUILDING_OWNER = "RESPONSABLE NO ENCONTRADO"


def usable_rows(rows: DataFrame, excluded: DataFrame | None, status: str | None = "estado") -> DataFrame:
    """Rows with an id that is not excluded and, where it matters, with a status."""
    kept = rows.withColumn("id", normalise_id("id")).filter("id <> ''")
    if status:
        kept = kept.filter(F.coalesce(F.col(status), F.lit("")) != "")
    if excluded is not None:
        kept = kept.join(excluded.select(normalise_id("id").alias("id")).filter("id <> ''"), "id", "left_anti")
    return kept


def exclusions(sheet: DataFrame) -> DataFrame:
    """Ids of the exclusion sheet (id, elemento, tb)."""
    return sheet.select(normalise_id("id").alias("id")).filter("id <> ''").distinct()


def exempt_names(sheet: DataFrame) -> DataFrame:
    """Building names exempt from the type rule."""
    return (
        sheet.filter(F.upper(strip("tb")) == "ED1").select(strip("elemento").alias("name"))
        .filter("name <> ''").distinct()
    )


def owners_by(sheet: DataFrame, key: Column) -> DataFrame:
    """(key, owner): the last row of a key wins. ``sheet`` has responsable and seq."""
    rows = sheet.select(
        F.coalesce(key, F.lit("")).alias("owner_key"), text_or_empty("responsable").alias("owner"), "seq"
    ).filter("owner_key <> ''")
    return last_wins(rows, ["owner_key"], ["seq"], ["owner"])


def cable_owners(sheet: DataFrame) -> DataFrame:
    return owners_by(sheet, strip(F.substring_index("cable_acceso", "/", 1)))


def building_owners(sheet: DataFrame) -> DataFrame:
    return owners_by(sheet, normalise_id("id_edificio"))


def lookup(table: DataFrame) -> DataFrame:
    """A table with one row per key, stored before it is joined.

    Where a join follows the aggregate of its key in one stage, adaptive execution can't split
    the rows of a hot key, or those without one. A stored table has a known size, too, and
    is made once for all of its joins.
    """
    return stored(table)


def with_owner(rows: DataFrame, owners: DataFrame, key: Column, default: str = NO_OWNER, name: str = "owner") -> DataFrame:
    """Owner by key; one row per key on the owner side."""
    lookup = owners.withColumnRenamed("owner", "_owner")
    return (
        rows.withColumn("_key", key)
        .join(lookup, F.col("_key") == F.col("owner_key"), "left")
        .withColumn(name, F.coalesce("_owner", F.lit(default)))
        .drop("_key", "owner_key", "_owner")
    )


def findings(
    rows: DataFrame, entity: str, stage: int, messages: Column, id: Column | str = "id",
    value: Column | str = "nombre", owner: Column | str | None = None, seq: Column | str = "seq",
    owners: DataFrame | None = None, key: Column | None = None, default: str = NO_OWNER,
) -> DataFrame:
    """One row per message: entity, id, value, owner, message, stage, seq, pos.

    With ``owners`` the owner of ``key`` is looked up for rows that have a message. The
    outer explode keeps the optimiser from deriving a filter that would run every rule a
    second time; a filter on the size of the messages would do the same. The messages are
    a column before they are exploded: as a projection they are compiled, and what several
    rules share is computed once, while an explode of so long an expression is interpreted.
    """
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    who = key.alias("_key") if owners is not None else as_col(owner if owner is not None else "owner").alias("owner")
    made = rows.select(
        as_col(id).cast("string").alias("id"), as_col(value).alias("value"), who,
        as_col(seq).cast("bigint").alias("seq"), messages.alias("_messages"),
    )
    exploded = made.select(
        F.lit(entity).alias("entity"), *[c for c in made.columns if c != "_messages"], F.lit(stage).alias("stage"),
        F.posexplode_outer("_messages").alias("pos", "message"),
    ).filter("message IS NOT NULL")
    if owners is not None:
        exploded = with_owner(exploded, owners, F.col("_key"), default)
    return exploded.select("entity", "id", "value", "owner", "message", "stage", "seq", "pos")


def one(message: Column) -> Column:
    return F.array(message)


def together(messages: Column) -> Column:
    """All messages of a row as one; null when there is none."""
    return one(null_if_empty(F.array_join(messages, " | ")))


def percent(value: Column) -> Column:
    """One decimal, ties to even."""
    return F.format_string("%.1f", F.bround(value, 1))
