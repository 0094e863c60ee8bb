"""Audit of buildings and their structures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hilvan.functions import rules as R
from hilvan.functions.text import normalise_id, strip, text_or_empty
from hilvan.operators.groups import PART_BYTES, majority, similar_names
from hilvan.plans.findings import NO_BUILDING_OWNER, findings, one, together, usable_rows

# Logical column and headers of a building export.
COLUMNS = {
    "id": ["idtexto", "id", "id texto", "building.id"],
    "nombre": ["name", "nombre", "building name"],
    "tipo": ["type", "tipo", "building type"],
    "categoria": ["categoria", "category"],
    "floor_len": ["floor dimension (length)"],
    "floor_wid": ["floor dimension (width)"],
    "rooms_len": ["number of rooms (length)"],
    "rooms_wid": ["number of rooms (width)"],
    "floors": ["number of floors"],
}


def audit_buildings(
    buildings: DataFrame, owners: DataFrame, excluded: DataFrame | None = None,
    exempt: DataFrame | None = None, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """All findings of buildings and structures. ``exempt`` has the column name."""
    return reduce(
        DataFrame.unionByName,
        [
            building_findings(buildings, owners, excluded, exempt),
            structure_findings(buildings, owners, excluded),
            similar_findings(buildings, part_bytes),
        ],
    )


def building_findings(
    buildings: DataFrame, owners: DataFrame, excluded: DataFrame | None = None, exempt: DataFrame | None = None
) -> DataFrame:
    name = text_or_empty("nombre")
    rows = usable_rows(buildings, excluded, status=None).select(
        "id", "seq", name.alias("nombre"), text_or_empty("tipo").alias("tipo"),
        F.upper(text_or_empty("categoria")).alias("cat"),
        strip(F.substring_index(name, "/", 1)).alias("base"),
    )
    usual = majority(rows.filter("base <> ''"), ["base"], "tipo", ["seq"]).select(
        "base", F.col("majority").alias("_usual")
    )
    typed = rows.join(usual, "base", "left")
    if exempt is None:
        typed = typed.withColumn("_exempt", F.lit(False))
    else:
        names = exempt.select(F.col("name").alias("_ex")).distinct()
        typed = typed.join(names, F.col("nombre") == F.col("_ex"), "left").withColumn(
            "_exempt", F.col("_ex").isNotNull()
        )
    spaced = rows.filter((F.col("nombre") != "") & R.spaced_legal_form("nombre"))
    suffix = findings(
        spaced, "EDIFICIO", 30, one(F.lit(R.SPACED_FORM_MESSAGE)), owners=owners, key=F.col("id"),
        default=NO_BUILDING_OWNER,
    )
    marks = findings(rows, "EDIFICIO", 31, R.whitespace("nombre", "NOMBRE"), owner=F.lit("..."))
    own = R.building_attributes(
        F.col("nombre"), F.col("cat"), F.col("tipo"), F.col("_usual"), F.col("base"), F.col("_exempt")
    )
    attributes = findings(typed, "EDIFICIO", 32, together(own), owner=F.lit("..."))
    return suffix.unionByName(marks).unionByName(attributes)


def structure_findings(buildings: DataFrame, owners: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    sizes = ("floor_len", "floor_wid", "rooms_len", "rooms_wid", "floors")
    rows = usable_rows(buildings, excluded, status=None).select(
        "id", "seq", text_or_empty("nombre").alias("nombre"), *[normalise_id(c).alias(c) for c in sizes]
    ).filter(~F.upper("nombre").startswith("NODO"))
    c = F.col
    messages = R.all_of(
        R.whitespace("nombre", "NOMBRE"),
        R.whitespace("floor_len", "FLOOR LENGTH"),
        R.whitespace("floor_wid", "FLOOR WIDTH"),
        R.whitespace("rooms_len", "ROOMS LENGTH"),
        R.whitespace("rooms_wid", "ROOMS WIDTH"),
        R.whitespace("floors", "NUMBER OF FLOORS"),
        R.structure_sizes(c("floors"), c("floor_len"), c("floor_wid"), c("rooms_len"), c("rooms_wid")),
    )
    return findings(
        rows, "ESTRUCTURA", 33, messages, owners=owners, key=c("id"), default=NO_BUILDING_OWNER
    )


def similar_findings(buildings: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    names = similar_names(buildings, "nombre", "id", ["seq"], part_bytes)
    return findings(
        names.withColumn("seq", F.lit(0)), "EDIFICIO", 34,
        one(R.text("NOMBRE (Corregir a (", F.col("best"), ")")), id="ids", value="name", owner=F.lit("..."),
    )
