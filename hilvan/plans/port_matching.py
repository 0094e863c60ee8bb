"""From equipment sheets and ring rows to matched port ids with a status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hilvan.functions.text import blank, clean_port, null_if_empty, strip, text_or_empty
from hilvan.operators import ports as P

PLACEMENTS = {"bandeja": "+", "id_port_pacheo": "°", "id_port_cabecera": "°", "sincroniza": "°"}


def match_sheets(sheets: DataFrame, ports: DataFrame) -> DataFrame:
    """Adds ``id_port_cabecera``, the backbone port, to equipment sheet rows.

    ``sheets``: archivo, equipo, puerto, odf, cassetera, pos, pos2, seq.
    ``ports``: id, desc1, desc2, desc3, id_bay, seq.
    """
    return P.with_backbone(sheets, P.backbone_lookup(ports), "equipo", "puerto", "id_port_cabecera")


PATCHES = {"pos_token": "+", "id_port_pacheo": "°", "id_port_cabecera": "°"}


def patched_positions(matched: DataFrame, ports: DataFrame) -> DataFrame:
    """One row per sheet row and position, with its patch port and backbone port."""
    rows = matched.select(
        "archivo", strip("equipo").alias("equipo"), strip("odf").alias("odf"),
        F.upper(strip("cassetera")).alias("cassetera"), clean_port("puerto").alias("puerto"),
        "pos", "pos2", F.col("id_port_cabecera").alias("_backbone"), "seq",
    )
    exploded = P.explode_positions(rows, "pos", "pos2")
    key = F.when((F.col("equipo") != "") & (F.col("odf") != ""), F.concat(F.lit("OP"), "equipo", F.lit("_"), "odf"))
    patched = P.with_patch(
        exploded, P.patch_lookup(ports), F.col("cassetera"), key,
        F.when(F.col("pos_original").isNotNull(), F.col("pos_token")), "id_port_pacheo",
    )
    guarded = P.same_bay_id(patched, P.bay_lookup(ports), "_backbone", "id_port_pacheo", "id_port_cabecera")
    return guarded.drop("pos", "pos2", "_backbone")


def patch_rows(matched: DataFrame, ports: DataFrame, **consolidation) -> DataFrame:
    """Positions of equal sheet rows joined in one row."""
    return P.consolidate(patched_positions(matched, ports), PATCHES, order=["seq", "token_no"], **consolidation)


def patch_lists(matched: DataFrame, ports: DataFrame, **consolidation) -> DataFrame:
    """List table of the patched rows: the columns that are equal, lista, part, entries, texto."""
    rows = patched_positions(matched, ports)
    whole, texts = P.consolidated_lists(rows, PATCHES, order=["seq", "token_no"], **consolidation)
    return whole.join(texts, "_key").drop("_key")


def _matched_trays(
    rows: DataFrame, op: DataFrame, trunk: DataFrame, ports: DataFrame, changes: DataFrame,
    separate_missing: bool,
) -> DataFrame:
    backbone = P.with_backbone(rows, P.backbone_lookup(ports), "ec", "port_ec", "_backbone")
    key = F.when(~blank("ec") & ~blank("op"), F.concat(F.lit("OP"), "ec", F.lit("_"), "op"))
    patched = P.with_patch(
        backbone, P.patch_lookup(ports), F.col("cassetera"), key, null_if_empty(F.col("bandeja")), "id_port_pacheo"
    )
    guarded = P.same_bay_id(patched, P.bay_lookup(ports), "_backbone", "id_port_pacheo", "id_port_cabecera")
    trunked = P.with_trunk(guarded, P.trunk_ports(trunk), "fibra", "odf_calle", "hilo")
    changed = P.with_ring_change(trunked, P.ring_changes(changes), "fibra", "anillo")
    return P.with_sync_status(
        changed, op, "ec", "port_ec", "id_port_pacheo", "id_port_troncal", separate_missing=separate_missing
    ).drop("_backbone")


def match_cable_rows(
    cables: DataFrame, op: DataFrame, trunk: DataFrame, ports: DataFrame, changes: DataFrame,
    **consolidation,
) -> DataFrame:
    """Cable sheet rows with patch value, one row per patch group.

    ``cables``: fibra, ec, port_ec, patcheo, odf_calle, hilo, anillo_origen, anillo, seq.
    A patch value that cannot be read keeps its own status.
    """
    rows = cables.withColumns({"ec": text_or_empty("ec"), "port_ec": text_or_empty("port_ec")})
    exploded = P.explode_trays(rows, "patcheo")
    done = _matched_trays(exploded, op, trunk, ports, changes, separate_missing=False)
    no_trunk = text_or_empty("id_port_troncal") == ""
    fault = F.col("fault")
    status = (
        F.when(fault == "F (sin PATCHEO)", fault)
        .when(fault.isNotNull(), F.when(no_trunk, fault).otherwise("F"))
        .otherwise(F.col("sincroniza"))
    )
    unreadable = fault.isNotNull()
    ruled = done.withColumns(
        {
            "sincroniza": status,
            "id_port_cabecera": F.when(~unreadable, F.col("id_port_cabecera")),
            "id_port_pacheo": F.when(~unreadable, F.col("id_port_pacheo")),
        }
    ).drop("fault")
    marked = P.mark_mixed_rings(ruled, "fibra", "hilo", "anillo", "sincroniza")
    return P.consolidate(
        marked, PLACEMENTS, order=["seq", "tray_no"], numeric="bandeja", **consolidation
    )


def match_ring_rows(
    rings: DataFrame, op: DataFrame, trunk: DataFrame, ports: DataFrame, changes: DataFrame,
    **consolidation,
) -> DataFrame:
    """Ring sheet rows: fibra, ec, port_ec, odf_patcheo, cassetera, port_pacheo, odf_troncal, hilo, anillo, seq."""
    rows = rings.select(
        text_or_empty("fibra").alias("fibra"), text_or_empty("ec").alias("ec"),
        clean_port(text_or_empty("port_ec")).alias("port_ec"), text_or_empty("odf_patcheo").alias("op"),
        F.upper(text_or_empty("cassetera")).alias("cassetera"), "port_pacheo",
        text_or_empty("odf_troncal").alias("odf_calle"), text_or_empty("hilo").alias("hilo"),
        text_or_empty("anillo").alias("anillo"), "seq",
    )
    exploded = P.explode_plus(rows, "port_pacheo").drop("port_pacheo")
    done = _matched_trays(exploded, op, trunk, ports, changes, separate_missing=True)
    marked = P.mark_mixed_rings(done, "fibra", "hilo", "anillo", "sincroniza")
    return P.consolidate(
        marked, PLACEMENTS, order=["seq", "tray_no"], numeric="bandeja", **consolidation
    )
