"""Equipment, patch-panel and trunk-panel sheets matched to the port inventory.

Every lookup is reduced to one row per key before it is joined, so no join multiplies
rows and a hot port is skewed on one side only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hilvan.functions.text import (
    as_column,
    blank,
    clean_port,
    expand_exponent_id,
    extract,
    iso_date,
    null_if_empty,
    port_kind,
    port_number,
    port_parts,
    slot_number,
    strip,
    text_or_empty,
    tray_letter,
    trunk_panel_parts,
)
from hilvan.operators.groups import PART_BYTES, first_part, first_wins, last_wins, ordered_text
from hilvan.session import cut_lineage

NO_POSITION = "SIN_POS"


# --- lookups from the port inventory (id, desc1, desc2, desc3, id_bay, seq) -------------

def backbone_lookup(ports: DataFrame) -> DataFrame:
    """(equipment, slot, mid, number) -> id of the port that the matching accepts.

    An XG port answers to mid 0. A G port answers to mid 1 where its slot has an XG port
    and to mid 0 where it has none. The first row of the inventory wins.
    """
    named = ports.select(
        F.col("desc3").alias("equipment"), slot_number("desc2").alias("slot"),
        port_kind("desc1").alias("kind"), port_number("desc1").alias("number"), "id", "seq",
    ).filter("slot IS NOT NULL AND kind IS NOT NULL AND number IS NOT NULL")
    slots = named.groupBy("equipment", "slot").agg(
        F.bool_or(F.col("kind") == "XG").alias("_has_xg")
    )
    # One row per kind first: the flag of the slot is then joined to few rows.
    firsts = first_wins(named, ["equipment", "slot", "number", "kind"], ["seq"], ["id", "seq"])
    placed = firsts.join(slots, ["equipment", "slot"]).withColumn(
        "mid", F.when((F.col("kind") == "G") & F.col("_has_xg"), 1).otherwise(0).cast("bigint")
    )
    return first_wins(placed, ["equipment", "slot", "mid", "number"], ["seq"], ["id"])


def patch_lookup(ports: DataFrame) -> DataFrame:
    """(tray, panel key, token) -> id; only shelves named 'OP'; the first row wins."""
    rows = ports.select(
        tray_letter("desc2").alias("tray"), strip("desc3").alias("panel_key"),
        strip("desc1").alias("token"), "id", "seq", "desc3",
    ).filter(
        F.col("tray").isNotNull() & F.upper("desc3").contains("OP")
        & (F.col("panel_key") != "") & (F.col("token") != "")
    )
    return first_wins(rows, ["tray", "panel_key", "token"], ["seq"], ["id"])


def bay_lookup(ports: DataFrame) -> DataFrame:
    """id -> bay; the last row wins."""
    rows = ports.filter("id IS NOT NULL").select(strip("id").alias("port_id"), strip("id_bay").alias("bay"), "seq")
    return last_wins(rows, ["port_id"], ["seq"], ["bay"])


def trunk_ports(ports: DataFrame) -> DataFrame:
    """Trunk-panel rows (id, fibre, panel, port, rest) of ports (id, desc1, desc_shelf, seq)."""
    parts = trunk_panel_parts("desc_shelf")
    return ports.filter(F.col("desc_shelf").startswith("OT")).select(
        "id", parts["fibre"].alias("fibra"), parts["panel"].alias("nombre_odf"),
        F.col("desc1").alias("desc_port"), parts["rest"].alias("desc_shelf"), "seq",
    )


def with_backbone(rows: DataFrame, lookup: DataFrame, equipment: str, port: str, name: str) -> DataFrame:
    """Adds the backbone port id of (equipment, 'slot/mid/number')."""
    parts = port_parts(port)
    keyed = rows.withColumns({"_eq": strip(equipment), "_p": parts})
    return (
        keyed.join(
            lookup.withColumnRenamed("id", name),
            (F.col("_eq") == F.col("equipment"))
            & (F.col("_p")["slot"] == F.col("slot"))
            & (F.col("_p")["mid"] == F.col("mid"))
            & (F.col("_p")["number"] == F.col("number")),
            "left",
        ).drop("_eq", "_p", "equipment", "slot", "mid", "number")
    )


def with_patch(
    rows: DataFrame, lookup: DataFrame, tray: Column, panel_key: Column, token: Column, name: str
) -> DataFrame:
    keyed = rows.withColumns({"_t": tray, "_k": panel_key, "_tok": token})
    return keyed.join(
        lookup.withColumnRenamed("id", name),
        (F.col("_t") == F.col("tray")) & (F.col("_k") == F.col("panel_key")) & (F.col("_tok") == F.col("token")),
        "left",
    ).drop("_t", "_k", "_tok", "tray", "panel_key", "token")


def same_bay_id(rows: DataFrame, bays: DataFrame, backbone: str, patch: str, name: str) -> DataFrame:
    """``name`` = the backbone id, only if both ports stand in the same known bay."""
    one = bays.select(F.col("port_id").alias("_b1"), F.col("bay").alias("_bay1"))
    two = bays.select(F.col("port_id").alias("_b2"), F.col("bay").alias("_bay2"))
    return (
        rows.join(one, F.col(backbone) == F.col("_b1"), "left")
        .join(two, F.col(patch) == F.col("_b2"), "left")
        .withColumn(name, F.when(F.col("_bay1") == F.col("_bay2"), F.col(backbone)))
        .drop("_b1", "_b2", "_bay1", "_bay2")
    )


def with_trunk(rows: DataFrame, trunks: DataFrame, fibre: str, panel: str, strand: str) -> DataFrame:
    """Adds the trunk port of a strand: port = strand - first strand of the panel + 1."""
    known = trunks.select(
        strip("fibra").alias("_f"), strip("nombre_odf").alias("_o"), strip("desc_port").alias("_port"),
        strip("id").alias("id_port_troncal"), strip("desc_shelf").alias("desc_shelf_ot"), "seq",
    ).filter("_f <> '' AND _o <> ''")
    based = known.withColumn("_base", extract(F.col("desc_shelf_ot"), r"(\d+)/").try_cast("bigint"))
    base = first_wins(based.filter("_base IS NOT NULL"), ["_f", "_o"], ["seq"], ["_base"]).withColumnsRenamed(
        {"_f": "_bf", "_o": "_bo"}
    )
    port = last_wins(
        known.filter("_port <> '' AND id_port_troncal <> ''"), ["_f", "_o", "_port"], ["seq"],
        ["id_port_troncal", "desc_shelf_ot"],
    )
    keyed = rows.withColumns({"_rf": strip(fibre), "_ro": strip(panel), "_rs": strip(strand)})
    return (
        keyed.join(base, (F.col("_rf") == F.col("_bf")) & (F.col("_ro") == F.col("_bo")), "left")
        .withColumn(
            "_want",
            F.when(
                F.col("_rs").rlike(r"^\d+$"),
                (F.col("_rs").try_cast("bigint") - F.col("_base") + 1).cast("string"),
            ),
        )
        .join(
            port, (F.col("_rf") == F.col("_f")) & (F.col("_ro") == F.col("_o")) & (F.col("_want") == F.col("_port")), "left"
        )
        .withColumnRenamed("_port", "desc_port_ot")
        .drop("_rf", "_ro", "_rs", "_bf", "_bo", "_base", "_want", "_f", "_o")
    )


# --- ring changes ----------------------------------------------------------------------

def ring_changes(changes: DataFrame) -> DataFrame:
    """One record per ring code, by old and by present code; the last row wins."""
    rows = changes.select(
        *[text_or_empty(c).alias(c) for c in ("cable", "anillo", "anillo_actual", "iluminacion")],
        iso_date("fecha_cambio").alias("fecha_cambio"),
        F.upper(text_or_empty("igualar")).alias("igualar"), "seq",
    )
    codes = F.array(
        F.struct(F.lit(0).alias("pos"), F.col("anillo").alias("code")),
        F.struct(F.lit(1).alias("pos"), F.col("anillo_actual").alias("code")),
    )
    keyed = rows.withColumn("_c", F.explode(codes)).select("*", "_c.pos", "_c.code").filter("code <> ''")
    return last_wins(
        keyed, ["code"], ["seq", "pos"],
        ["cable", "anillo", "anillo_actual", "iluminacion", "fecha_cambio", "igualar"],
    )


def with_ring_change(rows: DataFrame, records: DataFrame, fibre: str, ring: str, name: str = "cambio") -> DataFrame:
    """'V|…' for a present ring, 'F|…' for an old one, else why there is no record."""
    found = records.select(F.struct(*records.columns).alias("_r"), F.col("code").alias("_code"))
    keyed = rows.withColumns({"_ring": text_or_empty(ring), "_fib": text_or_empty(fibre)})
    r = F.col("_r")
    other_cable = (r["cable"] != "") & (F.col("_fib") != "") & (r["cable"] != F.col("_fib"))
    shown = F.coalesce(null_if_empty(r["anillo_actual"]), r["anillo"])
    tail = [F.lit("|"), r["iluminacion"], F.lit("|"), r["fecha_cambio"]]
    answer = (
        F.when(F.col("_ring") == "", "SIN ANILLO")
        .when(r.isNull() | (other_cable & (r["igualar"] != "SI")), "SIN COINCIDENCIA")
        .when(r["anillo_actual"] == F.col("_ring"), F.concat(F.lit("V|"), r["anillo_actual"], *tail))
        .when(r["anillo"] == F.col("_ring"), F.concat(F.lit("F|"), shown, *tail))
        .otherwise("SIN COINCIDENCIA")
    )
    return (
        keyed.join(found, F.col("_ring") == F.col("_code"), "left")
        .withColumn(name, answer)
        .drop("_ring", "_fib", "_r", "_code")
    )


# --- explosions ------------------------------------------------------------------------

def position_tokens(*values: Column | str) -> Column:
    """Array of struct(original, token) over several position cells, split at ',' or '.'."""
    def of(c: Column) -> Column:
        tokens = F.transform(F.split(c, "[.,]"), strip)
        kept = F.filter(tokens, lambda t: t != "")
        return F.coalesce(
            F.transform(kept, lambda t: F.struct(c.alias("original"), t.alias("token"))),
            F.expr("cast(array() as array<struct<original:string,token:string>>)"),
        )

    return F.concat(*[of(as_column(v)) for v in values])


def explode_positions(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per position token; a row without any keeps one with 'SIN_POS'."""
    return (
        rows.withColumn("_tokens", position_tokens(*columns))
        .select("*", F.posexplode_outer("_tokens").alias("token_no", "_t"))
        .withColumns(
            {
                "pos_original": F.col("_t")["original"],
                "pos_token": F.coalesce(F.col("_t")["token"], F.lit(NO_POSITION)),
                "token_no": F.coalesce("token_no", F.lit(0)),
            }
        )
        .drop("_tokens", "_t")
    )


def patch_parts(patch: Column | str) -> Column:
    """struct(op, trays, letter, fault) of a patch value 'op-b1/b2'.

    ``fault`` names one of the shapes that cannot be read, else null. The letter is the
    first one found in any tray and serves all trays.
    """
    value = strip(patch)
    rest = strip(F.regexp_replace(value, "(?s)^[^-]*-", ""))
    trays = F.filter(F.transform(F.split(rest, "/"), strip), lambda t: t != "")
    letter = F.upper(F.regexp_extract(F.array_join(trays, "/"), "([A-Za-z])", 1))
    fault = (
        F.when(blank(patch), "F (sin PATCHEO)")
        .when(~value.contains("-"), "F (formato PATCHEO sin guion)")
        .when(F.size(trays) == 0, "F (PATCHEO sin bandejas)")
    )
    return F.struct(
        F.when(~blank(patch), strip(F.substring_index(value, "-", 1))).alias("op"),
        F.when(fault.isNull(), trays).alias("trays"),
        F.when(fault.isNull(), null_if_empty(letter)).alias("letter"),
        fault.alias("fault"),
    )


def explode_trays(rows: DataFrame, patch: str) -> DataFrame:
    """One row per tray of a patch value; unreadable values keep one row with ``fault``."""
    tray_number = F.regexp_extract("_tray", r"(\d+)", 1)
    return (
        rows.withColumn("_p", patch_parts(patch))
        .select("*", F.posexplode_outer(F.col("_p")["trays"]).alias("tray_no", "_tray"))
        .withColumns(
            {
                "op": F.col("_p")["op"],
                "cassetera": F.col("_p")["letter"],
                "fault": F.col("_p")["fault"],
                "bandeja": F.when(F.col("_tray").isNotNull(), tray_number),
                "tray_no": F.coalesce("tray_no", F.lit(0)),
            }
        )
        .drop("_p", "_tray")
    )


def explode_plus(rows: DataFrame, column: str, name: str = "bandeja") -> DataFrame:
    """One row per part of 'a+b'; an empty value keeps one row with null."""
    value = null_if_empty(strip(column))
    parts = F.filter(F.transform(F.split(value, r"\+"), strip), lambda p: p != "")
    return rows.select("*", F.posexplode_outer(parts).alias("tray_no", name)).withColumn(
        "tray_no", F.coalesce("tray_no", F.lit(0))
    )


# --- status ----------------------------------------------------------------------------

def patch_registry(op: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From matched sheets: (equipment, port) with a flag for any patch id, and its ids.

    Ids joined by '°' count one by one.
    """
    rows = op.select(
        strip("equipo").alias("_e"), strip("puerto").alias("_pt"), text_or_empty("id_port_pacheo").alias("_ids")
    ).filter("_e <> '' AND _pt <> ''")
    ids = rows.select(
        "_e", "_pt", F.explode(F.transform(F.split("_ids", "°"), strip)).alias("_one")
    ).filter("_one NOT IN ('', 'None')").distinct()
    flags = rows.groupBy("_e", "_pt").agg(F.bool_or(~F.col("_ids").isin("", "None")).alias("_any"))
    return flags, ids.withColumnsRenamed({"_e": "_ie", "_pt": "_ip"})


def with_sync_status(
    rows: DataFrame, op: DataFrame, equipment: str, port: str, patch_id: str, trunk_id: str,
    name: str = "sincroniza", separate_missing: bool = True,
) -> DataFrame:
    """Outcome of a matched row, the first that applies of seven.

    ``separate_missing``: a row without patch id has an outcome of its own; the older of
    the two studied variants counts it as an id that does not match.
    """
    flags, ids = patch_registry(op)
    eq, pt, pid = F.col(equipment), F.col(port), F.col(patch_id)
    missing = "F (sin ID_PORT_PACHEO en OP)" if separate_missing else "F (ID no coincide[93XX-C12])"
    status = (
        F.when(text_or_empty(trunk_id) == "", "F (sin ID_PORT_ODF-TRONCAL)")
        .when(blank(equipment) | blank(port), "F (equipo o interfaz vacío)")
        .when(F.col("_e").isNull(), "F (sin registro en OP)")
        .when(~F.col("_any"), "F (ID vacío en OP)")
        .when(pid.isNull(), missing)
        .when(F.col("_one").isNull(), "F (ID no coincide[93XX-C12])")
        .otherwise("V")
    )
    return (
        rows.join(flags, (eq == F.col("_e")) & (pt == F.col("_pt")), "left")
        .join(ids, (eq == F.col("_ie")) & (pt == F.col("_ip")) & (strip(pid) == F.col("_one")), "left")
        .withColumn(name, status)
        .drop("_e", "_pt", "_any", "_ie", "_ip", "_one")
    )


def mark_mixed_rings(rows: DataFrame, fibre: str, strand: str, ring: str, status: str) -> DataFrame:
    """Suffix on every row of a (fibre, strand) with more than one ring.

    More than one distinct value is the same as smallest <> largest: a plain aggregate.
    """
    ends = (
        rows.filter(F.col(ring).isNotNull() & F.col(fibre).isNotNull() & F.col(strand).isNotNull())
        .groupBy(fibre, strand)
        .agg(F.min(ring).alias("_low"), F.max(ring).alias("_high"))
        .filter("_low <> _high")
        .select(F.col(fibre).alias("_mf"), F.col(strand).alias("_ms"))
    )
    fault = F.lit("ERROR: Hilos con diferentes anillos")
    marked = F.when(blank(status), fault).otherwise(F.concat(F.col(status), F.lit(" - "), fault))
    return (
        rows.join(ends, (F.col(fibre) == F.col("_mf")) & (F.col(strand) == F.col("_ms")), "left")
        .withColumn(status, F.when(F.col("_mf").isNotNull(), marked).otherwise(F.col(status)))
        .drop("_mf", "_ms")
    )


def consolidated_lists(
    rows: DataFrame, lists: Mapping[str, str], order: Sequence[str], numeric: str | None = None,
    exclude: Sequence[str] = (), part_bytes: int = PART_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Rows that are equal but for the ``lists`` columns, and the list table of those columns.

    The first table has ``_key`` and the equal columns, the second ``_key``, ``lista``,
    ``part``, ``entries`` and ``texto``. ``lists`` maps a column to its separator. Values are
    listed once each in first-seen order; those of ``numeric`` keep repeats, drop what is not
    digits and are sorted as numbers. Nulls of the equal columns group together.
    """
    keys = [c for c in rows.columns if c not in lists and c not in order and c not in exclude]
    # Copies of a row are counted before the shuffle, and what was grouped is written once.
    once = cut_lineage(
        rows.groupBy(*keys, *lists).agg(F.min(F.struct(*order)).alias("_at"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_key", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
    )
    whole = once.select("_key", *keys).dropDuplicates(["_key"])
    digits = lambda c: F.when(c.rlike(r"^\d+$"), c.cast("decimal(38,0)"))
    each = []
    for name in lists:
        value = F.col(name).cast("string")
        number = digits(value) if name == numeric else F.lit(None).cast("decimal(38,0)")
        each.append(F.struct(
            F.lit(name).alias("lista"), number.alias("number"),
            (number.cast("string") if name == numeric else value).alias("value"),
            (F.col("_n") if name == numeric else F.lit(1).cast("bigint")).alias("copies"),
        ))
    values = (
        once.select("_key", "_at", F.explode(F.array(*each)).alias("_e")).select("_key", "_at", "_e.*")
        .filter("value IS NOT NULL")
        .groupBy("_key", "lista", "number", "value")
        .agg(F.min("_at").alias("_at"), F.sum("copies").alias("_copies"))
        .withColumn("_copy", F.explode(F.expr(
            f"sequence(1L, if(lista = '{numeric}', _copies, 1L))" if numeric else "sequence(1L, 1L)"
        )))
    )
    separator = F.lit("")
    for name, sep in lists.items():
        separator = F.when(F.col("lista") == name, sep).otherwise(separator)
    texts = ordered_text(
        values, ["_key", "lista"], F.col("value"), [F.col("number"), F.col("_at"), F.col("_copy")],
        separator, part_bytes, "texto",
    )
    return whole, texts


def consolidate(
    rows: DataFrame, lists: Mapping[str, str], order: Sequence[str], numeric: str | None = None,
    exclude: Sequence[str] = (), part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Rows that are equal but for the ``lists`` columns become one row.

    Each list cell holds part 0 of its list (``parte`` says so); :func:`consolidated_lists`
    has all parts.
    """
    whole, texts = consolidated_lists(rows, lists, order, numeric, exclude, part_bytes)
    cells = first_part(texts).groupBy("_key").agg(
        *[F.max(F.when(F.col("lista") == n, F.col("texto"))).alias(n) for n in lists]
    )
    return whole.join(cells, "_key", "left").select(
        *[c for c in whole.columns if c != "_key"], *[F.coalesce(F.col(n), F.lit("")).alias(n) for n in lists],
        F.lit(0).cast("bigint").alias("parte"),
    )


def fill_from_sheets(
    rows: DataFrame, sheets: DataFrame, equipment: str, port: str, header_id: str, status: str
) -> DataFrame:
    """Empty header ids filled from the equipment sheets; the last sheet row wins.

    ``sheets`` has equipo, puerto, id_port_cabecera and seq. Adds the flag ``rellenado``.
    """
    known = sheets.select(
        text_or_empty("equipo").alias("_e"), clean_port(text_or_empty("puerto")).alias("_p"),
        expand_exponent_id(text_or_empty("id_port_cabecera")).alias("_id"), "seq",
    ).filter("_e <> '' AND _p <> '' AND _id <> ''")
    lookup = last_wins(known, ["_e", "_p"], ["seq"], ["_id"])
    keyed = rows.withColumns(
        {"_re": text_or_empty(equipment), "_rp": clean_port(text_or_empty(port)),
         "_empty": text_or_empty(header_id).isin("", "nan", "None")}
    )
    filled = F.col("_empty") & F.col("_id").isNotNull()
    current = F.coalesce(F.col(status), F.lit(""))
    return (
        keyed.join(lookup, (F.col("_re") == F.col("_e")) & (F.col("_rp") == F.col("_p")), "left")
        .withColumns(
            {
                header_id: F.when(filled, F.col("_id")).otherwise(F.col(header_id)),
                status: F.when(
                    filled & (current.contains("F") | ~current.contains("V")), "V - usando EC (ID respaldo)"
                ).otherwise(F.col(status)),
                "rellenado": filled,
            }
        )
        .drop("_re", "_rp", "_empty", "_e", "_p", "_id")
    )


def tagged_remarks(remarks: DataFrame) -> DataFrame:
    state = F.lower(text_or_empty("estado"))
    return (
        remarks.select(
            text_or_empty("fibra").alias("_f"), text_or_empty("observacion").alias("_obs"), "seq",
            F.when(state.contains("error"), "OM").when(state.contains("bulk file"), "BULK").alias("_tag"),
        )
        .filter("_f <> '' AND _tag IS NOT NULL")
    )


def remark_lists(remarks: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """List table of the remarks of every fibre in row order: fibra, part, entries, observacion."""
    rows = tagged_remarks(remarks).filter("_obs <> ''").withColumnRenamed("_f", "fibra")
    return ordered_text(rows, ["fibra"], F.col("_obs"), [F.col("seq")], " | ", part_bytes, "observacion")


# What a row weighs beside its fibre's remarks when the rows are dealt, in bytes.
ROW_BYTES = 64


def append_remarks(
    rows: DataFrame, remarks: DataFrame, fibre: str, status: str, part_bytes: int = PART_BYTES
) -> DataFrame:
    """Prefixes OM and BULK and the remarks of a fibre around the status, joined ' | '.

    ``remarks`` has fibra, estado, observacion and seq. The status takes part 0 of the
    remarks (``parte`` says so); :func:`remark_lists` has all parts. Rows stay as many.

    A few fibres can hold all rows, and every row takes its fibre's text. The rows of a fibre
    are dealt over as many pieces as its share of all text is worth in tasks, so a task has
    the rows of few fibres, next to each other and the longest texts first. A writer then
    holds few distinct texts, and none that meets rows of a growing size: one that judges its
    page by the rows so far would let a page of short rows grow by thousands of long ones.
    """
    tags = tagged_remarks(remarks).groupBy("_f").agg(
        F.max(F.when(F.col("_tag") == "OM", "OM")).alias("_om"),
        F.max(F.when(F.col("_tag") == "BULK", "BULK")).alias("_bulk"),
    )
    texts = first_part(remark_lists(remarks, part_bytes)).select(
        F.col("fibra").alias("_f"), F.col("observacion").alias("_text")
    )
    # Written once: read for the sizes and for the texts.
    info = cut_lineage(tags.join(texts, "_f", "left"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumn("_key", strip(fibre))
    sizes = info.select("_f", F.coalesce(F.octet_length("_text"), F.lit(0)).alias("_bytes"))
    weighed = cut_lineage(
        keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"))
        .join(sizes, F.col("_key") == F.col("_f"), "left")
        .select(
            F.col("_key").alias("_w_key"), F.coalesce(-F.col("_bytes"), F.lit(1)).alias("_less"),
            (F.col("_rows") * (F.coalesce("_bytes", F.lit(0)) + ROW_BYTES)).alias("_weight"),
        )
    )
    everything = weighed.agg(F.sum("_weight")).first()[0] or 1
    shares = weighed.select(
        "_w_key", "_less", F.ceil(F.col("_weight") * F.lit(float(tasks)) / F.lit(float(everything))).alias("_pieces")
    )
    dealt = (
        keyed.join(shares, F.col("_key").eqNullSafe(F.col("_w_key")))
        .withColumn("_piece", F.pmod(F.xxhash64(*rows.columns), F.col("_pieces")))
        .drop("_w_key", "_pieces")
    )
    sent = (
        info.join(shares, F.col("_f") == F.col("_w_key"))
        .withColumn("_p", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1)))
        .withColumnRenamed("_less", "_l").drop("_w_key", "_pieces").hint("merge")
    )
    same = (F.col("_less") == F.col("_l")) & (F.col("_key") == F.col("_f")) & (F.col("_piece") == F.col("_p"))
    return (
        dealt.repartition(tasks, "_less", "_key", "_piece")
        .join(sent, same, "left")
        .withColumns(
            {
                status: F.when(
                    F.col("_f").isNotNull(),
                    F.concat_ws(" | ", "_om", "_bulk", F.when(~blank(status), F.col(status)), "_text"),
                ).otherwise(F.col(status)),
                "parte": F.lit(0).cast("bigint"),
            }
        )
        .drop("_f", "_om", "_bulk", "_text", "_key", "_less", "_l", "_piece", "_p")
    )
