"""Keyed edits, deletes and lookups with a status for every input line."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hilvan.functions.text import as_column, literal_regex

OK = "EXITOSO"
NOT_READ = "SIN_PROCESAR"


@dataclass(frozen=True)
class Edit:
    """One kind of bulk edit: which field of which table, and how a line reads."""

    table: str
    column: str
    kind: str = "string"  # string, number or date
    separator: str = "|"
    verify: bool = False
    log: str = "all"  # all or success
    texts: Mapping[str, str] = field(default_factory=dict)
    max_lines: int | None = None


# Failure texts by reason.
PLAIN = {"format": "FALLIDO", "missing": "FALLIDO", "cast": "FALLIDO"}
VERIFIED = {
    "format": "FALLIDO|FORMATO_INCORRECTO",
    "missing": "FALLIDO|NO_ENCONTRADO",
    "cast": "FALLIDO|ERROR_EN_EJECUCION",
    "unchanged": "FALLIDO|NO_CAMBIO",
}
NUMBERED = VERIFIED | {"cast": "FALLIDO|ERROR: valor no numérico"}
ADDRESS = {
    "format": "FALLIDO - Formato incorrecto",
    "missing": "FALLIDO - Puerto no encontrado",
    "cast": "FALLIDO - Error en actualización",
}
DATED = PLAIN | {"cast": "FALLIDO - fecha no parseable"}

# The bulk edits that exist, by name.
EDITS: dict[str, Edit] = {
    "port_client_name": Edit("port", "nombre_cliente"),
    "port_description": Edit("port", "description"),
    "port_service_change": Edit("port", "cambio_serv_man"),
    "port_client_address": Edit("port", "direccion_cliente_id", "number", texts=ADDRESS),
    "port_contractor": Edit("port", "contratista"),
    "port_bandwidth_unit": Edit("port", "unidad_ancho_banda"),
    "port_bandwidth": Edit("port", "ancho_de_banda", "number"),
    "port_service_id": Edit("port", "id_servicio"),
    "port_signal_type": Edit("port", "tipo_senial"),
    "port_spec": Edit("port", "spec_id", separator="&&&"),
    "port_type": Edit("port", "type"),
    "port_status": Edit("port", "physical_status"),
    "port_service_level": Edit("port", "service_level"),
    "port_connector_type": Edit("port", "connector_type"),
    "port_service_type": Edit("port", "tipo_servicio"),
    "port_central_equipment": Edit("port", "equipo_central"),
    "port_central_port": Edit("port", "puerto_central"),
    "port_network_project": Edit("port", "proyecto_red"),
    "port_provision_date": Edit("port", "fecha_aprovisionamiento", "date", texts=DATED),
    "splice_name": Edit("splice", "name"),
    "splice_spec": Edit("splice", "spec_id"),
    "splice_status": Edit("splice", "construction_status", separator="&&&"),
    "splice_municipality": Edit("splice", "municipio_id", "number", verify=True),
    "cable_status": Edit("cable", "construction_status"),
    "cable_name": Edit("cable", "name"),
    "cable_old_name": Edit("cable", "nombre_antiguo"),
    "cable_placement": Edit("cable", "colocacion_type"),
    "cable_spec": Edit("cable", "spec_id"),
    "cable_municipality": Edit("cable", "municipio_b_id", "number", verify=True, texts=NUMBERED),
    "cable_node": Edit("cable", "mit_hub_id1", "number", verify=True, texts=NUMBERED),
    "building_name": Edit("building", "name"),
    "building_type": Edit("building", "type", separator="&&&"),
    "building_comments": Edit("building", "comentarios"),
    "building_feasibility": Edit("building", "no_factibilidad"),
    "building_category": Edit("building", "tipo_categoria"),
    "building_address": Edit("building", "direccion_cliente_id"),
    "bay_number": Edit("bay", "number"),
    "bay_row": Edit("bay", "no_fila"),
    "bay_room": Edit("bay", "no_salon"),
    "shelf_type": Edit("shelf", "tipo"),
    "shelf_status": Edit("shelf", "construction_status"),
    "shelf_address": Edit("shelf", "direccion_ip"),
    "shelf_level": Edit("shelf", "nivel_en_bastidor"),
    "aerial_route_owner": Edit("aerial_route", "owner", separator="&&&"),
    "pole_status": Edit("pole", "construction_status", separator="&&&"),
    "pole_usage": Edit("pole", "usage", separator="&&&", log="success"),
}


def split_line(line: Column | str, separator: str) -> Column:
    return F.split(as_column(line), literal_regex(separator))


def cast_value(text: Column, kind: str) -> Column:
    """Empty text is an empty value; text that does not cast gives null."""
    if kind == "number":
        return F.nullif(text, F.lit("")).try_cast("decimal(38,6)")
    if kind == "date":
        return F.coalesce(
            F.try_to_timestamp(text, F.lit("dd/MM/yyyy")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))
        ).cast("date")
    return text


def _cast_ok(text: Column, kind: str) -> Column:
    if kind == "string":
        return F.lit(True)
    parsed = cast_value(text, kind).isNotNull()
    return parsed if kind == "date" else parsed | (text == "")


def read_changes(
    lines: DataFrame, kinds: Sequence[str], separator: str, max_lines: int | None = None
) -> DataFrame:
    """Adds ``_fields``, ``_arity_ok``, ``_id`` and ``_read`` to lines ``(line_no, line)``.

    Lines past ``max_lines`` are not read but stay in the ledger; the studied scripts
    lose them when they rewrite the file.
    """
    parts = split_line("line", separator)
    return lines.withColumns(
        {
            "_fields": parts,
            "_arity_ok": F.size(parts) == len(kinds) + 1,
            "_id": F.get(parts, 0).try_cast("bigint"),
            "_read": F.lit(True) if max_lines is None else F.col("line_no") <= max_lines,
        }
    )


def known_ids(target: DataFrame, parsed: DataFrame, key: str) -> DataFrame:
    """Ids (``_known``) that lines ask for and the table holds.

    The table's keys meet the few asked ids first, so they are neither shuffled for a few
    lines nor made distinct as a whole.
    """
    asked = parsed.filter("_id IS NOT NULL").select("_id").distinct()
    return target.join(asked, F.col(key) == F.col("_id"), "left_semi").select(F.col(key).alias("_known")).distinct()


def bulk_update(
    target: DataFrame, lines: DataFrame, edit: Edit, key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Applies ``id<sep>value`` lines to one field.

    Returns the updated table, with as many rows as before, and the ledger
    ``(line_no, line, status, ledger_line)``. The last good line of an id wins. Both
    joins are on the id; the side of changed ids is reduced to one row per id, so a
    repeated id cannot multiply target rows.
    """
    texts = {**(VERIFIED if edit.verify else PLAIN), **edit.texts}
    value = F.get("_fields", 1)
    column_type = dict(target.dtypes)[edit.column]
    parsed = (
        read_changes(lines, [edit.kind], edit.separator, edit.max_lines)
        .withColumn("_cast_ok", F.coalesce(_cast_ok(value, edit.kind), F.lit(False)))
        .withColumn("_value", cast_value(value, edit.kind).try_cast(column_type))
        .withColumn("_asked", cast_value(value, edit.kind))
    )
    known = known_ids(target, parsed, key)
    checked = parsed.join(known, F.col("_id") == F.col("_known"), "left")
    status = (
        F.when(~F.col("_read"), F.lit(NOT_READ))
        .when(~F.col("_arity_ok"), texts["format"])
    )
    if edit.kind == "date":  # the date is parsed before the record is looked up
        status = status.when(~F.col("_cast_ok"), texts["cast"])
    status = status.when(F.col("_known").isNull(), texts["missing"]).when(
        ~F.col("_cast_ok"), texts["cast"]
    )
    if edit.verify:
        # Read back: the field may hold less than what was asked for.
        stored = F.col("_value").cast(dict(parsed.dtypes)["_asked"])
        status = status.when(~stored.eqNullSafe(F.col("_asked")), texts["unchanged"])
    ledger = checked.withColumn("status", status.otherwise(OK))
    changes = (
        ledger.filter(F.col("status") == OK)
        .groupBy("_id")
        .agg(F.max_by(F.struct("_value"), "line_no").alias("_change"))
    )
    updated = target.join(changes, F.col(key) == F.col("_id"), "left").withColumn(
        edit.column,
        F.when(F.col("_change").isNotNull(), F.col("_change")["_value"]).otherwise(F.col(edit.column)),
    ).select(*target.columns)
    log = ledger.select(
        "line_no", "line", "status", F.concat_ws(edit.separator, "line", "status").alias("ledger_line")
    )
    return updated, log.filter(F.col("status") == OK) if edit.log == "success" else log


# Fields of a merge line after the id, and the order in which the fields
# are written and reported.
MERGE_FIELDS = (
    ("physical_status", "string"),
    ("type", "string"),
    ("connector_type", "string"),
    ("tipo_senial", "string"),
    ("ancho_de_banda", "number"),
    ("unidad_ancho_banda", "string"),
    ("proyecto_red", "string"),
    ("cambio_serv_man", "string"),
    ("fecha_aprovisionamiento", "date"),
    ("contratista", "string"),
    ("id_servicio", "string"),
    ("equipo_central", "string"),
    ("puerto_central", "string"),
    ("tipo_servicio", "string"),
    ("nombre_cliente", "string"),
    ("direccion_cliente_id", "number"),
    ("comentarios", "string"),
)
MERGE_REPORT = (
    "type", "physical_status", "connector_type", "tipo_senial", "ancho_de_banda",
    "unidad_ancho_banda", "proyecto_red", "cambio_serv_man", "fecha_aprovisionamiento",
    "direccion_cliente_id", "contratista", "id_servicio", "equipo_central", "puerto_central",
    "tipo_servicio", "nombre_cliente", "comentarios",
)


def bulk_merge(
    target: DataFrame, lines: DataFrame, fields: Sequence[tuple[str, str]] = MERGE_FIELDS,
    report: Sequence[str] = MERGE_REPORT, key: str = "id", separator: str = "|",
    max_lines: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Applies lines that set many fields; each field stands or fails on its own.

    A line needs the id and every field (18 with the usual ones; the failure text says
    17, as it does in the studied script). An empty date clears the field.
    """
    kinds = [kind for _, kind in fields]
    parsed = read_changes(lines, kinds, separator, max_lines)
    for i, (name, kind) in enumerate(fields, start=1):
        text = F.get("_fields", i)
        fine = F.coalesce(_cast_ok(text, kind) | (text == ""), F.lit(False))
        parsed = parsed.withColumn(f"_ok_{name}", fine).withColumn(
            f"_v_{name}", cast_value(text, kind).try_cast(dict(target.dtypes)[name])
        )
    known = known_ids(target, parsed, key)
    checked = parsed.join(known, F.col("_id") == F.col("_known"), "left")
    outcome = F.concat_ws(
        ", ",
        *[
            F.concat(F.lit(f"{n}:"), F.when(F.col(f"_ok_{n}"), "OK").otherwise("ERROR"))
            for n in report
        ],
    )
    every = F.lit(True)
    for name, _ in fields:
        every = every & F.col(f"_ok_{name}")
    short = F.concat(
        F.lit("FALLIDO_CAMPOS_INSUFICIENTES (se esperaban 17, se recibieron "),
        F.size("_fields").cast("string"), F.lit(")"),
    )
    ledger = checked.withColumn(
        "status",
        F.when(~F.col("_read"), F.lit(NOT_READ))
        .when(~F.col("_arity_ok"), short)
        .when(F.col("_known").isNull(), "ID_NO_ENCONTRADO")
        .when(every, "GS_EXITOSOS")
        .otherwise(F.concat(F.lit("CAMPOS_PARCIALES|"), outcome)),
    )
    applied = ledger.filter(F.col("_read") & F.col("_arity_ok") & F.col("_known").isNotNull())
    changes = applied.groupBy("_id").agg(
        *[
            F.max_by(F.struct(F.col(f"_v_{n}").alias("v")), F.when(F.col(f"_ok_{n}"), F.col("line_no"))).alias(f"_c_{n}")
            for n, _ in fields
        ]
    )
    updated = target.join(changes, F.col(key) == F.col("_id"), "left").withColumns(
        {
            n: F.when(F.col(f"_c_{n}").isNotNull(), F.col(f"_c_{n}")["v"]).otherwise(F.col(n))
            for n, _ in fields
        }
    ).select(*target.columns)
    log = ledger.select(
        "line_no", "line", "status", F.concat_ws(separator, "line", "status").alias("ledger_line")
    )
    return updated, log


def ledger_counters(ledger: DataFrame) -> DataFrame:
    """Lines per kind of status."""
    kind = F.regexp_extract("status", r"^([A-Z_]+)", 1)
    return ledger.groupBy(kind.alias("status")).agg(F.count(F.lit(1)).alias("lines"))


def bulk_delete(
    target: DataFrame, lines: DataFrame, key: str = "id", separator: str = "|"
) -> tuple[DataFrame, DataFrame]:
    """Deletes one id per line. A second line with the same id finds nothing."""
    parsed = lines.withColumn("_id", F.trim("line").try_cast("bigint"))
    known = known_ids(target, parsed, key)
    hits = (
        parsed.filter("_id IS NOT NULL").groupBy("_id").agg(F.min("line_no").alias("_first"))
        .join(known, F.col("_id") == F.col("_known"))
        .select(F.col("_id").alias("_hit"), "_first")
    )
    ledger = parsed.join(
        hits, (F.col("_id") == F.col("_hit")) & (F.col("line_no") == F.col("_first")), "left"
    ).withColumn("status", F.when(F.col("_hit").isNotNull(), OK).otherwise("FALLIDO"))
    left = target.join(hits, F.col(key) == F.col("_hit"), "left_anti")
    return left, ledger.select(
        "line_no", "line", "status", F.concat_ws(separator, "line", "status").alias("ledger_line")
    )


def upsert(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows replace stored rows with the same keys; new keys are added.

    Only keys that exist in the data count. Repeated keys in one batch are an error, as
    for an insert with conflict handling. Rows with a null key never conflict.
    """
    usable = [k for k in keys if k in incoming.columns]
    if not usable:
        raise ValueError(f"none of the keys {list(keys)} in columns {incoming.columns}")
    known = F.lit(True)
    for k in usable:
        known = known & F.col(k).isNotNull()
    repeated = incoming.filter(known).groupBy(*usable).count().filter("count > 1")
    example = repeated.limit(1).collect()
    if example:
        raise ValueError(f"key repeated within one batch: {example[0].asDict()}")
    kept = stored.join(incoming.select(*usable), usable, "left_anti")
    return kept.unionByName(incoming.select(*stored.columns))


@dataclass(frozen=True)
class Lookup:
    """A point lookup: search column, result column and the texts around them."""

    column: str
    kind: str  # number or string
    hit: str  # uses {line}, {id} and {value}
    miss: str
    value: str = "name"


# The lookups that exist, with their output texts.
LOOKUPS: dict[str, Lookup] = {
    "cable_by_id": Lookup("id", "number", '"{line}"|{value}', "{line}&!"),
    "cable_comments": Lookup("id", "number", '"{line}"|{value}', "{line}&!", "description"),
    "cable_contractor": Lookup("id", "number", '"{line}"|{value}', "{line}&!", "contratista"),
    "cable_by_name": Lookup("name", "string", "{id}|{line}", "N/A {line}"),
    "cable_by_old_name": Lookup("nombre_antiguo", "string", '"{id}"|{line}', "N/A {line}"),
    "building_by_id": Lookup("id", "number", '"{line}"|{value}', "{line}&!"),
    "building_by_name": Lookup("name", "string", "{id}&{line}", "N/A {line}"),
    "building_name": Lookup("id", "number", "{line},{value}", "{line}&N/A"),
    "port_by_service_id": Lookup("id_servicio", "string", "{id}|{line}", "N/A {line}"),
    "port_by_service_change": Lookup("cambio_serv_man", "string", "{id}|{line}", "N/A {line}"),
}


def find(target: DataFrame, lines: DataFrame, lookup: Lookup, key: str = "id") -> DataFrame:
    """One output line per input line.

    Of several records with the searched value the smallest id is taken (the studied
    scripts take any). The target is reduced to one row per searched value first, and
    only to values that are asked for.
    """
    asked = F.col("line").try_cast("bigint") if lookup.kind == "number" else F.col("line")
    wanted = lines.withColumn("_asked", asked)
    value = lookup.value if lookup.value in target.columns else key
    hits = (
        target.join(wanted.select("_asked"), F.col(lookup.column) == F.col("_asked"), "left_semi")
        .groupBy(F.col(lookup.column).alias("_searched"))
        .agg(F.min_by(F.struct(F.col(key).alias("id"), F.col(value).alias("value")), key).alias("_hit"))
    )

    def fill(template: str) -> Column:
        pieces = {"line": F.col("line"), "id": F.col("_hit")["id"], "value": F.col("_hit")["value"]}
        out, rest = [], template
        while rest:
            start = rest.find("{")
            if start < 0:
                out.append(F.lit(rest))
                break
            if start:
                out.append(F.lit(rest[:start]))
            end = rest.index("}")
            out.append(F.coalesce(pieces[rest[start + 1 : end]].cast("string"), F.lit("")))
            rest = rest[end + 1 :]
        return F.concat(*out)

    return wanted.join(hits, F.col("_asked") == F.col("_searched"), "left").select(
        "line_no", "line",
        F.when(F.col("_hit").isNotNull(), fill(lookup.hit)).otherwise(fill(lookup.miss)).alias("output"),
    )
