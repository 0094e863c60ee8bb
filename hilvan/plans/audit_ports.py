"""Audit of ports with their shelf and bay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hilvan.functions import rules as R
from hilvan.functions.text import company_name, normalise_id, report_text, strip, text_or_empty
from hilvan.operators.groups import PART_BYTES, first_wins, last_wins, ordered_text
from hilvan.operators.sequence import state_sequence
from hilvan.plans.findings import findings, lookup, one, together, usable_rows
from hilvan.session import stored

# Logical column and header of a port export with shelf and bay columns.
COLUMNS = {
    "id": ["id"],
    "description": ["description"],
    "tipo_senal": ["tipo señal"],
    "physical_status": ["physical status"],
    "type": ["type"],
    "connector_type": ["connector type"],
    "unidad_ancho_banda": ["unidad ancho de banda"],
    "service_level": ["service level"],
    "proyecto_red": ["proyecto de red"],
    "id_servicio": ["id servicio"],
    "equipo_central": ["equipo central"],
    "puerto_central": ["puerto central"],
    "nombre_cliente": ["nombre cliente"],
    "direccion_cliente_id": ["direccion cliente id"],
    "comentarios": ["comentarios"],
    "anillo": ["anillo"],
    "cambio_service_manager": ["cambio service manager"],
    "name_building": ["name_building", "name building"],
    "building_id": ["building.id", "building id"],
    "shelf_id": ["id shelf"],
    "shelf_description": ["description shelf"],
    "construction_status": ["construction status"],
    "shelf_tipo": ["tipo"],
    "shelf_tecnologia": ["tecnologia"],
    "shelf_ip": ["direccion ip"],
    "shelf_nivel": ["nivel en bastidor"],
    "contratista": ["contratista"],
    "shelf_migracion": ["migracion olt"],
    "bay_id": ["bay.id"],
    "bay_number": ["number"],
    "bay_description": ["description bay"],
    "bay_salon": ["numero de salon"],
    "bay_fila": ["numero de fila"],
}
NO_DESCRIPTION = "Sin descripción"
# Columns that no rule reads once the client's name is judged.
NAMING = (
    "description", "physical_status", "nombre_cliente", "comentarios", "building", "_n_buildings", "client_norm",
    "building_norm",
)


def building_names(buildings: DataFrame) -> DataFrame:
    """(building_id, building): upper-case name per id, the last row wins."""
    rows = buildings.select(
        normalise_id("id").alias("building_id"), F.upper(text_or_empty("nombre")).alias("building"), "seq"
    ).filter("building_id <> '' AND building <> ''")
    return last_wins(rows, ["building_id"], ["seq"], ["building"])


def prepare(ports: DataFrame, excluded: DataFrame | None, buildings: DataFrame) -> DataFrame:
    """Usable ports with central kind, client's building name and number of buildings.

    A port without a known building gets the building whose normalised name equals the
    client's; of several the smallest id is taken.
    """
    rows = usable_rows(ports, excluded, status=None).withColumns(
        {
            "cliente": report_text("nombre_cliente"),
            "building_id": normalise_id("building_id"),
            "shelf_id": normalise_id("shelf_id"),
            "bay_id": normalise_id("bay_id"),
            "central": R.central_kind("shelf_description"),
            "desc": text_or_empty("description"),
            "ps": F.when(F.upper(strip("physical_status")) == "IS", "IN SERVICE").otherwise(F.col("physical_status")),
        }
    ).withColumn("_client_key", F.upper("cliente"))
    spread = lookup(
        rows.filter("_client_key <> '' AND building_id <> ''")
        .groupBy("_client_key").agg(F.count_distinct("building_id").alias("_n_buildings"))
        .withColumnRenamed("_client_key", "_spread_key")
    )
    names = lookup(building_names(buildings).withColumn("_norm", company_name("building")))
    by_name = lookup(first_wins(names, ["_norm"], ["building_id"], ["building"]).withColumnRenamed("building", "_by_name"))
    own = names.withColumnsRenamed({"building_id": "_bid", "building": "_own", "_norm": "_own_norm"})
    return (
        rows.join(spread, F.col("_client_key") == F.col("_spread_key"), "left")
        .join(own, F.col("building_id") == F.col("_bid"), "left")
        .withColumn("client_norm", company_name("cliente"))
        .withColumn("_wanted", F.when(F.col("_own").isNull(), F.col("client_norm")))
        .join(by_name, F.col("_wanted") == F.col("_norm"), "left")
        .withColumn("building", F.coalesce("_own", "_by_name"))
        .withColumn("building_norm", F.coalesce("_own_norm", "_norm", F.lit("")))
        .drop("_client_key", "_spread_key", "_bid", "_own", "_own_norm", "_norm", "_wanted", "_by_name")
    )


def port_messages() -> Column:
    """All messages of a client port except the client-name fault."""
    c = F.col
    equipment, port = R.central_equipment("equipo_central"), R.central_port("puerto_central")
    in_service = F.upper(strip("ps")) == "IN SERVICE"
    fields = (
        (text_or_empty("tipo_senal"), "TIPO SEÑAL"), (c("desc"), "DESCRIPTION"), (c("ps"), "PHYSICAL STATUS"),
        (c("type"), "TYPE"), (c("connector_type"), "CONNECTOR TYPE"), (c("proyecto_red"), "PROYECTO DE RED"),
        (c("anillo"), "ANILLO"), (c("cambio_service_manager"), "CAMBIO SERVICE MANAGER"),
        (c("equipo_central"), "EQUIPO CENTRAL"), (c("puerto_central"), "PUERTO CENTRAL"),
        (text_or_empty("name_building"), "NAME BUILDING"), (c("building_id"), "BUILDING ID"),
        (c("direccion_cliente_id"), "DIRECCION CLIENTE"), (c("cliente"), "NOMBRE CLIENTE"),
    )
    return R.all_of(
        *[R.whitespace(value, name) for value, name in fields],
        F.when(
            F.coalesce(in_service, F.lit(False)),
            R.in_service_port(
                "direccion_cliente_id", "proyecto_red", "anillo", "cambio_service_manager", "id_servicio"
            ),
        ).otherwise(R.no_messages()),
        R.messages(
            (equipment != R.VALID, R.text("EQUIPO CENTRAL (", strip("equipo_central"), ")")),
            (port != R.VALID, R.text("PUERTO CENTRAL (", strip("puerto_central"), ")")),
        ),
        R.closed_vocabularies(
            text_or_empty("tipo_senal"), "type", "connector_type", "service_level", "ps", "unidad_ancho_banda",
        ),
    )


def audit_ports(
    ports: DataFrame, buildings: DataFrame, excluded: DataFrame | None = None, part_bytes: int = PART_BYTES
) -> DataFrame:
    """All findings of ports, shelves and bays.

    ``ports`` has the columns of ``COLUMNS`` and seq; ``buildings`` id, nombre, seq. A
    port with a client-name fault is not checked further, nor are its shelf and bay.
    """
    # Written once: five branches read it, and filters on the name fault would otherwise
    # run all of its patterns again.
    rows = stored(
        prepare(ports, excluded, buildings).withColumn(
            "_name_fault",
            R.client_name(
                "cliente", "ps", "comentarios", F.col("building"), F.col("_n_buildings"),
                F.col("client_norm"), F.col("building_norm"),
            ),
        ).drop(*NAMING)
    )
    central = rows.filter("central IS NOT NULL")
    client = rows.filter("central IS NULL")
    checked = client.filter("_name_fault IS NULL")
    shown = F.when(F.col("desc") == "", NO_DESCRIPTION).otherwise(F.col("desc"))
    raw = _port_rows(
        central.withColumn("shelf_id", F.lit("")), shown, R.central_port_type("type"), 40
    ).unionByName(
        _port_rows(client.filter("_name_fault IS NOT NULL"), text_or_empty("cliente"), one(F.col("_name_fault")), 41)
    )
    raw = raw.unionByName(_port_rows(checked, shown, together(port_messages()), 41)).unionByName(
        sequence_rows(client, central)
    )
    return (
        group_by_shelf(raw, part_bytes)
        .unionByName(shelf_findings(checked, central, excluded))
        .unionByName(bay_findings(checked, excluded))
    )


def _port_rows(rows: DataFrame, shown: Column, messages: Column, stage: int) -> DataFrame:
    # As in findings(): the messages are a column before they are exploded.
    made = rows.select("id", "shelf_id", shown.alias("shown"), "seq", messages.alias("_messages"))
    return made.select(
        "id", "shelf_id", "shown", "seq", F.lit(stage).alias("stage"), F.explode_outer("_messages").alias("message"),
    ).filter("message IS NOT NULL")


def sequence_rows(client: DataFrame, central: DataFrame) -> DataFrame:
    """Breaks of 'in service first' along the port numbers of each client shelf."""
    central_shelves = central.select("shelf_id").filter("shelf_id <> ''").distinct()
    numbered = (
        client.filter(F.col("desc").rlike(r"^\d+$") & (F.col("shelf_id") != ""))
        .join(central_shelves, "shelf_id", "left_anti")
        .withColumn("number", F.col("desc").try_cast("bigint"))
        .filter("number IS NOT NULL")
    )
    broken = state_sequence(
        numbered, ["shelf_id"], "number", ["seq", "id"], F.upper(strip("ps")) == "IN SERVICE", ["desc"]
    )
    message = F.when(F.col("last_number").isNull(), "SECUENCIA: SIN_IN_SERVICE").otherwise(
        R.text("SECUENCIA: SPARE_ANTES_DE_IN_SERVICE (puerto ", F.col("number"), ", último ", F.col("last_number"), ")")
    )
    return _port_rows(broken, F.col("desc"), one(message), 42)


def group_by_shelf(raw: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Ports of a shelf with the same message as one finding; ids joined ' , '.

    A port without shelf stands alone. A further part of a list of ids is a further
    finding, and ``pos`` is the part.
    """
    # Ids and first rows both come from it: the whole port audit is run once.
    raw = stored(raw)
    keyed = raw.withColumn("_group", F.when(F.col("shelf_id") == "", F.concat(F.lit("\0"), "id")).otherwise(F.col("shelf_id")))
    keys = ["_group", "message"]
    ids = ordered_text(keyed, keys, F.col("id"), [F.col("stage"), F.col("seq")], " , ", part_bytes, "ids", written=True)
    first = keyed.groupBy(*keys).agg(
        F.min(F.struct("stage", "seq", "shown")).alias("_first")
    ).select(*keys, "_first.*")
    return ids.join(first, keys).select(
        F.lit("PORT").alias("entity"), F.col("ids").alias("id"), F.col("shown").alias("value"), F.lit("").alias("owner"),
        "message", F.lit(40).alias("stage"), F.col("seq").cast("bigint"), F.col("part").cast("int").alias("pos"),
    )


def shelf_findings(checked: DataFrame, central: DataFrame, excluded: DataFrame | None) -> DataFrame:
    """Shelf rules on client ports, and the type of central shelves."""
    c, t = F.col, text_or_empty
    shown = R.text("SHELF: ", F.when(t("shelf_description") == "", NO_DESCRIPTION).otherwise(t("shelf_description")))
    rules = R.shelf(
        t("shelf_description"), t("construction_status"), t("contratista"), t("shelf_tecnologia"),
        t("shelf_ip"), t("shelf_nivel"), t("shelf_migracion"), c("bay_id"),
    )
    rows = usable_ids(checked, "shelf_id", excluded)
    own = findings(rows, "SHELF", 50, together(rules), id="shelf_id", value=shown, owner=F.lit(""))
    types = findings(
        central, "SHELF", 51, R.central_shelf_type(c("central"), "shelf_tipo"),
        id=F.when(c("shelf_id") == "", c("id")).otherwise(c("shelf_id")), value=shown, owner=F.lit(""),
    )
    return own.unionByName(types)


def bay_findings(checked: DataFrame, excluded: DataFrame | None) -> DataFrame:
    c, t = F.col, text_or_empty
    shown = R.text("BAY: ", F.when(t("bay_description") == "", NO_DESCRIPTION).otherwise(t("bay_description")))
    rules = R.bay(
        t("bay_description"), t("bay_number"), t("construction_status"), t("bay_salon"), t("bay_fila"),
        t("contratista"), c("building_id"),
    )
    rows = usable_ids(checked, "bay_id", excluded)
    return findings(rows, "BAY", 52, together(rules), id="bay_id", value=shown, owner=F.lit(""))


def usable_ids(rows: DataFrame, column: str, excluded: DataFrame | None) -> DataFrame:
    known = rows.filter(F.col(column) != "")
    if excluded is None:
        return known
    return known.join(
        excluded.select(normalise_id("id").alias("_ex")), F.col(column) == F.col("_ex"), "left_anti"
    )
