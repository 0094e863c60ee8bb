"""Audit of cables (fibres): names, attributes, nodes, and values against their cable."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hilvan.functions import rules as R
from hilvan.functions.text import (
    construction_status,
    extract,
    fibre_base_name,
    normalise_id,
    strand_count,
    strip,
    text_or_empty,
)
from hilvan.operators.groups import first_wins, last_wins, minority_rows, pooled_majority
from hilvan.plans.findings import findings, one, percent, usable_rows
from hilvan.session import stored

ENTITY = "FIBRA"

# Logical column and header of a cable export.
COLUMNS = {
    "id": ["id text"],
    "nombre": ["name"],
    "colocacion": ["colocacion type"],
    "especificacion": ["nombre especificación"],
    "propietario": ["propietario"],
    "estado": ["construction status"],
    "nombre_ant": ["nombre antiguo"],
    "nodo_a": ["nodo a"],
    "nodo_b": ["nodo b"],
    "municipio_a": ["municipio a id"],
    "municipio_b": ["municipio b id"],
}


def prepare(cables: DataFrame, excluded: DataFrame | None = None, decode: bool = True) -> DataFrame:
    """Usable rows with trimmed text, the base name and the spelled-out status."""
    name = text_or_empty("nombre")
    return usable_rows(cables, excluded).select(
        "id", "seq", name.alias("nombre"),
        F.when(name.contains("/"), strip(F.substring_index(name, "/", 1))).otherwise(name).alias("base_raw"),
        text_or_empty("colocacion").alias("tipo"),
        text_or_empty("especificacion").alias("esp_raw"),
        F.lower(text_or_empty("especificacion")).alias("esp"),
        text_or_empty("propietario").alias("prop"),
        construction_status("estado", decode).alias("est"),
        "nombre_ant",
        *[normalise_id(c).alias(c) for c in ("nodo_a", "nodo_b", "municipio_a", "municipio_b")],
    ).withColumn("base", fibre_base_name("base_raw"))


def audit_cables(
    cables: DataFrame, owners: DataFrame, valid_owner: str, excluded: DataFrame | None = None,
    nodes: DataFrame | None = None, decode: bool = True,
) -> DataFrame:
    """All findings of cables.

    ``cables`` has the logical columns of ``COLUMNS`` and seq; ``owners`` (owner_key,
    owner); ``nodes`` the node rules (validacion, troncal, ids_distribucion, seq).
    """
    return prepared_findings(stored(prepare(cables, excluded, decode)), owners, valid_owner, nodes)


def prepared_findings(
    rows: DataFrame, owners: DataFrame, valid_owner: str, nodes: DataFrame | None = None
) -> DataFrame:
    """All findings of the rows of :func:`prepare`, which are read by every rule: store them first."""
    parts = [
        attribute_findings(rows, owners, valid_owner),
        trunk_findings(rows, owners),
        municipality_findings(rows, owners),
    ]
    if nodes is not None:
        parts.append(node_findings(rows, node_rules(nodes)))
    return reduce(DataFrame.unionByName, parts)


def attribute_findings(rows: DataFrame, owners: DataFrame, valid_owner: str) -> DataFrame:
    c = F.col
    messages = R.all_of(
        R.whitespace("nombre", "NOMBRE"),
        R.whitespace("tipo", "COLOCACION"),
        R.whitespace("esp_raw", "ESPECIFICACION"),
        R.whitespace("prop", "PROPIETARIO"),
        R.whitespace("est", "ESTADO"),
        R.whitespace("nombre_ant", "NOMBRE_ANTIGUO"),
        R.cable_name("nombre", "tipo"),
        R.cable_attributes(
            c("nombre"), c("tipo"), c("esp"), c("prop"), c("est"), c("nombre_ant"),
            strand_count("esp_raw"), valid_owner,
        ),
    )
    return findings(rows, ENTITY, 10, messages, owners=owners, key=c("base"))


def trunk_findings(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Trunk cables whose specification or status differs from the cable's majority."""
    trunk = rows.filter(
        ~F.col("nombre").contains("-") & F.col("tipo").isin(*R.TRUNK_TYPES) & (F.col("base") != "")
    ).select("id", "nombre", "base", "esp", "est", "seq")
    spec = minority_rows(trunk, ["base"], "esp", ["seq"]).withColumn(
        "_m",
        R.text("MERGE | Cable '", F.col("base"), "' tiene mayoría '", F.col("majority"), "' | MAYORÍA: '",
               F.col("majority"), "' , ACTUAL: '", F.col("esp"), "'"),
    )
    status = minority_rows(trunk, ["base"], "est", ["seq"]).withColumn(
        "_m",
        R.text("STATUS ADMITIDOS (En servicio/Plan Abandono/Futuro) | MAYORÍA: '", F.col("majority"),
               "' , ACTUAL: '", F.col("est"), "'"),
    )
    cols = ["id", "nombre", "base", "seq", "_m"]
    both = spec.select(*cols).withColumn("_s", F.lit(0)).unionByName(status.select(*cols).withColumn("_s", F.lit(1)))
    return findings(both, ENTITY, 12, one(F.col("_m")), owners=owners, key=F.col("base"))


def municipality_findings(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Ends in another municipality than most ends of the same cable number.

    Cables with any trunk section are left out.
    """
    numbered = rows.withColumn("cable", extract(F.col("nombre"), r"^(\d+)")).filter("cable IS NOT NULL")
    trunk = F.col("tipo").isin(*R.TRUNK_TYPES)
    with_trunk = numbered.filter(trunk).select("cable").distinct()
    local = numbered.join(with_trunk, "cable", "left_anti").select(
        "id", "nombre", "cable", "municipio_a", "municipio_b", "seq"
    )
    usual = pooled_majority(local, ["cable"], ["municipio_a", "municipio_b"], ["seq"]).select(
        "cable", F.col("majority").alias("_usual"), percent(F.col("percent")).alias("_pct")
    )

    def end(which: str):
        value = F.col(f"municipio_{which.lower()}")
        usual_text = [F.col("_usual"), "' (", F.col("_pct"), "%)"]
        return [
            (value == "", R.text("MUNICIPIO (Vacío) | SUGERIDO: '", *usual_text)),
            ((value != "") & (value != F.col("_usual")),
             R.text(f"MUNICIPIO {which} INCONSISTENTE | Municipio {which} '", value,
                    "' no coincide con predominante '", *usual_text)),
        ]

    return findings(
        local.join(usual, "cable"), ENTITY, 13, R.messages(*end("A"), *end("B")), owners=owners, key=F.col("cable")
    )


# --- node rules ------------------------------------------------------------------------

def node_rules(sheet: DataFrame) -> DataFrame:
    """Distinct (troncal, node) of the valid rows with the place of the first row."""
    ids = F.transform(F.split(F.replace("ids_distribucion", F.lit('"'), F.lit("")), r"\|"), strip)
    return (
        sheet.filter(F.upper(strip("validacion")) == "OK")
        .select(strip("troncal").alias("troncal"), F.explode(ids).alias("node"), "seq")
        .filter("troncal <> '' AND node <> ''")
        .groupBy("troncal", "node")
        .agg(F.min("seq").alias("seq"))
    )


def rule_of_base(bases: DataFrame, trunks: DataFrame) -> DataFrame:
    """Trunk whose node rule holds for a base name.

    By the exact name, else by the number before '-', else the first trunk of which one
    name is the beginning of the other. The third way is an equi join on beginnings:
    those of the base against the trunks, and the base's number against the beginnings
    of the trunks, each reduced to its first trunk.
    """
    names = bases.select("base").filter("base IS NOT NULL").distinct().withColumn(
        "_head", F.substring_index("base", "-", 1)
    )
    exact = names.join(trunks.select(F.col("troncal").alias("_t")), F.col("base") == F.col("_t"), "left")
    with_head = exact.join(trunks.select(F.col("troncal").alias("_h")), F.col("_head") == F.col("_h"), "left")
    direct = F.coalesce("_t", F.when(F.col("base").contains("-"), F.col("_h")))
    beginnings = lambda c: F.explode(
        F.transform(F.sequence(F.lit(1), F.length(c)), lambda n: F.substring(c, F.lit(1), n))
    )
    trunk_beginnings = trunks.select("troncal", "seq", beginnings(F.col("troncal")).alias("_begin"))
    by_begin = first_wins(trunk_beginnings, ["_begin"], ["seq", "troncal"], ["troncal", "seq"])
    open_names = with_head.filter(direct.isNull()).select("base", "_head")
    longer = open_names.join(by_begin, F.col("_head") == F.col("_begin")).select("base", "troncal", "seq")
    shorter = (
        open_names.select("base", beginnings(F.col("base")).alias("_begin"))
        .join(trunks.select("troncal", "seq"), F.col("_begin") == F.col("troncal"))
        .select("base", "troncal", "seq")
    )
    third = first_wins(longer.unionByName(shorter), ["base"], ["seq", "troncal"], ["troncal"])
    return with_head.filter(direct.isNotNull()).select("base", direct.alias("troncal")).unionByName(third)


def node_findings(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Ends against the node rule; only the first row of an id is checked."""
    first = (
        rows.withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy("seq")))
        .filter("_n = 1")
        .select(
            "id", "nombre", "seq", "nodo_a", "nodo_b", F.col("prop"),
            extract(F.col("nombre"), r"^(\d+(?:-\d+)?)").alias("base"),
        )
    )
    trunks = rules.groupBy("troncal").agg(
        F.count(F.lit(1)).alias("_allowed"), F.min("node").alias("_only"), F.min("seq").alias("seq")
    )
    which = rule_of_base(first, trunks)
    ends = {
        e: rules.select(F.col("troncal").alias(f"_t{e}"), F.col("node").alias(f"_n{e}")) for e in ("a", "b")
    }
    checked = first.join(which, "base").join(trunks.drop("seq"), "troncal")
    for e, known in ends.items():
        checked = checked.join(
            known, (F.col("troncal") == F.col(f"_t{e}")) & (F.col(f"nodo_{e}") == F.col(f"_n{e}")), "left"
        )
    messages = R.node_rule(
        F.col("nodo_a"), F.col("nodo_b"), F.col("_allowed"), F.col("_only"),
        F.col("_na").isNotNull(), F.col("_nb").isNotNull(),
    )
    owner = F.when(F.col("prop") == "", "-").otherwise(F.col("prop"))
    return findings(checked, ENTITY, 11, messages, owner=owner)


# --- specifications for the comparison with splices --------------------------------------

def specifications(rows: DataFrame) -> DataFrame:
    """(name, spec, source) of cables; base names first, full names as fallback.

    The last row of a name wins; a base name hides the same full name.
    """
    main = last_wins(rows.filter("base <> ''"), ["base"], ["seq"], ["esp"]).select(
        F.col("base").alias("name"), F.col("esp").alias("spec"), F.lit("principal").alias("source")
    )
    spare = last_wins(rows.filter("base_raw <> ''"), ["base_raw"], ["seq"], ["esp"]).select(
        F.col("base_raw").alias("name"), F.col("esp").alias("spec"), F.lit("respaldo").alias("source")
    )
    return main.unionByName(spare.join(main.select("name"), "name", "left_anti"))
