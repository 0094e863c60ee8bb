"""Audit of splices: names, specifications, repeats, sequences, and against their cable."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hilvan.functions import rules as R
from hilvan.functions.text import construction_status, expected_splice_type, text_or_empty
from hilvan.operators.groups import PART_BYTES, duplicate_keys, first_wins, majority, minority_rows
from hilvan.operators.sequence import first_two, repeated_numbers, sequence_gaps
from hilvan.plans.findings import findings, one, usable_rows
from hilvan.session import stored

ENTITY = "EMPALME"

# Logical column and header of a splice export.
COLUMNS = {
    "id": ["id texto"],
    "nombre": ["name"],
    "especificacion": ["nombre especificación"],
    "propietario": ["propietario"],
    "estado": ["construction status"],
}
NAP = "Nap Sotano"


def prepare(splices: DataFrame, excluded: DataFrame | None = None, decode: bool = True) -> DataFrame:
    name = text_or_empty("nombre")
    rows = usable_rows(splices, excluded).select(
        "id", "seq", name.alias("nombre"), F.upper(name).alias("upper"),
        text_or_empty("especificacion").alias("esp"),
        text_or_empty("propietario").alias("prop"),
        construction_status("estado", decode).alias("est"),
    )
    n, u = F.col("nombre"), F.col("upper")
    chained = (n.startswith("ET") | n.startswith("NAP")) & n.contains("_")
    return rows.withColumns(
        {
            "corto": F.when(u.startswith("NAP"), F.substring(n, 4, 1 << 30))
            .when(F.length(n) > 2, F.substring(n, 3, 1 << 30)).otherwise(n),
            "chained": chained,
            "grupo": F.when(chained & u.contains("-SUB"), F.regexp_extract(u, r"^((?:ET|NAP)\d+-SUB)", 1))
            .when(chained, F.substring_index(n, "_", 1)).otherwise(""),
        }
    )


def audit_splices(
    splices: DataFrame, owners: DataFrame, valid_owner: str, excluded: DataFrame | None = None,
    decode: bool = True, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """All findings of splices. ``splices`` has the columns of ``COLUMNS`` and seq."""
    return prepared_findings(stored(prepare(splices, excluded, decode)), owners, valid_owner, part_bytes)


def prepared_findings(
    rows: DataFrame, owners: DataFrame, valid_owner: str, part_bytes: int = PART_BYTES
) -> DataFrame:
    """All findings of the rows of :func:`prepare`, which are read by every rule: store them first."""
    return reduce(
        DataFrame.unionByName,
        [
            attribute_findings(rows, owners, valid_owner),
            repeat_findings(rows, owners, part_bytes),
            group_findings(rows, owners),
            sequence_findings(rows, owners),
            cable_findings(rows, owners),
        ],
    )


def attribute_findings(rows: DataFrame, owners: DataFrame, valid_owner: str) -> DataFrame:
    c = F.col
    messages = R.all_of(
        R.whitespace("nombre", "NOMBRE"),
        R.whitespace("esp", "ESPECIFICACION"),
        R.whitespace("prop", "PROPIETARIO"),
        R.whitespace("est", "ESTADO"),
        R.splice_name("nombre"),
        R.splice_spec("nombre", "esp"),
        R.messages(
            (c("prop") != valid_owner, R.actual(f"PROPIETARIO ({valid_owner})", c("prop"))),
            (~c("est").isin(*R.ACCEPTED_STATUS), R.actual("STATUS (En servicio/Plan Abandono/Futuro)", c("est"))),
        ),
        R.splice_name_suggestion("nombre"),
    )
    return findings(rows, ENTITY, 20, messages, owners=owners, key=c("corto"))


def repeated_names(rows: DataFrame) -> DataFrame:
    """Names with several ids; numbered ET and NAP names may repeat."""
    return rows.filter(~F.col("chained"))


def repeat_findings(rows: DataFrame, owners: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    single = repeated_names(rows)
    repeats = duplicate_keys(single, "nombre", "id", [F.col("seq")], part_bytes=part_bytes)
    first = single.groupBy("nombre").agg(F.min("seq").alias("seq"), F.first("corto").alias("corto"))
    named = repeats.join(first, "nombre")
    return findings(
        named, ENTITY, 21, one(F.lit("DUPLICADO)")), owners=owners, key=F.col("corto"), id="ids"
    )


def grouped_spec(spec: Column, is_nap: Column) -> Column:
    return F.when(is_nap & spec.startswith(NAP), F.lit(NAP)).otherwise(spec)


def group_findings(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Splices whose type differs from the majority of their chain."""
    kinds = rows.filter("grupo <> ''").withColumn(
        "kind", grouped_spec(F.col("esp"), F.col("upper").startswith("NAP"))
    )
    usual = majority(kinds.filter(F.col("kind").isin(*R.SPLICE_TYPES, NAP)), ["grupo"], "kind", ["seq"]).select(
        "grupo", F.col("majority").alias("_usual")
    )
    nap = F.col("grupo").startswith("NAP")
    differs = F.when(nap, F.col("esp").startswith(NAP) != (F.col("_usual") == NAP)).otherwise(
        F.col("esp").isin(*R.SPLICE_TYPES) & (F.col("esp") != F.col("_usual"))
    )
    start = F.when(nap, R.text("(para ", F.col("grupo"), ", ")).otherwise("(")
    message = R.text("TIPO DE GRUPO ", start, "esperado: '", F.col("_usual"), "', actual: '", F.col("esp"), "')")
    # Only chained names have a group, and only the others can be repeated.
    faulty = kinds.join(usual, "grupo").filter(differs)
    return findings(
        faulty, ENTITY, 22, one(message), owners=owners, key=F.col("corto"))


def numbered(rows: DataFrame) -> DataFrame:
    pattern = r"^((?:ET|NAP)\d+)_(\d+)$"
    return rows.filter(F.col("chained") & F.col("upper").rlike(pattern)).select(
        "id", "nombre", "corto", "seq", F.regexp_extract("upper", pattern, 1).alias("prefijo"),
        F.regexp_extract("upper", pattern, 2).try_cast("bigint").alias("numero"),
    ).filter("numero IS NOT NULL")


def sequence_findings(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Repeated numbers and gaps along each chain."""
    pairs = first_two(numbered(rows), ["prefijo"], "numero", ["seq"], ["id", "nombre", "corto", "seq"])
    repeats = repeated_numbers(pairs).select(
        F.concat(F.col("first.id"), F.lit(" , "), F.col("second.id")).alias("id"),
        F.col("first.nombre").alias("nombre"), F.col("second.corto").alias("corto"),
        F.col("second.seq").alias("seq"), F.lit("DUPLICADO)").alias("_m"),
    )
    n, m = F.col("numero"), F.col("following")
    message = F.when(
        m - n == 2,
        R.text("CONSECUTIVO ", F.col("missing"), " después del _", n, ")"),
    ).otherwise(
        R.text("CONSECUTIVO _", n, " y el _", m, ". Faltan: ", F.col("missing"), ")")
    )
    gaps = sequence_gaps(pairs, ["prefijo"], "numero").select(
        F.col("first.id").alias("id"), F.col("first.nombre").alias("nombre"), F.col("first.corto").alias("corto"),
        F.col("first.seq").alias("seq"), message.alias("_m"),
    )
    return findings(
        repeats.unionByName(gaps), ENTITY, 23, one(F.col("_m")), owners=owners, key=F.col("corto")
    )


def cable_findings(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Splices whose type differs from the majority of their cable or sub-ring."""
    main, sub = r"^((?:ET|NAP)(\d+))", r"^((?:ET|NAP)\d+)-SUB"
    u, n, esp = F.col("upper"), F.col("nombre"), F.col("esp")
    is_sub = u.contains("-SUB")
    named = rows.filter(
        (n.startswith("ET") | n.startswith("NAP"))
        & (esp.isin(*R.SPLICE_SPECS) | esp.startswith("Nap Sotano ")) & u.rlike(main)
        & (~is_sub | u.rlike(sub))
    ).select(
        "id", "nombre", "esp", "seq", F.regexp_extract(u, main, 2).alias("numero"),
        F.when(is_sub, F.concat(F.regexp_extract(u, sub, 1), F.lit("-SUB")))
        .otherwise(F.regexp_extract(u, main, 1)).alias("cable"),
    ).withColumn("kind", grouped_spec(esp, F.col("cable").contains("NAP")))
    faulty = minority_rows(named, ["cable"], "kind", ["seq"])
    nap = F.col("cable").contains("NAP")
    # Among NAP cables only being a NAP type or not counts.
    differs = ~nap | ((F.col("kind") == NAP) != (F.col("majority") == NAP))
    message = R.text(
        "TIPO DE CABLE INCONSISTENTE | Cable ", F.col("cable"), " tiene mayoría '", F.col("majority"),
        "' | MAYORÍA: '", F.col("majority"), "' , ACTUAL: '", F.col("esp"), "'",
    )
    return findings(
        faulty.filter(differs), ENTITY, 24, one(message), owners=owners, key=F.col("numero")
    )


def merge_findings(
    rows: DataFrame, specs: DataFrame, cables: DataFrame, owners: DataFrame
) -> DataFrame:
    """Chains whose splices all agree with each other but not with their cable.

    ``rows`` from :func:`prepare`, ``specs`` and ``cables`` from the cable audit
    (``specifications`` and ``prepare``).
    """
    chain = r"^(ET|NAP)(\d+)(-SUB|_)"
    u = F.col("upper")
    chained = rows.filter("chained").select(
        "id", "seq", "esp",
        F.regexp_extract(u, chain, 1).alias("kind"), F.regexp_extract(u, chain, 2).alias("code"),
        u.contains("-SUB").alias("sub"), F.regexp_extract(u, chain, 3).alias("_mark"),
    ).filter(
        ((F.col("_mark") == "-SUB") & F.col("sub")) | ((F.col("_mark") == "_") & ~F.col("sub"))
    ).withColumn("esp", grouped_spec(F.col("esp"), F.col("kind") == "NAP"))
    chains = chained.groupBy("kind", "code", "sub").agg(
        F.min("esp").alias("type"), F.max("esp").alias("_other"), F.count(F.lit(1)).alias("n"),
        F.min_by("id", "seq").alias("first_id"), F.min("seq").alias("seq"),
    ).filter("type = _other")
    number = r"^(\d+)(-SUB)?$"
    named = specs.filter(F.upper("name").rlike(number)).select(
        F.regexp_extract(F.upper("name"), number, 1).alias("code"),
        F.upper("name").endswith("-SUB").alias("sub"), "name", "spec", "source",
        expected_splice_type("spec").alias("expected"),
    )
    # Names that differ only by case give one entry; the smallest name is taken.
    cable = first_wins(named, ["code", "sub"], ["name"], ["name", "spec", "source", "expected"])
    first_cable = first_wins(cables.filter("base <> ''"), ["base"], ["seq"], ["id"]).select(
        F.col("base").alias("name"), F.col("id").alias("cable_id")
    )
    differing = (
        chains.join(cable, ["code", "sub"])
        .filter("type <> expected AND expected <> 'Desconocido'")
        .join(first_cable, "name", "left")
    )
    sub, nap = F.col("sub"), F.col("kind") == "NAP"
    label = (
        F.when(sub & nap, "NAP SUB-ANILLO").when(sub, "SUB-ANILLO").when(nap, "NAP PRINCIPAL").otherwise("CABLE PRINCIPAL")
    )
    note = F.when(F.col("source") == "respaldo", " [FI de archivo respaldo]").otherwise("")
    message = R.text(
        "MERGE (", label, ") | FI:'", F.col("name"), "' (", F.col("spec"), " → actual: '", F.col("expected"),
        "' | Todos los empalmes (", F.col("n"), ") tienen: '", F.col("type"), "' | ",
        F.when(sub, "PROBLEMA EN SUB-ANILLO").otherwise("PROBLEMA EN FIBRA PRINCIPAL"),
        ": Todos los empalmes concuerdan entre sí pero no con la fibra | ",
        "RECOMENDACIÓN: Corregir especificación de fibra a '", F.col("type"), "'", note,
    )
    value = R.text(
        "FI:", F.col("name"), F.when(sub, " (sub-anillo '").otherwise(" (cable principal '"), F.col("code"), "')"
    )
    return findings(
        differing, "MERGE FI-EM", 60, one(message), owners=owners, key=F.col("code"),
        id=F.coalesce("cable_id", "first_id"), value=value,
    )
