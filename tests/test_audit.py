"""Audits on hand-made exports."""

import pytest
from pyspark.sql import functions as F

from hilvan.functions import rules as R
from hilvan.operators import prioritize
from hilvan.operators.prioritize import leading_findings, message_lists, prioritise
from hilvan.plans import audit, audit_cables, audit_ports, audit_splices
from hilvan.plans.findings import cable_owners, findings


def found(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


TRUNKS = ("12", "7-1", "7", "300", "45-2", "5-2", "5-1", "9")
RULE_OF = {
    "12": "12", "7-1": "7-1", "9": "9",  # the trunk itself
    "12-3": "12", "7-5": "7", "9-": "9",  # the number before the hyphen
    "3001": "300", "128": "12", "71": "7",  # a trunk that begins the base
    "30": "300", "1": "12", "45": "45-2", "45-9": "45-2",  # a trunk that the number begins
    "5": "5-2", "5-7": "5-2",  # the first in order, not the smallest
}


def test_rule_of_base(spark):
    got = audit_cables.rule_of_base(
        spark.createDataFrame([(b,) for b in [*RULE_OF, "8", "81-2", "600"]], "base string"),
        spark.createDataFrame([(t, i) for i, t in enumerate(TRUNKS)], "troncal string, seq int"),
    )
    assert {x.base: x.troncal for x in got.collect()} == RULE_OF


def test_node_rules_read_the_named_column(spark):
    sheet = spark.createDataFrame(
        [("OK", "12", '"N1" | N2', 1), ("ok ", "7", "N3", 2), ("NO", "9", "N4", 3), ("OK", "7", " ", 4)],
        "validacion string, troncal string, ids_distribucion string, seq int",
    )
    rules = audit_cables.node_rules(sheet)
    assert found(rules, "troncal", "node") == [("12", "N1"), ("12", "N2"), ("7", "N3")]
    rows = spark.createDataFrame(
        [("a", "12-1", "N1", "N9", "o", 1), ("b", "12", "N1", "", "", 2), ("c", "7", "N3", "", "o", 3), ("c", "7", "x", "x", "o", 4)],
        "id string, nombre string, nodo_a string, nodo_b string, prop string, seq int",
    )
    assert found(audit_cables.node_findings(rows, rules), "id", "owner", "message") == [
        ("a", "o", "NODO A Y B | Nodos no coinciden con ODFS"),
        ("c", "o", "NODO INVÁLIDO | CORREGIR SEGÚN ODFS: A='N3', B='N3' | ACTUAL A='N3' B=''"),
    ]


def test_prioritise(spark):
    rows = [
        ("FIBRA", "1", "v1", "o1", "STATUS x", 1, 1, 0),
        ("FIBRA", "1", "v1", "o1", "PROPIETARIO (R) y", 1, 1, 1),
        ("EMPALME", "1", "v2", "o2", "TIPO DE GRUPO b", 2, 1, 0),
        ("EMPALME", "1", "v3", "o3", "actual: a", 2, 2, 0),
        ("PORT", "2", "v", "o", "DESCRIPTION: TABS - valor: 'x'", 1, 1, 0),
        ("PORT", "2", "v", "o", "DESCRIPTION VACIO", 1, 1, 1),
        ("NADA", "3", "v", "o", "DUPLICADO", 1, 1, 0),
        ("MERGE FI-EM", "4", "v", "o", "MERGE DE", 1, 1, 0),
        ("ESTRUCTURA X", "5", "v", "o", "FLOOR: 1", 1, 1, 0),
    ]
    df = spark.createDataFrame(rows, "entity string, id string, value string, owner string, message string, stage int, seq bigint, pos int")
    # White-space marks take priority 1; the pattern 'DE' takes many messages to level 3.
    expected = [
        ("EMPALME", "1", "v2", "o2", "TIPO DE GRUPO b | actual: a", 8, "Especificación"),
        ("ESTRUCTURA X", "5", "v", "o", "FLOOR: 1", 1, "ESTRUCTURA"),
        ("MERGE FI-EM", "4", "v", "o", "MERGE DE", 3, "Nombre"),
        ("NADA", "3", "v", "o", "DUPLICADO", 999, "Otros"),
        ("PORT", "2", "v", "o", "DESCRIPTION: TABS - valor: 'x'", 1, "Id"),
    ]
    columns = ("entity", "id", "value", "owner", "message", "priority", "field")
    assert found(prioritise(df, "R"), *columns) == expected
    short = prioritise(df, "R", part_bytes=5).collect()
    assert len(short) == len(expected)
    assert {r.message for r in short if r.id == "1"} == {"TIPO DE GRUPO b"}
    lists = message_lists(leading_findings(df, "R"), part_bytes=5).filter("id = '1'").collect()
    assert [(r.part, r.message) for r in sorted(lists, key=lambda r: r.part)] == [(0, "TIPO DE GRUPO b"), (3, "actual: a")]


def test_splice_chain_rules(spark):
    rows = [("ET1_1", "Tipo 0"), ("ET1_2", "Tipo 1"), ("ET1_3", "Tipo 1"), ("ET1_7", "Tipo 0"), ("EA9", "x"), ("EA9", "x"), ("NAP1_1", "Nap Sotano 12")]
    df = spark.createDataFrame([(f"i{i}", n, e, "R", "is", i) for i, (n, e) in enumerate(rows)],
                               "id string, nombre string, especificacion string, propietario string, estado string, seq int")
    owners = cable_owners(spark.createDataFrame([("1/x", "Ana", 1), ("1", "Eva", 2)], "cable_acceso string, responsable string, seq int"))
    ready = audit_splices.prepare(df)
    assert found(audit_splices.group_findings(ready, owners), "id", "message") == [
        ("i1", "TIPO DE GRUPO (esperado: 'Tipo 0', actual: 'Tipo 1')"), ("i2", "TIPO DE GRUPO (esperado: 'Tipo 0', actual: 'Tipo 1')"),
    ]
    assert found(audit_splices.sequence_findings(ready, owners), "id", "message") == [
        ("i2", "CONSECUTIVO _3 y el _7. Faltan: _4, _5, _6)")
    ]
    assert found(audit_splices.repeat_findings(ready, owners), "id", "message") == [("i4 , i5", "DUPLICADO)")]
    types = audit_splices.cable_findings(ready, owners)
    assert {r.owner for r in types.collect()} == {"Eva"}


@pytest.mark.parametrize(
    "name,status,comments,building,count,fault",
    [
        ("ACME SAS", "IS", None, "ACME NORTE", 1, None),
        ("ACME", "Spare", None, "OTRO", 1, None),
        ("ACME", "Spare", "una adicion", "OTRO", 1, "NOMBRE CLIENTE | Posible esperado: 'OTRO'"),
        ("ACME", "In Service", None, "TORRE 1", 1, None),
        ("ACME", "In Service", None, "OTRO", 6, None),
        ("ACME", "In Service", None, None, None, None),
        ("", "IS", None, "X", 1, "NOMBRE CLIENTE VACIO"),
        ("A  B", "IS", None, "X", 1, "NOMBRE CLIENTE: ESPACIOS_DOBLES - valor: 'A  B'"),
        ("ACME S A S", "IS", None, "X", 1, "NOMBRE (Sufijo con espacios)'"),
        ("Acme @", "IS", None, "X", 1, "NOMBRE CLIENTE: CARACTER INVALIDO: '@' | ACME @"),
    ],
)
def test_client_name(spark, name, status, comments, building, count, fault):
    from hilvan.functions.text import company_name

    df = spark.createDataFrame([(name, status, comments, building, count)], "n string, s string, c string, b string, k int")
    rule = R.client_name(F.col("n"), F.col("s"), F.col("c"), F.col("b"), F.col("k"), company_name("n"), company_name("b"))
    assert df.select(rule).first()[0] == fault


def exports(spark):
    def table(columns, *rows):
        names = ", ".join(f"`{c}` string" for c in columns)
        return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], names + ", seq bigint")

    return {
        "cables": table(
            ["Id Text", "Name", "Colocacion Type", "Nombre Especificación", "Propietario", "Construction Status"],
            ("1", "100", "Troncal-Acceso", "Ductado 144 hilos", "R", "is"), ("2", "100x", "Troncal-Acceso", "Ductado 96", "R", "is"),
            ("3", "", "", "", "", ""),
        ),
        "splices": table(
            ["id texto", "name", "nombre especificación", "propietario", "construction status"],
            ("e1", "ET100_1", "Tipo 2", "R", "is"), ("e2", "ET100_2", "Tipo 2", "R", "pa"), ("om", "ET100_9", "x", "R", "is"),
        ),
        "buildings": table(
            ["idtexto", "name", "type", "categoria", "number of floors"],
            ("b1", "ACME", "Torre", "AAA", "1"), ("b2", "Acme", "Torre", "B", "1"), ("b3", "NODO 1", "", "", "0"),
        ),
        "ports": table(
            ["id", "description", "physical status", "nombre cliente", "building.id", "id shelf", "description shelf", "type"],
            ("p1", "1", "Spare", "", "b1", "s1", "DEMARCADOR CLIENTE", "Equipo Cliente"),
            ("p2", "2", "IS", "ACME", "b1", "s1", "DEMARCADOR CLIENTE", "Equipo Cliente"),
            ("p3", "1", "", "", "", "s9", "OT1", "x"),
        ),
    }


def test_whole_audit(spark, tmp_path):
    tables = audit.logical(exports(spark))
    owners = spark.createDataFrame([("100/a", "b1", "Ana", 1)], "cable_acceso string, id_edificio string, responsable string, seq int")
    out = spark.createDataFrame([("om", None, None)], "id string, elemento string, tb string")
    report = audit.run_audit(spark, tables, owners, "R", str(tmp_path), out)
    rows = {(r.element, r.id): r.error for r in report.collect()}
    assert rows[("MERGE FI-EM", "1")].startswith("MERGE (CABLE PRINCIPAL) | FI:'100'")
    assert "(en Troncal-Acceso debe contener solo números cuando no hay P)" in rows[("FIBRA", "2")]
    assert rows[("EDIFICIO", "b2")] == "CATEGORIA (AAA) (actual: B) | NOMBRE (usar: ACME) | NOMBRE (Corregir a (ACME)"
    assert rows[("SHELF", "s9")] == "TIPO INVALIDO. Esperado: 'ODF Troncal', actual: ''"
    assert rows[("SHELF", "s1")].startswith("CONTRATISTA VACIO")
    assert not any("om" in k[1] for k in rows)
    counters = {r.entity: r.findings for r in spark.read.parquet(f"{tmp_path}/counters").collect()}
    assert sum(counters.values()) == spark.read.parquet(f"{tmp_path}/findings").count()


def test_sequence_skips_central_shelves(spark):
    tables = audit.logical(exports(spark))
    ready = audit_ports.prepare(tables["ports"], None, tables["buildings"])
    client, central = ready.filter("central IS NULL"), ready.filter("central IS NOT NULL")
    assert found(audit_ports.sequence_rows(client, central), "id", "message") == [
        ("p1", "SECUENCIA: SPARE_ANTES_DE_IN_SERVICE (puerto 1, último 2)")
    ]


def test_whole_audit_prepares_cables_and_splices_once(spark, monkeypatch):
    calls = []
    for module in (audit_cables, audit_splices):
        monkeypatch.setattr(module, "prepare", lambda *a, m=module, f=module.prepare: (calls.append(m.ENTITY), f(*a))[1])
    tables = audit.logical(exports(spark))
    owners = spark.createDataFrame([("100/a", "b1", "Ana", 1)], "cable_acceso string, id_edificio string, responsable string, seq int")
    audit.all_findings(tables, owners, "R")
    assert sorted(calls) == ["EMPALME", "FIBRA"]


def test_repeated_messages_are_merged_before_the_join(spark, monkeypatch):
    written = []
    monkeypatch.setattr(prioritize, "stored", lambda df, f=prioritize.stored: (written.append(f(df)), written[-1])[1])
    cells = [("BAY", i, f"v{n}", "", "NUMBER INVALIDO", 52, n, 0) for i in ("b1", None) for n in (3, None, 1, 2)]
    cells += [("BAY", "b1", "w", "", "CONTRATISTA VACIO", 52, 0, 0), ("SHELF", "b1", "s", "", "TIPO INVALIDO", 51, 0, 0)]
    rows = spark.createDataFrame(
        cells, "entity string, id string, value string, owner string, message string, stage int, seq long, pos int"
    )
    got = leading_findings(rows).select("id", "entity", "message", "_first.value", "_first.at.seq").collect()
    assert [tuple(r) for r in got] == [("b1", "BAY", "NUMBER INVALIDO", "vNone", None)]
    assert written[0].count() == 4  # of ten rows


def test_messages_are_made_before_they_are_exploded(spark):
    rows = spark.createDataFrame([("1", " a", 1), ("2", "a", 2)], "id string, nombre string, seq int")
    out = findings(rows, "X", 1, R.whitespace("nombre", "N"), owner=F.lit(""))
    assert found(out, "id", "message", "pos") == [("1", "N: ESPACIOS_DOBLES - valor: ' a'", 0)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode(_messages" in plan


def test_ports_are_written_without_the_columns_of_the_name_rule(spark, monkeypatch):
    written = []
    monkeypatch.setattr(audit_ports, "stored", lambda df, f=audit_ports.stored: (written.append(df.columns), f(df))[1])
    tables = audit.logical(exports(spark))
    audit_ports.audit_ports(tables["ports"], tables["buildings"])
    assert not {"building_norm", "nombre_cliente", "comentarios", "client_norm"} & set(written[0])


def test_lookups_of_ports_are_no_aggregates_in_the_join(spark):
    """Else the ports of one client, or without a name to look up, go to one task: no stage splits them."""
    tables = audit.logical(exports(spark))
    ready = audit_ports.prepare(tables["ports"], None, tables["buildings"])
    assert "Aggregate" not in ready._jdf.queryExecution().optimizedPlan().toString()
    assert found(ready, "id", "building", "building_norm", "client_norm", "_n_buildings") == [
        ("p1", "ACME", "ACME", "", None), ("p2", "ACME", "ACME", "ACME", 1), ("p3", None, "", "", None)]
    by_name = ready.sparkSession.createDataFrame([("p9", 9, "Acme S.A.S", "no")], "id string, seq long, n string, b string")
    port = audit.select_aliases(
        by_name.selectExpr("id", "n AS `nombre cliente`", "b AS `building.id`", "seq"), audit_ports.COLUMNS,
        keep=["seq"], required=["id"])
    assert found(audit_ports.prepare(port, None, tables["buildings"]), "building", "building_norm", "client_norm") == [
        ("ACME", "ACME", "ACME")]


def test_owners_are_looked_up_from_one_stored_table(spark):
    tables = audit.logical(exports(spark))
    owners = spark.createDataFrame([("100/a", "b1", "Ana", 1)], "cable_acceso string, id_edificio string, responsable string, seq int")
    out = audit.all_findings(tables, owners, "R")
    assert "responsable" not in out._jdf.queryExecution().optimizedPlan().toString()
