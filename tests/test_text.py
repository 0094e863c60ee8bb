"""Normalisation functions on hand-made values."""

import datetime

import pytest
from pyspark.sql import functions as F

from hilvan.functions import rules as R
from hilvan.functions import text as T
from hilvan.functions.sql import register_functions
from hilvan.sources.columns import (
    ascii_name,
    find_by_part,
    find_column,
    loader_name,
    select_aliases,
    unique_names,
)


def apply(spark, fn, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("v")).alias("r")).collect()]


CASES = [
    (T.strip, {" a\t": "a", " x ": "x", "": "", None: None}),
    (T.clean_port, {"007/00/": "7/0", "XG 3/0/12": "3/0/12", "": "0", "a//05": "0/0/5", "00-1/2": "-1/2", None: None}),
    (T.panel_number, {"12": "12", "odf 7 x9": "7", "a1b22": "22", "nada": "nada", None: None}),
    (T.ring_from_origin, {
        "a_MEABC1_b": "MEABC1", "me12345": "ME12345", "ABCDEF9": "ABCDEF9", "N/A": None, "#N/A": None, "": None,
        "10.0.0.1_9f8e7d6(z)": "9F8E7D6", "1.2.3.4": None, "123456/789": None, "MEx MEabcd": "MEABCD", None: None,
    }),
    (T.equipment_name, {"EQUIPO ABC x": "ABC", "ABC": "ABC", " EQUIPO  D": ""}),
    (T.fibre_base_name, {"12": "12", "12-3": "12-3", "12-3-4": "12-3", "12-3-4-5": "12-3", "12-SUB": "12", "A-1-x": "A-1-x", "x": "x"}),
    (T.company_name, {"Acme S.A.S.": "ACME", " foo  ltda, bar ": "FOO BAR", "x NIT 900123 y": "X Y", None: "", "": ""}),
    (T.comparison_key, {"Acme S. A. S.": "acme sas", "ACME SAS": "acme sas", "a b": "ab", "uno a dos": "uno a dos", "x (y); z": "xyz"}),
    (T.report_text, {"a\t b  c\n": "a b c", None: None}),
    (T.normalise_id, {None: "", "": "", " 3492000048800395440 ": "3492000048800395440"}),
    (T.expand_exponent_id, {"1.2E+10": "12000000000", "1.5e0": "1", "e": "e", "abc": "abc", "12": "12", None: None}),
    (T.is_zero, {"0": True, " 0.0 ": True, "-0": True, "0e5": True, "1": False, "": False, "x": False, None: False, ".": False}),
    (T.strand_count, {"Ductado 48  Hilos": 48, "x": 0, None: 0}),
    (T.first_item, {" a , b": "a", "c": "c"}),
    (T.construction_status, {"IS": "En servicio", " pa": "Plan Abandono", "pf ": "Plan Uso Futuro", "z": "z", None: ""}),
    (T.equipment_in_text, {"ir a BOGOTA1234 y VILLAV99": "BOGOTA1234", "BOGOTA12": None}),
    (T.port_in_text, {"p 1/2/3 x": "1/2/3", "4/5": "4/5", "6": None}),
    (lambda c: T.odd_characters(c, "[a-z ]"), {"ab#é#Z": "#Zé", "ab": "", None: None}),
    (lambda c: T.labelled_value(c, "ANILLO:"), {"x ANILLO:  a \t b ": "a b", "ANILLO:": None, "otro": None}),
    (T.metro_port_value, {"PTO METRO: GE 1/2": "1/2", "GigabitEthernet 0/1": "0/1", "nada": None}),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_function(spark, case):
    fn, values = CASES[case]
    assert apply(spark, fn, list(values)) == list(values.values())


def test_port_parts(spark):
    got = apply(spark, T.port_parts, ["XG 3/0/12", "1/2", "a/1/2", "GE-1/2/3", None])
    assert [tuple(g) if g else None for g in got] == [(3, 0, 12), None, None, (1, 2, 3), None]


def test_trunk_panel_parts(spark):
    got = apply(spark, T.trunk_panel_parts, ["OT12_4 1/12 x", "OT12 99", "OTabc", "XX"])
    assert [tuple(g) if g else None for g in got] == [("12", "4", "1/12 x"), ("12", "", "99"), ("abc", "", ""), None]


def test_loose_date(spark):
    got = apply(spark, T.loose_date, ["5-Jan", "05-jan-24", "5-Jan-70", "03/02/2021", "31/02/2021", "29-Feb", "x"])
    low = datetime.date(1, 1, 1)
    assert got == [
        datetime.date(1900, 1, 5), datetime.date(2024, 1, 5), datetime.date(1970, 1, 5), datetime.date(2021, 2, 3), low, low, low,
    ]


def test_joined_values(spark):
    rows = spark.createDataFrame([("a", "b"), ("a", "a"), (None, "b"), ("a", None), (None, None)], "a string, b string")
    assert [r[0] for r in rows.select(T.joined_values("a", "b")).collect()] == ["a|b", "a", "b", "a", None]


def test_column_names():
    assert loader_name("Año-Base x#") == "año_base_x"
    assert ascii_name("Año  Base (x)") == "ano_base_x_"
    assert ascii_name("1a") == "_1a" and ascii_name("") == "columna"
    # A generated name is registered, so it cannot be handed out twice.
    assert unique_names(["a", "a", "a_1"]) == ["a", "a_1", "a_1_1"]
    assert find_column(["Id Bay ", "x"], ["bay id", "id bay"]) == "Id Bay "
    assert find_by_part(["Nombre Anillo", "clientes"], [["total", "cliente"], ["clientes"]]) == "clientes"
    assert find_by_part(["a", "b"], [["z"]], 1) == "b"


def test_select_aliases(spark):
    df = spark.createDataFrame([("1", "n")], "`ID Texto` string, NAME string")
    got = select_aliases(df, {"id": ["id texto"], "nombre": ["nombre", "name"], "falta": ["zz"]})
    assert [tuple(r) for r in got.collect()] == [("1", "n", None)]
    with pytest.raises(ValueError):
        select_aliases(df, {"id": ["nope"]}, required=["id"])


def test_sql_functions(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS clean")
    for schema in (None, "clean"):
        own = spark.newSession()  # without the temporary functions of others
        register_functions(own, schema)
        at = "" if schema is None else f"{schema}."
        row = own.sql(f"""SELECT {at}extraer_equipo_central(t) AS e, {at}extraer_port_ec(t) AS p, {at}sin_cero(' 0 ') AS z,
            {at}sin_blancos(' ') AS b, {at}extraer_equipo_central('ABCDEF12') AS few, {at}extraer_port_ec(NULL) AS n
            FROM VALUES ('x ABCDEFG1 LIMAPE1234 1/2/3 4/5') AS v(t)""").first()
        assert tuple(row) == ("LIMAPE1234", "1/2/3", None, None, None, None)
        own.catalog.setCurrentDatabase(schema or "default")
        rows = own.sql(r"SELECT cable FROM cables_en_lista('a\n\nb') ORDER BY cable").collect()
        assert [r.cable for r in rows] == ["a", "b"]


def test_port_statuses_clean_their_value_once(spark):
    df = spark.createDataFrame([(" BOGOTA1234 ", " 1/2 "), ("0", None), ("bo", "a/1")], "e string, p string")
    out = df.select(R.central_equipment("e").alias("e"), R.central_port("p").alias("p"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("btrim(") + \
        out._jdf.queryExecution().optimizedPlan().toString().count("trim(both") <= 2
    assert [tuple(r) for r in out.collect()] == [
        ("VÁLIDO", "VÁLIDO"), ("VÁLIDO", "VÁLIDO"), ("CARACTERES_INVALIDOS", "CARACTERES_INVALIDOS")
    ]


def test_named_columns_are_trimmed_like_expressions(spark):
    inner = ["", "a", "a b", "~", "!", "\x7f", "é", "ñ a", "\U0001f600"]
    edges = ["", *T.EDGE_SPACE, " \t"]
    cells = [a + x + b for x in inner for a in edges for b in edges] + [None]
    rows = spark.createDataFrame([(c,) for c in cells], "t string").coalesce(1)
    got = rows.select("t", T.strip("t").alias("named"), T.strip(F.col("t")).alias("made")).collect()
    assert all(r.named == r.made == (None if r.t is None else r.t.strip(T.EDGE_SPACE)) for r in got)
    numbers = spark.createDataFrame([(7, None), (-1, 2.5)], "n long, x double").select(T.strip("n"), T.strip("x"))
    assert [tuple(r) for r in numbers.collect()] == [("7", None), ("-1", "2.5")]


def test_names_without_legal_form_take_one_look(spark):
    names = ["ACME S.A.S.", "acme\tsa", "X  LTDA", "X L.T.D.A", "Y E.U", "Y NIT 9", "Y N.I.T. 12 S.A", "Z & CIE", "Z &CIE.",
             "Z INC", "Z CORP.", "Q S.C.S", "Q EIRL", "Q E.I.R.L.", "SAS", "CASA SAGA", "A  B., C", " ", None, "ETB X", "P S A S"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").coalesce(1)
    chain = F.upper(T.text_or_empty("n"))
    for form in T.LEGAL_FORMS:
        chain = F.regexp_replace(chain, form, "")
    chain = T.strip(F.regexp_replace(F.regexp_replace(chain, "[.,]", ""), r"\s+", " "))
    got = rows.select(T.company_name("n").alias("got"), chain.alias("want")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    assert T.ANY_LEGAL_FORM.count("|") == len(T.LEGAL_FORMS) - 1
