"""Trace elements of known traces, and properties that hold for any trace."""

import random
import time

import pytest
from pyspark.sql import functions as F

from hilvan.plans import trace as T


FIBRE = "Fibre (1: 1) Cable de FO (Ductado 12h, 'C')"
SECOND = "Fibre (1: 2) Cable de FO (Ductado 24h, 'D')"
ON, ON_SECOND = ("(12h) | C", "H1"), ("(24h) | D", "H2")


def splice(name):
    return f"at Empalme de Fibra (Tipo 1, '{name}')"


#: Lines of a trace, and the elements they stand for.
CASES = {
    "nothing": (["", "  "], []),
    "building": ([FIBRE, "Edificio 'X'", "Port (1)", "Port (2) Card (c) Bay (B)"], [("(ED) X | 1, B, c, 2", *ON)]),
    "building without ports": ([FIBRE, "Edificio 'X'"], []),
    "node keeps its lines": ([FIBRE, "Edificio 'NODO A'", "Port (1)", "Port (2)"], [("NODO A | Port (1)\nPort (2)", *ON)]),
    "ports before any fibre": (["Port (7)"], [("NODO INICIAL | Port (7)", "", "")]),
    "early ports go to the next building": (
        ["Port (7)", FIBRE, "Edificio 'NODO A'", "Port (1)"], [("NODO A | Port (7)\nPort (1)", *ON)]),
    "first and last splice of a strand": (
        [FIBRE, splice("E1"), splice("E2"), splice("E3")], [("(EM 1) | E1", *ON), ("(EM 1) | E3", *ON)]),
    "a splice per strand": (
        [FIBRE, splice("E1"), SECOND, splice("E2")], [("(EM 1) | E1", *ON), ("(EM 1) | E2", *ON_SECOND)]),
    "client splices all count": (
        [FIBRE, splice("E1"), "at Empalme de Fibra (Empalme Cliente, 'O1')", "at Empalme de Fibra (Empalme Cliente, 'O2')"],
        [("(EM 1) | E1", *ON), ("(EM CL) | O1", *ON), ("(EM CL) | O2", *ON)]),
    "splice after a building": (
        [FIBRE, splice("E1"), "Edificio 'X'", "Port (3)", splice("E2")],
        [("(EM 1) | E1", *ON), ("(ED) X | 3", *ON), ("(EM 1) | E2", *ON)]),
}


def elements(spark, traces, size):
    rows = [(f, n, line) for f, lines in traces.items() for n, line in enumerate(lines, 1)]
    df = spark.createDataFrame(rows, "file_path string, line_no bigint, line string")
    out = T.trace_elements(df, chunk=[F.floor(F.col("line_no") / size)])
    got = {f: [] for f in traces}
    for row in sorted(out.collect(), key=lambda x: (x.line_no is None, x.line_no or 0, x.step, x.part)):
        got[row.file_path].append((row.elemento, row.cable, row.hilo))
    return got


def test_elements_of_known_traces(spark):
    got = elements(spark, {name: lines for name, (lines, _) in CASES.items()}, 2)
    assert got == {name: rows for name, (_, rows) in CASES.items()}


def random_trace(r):
    kinds = [
        lambda: f"Fibre (1: {r.randrange(3)}) Cable de FO (Ductado 48h (x), 'C{r.randrange(2)}')",
        lambda: "Fibre (sin numero)",
        lambda: f" Edificio 'S{r.randrange(3)}'",
        lambda: f"Edificio 'NODO {r.randrange(2)}'",
        lambda: "Edificio sin nombre",
        lambda: f"at Empalme de Fibra (Tipo {r.randrange(2)}, 'ET{r.randrange(2)}')",
        lambda: f"at Empalme de Fibra (Empalme Cliente, 'OB{r.randrange(2)}')",
        lambda: "at Empalme de Fibra sin nombre",
        lambda: f"Port ({r.randrange(4)}) Card (c) Bay (B)",
        lambda: f"Port ({r.randrange(4)})",
        lambda: f"Edificio 'E' Port ({r.randrange(3)})",
        lambda: f"Edificio 'J' at Empalme de Fibra (Tipo 1, 'ET{r.randrange(2)}')",
        lambda: "",
    ]
    return [r.choice(kinds)() for _ in range(r.randrange(1, 40))]


def test_chunk_size_does_not_matter(spark):
    r = random.Random(11)
    traces = {f"t{i}": random_trace(r) for i in range(120)}
    assert elements(spark, traces, 3) == elements(spark, traces, 1000)


def test_each_named_building_with_ports_appears_once(spark):
    r = random.Random(5)
    traces = {}
    for t in range(20):
        lines = [FIBRE]
        for b in range(r.randrange(1, 8)):
            lines += [f"Edificio 'B{b}'", *[f"Port ({p})" for p in range(r.randrange(1, 4))], *[splice(f"E{b}")] * r.randrange(2)]
        traces[f"t{t}"] = lines
    for name, rows in elements(spark, traces, 4).items():
        named = [e.split(" | ")[0] for e, _, _ in rows if e.startswith("(ED)")]
        assert named == [f"(ED) {x[10:-1]}" for x in traces[name] if x.startswith("Edificio")]


def test_long_port_list_continues_in_its_table(spark):
    lines = ["Port (8)", "Fibre (1: 1) Cable de FO (Ductado 12h, 'C')", "Edificio 'X'"] + [f"Port ({i})" for i in range(7)]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file_path string, line_no bigint, line string")
    rows = T.trace_elements(df, part_bytes=9).collect()
    assert [(r.elemento, r.part) for r in rows] == [("(ED) X | Port (8), 0, 1, 2", 0)]
    lists = T.trace_port_lists(df, part_bytes=9).orderBy("before_strands", "part").collect()
    assert [(r.line_no, r.before_strands, r.puertos) for r in lists] == [
        (2, False, "0, 1, 2"), (2, False, "3, 4, 5"), (2, False, "6"), (2, True, "Port (8)"),
    ]


def test_report_and_missing(spark):
    lines = {
        "a": ["Fibre (1: 1) Cable de FO (Ductado 12h, 'C')", "Edificio 'X'", "Port (1)", "at Empalme de Fibra (Tipo 1, 'ET1')"],
        "b": ["Edificio 'NODO A'", "Fibre (1: 1) Cable de FO (Ductado 12h, 'C')", "Port (1)", "at Empalme de Fibra (Tipo 1, 'ET1')"],
    }
    df = spark.createDataFrame([(f, i, x) for f, xs in lines.items() for i, x in enumerate(xs, 1)], "file_path string, line_no bigint, line string")
    files = spark.createDataFrame([("a", "cab", "x_y_r1"), ("b", "cab", "x_y_r2")], "file_path string, folder string, stem string")
    owners = T.ring_owners(
        spark.createDataFrame(
            [("r1", "Ana", "2", "01/01/2020", 1), ("R1 ", "Eva", "1", "01/01/2021", 2), ("R1", "Leo", "9", "01/01/2021", 3), ("r9", "Z", "", None, 4)],
            "anillo string, responsable string, total_clientes string, fecha string, seq int",
        )
    )
    got = {r.hoja: (r.archivo, r.estado) for r in T.trace_report(files, T.trace_elements(df), owners, only_faults=False).collect()}
    # Both owners occur once, so the tie goes to the smaller name, here the empty one.
    assert got["x_y_r1"] == ("cab.xlsx", "(FALTA OB C, H1)")
    assert got["x_y_r2"] == ("cab.xlsx", "SIN RESPONSABLE")
    assert [r.archivo for r in T.missing_files(files, owners).collect()] == ["R9"]


def test_brackets_at_any_depth(spark):
    deep = lambda n, text: "(" * n + text + ")" * n
    rows = [
        (f"Cable de FO (Ductado 4h {deep(4, 'x')}, 'A') z", "(4h) | A"), (f"Cable de FO (Ductado 9h {deep(10, 'x')}, 'B')", "(9h) | B"),
        ("Cable de FO (Ductado 4h ((x), 'A'", None), ("Cable de FO ()", None), ("Cable de FO (Ductado 1h) 'C'", None),
        ("no marker (Ductado 1h, 'C')", None), (f"Cable de FO (Ductado 8h {deep(100_000, '')} 'L')", "(8h) | L"), (None, None),
        ("Cable de FO (Ductado 2h, 'é(漢)')) x)", "(2h) | é(漢)"),
    ]
    df = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(rows)], "i int, line string")
    start = time.monotonic()
    got = df.select("i", T.cable_label(F.col("line")).alias("c")).orderBy("i").collect()
    assert [r.c for r in got] == [c for _, c in rows]
    assert time.monotonic() - start < 20
    line = F.lit(f"at Empalme de Fibra (Tipo 3 {deep(7, 'y')}, 'ET9') 'no'")
    assert spark.range(1).select(T.splice_label(line).alias("s")).first().s == "(EM 3) | ET9"


def test_brackets_beyond_the_pattern(spark):
    """Texts on both sides of the depth that one pattern covers, long ones, and ones left open."""
    texts = []
    for deep in (0, 1, T.PATTERN_DEPTH - 1, T.PATTERN_DEPTH, T.PATTERN_DEPTH + 1, 3 * T.PATTERN_DEPTH):
        inner = "a" + "(b" * deep + "c)" * deep
        texts += [(f"m ({inner}) rest (x)", inner), (f"m ({inner}", ""), (f"m (({inner}) 'x'", "")]
    wide = "(a)b" * 5000
    texts += [(f"m ({wide})", wide), (f"m ({wide}", ""), ("m ()" + "(" * 40, ""), ("n (a)", ""), (None, "")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, line string")
    got = {r.i: r.found for r in df.select("i", T.inside_brackets(F.col("line"), "m ").alias("found")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(texts)}


@pytest.mark.parametrize("label", [T.cable_label, T.splice_label])
def test_labels_look_for_their_text_once(spark, label):
    df = spark.createDataFrame([("x",)], "line string").select(label(F.col("line")))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("locate(") <= 4


@pytest.mark.parametrize("size", [1, 3, 50])
def test_long_traces_are_cut_and_short_ones_are_not(spark, monkeypatch, size):
    r = random.Random(size)
    kinds = [FIBRE, SECOND, "Edificio 'A'", "Edificio 'NODO B'", splice("ET1"), splice("EA2"), "Port (1) Card (2)", "x"]
    rows = [(f, i, r.choice(kinds)) for f, n in (("long", 60), ("short", 9), ("one", 1)) for i in range(1, n + 1)]
    rows += [(None, 1, FIBRE)]
    df = spark.createDataFrame(rows, "file_path string, line_no int, line string")
    chunk = [F.floor(F.col("line_no") / size)]
    whole = sorted(map(str, T.trace_elements(df, chunk=chunk).collect()))
    for lines in (0, 9):
        monkeypatch.setattr(T, "LINES_PER_CHUNK", lines)
        assert sorted(map(str, T.trace_elements(df, chunk=chunk).collect())) == whole


def test_short_traces_are_windowed_whole(spark):
    """A chunk of its own for every line would carry as many rows as there are lines."""
    seen = []
    real = T.carry_forward
    T.carry_forward = lambda df, *a, **b: seen.append(df) or real(df, *a, **b)
    try:
        rows = [("f", i, FIBRE if i == 1 else splice(f"ET{i}")) for i in range(1, 30)]
        T.trace_elements(spark.createDataFrame(rows, "file_path string, line_no int, line string"), chunk=[F.col("line_no")])
    finally:
        T.carry_forward = real
    assert seen[0].select("file_path", "_chunk0").distinct().count() == 1


def test_a_building_line_given_twice_lists_its_ports_twice(spark):
    rows = [(1, FIBRE), (2, "Edificio 'A'"), (2, "Edificio 'A'"), (3, "Port (4) Card (7)"), (4, splice("ET1"))]
    df = spark.createDataFrame([("f", *r) for r in rows], "file_path string, line_no int, line string")
    assert {r.elemento for r in T.trace_elements(df).collect()} == {"(ED) A | 7, 4, 7, 4", "(EM 1) | ET1"}
