"""Readers and writers on real files."""

import pytest
import os

from pyspark.sql import functions as F

from hilvan.sources import lines as L
from hilvan.sources import tables as T


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return path


def test_line_numbers_of_split_files(spark, tmp_path):
    big = [f"line {i} {'x' * (i % 50)}" for i in range(5000)]
    write(tmp_path / "in" / "big.txt", "\n".join(big) + "\n")
    write(tmp_path / "in" / "sub" / "small.txt", "﻿uno\n\ndos\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = L.read_lines(spark, str(tmp_path / "in"), "*.txt")
        assert got.select(F.spark_partition_id()).distinct().count() > 1
        rows = {(r.file, r.line_no): r.line for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected = {("big.txt", i): x for i, x in enumerate(big, 1)}
    expected |= {("small.txt", 1): "uno", ("small.txt", 2): "", ("small.txt", 3): "dos"}
    assert rows == expected


def test_trace_exclusions(spark, tmp_path):
    for folder, name in (("A", "x"), ("A", "y"), ("B", "z")):
        write(tmp_path / folder / f"{name}.txt", "l\n")
    out = spark.createDataFrame([(" B",), ("y",), (None,)], "name string")
    assert [(r.folder, r.stem) for r in L.read_trace(spark, str(tmp_path), out).collect()] == [("A", "x")]


def test_central_sheets(spark, tmp_path):
    header = ",Puerto,ODF puerto,Cassetera,POS,\n,EQUIPO BOGOTA1 x,,,,\n" + ",,,,,\n" * 4
    write(tmp_path / "con.csv", header + ',001/2,ODF 7,a,"1,2",\n,3/4,p9,B,5,\n')
    write(tmp_path / "sin.csv", "t,,,,,\n,,,,,\n" + "t,,,,,\n" * 4 + "1,x,01/1,4,C,6\n")
    write(tmp_path / "sin2.csv", "t,,,,,\n" * 6 + ",02/1,8,D,7,\n")
    rows = L.central_sheets(L.read_lines(spark, str(tmp_path), "*.csv")).orderBy("archivo", "line_no").collect()
    got = [(r.archivo, r.equipo, r.puerto, r.odf, r.odf_original, r.cassetera, r.pos) for r in rows]
    assert got == [
        ("con.csv", "BOGOTA1", "1/2", "7", "ODF 7", "a", "1,2"),
        ("con.csv", "BOGOTA1", "3/4", "9", "p9", "B", "5"),
        ("sin.csv", "sin", "1/1", "4", "4", "C", "6"),
        ("sin2.csv", "sin2", "2/1", "8", "8", "D", "7"),
    ]


def test_cable_sheets(spark, tmp_path):
    write(tmp_path / "12-3.csv", "EC,PORT_EC,PATCHEO,HILO,ANILLO ORIGEN,BUL\nEQ,001/2,1-A2,7,x_MEZONA1,1\nEQ,1/2,1-A2,7,x,0\n,,,7,x,1\n")
    write(tmp_path / "otro.csv", "EC,BUL\nEQ,1\n")
    write(tmp_path / "~$tmp.csv", "EC,PORT_EC,PATCHEO,BUL\nEQ,1,1,1\n")
    rows = L.cable_sheets(L.read_lines(spark, str(tmp_path), "*.csv")).collect()
    assert [(r.fibra, r.ec, r.port_ec, r.patcheo, r.odf_calle, r.hilo, r.anillo) for r in rows] == [
        ("12-3", "EQ", "1/2", "1-A2", None, "7", "MEZONA1")
    ]


def test_first_values(spark):
    df = spark.createDataFrame([("a", 2, "ANILLO: dos"), ("a", 1, "ANILLO:  "), ("a", 3, "ANILLO: tres"), ("b", 1, "x")], "f string, n int, line string")
    from hilvan.functions.text import labelled_value

    got = L.first_values(df, "f", ["n"], {"anillo": labelled_value("line", "ANILLO:")})
    assert {r.f: r.anillo for r in got.collect()} == {"a": "dos", "b": ""}


def test_loads(spark, tmp_path):
    src = write(tmp_path / "src" / "Mi Tabla-1.csv", "Id,Año Base,Año Base\n01,x,y\n,,\n02,z,\n")
    assert T.load_many(spark, [str(src)], "raw_").collect() == [("raw_mi_tabla_1", 2)]
    table = spark.table("raw_mi_tabla_1")
    assert [t for _, t in table.dtypes] == ["string"] * 3 and table.columns[0] == "id"
    assert sorted(r[0] for r in table.collect()) == ["01", "02"]
    assert T.load_table(T.read_text_table(spark, str(src)), "raw_mi_tabla_1", "append") == 2
    assert spark.table("raw_mi_tabla_1").count() == 4


def test_loads_side_by_side(spark, tmp_path):
    paths = [str(write(tmp_path / "many" / f"t{i}.csv", "Id\n" + "x\n" * i)) for i in range(1, 6)]
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    assert [tuple(r) for r in T.load_many(spark, paths, "side_").collect()] == [(f"side_t{i}", i) for i in range(1, 6)]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    twice = [paths[0], str(write(tmp_path / "other" / "t1.csv", "Id\ny\nz\n"))]
    assert [r.rows for r in T.load_many(spark, twice, "side_", if_exists="append").collect()] == [1, 2]
    assert spark.table("side_t1").count() == 4
    missing = [str(tmp_path / "no1.csv"), str(tmp_path / "no2.csv")]
    with pytest.raises(RuntimeError, match=r"no1\.csv.*no2\.csv"):
        T.load_many(spark, [missing[0], paths[1], missing[1]], "late_")
    assert spark.table("late_t2").count() == 2
    assert T.load_many(spark, []).collect() == []


def test_incremental_load(spark, tmp_path):
    src = write(tmp_path / "datos.csv", "Clave,Valor\na,1\nb,2\n")
    args = (spark, str(src), "inc_table", "inc_control", ["clave"])
    assert T.load_incremental(*args) == (True, 2)
    assert T.load_incremental(*args) == (False, 0)
    write(src, "Clave,Valor\nb,3\nc,4\n")
    os.utime(src, (2_000_000_000, 2_000_000_000))
    assert T.load_incremental(*args) == (True, 2)
    assert {tuple(r) for r in spark.table("inc_table").collect()} == {("a", "1"), ("b", "3"), ("c", "4")}
    assert spark.table("inc_control").count() == 1


def test_inventory_and_reports(spark, tmp_path):
    write(tmp_path / "in" / "sub" / "plano.dwg", "x" * 2048)
    write(tmp_path / "in" / "b.DWG", "y")
    inv = T.file_inventory(spark, str(tmp_path / "in"), "*.{dwg,DWG}")
    got = {r.archivo: (r.extension, r.carpeta_padre, r.tamano_bytes, r.nivel_profundidad) for r in inv.collect()}
    assert got == {"plano.dwg": (".DWG", "sub", 2048, 1), "b.DWG": (".DWG", "in", 1, 1)}
    T.write_report({"uno": inv, "dos": inv.limit(1)}, str(tmp_path / "rep"))
    assert spark.read.parquet(str(tmp_path / "rep" / "uno")).count() == 2
    T.write_csv(inv.select("archivo").coalesce(1), str(tmp_path / "csv"))
    part = next((tmp_path / "csv").glob("part-*.csv"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbfarchivo")


def test_panel_table_is_stamped(spark):
    assert "fecha_actualizacion" in T.stamped(spark.range(1)).columns
    T.ensure_layers(spark)
    assert {"raw", "clean", "staging"} <= {d.name for d in spark.catalog.listDatabases()}


def test_failed_rename_leaves_the_old_table(spark, monkeypatch):
    from hilvan.sources import tables

    spark.sql("DROP TABLE IF EXISTS kept_rows")
    spark.createDataFrame([(1,)], "a int").write.saveAsTable("kept_rows")
    real = type(spark).sql

    def failing(self, text, *rest, **named):
        if "__next RENAME" in text:
            raise RuntimeError("rename failed")
        return real(self, text, *rest, **named)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        tables.replace_from_self(spark.createDataFrame([(2,)], "a int"), "kept_rows")
    monkeypatch.undo()
    assert [r.a for r in spark.table("kept_rows").collect()] == [1]
    spark.sql("DROP TABLE IF EXISTS kept_rows__next")
    tables.replace_from_self(spark.createDataFrame([(3,)], "a int"), "kept_rows")
    assert [r.a for r in spark.table("kept_rows").collect()] == [3]
    spark.sql("DROP TABLE kept_rows")


def test_cells_of_a_line(spark):
    lines = ['a,b', 'a,', '', '"x, ""y""" , z', '"open,b', '"",c', '"a"b,c', '"a ""b", c', None, "x," * 5000]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = df.select("i", F.transform(L.cells(F.col("line")), L.cell_text).alias("c")).orderBy("i").collect()
    assert [r.c for r in got] == [
        ["a", "b"], ["a", None], [None], ['x, "y"', "z"], ['"open', "b"], [None, "c"], ['"a"b', "c"], ['a "b', "c"], None,
        ["x"] * 5000 + [None],
    ]


@pytest.mark.parametrize("width", [60, 600])
def test_wide_cable_sheets(spark, tmp_path, width):
    names = [f"c{i}" for i in range(width)]
    names[width - 7 :] = ["EC", "PORT_EC", "PATCHEO", "PORT_OT", "HILO", "ANILLO ORIGEN", "BUL"]
    body = [",".join([*([""] * (width - 7)), f"E{i}", "1/1", "T-1/2", "OT", "3", "R", str(i % 2)]) for i in range(4)]
    (tmp_path / "wide.csv").write_text("\n".join([",".join(names), *body]))
    rows = L.cable_sheets(L.read_lines(spark, str(tmp_path), "*.csv")).collect()
    assert {(r.fibra, r.ec, r.patcheo, r.hilo) for r in rows} == {("wide", "E1", "T-1/2", "3"), ("wide", "E3", "T-1/2", "3")}


def test_cable_sheets_cut_lines_last(spark, tmp_path):
    """No row carries its cells through a join or a group: they are cut where they are read."""
    write(tmp_path / "1.csv", "\nEC,PORT_EC,PATCHEO,BUL\nEQ,1/2,1-A2,1\nEQ,1/3,,0\n")
    df = L.cable_sheets(L.read_lines(spark, str(tmp_path), "*.csv"))
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert all("Generate" in row for row in plan if "regexp_extract_all" in row)
    assert [(r.ec, r.port_ec, r.line_no) for r in df.collect()] == [("EQ", "1/2", 3)]
