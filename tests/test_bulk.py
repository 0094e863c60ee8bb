"""Bulk edits: statuses, invariants, upsert and lookups."""

import datetime

import pytest

from hilvan.operators import bulk as B


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(
        [(1, "a", 10, None), (2, "b", 20, None), (3, "c", 30, None)], "id bigint, name string, size bigint, day date"
    )


def lines(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "line_no bigint, line string")


def statuses(ledger):
    return [r.status for r in ledger.orderBy("line_no").collect()]


def test_update(spark, target):
    edit = B.Edit("t", "name")
    ins = lines(spark, "1|x", "1|y", "2", "2|p|q", "9|z", "k|z", "3|")
    updated, ledger = B.bulk_update(target, ins, edit)
    assert statuses(ledger) == ["EXITOSO", "EXITOSO", "FALLIDO", "FALLIDO", "FALLIDO", "FALLIDO", "EXITOSO"]
    assert {r.id: r.name for r in updated.collect()} == {1: "y", 2: "b", 3: ""}
    assert ledger.count() == 7 and updated.count() == 3
    assert ledger.filter("line_no = 3").first().ledger_line == "2|FALLIDO"


def test_update_other_separator_and_success_log(spark, target):
    edit = B.Edit("t", "name", separator="&&&", log="success")
    _, ledger = B.bulk_update(target, lines(spark, "1&&&x", "1|x", "7&&&x"), edit)
    assert [r.ledger_line for r in ledger.collect()] == ["1&&&x&&&EXITOSO"]


def test_update_verified_number(spark, target):
    edit = B.Edit("t", "size", "number", verify=True)
    updated, ledger = B.bulk_update(target, lines(spark, "1|5", "2|x", "3|1.5", "9|1", "1"), edit)
    assert statuses(ledger) == [
        "EXITOSO", "FALLIDO|ERROR_EN_EJECUCION", "FALLIDO|NO_CAMBIO", "FALLIDO|NO_ENCONTRADO", "FALLIDO|FORMATO_INCORRECTO",
    ]
    assert {r.id: r["size"] for r in updated.collect()} == {1: 5, 2: 20, 3: 30}


def test_update_date_and_unread_lines(spark, target):
    edit = B.Edit("t", "day", "date", texts=B.DATED, max_lines=2)
    updated, ledger = B.bulk_update(target, lines(spark, "1|05/02/2024", "9|ayer", "2|2024-01-01"), edit)
    # The studied scripts lose the lines after the last one read.
    assert statuses(ledger) == ["EXITOSO", "FALLIDO - fecha no parseable", "SIN_PROCESAR"]
    assert updated.filter("id = 1").first().day == datetime.date(2024, 2, 5)


def test_update_is_idempotent(spark, target):
    ins = lines(spark, "1|x", "2|y")
    once, _ = B.bulk_update(target, ins, B.Edit("t", "name"))
    twice, _ = B.bulk_update(once, ins, B.Edit("t", "name"))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_delete(spark, target):
    left, ledger = B.bulk_delete(target, lines(spark, "2", "2", "x", "9", " 1 "))
    assert statuses(ledger) == ["EXITOSO", "FALLIDO", "FALLIDO", "FALLIDO", "EXITOSO"]
    assert [r.id for r in left.collect()] == [3]


def test_merge_fields_stand_alone(spark, target):
    fields = (("name", "string"), ("size", "number"), ("day", "date"))
    ins = lines(spark, "1|n1|x|05/02/2024", "1|n2|7|", "2|n", "9|a|1|")
    updated, ledger = B.bulk_merge(target, ins, fields, ("name", "size", "day"))
    assert statuses(ledger) == [
        "CAMPOS_PARCIALES|name:OK, size:ERROR, day:OK", "GS_EXITOSOS",
        "FALLIDO_CAMPOS_INSUFICIENTES (se esperaban 17, se recibieron 2)", "ID_NO_ENCONTRADO",
    ]
    row = updated.filter("id = 1").first()
    assert (row.name, row["size"], row.day) == ("n2", 7, None)


def test_merge_line_has_eighteen_fields():
    assert len(B.MERGE_FIELDS) == 17 and sorted(B.MERGE_REPORT) == sorted(n for n, _ in B.MERGE_FIELDS)


def test_every_edit_is_usable(spark):
    kinds = {"string": "string", "number": "bigint", "date": "date"}
    for edit in B.EDITS.values():
        target = spark.createDataFrame([(1, None)], f"id bigint, {edit.column} {kinds[edit.kind]}")
        value = {"string": "v", "number": "4", "date": "2024-01-01"}[edit.kind]
        _, ledger = B.bulk_update(target, lines(spark, f"1{edit.separator}{value}"), edit)
        assert dict(ledger.dtypes)["status"] == "string"
    assert B.bulk_update(target, lines(spark, "1&&&v"), edit)[1].first().status == "EXITOSO"


def test_upsert(spark, target):
    new = spark.createDataFrame([(2, "B", 0, None), (7, "n", 1, None), (None, "z", 1, None), (None, "z", 2, None)], target.schema)
    out = B.upsert(target, new, ["id", "absent"])
    assert sorted((r.id or 0, r.name) for r in out.collect()) == [(0, "z"), (0, "z"), (1, "a"), (2, "B"), (3, "c"), (7, "n")]
    assert sorted(map(str, B.upsert(out.filter("id IS NOT NULL"), new.filter("id IS NOT NULL"), ["id"]).collect())) == sorted(
        map(str, out.filter("id IS NOT NULL").collect())
    )
    with pytest.raises(ValueError, match="repeated"):
        B.upsert(target, new.union(new), ["id"])
    with pytest.raises(ValueError, match="none of the keys"):
        B.upsert(target, new, ["absent"])


def test_find(spark):
    target = spark.createDataFrame([(5, "n"), (4, "n"), (6, None)], "id bigint, name string")
    by_name = B.find(target, lines(spark, "n", "m"), B.LOOKUPS["building_by_name"]).orderBy("line_no").collect()
    assert [r.output for r in by_name] == ["4&n", "N/A m"]
    by_id = B.find(target, lines(spark, "5", "9", "x"), B.LOOKUPS["cable_by_id"]).orderBy("line_no").collect()
    assert [r.output for r in by_id] == ['"5"|n', "9&!", "x&!"]


def test_remarks_of_a_hot_fibre_go_to_many_tasks(spark):
    from pyspark.sql import functions as F

    from hilvan.operators.ports import append_remarks

    rows = spark.range(400).selectExpr("id", "IF(id % 50 = 0, NULL, ' 7 ') AS fibra", "'V' AS sincroniza").coalesce(1)
    remarks = spark.createDataFrame(
        [("7", "un error", "a", 1), ("7", "bulk file", "b", 2), ("8", "error", "c", 3)],
        "fibra string, estado string, observacion string, seq int")
    out = append_remarks(rows, remarks, "fibra", "sincroniza")
    got = out.withColumn("task", F.spark_partition_id()).collect()
    assert len(got) == 400 and len({r.task for r in got if r.fibra}) > 1
    assert {(r.fibra, r.sincroniza) for r in got} == {(" 7 ", "OM | BULK | V | a | b"), (None, "V")}


def test_a_task_has_the_remarks_of_few_fibres_and_the_longest_first(spark):
    from pyspark.sql import functions as F

    from hilvan.operators.ports import append_remarks

    rows = spark.range(4000).selectExpr("id", "CAST(id % 41 AS STRING) AS fibra", "IF(id % 2 = 0, 'V', NULL) AS sincroniza")
    remarks = spark.range(40).selectExpr(
        "CAST(id AS STRING) AS fibra", "'error' AS estado", "repeat('x', 100 + id % 8 * 1000) AS observacion", "id AS seq")
    got = append_remarks(rows, remarks, "fibra", "sincroniza").withColumn("task", F.spark_partition_id()).collect()
    assert len(got) == 4000
    assert all(r.sincroniza is None or r.sincroniza in ("V", "OM | V") or "x" in r.sincroniza for r in got)
    by_task = {}
    for r in got:
        by_task.setdefault(r.task, []).append((r.fibra, (r.sincroniza or "").count("x")))
    # 64 pieces of each fibre were dealt to every task before, in the order of the fibres' names.
    assert len({(t, f) for t, found in by_task.items() for f, _ in found}) < 41 * len(by_task) * 0.6
    for found in by_task.values():
        sizes = [n for _, n in found]
        assert sizes == sorted(sizes, reverse=True)
