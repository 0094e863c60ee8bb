import os

import pytest

from hilvan.operators import bulk as B
from hilvan.sources import buckets as K

EDIT = B.Edit("port", "name")


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(500).selectExpr("id", "'n' || id AS name")
    path = str(tmp_path / "table")
    K.write_buckets(rows, path, buckets=32)
    return path, rows


def lines_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "line_no bigint, line string")


def test_edit_touches_its_buckets_only(spark, table):
    path, rows = table
    lines = lines_of(spark, ["7|a", "7|b", "9999|c", "x|d", "8", "11|e"])
    before = files_of(path)
    ledger = K.edit_buckets(spark, path, lines, lambda t, x: B.bulk_update(t, x, EDIT), buckets=32)
    want, log = B.bulk_update(rows, lines, EDIT)
    assert sorted(map(tuple, ledger.collect())) == sorted(map(tuple, log.collect()))
    assert sorted(map(tuple, K.read_buckets(spark, path).select("id", "name").collect())) == sorted(map(tuple, want.collect()))
    touched = K.touched_buckets(lines, "|", 32)
    after = files_of(path)
    kept = {f for f in before if int(f.split("_bucket=")[1].split("/")[0]) not in touched}
    assert len(touched) < 6 and kept and all(after.get(f) == before[f] for f in kept)


def test_plan_prunes_and_does_not_shuffle_the_table(spark, table, tmp_path):
    path, _ = table
    lines_of(spark, ["7|a"]).write.parquet(str(tmp_path / "lines"))
    lines = spark.read.parquet(str(tmp_path / "lines"))
    rows = spark.read.parquet(path).filter(f"_bucket = {K.touched_buckets(lines, '|', 32)[0]}")
    assert all("_bucket=" in f for f in rows.inputFiles())
    updated, _ = B.bulk_update(rows.drop("_bucket"), lines, EDIT)
    plan = updated._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan and "SortMergeJoin" not in plan


def test_emptied_bucket_and_no_lines(spark, table):
    path, _ = table
    gone = [r.id for r in spark.read.parquet(path).filter("_bucket = 5").collect()]
    K.edit_buckets(spark, path, lines_of(spark, [str(i) for i in gone]), B.bulk_delete, buckets=32)
    left = {r.id for r in K.read_buckets(spark, path).collect()}
    assert left == set(range(500)) - set(gone) and gone
    before = files_of(path)
    K.edit_buckets(spark, path, lines_of(spark, ["", "x"]), B.bulk_delete, buckets=32)
    assert files_of(path) == before
