"""Arriving files and arriving edits."""

from hilvan.operators.bulk import Edit
from hilvan.streaming.ingest import apply_arriving_edits, load_new_files


def test_only_new_files_are_loaded(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()

    def run():
        query = load_new_files(spark, str(inbox), ["id", "name"], str(tmp_path / "raw"), str(tmp_path / "cp"), "*.csv")
        query.awaitTermination()
        return sorted((r.id, r.name) for r in spark.read.parquet(str(tmp_path / "raw")).collect())

    (inbox / "a.csv").write_text("id,name\n01,x\n")
    assert run() == [("01", "x")]
    (inbox / "b.csv").write_text("id,name\n02,y\n")
    assert run() == [("01", "x"), ("02", "y")]
    assert run() == [("01", "x"), ("02", "y")]


def test_arriving_edits(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    versions = tmp_path / "versions"
    spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string").write.parquet(str(versions / "start"))
    state = {"current": str(versions / "start")}

    def write_target(df, batch_id):
        path = str(versions / f"batch{batch_id}")
        df.write.mode("overwrite").parquet(path)
        state["current"] = path

    def write_ledger(df, batch_id):
        df.drop("line_no").write.mode("overwrite").parquet(str(tmp_path / "ledger" / f"batch={batch_id}"))

    def run():
        apply_arriving_edits(
            spark, str(inbox), str(tmp_path / "cp"), Edit("t", "name"),
            lambda: spark.read.parquet(state["current"]), write_target, write_ledger,
        ).awaitTermination()
        return {r.id: r.name for r in spark.read.parquet(state["current"]).collect()}

    (inbox / "1.txt").write_text("1|x\n1|y\n9|z\n")
    assert run() == {1: "y", 2: "b"}
    (inbox / "2.txt").write_text("2|w\n")
    assert run() == {1: "y", 2: "w"}
    ledger = [r.ledger_line for r in spark.read.parquet(str(tmp_path / "ledger" / "*")).collect()]
    assert sorted(ledger) == ["1|x|EXITOSO", "1|y|EXITOSO", "2|w|EXITOSO", "9|z|FALLIDO"]
