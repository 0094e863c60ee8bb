"""Files as they arrive: raw loads, and keyed edits with a ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hilvan.operators.bulk import Edit, bulk_update


def load_new_files(
    spark: SparkSession, path: str, columns: list[str], target: str, checkpoint: str,
    pattern: str | None = None,
) -> StreamingQuery:
    """Appends files that were not loaded before, all fields as text, then stops.

    The file source remembers names only: a changed file of the same name is left to the
    control table of the batch load. A file whose header differs from ``columns``, also in
    order, is an error: fields are never taken by position alone.
    """
    reader = spark.readStream.schema(", ".join(f"`{c}` STRING" for c in columns)).option(
        "header", "true").option("enforceSchema", "false")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    arriving = reader.csv(path).withColumn("source_file", F.col("_metadata.file_name"))
    return (
        arriving.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def apply_arriving_edits(
    spark: SparkSession, path: str, checkpoint: str, edit: Edit,
    read_target: Callable[[], DataFrame], write_target: Callable[[DataFrame, int], None],
    write_ledger: Callable[[DataFrame, int], None], key: str = "id",
) -> StreamingQuery:
    """Applies arriving change lines batch by batch.

    Lines of a batch are ordered by file time, file name and place in the file. The
    writers get the batch number and must overwrite what an earlier try of the same
    batch left, so a repeated batch does no harm.
    """
    arriving = spark.readStream.text(path).select(
        F.col("_metadata.file_modification_time").alias("_time"),
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("value").alias("line"),
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        # A struct orders the lines; the last good line of an id wins by it.
        numbered = batch.select(
            F.struct("_time", "_file", "_block", F.monotonically_increasing_id()).alias("line_no"), "line"
        )
        updated, ledger = bulk_update(read_target(), numbered, edit, key)
        write_ledger(ledger.withColumn("batch", F.lit(batch_id)), batch_id)
        write_target(updated, batch_id)

    return (
        arriving.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
