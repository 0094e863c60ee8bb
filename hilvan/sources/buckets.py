"""Tables partitioned by id bucket, of which an edit reads and rewrites only the touched buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hilvan.operators.bulk import split_line
from hilvan.session import cut_lineage

BUCKETS = 256
BUCKET = "_bucket"


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_buckets(rows: DataFrame, path: str, key: str = "id", buckets: int = BUCKETS) -> None:
    """Writes a table in bucket folders; one shuffle, the only one that the table ever needs."""
    placed = rows.withColumn(BUCKET, bucket_of(key, buckets))
    placed.repartition(buckets, BUCKET).write.partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def touched_buckets(lines: DataFrame, separator: str, buckets: int = BUCKETS) -> list[int]:
    """Buckets of the ids that lines begin with; at most ``buckets`` numbers reach the driver."""
    asked = lines.select(F.get(split_line("line", separator), 0).try_cast("bigint").alias("_id"))
    found = asked.filter("_id IS NOT NULL").select(bucket_of("_id", buckets).alias("b")).distinct()
    return sorted(r["b"] for r in found.collect())


def edit_buckets(
    spark: SparkSession,
    path: str,
    lines: DataFrame,
    edit: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]],
    separator: str = "|",
    key: str = "id",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Applies an edit, ``(rows, lines) -> (rows, ledger)``, to a table of buckets; the ledger.

    Partition pruning leaves the other buckets unread, and a dynamic overwrite leaves them as
    they are. The edited rows are cut off from the files before these are replaced, so a lost
    executor never asks for a file that is gone, and the folder of the table stays throughout.
    A bucket whose last row was deleted is removed. One edit at a time; readers that run
    meanwhile can see some buckets before and some after it.
    """
    touched = touched_buckets(lines, separator, buckets)
    stored = spark.read.parquet(path)
    rows = stored.filter(F.col(BUCKET).isin(touched))
    updated, ledger = edit(rows.drop(BUCKET), lines)
    ledger = cut_lineage(ledger)
    updated = cut_lineage(updated.withColumn(BUCKET, bucket_of(key, buckets)))
    left = {r[BUCKET] for r in updated.select(BUCKET).distinct().collect()}
    if left:
        updated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    for gone in sorted(set(touched) - left):
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{BUCKET}={gone}")
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return ledger
