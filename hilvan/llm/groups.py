"""Shared folder tables and connected groups of links."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Bytes of rows handed to a Python worker at a time. Spark's own limit, 10,000 rows or 64 MB, costs
#: several times as much in the worker, once as a batch and again as cells, and a worker keeps it.
BATCH_BYTES, SMALL_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "2m"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query go when the query ends, not when the driver collects garbage.

    For jobs that write a table after each step, so that no later step reads those files.
    """
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of SMALL_BATCH bytes for jobs that end inside; a session with a limit of its own keeps it."""
    unset = spark.conf.get(BATCH_BYTES, None) is None
    if unset:
        spark.conf.set(BATCH_BYTES, SMALL_BATCH)
    try:
        yield
    finally:
        if unset:
            spark.conf.unset(BATCH_BYTES)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that :func:`stored` wrote, once their successors are written."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("hilvan-"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, *more: DataFrame) -> DataFrame:
    """Writes ``df`` as a table in the folder of ``spark.checkpoint.dir`` and reads it back.

    Further parts with the same columns are written one after the other to the same table.

    As durable as a checkpoint, compressed, and read column by column. Only a local session
    without the setting uses its warehouse folder; a cluster without one is an error, because
    a folder of one machine isn't seen by the others.
    """
    spark = df.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set on this cluster")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    path = f"{shared.rstrip('/')}/hilvan-{uuid.uuid4().hex}"
    for part in (df, *more):
        part.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _sum_of(edges: DataFrame) -> tuple[int, int]:
    seen = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("s")).first()
    return seen["n"], seen["s"] or 0


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); component is the least id of its group.

    Alternates two steps until nothing changes: every node hands its larger neighbours to the
    least node it knows, then its smaller ones. The number of rounds grows with the logarithm
    of the longest path, and no node's neighbours are gathered in one place.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges = stored(edges)
    before = _sum_of(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").union(
            least.select("u", F.col("m").alias("v"))).distinct()
        edges, old = stored(small), edges
        dropped(old)
        after = _sum_of(edges)
        if after == before:
            break
        before = after
    stars = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
    roots = edges.select(F.col("v").alias("id")).distinct().join(stars, "id", "left_anti")
    return stars.union(roots.select("id", F.col("id").alias("component")))
