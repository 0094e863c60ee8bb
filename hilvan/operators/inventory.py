"""Summaries of a file inventory: folders, totals, size classes, largest files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hilvan.functions.text import as_column

# Left edges and labels of the size classes in MB; the last is open.
SIZE_EDGES = (0, 0.1, 1, 5, 10, 20, 50, 100, 500, 1000)
SIZE_LABELS = (
    "<0.1", "0.1-1", "1-5", "5-10", "10-20", "20-50", "50-100", "100-500", "500-1000", ">1000",
)


def folder_summary(files: DataFrame, folder: str, size: str, scale: int = 2) -> DataFrame:
    """Files and total size per folder. Sums are decimal, so they do not depend on order."""
    return files.groupBy(folder).agg(
        F.count(F.lit(1)).alias("cantidad_archivos"),
        F.round(F.sum(F.col(size).cast("decimal(28,6)")), scale).cast("double").alias("tamano_total"),
    )


def top_folders(summary: DataFrame, folder: str, n: int = 5) -> DataFrame:
    return summary.orderBy(F.desc("cantidad_archivos"), folder).limit(n)


def global_stats(files: DataFrame, folder: str, size: str, modified: str) -> DataFrame:
    """Rows ``(metrica, valor)`` over all files; one aggregate pass."""
    total = F.sum(F.col(size).cast("decimal(28,6)"))
    fmt = lambda c: F.format_string("%.2f", c.cast("double"))
    row = files.agg(
        F.count(F.lit(1)).cast("string").alias("a"),
        F.count_distinct(folder).cast("string").alias("b"),
        fmt(total).alias("c"),
        fmt(total / F.count(size)).alias("d"),
        fmt(F.max(size)).alias("e"),
        fmt(F.min(size)).alias("f"),
        F.date_format(F.max(modified), "yyyy-MM-dd HH:mm:ss").alias("g"),
        F.date_format(F.min(modified), "yyyy-MM-dd HH:mm:ss").alias("h"),
    )
    return row.selectExpr(
        "stack(8, 'Total archivos', a, 'Total carpetas', b, 'Tamano total', c, "
        "'Tamano promedio', d, 'Archivo mas grande', e, 'Archivo mas pequeno', f, "
        "'Fecha mas reciente', g, 'Fecha mas antigua', h) AS (metrica, valor)"
    )


def size_class(size: Column | str) -> Column:
    """Label of the left-closed size class; null below the first edge."""
    size = as_column(size)
    out = F.when(size < SIZE_EDGES[0], F.lit(None).cast("string"))
    for edge, label in zip(SIZE_EDGES[1:], SIZE_LABELS):
        out = out.when(size < edge, label)
    return out.when(size.isNotNull(), SIZE_LABELS[-1])


def size_histogram(files: DataFrame, size: str) -> DataFrame:
    """Files per size class with the share of all files, empty classes included."""
    spark = files.sparkSession
    labels = spark.range(1).select(
        F.posexplode(F.array(*[F.lit(x) for x in SIZE_LABELS])).alias("orden", "rango")
    )
    # At most eleven rows from here on, whatever the size of the table.
    counts = (
        files.groupBy(size_class(size).alias("rango")).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_share", F.round(F.col("_n") * 100.0 / F.sum("_n").over(Window.partitionBy()), 1))
    )
    return labels.join(counts.filter("rango IS NOT NULL"), "rango", "left").select(
        "orden", "rango", F.coalesce("_n", F.lit(0)).alias("cantidad"),
        F.coalesce(F.col("_share").cast("double"), F.lit(0.0)).alias("porcentaje"),
    )


def largest_files(files: DataFrame, size: str, tie: Sequence[str], n: int = 100) -> DataFrame:
    """Top-k by size; every task keeps its own top k before the final sort."""
    return files.orderBy(F.desc(size), *tie).limit(n)
