"""Tables: all-text scans, loads, upserts, the load control, reports, file inventory."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hilvan.functions.text import as_column
from hilvan.operators.bulk import upsert
from hilvan.sources.columns import loader_name, with_names


def read_text_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, fmt: str = "csv", **options
) -> DataFrame:
    """Full scan with every field as text and only the chosen columns read."""
    reader = spark.read.options(**options)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "false")
    df = reader.format(fmt).load(path)
    return as_text(df.select(*[f"`{c}`" for c in columns]) if columns else df)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def without_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(how="all")


def ensure_layers(spark: SparkSession, layers: Sequence[str] = ("raw", "clean", "staging")) -> None:
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def load_table(df: DataFrame, table: str, if_exists: str = "replace", text: bool = False) -> int:
    """Replaces or appends a table from a raw sheet; returns the rows of the batch."""
    clean = without_empty_rows(with_names(df, loader_name))
    clean = as_text(clean) if text else clean
    written = Observation()
    clean.observe(written, F.count(F.lit(1)).alias("n")).write.mode(
        "overwrite" if if_exists == "replace" else "append"
    ).saveAsTable(table)
    return written.get["n"]


def load_many(
    spark: SparkSession, paths: Sequence[str], prefix: str = "", fmt: str = "csv", if_exists: str = "replace",
    at_once: int = 8,
) -> DataFrame:
    """One table per file; ``(table, rows)``, in the order of ``paths``.

    Each load is its own Spark job; ``at_once`` of them run side by side, each in a scheduler
    pool of its own (pools share the executors evenly where the scheduler's mode is FAIR).
    Files of one table are loaded one after the other. All files are tried; those that fail are
    named together in one error.
    """
    by_table: dict[str, list[int]] = {}
    for place, path in enumerate(paths):
        stem = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
        by_table.setdefault(f"{prefix}{loader_name(stem)}", []).append(place)
    counts: dict[int, tuple[str, int]] = {}
    failed: dict[int, Exception] = {}

    def load(table: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
        for place in by_table[table]:
            try:
                counts[place] = table, load_table(read_text_table(spark, paths[place], fmt=fmt), table, if_exists)
            except Exception as e:  # told below, with the others
                failed[place] = e

    with ThreadPoolExecutor(at_once) as pool:
        # A wrapper for each task: it carries the caller's local properties, which no two tasks share.
        for done in [pool.submit(inheritable_thread_target(spark)(load), table) for table in by_table]:
            done.result()
    if failed:
        raise RuntimeError("not loaded: " + "; ".join(f"{paths[at]}: {e}" for at, e in sorted(failed.items()))
                           ) from failed[min(failed)]
    return spark.createDataFrame([counts[at] for at in sorted(counts)], "table string, rows bigint")


def write_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "append", batch_size: int = 10_000, **options) -> None:
    """Batched insert over JDBC, one connection per partition."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table)
    writer.option("batchsize", batch_size).options(**options).mode(
        "overwrite" if if_exists == "replace" else "append"
    ).save()


def replace_from_self(df: DataFrame, table: str) -> None:
    """Overwrites a table that ``df`` reads: written beside it first, then renamed.

    The old table is set aside before the new one takes its name, and dropped last; if the
    second rename fails, the old table gets its name back.
    """
    spark = df.sparkSession
    beside = f"{table}__next"
    df.write.mode("overwrite").saveAsTable(beside)
    before = f"{table}__before"
    spark.sql(f"DROP TABLE IF EXISTS {before}")
    there = spark.catalog.tableExists(table)
    if there:
        spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
    try:
        spark.sql(f"ALTER TABLE {beside} RENAME TO {table}")
    except Exception:
        if there:
            spark.sql(f"ALTER TABLE {before} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {before}")


def upsert_table(incoming: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Upsert into a stored table; file tables have no MERGE, so it is rewritten."""
    spark = incoming.sparkSession
    if spark.catalog.tableExists(table):
        replace_from_self(upsert(spark.table(table), incoming, keys), table)
    else:
        upsert(incoming.limit(0), incoming, keys).write.saveAsTable(table)


def stamped(df: DataFrame, column: str = "fecha_actualizacion") -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


# --- file inventory and load control --------------------------------------------------

def file_inventory(
    spark: SparkSession, path: str, pattern: str | None = None, root: str | None = None
) -> DataFrame:
    """Name, extension, folder, parent, size, time and depth of every file.

    The content column is not selected, so no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return inventory_columns(
        reader.load(path).select("path", "length", "modificationTime"), root or path
    )


def inventory_columns(files: DataFrame, root: str) -> DataFrame:
    """Inventory columns from ``path``, ``length`` and ``modificationTime``."""
    path = F.regexp_replace("path", "^file:/+", "/")
    base = "/" + root.removeprefix("file:").strip("/")
    name = F.try_element_at(F.split(path, "/"), F.lit(-1))
    folder = F.regexp_replace(path, "/[^/]*$", "")
    inside = F.substring(folder, len(base) + 2, 1 << 30)
    depth = F.when(
        folder.startswith(base), F.when(inside == "", 1).otherwise(F.size(F.split(inside, "/")))
    ).otherwise(0)
    extension = F.regexp_extract(name, r"[^.](\.[^.]*)$", 1)
    return files.select(
        name.alias("archivo"),
        F.upper(extension).alias("extension"),
        path.alias("ruta_completa"),
        folder.alias("carpeta"),
        F.try_element_at(F.split(folder, "/"), F.lit(-1)).alias("carpeta_padre"),
        F.col("length").alias("tamano_bytes"),
        F.round(F.col("length") / (1024 * 1024), 3).alias("tamano_mb"),
        F.col("modificationTime").alias("fecha_modificacion"),
        depth.alias("nivel_profundidad"),
    )


def distinct_files(inventory: DataFrame) -> DataFrame:
    return inventory.dropDuplicates(["ruta_completa"])


def changed_files(inventory: DataFrame, control: DataFrame) -> DataFrame:
    """Files whose time differs from the control table, or that it does not know."""
    known = control.select("file_name", "last_modified")
    return (
        inventory.join(known, F.col("archivo") == F.col("file_name"), "left")
        .filter(~F.col("last_modified").eqNullSafe(F.col("fecha_modificacion")))
        .drop("file_name", "last_modified")
    )


def control_rows(loaded: DataFrame) -> DataFrame:
    return loaded.select(
        F.col("archivo").alias("file_name"),
        F.col("fecha_modificacion").alias("last_modified"),
        F.current_timestamp().alias("last_imported"),
    )


def load_incremental(
    spark: SparkSession, path: str, table: str, control_table: str, keys: Sequence[str] | None = None,
    check: bool = True, fmt: str = "csv",
) -> tuple[bool, int]:
    """Loads one file unless its time is unchanged; full reload or upsert on ``keys``."""
    seen = file_inventory(spark, path)
    has_control = spark.catalog.tableExists(control_table)
    if check and has_control and changed_files(seen, spark.table(control_table)).isEmpty():
        return False, 0
    batch = with_names(read_text_table(spark, path, fmt=fmt))
    if keys:
        upsert_table(batch, table, keys)
    else:
        batch.write.mode("overwrite").saveAsTable(table)
    if check:
        upsert_table(control_rows(seen), control_table, ["file_name"])
    return True, batch.count()


# --- reports --------------------------------------------------------------------------

def write_report(sheets: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """One dataset per sheet under ``path``."""
    for name, df in sheets.items():
        df.write.mode("overwrite").format(fmt).save(f"{path}/{name}")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header; every file starts with a byte-order mark."""
    marked = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0])
    marked.write.mode(mode).option("header", "true").csv(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def first_errors(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    return df.orderBy(*map(as_column, order)).limit(n)
