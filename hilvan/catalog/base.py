"""Reading the given tables, and input shapes written once for Spark and SQL.

An input shape is a list of select expressions that both engines read alike, so the
query and its SQL start from the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Order of lineitem rows: (l_orderkey, l_linenumber) is not unique.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shape(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str]) -> DataFrame:
    return table(spark, sf_dir, name).selectExpr(*columns)


def select(name: str, columns: Sequence[str], where: str = "") -> str:
    return f"SELECT {', '.join(columns)} FROM {name}" + (f" WHERE {where}" if where else "")
