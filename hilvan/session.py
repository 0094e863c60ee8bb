"""Session settings and lineage cutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "hilvan",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution on; cluster settings win over defaults here.

    ``shuffle_partitions`` is left to the cluster when not given: adaptive execution
    coalesces small shuffles and splits skewed ones at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Methods beyond this size are never compiled by the JVM; such stages run faster
        # as split expressions.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder that the cluster names.

    The folder is read from the session (``spark.checkpoint.dir``). Only a local
    session without the setting uses its warehouse folder instead; a cluster without one
    is an error, because a machine-local folder is lost with its executor.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Writes ``df`` as a table in the same shared folder and reads it back.

    As durable as a checkpoint, compressed, and read column by column, so it is the better
    cut where many branches read some columns each. It stays until the folder is emptied.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/hilvan-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set on this cluster")
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    return shared
