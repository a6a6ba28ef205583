"""A Spark session with the settings that results depend on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, **settings: str) -> SparkSession:
    """UTC, ANSI arithmetic and adaptive execution; ``settings`` are added as they are (dots as ``__``)."""
    builder = SparkSession.builder.appName("ledgerline")
    if master:
        builder = builder.master(master)
    fixed = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in (fixed | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below the one the cluster names in spark.checkpoint.dir.

    Where the setting is absent a temporary folder will do on one machine; on a cluster, whose executors would not see it,
    that is an error.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A path below the shared folder that nothing has."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The table, written once to the shared folder: what is drawn or numbered while it is made stays as it is, whatever is lost later."""
    path = fresh_path(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path and the path as it knows it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), found
