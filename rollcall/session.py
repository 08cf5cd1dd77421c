"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "rollcall", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution on, UTC time and no web page."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; without one, intermediate tables have no place."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and every executor can reach")
    return root.rstrip("/")


def name_scratch(spark: SparkSession, folder: str) -> None:
    """Name ``folder`` as the shared folder of a session on one machine that has none; a cluster must name its own."""
    one_machine = spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")
    if one_machine and not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never an earlier run's."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Materialise ``df`` once in the shared folder and go on from there."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table that this library wrote under the shared folder; nothing else may be named."""
    root = scratch_root(spark)
    if not path.startswith(f"{root}/"):
        raise ValueError(f"{path} is not under {root}")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
