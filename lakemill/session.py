"""Session builder with the settings every operator assumes (UTC, AQE)."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "lakemill", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with AQE; sizes are left to the cluster unless given."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in {**settings, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share. Only a local session may do without it, in a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="lakemill-")
