"""A session with the settings the operators assume."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str = "quireflow", **conf: str) -> SparkSession:
    """UTC, adaptive execution, skew joins split. Settings of a running session stay as they are."""
    b = SparkSession.builder.appName(app)
    for k, v in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }.items():
        b = b.config(k, v)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A local session without one gets one here. On a cluster a machine's own folder would lose rows, so there
    the setting must be made.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="quireflow-shared-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder; it goes when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(place)
    fs.deleteOnExit(place)  # only what is there can be marked
    return path
