"""Session settings for tests and local runs; a cluster brings its own."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tallyforge", cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """A local session with adaptive execution and UTC timestamps."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; timestamps stay TIMESTAMP_NTZ as they are stored."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share: ``spark.checkpoint.dir``; where that is unset, as
    in tests on one machine, a temporary folder becomes it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="tallyforge-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
