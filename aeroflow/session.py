"""Session settings and the shared folder that jobs write to."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Results depend on these, so they are set on whatever session we are given.
REQUIRED_SETTINGS = {
    # Wire timestamps carry offsets; tables hold them in UTC.
    "spark.sql.session.timeZone": "UTC",
    # INT96 has no min/max statistics, so time filters could not skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in REQUIRED_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int = 8, app: str = "aeroflow", **settings: str) -> SparkSession:
    """A single-machine session for tests and the bench run."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path below the folder that every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one process, may fall back to a
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root()
    return "/".join([root.rstrip("/"), "aeroflow", spark.sparkContext.applicationId, *parts])


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="aeroflow-")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A shared folder nobody has written to yet."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")
