"""Session set-up and the shared folder that written intermediate tables go to."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# A cluster sets its own partition counts and memory; these are the settings the results or plans depend on.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",  # sums and casts that overflow raise
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on; safe to call on a session somebody else made."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str | int = "*", app: str = "goldenlake", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")  # listing folders, a task each otherwise
    )
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="goldenlake-")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder for one run, below the one the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = _local_scratch()
    return f"{root.rstrip('/')}/goldenlake/{uuid.uuid4().hex}"
