"""Session helpers.

Library functions never create their own session; they take the caller's
and only set *runtime* SQL options that the semantics depend on (UTC time
zone).  ``get_spark`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime options every query relies on.  They are safe to set on a shared
# session: they change no result other than making time arithmetic UTC.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_spark(
    master: str | None = None,
    app: str = "farebox",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FAREBOX_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def _local_folder(spark: SparkSession) -> str:
    """A temporary folder, for a session whose tasks all run on this machine."""
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="farebox-ckpt-")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (set by the cluster).  Only
    when the session has none – local tests – a temporary folder is created
    and registered as the checkpoint dir, so ``DataFrame.checkpoint`` works too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = _local_folder(spark)
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), "farebox", *parts, uuid.uuid4().hex])


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable: keep the cluster's setting."""
    if spark.sparkContext.getCheckpointDir():
        return
    base = spark.conf.get("spark.checkpoint.dir", None) or _local_folder(spark)
    spark.sparkContext.setCheckpointDir(base)
