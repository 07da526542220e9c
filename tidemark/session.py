"""Session construction and cluster-level settings.

Everything here is plain SparkSession configuration. On a cluster the session
already exists and carries its own settings; :func:`tune` only fills in values
that are unset, so a cluster's choices always win.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the package relies on. Values are the defaults we want
# when nothing else is configured; the session's own values take precedence.
_BASE_CONF = {
    # Timestamps in the inputs are zone-less; with the session on UTC date_trunc
    # and casts give the same calendar weeks on every executor.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, turn sort-merge joins into broadcast joins when a side
    # turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    # Per-call Python call-site capture (error context for notebooks) costs
    # two JVM round trips per column function while plans are built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str = "local[8]", app: str = "tidemark",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (on a cluster use the given one)."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(_BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the package's runtime SQL settings where the session has none."""
    for k, v in _BASE_CONF.items():
        # Only runtime settings can change on a live session; static ones
        # (UI, call-site capture) are for sessions built here.
        if not spark.conf.isModifiable(k) or spark.conf.get(k, None) is not None:
            continue
        spark.conf.set(k, v)
    # Weeks and days are cut in UTC, unless the caller has chosen a zone, in the context's
    # settings or on the session.
    if not spark._jsparkSession.sessionState().conf().contains("spark.sql.session.timeZone"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    ``spark.checkpoint.dir`` as the session has it; where it is unset, a folder
    below the warehouse, which driver and executors share as well.
    """
    sc = spark.sparkContext
    path = (spark.conf.get("spark.checkpoint.dir", None)
            or sc.getConf().get("spark.checkpoint.dir", None)
            or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def staged(df, tag: str) -> tuple[DataFrame, Callable[[], None]]:
    """Write ``df`` as a new Parquet table in the shared folder; return it read
    back, and a function that deletes its files when no plan needs them."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)

    def discard() -> None:
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)

    return spark.read.schema(df.schema).parquet(path), discard
