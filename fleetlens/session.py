"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime settings every plan of this package relies on; all are SQL settings that may be set on a live session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where that costs one more shuffle of its result.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Map state and timers of streams.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "fleetlens") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("FLEETLENS_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="fleetlens-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
