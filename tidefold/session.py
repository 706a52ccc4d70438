"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Settings the operators are planned for; sizes are left to AQE.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # The JVM never compiles methods above 8000 bytes of code; the wide parsing projections
    # run faster operator by operator than in one generated method of that size.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(app: str, cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "12g")
    )
    for name, value in {**SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return root.rstrip("/")


@cache
def _local_root() -> str:
    """One folder of this machine for as long as this process lives; the setting itself cannot be changed in a running session."""
    return tempfile.mkdtemp(prefix="tidefold-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else writes to."""
    return f"{shared_dir(spark)}/tidefold/{name}-{uuid.uuid4().hex}"
