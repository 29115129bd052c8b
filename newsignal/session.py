"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  Sizes that depend on the
# cluster (executors, memory, shuffle partitions) are left to spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole article texts cross to Python when a model scores them, so batches
    # are bounded by bytes (Spark's own default) and by a modest row count.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "newsignal", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_base() -> str:
    """A temporary folder of this process, removed at its end."""
    base = tempfile.mkdtemp(prefix="newsignal-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` that all executors can reach.

    Only a local session may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = _local_base()
    return f"{base.rstrip('/')}/newsignal/{name}-{uuid.uuid4().hex}"
