"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Text scoring is heavy on the processor and light on bytes: do not merge it into one task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    # Split a hot borrower's rows even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Streaming state, where a caller's query keeps any, belongs on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Recording the Python line of every column expression doubles plan-building time.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def build_session(master: str | None = None, name: str = "ledgerloom", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder the cluster shares.

    ``spark.checkpoint.dir`` names that folder.  Only a local session may do without it: a
    folder of this machine is no use to executors elsewhere.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="ledgerloom-")
    return f"{shared.rstrip('/')}/ledgerloom/{purpose}-{uuid.uuid4().hex}"
