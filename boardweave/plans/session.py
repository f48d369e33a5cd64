"""Runtime settings the jobs expect; all can be changed on a live session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Above about 8000 bytecodes the JVM never compiles a method. The typed
# projection is wide enough to exceed that when fused into one generated
# method; with this limit Spark splits such a stage into smaller methods.
JIT_METHOD_LIMIT = "8000"


# For the session builder: a whole run generates more classes than the default
# cache of 100 holds, and an evicted class is compiled from cold again.
BUILDER_CONF = {"spark.sql.codegen.cache.maxEntries": "2000"}

# Keeps streaming state on disk, beyond what executors have in memory.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def tune(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_METHOD_LIMIT)
    spark.conf.set(*STATE_STORE)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without one gets a folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="boardweave-"))
    return sc.getCheckpointDir()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
