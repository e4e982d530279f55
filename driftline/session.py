"""Session settings the engine relies on, and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings that change results.  They are applied to every session
# the engine touches (``apply_session_conf``), so a driver-provided session
# behaves the same as one built here.
ENGINE_SQL_CONF = {
    # JSON field names are compared case-sensitively: `Id` and `id` are two columns.
    "spark.sql.caseSensitive": "true",
    # Duplicate keys in one JSON object: the last value wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Epoch millis / ISO instants are UTC; TIMESTAMP_NTZ columns hold UTC wall time.
    "spark.sql.session.timeZone": "UTC",
    # Replaying one micro-batch rewrites only that batch's hidden partition.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Coercion projections are wide CASE trees; a whole-stage method above
    # HotSpot's 8000-byte limit would never be JIT-compiled, so such stages
    # fall back to split expression code instead (Spark's documented setting).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The first columns of a wide table: ranked rows are cut per partition up to this rank.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    # A task keeps this many folders of a write open at once, instead of sorting (and
    # spilling) all its records by folder first; only records of more folders are sorted.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Of files that a task writes side by side: what each may hold in memory.
SIDE_BY_SIDE = {"parquet.block.size": str(16 << 20)}


def apply_session_conf(spark: SparkSession) -> SparkSession:
    for key, value in ENGINE_SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app_name: str = "driftline",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests.  On a cluster, pass ``master=None`` and
    let spark-submit supply the master and resources."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # Wide tables need thousands of Column calls on the driver; noting a call site for each doubles their cost.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in ENGINE_SQL_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_session_conf(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Where it is unset, a session inside one process
    (master ``local``) registers a folder of its own, so that later reads
    agree; any other master must name a folder, since executors do not see the
    driver's own."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        jdir = sc._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="driftline-"))
        root = sc._jsc.sc().getCheckpointDir().get()
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder (optionally with a fresh leaf); Spark's
    writers create it where that folder lives."""
    path = "/".join([checkpoint_root(spark), "driftline", *parts])
    return f"{path}-{uuid.uuid4().hex[:12]}" if unique else path
