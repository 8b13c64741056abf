"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that change results, not only speed.
_SEMANTICS = {
    # A repeated JSON key keeps its last value instead of failing the parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
}

_SPEED = {
    # Streaming state outside the heap: one row per batch or per recent line adds up.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session. Safe to call again."""
    for key, value in {**_SEMANTICS, **_SPEED}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "reqframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_SEMANTICS, **_SPEED}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


# Working folders of local sessions that name none, by application.
_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="reqframe-")
    return _LOCAL_DIRS[app]


def plan_bytes(df) -> int:
    """Catalyst's own upper estimate of a frame's size, used to check a broadcast side."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """Byte limit below which a side may be broadcast (Spark's own setting)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    if text.strip().startswith("-"):
        return -1
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))
