"""Session settings the jobs are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE picks join strategies and partition counts from run-time sizes. Skew is handled in the plans themselves
# (operators/skew.py); AQE's skew join stays on as a second line for joins of two plain scans.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: Bytes of the batches that go to Python workers. A batch is held by the JVM (its buffers grow by doubling) and by the
#: worker, outside the heap and for each task; Spark's bound is 64 MB.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the batches of whole texts by `BATCH_BYTES` from now on in this session; a smaller bound stays."""
    held = spark.conf.get(BATCH).lower().removesuffix("b")
    scale = 1 << 10 * (" kmgtp".find(held[-1]) if held[-1] in "kmgtp" else 0)
    if int(held.rstrip("kmgtp")) * scale > BATCH_BYTES:
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")


def build_session(app_name: str = "refsync", **extra: str) -> SparkSession:
    """Session with the settings above; `extra` overrides or adds (dots written as double underscores)."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
