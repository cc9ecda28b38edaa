"""Session settings the reports are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that let Spark size, split and re-plan the work at run time. They are
# safe on a laptop and on a large cluster; memory and cores belong to the
# cluster's own configuration.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Where the size of the largest shuffle is not known, a cluster's session starts from so
# many partitions, which adaptive execution merges to fit.
START_PARTITIONS = 8192


def partitions_for(shuffled_bytes: int, target_bytes: int = 256 << 20, least: int = 200) -> int:
    """Shuffle partitions that hold about ``target_bytes`` each.

    Adaptive execution merges small partitions but never makes more of them than it
    starts with, so a large job has to start high enough.
    """
    return max(least, -(-shuffled_bytes // target_bytes))


def build_session(
    app: str = "casetally",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with :data:`SETTINGS`; ``master`` only for local runs.

    ``shuffled_bytes``, the expected size of the largest shuffle, sets how many
    partitions adaptive execution starts from; without it a cluster starts from
    :data:`START_PARTITIONS`, unless ``spark.sql.shuffle.partitions`` is given.
    """
    builder = SparkSession.builder.appName(app)
    start = None
    if shuffled_bytes is not None:
        start = partitions_for(shuffled_bytes)
    elif master is None and "spark.sql.shuffle.partitions" not in extra:
        start = START_PARTITIONS
    if start is not None:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(start)
        )
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
