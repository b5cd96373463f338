"""Session settings the jobs are written for.

Only runtime-safe SQL settings live here; executor counts and memory belong to
the cluster's own submit configuration.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_SETTINGS = {
    # Runtime re-planning: coalesces small shuffle partitions, splits skewed
    # ones and turns a join into a broadcast join once a side is known small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join may run on a partitioning by some of its keys, as the triangle grid's does.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Size checks behind every broadcast this library lets Spark choose: a
    # cohort of a few million 13-digit numbers passes, a fact table never does.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    # A re-run of a late period replaces that period only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Checkpoints of intermediate results go when their frame goes.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024
FEWEST_PARTITIONS, MOST_PARTITIONS = 200, 100_000


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Initial number of shuffle partitions for the largest expected shuffle.

    Adaptive execution merges small partitions but never adds any, so the start
    has to fit the largest shuffle: 100 TB asks for the maximum, about 1 GB each.
    """
    wanted = -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES)
    return max(FEWEST_PARTITIONS, min(MOST_PARTITIONS, wanted))


def build_session(
    app_name: str,
    master: str | None = None,
    shuffled_bytes: int | None = None,
    **extra: str,
) -> SparkSession:
    """Create (or fetch) a session with :data:`SQL_SETTINGS` applied.

    ``shuffled_bytes`` sizes the shuffles; ``extra`` overrides any setting.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    sized = {}
    if shuffled_bytes is not None:
        count = str(shuffle_partitions(shuffled_bytes))
        sized["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = count
    for key, value in {**SQL_SETTINGS, **sized, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
