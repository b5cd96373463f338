"""Cutting the lineage of an intermediate result that several branches read."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or what
    ``setCheckpointDir`` named.

    Where neither is set, as in tests, a session on one machine gets a temporary folder;
    on a cluster there is no folder that would do, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="ridgeway-shared-")
    context.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint below :func:`shared_base`. Branches that read the result see
    the same rows in the same partitions, also after an executor is lost."""
    spark = df.sparkSession
    folder = shared_base(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
