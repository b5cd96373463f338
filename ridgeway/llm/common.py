"""Helpers that several operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridgeway.operators.lineage import materialise, shared_base

SHIPPED = "ridgeway-package.zip"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application, so that
    functions which run in Python workers can be imported there."""
    context = spark.sparkContext
    if any(os.path.basename(f) == SHIPPED for f in context._python_includes):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="ridgeway-"), SHIPPED)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one that driver and executors share."""
    return f"{shared_base(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def packed(df: DataFrame, **computed: Column) -> DataFrame:
    """All columns of ``df`` in one struct ``row``, next to computed columns, so
    that no name of the input can clash with a name used on the way."""
    return df.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in computed.items()])


def running_totals(df: DataFrame, order: Sequence[str], totals: dict[str, str]) -> DataFrame:
    """Exclusive running totals over a whole frame in a total order, without
    passing the frame through one task.

    ``totals`` maps a new column to the summed one (the name ``1`` counts rows).
    Rows are range-partitioned by ``order``; each range is summed by itself and
    starts from the sum of the ranges before it, of which there are as many as
    partitions. Pass an order without ties where results must repeat. The frame
    is checkpointed in its ranges; keep it narrow.
    """
    summed = {new: F.lit(1) if old == "1" else F.col(old) for new, old in totals.items()}
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    ranged = materialise(ranged)
    per_range = ranged.groupBy("__range").agg(*[F.sum(c).alias(n) for n, c in summed.items()])
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_range.select(
        "__range", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__at_{n}") for n in totals]
    )
    inside = (
        Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = ranged.select(
        "*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"__in_{n}") for n, c in summed.items()]
    )
    # one row per partition
    placed = local.join(F.broadcast(starts), "__range")
    return placed.select(
        *df.columns, *[(F.col(f"__at_{n}") + F.col(f"__in_{n}")).alias(n) for n in totals]
    )


def at_most(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows. Count a frame
    that has been checkpointed; otherwise it is computed twice."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def open_store(uri: str):
    """``(filesystem, path)`` of a URI as Spark writes them, for use inside tasks.

    Local and shared POSIX folders need nothing further; other schemes go through
    the connector that pyarrow has for them.
    """
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class Finished:
    """A file that appears under its name only when it is complete.

    A task that runs twice writes the same content twice; the second move replaces
    the first file, and what a lost task left unfinished has another name.
    """

    def __init__(self, folder: str, name: str):
        self.fs, base = open_store(folder)
        self.fs.create_dir(base, recursive=True)
        self.path = f"{base}/{name}"
        self.partial = f"{base}/_{name}.{uuid.uuid4().hex}"

    def __enter__(self):
        self.stream = self.fs.open_output_stream(self.partial, compression=None)
        return self.stream

    def __exit__(self, kind, *_):
        self.stream.close()
        if kind is None:
            self.fs.move(self.partial, self.path)
        else:
            self.fs.delete_file(self.partial)
