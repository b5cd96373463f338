"""Cohort files and delivered tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.operators.calendar import DAY_ID, PERIOD
from ridgeway.operators.cohort import COHORT_KEY, distinct_cohort

# Fixed value: key column of the client list.
CLIENT_COLUMN = "Phone"


def read_cohort(spark: SparkSession, path: str) -> DataFrame:
    """Client list: ``;``-separated with a header; numbers are read as text."""
    # the header decides which column is the key, all columns stay text
    raw = spark.read.option("sep", ";").option("header", True).csv(path)
    return distinct_cohort(raw.select(F.col(CLIENT_COLUMN).alias(COHORT_KEY)))


def result_path(root: str, job: str, *qualifiers: str) -> str:
    """Where a job's table goes: job name, then service, category and the like."""
    return "/".join([root.rstrip("/"), job, *[q.lower() for q in qualifiers if q]])


def period_name(start: str, end: str) -> str:
    return f"{start}_to_{end}"


def with_period_name(df: DataFrame) -> DataFrame:
    """Replace the two period columns by one readable partition value."""
    start, end = (F.date_format(c, DAY_ID) for c in PERIOD)
    return df.withColumn("period", F.concat(start, F.lit("_to_"), end)).drop(*PERIOD)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    file_format: str = "csv",
    rows_per_file: int = 5_000_000,
) -> None:
    """Write a delivered table as a directory of part files with a header.

    The executors write in parallel; nothing passes through the driver. With
    ``partition_by=("period",)`` a re-run replaces its own periods only (dynamic
    overwrite). Rows are brought together per partition value before writing
    and a large one is split over several files by Spark's rebalance.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)


def write_plain_csv(df: DataFrame, path: str) -> None:
    """Write a directory of headerless CSV part files."""
    df.write.mode("overwrite").csv(path)


# -- publishing several periods at once -------------------------------------
PUBLISHED, MANIFESTS = "data", "manifests"
OWNER = "__of"


def _store(spark: SparkSession, path: str):
    """Hadoop's file system and its path class, for whatever scheme the path has."""
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number of the newest manifest (0 if there is none) and the folder it names for each
    partition value."""
    store, make = _store(spark, path)
    folder = make(f"{path}/{MANIFESTS}")
    if not store.exists(folder):
        return 0, {}
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    numbers = [int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit() and n.endswith(".json")]
    if not numbers:
        return 0, {}
    stream = store.open(make(f"{path}/{MANIFESTS}/{max(numbers):08d}.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return max(numbers), json.loads(text)


def publish(df: DataFrame, path: str, partition: str) -> int:
    """Write a frame and make all its values of ``partition`` visible at once; returns
    the number of the manifest.

    Rows are written to a new folder. Only when all of it is there, a manifest that names
    the folder of every value, those of earlier writes included, is put in place by one
    rename. A write that fails, and one whose manifest number was taken by another in the
    meantime, leaves readers with what they had. A NULL value is a value of its own.
    """
    spark = df.sparkSession
    store, make = _store(spark, path)
    number, known = _manifest(spark, path)
    version = uuid.uuid4().hex
    staged = f"{path}/{PUBLISHED}/{version}"
    owned = df.withColumn(OWNER, F.coalesce(F.col(partition).cast("string"), F.lit("__null__")))
    owned.hint("rebalance", F.col(OWNER)).write.partitionBy(OWNER).parquet(staged)
    for status in store.listStatus(make(staged)):
        name = status.getPath().getName()
        if name.startswith(f"{OWNER}="):
            known[name.removeprefix(f"{OWNER}=")] = f"{PUBLISHED}/{version}/{name}"
    partial = make(f"{path}/{MANIFESTS}/_{version}")
    stream = store.create(partial, False)
    try:
        stream.write(bytearray(json.dumps(known, sort_keys=True).encode()))
    finally:
        stream.close()
    target = make(f"{path}/{MANIFESTS}/{number + 1:08d}.json")
    if store.exists(target) or not store.rename(partial, target):
        raise RuntimeError(f"another write published {path} in the meantime")
    return number + 1


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """What the newest manifest names. A path nothing was published to is an error."""
    _, known = _manifest(spark, path)
    if not known:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(*[f"{path}/{folder}" for folder in sorted(known.values())])
