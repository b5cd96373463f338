"""Profiles kept as mergeable states per day.

A state holds the values of one key on one day, as one array per metric, after all
filters, number normalisation and cohort joins. Any period's profile is put together from
the states of its days, percentiles included and exact. Kept in a table partitioned by
day, states let a late day be recomputed by itself: its partition is replaced, and no
event of another day is read again.

A key with very many events on a day has several states, none of them larger than
``profile`` would list, so no array grows with a busy key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.functions.predicates import in_days
from ridgeway.operators.calendar import slice_periods
from ridgeway.operators.profile import MOST_LISTED, null_safe, outsized, profile

DAY, CHUNK = "state_day", "state_chunk"


def day_states(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    metrics: Sequence[str],
    days: tuple | None = None,
    most_listed: int = MOST_LISTED,
) -> DataFrame:
    """``state_day, state_chunk``, ``keys``, and one array per metric.

    ``days`` limits the days read, as a filter that reaches the scan. Events without a
    time belong to no day; rows without any value still count as a state of their key.
    """
    keys, metrics = list(keys), list(metrics)
    wanted = df.where(F.col(ts).isNotNull() if days is None else in_days(F.col(ts), *days))
    spread = F.xxhash64(ts, *metrics)
    rows = wanted.select(F.to_date(ts).alias(DAY), *keys, *metrics, spread.alias(CHUNK))
    group = [DAY, *keys]
    large = outsized(rows, group, most_listed)
    marked = rows.alias("r").join(F.broadcast(large).alias("l"), null_safe(group, "r", "l"), "left")
    shares = F.ceil(F.col("l.__rows") / max(most_listed, 1))
    chunk = F.coalesce(F.pmod(f"r.{CHUNK}", shares), F.lit(0)).cast("int")
    return (
        marked.select(*[f"r.{c}" for c in (*group, *metrics)], chunk.alias(CHUNK))
        .groupBy(*group, CHUNK)
        .agg(*[F.collect_list(m).alias(m) for m in metrics])
    )


def write_states(states: DataFrame, path: str) -> None:
    """Replace the partitions of the days that occur in ``states``; others stay."""
    rows = states.hint("rebalance", F.col(DAY))
    writer = rows.write.mode("overwrite").partitionBy(DAY)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The kept states; a filter on the day prunes partitions."""
    return spark.read.parquet(path)


def profile_of_states(
    states: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    periods: DataFrame | tuple | None = None,
    **options,
) -> DataFrame:
    """What ``profile`` gives for the events behind the states, per period of a job's
    period argument. ``options`` are those of ``profile``; counts count values."""
    sliced, by = slice_periods(states, DAY, periods)
    each = F.arrays_zip(*metrics)
    rows = sliced.select(*by, *keys, F.inline_outer(each))
    counts = {f"n_{m}": m for m in metrics}
    return profile(rows, [*by, *keys], metrics, counts, **options)
