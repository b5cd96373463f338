"""Row reshaping: two-sided records, contact lists, unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(columns: Mapping[str, Column]) -> Column:
    return F.struct(*[column.alias(name) for name, column in columns.items()])


def two_sided(
    df: DataFrame,
    sender: Mapping[str, Column],
    receiver: Mapping[str, Column],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Turn each record into one row per party.

    ``sender`` and ``receiver`` map the same output names to each party's view
    of the record. The source is scanned once: both rows come from one
    ``inline`` of a two-element array.
    """
    if list(sender) != list(receiver):
        raise ValueError("both sides must define the same columns in the same order")
    return df.select(*keep, F.inline(F.array(_row(sender), _row(receiver))))


def transfer_sides(
    df: DataFrame, sender: str, receiver: str, value: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Transfer rows as ``msisdn, transfer_in, transfer_out``; the side a party
    does not play carries zero."""
    amount, zero = F.col(value), F.lit(0).cast(df.schema[value].dataType)
    return two_sided(
        df,
        {"msisdn": F.col(sender), "transfer_in": zero, "transfer_out": amount},
        {"msisdn": F.col(receiver), "transfer_in": amount, "transfer_out": zero},
        keep,
    )


def explode_contacts(df: DataFrame, contacts: Sequence[Column], name: str = "msisdn") -> DataFrame:
    """One row per distinct non-NULL contact number of a record."""
    numbers = F.array_distinct(F.array_compact(F.array(*contacts)))
    return df.withColumn(name, F.explode(numbers))


def unpivot_metrics(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Long form ``keys, metric, value`` of the non-NULL metric values."""
    cells = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ]
    return df.select(*keys, F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
