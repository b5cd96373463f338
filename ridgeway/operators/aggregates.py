"""Plain per-group aggregates; all combine map-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_and_sum(
    df: DataFrame, keys: Sequence[str], value: str, n: str = "nb_trx", total: str = "mtt_trx"
) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.sum(value).alias(total))


def flag_max(df: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Highest flag per group, NULL read as 0."""
    return df.groupBy(*keys).agg(*[F.max(F.coalesce(f, F.lit(0))).alias(f) for f in flags])


def indicator(condition: Column) -> Column:
    """1 where the condition holds, otherwise 0 (also for an unknown condition)."""
    return F.when(condition, 1).otherwise(0)


def sum_columns(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


def event_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def lookup_label(
    df: DataFrame,
    codes: DataFrame,
    code: str,
    list_name: str,
    output: str,
    columns: tuple[str, str, str] = ("lv_code", "lv_name", "lv_label"),
) -> DataFrame:
    """Left join to one named list of a code table; unmatched codes give NULL."""
    key, name, label = columns
    wanted = codes.where(F.col(name) == list_name).select(
        F.col(key).alias("__code"), F.col(label).alias(output)
    )
    return df.join(wanted, F.col(code) == F.col("__code"), "left").drop("__code")
