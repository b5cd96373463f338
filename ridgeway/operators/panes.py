"""Aggregates over periods that overlap, each event read and shuffled once.

A calendar of overlapping periods is cut into *panes*: the longest runs of days that lie
in the same periods. A day is in one pane, so giving events their pane copies none of
them. Mergeable aggregates are computed per key and pane, combined before the shuffle;
what is then copied per period are those partial results, whose number does not grow
with the events.

Panes come from the calendar alone, which holds a few hundred periods set by the run's
parameters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.functions.predicates import as_date, in_days
from ridgeway.operators.calendar import PERIOD

PANE = "__pane"
#: How the partial results of a measure are put together.
MERGED = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Measure:
    """A mergeable aggregate (``count``, ``sum``, ``min``, ``max``) of a column."""

    kind: str
    column: Column

    def __post_init__(self) -> None:
        if self.kind not in MERGED:
            raise ValueError(f"unknown measure {self.kind!r}, expected one of {tuple(MERGED)}")

    def of_rows(self) -> Column:
        return getattr(F, self.kind)(self.column)

    def of_parts(self, name: str) -> Column:
        return MERGED[self.kind](name)


@dataclass(frozen=True)
class Pane:
    first: dt.date
    last: dt.date
    periods: tuple[tuple[dt.date, dt.date], ...]


def panes_of(periods: Sequence[tuple[dt.date, dt.date]]) -> list[Pane]:
    """The panes of closed day ranges, in order; days outside all of them have none."""
    day = dt.timedelta(days=1)
    periods = sorted({(as_date(a), as_date(b)) for a, b in periods if a <= b})
    starts = sorted({p[0] for p in periods} | {p[1] + day for p in periods})
    found = []
    for first, after in zip(starts, starts[1:], strict=False):
        inside = tuple(p for p in periods if p[0] <= first and after - day <= p[1])
        if inside:
            found.append(Pane(first, after - day, inside))
    return found


def assign_panes(df: DataFrame, ts: str, panes: Sequence[Pane]) -> DataFrame:
    """Events with the number of their pane; those in none are left out by a filter that
    reaches the scan. The joined table has a row per calendar day."""
    spark = df.sparkSession
    if not panes:
        return df.where(F.lit(False)).withColumn(PANE, F.lit(None).cast("int"))
    rows = [(number, p.first, p.last) for number, p in enumerate(panes)]
    table = spark.createDataFrame(rows, f"{PANE} int, first date, last date")
    days = table.select(PANE, F.explode(F.sequence("first", "last")).alias("__day"))
    wanted = df.where(in_days(F.col(ts), panes[0].first, panes[-1].last))
    return wanted.join(F.broadcast(days), F.to_date(ts) == F.col("__day")).drop("__day")


def aggregate_periods(
    df: DataFrame,
    ts: str,
    periods: DataFrame | tuple | None,
    keys: Sequence[str],
    measures: Mapping[str, Measure],
) -> tuple[DataFrame, list[str]]:
    """``measures`` per key and period, and the names of the period columns.

    ``periods`` is a job's period argument: a pair of days, a calendar, or ``None`` for
    all rows. Periods may overlap or repeat; a repeated one counts once.
    """
    whole = [m.of_rows().alias(name) for name, m in measures.items()]
    if periods is None or isinstance(periods, tuple):
        kept = df if periods is None else df.where(in_days(F.col(ts), *periods))
        return kept.groupBy(*keys).agg(*whole), []
    panes = panes_of([tuple(p) for p in periods.select(*PERIOD).collect()])
    parts = assign_panes(df, ts, panes).groupBy(*keys, PANE).agg(*whole)
    owners = [(number, a, b) for number, pane in enumerate(panes) for a, b in pane.periods]
    table = df.sparkSession.createDataFrame(owners, f"{PANE} int, {PERIOD[0]} date, {PERIOD[1]} date")
    # a row per pane and period that holds it
    placed = parts.join(F.broadcast(table), PANE)
    if all(len(p.periods) == 1 for p in panes) and len({p.periods for p in panes}) == len(panes):
        return placed.select(*PERIOD, *keys, *measures), list(PERIOD)
    merged = placed.groupBy(*PERIOD, *keys).agg(*[m.of_parts(n).alias(n) for n, m in measures.items()])
    return merged, list(PERIOD)
