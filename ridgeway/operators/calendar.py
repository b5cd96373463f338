"""Periods: date-range functions, calendars, and many periods in one job.

The functions work on any date column, so one query can derive the periods of
every row. A calendar is a small frame ``period_start, period_end``; joining it
to the events replaces one run of a job per period by a single run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.functions.predicates import as_date, in_days, snapshot

# How many periods a first delivery for new clients covers.
NEW_CLIENT_WEEKS = 26
#: Weeks that the history of the telecom graph covers.
HISTORY_WEEKS = 59
NEW_CLIENT_DAYS = 180
NEW_CLIENT_MONTHS = 6
MODES = ("history", "latest", "range")
SNAPSHOT_LAG = 2
LINE_SNAPSHOT_LAG = 7

PERIOD = ("period_start", "period_end")
DAY_ID = "yyyyMMdd"
MONTH_ID = "yyyyMM"


def _range(start: Column, end: Column) -> Column:
    return F.struct(start.cast("date").alias(PERIOD[0]), end.cast("date").alias(PERIOD[1]))


def _steps(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1)) if n > 0 else F.array().cast("array<int>")


def next_weekday(day: Column, weekday: str) -> Column:
    """First given weekday (``MON`` ... ``SUN``) strictly after ``day``."""
    return F.next_day(day, weekday)


def weeks_back(end: Column, n: int) -> Column:
    """The last ``n`` Monday-Sunday weeks ending on or before ``end``, newest first."""
    last_sunday = F.date_sub(F.next_day(end, "SUN"), 7)
    return F.transform(
        _steps(n),
        lambda i: _range(F.date_sub(last_sunday, i * 7 + 6), F.date_sub(last_sunday, i * 7)),
    )


def previous_week(day: Column) -> Column:
    """The last complete Monday-Sunday week before the week of ``day``."""
    monday = F.date_sub(F.date_trunc("week", day).cast("date"), 7)
    return _range(monday, F.date_add(monday, 6))


def snapshot_day(day: Column, lag: int = SNAPSHOT_LAG) -> Column:
    """Day whose snapshot is complete."""
    return F.date_sub(day, lag)


def days_back(day: Column, n: int) -> Column:
    """The ``n`` days before ``day``, newest first."""
    return F.transform(_steps(n), lambda i: F.date_sub(day, i + 1))


def weeks_forward(start: Column, n: int) -> Column:
    """``n`` seven-day periods from ``start`` on."""
    return F.transform(
        _steps(n), lambda i: _range(F.date_add(start, i * 7), F.date_add(start, i * 7 + 6))
    )


def weeks_between(start: Column, end: Column) -> Column:
    """Weeks from the Monday strictly after ``start`` until a Sunday reaches
    ``end``; at least one."""
    first = F.next_day(start, "MON")
    mondays = F.sequence(first, F.greatest(first, end), F.expr("interval 7 days"))
    return F.transform(mondays, lambda monday: _range(monday, F.date_add(monday, 6)))


def months_between(start: Column, end: Column) -> Column:
    """Ids of the months from ``start``'s month while their first day is before
    ``end`` (``end`` itself is excluded)."""
    first, last = F.trunc(start, "MM"), F.date_sub(end, 1)
    # sequence() would count down when the range is empty
    days = F.when(first < end, F.sequence(first, F.greatest(first, last), F.expr("interval 1 month")))
    ids = F.transform(days, lambda day: F.date_format(day, MONTH_ID))
    return F.coalesce(ids, F.array().cast("array<string>"))


def months_back(end: Column, n: int) -> Column:
    """Ids of the last ``n`` months, ``end``'s own month first."""
    month = F.trunc(end, "MM")
    return F.transform(
        _steps(n), lambda i: F.date_format(F.add_months(month, -i), MONTH_ID)
    )


def month_ranges_back(end: Column, n: int) -> Column:
    """First and last day of the last ``n`` months, ``end``'s own month first."""
    month = F.trunc(end, "MM")
    return F.transform(
        _steps(n), lambda i: _range(F.add_months(month, -i), F.last_day(F.add_months(month, -i)))
    )


def calendar(spark: SparkSession, periods: Column) -> DataFrame:
    """Calendar frame from an array of periods or of single days."""
    frame = spark.range(1).select(F.explode(periods).alias("p"))
    if frame.schema["p"].dataType.typeName() == "struct":
        return frame.select("p.*")
    return frame.select(F.col("p").alias(PERIOD[0]), F.col("p").alias(PERIOD[1]))


def plan_periods(
    spark: SparkSession,
    mode: str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    run_day: dt.date | str | None = None,
    unit: str = "week",
    depth: int | None = None,
    snapshot_lag: int = SNAPSHOT_LAG,
) -> DataFrame:
    """Calendar of the periods a run has to cover.

    ``mode`` is ``history`` (for clients without any delivery so far: ``depth`` weeks,
    days or months up to ``end``), ``latest`` (the period before ``run_day``: the
    previous complete week, the day ``snapshot_lag`` days back, or the month of the
    previous week's end) or ``range`` (``start`` to ``end`` as one period; by month, the
    month of ``end``).
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    missing = [n for n, v in (("end", end), ("start", start), ("run_day", run_day)) if v is None]
    needed = {"history": ["end"], "latest": ["run_day"], "range": ["start", "end"]}[mode]
    if unit == "month" and mode == "range":
        needed = ["end"]
    if any(n in missing for n in needed):
        raise ValueError(f"mode {mode!r} needs {' and '.join(needed)}")
    if depth is not None and depth < 1:
        raise ValueError("depth counts periods and is at least 1")
    if unit not in ("week", "day", "month"):
        raise ValueError(f"unknown period unit {unit!r}")
    if mode == "history":
        last = F.lit(as_date(end))
        if unit == "week":
            return calendar(spark, weeks_back(last, depth or NEW_CLIENT_WEEKS))
        if unit == "day":
            return calendar(spark, days_back(last, depth or NEW_CLIENT_DAYS))
        return calendar(spark, month_ranges_back(last, depth or NEW_CLIENT_MONTHS))
    if mode == "range":
        if unit == "month":
            return calendar(spark, month_ranges_back(F.lit(as_date(end)), 1))
        return calendar(spark, F.array(_range(F.lit(as_date(start)), F.lit(as_date(end)))))
    today = F.lit(as_date(run_day))
    if unit == "day":
        return calendar(spark, F.array(snapshot_day(today, snapshot_lag)))
    week = previous_week(today)
    if unit == "week":
        return calendar(spark, F.array(week))
    return calendar(spark, month_ranges_back(week[PERIOD[1]], 1))


def assign_periods(df: DataFrame, ts: str, periods: DataFrame) -> DataFrame:
    """Give every event the period (or overlapping periods) it falls in.

    The calendar is unfolded to days, which turns the range condition into an
    equi-join; its size is the number of calendar days, fixed by the run's
    parameters and independent of the data, so it is broadcast. The outer
    bounds are read once and filter the scan itself.
    """
    bounds = periods.agg(F.min(PERIOD[0]), F.max(PERIOD[1])).first()
    if bounds[0] is None:
        return df.where(F.lit(False)).withColumns(
            {name: F.lit(None).cast("date") for name in PERIOD}
        )
    days = periods.select(*PERIOD, F.explode(F.sequence(*PERIOD)).alias("__day"))
    wanted = df.where(in_days(F.col(ts), bounds[0], bounds[1]))
    return wanted.join(F.broadcast(days), F.to_date(ts) == F.col("__day")).drop("__day")


def period_literals(periods: DataFrame) -> Column:
    """The calendar as a literal array, to give every member of a cohort a row
    per period. A calendar holds a few hundred rows, set by the run's parameters."""
    return F.array(*[_range(F.lit(p[0]), F.lit(p[1])) for p in periods.select(*PERIOD).collect()])


def snapshot_keys(periods: DataFrame, pattern: str) -> list[str]:
    """Key of every period's last day (``DAY_ID`` or ``MONTH_ID``). A calendar holds a few
    hundred periods, set by the run's parameters."""
    keys = periods.select(F.date_format(PERIOD[1], pattern).alias("key")).distinct()
    return sorted(row["key"] for row in keys.collect())


def slice_snapshots(
    df: DataFrame, key: str, periods: DataFrame | str | None, pattern: str = DAY_ID
) -> DataFrame:
    """Apply a snapshot job's period argument to its key column.

    A string is one snapshot, a calendar one per period, ``None`` all. The keys
    become literals of the filter, so that partitions prune and filters are pushed;
    the key column stays in the result and tells the snapshots apart.
    """
    if periods is None:
        return df
    if isinstance(periods, str):
        return df.where(snapshot(F.col(key), periods))
    return df.where(F.col(key).isin(*snapshot_keys(periods, pattern)))


def slice_periods(
    df: DataFrame, ts: str, periods: DataFrame | tuple | None
) -> tuple[DataFrame, list[str]]:
    """Apply a job's period argument.

    A pair of days filters the range; a calendar adds ``period_start`` and
    ``period_end``, returned as extra grouping keys; ``None`` keeps every row.
    """
    if periods is None:
        return df, []
    if isinstance(periods, tuple):
        return df.where(in_days(F.col(ts), *periods)), []
    return assign_periods(df, ts, periods), list(PERIOD)
