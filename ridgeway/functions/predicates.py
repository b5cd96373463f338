"""Row filters as Columns, so that they combine freely and reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status of a completed wallet transaction, cancelled transfer
# states, and the end date of an open record.
COMPLETED = "TS"
CANCELLED = (5, 6)
OPEN_END = dt.date(9999, 12, 31)
CATEGORY_MARKS = {"local": None, "inter": "INTER", "roaming": "ROAM"}


def as_date(value: dt.date | str) -> dt.date:
    """Accept a date, ``yyyyMMdd`` or ``yyyy-MM-dd``."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    pattern = "%Y-%m-%d" if "-" in value else "%Y%m%d"
    return dt.datetime.strptime(value, pattern).date()


def in_days(ts: Column, first: dt.date | str, last: dt.date | str) -> Column:
    """Both days included. The timestamp column stays bare, so the bounds are
    pushed to the scan and prune row groups or partitions."""
    end = as_date(last) + dt.timedelta(days=1)
    return (ts >= F.lit(as_date(first))) & (ts < F.lit(end))


def in_keys(key: Column, first: str, last: str) -> Column:
    """Inclusive range on a string period key (``yyyyMM``, ``yyyyMMdd``)."""
    return key.between(F.lit(first), F.lit(last))


def snapshot(key: Column, value: str) -> Column:
    """One day or month of a snapshot table: plain equality, prunes partitions."""
    return key == F.lit(value)


def completed(status: Column, rollbacked: Column) -> Column:
    """Transaction that went through and was not rolled back."""
    return (status == COMPLETED) & rollbacked.isNull()


def not_cancelled(status: Column, cancelled: Iterable = CANCELLED) -> Column:
    """Status outside the cancelled states; a NULL status is dropped."""
    return ~status.isin(*cancelled)


def non_zero(value: Column) -> Column:
    return value != 0


def both_in(left: Column, right: Column, value: str) -> Column:
    """Both parties belong to one customer category."""
    return (left == value) & (right == value)


def open_record(end_date: Column) -> Column:
    """Record whose end date is the open-end sentinel."""
    return F.to_date(end_date) == F.lit(OPEN_END)


def not_like_any(text: Column, patterns: Iterable[str]) -> Column:
    """Case-folded text matches none of the LIKE patterns."""
    folded = F.upper(text)
    return all_of(*[~folded.like(p) for p in patterns])


def in_category(category: Column, name: str) -> Column | None:
    """Traffic category; ``local`` means every row and gives no filter."""
    if name not in CATEGORY_MARKS:
        raise ValueError(f"unknown category {name!r}, expected one of {sorted(CATEGORY_MARKS)}")
    mark = CATEGORY_MARKS[name]
    return None if mark is None else category.contains(mark)


def equals_if(column: Column, value: str | int | None) -> Column | None:
    """Equality that is left out when no value is given."""
    return None if value is None or value == "" else column == F.lit(value)


def all_of(*predicates: Column | None) -> Column:
    """AND of the given predicates, ``None`` ones skipped."""
    kept = [p for p in predicates if p is not None]
    return reduce(lambda a, b: a & b, kept) if kept else F.lit(True)
