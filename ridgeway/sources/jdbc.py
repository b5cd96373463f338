"""Relational sources over JDBC.

Connection settings come from the caller only. A query text is passed to the
database as it stands; everything that varies (dates, keys) belongs in DataFrame
filters, which Spark pushes down as typed predicates.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ridgeway.functions.predicates import as_date

FETCH_ROWS = 10_000
# How each database wants a derived table named.
ALIAS_FORMS = {"teradata": "({query}) as src", "oracle": "({query}) src"}


@dataclass(frozen=True)
class Connection:
    """Where and how to connect; the password never appears in ``repr``."""

    url: str
    driver: str
    user: str
    password: str = field(repr=False)
    dialect: str = "teradata"

    def __post_init__(self) -> None:
        if self.dialect not in ALIAS_FORMS:
            raise ValueError(f"unknown dialect {self.dialect!r}")


def source_options(connection: Connection, table: str | None, query: str | None) -> dict[str, str]:
    """Reader options for a table (also a remote one, ``name@link``) or a query."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    source = table or ALIAS_FORMS[connection.dialect].format(query=query)
    return {
        "url": connection.url,
        "driver": connection.driver,
        "user": connection.user,
        "password": connection.password,
        "dbtable": source,
        "fetchsize": str(FETCH_ROWS),
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
    }


def split_options(column: str, lower: object, upper: object, parts: int) -> dict[str, str]:
    """Options that read a numeric or date column's range in parallel slices."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(parts),
    }


def day_predicates(column: str, first: dt.date | str, last: dt.date | str) -> list[str]:
    """One half-open range per day: each day becomes one parallel read."""
    start, end = as_date(first), as_date(last)
    days = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
    return [
        f"{column} >= DATE '{day}' AND {column} < DATE '{day + dt.timedelta(days=1)}'"
        for day in days
    ]


# -- even slices of uneven keys ---------------------------------------------
#: Cells a histogram asks for at a time, and how often a heavy cell is divided again.
HISTOGRAM_CELLS = 1_024
HISTOGRAM_ROUNDS = 6
#: A cell heavier than this part of a slice is divided.
HEAVY_PART = 0.25

#: ``count(low, high, width)`` gives ``(cell, rows)`` of the keys from ``low`` up to and
#: without ``high``, a cell being ``width`` keys wide and numbered from ``low``.
Count = Callable[[int, int, int], Sequence[tuple[int, int]]]


def histogram_query(table: str, column: str, low: int, high: int, width: int) -> str:
    """Rows per cell of a whole-number key, counted by the database."""
    cell = f"FLOOR(({column} - {low}) / {width})"
    return (
        f"SELECT {cell} AS cell, COUNT(*) AS n FROM {table} "
        f"WHERE {column} >= {low} AND {column} < {high} GROUP BY {cell}"
    )


def database_count(spark: SparkSession, connection: Connection, table: str, column: str) -> Count:
    """The histogram read over JDBC; a call returns at most ``HISTOGRAM_CELLS`` rows."""

    def count(low: int, high: int, width: int) -> list[tuple[int, int]]:
        rows = read_jdbc(spark, connection, query=histogram_query(table, column, low, high, width))
        return [(int(r[0]), int(r[1])) for r in rows.collect()]

    return count


def key_histogram(count: Count, low: int, high: int, parts: int) -> list[tuple[int, int, int]]:
    """``(first key, key after the last, rows)`` in order, from ``low`` up to and without
    ``high``. Cells with more rows than a quarter of an even slice are counted again in
    narrower cells, down to single keys."""

    def counted(a: int, b: int) -> list[tuple[int, int, int]]:
        width = max(-(-(b - a) // HISTOGRAM_CELLS), 1)
        return [(a + c * width, min(a + (c + 1) * width, b), n) for c, n in sorted(count(a, b, width))]

    cells = counted(low, high)
    limit = sum(n for *_, n in cells) / parts * HEAVY_PART
    for _ in range(HISTOGRAM_ROUNDS):
        heavy = [c for c in cells if c[2] > limit and c[1] - c[0] > 1]
        if not heavy:
            break
        light = [c for c in cells if c not in heavy]
        cells = sorted([*light, *[narrow for a, b, _ in heavy for narrow in counted(a, b)]])
    return cells


def even_cuts(cells: Sequence[tuple[int, int, int]], parts: int) -> list[int]:
    """Keys at which slices begin, the first one left out. A slice ends where it comes
    nearest to an even share of the rows that are left."""
    left, cuts, held = sum(n for *_, n in cells), [], 0
    for first, _, n in cells:
        share = left / (parts - len(cuts))
        if held and len(cuts) < parts - 1 and held + n - share > share - held:
            cuts.append(first)
            left, held = left - held, 0
        held += n
    return cuts


def even_predicates(column: str, count: Count, low: int, high: int, parts: int) -> list[str]:
    """Predicates for :func:`read_jdbc` that cut a skewed whole-number key into slices of
    about equal rows.

    The outer slices are open, so keys beyond ``low`` and ``high`` are read too; rows
    without a key come with the first slice. A key value is never divided, so one that
    has more rows than an even share makes a slice by itself.
    """
    if parts < 1 or high <= low:
        raise ValueError("there is at least one slice, and high lies above low")
    cuts = even_cuts(key_histogram(count, low, high, parts), parts)
    if not cuts:
        return [f"{column} IS NULL OR {column} IS NOT NULL"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_jdbc(
    spark: SparkSession,
    connection: Connection,
    table: str | None = None,
    query: str | None = None,
    split: dict[str, str] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Read a table or query, in parallel when told how to slice it.

    ``split`` comes from :func:`split_options`, ``predicates`` from
    :func:`day_predicates`. With neither, the database is read by one task.
    """
    options = source_options(connection, table, query)
    if predicates is not None:
        properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(
            options["url"], options["dbtable"], predicates=list(predicates), properties=properties
        )
    return spark.read.format("jdbc").options(**options, **(split or {})).load()
