"""Percentile profile: count, mean, deviation and exact percentiles per group.

One lazy plan serves every group, however its rows lie in the input; nothing runs when
it is built.

1. One aggregate, combined before its exchange, gives every group its counts and
   moments, and the sorted values of its metrics, from which percentiles are read by
   position. This is the only exchange of all values.
2. What must not be gathered is a group of more than ``MOST_LISTED`` rows. Such groups
   are found by a count of rows per key beforehand and their values are left out of the
   lists. Their percentiles are selected exactly: values are counted by cell (an interval
   of values), running totals tell in which cells the wanted ranks lie, and only the
   values of those few cells are ranked.

The table of outsized groups is broadcast; it has at most ``MOST_OUTSIZED`` rows by
construction, taking the largest groups first. A group that finds no place in it has less
than that fraction of all rows and is listed. While there is no outsized group, adaptive
execution drops step 2.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

APPROX_ACCURACY = 10_000
#: Rows up to which a group's values are listed.
MOST_LISTED = 1 << 20
#: Groups beyond that which are told apart, the largest first.
MOST_OUTSIZED = 1 << 17
#: Cells per factor e of a value's magnitude.
CELLS = 4_096
POINTS = {0.0: "p0", 0.25: "p25", 0.5: "p50", 0.75: "p75", 1.0: "p100"}
QUANTILES = tuple(POINTS)


def null_safe(keys: Sequence[str], left: str, right: str) -> Column:
    """Equality of group keys in which NULL equals NULL."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def _moments(metric: str, sums: bool) -> list[Column]:
    value = F.col(metric)
    columns = [F.avg(value).alias(f"{metric}_avg"), F.stddev_samp(value).alias(f"{metric}_std")]
    if sums:
        columns.insert(0, F.sum(value).alias(f"{metric}_sum"))
    return columns


def _output(metric: str, sums: bool) -> list[str]:
    names = [f"{metric}_sum"] if sums else []
    return [*names, f"{metric}_avg", f"{metric}_std", *[f"{metric}_{p}" for p in POINTS.values()]]


def profile(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    counts: Mapping[str, str | Column] | None = None,
    sums: bool = False,
    approx: bool = False,
    most_listed: int = MOST_LISTED,
) -> DataFrame:
    """Describe every metric per group.

    ``counts`` maps an output name to the column whose non-NULL values are
    counted (default: ``n_<first metric>``). Output: ``keys``, the counts, then
    per metric ``_avg``, ``_std`` and ``_p0 _p25 _p50 _p75 _p100`` (plus
    ``_sum`` on request). ``approx=True`` replaces exact percentiles by
    mergeable sketches in a single pass. NaN counts as the greatest value, as in any
    Spark order.
    """
    counts = counts or {f"n_{metrics[0]}": metrics[0]}
    keys, metrics = list(keys), list(metrics)
    counted = {
        name: F.col(column) if isinstance(column, str) else column
        for name, column in counts.items()
    }
    # count columns become flags first, so that both branches carry plain columns
    rows = df.select(
        *keys,
        *metrics,
        *[F.when(column.isNotNull(), 1).alias(name) for name, column in counted.items()],
    )
    plain = [F.count(name).alias(name) for name in counted]
    plain += [column for metric in metrics for column in _moments(metric, sums)]
    wanted = [*keys, *counted, *[name for m in metrics for name in _output(m, sums)]]

    if approx:
        points = [
            F.percentile_approx(m, list(QUANTILES), APPROX_ACCURACY).alias(f"{m}_points")
            for m in metrics
        ]
        return spread_points(rows.groupBy(*keys).agg(*plain, *points), metrics).select(*wanted)

    large = F.broadcast(outsized(rows, keys, most_listed))
    marked = rows.alias("r").join(large.alias("l"), null_safe(keys, "r", "l"), "left")
    marked = marked.select("r.*", F.col(f"l.{ROWS}").isNull().alias(LISTED))
    lists = [
        F.sort_array(F.collect_list(F.when(F.col(LISTED), F.col(m).cast("double")))).alias(f"{m}_list")
        for m in metrics
    ]
    whole = marked.groupBy(*keys).agg(*plain, *lists)
    selected = F.broadcast(_selected(rows, large, keys, metrics))
    joined = whole.alias("w").join(selected.alias("s"), null_safe(keys, "w", "s"), "left")
    found = joined.select(
        "w.*",
        *[
            F.coalesce(F.col(f"s.{m}_points"), points_of_sorted(f"w.{m}_list")).alias(f"{m}_points")
            for m in metrics
        ],
    )
    return spread_points(found, metrics).select(*wanted)


ROWS, LISTED = "__rows", "__listed"


def outsized(rows: DataFrame, keys: list[str], most_listed: int) -> DataFrame:
    """The keys of groups with more than ``most_listed`` rows; reads the keys only. Ties
    are broken by the keys, so that every use of the result sees the same groups."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS)).where(F.col(ROWS) > most_listed)
    return counted.orderBy(F.desc(ROWS), *keys).limit(MOST_OUTSIZED)


def _selected(rows: DataFrame, large: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """``keys`` and ``<metric>_points`` of outsized groups: one row each."""
    own = rows.alias("r").join(large.alias("l"), null_safe(keys, "r", "l"))
    each = [F.struct(F.lit(m).alias("metric"), F.col(f"r.{m}").cast("double").alias("value")) for m in metrics]
    values = own.select(*[f"r.{k}" for k in keys], F.inline(F.array(*each))).where("value IS NOT NULL")
    points = _ranked_points(values, keys)

    def of(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("points")))

    return points.groupBy(*keys).agg(*[of(m).alias(f"{m}_points") for m in metrics])


def _cell(value: Column) -> Column:
    """A number that never falls as the value grows, ends and NaN included."""
    size = F.floor(F.signum(value) * F.log1p(F.abs(value)) * CELLS)
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    beyond = F.when(value < 0, -1).otherwise(F.when(F.isnan(value), 2).otherwise(1)) * (1 << 40)
    return F.when(finite, size).otherwise(beyond).cast("bigint")


def _ranked_points(values: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, metric, points`` by selection: first the cells of the wanted ranks, then
    the values inside them. Cells are a function of the value alone."""
    group = [*keys, "metric"]
    celled = values.withColumn("cell", _cell(F.col("value")))
    cells = celled.groupBy(*group, "cell").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        *group,
        "cell",
        "n",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        F.sum("n").over(whole).alias("all"),
    )
    inside = (F.col("base"), F.col("base") + F.col("n"))
    wanted = cells.where(F.exists(_ranks(), lambda r: (r >= inside[0]) & (r < inside[1])))
    wanted = wanted.select(*group, "cell", "base", "all")
    near = celled.alias("v").join(wanted.alias("c"), null_safe([*group, "cell"], "v", "c"), "left_semi")
    counted = near.groupBy(*group, "cell", "value").agg(F.count(F.lit(1)).alias("n"))
    order = (
        Window.partitionBy(*group, "cell")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = counted.withColumn("at", F.coalesce(F.sum("n").over(order), F.lit(0)))
    ranked = placed.alias("v").join(wanted.alias("c"), null_safe([*group, "cell"], "v", "c"))
    ranked = ranked.select("v.*", "c.all", (F.col("c.base") + F.col("v.at")).alias("first"))
    held = F.filter(
        _ranks(), lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("n"))
    )
    found = ranked.select(*group, "all", F.explode(held).alias("rank"), "value")
    # at most ten (rank, value) pairs per group and metric
    table = found.groupBy(*group, "all").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at")
    )
    return table.select(*group, F.array(*[_from_ranks(q) for q in QUANTILES]).alias("points"))


def _ranks() -> Column:
    """Zero-based ranks on both sides of each percentile position."""
    positions = [(F.col("all") - 1) * F.lit(q) for q in QUANTILES]
    return F.array_distinct(F.array(*[side(p) for p in positions for side in (F.floor, F.ceil)]))


def _from_ranks(q: float) -> Column:
    position = (F.col("all") - 1) * F.lit(q)
    lower, upper = F.floor(position), F.ceil(position)
    return _between(F.element_at("at", lower), F.element_at("at", upper), position - lower)


def _between(low: Column, high: Column, part: Column) -> Column:
    """Interpolation; exactly ``low`` if the position is a rank or both values agree.
    Between a finite value and an infinite one the result is infinite."""
    infinite = (F.abs(low) == float("inf")) | (F.abs(high) == float("inf"))
    weighted = F.when(infinite, low * (1 - part) + high * part)
    return F.when((part == 0) | (low == high), low).otherwise(
        F.coalesce(weighted, low + part * (high - low))
    )


def points_of_sorted(values: Column | str) -> Column:
    """Interpolated percentiles of a sorted array, NULLs if it is empty."""

    def at(q: Column) -> Column:
        position = (F.size(values) - 1) * q
        lower, upper = F.floor(position).cast("int"), F.ceil(position).cast("int")
        return _between(F.get(values, lower), F.get(values, upper), position - lower)

    return F.transform(F.array(*[F.lit(q) for q in QUANTILES]), at)


def spread_points(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Spread each array of percentiles over its named columns."""
    return df.withColumns(
        {
            f"{m}_{name}": F.get(F.col(f"{m}_points"), F.lit(i))
            for m in metrics
            for i, name in enumerate(POINTS.values())
        }
    )
