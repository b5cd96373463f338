"""Panes for overlapping periods, and profiles from kept day states."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ridgeway.operators import panes as P
from ridgeway.operators import states as T
from ridgeway.operators.profile import profile

START = dt.date(2024, 1, 1)
SCHEMA = "k string, ts timestamp, x double, y double"


def day(n):
    return START + dt.timedelta(days=n)


def events(n=900, seed=5):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        when = dt.datetime.combine(day(draw.randrange(60)), dt.time(draw.randrange(24), 30))
        key = draw.choice(["hub", "hub", "a", "b", None])
        rows.append((key, when if i % 50 else None, draw.choice([1.0, 2.5, draw.random() * 100, None]), float(i % 7)))
    return rows


def calendar_of(spark, ranges):
    return spark.createDataFrame(ranges, "period_start date, period_end date")


def test_panes_are_disjoint_and_know_their_periods():
    got = P.panes_of([(day(0), day(9)), (day(5), day(14)), (day(20), day(20)), (day(5), day(14))])
    assert [((p.first - START).days, (p.last - START).days, len(p.periods)) for p in got] == [
        (0, 4, 1), (5, 9, 2), (10, 14, 1), (20, 20, 1)
    ]
    assert P.panes_of([]) == [] and P.panes_of([(day(3), day(1))]) == []


@pytest.mark.parametrize("width", [7, 28])
def test_overlapping_periods_equal_one_run_each(spark, width):
    rows = events()
    ranges = [(day(i * 2), day(i * 2 + width - 1)) for i in range(26)]
    measures = {
        "n": P.Measure("count", F.col("x")), "total": P.Measure("sum", F.col("y")),
        "low": P.Measure("min", F.col("x")), "high": P.Measure("max", F.col("x")),
    }
    frame = spark.createDataFrame(rows, SCHEMA)
    got, by = P.aggregate_periods(frame, "ts", calendar_of(spark, ranges + ranges[:2]), ["k"], measures)
    want = defaultdict(list)
    for key, ts, x, y in rows:
        for a, b in ranges:
            if ts is not None and a <= ts.date() <= b:
                want[a, b, key].append((x, y))
    expected = {}
    for group, values in want.items():
        xs = [x for x, _ in values if x is not None]
        expected[group] = (len(xs), sum(y for _, y in values), min(xs, default=None), max(xs, default=None))
    assert by == ["period_start", "period_end"]
    assert {(r[0], r[1], r["k"]): (r["n"], r["total"], r["low"], r["high"]) for r in got.collect()} == expected
    empty, _ = P.aggregate_periods(frame, "ts", calendar_of(spark, []), ["k"], measures)
    assert empty.count() == 0
    pair, by = P.aggregate_periods(frame, "ts", ("20240101", "20240110"), ["k"], measures)
    assert by == [] and pair.count() > 0
    with pytest.raises(ValueError):
        P.Measure("median", F.col("x"))


def test_each_event_is_shuffled_once(spark, tmp_path):
    spark.createDataFrame(events(2000), SCHEMA).write.parquet(str(tmp_path / "events"))
    frame = spark.read.parquet(str(tmp_path / "events"))
    ranges = [(day(i), day(i + 27)) for i in range(26)]
    measures = {"n": P.Measure("count", F.col("x"))}
    got, _ = P.aggregate_periods(frame, "ts", calendar_of(spark, ranges), ["k"], measures)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    # the join that copies per period stands above the first exchange of the aggregate
    events_side = plan[plan.index("partial_count") : plan.index("FileScan")]
    assert "period_start" not in events_side and "Generate" not in events_side


def test_a_late_day_recomputes_its_day_only(spark, tmp_path):
    path = str(tmp_path / "states")
    rows = [r for r in events() if r[1] is not None]
    late = day(17)
    early = [r for r in rows if r[1].date() != late]
    T.write_states(T.day_states(spark.createDataFrame(early, SCHEMA), "ts", ["k"], ["x", "y"]), path)
    stamps = {f: f.stat().st_mtime_ns for f in (tmp_path / "states").rglob("*.parquet")}
    all_events = spark.createDataFrame(rows, SCHEMA)
    T.write_states(T.day_states(all_events, "ts", ["k"], ["x", "y"], (late, late)), path)
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "states").rglob("*.parquet")}
    assert {f: t for f, t in after.items() if f in stamps} == stamps
    assert {f.parent.name for f in set(after) - set(stamps)} == {f"state_day={late}"}
    got = T.profile_of_states(T.read_states(spark, path), ["k"], ["x", "y"], (day(0), day(40)))
    kept = all_events.where(F.to_date("ts") <= F.lit(day(40)))
    want = profile(kept, ["k"], ["x", "y"], {"n_x": "x", "n_y": "y"})
    same(got, want)


def same(got, want):
    assert got.columns == want.columns
    a, b = ({r["k"]: r for r in f.collect()} for f in (got, want))
    assert set(a) == set(b)
    for key, row in a.items():
        for name in got.columns[1:]:
            assert row[name] == (None if b[key][name] is None else pytest.approx(b[key][name], rel=1e-12)), name


def test_busy_keys_have_several_states(spark):
    frame = spark.createDataFrame(events(), SCHEMA)
    few = T.day_states(frame, "ts", ["k"], ["x", "y"], most_listed=3)
    assert few.agg(F.max(F.size("y"))).first()[0] < 12
    assert few.where(F.col(T.CHUNK) > 0).count() > 0
    kept = frame.where("ts IS NOT NULL")
    same(
        T.profile_of_states(few, ["k"], ["x", "y"], most_listed=0),
        profile(kept, ["k"], ["x", "y"], {"n_x": "x", "n_y": "y"}),
    )
    days = calendar_of(spark, [(day(0), day(27)), (day(14), day(41))])
    per_period = T.profile_of_states(few, ["k"], ["y"], days)
    assert per_period.select("period_start").distinct().count() == 2
