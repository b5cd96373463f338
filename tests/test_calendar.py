import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridgeway.operators import calendar as C

DAYS = [dt.date(2020, 12, 20) + dt.timedelta(days=i) for i in range(70)]


@pytest.fixture(scope="module")
def on_days(spark):
    frame = spark.createDataFrame([(d,) for d in DAYS], "d date")

    def run(function):
        return {r["d"]: r["x"] for r in frame.select("d", function(F.col("d")).alias("x")).collect()}

    return run


def pairs(value):
    return [(p["period_start"], p["period_end"]) for p in value]


def weekday_after(day, weekday):
    step = (weekday - day.weekday() - 1) % 7 + 1
    return day + dt.timedelta(days=step)


def test_next_weekday_is_strictly_later(on_days):
    for day, got in on_days(lambda d: C.next_weekday(d, "MON")).items():
        assert got == weekday_after(day, 0)


def test_weeks_back_are_contiguous_and_end_by_the_day(on_days):
    for day, got in on_days(lambda d: C.weeks_back(d, 4)).items():
        weeks = pairs(got)
        assert len(weeks) == 4
        assert day - dt.timedelta(days=6) <= weeks[0][1] <= day
        for start, end in weeks:
            assert start.weekday() == 0 and end - start == dt.timedelta(days=6)
        for newer, older in zip(weeks, weeks[1:]):
            assert newer[0] - older[1] == dt.timedelta(days=1)


def test_previous_week(on_days):
    for day, got in on_days(C.previous_week).items():
        monday = day - dt.timedelta(days=day.weekday() + 7)
        assert pairs([got]) == [(monday, monday + dt.timedelta(days=6))]


def test_days_back_newest_first(on_days):
    for day, got in on_days(lambda d: C.days_back(d, 3)).items():
        assert got == [day - dt.timedelta(days=i) for i in (1, 2, 3)]


def test_snapshot_days(on_days):
    for day, got in on_days(C.snapshot_day).items():
        assert got == day - dt.timedelta(days=2)
    for day, got in on_days(lambda d: C.snapshot_day(d, C.LINE_SNAPSHOT_LAG)).items():
        assert got == day - dt.timedelta(days=7)


def test_weeks_forward(on_days):
    got = on_days(lambda d: C.weeks_forward(d, 2))[DAYS[0]]
    assert pairs(got) == [
        (DAYS[0], DAYS[0] + dt.timedelta(days=6)),
        (DAYS[0] + dt.timedelta(days=7), DAYS[0] + dt.timedelta(days=13)),
    ]


def weeks_by_hand(start, end):
    monday, weeks = weekday_after(start, 0), []
    while not weeks or weeks[-1][1] < end:
        weeks.append((monday, monday + dt.timedelta(days=6)))
        monday += dt.timedelta(days=7)
    return weeks


@pytest.mark.parametrize("length", [-3, 0, 6, 7, 20])
def test_weeks_between_skip_a_starting_monday(on_days, length):
    got = on_days(lambda d: C.weeks_between(d, F.date_add(d, length)))
    for day, weeks in got.items():
        assert pairs(weeks) == weeks_by_hand(day, day + dt.timedelta(days=length))


def months_by_hand(start, end):
    first, ids = start.replace(day=1), []
    while first < end:
        ids.append(first.strftime("%Y%m"))
        first = (first + dt.timedelta(days=31)).replace(day=1)
    return ids


@pytest.mark.parametrize("length", [-60, 0, 1, 40, 200])
def test_months_between_excludes_the_end(on_days, length):
    got = on_days(lambda d: C.months_between(d, F.date_add(d, length)))
    for day, months in got.items():
        assert months == months_by_hand(day, day + dt.timedelta(days=length))


def test_months_back_skip_none(on_days):
    # as written, stepping back 31 days from the first skipped months
    got = on_days(lambda d: C.months_back(d, 6))[dt.date(2020, 12, 31)]
    assert got == ["202012", "202011", "202010", "202009", "202008", "202007"]


def test_month_ranges_back(on_days):
    got = pairs(on_days(lambda d: C.month_ranges_back(d, 2))[dt.date(2021, 2, 27)])
    assert got == [
        (dt.date(2021, 2, 1), dt.date(2021, 2, 28)),
        (dt.date(2021, 1, 1), dt.date(2021, 1, 31)),
    ]


def test_zero_periods(on_days):
    assert on_days(lambda d: C.weeks_back(d, 0))[DAYS[0]] == []


@pytest.mark.parametrize(
    ("mode", "options", "count", "first"),
    [
        ("history", {}, 26, (dt.date(2021, 9, 27), dt.date(2021, 10, 3))),
        ("history", {"depth": 59}, 59, (dt.date(2021, 9, 27), dt.date(2021, 10, 3))),
        ("history", {"unit": "day"}, 180, (dt.date(2021, 10, 4), dt.date(2021, 10, 4))),
        ("history", {"unit": "month"}, 6, (dt.date(2021, 10, 1), dt.date(2021, 10, 31))),
        ("range", {}, 1, (dt.date(2021, 9, 30), dt.date(2021, 10, 5))),
        ("range", {"unit": "month"}, 1, (dt.date(2021, 10, 1), dt.date(2021, 10, 31))),
        ("latest", {"run_day": "20211006"}, 1, (dt.date(2021, 9, 27), dt.date(2021, 10, 3))),
        (
            "latest", {"run_day": "20211006", "unit": "day"},
            1, (dt.date(2021, 10, 4), dt.date(2021, 10, 4)),
        ),
        (
            "latest", {"run_day": "20211006", "unit": "month"},
            1, (dt.date(2021, 10, 1), dt.date(2021, 10, 31)),
        ),
    ],
)
def test_plan_periods(spark, mode, options, count, first):
    planned = C.plan_periods(spark, mode, "20210930", "20211005", **options).collect()
    assert len(planned) == count
    assert max(tuple(p) for p in planned) == first


def test_unknown_unit(spark):
    with pytest.raises(ValueError):
        C.plan_periods(spark, "range", "20210101", "20210102", unit="year")


@pytest.mark.parametrize(
    "mode, options",
    [("newest", {}), ("history", {}), ("latest", {"end": "20210101"}), ("range", {"end": "20210101"}),
     ("history", {"end": "20210101", "depth": 0})],
)
def test_modes_say_what_they_need(spark, mode, options):
    with pytest.raises(ValueError):
        C.plan_periods(spark, mode, **options)


def test_snapshot_backfill_takes_one_key_per_period(spark):
    days = [(f"202101{d:02d}", d) for d in range(1, 32)]
    frame = spark.createDataFrame(days, "date_id string, d int")
    periods = C.plan_periods(spark, "history", end="20210110", unit="day", depth=3)
    got = C.slice_snapshots(frame, "date_id", periods).collect()
    expected = [f"202101{d:02d}" for d in range(1, 32) if f"202101{d:02d}" in C.snapshot_keys(periods, C.DAY_ID)]
    assert [r["date_id"] for r in got] == expected and len(expected) == 3
    assert [r["d"] for r in C.slice_snapshots(frame, "date_id", "20210105").collect()] == [5]
    assert C.slice_snapshots(frame, "date_id", None).count() == 31


def test_assign_periods_equals_a_loop_over_periods(spark, rows):
    start = dt.datetime(2021, 1, 1)
    events = spark.createDataFrame(
        [(i, start + dt.timedelta(hours=7 * i)) for i in range(200)], "i int, t timestamp_ntz"
    )
    periods = spark.createDataFrame(
        [
            (dt.date(2021, 1, 4), dt.date(2021, 1, 10)),
            (dt.date(2021, 1, 9), dt.date(2021, 1, 20)),
            (dt.date(2021, 3, 20), dt.date(2021, 3, 25)),
        ],
        "period_start date, period_end date",
    )
    got = rows(C.assign_periods(events, "t", periods), "i", "period_start")
    expected = [
        (i, first)
        for first, last in (tuple(p) for p in periods.collect())
        for i in range(200)
        if first <= (start + dt.timedelta(hours=7 * i)).date() <= last
    ]
    assert got == sorted(expected, key=repr)
    assert C.assign_periods(events, "t", periods.limit(0)).count() == 0
