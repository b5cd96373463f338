import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridgeway.operators.profile import profile

POINTS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}


def percentile(values, q):
    values = sorted(values)
    position = (len(values) - 1) * q
    low = int(position)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (position - low)


def by_hand(data, metric_at, key_at):
    groups = {}
    for row in data:
        groups.setdefault(tuple(row[i] for i in key_at), []).append(row[metric_at])
    result = {}
    for key, values in groups.items():
        known = [v for v in values if v is not None]
        described = {"n": len(known)}
        described["avg"] = statistics.fmean(known) if known else None
        described["std"] = statistics.stdev(known) if len(known) > 1 else None
        for name, q in POINTS.items():
            described[name] = percentile(known, q) if known else None
        result[key] = described
    return result


def check(frame, expected, metric, keys):
    got = {tuple(r[k] for k in keys): r.asDict() for r in frame.collect()}
    assert set(got) == set(expected)
    for key, numbers in expected.items():
        for name, value in numbers.items():
            column = f"n_{metric}" if name == "n" else f"{metric}_{name}"
            actual = got[key][column]
            if value is None:
                assert actual is None, (key, column)
            else:
                assert actual == pytest.approx(value, rel=1e-9, abs=1e-9), (key, column)


def skewed(n=3000):
    """One key holds over a third of the rows; values have ties and a heavy tail."""
    chooser = random.Random(3)
    rows = []
    for i in range(n):
        key = "hub" if i % 5 < 2 else chooser.choice(["a", "b", None, "c"])
        value = chooser.choice([1.0, 2.5, chooser.random() * 100, chooser.random() ** 9 * 1e15, None])
        rows.append((key, i % 2, value, chooser.choice([7.0, 7.0, -3.0])))
    return rows


SCHEMA = "k string, side int, x double, y double"


def spread(spark, data, schema, parts=5):
    """A frame whose rows lie in several partitions, with no order to them."""
    return spark.createDataFrame(data, schema).repartition(parts)


@pytest.mark.parametrize("pieces", [1, 2, 100])
def test_profile_is_exact_however_groups_are_split(spark, pieces):
    data = skewed()
    frame = spread(spark, data, SCHEMA)
    result = profile(
        frame, ["k", "side"], ["x", "y"], {"n_x": "x", "n_y": "y"}, most_listed=pieces
    ).cache()
    check(result, by_hand(data, 2, (0, 1)), "x", ["k", "side"])
    check(result, by_hand(data, 3, (0, 1)), "y", ["k", "side"])
    result.unpersist()


def test_known_values_and_single_row_group(spark):
    data = [("a", v) for v in (1.0, 2.0, 4.0, 10.0)] + [("b", 5.0), ("c", None)]
    got = {r["k"]: r for r in profile(spark.createDataFrame(data, "k string, x double"), ["k"], ["x"]).collect()}
    assert got["a"]["x_p25"] == 1.75 and round(got["a"]["x_std"], 4) == 4.0311
    assert got["b"]["x_std"] is None and got["b"]["x_p75"] == 5.0
    assert got["c"]["n_x"] == 0 and got["c"]["x_avg"] is None and got["c"]["x_p50"] is None


def test_group_of_nulls_and_equal_values_in_many_pieces(spark):
    data = [("a", 3.0)] * 20 + [("b", None)] * 20
    frame = profile(spread(spark, data, "k string, x double"), ["k"], ["x"], most_listed=0)
    got = {r["k"]: r for r in frame.collect()}
    assert got["a"]["x_p0"] == got["a"]["x_p100"] == 3.0 and got["a"]["x_std"] == 0.0
    assert got["b"]["n_x"] == 0 and got["b"]["x_p50"] is None


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.floats(-1e12, 1e12, allow_nan=False).map(lambda v: round(v, 3)), min_size=2, max_size=60
    )
)
def test_pieces_agree_with_sorting(spark, values):
    data = [("k", v) for v in values]
    frame = profile(spread(spark, data, "k string, x double"), ["k"], ["x"], most_listed=0)
    row = frame.first()
    points = [row[f"x_{name}"] for name in POINTS]
    assert points == sorted(points)
    for name, q in POINTS.items():
        assert row[f"x_{name}"] == pytest.approx(percentile(values, q), rel=1e-9, abs=1e-6)


def test_sums_and_decimal_and_integer_metrics(spark):
    frame = spark.range(1, 101, 1, 4).select(
        F.lit("k").alias("k"), F.col("id").alias("n"), F.col("id").cast("decimal(30,0)").alias("d")
    )
    for pieces in (1, 100):
        row = profile(frame, ["k"], ["n", "d"], sums=True, most_listed=pieces).first()
        assert row["n_sum"] == 5050 and row["n_p50"] == 50.5
        assert int(row["d_sum"]) == 5050 and row["d_p25"] == 25.75 and row["d_p100"] == 100.0


def test_approximate_form_stays_close(spark):
    frame = spark.range(0, 10001).select(F.lit("k").alias("k"), F.col("id").cast("double").alias("x"))
    row = profile(frame, ["k"], ["x"], approx=True).first()
    assert row["x_p0"] == 0 and row["x_p100"] == 10000
    assert abs(row["x_p50"] - 5000) <= 2


@pytest.mark.parametrize("pieces", [1, 100])
def test_values_that_are_not_finite(spark, pieces):
    """As everywhere in Spark, NaN is the greatest value."""
    inf, nan = float("inf"), float("nan")
    data = [("a", v) for v in (1.0, 2.0, inf, inf, inf)] + [("b", v) for v in (-inf, -inf, 0.0, nan)]
    frame = spread(spark, data, "k string, x double")
    got = {r["k"]: r for r in profile(frame, ["k"], ["x"], most_listed=pieces).collect()}
    assert [got["a"][f"x_{p}"] for p in POINTS] == [1.0, 2.0, inf, inf, inf]
    b = got["b"]
    assert b["x_p0"] == b["x_p25"] == -inf and b["x_p50"] == -inf and str(b["x_p100"]) == "nan"


def test_building_the_profile_starts_no_job(spark):
    frame = spread(spark, skewed(300), SCHEMA)
    spark.sparkContext.setJobGroup("lazy", "building a profile")
    try:
        profile(frame, ["k"], ["x", "y"], most_listed=0)
        started = spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not list(started)


def test_values_over_hundreds_of_magnitudes(spark):
    values = [10.0 ** (i / 4) for i in range(-400, 400)]
    data = [("k", v) for v in values]
    frame = spread(spark, data, "k string, x double")
    row = profile(frame, ["k"], ["x"], most_listed=0).first()
    for name, q in POINTS.items():
        assert row[f"x_{name}"] == pytest.approx(percentile(values, q), rel=1e-9)


def test_shuffle_sizing():
    from ridgeway.session import shuffle_partitions

    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(10**12) == 7451
    assert shuffle_partitions(10**14) == 100_000
