import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridgeway.functions import predicates as P


def kept(spark, schema, data, predicate):
    frame = spark.createDataFrame(data, schema)
    return [r[0] for r in frame.where(predicate).collect()]


def test_day_range_includes_the_whole_last_day(spark):
    moments = [
        dt.datetime(2021, 1, 3, 23, 59, 59, 999999), dt.datetime(2021, 1, 4),
        dt.datetime(2021, 1, 10, 23, 59, 59, 999999), dt.datetime(2021, 1, 11),
    ]
    frame = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    for first, last in (("20210104", "20210110"), (dt.date(2021, 1, 4), "2021-01-10")):
        got = [r[0] for r in frame.where(P.in_days(F.col("t"), first, last)).collect()]
        assert got == moments[1:3]


def test_completed_needs_status_and_no_rollback(spark):
    data = [(1, "TS", None), (2, "TS", "Y"), (3, "TF", None), (4, None, None)]
    predicate = P.completed(F.col("s"), F.col("r"))
    assert kept(spark, "i int, s string, r string", data, predicate) == [1]


def test_not_cancelled_drops_null_status(spark):
    data = [(1, 4), (2, 5), (3, 6), (4, None)]
    assert kept(spark, "i int, s int", data, P.not_cancelled(F.col("s"))) == [1]


def test_open_record(spark):
    data = [(1, dt.date(9999, 12, 31)), (2, dt.date(2020, 1, 1)), (3, None)]
    assert kept(spark, "i int, d date", data, P.open_record(F.col("d"))) == [1]


def test_optional_filters_combine_with_and(spark):
    # as written, a second filter after the category broke the statement
    data = [(1, "X INTER", "a"), (2, "X INTER", "b"), (3, "LOCAL", "a")]
    predicate = P.all_of(
        P.in_category(F.col("c"), "inter"), P.equals_if(F.col("e"), "a"), P.equals_if(F.col("i"), None)
    )
    assert kept(spark, "i int, c string, e string", data, predicate) == [1]
    assert P.in_category(F.col("c"), "local") is None
    assert len(kept(spark, "i int, c string, e string", data, P.all_of(None, None))) == 3
    with pytest.raises(ValueError):
        P.in_category(F.col("c"), "elsewhere")


def test_not_like_any_folds_case(spark):
    data = [(1, "sp br_nova"), (2, "SPxCommunity"), (3, "other"), (4, None)]
    predicate = P.not_like_any(F.col("p"), ["%SP%BR_NOVA%", "%SP%COMMUNITY%"])
    assert kept(spark, "i int, p string", data, predicate) == [3]


def test_snapshot_and_key_range(spark):
    data = [(1, "202312"), (2, "202401"), (3, "202402"), (4, "202403")]
    assert kept(spark, "i int, m string", data, P.snapshot(F.col("m"), "202402")) == [3]
    assert kept(spark, "i int, m string", data, P.in_keys(F.col("m"), "202401", "202402")) == [2, 3]
