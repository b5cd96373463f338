import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ridgeway.sources import files, jdbc

CONNECTION = jdbc.Connection("jdbc:example:host", "example.Driver", "someone", "hidden")


def test_query_alias_follows_the_database():
    options = jdbc.source_options(CONNECTION, None, "select 1")
    assert options["dbtable"] == "(select 1) as src"
    oracle = jdbc.Connection("u", "d", "someone", "hidden", "oracle")
    assert jdbc.source_options(oracle, None, "select 1")["dbtable"] == "(select 1) src"
    assert jdbc.source_options(oracle, "schema.t@link", None)["dbtable"] == "schema.t@link"
    assert "hidden" not in repr(CONNECTION)
    with pytest.raises(ValueError):
        jdbc.source_options(CONNECTION, "t", "select 1")
    with pytest.raises(ValueError):
        jdbc.Connection("u", "d", "someone", "hidden", "other")


def test_parallel_read_options():
    split = jdbc.split_options("id", 0, 1000, 16)
    assert split == {"partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "16"}
    predicates = jdbc.day_predicates("ts", "20240228", "20240301")
    assert predicates == [
        "ts >= DATE '2024-02-28' AND ts < DATE '2024-02-29'",
        "ts >= DATE '2024-02-29' AND ts < DATE '2024-03-01'",
        "ts >= DATE '2024-03-01' AND ts < DATE '2024-03-02'",
    ]


class FakeReader:
    """Records what the reader is asked for; no database is involved."""

    def __init__(self):
        self.calls = []

    def format(self, name):
        self.calls.append(("format", name))
        return self

    def options(self, **options):
        self.calls.append(("options", options))
        return self

    def load(self):
        return self

    def jdbc(self, url, table, predicates, properties):
        self.calls.append(("jdbc", url, table, predicates, properties))
        return self


class FakeSession:
    def __init__(self):
        self.read = FakeReader()


def test_read_jdbc_passes_slices_to_the_reader():
    session = FakeSession()
    jdbc.read_jdbc(session, CONNECTION, table="t", split=jdbc.split_options("id", 0, 9, 3))
    assert session.read.calls[0] == ("format", "jdbc")
    assert session.read.calls[1][1]["numPartitions"] == "3"
    session = FakeSession()
    jdbc.read_jdbc(session, CONNECTION, query="select 1", predicates=["a", "b"])
    kind, url, table, predicates, properties = session.read.calls[0]
    assert (kind, table, predicates) == ("jdbc", "(select 1) as src", ["a", "b"])
    assert "dbtable" not in properties and properties["user"] == "someone"


def test_cohort_file_keeps_numbers_as_text(spark, tmp_path, rows):
    path = tmp_path / "clients.csv"
    path.write_text("Name;Phone\nx;2250700000001\ny;2250700000001\nz;0700000002\nw;\n")
    cohort = files.read_cohort(spark, str(path))
    assert cohort.schema.simpleString() == "struct<phone:string>"
    assert rows(cohort) == [("0700000002",), ("2250700000001",)]


def test_table_with_header_round_trips(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double")
    files.write_table(frame, path)
    back = spark.read.option("header", True).schema("k string, v double").csv(path)
    assert sorted(map(tuple, back.collect()), key=repr) == [("a", 1.5), ("b", None)]


def test_a_rerun_replaces_its_own_period_only(spark, tmp_path, rows):
    path = files.result_path(str(tmp_path) + "/", "wallet", "SMS", None, "LOCAL")
    assert path.endswith("/wallet/sms/local")
    week = dt.date(2024, 1, 1)

    def delivered(values):
        data = [(week + dt.timedelta(days=7 * w), v) for w, v in values]
        frame = spark.createDataFrame(data, "period_start date, v int")
        return files.with_period_name(frame.withColumn("period_end", F.date_add("period_start", 6)))

    files.write_table(delivered([(0, 1), (1, 2)]), path, ("period",))
    files.write_table(delivered([(1, 3)]), path, ("period",))
    back = spark.read.option("header", True).csv(path)
    assert rows(back, "period", "v") == [("20240101_to_20240107", "1"), ("20240108_to_20240114", "3")]
    assert files.period_name("20240101", "20240107") == "20240101_to_20240107"
    assert {d for d in os.listdir(path) if d.startswith("period=")} == {
        "period=20240101_to_20240107",
        "period=20240108_to_20240114",
    }


def test_other_formats_and_plain_csv(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1)], "k string, v int")
    files.write_table(frame, str(tmp_path / "p"), file_format="parquet")
    assert spark.read.parquet(str(tmp_path / "p")).collect() == frame.collect()
    files.write_plain_csv(frame, str(tmp_path / "c"))
    assert spark.read.text(str(tmp_path / "c")).first()[0] == "a,1"
