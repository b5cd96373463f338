"""Even slices of skewed keys, deliveries that appear as a whole, and the cohort's sieve."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ridgeway.operators import cohort as C
from ridgeway.sources import files, jdbc


# -- slices -----------------------------------------------------------------
def counted(keys):
    """A database that counts: cells of a width from a lowest key on."""
    asked = []

    def count(low, high, width):
        asked.append((low, high, width))
        return list(Counter((k - low) // width for k in keys if low <= k < high).items())

    return count, asked


def slice_sizes(spark, keys, predicates):
    frame = spark.createDataFrame([(k,) for k in keys], "k bigint")
    return [frame.where(p).count() for p in predicates]


def test_skewed_keys_give_even_slices(spark):
    draw = random.Random(8)
    keys = [int(draw.random() ** 6 * 10**9) for _ in range(4000)] + [None] * 10
    known = [k for k in keys if k is not None]
    count, asked = counted(known)
    predicates = jdbc.even_predicates("k", count, min(known), max(known) + 1, 8)
    sizes = slice_sizes(spark, keys, predicates)
    assert len(sizes) == 8 and sum(sizes) == len(keys)
    assert max(sizes) <= 1.3 * len(keys) / 8 and min(sizes) >= 0.6 * len(keys) / 8
    assert len(asked) > 1 and all(-(-(b - a) // w) <= jdbc.HISTOGRAM_CELLS for a, b, w in asked)
    width = (max(known) + 1) // 8
    plain = Counter(k // width for k in known)
    assert max(plain.values()) > 3 * max(sizes)


def test_a_key_with_a_third_of_all_rows_is_a_slice_by_itself(spark):
    keys = [500_000] * 2000 + list(range(0, 1_000_000, 250)) + [-5, 2_000_000]
    count, _ = counted(keys)
    predicates = jdbc.even_predicates("k", count, 0, 1_000_000, 6)
    sizes = slice_sizes(spark, keys, predicates)
    assert sum(sizes) == len(keys) and 2000 <= max(sizes) <= 2400
    assert sorted(sizes)[-2] < 1300
    assert jdbc.even_cuts([(0, 1, 9)], 4) == []
    everything = jdbc.even_predicates("k", counted([])[0], 0, 10, 4)
    assert slice_sizes(spark, [1, None], everything) == [2]
    with pytest.raises(ValueError):
        jdbc.even_predicates("k", count, 5, 5, 4)


def test_the_histogram_is_counted_by_the_database():
    query = jdbc.histogram_query("T", "ID", 10, 500, 7)
    assert query == (
        "SELECT FLOOR((ID - 10) / 7) AS cell, COUNT(*) AS n FROM T"
        " WHERE ID >= 10 AND ID < 500 GROUP BY FLOOR((ID - 10) / 7)"
    )


# -- publishing -------------------------------------------------------------
def delivery(spark, values, tag):
    rows = [(p, f"{tag}{i}") for p in values for i in range(3)]
    return spark.createDataFrame(rows, "period string, v string")


def seen(spark, path):
    return {(r["period"], r["v"][0]) for r in files.read_published(spark, path).collect()}


def test_a_later_delivery_replaces_its_periods_only(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        files.read_published(spark, path)
    assert files.publish(delivery(spark, ["p1", "p2", None], "a"), path, "period") == 1
    assert files.publish(delivery(spark, ["p2", "p3"], "b"), path, "period") == 2
    assert seen(spark, path) == {("p1", "a"), ("p2", "b"), ("p3", "b"), (None, "a")}
    assert files.read_published(spark, path).columns == ["period", "v"]


def test_a_delivery_that_fails_midway_leaves_the_old_result(spark, tmp_path):
    path = str(tmp_path / "out")
    files.publish(delivery(spark, ["p1", "p2"], "a"), path, "period")
    broken = delivery(spark, ["p1", "p2", "p3"], "b").repartition(3, "period").withColumn(
        "v", F.when(F.col("period") == "p2", F.raise_error(F.lit("lost"))).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="lost"):
        files.publish(broken, path, "period")
    assert seen(spark, path) == {("p1", "a"), ("p2", "a")}
    assert files.publish(delivery(spark, ["p3"], "c"), path, "period") == 2


def test_a_manifest_is_never_overwritten(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    files.publish(delivery(spark, ["p1"], "a"), path, "period")
    files.publish(delivery(spark, ["p1"], "b"), path, "period")
    monkeypatch.setattr(files, "_manifest", lambda *_: (1, {}))
    with pytest.raises(RuntimeError, match="in the meantime"):
        files.publish(delivery(spark, ["p1"], "c"), path, "period")
    monkeypatch.undo()
    assert seen(spark, path) == {("p1", "b")}


# -- sieve ------------------------------------------------------------------
@pytest.fixture()
def numbers(spark, tmp_path):
    spark.range(0, 20_000).select(F.concat(F.lit("22507"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("msisdn")).write.parquet(str(tmp_path / "n"))
    everyone = spark.read.parquet(str(tmp_path / "n"))
    return everyone, everyone.where("msisdn LIKE '%7'").select(F.col("msisdn").alias("phone"))


def test_sieve_drops_most_others_and_no_member(spark, numbers):
    everyone, cohort = numbers
    extra = everyone.unionByName(everyone.limit(1).select(F.lit(None).cast("string").alias("msisdn")))
    sifted = C.sift(extra, cohort, words=1 << 12)
    members = {r["phone"] for r in cohort.collect()}
    left = {r["msisdn"] for r in sifted.collect()}
    assert members <= left and len(left) < len(members) * 1.1
    kept = C.restrict_to_cohort(extra, cohort, sieve_words=1 << 12)
    assert {r["msisdn"] for r in kept.collect()} == members
    none = C.restrict_to_cohort(extra, cohort.where("1 = 0"), sieve_words=64)
    assert none.count() == 0


def test_sieve_stands_below_the_shuffle(spark, numbers):
    everyone, cohort = numbers
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        kept = C.restrict_to_cohort(everyone, cohort, sieve_words=1 << 12)
        assert kept.count() == 2000
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    side = plan[plan.index("Exchange hashpartitioning(msisdn") :]
    assert "Filter" in side[: side.index("FileScan")] and "ubquery" in side[: side.index("FileScan")]
