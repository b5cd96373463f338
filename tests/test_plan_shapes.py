"""The physical plans are the intended ones."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from harness import sources as S
from harness.queries import ALL_DAYS, registered
from ridgeway.operators.cohort import restrict_to_cohort
from ridgeway.operators.profile import profile
from ridgeway.plans import usage, wallet

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize(
    "name", ["wallet_profile", "recharge_tag_profile", "value_segments", "graph_indicators",
             "segment_centroid", "peer_in_out_profile", "line_base_two_contacts"],
)
def test_no_python_worker_and_no_cross_join(spark, name):
    plan = plan_of(registered()[name](spark, SMALL))
    for word in ("Python", "ArrowEval", "CartesianProduct", "NestedLoop"):
        assert word not in plan, word


def test_day_range_reaches_the_scan_and_columns_are_pruned(spark):
    orders = S.read(spark, SMALL, "orders").withColumn("acc", F.col("o_custkey").cast("string"))
    rows = usage.activity_extract(
        orders, S.cohort(spark, SMALL), ("19960101", "19961231"), "acc", ["o_orderkey"], "o_orderdate"
    )
    plan = plan_of(rows)
    pushed = re.search(r"PushedFilters: \[(.*o_orderdate.*)\]", plan).group(1)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    schemas = re.findall(r"ReadSchema: (.*)", plan)
    assert any("o_orderkey" in s and "o_totalprice" not in s for s in schemas)
    assert "LeftSemi" in plan


def test_two_sided_reshape_scans_each_source_once(spark):
    parties = wallet.wallet_parties(S.wallet_tx(spark, SMALL), [])
    plan = plan_of(parties)
    assert plan.count("Scan parquet") == 2 * 2  # tree and details, lines and orders
    assert "Generate" in plan and "Union" not in plan


def test_profile_reads_its_metrics_once_and_exchanges_them_once(spark):
    lines = S.read(spark, SMALL, "lineitem")
    described = profile(lines, ["l_suppkey"], ["l_tax", "l_discount"])
    described.collect()
    plan = described._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    read = re.findall(r"ReadSchema: struct<([^>]*)>", final)
    # the search for outsized groups found none, so its joins are gone
    assert len(read) == 1 and "l_tax" in read[0]
    assert final.count("Exchange hashpartitioning") == 1 and "Join" not in final
    keys_only = [c for c in re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(described)) if "l_tax" not in c]
    assert keys_only and all(c.startswith("l_suppkey") for c in keys_only)


def test_large_cohort_is_not_broadcast(spark):
    tx = S.wallet_tx(spark, SMALL).withColumn("msisdn", F.col("sender_msisdn"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        plan = plan_of(restrict_to_cohort(tx, S.cohort(spark, SMALL)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Broadcast" not in plan and "LeftSemi" in plan


def test_snapshot_equality_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    rows = S.fixed_lines(spark, SMALL)
    rows.write.partitionBy("date_jour").parquet(path)
    from ridgeway.plans import lines

    stored = spark.read.option("inferSchema", False).schema(rows.schema).parquet(path)
    plan = plan_of(lines.wireless_base(stored, S.line_cohort(spark, SMALL), "FDD", "20240101"))
    assert re.search(r"PartitionFilters: \[.*date_jour", plan)


def test_backfill_joins_days_not_ranges(spark):
    from ridgeway.operators.calendar import assign_periods, plan_periods

    periods = plan_periods(spark, "history", end="20010805", depth=10)
    plan = plan_of(assign_periods(S.read(spark, SMALL, "orders"), "o_orderdate", periods))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_days_argument_and_none_agree_on_a_full_range(spark, rows):
    tx, cohort = S.wallet_tx(spark, SMALL), S.cohort(spark, SMALL)
    assert rows(wallet.wallet_arpu(tx, cohort)) == rows(wallet.wallet_arpu(tx, cohort, ALL_DAYS))
