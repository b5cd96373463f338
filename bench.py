"""Time the headline queries and print one JSON line.

Every query is written to Spark's ``noop`` sink, so the whole result is computed
and nothing is collected. ``value`` is the sum of each query's best of three runs.
``plain`` times the same results in their most direct form (harness/plain.py);
With BENCH_SPREAD=1, ``spread`` times both forms of the wallet profile on 64 partitions
that are not merged.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness.plain import PLAIN  # noqa: E402
from harness.queries import registered  # noqa: E402
from ridgeway.session import build_session  # noqa: E402

HEADLINE = (
    "wallet_profile", "wallet_arpu", "transfer_profile", "recharge_weekly_profile",
    "recharge_tag_profile", "subscription_mix", "activity_extract", "data_usage_profile",
    "bill_payments", "value_segments", "multi_flag", "fleet_flag", "geo_location",
    "line_base_one_contact", "line_base_two_contacts", "graph_in_out_profile",
    "graph_triangles", "graph_indicators", "telecom_sms", "telecom_voix", "telecom_data",
    "telecom_sva", "peer_in_out_profile", "backfill_weekly", "segment_centroid",
)
RUNS = 3
SPREAD_QUERY = "wallet_profile"
SPREAD = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
# Untimed first: class loading and code generation would fall on whatever
# happens to run first.
WARM_UP = ("wallet_arpu", "graph_in_out_profile", "value_segments")


def timed(query, spark, sf_dir: str) -> float:
    best = float("inf")
    for _ in range(RUNS):
        started = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - started)
    return round(best, 3)


def spread(spark, sf_dir: str) -> dict[str, float]:
    before = {key: spark.conf.get(key) for key in SPREAD}
    try:
        for key, value in SPREAD.items():
            spark.conf.set(key, value)
        forms = {"library": registered()[SPREAD_QUERY], "plain": PLAIN[SPREAD_QUERY]}
        return {name: timed(query, spark, sf_dir) for name, query in forms.items()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    known = registered()
    for name in WARM_UP:
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {name: timed(known[name], spark, sf_dir) for name in wanted}
    plain = {name: timed(query, spark, sf_dir) for name, query in PLAIN.items() if name in wanted}
    scattered = spread(spark, sf_dir) if os.environ.get("BENCH_SPREAD") == "1" else {}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "plain": plain,
                "spread": scattered,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
