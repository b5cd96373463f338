"""The same results in the most direct Spark form, as a yardstick.

These follow how the batch jobs are usually stated: both sides of a transaction
by two scans and a union, five separate percentile calls per metric, one
aggregate per graph indicator joined in a chain. The tests check that they give
the same rows; ``bench.py`` times them next to the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness import sources as S
from harness.queries import _edges, stable

QUANTILES = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}


def _describe(metrics: list[str]) -> list:
    columns = []
    for m in metrics:
        columns += [F.avg(m).alias(f"{m}_avg"), F.stddev(m).alias(f"{m}_std")]
        columns += [F.expr(f"percentile({m}, {q})").alias(f"{m}_{n}") for n, q in QUANTILES.items()]
    return columns


def wallet_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = S.wallet_tx(spark, sf_dir)
    day = F.to_date("transaction_date_time")
    done = tx.where(day.between("1995-01-01", "2001-12-31")).where(
        (F.col("transaction_status") == "TS") & F.col("rollbacked").isNull()
    )

    def side(own: str, other: str, is_send: int) -> DataFrame:
        return done.select(
            F.expr(f"concat('22507', right({own}_msisdn, 8))").alias("msisdn"),
            F.lit(is_send).alias("is_send"),
            F.col(f"{own}_user_id").alias("user_id"),
            F.col(f"{own}_pre_balance").alias("pre_balance"),
            F.col(f"{own}_post_balance").alias("post_balance"),
            F.col(f"{own}_category_code").alias("category_code"),
            F.col(f"{other}_category_code").alias("other_category_code"),
            F.col("transaction_amount").alias("amount"),
            F.col("service_charge_amount").alias("service_charge"),
            F.col("transaction_tag").alias("tag"),
        )

    rows = side("sender", "receiver", 1).union(side("receiver", "sender", 0))
    cohort = S.cohort(spark, sf_dir)
    kept = rows.join(cohort, rows["msisdn"] == cohort["phone"]).drop("phone")
    keys = ["msisdn", "user_id", "is_send", "tag", "category_code", "other_category_code"]
    metrics = ["pre_balance", "post_balance", "amount", "service_charge"]
    return stable(
        kept.groupBy(*keys).agg(
            F.count("pre_balance").alias("n_transactions"), *_describe(metrics)
        )
    )


def graph_in_out_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _edges(spark, sf_dir)
    weight = "total_transaction"
    aggregates = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "count": F.count}
    result = None
    for side, end in (("in", "dst"), ("out", "src")):
        ends = edges.withColumnRenamed(end, "id")
        parts = [
            ends.groupBy("id").agg(f(weight).alias(f"{name}_{side}"))
            for name, f in aggregates.items()
        ]
        parts.append(ends.groupBy("id").agg(F.count(F.lit(1)).alias(f"{side}_degree")))
        for part in parts:
            result = part if result is None else result.join(part, "id")
    return stable(result)


PLAIN = {"wallet_profile": wallet_profile, "graph_in_out_profile": graph_in_out_profile}
