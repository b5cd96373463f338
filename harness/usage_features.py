"""Stand-in for the monthly usage feature table, built from the order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.sources import home_number, order_lines

# feature suffix -> line number that feeds it
KINDS = {
    "irtin": 1, "irtout": 2, "b2win": 3, "b2wout": 4, "cashin": 5, "cashout": 6,
    "p2pin": 7, "p2pout": 1, "paiementfacture": 2, "topup": 3,
    "transact_in": 4, "transact_out": 5,
}
PEAKS = ("irtin", "irtout", "b2win", "b2wout", "cashin", "cashout", "p2pin", "p2pout")
USAGES = {
    "usage_cashin": "cashin", "usage_cashout": "cashout", "usage_irtin": "irtin",
    "usage_irtout": "irtout", "usage_p2p_in": "p2pin", "usage_p2p_out": "p2pout",
    "usage_b2wout": "b2wout", "usage_b2win": "b2win",
    "usage_paiementfacture": "paiementfacture", "usage_frais_sco": "topup",
}
# a line belongs to a kind when its number fits and its quantity is in range
LOW, HIGH = 20, 45


def usage_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, line = F.col("l_extendedprice"), F.col("l_linenumber")
    busy = F.col("l_quantity").between(LOW, HIGH)
    columns = [F.avg("o_totalprice").alias("arpu"), F.max("o_orderpriority").alias("sexe")]
    for kind, number in KINDS.items():
        value = F.when(busy & (line == number), price)
        columns += [F.sum(value).alias(f"mnt_{kind}"), F.count(value).alias(f"nb_{kind}")]
        if kind in PEAKS:
            columns += [F.max(value).alias(f"max_{kind}"), F.min(value).alias(f"min_{kind}")]
    grouped = order_lines(spark, sf_dir).groupBy("o_custkey").agg(*columns)
    used = {
        name: F.when(F.col(f"nb_{kind}") > 2, 1).otherwise(0) for name, kind in USAGES.items()
    }
    return (
        grouped.withColumns(used)
        .withColumn("msisdn", home_number("o_custkey"))
        .withColumn("periode", F.concat(F.lit("20240"), (F.col("o_custkey") % 3 + 1).cast("string")))
        .drop("o_custkey")
    )


def centroids(features: tuple[str, ...]) -> dict[int, list[float]]:
    """Seven centres spread along the scale of the features."""
    steps = (20_000, 60_000, 110_000, 170_000, 240_000, 320_000, 410_000)
    return {
        label: [
            float(step + 5_000 * (i % 3)) if name.startswith("mnt_") else float(1 + label)
            for i, name in enumerate(features)
        ]
        for label, step in enumerate(steps)
    }
