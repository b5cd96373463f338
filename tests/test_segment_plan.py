"""The plan of the behavioural segments stays small."""

import pytest
from pyspark.sql import functions as F

from ridgeway.functions.usage import MODEL_FEATURES
from ridgeway.operators import segment as M


def labelled(spark, rows):
    """Rows whose features are filled, as those of the jobs are, and labelled by two centres."""
    raw = spark.createDataFrame(rows, "p string, v double, x double")
    raw = raw.select("p", "v", *[F.col("x").alias(name) for name in MODEL_FEATURES])
    filled = M.fill_features(raw, MODEL_FEATURES).na.fill(0)
    return M.assign_labels(filled, MODEL_FEATURES, {i: [10.0 * i] * len(MODEL_FEATURES) for i in range(3)})


@pytest.mark.parametrize("by", [[], ["p"]])
def test_means_put_no_condition_on_the_label_below_the_features(spark, rows, by):
    data = [("m", 1.0, None), ("m", 3.0, 1.0), ("n", 5.0, 0.0), ("n", 9.0, 11.0), ("m", 2.0, 20.0)]
    splits, whole = {0: ("<=", "S1", "S2"), 1: (">=", "S3", "S4")}, {2: "S5"}
    found = M.split_by_mean(labelled(spark, data), "v", by, splits, whole)
    assert found.columns[: 1 + len(by)] == ["label", *by] and found.columns[-1] == "categorie"
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Filter" in line and "zip_with" in line]
    third = "S1" if by else "S2"
    expected = [("S1", 1.0), (third, 5.0), ("S3", 9.0), ("S5", 2.0), ("S2", 3.0) if by else ("S1", 3.0)]
    assert rows(found, "categorie", "v") == sorted(expected, key=repr)


def test_a_label_below_zero_keeps_its_own_mean(spark, rows):
    frame = spark.createDataFrame([(-1, 1.0), (-1, 3.0), (7, 100.0), (None, 50.0)], "label int, v double")
    found = M.split_by_mean(frame, "v", [], {-1: ("<=", "A", "B")}, {7: "C"})
    assert rows(found, "categorie", "v") == sorted([("A", 1.0), ("B", 3.0), ("C", 100.0), (None, 50.0)], key=repr)
