"""Wallet behaviour segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.functions import predicates as P
from ridgeway.functions import usage as U
from ridgeway.operators.calendar import MONTH_ID, slice_snapshots
from ridgeway.operators.cohort import restrict_to_cohort
from ridgeway.operators.segment import (
    SPLITS,
    WHOLE,
    assign_labels,
    cluster_of,
    fill_features,
    split_by_mean,
)

# Descriptive columns, delivered with their NULLs.
DESCRIPTORS = (
    "departement_travail", "region_residence", "anciennete_mois",
    "nb_dist_transact", "freq_mois",
)
VALUE = "arpu"


def usage_measures(features: DataFrame) -> DataFrame:
    """Add amounts, service flags and the number of services in use."""
    return features.withColumns({**U.amount_measures(), **U.service_measures()})


def wallet_segments(
    features: DataFrame,
    cohort: DataFrame,
    centroids: Mapping[int, Sequence[float]],
    months: tuple[str, str] | DataFrame | None = None,
    model_features: Sequence[str] = U.MODEL_FEATURES,
    by: Sequence[str] = (),
    splits: Mapping[int, tuple[str, str, str]] = SPLITS,
    whole: Mapping[int, str] = WHOLE,
) -> DataFrame:
    """Label, category and cluster of every cohort member.

    ``splits`` and ``whole`` give the labels of ``centroids`` their categories; the
    defaults belong to the delivered model, other centroids need their own. Labels
    that neither names are refused. ``months`` is an inclusive range of period keys, or
    a calendar of months. The mean that splits a
    label is taken over the whole range, or per ``by`` (for instance
    ``["periode"]``) when several periods are scored in one job.
    """
    unnamed = set(centroids) - set(splits) - set(whole)
    if unnamed:
        raise ValueError(f"labels without category: {sorted(unnamed)}")
    rows = features
    if isinstance(months, DataFrame):
        rows = slice_snapshots(rows, "periode", months, MONTH_ID)
    elif months is not None:
        rows = rows.where(P.in_keys(F.col("periode"), *months))
    rows = restrict_to_cohort(rows, cohort)
    kept = [c for c in rows.columns if c.lower() not in DESCRIPTORS]
    numeric = [f.name for f in rows.schema if f.name in kept and f.dataType.typeName() != "string"]
    rows = fill_features(rows, model_features).na.fill(0, numeric)
    measured = usage_measures(rows).withColumn("arpu_om", F.col(VALUE))
    labelled = assign_labels(measured, model_features, centroids)
    split = split_by_mean(labelled, "arpu_om", by, splits, whole)
    return split.withColumn("cluster", cluster_of(F.col("categorie")))
