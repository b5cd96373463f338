"""Behavioural segments: nearest centroid, mean split, category and cluster."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Per label, which side of the label's own mean takes which
# category. "<=" and ">=" say where the mean itself falls.
SPLITS = {
    0: ("<=", "S11", "S41"),
    4: ("<=", "S21", "S32"),
    5: (">=", "S12", "S22"),
    3: ("<=", "S42", "S51"),
    1: (">=", "S31", "S61"),
    6: ("<=", "S52", "S72"),
}
WHOLE = {2: "S71"}


def fill_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as doubles with NULL read as zero."""
    return df.withColumns(
        {f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features}
    )


def standardise(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Centre and scale the features (population deviation; a constant feature
    becomes zero). Optional: the delivered segments use raw features."""
    moments = df.agg(
        *[F.avg(f).alias(f"__avg_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"__std_{f}") for f in features],
    )
    # one row, whatever the input
    row = moments.first().asDict()
    scaled = {}
    for f in features:
        mean, deviation = row[f"__avg_{f}"], row[f"__std_{f}"]
        scaled[f] = (F.col(f) - F.lit(mean)) / F.lit(deviation) if deviation else F.lit(0.0)
    return df.withColumns(scaled)


def nearest_centroid(features: Sequence[str], centroids: Mapping[int, Sequence[float]]) -> Column:
    """Label of the closest centroid (Euclidean, lowest label on a tie).

    The centroids are literals of the expression: scoring is a projection,
    without a join or a Python worker.
    """
    point = F.array(*features)
    distances = []
    for label, centre in sorted(centroids.items()):
        if len(centre) != len(features):
            raise ValueError(f"centroid {label} has {len(centre)} values, expected {len(features)}")
        target = F.array(*[F.lit(float(value)) for value in centre])
        squares = F.zip_with(point, target, lambda x, y: (x - y) * (x - y))
        distance = F.aggregate(squares, F.lit(0.0), lambda total, square: total + square)
        distances.append(F.struct(distance.alias("distance"), F.lit(label).alias("label")))
    return F.array_min(F.array(*distances))["label"]


def assign_labels(
    df: DataFrame, features: Sequence[str], centroids: Mapping[int, Sequence[float]]
) -> DataFrame:
    return df.withColumn("label", nearest_centroid(features, centroids))


def fit_centroids(
    df: DataFrame, features: Sequence[str], k: int = 7, seed: int = 1, max_iter: int = 20
) -> dict[int, list[float]]:
    """Train the clusters with MLlib; returns ``k`` centroids, a fixed-size result.

    Labels are numbered by the centres' values, first feature first, so that a label
    has a meaning that does not depend on the order in which clusters were found.
    """
    assembled = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="error"
    ).transform(fill_features(df, features).select(*features))
    model = KMeans(k=k, seed=seed, maxIter=max_iter).fit(assembled.select("features"))
    centres = sorted([float(x) for x in centre] for centre in model.clusterCenters())
    return dict(enumerate(centres))


def predict_with_model(df: DataFrame, features: Sequence[str], model) -> DataFrame:
    """Label rows with a trained MLlib model instead of plain centroids."""
    vector = array_to_vector(F.array(*features))
    scored = model.setFeaturesCol("__features").setPredictionCol("label")
    return scored.transform(df.withColumn("__features", vector)).drop("__features")


def split_by_mean(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    splits: Mapping[int, tuple[str, str, str]] = SPLITS,
    whole: Mapping[int, str] = WHOLE,
) -> DataFrame:
    """Category of each row from its label and the label's mean of ``value``.

    ``splits`` says per label which side of the mean takes which category, ``whole``
    names the category of labels that are not split. Both belong to one set of
    centroids; a label in neither has no category.

    The means are one small aggregate (split labels x ``by`` rows) joined back, so the
    rows of a label are never brought together in one task. Without ``by`` there are at
    most one more of them than ``splits`` has labels, and they are broadcast.
    """
    # Rows of other labels share a key that is never null. A condition on the label, also
    # one that Spark infers from a key that may be null, is pushed below the features,
    # where the optimiser derives a variant of it for every subset of them.
    split = F.when(F.col("label").isin(*splits), F.col("label"))
    keyed = df.withColumn("__split", F.coalesce(split, F.lit(min(splits, default=0) - 1)))
    keys = ["__split", *by]
    means = keyed.groupBy(*keys).agg(F.avg(value).alias("__mean"))
    joined = keyed.join(means if by else F.broadcast(means), keys, "left")
    first = ["label", *by]
    joined = joined.select(*first, *[c for c in df.columns if c not in first], "__mean")
    category = F.lit(None).cast("string")
    for label, name in whole.items():
        category = F.when(F.col("label") == label, name).otherwise(category)
    for label, (side, inside, outside) in splits.items():
        x, mean = F.col(value), F.col("__mean")
        hit = x <= mean if side == "<=" else x >= mean
        halves = F.when(hit, inside).otherwise(outside)
        category = F.when(F.col("label") == label, halves).otherwise(category)
    return joined.withColumn("categorie", category).drop("__mean")


def cluster_of(category: Column) -> Column:
    """Final cluster: the first digit of the category."""
    return F.substring(category, 2, 1)
