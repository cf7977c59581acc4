"""Clusters of similar players and the rating-versus-age curve."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas

FEATURES = [f.name for f in schemas.PROFILE.fields if f.name != "player_id"]

# Ages are centred here before powers are summed, which keeps the sums well conditioned.
CENTER = 28.0


def fit_clusters(
    profile: DataFrame,
    k: int = 5,
    max_iter: int = 10,
    seed: int = 42,
    scale: bool = False,
    features: list[str] = FEATURES,
) -> PipelineModel:
    """K-means over the raw profile columns, random start; scaling is optional."""
    stages = [VectorAssembler(inputCols=features, outputCol="raw_features")]
    column = "raw_features"
    if scale:
        stages.append(StandardScaler(inputCol=column, outputCol="scaled_features"))
        column = "scaled_features"
    stages.append(
        KMeans(
            k=k,
            maxIter=max_iter,
            initMode="random",
            seed=seed,
            featuresCol=column,
            predictionCol="cluster",
        )
    )
    return Pipeline(stages=stages).fit(profile)


def predict_clusters(model: PipelineModel, profile: DataFrame) -> DataFrame:
    """Profiles with their cluster."""
    return model.transform(profile).drop("raw_features", "scaled_features")


def cluster_centers(clustered: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Mean of every feature per cluster."""
    return clustered.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in features])


def assign_clusters(
    profile: DataFrame, centers: DataFrame, features: list[str] = FEATURES
) -> DataFrame:
    """Nearest of the given centers for each profile, the lower number on ties.

    ``centers`` has one row per cluster. It is turned into one array by a scalar subquery,
    so the profiles stay where they are; the number of clusters bounds its size.
    """
    array = centers.agg(
        F.array_sort(F.collect_list(F.struct("cluster", *features)))
    ).scalar()

    def squared_distance(center: Column) -> Column:
        total = F.lit(0.0)
        for feature in features:
            gap = F.col(feature) - center[feature]
            total = total + gap * gap
        return total

    ranked = F.transform(
        "centers",
        lambda c: F.struct(
            squared_distance(c).alias("distance"), c["cluster"].alias("cluster")
        ),
    )
    return (
        profile.withColumn("centers", array)
        .withColumn("cluster", F.array_min(ranked)["cluster"])
        .drop("centers")
    )


def cluster_means(clustered: DataFrame) -> DataFrame:
    """Mean rating per cluster, rarely seen players included."""
    return clustered.groupBy("cluster").agg(F.avg("rating").alias("cluster_rating"))


def cold_start(clustered: DataFrame, min_matches: int = 5) -> DataFrame:
    """Replaces the rating of players with fewer matches by their cluster's mean.

    The means combine before the shuffle. How they come back is left to Spark, which knows
    their size when it joins. A player without cluster, or in one without a mean, keeps the
    rating.
    """
    means = cluster_means(clustered)
    mean = F.coalesce("cluster_rating", "rating")
    rating = F.when(F.col("matches") < min_matches, mean).otherwise(F.col("rating"))
    return (
        clustered.join(means, "cluster", "left")
        .withColumn("rating", rating)
        .select(*clustered.columns)
    )


def quadratic_features(rows: DataFrame) -> DataFrame:
    """Age and its square next to the rating."""
    age = F.col("age").cast("double")
    return rows.withColumn("age_1", age).withColumn("age_2", age * age)


def quadratic_stats(rows: DataFrame) -> DataFrame:
    """Sums per age from which the least-squares curve follows.

    One row per age with the number of ratings and their sum. Rows of disjoint inputs add
    up, so streams can keep them batch by batch, and ages bound their number.
    """
    return (
        rows.where("age IS NOT NULL AND rating IS NOT NULL")
        .groupBy("age")
        .agg(F.count("*").alias("n"), F.sum("rating").alias("rating_sum"))
    )


def quadratic_changes(changes: DataFrame) -> DataFrame:
    """What changed ratings change the sums per age by, from ``rating`` and ``old_rating`` (null: new)."""
    new = F.col("old_rating").isNull().cast("long")
    return (
        changes.where("age IS NOT NULL AND rating IS NOT NULL")
        .groupBy("age")
        .agg(
            F.sum(new).alias("n"),
            F.sum(F.col("rating") - F.coalesce("old_rating", F.lit(0.0))).alias("rating_sum"),
        )
    )


def solve_quadratic(stats: DataFrame, center: float = CENTER) -> DataFrame:
    """One row with intercept, linear and quadratic coefficient of the least-squares fit.

    All three are null when fewer than three ages occur.
    """
    x = F.col("age").cast("double") - center
    n = F.col("n").cast("double")
    y = F.col("rating_sum")
    sums = stats.agg(
        F.sum(n).alias("s0"),
        F.sum(n * x).alias("s1"),
        F.sum(n * x * x).alias("s2"),
        F.sum(n * x * x * x).alias("s3"),
        F.sum(n * x * x * x * x).alias("s4"),
        F.sum(y).alias("t0"),
        F.sum(y * x).alias("t1"),
        F.sum(y * x * x).alias("t2"),
        F.count("*").alias("ages"),
    )
    s0, s1, s2, s3, s4, t0, t1, t2 = (
        F.col(c) for c in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2")
    )

    def det(rows: list[list[Column]]) -> Column:
        (a, b, c), (d, e, f), (g, h, i) = rows
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    solvable = F.when(F.col("ages") >= 3, det([[s0, s1, s2], [s1, s2, s3], [s2, s3, s4]]))
    solved = sums.select(
        F.try_divide(det([[t0, s1, s2], [t1, s2, s3], [t2, s3, s4]]), solvable).alias("c0"),
        F.try_divide(det([[s0, t0, s2], [s1, t1, s3], [s2, t2, s4]]), solvable).alias("c1"),
        F.try_divide(det([[s0, s1, t0], [s1, s2, t1], [s2, s3, t2]]), solvable).alias("c2"),
    )
    c0, c1, c2 = F.col("c0"), F.col("c1"), F.col("c2")
    return solved.select(
        (c0 - c1 * center + c2 * center * center).alias("intercept"),
        (c1 - 2 * center * c2).alias("linear"),
        c2.alias("quadratic"),
    )


def fit_quadratic(rows: DataFrame) -> DataFrame:
    """Least-squares curve of rating over age and its square, with intercept."""
    return solve_quadratic(quadratic_stats(rows))


def curve(age: Column) -> Column:
    """Value of the curve at an age, for rows that carry the coefficients."""
    x = age.cast("double")
    return F.col("intercept") + F.col("linear") * x + F.col("quadratic") * x * x


def predict_grid(coefficients: DataFrame, first: int = 11, last: int = 60) -> DataFrame:
    """Predicted rating for every age of the grid."""
    return coefficients.withColumn(
        "age", F.explode(F.sequence(F.lit(first), F.lit(last)))
    ).select("age", curve(F.col("age")).alias("rating"))


def predict_ages(stats: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Predicted rating for every age that occurs in the statistics."""
    fitted = coefficients.select(F.struct("*")).scalar()
    return (
        stats.select("age")
        .distinct()
        .withColumn("fit", fitted)
        .select("age", "fit.*")
        .select("age", curve(F.col("age")).alias("rating"))
    )


def latest_prediction(predictions: DataFrame, order: str) -> DataFrame:
    """Last prediction per age; an age without a new one keeps the old."""
    return predictions.groupBy("age").agg(
        F.max_by("rating", order).alias("rating")
    )
