import math
import random

import pytest

from sportlake.operators import models

# Coefficients of a known curve: intercept, linear, quadratic.
CURVE = (-0.98105503, 0.09753414, -0.00176614)


def _on_curve(age):
    return CURVE[0] + CURVE[1] * age + CURVE[2] * age * age


def test_fit_recovers_a_curve(spark):
    rows = [(age, _on_curve(age)) for age in range(16, 38)]
    frame = spark.createDataFrame(rows, "age int, rating double")
    fit = models.fit_quadratic(frame).first()
    assert tuple(fit) == pytest.approx(CURVE, abs=1e-10)
    grid = {r.age: r.rating for r in models.predict_grid(models.fit_quadratic(frame)).collect()}
    assert sorted(grid) == list(range(11, 61))
    assert grid[28] == pytest.approx(_on_curve(28))
    stats = models.quadratic_stats(frame)
    by_age = models.predict_ages(stats, models.solve_quadratic(stats)).collect()
    assert len(by_age) == 22 and all(
        r.rating == pytest.approx(_on_curve(r.age)) for r in by_age
    )


def test_fit_agrees_with_the_library(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rng = random.Random(2)
    rows = [(age, rng.random()) for age in [rng.randint(17, 39) for _ in range(400)]]
    frame = models.quadratic_features(spark.createDataFrame(rows, "age int, rating double"))
    assembled = VectorAssembler(inputCols=["age_1", "age_2"], outputCol="x").transform(frame)
    fit = LinearRegression(featuresCol="x", labelCol="rating", solver="normal").fit(assembled)
    ours = models.fit_quadratic(frame).first()
    assert tuple(ours) == pytest.approx((fit.intercept, *fit.coefficients), rel=1e-6, abs=1e-9)


def test_too_few_ages_give_no_curve(spark):
    frame = spark.createDataFrame([(20, 0.1), (21, 0.2), (21, 0.3)], "age int, rating double")
    assert tuple(models.fit_quadratic(frame).first()) == (None, None, None)


def test_statistics_add_up(spark):
    rows = [(20 + i % 5, i / 10) for i in range(40)]
    both = spark.createDataFrame(rows, "age int, rating double")
    parts = [spark.createDataFrame(rows[i::3], "age int, rating double") for i in range(3)]
    summed = models.quadratic_stats(parts[0])
    for part in parts[1:]:
        summed = summed.unionByName(models.quadratic_stats(part))
    split, whole = models.solve_quadratic(summed).first(), models.fit_quadratic(both).first()
    # Parts count ages more than once, which must not change the sums.
    assert tuple(split) == pytest.approx(tuple(whole))


def _profiles(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        base = (i % 3) * 100
        rows.append((i, rng.random(), 0.0, i % 9, 20, *[base + rng.randint(0, 5) for _ in range(8)]))
    schema = "player_id long, rating double, delta double, matches int, age int, " + ", ".join(
        f"{c} long" for c in models.FEATURES[4:]
    )
    return rows, spark.createDataFrame(rows, schema)


def test_nearest_center(spark):
    rows, frame = _profiles(spark)
    given = frame.selectExpr("*", "player_id % 4 AS cluster")
    centers = {r.cluster: tuple(r)[1:] for r in models.cluster_centers(given).collect()}
    got = models.assign_clusters(frame, models.cluster_centers(given)).collect()
    for r in got:
        point = [r[c] for c in models.FEATURES]
        best = min(centers, key=lambda k: (math.dist(point, centers[k]), k))
        assert math.dist(point, centers[r.cluster]) == pytest.approx(
            math.dist(point, centers[best])
        )


def test_kmeans_and_cold_start(spark):
    rows, frame = _profiles(spark)
    for scale in (False, True):
        model = models.fit_clusters(frame, k=3, scale=scale)
        clustered = models.predict_clusters(model, frame)
        assert set(clustered.columns) == {*frame.columns, "cluster"}
    clusters = {r.player_id: (r.cluster, r.rating) for r in clustered.collect()}
    means = {}
    for cluster, rating in clusters.values():
        means.setdefault(cluster, []).append(rating)
    for limit in (3, 0):
        got = models.cold_start(clustered).collect()
        assert len(got) == 60
        for r in got:
            cluster, rating = clusters[r.player_id]
            mean = sum(means[cluster]) / len(means[cluster])
            assert r.rating == pytest.approx(mean if r.matches < 5 else rating)
        cold = {round(r.rating, 9) for r in got if r.matches < 5}
        assert len(cold) <= 3


def test_latest_prediction(spark):
    rows = [(20, 0.1, 1), (20, 0.2, 3), (20, 0.3, 2), (21, 0.4, 1)]
    frame = spark.createDataFrame(rows, "age int, rating double, batch int")
    got = sorted(map(tuple, models.latest_prediction(frame, "batch").collect()))
    assert got == [(20, 0.2), (21, 0.4)]


def test_cold_start_keeps_players_without_cluster(spark):
    rows = [(1, 0.5, 2, 0), (2, 0.7, 9, 0), (3, 0.2, 1, None)]
    clustered = spark.createDataFrame(rows, "player_id long, rating double, matches int, cluster int")
    got = {r.player_id: r.rating for r in models.cold_start(clustered).collect()}
    assert got == {1: 0.6, 2: 0.7, 3: 0.2}
