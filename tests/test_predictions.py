"""Queries of fitted values against brute force."""

import math

import numpy as np
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from farelight.catalog import FITTED, views
from farelight.operators import models, requests, sequence


def design(rows, spec, levels):
    """Intercept, numbers centred, and 0/1 columns of the levels but the first."""
    numbers = [np.array([float(r[c]) for r in rows]) for c in (*spec.scaled, *spec.passthrough)]
    dummies = [np.array([float(r[c] == v) for r in rows]) for c, values in levels.items() for v in values[1:]]
    return np.column_stack([np.ones(len(rows)), *numbers, *dummies])


def least_squares(train, asked, spec):
    levels = {c: sorted({r[c] for r in train}) for c in spec.categorical}
    x, y = design(train, spec, levels), np.array([r[spec.target] for r in train])
    scale = np.abs(x).max(axis=0) + 1e-12
    return design(asked, spec, levels) / scale @ np.linalg.lstsq(x / scale, y, rcond=1e-11)[0]


def test_batch_predictions_serve_both_trip_types(spark, sf_dir):
    trips = views.enriched(spark, sf_dir).drop("trip_type")
    found = FITTED["batch_predictions"](spark, sf_dir).cache()
    assert found.count() == trips.count()
    assert found.filter("score_status <> 'ok' OR NOT (dropoff_fits AND eta_fits AND answer_fits)").count() == 0
    train = views.enriched(spark, sf_dir).collect()
    # The same trips with what was predicted, as the cost models saw them.
    single = found.groupBy("trip_key").count().filter("count = 1")
    predicted = found.join(single, "trip_key", "left_semi").select("trip_key", "trip_duration", "trip_cost", "dropoff_ts")
    asked = trips.drop(*[c for c in trips.columns if c.startswith("dropoff_") or c in ("trip_duration", "trip_cost")]).join(predicted, "trip_key")
    asked = requests.end_features(asked, "dropoff", F.col("dropoff_ts"), views.HOLIDAYS).collect()
    for kind, long in (("short_trip", False), ("long_trip", True)):
        part, wanted = [r for r in train if r["trip_type"] == kind], [r for r in asked if (r["trip_distance"] > 35.0) == long]
        assert len(part) >= len(wanted) > 100
        for spec in (models.DURATION, models.COST):
            # Predictions are rounded to hundredths.
            expected = least_squares(part, wanted, spec)
            assert np.allclose([r[spec.target] for r in wanted], expected, rtol=1e-5, atol=0.0051), (kind, spec.target)


def metrics_of(rows, predicted, target):
    y = np.array([r[target] for r in rows])
    error = y - predicted
    return len(y), np.sqrt((error**2).mean()), 1 - (error**2).mean() / y.var(), np.abs(error).mean()


def test_holdout_metrics_by_least_squares(spark, sf_dir):
    """Trimmed by quantiles, fitted on training rows and judged on the others, each with numpy."""
    found = {(r["target"], r["regressor"], r["trip_type"]): r for r in FITTED["linear_holdout"](spark, sf_dir).collect()}
    assert len(found) == 8
    trips = sequence.hash_split(views.enriched(spark, sf_dir), ["trip_key"]).collect()
    for target, spec in (("duration", models.DURATION), ("cost", models.COST)):
        for kind in ("short_trip", "long_trip"):
            own = sorted((r for r in trips if r["trip_type"] == kind), key=lambda r: r[spec.target])
            low, high = (own[math.floor((len(own) - 1) * q + 0.5)][spec.target] for q in (0.05, 0.99))
            own = [r for r in own if math.floor(low) <= r[spec.target] <= high]
            train, held = [r for r in own if r["is_train"]], [r for r in own if not r["is_train"]]
            expected = metrics_of(held, least_squares(train, held, spec), spec.target)
            row = found[target, "linear_regressor", kind]
            # Few rows and many levels leave least squares ill-conditioned here.
            assert np.allclose([row["n"], row["rmse"], row["r2"], row["mae"]], expected, rtol=2e-3, atol=1e-7)
            # Penalties change the mean of three members little.
            assert found[target, "voting_regressor", kind]["rmse"] < 1.2 * expected[1]


def test_kept_chunk_model_by_least_squares(spark, sf_dir):
    spec = models.DURATION
    found = FITTED["kept_chunk_model_full"](spark, sf_dir).collect()
    trips = sequence.hash_split(views.enriched(spark, sf_dir), ["trip_key"]).withColumn("chunk", F.floor(F.col("l_orderkey") / 1000)).collect()
    errors = {}
    levels = {c: sorted({r[c] for r in trips if r["is_train"]}) for c in spec.categorical}
    fits = {}
    for chunk in {r["chunk"] for r in trips}:
        train, held = ([r for r in trips if r["chunk"] == chunk and r["is_train"] == flag] for flag in (True, False))
        if train and held:
            x = design(train, spec, levels)[:, 1:]
            centre, y = x.mean(axis=0), np.array([r[spec.target] for r in train])
            weights = np.linalg.pinv((x - centre).T @ (x - centre), rcond=1e-12) @ (x - centre).T @ (y - y.mean())
            fits[chunk] = (lambda rows, w=weights, m=y.mean(), c=centre: m + (design(rows, spec, levels)[:, 1:] - c) @ w)
            errors[chunk] = metrics_of(held, fits[chunk](held), spec.target)[1]
    best = min(errors, key=lambda c: (errors[c], c))
    assert {r["chunk_id"] for r in found} == {best}
    held = [r for r in trips if not r["is_train"]]
    assert np.allclose(sorted(r["prediction"] for r in found), sorted(fits[best](held)), rtol=1e-4, atol=1e-4)


def test_requests_without_model_or_distance_come_back(spark):
    rows = spark.sql(
        "SELECT id, timestamp_ntz'2000-05-16 07:20:00' AS pickup_ts, d AS trip_distance, 1.0D AS haversine_centroid_distance "
        "FROM VALUES (1, 3.0D), (2, 40.0D), (3, CAST(NULL AS DOUBLE)), (4, 35.0D) AS t(id, d)"
    )
    fixed = {name: SQLTransformer(statement=f"SELECT *, {value} AS prediction FROM __THIS__") for name, value in (("duration", "10.0D"), ("cost", "25.0D"))}
    served = {"short_trip": [fixed["duration"]]}, {"short_trip": [fixed["cost"]], "long_trip": [fixed["cost"]]}
    for duration, cost, long in ((*served, "no_model"), ({**served[0], "long_trip": [fixed["duration"]]}, served[1], "ok")):
        found = {r["id"]: r for r in requests.batch_score(rows, duration, cost, []).collect()}
        assert [found[i]["score_status"] for i in (1, 2, 3, 4)] == ["ok", long, "no_distance", "ok"]
        for r in found.values():
            predicted = [r[c] for c in ("trip_duration", "dropoff_ts", "trip_cost", "eta", "answer")]
            assert all(v is not None for v in predicted) if r["score_status"] == "ok" else predicted == [None] * 5
