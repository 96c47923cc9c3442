import json
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from farelight.operators import models, sequence, stats
from farelight.plans import training

SPEC = models.ModelSpec("y", ("a", "b", "c", "f"), ("a", "b"), ("c",))


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(11)
    n = 600
    a, b = rng.normal(3, 2, n), rng.normal(-1, 5, n)
    c, f = rng.integers(1, 4, n), rng.integers(0, 2, n)
    y = 2 * a - 0.5 * b + np.array([0, 4, -3])[c - 1] + f + rng.normal(0, 1, n)
    rows = [(i, float(a[i]), float(b[i]), int(c[i]), int(f[i]), float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "i int, a double, b double, c int, f int, y double").cache(), (a, b, c, f, y)


def design(arrays):
    a, b, c, f, _ = arrays

    def z(x):
        return (x - x.mean()) / x.std()

    return np.column_stack([z(a), z(b), c == 2, c == 3, f]).astype(float)


def fitted(sample, regressor):
    rows, arrays = sample
    model = models.fit_model(rows, SPEC, regressor)
    got = models.predict(model, rows).orderBy("i").select("prediction").collect()
    return model, np.array([r[0] for r in got]), arrays


def ridge_predictions(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return y.mean() + xc @ w


def elastic_predictions(x, y, alpha, l1):
    xc, yc, n = x - x.mean(0), y - y.mean(), len(y)
    w = np.zeros(x.shape[1])
    for _ in range(2000):
        for j in range(len(w)):
            r = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1, 0) / (xc[:, j] @ xc[:, j] / n + alpha * (1 - l1))
    return y.mean() + xc @ w


def test_spec_positions():
    assert models.DURATION.scaled == ("trip_distance", "pickup_quarter", "pickup_seconds", "haversine_centroid_distance")
    assert models.DURATION.categorical == ("pickup_daytime", "pickup_hour", "pickup_weekday")
    assert models.DURATION.passthrough == ("pickup_holiday", "pickup_weekend")
    assert len(models.COST.features) == 16 and len(models.COST.scaled) == 6 and len(models.COST.categorical) == 6


def test_linear_regression_is_least_squares(sample):
    _, got, arrays = fitted(sample, "linear_regressor")
    assert got == pytest.approx(ridge_predictions(design(arrays), arrays[4], 0.0), abs=1e-6)


@pytest.mark.parametrize("alpha", [0.1, 50.0])
def test_ridge_penalty(sample, alpha):
    rows, arrays = sample
    rows = models.model_input(rows, SPEC, ("i",))
    about = models.label_stats(rows, "y")
    stage = models.ridge("y", about, params={**models.RIDGE, "alpha": alpha})
    model = Pipeline(stages=[*models.linear_stages(rows, SPEC), stage]).fit(rows)
    got = [r[0] for r in model.transform(rows).orderBy("i").select("prediction").collect()]
    assert got == pytest.approx(ridge_predictions(design(arrays), arrays[4], alpha), abs=1e-5)


def test_voting_is_the_mean_of_its_members(sample):
    _, got, arrays = fitted(sample, "voting_regressor")
    x, y = design(arrays), arrays[4]
    expected = (ridge_predictions(x, y, 0.0) + ridge_predictions(x, y, 0.1) + elastic_predictions(x, y, 0.1, 0.1)) / 3
    assert got == pytest.approx(expected, abs=1e-4)


def test_unknown_level_gets_zeros(spark, sample):
    rows, _ = sample
    levels = models.category_levels(rows, ("c",))
    assert levels == {"c": [1, 2, 3]}
    out = models.dummy_stage(levels).transform(spark.createDataFrame([(1,), (2,), (9,)], "c int")).orderBy("c").collect()
    assert [(r["c_is_2"], r["c_is_3"]) for r in out] == [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]


def test_scalers(sample):
    rows, (a, *_ ) = sample
    z = Pipeline(stages=models.standard_scale_stages(("a",), rows.count())).fit(rows).transform(rows)
    got = np.array([r[0] for r in z.orderBy("i").select(vector_to_array("scaled")[0]).collect()])
    assert got == pytest.approx((a - a.mean()) / a.std())
    m = Pipeline(stages=models.minmax_scale_stages(("a",))).fit(rows).transform(rows)
    got = np.array([r[0] for r in m.orderBy("i").select(vector_to_array("scaled")[0]).collect()])
    assert got == pytest.approx((a - a.min()) / (a.max() - a.min()))


def test_linear_models_store_and_load(spark, sample, tmp_path):
    model, got, _ = fitted(sample, "voting_regressor")
    model.write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    again = [r[0] for r in models.predict(loaded, sample[0]).orderBy("i").select("prediction").collect()]
    assert again == got.tolist()
    unseen = spark.createDataFrame([(0, 1.0, 2.0, 9, 0, 1.0), (1, None, 2.0, 1, 0, 1.0)], sample[0].schema)
    first = models.predict(loaded, unseen).orderBy("i").collect()
    assert first[0]["prediction"] is not None and first[1]["prediction"] is None


@pytest.mark.parametrize("regressor", ["linear_regressor", "voting_regressor"])
def test_folds_with_all_features(sample, regressor):
    rows, _ = sample
    folded = sequence.kfold_assign(rows, ["i"], 3)
    found = {r["fold"]: r["rmse"] for r in models.cross_validate(folded, SPEC, regressor).collect()}
    for number, rmse in found.items():
        model = models.fit_model(folded.filter(F.col("fold") != number), SPEC, regressor)
        own = models.holdout_evaluate(model, folded.filter(F.col("fold") == number), SPEC).first()["rmse"]
        assert rmse == pytest.approx(own, abs=1e-9)
    assert len(found) == 3


def test_forest_beats_the_deviation(sample):
    rows, _ = sample
    model = models.fit_model(rows, SPEC, "randomforest_regressor", {**models.FOREST, "n_estimators": 10, "max_depth": 6, "max_samples": 0.8})
    assert models.holdout_evaluate(model, rows, SPEC).first()["rmse"] < stats.describe_std(rows, "y").first()["std"]


def test_unknown_regressor(sample):
    with pytest.raises(ValueError, match="is not one of"):
        models.fit_model(sample[0], SPEC, "boosting")


def test_fit_per_chunk(sample):
    rows, (a, b, _, _, y) = sample
    chunked = rows.withColumn("chunk_id", (F.col("i") % 3).cast("bigint"))
    fits = models.chunked_least_squares(chunked.repartition(5), ["a", "b"], "y").collect()
    for r in fits:
        own = np.arange(len(y)) % 3 == r["chunk_id"]
        x = np.column_stack([np.ones(own.sum()), a[own], b[own]])
        w = np.linalg.lstsq(x, y[own], rcond=None)[0]
        assert [r["intercept"], *r["coefficients"]] == pytest.approx(w.tolist(), abs=1e-8)
        assert r["n"] == own.sum()


def test_singular_chunk_is_solved(spark):
    rows = spark.createDataFrame([(1, float(i), float(2 * i), float(i)) for i in range(10)], "chunk_id bigint, a double, b double, y double")
    fits = models.chunked_least_squares(rows, ["a", "b"], "y")
    scored = models.score_by_chunk(rows, fits, ["a", "b"])
    assert stats.regression_metrics(scored, "y").first()["rmse"] < 1e-8


def test_fold_fits_leave_their_fold_out(sample):
    rows, arrays = sample
    folded = sequence.kfold_assign(rows, ["i"], 4).withColumn("fold", F.col("fold").cast("bigint"))
    spec = models.ModelSpec("y", ("a", "b"), ("a", "b"), ())
    slow = {r["fold"]: r["rmse"] for r in models.cross_validate(folded, spec, "linear_regressor").collect()}
    fits = models.fold_least_squares(folded, ["a", "b"], "y")
    scored = models.score_by_chunk(folded, fits, ["a", "b"], "fold")
    fast = {r["fold"]: r["rmse"] for r in stats.regression_metrics(scored, "y", by=("fold",)).collect()}
    assert len(fast) == 4 and all(fast[k] == pytest.approx(slow[k], abs=1e-6) for k in fast)


def test_growth_truncates_and_stays_in_bounds():
    series = models.hyperparameter_growth(models.FOREST, 10)
    assert series[1]["n_estimators"] == int(100 * 1.15) and series[1]["max_depth"] == 28 and series[1]["min_samples_leaf"] == 5
    assert series[1]["max_samples"] == pytest.approx(0.2875)
    assert all(0 < p["max_samples"] <= 1 for p in series)
    with pytest.raises(ValueError):
        models.hyperparameter_growth({"max_samples": 1.2}, 0)


def test_growth_goes_on_beyond_all_doubles():
    series = models.hyperparameter_growth(models.FOREST, 6000)
    assert series[1000]["n_estimators"] == int(series[999]["n_estimators"] * 1.15)
    assert series[-1]["n_estimators"] == float("inf") and series[-1]["max_depth"] == models.DEEPEST and 0.25 < series[-1]["max_samples"] <= 1


def test_ensemble_and_cache(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 2.5), (4, None)], "i int, x double")
    members = [SQLTransformer(statement=f"SELECT *, {e} AS prediction FROM __THIS__") for e in ("x", "2 * x", "x + 1")]
    got = models.ensemble_mean(rows, members, "p").orderBy("i").collect()
    assert [r["p"] for r in got] == [round((x + 2 * x + x + 1) / 3, 2) if x else None for x in (1.0, 1.0, 2.5, None)]
    seen = []

    def score(distinct):
        seen.append(distinct.count())
        return models.ensemble_mean(distinct, members, "p")

    cached = models.prediction_cache(rows, ["x"], score, "p").orderBy("i").collect()
    assert [r["p"] for r in cached] == [r["p"] for r in got] and seen == [3]


def test_training_job(spark, tmp_path, sf_dir):
    from farelight.catalog import views
    from farelight.sources import checkpoints, sinks

    table, out = str(tmp_path / "enriched"), str(tmp_path / "models")
    sinks.partitioned_append(views.enriched(spark, sf_dir), table)
    scores = training.run(spark, table, "duration", "short_trip", "linear_regressor", out, chunk_size=1000).orderBy("chunk_id").collect()
    assert len(scores) >= 3 and scores[0]["percentage_improvement"] == 0.0 and scores[0]["patience"] == 0
    stored = checkpoints.scores_scan(spark, f"{out}/duration/short_trip/metadata/linear_regressor_scores")
    assert stored.count() == len(scores)
    bins = spark.read.json(f"{out}/duration/short_trip/residuals/linear_regressor_histogram")
    assert 0 < bins.count() <= 30
    with pytest.raises(ValueError):
        training.run(spark, table, "duration", "short_trip", "boosting", out)


def test_tuning_keeps_the_best_and_reports_what_was_fitted(spark, sample):
    rows, _ = sample
    train, test = rows.filter("i % 5 < 4"), rows.filter("i % 5 = 4")
    small = {**models.FOREST, "n_estimators": 4, "max_depth": 3, "max_samples": 0.7}
    model, tried = training.tune(train, test, SPEC, "randomforest_regressor", small, 1)
    tried = tried.orderBy("step").collect()
    assert [json.loads(r["params"])["max_depth"] for r in tried] == [3, 3] and sum(r["kept"] for r in tried) == 1
    best = min(r["rmse"] for r in tried)
    assert models.holdout_evaluate(model, test, SPEC).first()["rmse"] == pytest.approx(best)
    assert math.isfinite(best)
    start = models.start_params("voting_regressor")
    _, tried = training.tune(train, test, SPEC, "voting_regressor", start, 2)
    grown = [json.loads(r["params"])["ridge"] for r in tried.orderBy("step").collect()]
    assert [g["max_iter"] for g in grown] == [2000, 2300, 2645] and grown[1]["alpha"] == pytest.approx(0.115)


def test_depth_stays_at_what_can_be_fitted():
    series = models.hyperparameter_growth(models.FOREST, 4)
    assert [p["max_depth"] for p in series] == [25, 28, 30, 30, 30]
    with pytest.raises(ValueError):
        models.random_forest("y", {**models.FOREST, "max_depth": 32})


def test_score_by_chunk_keeps_rows_without_a_fit(spark):
    rows = spark.createDataFrame([(1, 2.0), (2, 3.0)], "chunk_id bigint, x double")
    fits = spark.createDataFrame([(1, 1.0, [2.0])], "chunk_id bigint, intercept double, coefficients array<double>")
    scored = {r["chunk_id"]: r["prediction"] for r in models.score_by_chunk(rows, fits, ["x"]).collect()}
    assert scored == {1: 5.0, 2: None}


def test_forest_folds_read_their_rows_once(spark, sample, tmp_path):
    """All folds are fitted on one kept input: the table is scanned once, however many folds there are."""
    rows, _ = sample
    path = str(tmp_path / "rows")
    sequence.kfold_assign(rows, ["i"], 3).repartition(2).write.parquet(path)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    scan = spark.read.parquet(path)
    small = {**models.FOREST, "n_estimators": 3, "max_depth": 3, "max_samples": 0.9}
    found = {r["fold"]: r for r in models.cross_validate(scan.mapInArrow(counted, scan.schema), SPEC, "randomforest_regressor", params=small).collect()}
    assert read.value == scan.count() and len(found) == 3
    for number, row in found.items():
        own = scan.filter(F.col("fold") == number)
        model = models.build_pipeline(SPEC, small).fit(models.model_input(scan.filter(F.col("fold") != number), SPEC))
        assert row["n"] == own.count()
        assert row["rmse"] == pytest.approx(models.holdout_evaluate(model, own, SPEC).first()["rmse"], rel=0.05)


def test_best_chunk_is_kept(spark, sample, tmp_path):
    rows, _ = sample
    rows = rows.withColumns({"chunk_id": F.col("i") % 4, "held": F.floor(F.col("i") / 4) % 3 == 0})
    # Labels of one chunk follow its features exactly, up to a little noise in another.
    noise = F.pmod(F.xxhash64("i"), F.lit(100)) / 100
    exact = F.when(F.col("chunk_id") == 2, F.col("a") * 3 + F.col("b") + 1).otherwise(F.col("y") + 5 * noise)
    rows = rows.withColumn("y", exact)
    train, test = rows.filter("not held"), rows.filter("held and chunk_id <> 3")
    fits, columns = models.chunk_fits(train, SPEC)
    scores = models.chunk_scores(test, SPEC, fits, columns)
    assert {r["chunk_id"] for r in scores.collect()} == {0, 1, 2}
    models.store_chunk_models(fits, scores, columns, str(tmp_path / "models"))
    chunk, fit = models.kept_model(spark, str(tmp_path / "models"))
    assert chunk == 2 and fit.names == tuple(columns)
    scored = models.predict(fit.model(), models.model_input(rows.filter("chunk_id = 2"), SPEC)).collect()
    assert np.allclose([r["prediction"] for r in scored], [r["y"] for r in scored], atol=1e-6)
    with pytest.raises(ValueError):
        models.store_chunk_models(fits, scores.limit(0), columns, str(tmp_path / "none"))
        models.kept_model(spark, str(tmp_path / "none"))


def test_score_table_over_runs(spark, tmp_path):
    seen = []

    def score(distinct):
        seen.append(sorted(tuple(r) for r in distinct.fillna(-1).collect()))
        return distinct.withColumn("p", F.coalesce("x", F.lit(100.0)) + F.coalesce("k", F.lit(1000)))

    rows = [(1, 1.0, 2), (2, 1.0, 2), (3, None, 2), (4, 1.5, None)]
    more = [(5, None, 2), (6, 1.0, 3), (7, 1.0, 2), (8, 1.5, None), (9, None, None)]
    schema = "i int, x double, k int"
    table = models.ScoreTable(spark, str(tmp_path), "a", ["x", "k"], "p")
    found, n = table.scored(spark.createDataFrame(rows, schema), score)
    assert n == 3 and {r["i"]: r["p"] for r in found.collect()} == {1: 3.0, 2: 3.0, 3: 102.0, 4: 1001.5}
    found, n = models.ScoreTable(spark, str(tmp_path), "a", ["x", "k"], "p").scored(spark.createDataFrame(more, schema), score)
    assert n == 2 and {r["i"]: r["p"] for r in found.collect()} == {5: 102.0, 6: 4.0, 7: 3.0, 8: 1001.5, 9: 1100.0}
    assert seen == [[(-1.0, 2), (1.0, 2), (1.5, -1)], [(-1.0, -1), (1.0, 3)]]
    assert table.scored(spark.createDataFrame(more, schema), score)[1] == 0 and len(seen) == 2
    # Another version of the model starts anew.
    assert models.ScoreTable(spark, str(tmp_path), "b", ["x", "k"], "p").scored(spark.createDataFrame([], schema), score)[1] == 0
    assert len(seen) == 3 and seen[2] == []
