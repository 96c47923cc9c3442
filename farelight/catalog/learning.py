"""Queries: feature stages, regressors and scoring.

Single-feature fits have a closed form, which SQL states; models with all features are held to the conditions
that only their optimum meets.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelight.catalog import views
from farelight.catalog.registry import fitted_query, query
from farelight.operators import models, requests, sequence, stats
from farelight.session import broadcast_if_small, materialize, work_path

ONE = models.ModelSpec("trip_duration", ("trip_distance",), ("trip_distance",), ())
DISTANCE_ONLY = ["trip_distance"]

# Trips within the quantile bounds of a target, per trip type.
TRIMMED = """(SELECT t.* FROM features t JOIN (
    SELECT trip_type, floor(max({target}) FILTER (r = floor((n - 1) * 0.05::DOUBLE + 0.5))) AS lo,
           max({target}) FILTER (r = floor((n - 1) * 0.99::DOUBLE + 0.5)) AS hi
    FROM (SELECT trip_type, {target}, row_number() OVER (PARTITION BY trip_type ORDER BY {target}) - 1 AS r,
                 count(*) OVER (PARTITION BY trip_type) AS n FROM features) GROUP BY trip_type) b
  ON t.trip_type = b.trip_type WHERE {target} BETWEEN lo AND hi)"""


def _rows(spark, sf_dir):
    """Enriched trips with split and fold."""
    rows = sequence.hash_split(views.enriched(spark, sf_dir), ["trip_key"])
    return sequence.kfold_assign(rows, ["trip_key"])


NAMED = (
    "round(trip_distance, 6) AS trip_distance, pickup_daytime::DOUBLE AS pickup_daytime, pickup_hour::DOUBLE AS pickup_hour, "
    "pickup_weekday::DOUBLE AS pickup_weekday, pickup_quarter::DOUBLE AS pickup_quarter, pickup_seconds::DOUBLE AS pickup_seconds, "
    "pickup_holiday::DOUBLE AS pickup_holiday, pickup_weekend::DOUBLE AS pickup_weekend, "
    "round(haversine_centroid_distance, 6) AS haversine_centroid_distance"
)


@query("feature_vector", f"SELECT trip_key, {NAMED} FROM features", ("features",))
def feature_vector(spark, sf_dir):
    rows = models.feature_vector(views.enriched(spark, sf_dir), models.DURATION)
    values = vector_to_array("features")
    named = [F.round(values[i], 6).alias(name) for i, name in enumerate(models.DURATION.features)]
    return rows.select("trip_key", *named)


SCALED = models.DURATION.scaled


def _scaled_columns(rows, output):
    values = vector_to_array(output)
    return rows.select("trip_key", *[F.round(values[i], 6).alias(name) for i, name in enumerate(SCALED)])


@query(
    "standard_scale",
    "SELECT trip_key, " + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in SCALED) + " FROM features",
    ("features",),
)
def standard_scale(spark, sf_dir):
    rows = materialize(views.enriched(spark, sf_dir).select("trip_key", *SCALED), "rows")
    fitted = Pipeline(stages=models.standard_scale_stages(SCALED, rows.count())).fit(rows)
    return _scaled_columns(fitted.transform(rows), "scaled")


@query(
    "minmax_scale",
    "SELECT trip_key, " + ", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}" for c in SCALED) + " FROM features",
    ("features",),
)
def minmax_scale(spark, sf_dir):
    rows = materialize(views.enriched(spark, sf_dir).select("trip_key", *SCALED), "rows")
    return _scaled_columns(Pipeline(stages=models.minmax_scale_stages(SCALED)).fit(rows).transform(rows), "scaled")


@query(
    "one_hot_drop_first",
    "SELECT trip_key, " + ", ".join(
        f"({column} = {value})::INTEGER::DOUBLE AS {column}_is_{value}"
        for column, top in (("pickup_daytime", 3), ("pickup_weekday", 7)) for value in range(2, top + 1)
    ) + " FROM features",
    ("features",),
)
def one_hot_drop_first(spark, sf_dir):
    rows = materialize(views.enriched(spark, sf_dir).select("trip_key", "pickup_daytime", "pickup_weekday"), "rows")
    levels = models.category_levels(rows, ("pickup_daytime", "pickup_weekday"))
    return models.dummy_stage(levels).transform(rows).drop("pickup_daytime", "pickup_weekday")


BOTH_ENDS = """(SELECT f.*, (CASE WHEN hour(tpep_dropoff_datetime) BETWEEN 7 AND 10 OR hour(tpep_dropoff_datetime) BETWEEN 16 AND 19 THEN 1
           WHEN hour(tpep_dropoff_datetime) >= 20 OR hour(tpep_dropoff_datetime) <= 6 THEN 2 ELSE 3 END) AS dropoff_daytime,
       hour(tpep_dropoff_datetime) AS dropoff_hour, isodow(tpep_dropoff_datetime) AS dropoff_weekday,
       (hour(tpep_dropoff_datetime) * 60 + minute(tpep_dropoff_datetime)) // 15 AS dropoff_quarter,
       hour(tpep_dropoff_datetime) * 60 + minute(tpep_dropoff_datetime) AS dropoff_seconds,
       (tpep_dropoff_datetime::DATE IN (SELECT d FROM holidays))::INTEGER AS dropoff_holiday,
       (isodow(tpep_dropoff_datetime) >= 6)::INTEGER AS dropoff_weekend FROM features f)"""
COST_SCALED = models.COST.scaled


@query(
    "feature_vector_cost",
    "SELECT trip_key, " + ", ".join(f"round({c}::DOUBLE, 6) AS {c}" for c in models.COST.features) + f" FROM {BOTH_ENDS}",
    ("holidays", "features"),
)
def feature_vector_cost(spark, sf_dir):
    rows = models.feature_vector(views.enriched(spark, sf_dir), models.COST)
    values = vector_to_array("features")
    return rows.select("trip_key", *[F.round(values[i], 6).alias(name) for i, name in enumerate(models.COST.features)])


def _scaled_cost(spark, sf_dir, stages):
    rows = materialize(views.enriched(spark, sf_dir).select("trip_key", *COST_SCALED), "rows")
    values = vector_to_array("scaled")
    scaled = Pipeline(stages=stages(rows)).fit(rows).transform(rows)
    return scaled.select("trip_key", *[F.round(values[i], 6).alias(name) for i, name in enumerate(COST_SCALED)])


@query(
    "standard_scale_cost",
    "SELECT trip_key, " + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in COST_SCALED)
    + f" FROM {BOTH_ENDS}",
    ("holidays", "features"),
)
def standard_scale_cost(spark, sf_dir):
    return _scaled_cost(spark, sf_dir, lambda rows: models.standard_scale_stages(COST_SCALED, rows.count()))


@query(
    "minmax_scale_cost",
    "SELECT trip_key, "
    + ", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}" for c in COST_SCALED)
    + f" FROM {BOTH_ENDS}",
    ("holidays", "features"),
)
def minmax_scale_cost(spark, sf_dir):
    return _scaled_cost(spark, sf_dir, lambda rows: models.minmax_scale_stages(COST_SCALED))


# Every value of these occurs in the tables; an hour is one of 24.
COST_LEVELS = {c: range(1, 4) if "daytime" in c else range(24) if "hour" in c else range(1, 8) for c in models.COST.categorical}


@query(
    "one_hot_drop_first_cost",
    "SELECT trip_key, "
    + ", ".join(f"({c} = {v})::INTEGER::DOUBLE AS {c}_is_{v}" for c, values in COST_LEVELS.items() for v in values[1:])
    + f" FROM {BOTH_ENDS}",
    ("holidays", "features"),
)
def one_hot_drop_first_cost(spark, sf_dir):
    columns = models.COST.categorical
    rows = materialize(views.enriched(spark, sf_dir).select("trip_key", *columns), "rows")
    return models.dummy_stage(models.category_levels(rows, columns)).transform(rows).drop(*columns)


def _line(spark, model, rows):
    """(n, intercept, slope, r2) of a fitted single-feature model."""
    return spark.createDataFrame(
        [(rows, float(model.intercept), float(model.coefficients[0]), float(model.summary.r2))],
        "n bigint, intercept double, slope double, r2 double",
    ).select("n", *[F.round(c, 5).alias(c) for c in ("intercept", "slope", "r2")])


@query(
    "linear_regression",
    "SELECT count(*) AS n, round(regr_intercept(trip_duration, haversine_centroid_distance), 5) AS intercept, "
    "round(regr_slope(trip_duration, haversine_centroid_distance), 5) AS slope, "
    "round(regr_r2(trip_duration, haversine_centroid_distance), 5) AS r2 FROM enriched",
    ("enriched",),
)
def linear_regression(spark, sf_dir):
    rows = materialize(views.enriched(spark, sf_dir).select("trip_duration", "haversine_centroid_distance"), "rows")
    stage = models.standard_scale_stages(("haversine_centroid_distance",), rows.count())[0]
    model = models.linear_regression("trip_duration", features="_raw").fit(stage.transform(rows))
    return _line(spark, model, rows.count())


CENTRED = (
    "(SELECT count(*) AS n, avg(trip_duration) AS y, avg(trip_distance) AS x, stddev_pop(trip_distance) AS s, "
    "covar_pop(trip_distance, trip_duration) / stddev_pop(trip_distance) AS zy FROM enriched)"
)
RIDGE_WEIGHT = "(n * zy / (n + 0.1))"
ELASTIC_WEIGHT = "(CASE WHEN zy > 0.01 THEN zy - 0.01 WHEN zy < -0.01 THEN zy + 0.01 ELSE 0 END / 1.09)"


def _scaled_fit(spark, sf_dir, make):
    rows = materialize(views.enriched(spark, sf_dir).select("trip_duration", "trip_distance"), "rows")
    about = models.label_stats(rows, "trip_duration")
    n = about.n
    stages = models.standard_scale_stages(DISTANCE_ONLY, n)
    fitted = Pipeline(stages=[*stages, make(about)]).fit(rows)
    model = fitted.stages[-1]
    return spark.createDataFrame(
        [(n, float(model.intercept), float(model.coefficients[0]))], "n bigint, intercept double, slope double"
    ).select("n", F.round("intercept", 4).alias("intercept"), F.round("slope", 4).alias("slope"))


@query("ridge", f"SELECT n, round(y, 4) AS intercept, round({RIDGE_WEIGHT}, 4) AS slope FROM {CENTRED}", ("enriched",))
def ridge(spark, sf_dir):
    return _scaled_fit(spark, sf_dir, lambda about: models.ridge("trip_duration", about, features="scaled"))


@query("elastic_net", f"SELECT n, round(y, 4) AS intercept, round({ELASTIC_WEIGHT}, 4) AS slope FROM {CENTRED}", ("enriched",))
def elastic_net(spark, sf_dir):
    return _scaled_fit(spark, sf_dir, lambda about: models.elastic_net("trip_duration", about, features="scaled"))


@query(
    "voting_mean",
    f"SELECT trip_key, round(y + (trip_distance - x) / s * (zy + {RIDGE_WEIGHT} + {ELASTIC_WEIGHT}) / 3, 3) AS prediction FROM enriched, {CENTRED}",
    ("enriched",),
)
def voting_mean(spark, sf_dir):
    rows = materialize(views.enriched(spark, sf_dir).select("trip_key", "trip_duration", "trip_distance"), "rows")
    model = models.fit_model(rows, ONE, "voting_regressor")
    return models.predict(model, rows).select("trip_key", F.round("prediction", 3).alias("prediction"))


def _trimmed(spark, sf_dir, spec):
    rows = _rows(spark, sf_dir).select("trip_type", "is_train", spec.target, *spec.features)
    return materialize(stats.quantile_trim(materialize(rows, "model_rows"), spec.target, ("trip_type",)), "trimmed")


LEVELS = ("pickup_daytime", "pickup_hour", "pickup_weekday")
NUMBERS = [f for f in models.DURATION.features if f not in LEVELS]
TERMS = ", ".join(
    f"{{'term': '{c}', 'level': {f'{c}::INTEGER' if c in LEVELS else 'NULL::INTEGER'}}}" for c in ("all", *NUMBERS, *LEVELS)
)


@query(
    "duration_linear_model",
    f"SELECT term, level, count(*) AS n, 0.0 AS moment FROM {TRIMMED.format(target='trip_duration')}, unnest([{TERMS}]) u(t), "
    "LATERAL (SELECT t.term AS term, t.level AS level) WHERE is_train GROUP BY term, level",
    ("features",),
)
def duration_linear_model(spark, sf_dir):
    """Least squares on all nine features: residuals have no mean, overall, per level, or along a number."""
    spec = models.DURATION
    train = _trimmed(spark, sf_dir, spec).filter("is_train")
    model = models.fit_model(train, spec, "linear_regressor")
    scored = materialize(models.predict(model, models.model_input(train, spec)), "scored")
    error = F.col(spec.target) - F.col("prediction")
    about = scored.agg(
        *[F.avg(c).alias(f"m_{c}") for c in NUMBERS], *[F.stddev_pop(c).alias(f"s_{c}") for c in NUMBERS]
    ).first()
    parts = [F.struct(F.lit("all").alias("term"), F.lit(None).cast("int").alias("level"), F.lit(1.0).alias("x"))]
    for c in NUMBERS:
        scaled = (F.col(c) - about[f"m_{c}"]) / (about[f"s_{c}"] or 1.0)
        parts.append(F.struct(F.lit(c).alias("term"), F.lit(None).cast("int").alias("level"), scaled.alias("x")))
    parts += [F.struct(F.lit(c).alias("term"), F.col(c).cast("int").alias("level"), F.lit(1.0).alias("x")) for c in LEVELS]
    terms = scored.select(error.alias("e"), F.inline(F.array(*parts)))
    found = terms.groupBy("term", "level").agg(F.count("*").alias("n"), F.avg(F.col("e") * F.col("x")).alias("moment"))
    return found.withColumn("moment", F.round("moment", 4) + 0.0)


@query(
    "cost_voting_model",
    "SELECT part, n, 0.0 AS violation FROM (SELECT count(*) AS n "
    f"FROM {TRIMMED.format(target='trip_cost')} WHERE is_train), (VALUES ('linear'), ('ridge'), ('elastic_net'), ('mean')) t(part)",
    ("features",),
)
def cost_voting_model(spark, sf_dir):
    """Three penalised fits on all sixteen features and their mean: how far each is from its optimality conditions.

    Conditions are on z-scores for scaled columns, as the penalties are.
    """
    spec = models.COST
    train = _trimmed(spark, sf_dir, spec).filter("is_train")
    fit = models.fit_linear(train, spec, "voting_regressor")
    rows = models.model_input(train, spec)
    errors = [(F.col(spec.target) - F.expr(fit.member_expression(m))).alias(m) for m in fit.members]
    mean = sum((F.expr(fit.member_expression(m)) for m in fit.members), F.lit(0.0)) / len(fit.members)
    apart = F.abs(F.expr(fit.expression()) - mean).alias("mean")
    values = F.array(*[F.expr(c).cast("double") for c in fit.columns]).alias("x")
    long = materialize(rows.select(*errors, apart, F.posexplode(values).alias("j", "x")), "long")
    moments = long.groupBy("j").agg(
        F.count("*").alias("n"), F.max("mean").alias("mean"), F.avg("x").alias("m"), F.stddev_pop("x").alias("s"),
        *[F.avg(F.col(m) * F.col("x")).alias(m) for m in fit.members], *[F.avg(m).alias(f"rest_{m}") for m in fit.members],
    ).collect()
    alpha, net = models.RIDGE["alpha"], models.ELASTIC_NET
    worst = dict.fromkeys(("mean", *fit.members), 0.0)
    for r in moments:
        scale = r["s"] if r["j"] < len(spec.scaled) and r["s"] else 1.0
        worst["mean"] = max(worst["mean"], r["mean"])
        for member in fit.members:
            slope = (r[member] - r["m"] * r[f"rest_{member}"]) / scale
            w = fit.members[member][1][r["j"]] * scale
            if member == "ridge":
                slope -= alpha * w / r["n"]
            elif member == "elastic_net":
                slope -= net["alpha"] * (1 - net["l1_ratio"]) * w
                limit = net["alpha"] * net["l1_ratio"]
                slope = slope - math.copysign(limit, w) if w else max(0.0, abs(slope) - limit)
            worst[member] = max(worst[member], abs(slope), abs(r[f"rest_{member}"]))
    found = [(part, moments[0]["n"], float(value)) for part, value in worst.items()]
    return spark.createDataFrame(found, "part string, n long, violation double").withColumn("violation", F.round("violation", 4))


@query(
    "random_forest",
    f"SELECT trip_type, count(*) AS n, true AS within_labels, true AS better_than_deviation "
    f"FROM {TRIMMED.format(target='trip_duration')} WHERE NOT is_train GROUP BY trip_type",
    ("features",),
)
def random_forest(spark, sf_dir):
    """The forest with its start parameters: predictions within the labels it saw, error on them below their deviation."""
    spec = models.DURATION
    rows = _trimmed(spark, sf_dir, spec)
    train, test = rows.filter("is_train"), rows.filter(~F.col("is_train"))
    model = models.fit_model(train, spec, "randomforest_regressor")
    low, high = train.agg(F.min(spec.target), F.max(spec.target)).first()
    error = F.sqrt(F.avg((F.col(spec.target) - F.col("prediction")) ** 2))
    learned = models.predict(model, models.model_input(train, spec)).agg(error < F.stddev_pop(spec.target)).first()[0]
    scored = models.predict(model, models.model_input(test, spec, ("trip_type",)))
    return scored.groupBy("trip_type").agg(
        F.count("*").alias("n"),
        F.bool_and(F.col("prediction").between(low - 1e-9, high + 1e-9)).alias("within_labels"),
        F.lit(learned).alias("better_than_deviation"),
    )


def _holdout(spark, sf_dir, fits):
    """Metrics of models with all features on the rows they have not seen, a model per target, regressor and trip type."""
    found = []
    for target, spec, regressors in fits:
        rows = _trimmed(spark, sf_dir, spec)
        for kind in sorted(r[0] for r in rows.select("trip_type").distinct().collect()):
            part = rows.filter(F.col("trip_type") == kind)
            for regressor in regressors:
                model = models.fit_model(part.filter("is_train"), spec, regressor)
                metrics = models.holdout_evaluate(model, part.filter(~F.col("is_train")), spec)
                found.append(metrics.select(F.lit(target).alias("target"), F.lit(regressor).alias("regressor"), F.lit(kind).alias("trip_type"), "*"))
    return reduce(DataFrame.unionByName, found)


@fitted_query("linear_holdout")
def linear_holdout(spark, sf_dir):
    """Linear and voting models of duration and cost, per trip type."""
    linear = ("linear_regressor", "voting_regressor")
    return _holdout(spark, sf_dir, (("duration", models.DURATION, linear), ("cost", models.COST, linear)))


@fitted_query("forest_holdout")
def forest_holdout(spark, sf_dir):
    """The duration forest with its start parameters, per trip type."""
    return _holdout(spark, sf_dir, (("duration", models.DURATION, ("randomforest_regressor",)),))


@query(
    "cross_validate",
    "SELECT f.fold, count(*) AS n, round(sqrt(avg((trip_duration - a - b * trip_distance) ** 2)), 4) AS rmse FROM features f JOIN ("
    "SELECT k::BIGINT AS fold, regr_slope(trip_duration, trip_distance) AS b, regr_intercept(trip_duration, trip_distance) AS a "
    "FROM features JOIN range(10) t(k) ON fold <> k GROUP BY k) m ON f.fold = m.fold GROUP BY f.fold",
    ("features",),
)
def cross_validate(spark, sf_dir):
    rows = materialize(_rows(spark, sf_dir).select("fold", "trip_duration", "trip_distance"), "rows")
    found = models.cross_validate(rows, ONE, "linear_regressor")
    return found.select(F.col("fold").cast("bigint").alias("fold"), "n", F.round("rmse", 4).alias("rmse"))


@query(
    "fold_least_squares",
    "SELECT k::BIGINT AS fold, count(*) AS n, round(regr_intercept(trip_duration, trip_distance), 5) AS intercept, "
    "round(regr_slope(trip_duration, trip_distance), 5) AS slope FROM features JOIN range(10) t(k) ON fold <> k GROUP BY k",
    ("features",),
)
def fold_least_squares(spark, sf_dir):
    """The fits themselves, of every fold's complement, from one pass over the rows."""
    rows = _rows(spark, sf_dir).select(F.col("fold").cast("bigint").alias("fold"), "trip_duration", "trip_distance")
    fits = models.fold_least_squares(rows, DISTANCE_ONLY, "trip_duration")
    return fits.select("fold", "n", F.round("intercept", 5).alias("intercept"), F.round(F.col("coefficients")[0], 5).alias("slope"))


@query(
    "holdout_evaluate",
    "SELECT trip_type, count(*) AS n, round(sqrt(avg(e * e)), 4) AS rmse, round(1 - avg(e * e) / var_pop(trip_duration), 4) AS r2, "
    "round(avg(abs(e)), 4) AS mae FROM (SELECT *, trip_duration - a - b * trip_distance AS e FROM features, ("
    "SELECT regr_slope(trip_duration, trip_distance) AS b, regr_intercept(trip_duration, trip_distance) AS a FROM features WHERE is_train) "
    "WHERE NOT is_train) GROUP BY trip_type",
    ("features",),
)
def holdout_evaluate(spark, sf_dir):
    rows = materialize(_rows(spark, sf_dir).select("trip_type", "is_train", "trip_duration", "trip_distance"), "rows")
    model = models.fit_model(rows.filter("is_train"), ONE, "linear_regressor")
    found = models.holdout_evaluate(model, rows.filter(~F.col("is_train")), ONE, ("trip_type",))
    return found.select("trip_type", "n", *[F.round(m, 4).alias(m) for m in ("rmse", "r2", "mae")])


@query(
    "chunked_fit_best",
    "SELECT chunk_id, n, rmse FROM (SELECT chunk_id, count(*) AS n, round(sqrt(avg((trip_duration - a - b * trip_distance) ** 2)), 4) AS rmse "
    "FROM (SELECT *, l_orderkey // 1000 AS chunk_id FROM features WHERE NOT is_train) JOIN ("
    "SELECT l_orderkey // 1000 AS chunk_id, regr_slope(trip_duration, trip_distance) AS b, regr_intercept(trip_duration, trip_distance) AS a "
    "FROM features WHERE is_train GROUP BY 1) USING (chunk_id) GROUP BY chunk_id) ORDER BY rmse, chunk_id LIMIT 1",
    ("features",),
)
def chunked_fit_best(spark, sf_dir):
    rows = _rows(spark, sf_dir).withColumn("chunk_id", F.floor(F.col("l_orderkey") / 1000))
    rows = materialize(rows.select("chunk_id", "is_train", "trip_duration", "trip_distance"), "rows")
    fits = models.chunked_least_squares(rows.filter("is_train"), DISTANCE_ONLY, "trip_duration")
    scored = models.score_by_chunk(rows.filter(~F.col("is_train")), fits, DISTANCE_ONLY)
    found = stats.regression_metrics(scored, "trip_duration", by=("chunk_id",))
    return stats.best_score(found.select("chunk_id", "n", F.round("rmse", 4).alias("rmse")))


CHUNK_LINES = (
    "(SELECT l_orderkey // 1000 AS chunk_id, regr_slope(trip_duration, trip_distance) AS b, regr_intercept(trip_duration, trip_distance) AS a "
    "FROM features WHERE is_train GROUP BY 1)"
)


@query(
    "kept_chunk_model",
    "SELECT trip_key, chunk_id, round(a + b * trip_distance, 4) AS prediction FROM features, (SELECT chunk_id, a, b FROM ("
    "SELECT chunk_id, any_value(a) AS a, any_value(b) AS b, sqrt(avg((trip_duration - a - b * trip_distance) ** 2)) AS rmse FROM ("
    f"SELECT *, l_orderkey // 1000 AS chunk_id FROM features WHERE NOT is_train) JOIN {CHUNK_LINES} USING (chunk_id) GROUP BY chunk_id) "
    "ORDER BY rmse, chunk_id LIMIT 1) WHERE NOT is_train",
    ("features",),
)
def kept_chunk_model(spark, sf_dir):
    """All hold-out trips with the prediction of the model that was kept: that of the chunk with the lowest error."""
    return _kept_predictions(spark, sf_dir, ONE).withColumn("prediction", F.round("prediction", 4))


@fitted_query("kept_chunk_model_full")
def kept_chunk_model_full(spark, sf_dir):
    """As ``kept_chunk_model``, with all nine features."""
    return _kept_predictions(spark, sf_dir, models.DURATION)


def _kept_predictions(spark, sf_dir, spec):
    path = work_path(spark, "chunk_models")
    rows = _rows(spark, sf_dir).withColumn("chunk_id", F.floor(F.col("l_orderkey") / 1000))
    rows = materialize(rows.select("trip_key", "chunk_id", "is_train", spec.target, *spec.features), "rows")
    train, test = rows.filter("is_train"), rows.filter(~F.col("is_train"))
    fits, columns = models.chunk_fits(train, spec)
    fits = materialize(fits, "fits")
    models.store_chunk_models(fits, models.chunk_scores(test, spec, fits, columns), columns, path)
    chunk, fit = models.kept_model(spark, path)
    scored = models.predict(fit.model(), models.model_input(test, spec, ("trip_key",)))
    return scored.select("trip_key", F.lit(chunk).cast("bigint").alias("chunk_id"), "prediction")


GROWN = "list_reduce(list_prepend({start}::DOUBLE, range(growth_step)::DOUBLE[]), lambda a, x: {rule})"


@query(
    "hyperparameter_growth",
    "SELECT chunk_id, growth_step, "
    + GROWN.format(start=100.0, rule="trunc(a * 1.15::DOUBLE)") + " AS n_estimators, "
    + GROWN.format(start=25.0, rule="least(trunc(a * 1.15::DOUBLE), 30)") + " AS max_depth, "
    + "round(" + GROWN.format(start=0.25, rule="CASE WHEN a * 1.15::DOUBLE > 1 THEN 0.5 ELSE a * 1.15::DOUBLE END") + ", 9) AS max_samples "
    # Patience is spent when the last improvement before a chunk is five chunks back, or ten, or ...
    "FROM (SELECT chunk_id, sum(coalesce(((rn - last) % 5 = 0)::INTEGER, 0)) OVER (ORDER BY chunk_id)::INTEGER AS growth_step FROM ("
    "SELECT chunk_id, rn, max(CASE WHEN improved THEN rn END) OVER (ORDER BY chunk_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last "
    "FROM improvements))",
    ("improvements",),
)
def hyperparameter_growth(spark, sf_dir):
    rows = materialize(sequence.growth_steps(views.scores(spark, sf_dir)), "steps")
    steps = rows.agg(F.max("growth_step")).first()[0] or 0
    series = models.hyperparameter_growth(models.FOREST, steps)
    names = ("n_estimators", "max_depth", "max_samples")
    grown = spark.createDataFrame(
        [(k, *(float(p[name]) for name in names)) for k, p in enumerate(series)],
        "growth_step int, " + ", ".join(f"{name} double" for name in names),
    )
    joined = rows.select("chunk_id", "growth_step").join(broadcast_if_small(grown), "growth_step")
    return joined.select("chunk_id", "growth_step", "n_estimators", "max_depth", F.round("max_samples", 9).alias("max_samples"))


@query(
    "batch_score",
    "SELECT trip_key, CASE WHEN trip_distance > 35.0 THEN 'long_trip' ELSE 'short_trip' END AS trip_type, "
    "'ok' AS score_status, true AS dropoff_fits, true AS eta_fits, true AS answer_fits FROM enriched",
    ("enriched",),
)
def batch_score(spark, sf_dir):
    """All trips as requests, each with the models of its trip type.

    Dropoff, arrival clock and answer are checked against the predicted values, which ``batch_predictions`` returns.
    """
    scored = _scored_requests(spark, sf_dir, ("short_trip", "long_trip"))
    return scored.select("trip_key", "trip_type", "score_status", *_score_checks())


TYPE_LINES = (
    "(SELECT trip_type, regr_slope(trip_duration, trip_distance) AS db, regr_intercept(trip_duration, trip_distance) AS da, "
    "regr_slope(trip_cost, trip_duration) AS cb, regr_intercept(trip_cost, trip_duration) AS ca FROM enriched GROUP BY trip_type)"
)


@query(
    "batch_score_values",
    "SELECT trip_key, trip_type, minutes AS trip_duration, round(ca + cb * minutes, 2) AS trip_cost, "
    "strftime(date_trunc('minute', tpep_pickup_datetime) + to_minutes(trunc(minutes)::INTEGER), '%H:%M') AS eta FROM ("
    f"SELECT e.*, ca, cb, round(da + db * trip_distance, 2) AS minutes FROM enriched e JOIN {TYPE_LINES} USING (trip_type))",
    ("enriched",),
)
def batch_score_values(spark, sf_dir):
    """All trips as requests, with one-feature models per trip type: durations by distance, costs by the predicted duration."""
    cost = models.ModelSpec("trip_cost", ("trip_duration",), ("trip_duration",), ())
    scored = _scored_requests(spark, sf_dir, ("short_trip", "long_trip"), ONE, cost)
    return scored.select("trip_key", "trip_type", "trip_duration", "trip_cost", "eta")


@fitted_query("batch_predictions")
def batch_predictions(spark, sf_dir):
    """All trips as requests, each with the models of its trip type: what is predicted, and the checks of it."""
    scored = _scored_requests(spark, sf_dir, ("short_trip", "long_trip"))
    predicted = ("trip_duration", "dropoff_ts", "trip_cost", "eta", "answer")
    return scored.select("trip_key", "trip_type", "score_status", *predicted, *_score_checks())


def _scored_requests(spark, sf_dir, kinds, duration_spec=models.DURATION, cost_spec=models.COST):
    """Trips as requests, scored by duration models and then cost models fed with their result; a type without trips has no models."""
    spec_columns = [*models.COST.features, "trip_cost", "trip_distance"]
    rows = views.enriched(spark, sf_dir).select("trip_key", "trip_type", "tpep_pickup_datetime", *spec_columns)
    rows = materialize(rows, "requests")
    present = {r[0] for r in rows.select("trip_type").distinct().collect()}
    duration, cost = {}, {}
    for kind in (k for k in kinds if k in present):
        part = rows.filter(F.col("trip_type") == kind)
        duration[kind] = [models.fit_model(part, duration_spec, "linear_regressor")]
        cost[kind] = [models.fit_model(part, cost_spec, "linear_regressor")]
    asked = rows.select(
        "trip_key", F.col("tpep_pickup_datetime").alias("pickup_ts"), "trip_distance", "haversine_centroid_distance"
    )
    return requests.batch_score(asked, duration, cost, views.HOLIDAYS)


def _score_checks():
    """Whether dropoff, arrival clock and answer fit the predicted values, or are null where nothing is predicted."""
    ok = F.col("score_status") == "ok"
    start = F.unix_micros(F.col("pickup_ts").cast("timestamp"))
    late = F.unix_micros(F.col("dropoff_ts").cast("timestamp"))
    arrives = F.date_format(F.timestamp_add("MINUTE", F.col("trip_duration").cast("int"), F.date_trunc("minute", "pickup_ts")), "HH:mm")
    names_both = F.contains("answer", F.col("eta")) & F.contains("answer", F.round("trip_cost", 2).cast("string"))
    nothing = F.col("trip_duration").isNull() & F.col("eta").isNull() & F.col("answer").isNull()
    return [
        F.when(ok, F.abs(late - start - F.col("trip_duration") * 6e7) < 1.5).otherwise(nothing).alias("dropoff_fits"),
        F.when(ok, F.col("eta") == arrives).otherwise(nothing).alias("eta_fits"),
        F.when(ok, names_both).otherwise(nothing).alias("answer_fits"),
    ]


@query(
    "latest_model",
    "SELECT '20240613' AS folder_name, count(*) AS n, round(avg(y + b * (trip_distance - x)), 4) AS mean_prediction FROM enriched, ("
    "SELECT avg(trip_duration) AS y, avg(trip_distance) AS x, regr_slope(trip_duration, trip_distance) AS b FROM enriched WHERE trip_type = 'short_trip')",
    ("enriched",),
)
def latest_model(spark, sf_dir):
    from farelight.plans.advisor import latest_model_root

    root = work_path(spark, "models")
    rows = materialize(views.enriched(spark, sf_dir).select("trip_type", "trip_duration", "trip_distance"), "rows")
    for day, part in (("20240527", rows), ("20240613", rows.filter("trip_type = 'short_trip'"))):
        models.fit_model(part, ONE, "linear_regressor").write().save(f"{root}/{day}/linear_regressor")
    newest = latest_model_root(spark, root)
    model = PipelineModel.load(f"{newest}/linear_regressor")
    scored = models.predict(model, models.model_input(rows, ONE))
    return scored.agg(
        F.lit(newest.rsplit("/", 1)[-1]).alias("folder_name"),
        F.count("*").alias("n"),
        F.round(F.avg("prediction"), 4).alias("mean_prediction"),
    )


@query(
    "prediction_cache",
    "SELECT trip_key, trip_distance * 2 + trip_duration AS prediction FROM kms",
    ("kms",),
)
def prediction_cache(spark, sf_dir):
    rule = SQLTransformer(statement="SELECT *, trip_distance * 2 + trip_duration AS prediction FROM __THIS__")
    rows = views.kms(spark, sf_dir).select("trip_key", "trip_distance", "trip_duration")
    return models.prediction_cache(rows, ["trip_distance", "trip_duration"], rule.transform, "prediction").select(
        "trip_key", "prediction"
    )


@query(
    "prediction_cache_runs",
    "SELECT trip_key, trip_distance * 2 + trip_duration AS prediction, n_scored FROM kms, (SELECT count(*) AS n_scored FROM ("
    "SELECT DISTINCT trip_distance, trip_duration FROM kms EXCEPT SELECT trip_distance, trip_duration FROM kms WHERE batch_id < 4))",
    ("kms",),
)
def prediction_cache_runs(spark, sf_dir):
    """Half of the trips, then all of them: the second run scores the vectors that the first one has not stored."""
    rule = SQLTransformer(statement="SELECT *, trip_distance * 2 + trip_duration AS prediction FROM __THIS__")
    rows = views.kms(spark, sf_dir).select("trip_key", "batch_id", "trip_distance", "trip_duration")
    table = models.ScoreTable(spark, work_path(spark, "scores"), "1", ["trip_distance", "trip_duration"], "prediction")
    table.scored(rows.filter("batch_id < 4"), rule.transform)
    found, n = table.scored(rows, rule.transform)
    return found.select("trip_key", "prediction", F.lit(n).cast("bigint").alias("n_scored"))


@query("stage_trips", "SELECT trip_key, count(*) AS n FROM trips GROUP BY trip_key", ("trips",))
def stage_trips(spark, sf_dir):
    rows = spark.read.parquet(views.stage_trips(spark, sf_dir))
    return rows.groupBy("trip_key").agg(F.count("*").alias("n"))
