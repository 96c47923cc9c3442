"""Feature stages, regressors, validation and scoring on MLlib."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import ElementwiseProduct, MinMaxScaler, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farelight.operators import stats
from farelight.session import broadcast_if_small, materialize, shared_root
from farelight.sources.tables import COST_COLUMNS, DURATION_COLUMNS, path_exists


@dataclass(frozen=True)
class ModelSpec:
    """A target, its ordered features, and which of them are scaled or one-hot encoded."""

    target: str
    features: tuple[str, ...]
    scaled: tuple[str, ...]
    categorical: tuple[str, ...]

    @property
    def passthrough(self) -> tuple[str, ...]:
        return tuple(f for f in self.features if f not in self.scaled and f not in self.categorical)


def _spec(columns: tuple[str, ...], scaled: list[int], categorical: list[int]) -> ModelSpec:
    target, *features = columns
    return ModelSpec(
        target, tuple(features), tuple(features[i] for i in scaled), tuple(features[i] for i in categorical)
    )


# Feature positions that are scaled and one-hot encoded.
DURATION = _spec(DURATION_COLUMNS, [0, 4, 5, 8], [1, 2, 3])
COST = _spec(COST_COLUMNS, [0, 7, 8, 9, 10, 15], [1, 2, 3, 4, 5, 6])

# Hyper-parameters, seeds and growth.
SEED = 42
FOLDS = 10
PATIENCE = 5
GROWTH = 1.15
FOREST = {"n_estimators": 100, "max_depth": 25, "max_samples": 0.25, "min_samples_split": 3, "min_samples_leaf": 5}
RIDGE = {"tol": 0.0001, "alpha": 0.1, "max_iter": 2000}
ELASTIC_NET = {"alpha": 0.1, "l1_ratio": 0.1, "max_iter": 2000}

# The deepest trees MLlib can fit.
DEEPEST = 30

REGRESSORS = ("linear_regressor", "randomforest_regressor", "voting_regressor")

MAX_LEVELS = 1000

#: Forests of a cross-validation that are fitted at the same time.
FITS_AT_ONCE = 4


def feature_vector(df: DataFrame, spec: ModelSpec, output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(spec.features), outputCol=output).transform(df)


def category_levels(df: DataFrame, columns: tuple[str, ...]) -> dict[str, list[int]]:
    """Distinct values per column, ascending. They become columns, so there may only be a few."""
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("int").alias("value")) for c in columns])
    found = df.select(F.inline(pairs)).distinct().limit(MAX_LEVELS + 1).collect()
    if len(found) > MAX_LEVELS:
        raise ValueError(f"{', '.join(columns)} have more than {MAX_LEVELS} values")
    return {c: sorted(row["value"] for row in found if row["name"] == c and row["value"] is not None) for c in columns}


def dummy_names(levels: dict[str, list[int]]) -> list[str]:
    return [f"{column}_is_{value}" for column, values in levels.items() for value in values[1:]]


def dummy_stage(levels: dict[str, list[int]]) -> SQLTransformer:
    """0/1 columns for every level but the first; an unknown level has zeros only."""
    dummies = [
        f"CAST({column} = {value} AS DOUBLE) AS {column}_is_{value}"
        for column, values in levels.items()
        for value in values[1:]
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(dummies)} FROM __THIS__")


def standard_scale_stages(columns: tuple[str, ...], n_rows: int, output: str = "scaled") -> list:
    """z-scores by the population deviation: the sample deviation, corrected by a factor."""
    correction = math.sqrt(n_rows / (n_rows - 1)) if n_rows > 1 else 1.0
    return [
        VectorAssembler(inputCols=list(columns), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_z", withMean=True, withStd=True),
        ElementwiseProduct(scalingVec=Vectors.dense([correction] * len(columns)), inputCol="_z", outputCol=output),
    ]


def minmax_scale_stages(columns: tuple[str, ...], output: str = "scaled") -> list:
    return [
        VectorAssembler(inputCols=list(columns), outputCol="_raw"),
        MinMaxScaler(inputCol="_raw", outputCol=output),
    ]


def linear_stages(train: DataFrame, spec: ModelSpec) -> list:
    levels = category_levels(train, spec.categorical)
    names = ["scaled", *dummy_names(levels), *spec.passthrough]
    return [
        *([dummy_stage(levels)] if dummy_names(levels) else []),
        *standard_scale_stages(spec.scaled, train.count()),
        VectorAssembler(inputCols=names, outputCol="features"),
    ]


def forest_stages(spec: ModelSpec) -> list:
    rest = [f for f in spec.features if f not in spec.scaled]
    return [*minmax_scale_stages(spec.scaled), VectorAssembler(inputCols=["scaled", *rest], outputCol="features")]


def linear_regression(label: str, output: str = "prediction", features: str = "features") -> LinearRegression:
    return LinearRegression(
        featuresCol=features, labelCol=label, predictionCol=output, regParam=0.0, solver="normal", standardization=False, tol=1e-9, maxIter=1000
    )


@dataclass(frozen=True)
class LabelStats:
    """Row count and population deviation of the target, which the penalties are scaled by."""

    n: int
    std: float


def label_stats(train: DataFrame, target: str) -> LabelStats:
    n, std = train.agg(F.count(target), F.stddev_pop(target)).first()
    return LabelStats(n, float(std or 1.0) or 1.0)


def ridge(label: str, about: LabelStats, output: str = "prediction", features: str = "features", params: dict = RIDGE):
    """Sum of squares + alpha * |w|^2.

    MLlib averages the squares and divides a squared penalty by the label's deviation.
    """
    return LinearRegression(
        featuresCol=features, labelCol=label, predictionCol=output, solver="normal", standardization=False,
        regParam=params["alpha"] * about.std / about.n, elasticNetParam=0.0, tol=params["tol"], maxIter=int(params["max_iter"]),
    )


def elastic_net(label: str, about: LabelStats, output: str = "prediction", features: str = "features", params: dict = ELASTIC_NET):
    """Mean of squares / 2 + alpha * (l1_ratio * |w| + (1 - l1_ratio) / 2 * |w|^2).

    The squared part is divided by the label's deviation here, the absolute part is not.
    """
    absolute = params["alpha"] * params["l1_ratio"]
    squared = params["alpha"] * (1 - params["l1_ratio"]) * about.std
    return LinearRegression(
        featuresCol=features, labelCol=label, predictionCol=output, solver="normal", standardization=False,
        regParam=absolute + squared, elasticNetParam=absolute / (absolute + squared), tol=1e-9, maxIter=int(params["max_iter"]),
    )


def random_forest(label: str, params: dict = FOREST, features: str = "features") -> RandomForestRegressor:
    """Five rows per leaf already imply the three rows a split needs. MLlib has no trees deeper than ``DEEPEST``."""
    if int(params["max_depth"]) > DEEPEST:
        raise ValueError(f"max_depth is {params['max_depth']}, at most {DEEPEST} can be fitted")
    return RandomForestRegressor(
        featuresCol=features, labelCol=label, predictionCol="prediction", seed=SEED, featureSubsetStrategy="all",
        numTrees=int(params["n_estimators"]), maxDepth=int(params["max_depth"]),
        subsamplingRate=params["max_samples"], minInstancesPerNode=int(params["min_samples_leaf"]),
        maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=10,
    )


def build_pipeline(spec: ModelSpec, params: dict | None = None) -> Pipeline:
    return Pipeline(stages=[*forest_stages(spec), random_forest(spec.target, params or FOREST)])


def model_input(df: DataFrame, spec: ModelSpec, extra: tuple[str, ...] = ()) -> DataFrame:
    """Target, features and carried columns; features as double."""
    return df.select(
        *extra, F.col(spec.target).cast("double").alias(spec.target), *[F.col(c).cast("double").alias(c) for c in spec.features]
    )


def _set_checkpoints(spark: SparkSession) -> None:
    """Deep forests cut the lineage of their node ids every few levels."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def fit_model(train: DataFrame, spec: ModelSpec, regressor: str, params: dict | None = None) -> PipelineModel:
    """One distributed fit on all training rows; linear models read them once, forests keep them for their passes."""
    if regressor not in REGRESSORS:
        raise ValueError(f"{regressor} is not one of {', '.join(REGRESSORS)}")
    if regressor in LINEAR_MEMBERS:
        return fit_linear(train, spec, regressor, params).model()
    _set_checkpoints(train.sparkSession)
    rows = model_input(train, spec).persist()
    try:
        return build_pipeline(spec, params).fit(rows)
    finally:
        rows.unpersist()


def predict(model: Transformer, rows: DataFrame, output: str = "prediction") -> DataFrame:
    """Rows with a prediction; the columns between are dropped."""
    columns = [c for c in rows.columns if c != output]
    return model.transform(rows).select(*columns, F.col("prediction").alias(output))


def holdout_evaluate(model: Transformer, test: DataFrame, spec: ModelSpec, by: tuple[str, ...] = ()) -> DataFrame:
    scored = predict(model, model_input(test, spec, by))
    return stats.regression_metrics(scored, spec.target, "prediction", by)


def residuals(model: Transformer, test: DataFrame, spec: ModelSpec) -> DataFrame:
    scored = predict(model, model_input(test, spec))
    return scored.withColumn("residual", F.col(spec.target) - F.col("prediction"))


def cross_validate(df: DataFrame, spec: ModelSpec, regressor: str, fold: str = "fold", params: dict | None = None) -> DataFrame:
    """Metrics per fold of the model fitted on all other folds.

    Linear models come from one pass over all rows. Forests share one kept input that is read once; ``FITS_AT_ONCE`` of
    them are fitted at the same time, each without the rows of its fold.
    """
    rows = model_input(df, spec, (fold,))
    if regressor in LINEAR_MEMBERS:
        prediction = F.lit(None).cast("double")
        for number, fitted in fold_linear_fits(rows, spec, regressor, fold, params).items():
            prediction = F.when(F.col(fold) == number, F.expr(fitted.expression())).otherwise(prediction)
        return stats.regression_metrics(rows.withColumn("prediction", prediction), spec.target, by=(fold,))
    spark = df.sparkSession
    _set_checkpoints(spark)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        numbers = sorted(row[0] for row in rows.select(fold).distinct().collect())

        def evaluate(number: int) -> list:
            model = build_pipeline(spec, params).fit(rows.filter(F.col(fold) != number))
            own = predict(model, rows.filter(F.col(fold) == number))
            return stats.regression_metrics(own, spec.target, by=(fold,)).collect()

        with ThreadPool(min(FITS_AT_ONCE, max(len(numbers), 1))) as pool:
            found = pool.map(inheritable_thread_target(spark)(evaluate), numbers)
    finally:
        rows.unpersist()
    schema = f"{fold} {df.schema[fold].dataType.simpleString()}, n bigint, rmse double, r2 double, mae double"
    return spark.createDataFrame([row for part in found for row in part], schema)


# Linear models from one pass -------------------------------------------------------------

# The members whose mean is the prediction.
LINEAR_MEMBERS = {"linear_regressor": ("linear",), "voting_regressor": ("linear", "ridge", "elastic_net")}


@dataclass(frozen=True)
class LinearFit:
    """Intercept and weights of each member over the design columns, in the units of the columns."""

    names: tuple[str, ...]
    columns: tuple[str, ...]
    members: dict[str, tuple[float, np.ndarray]]

    def member_expression(self, member: str) -> str:
        intercept, weights = self.members[member]
        terms = [f"{w!r}D * {c}" for w, c in zip(map(float, weights), self.columns, strict=True) if w]
        return " + ".join([f"{float(intercept)!r}D", *terms])

    def expression(self) -> str:
        parts = [f"({self.member_expression(m)})" for m in self.members]
        return f"({' + '.join(parts)}) / {len(parts)}D"

    def model(self) -> PipelineModel:
        """A model that can be stored: one expression, without a vector of features."""
        return PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, {self.expression()} AS prediction FROM __THIS__")])


def design_columns(spec: ModelSpec, levels: dict[str, list[int]]) -> dict[str, str]:
    """Name and SQL of each column: scaled numbers first, 0/1 columns for every level but the first, other numbers."""
    dummies = {f"{c}_is_{v}": f"(CASE WHEN {c} = {v} THEN 1D ELSE 0D END)" for c, values in levels.items() for v in values[1:]}
    return {**{c: c for c in spec.scaled}, **dummies, **{c: c for c in spec.passthrough}}


def _elastic_weights(inner: np.ndarray, cross: np.ndarray, alpha: float, l1_ratio: float, sweeps: int) -> np.ndarray:
    """Coordinate descent on the moments: half the mean square plus the penalty."""
    weights = np.zeros(len(cross))
    for _ in range(sweeps):
        before = weights.copy()
        for j in range(len(weights)):
            rest = cross[j] - inner[j] @ weights + inner[j, j] * weights[j]
            size = inner[j, j] + alpha * (1 - l1_ratio)
            weights[j] = math.copysign(max(abs(rest) - alpha * l1_ratio, 0.0), rest) / size if size else 0.0
        if np.abs(weights - before).max(initial=0.0) <= 1e-12 * (1 + np.abs(weights).max(initial=0.0)):
            break
    return weights


def solve_linear(gram: np.ndarray, n_scaled: int, regressor: str, params: dict | None = None) -> dict[str, tuple[float, np.ndarray]]:
    """Members from the moments of [1 X y]; the first ``n_scaled`` columns are penalised as z-scores."""
    params = params or {"ridge": RIDGE, "elastic_net": ELASTIC_NET}
    n, width = gram[0, 0], len(gram) - 2
    mean = gram[0, 1:] / n
    centred = gram[1:, 1:] - n * np.outer(mean, mean)
    spread = np.ones(width)
    spread[:n_scaled] = np.sqrt(np.maximum(np.diag(centred)[:n_scaled], 0) / n)
    spread[spread == 0] = 1.0
    inner, cross = centred[:-1, :-1] / np.outer(spread, spread), centred[:-1, -1] / spread
    found = {}
    for member in LINEAR_MEMBERS[regressor]:
        if member == "elastic_net":
            about = params["elastic_net"]
            weights = _elastic_weights(inner / n, cross / n, about["alpha"], about["l1_ratio"], int(about["max_iter"]))
        else:
            alpha = params["ridge"]["alpha"] if member == "ridge" else 0.0
            weights = np.linalg.lstsq(inner + alpha * np.eye(width), cross, rcond=1e-12)[0]
        weights = weights / spread
        found[member] = (float(mean[-1] - mean[:-1] @ weights), weights)
    return found


def _design_moments(rows: DataFrame, spec: ModelSpec, by: str) -> tuple[dict[str, str], dict[int, np.ndarray]]:
    """The design columns and the moments of [1 X y] per group, from one pass over rows without nulls."""
    rows = rows.dropna(subset=[spec.target, *spec.features])
    columns = design_columns(spec, category_levels(rows, spec.categorical))
    designed = rows.select(by, *[F.expr(sql).cast("double").alias(f"x{k}") for k, sql in enumerate(columns.values())], spec.target)
    width = len(columns) + 2
    grams: dict[int, np.ndarray] = {}
    for row in _moments(designed, [f"x{k}" for k in range(len(columns))], spec.target, by).collect():
        grams.setdefault(row[by], np.zeros(width * width))[row["position"]] = row["value"]
    return columns, {key: gram.reshape(width, width) for key, gram in grams.items()}


def fit_linear(train: DataFrame, spec: ModelSpec, regressor: str, params: dict | None = None) -> LinearFit:
    rows = model_input(train, spec).withColumn("_all", F.lit(0).cast("bigint"))
    columns, grams = _design_moments(rows, spec, "_all")
    if not grams:
        raise ValueError("no rows to fit on")
    members = solve_linear(grams[0], len(spec.scaled), regressor, params)
    return LinearFit(tuple(columns), tuple(columns.values()), members)


def fold_linear_fits(rows: DataFrame, spec: ModelSpec, regressor: str, fold: str, params: dict | None = None) -> dict[int, LinearFit]:
    """For every fold the fit of all others: the moments of all rows less its own."""
    columns, grams = _design_moments(rows.withColumn(fold, F.col(fold).cast("bigint")), spec, fold)
    total = sum(grams.values())
    fits = {}
    for number, gram in grams.items():
        if (total - gram)[0, 0] > 0:
            members = solve_linear(total - gram, len(spec.scaled), regressor, params)
            fits[number] = LinearFit(tuple(columns), tuple(columns.values()), members)
    return fits


# One least-squares fit per chunk ---------------------------------------------------------


def _moments(rows: DataFrame, features: list[str], label: str, by: str) -> DataFrame:
    """(by, position, value): entries of [1 X y]'[1 X y], summed per group.

    Each task adds up its rows per group; the small matrices are then summed by Spark.
    """
    width = len(features) + 2

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            keys = batch[by].to_numpy()
            matrix = np.column_stack([np.ones(len(batch)), batch[features].to_numpy(float), batch[label].to_numpy(float)])
            for key in np.unique(keys):
                part = matrix[keys == key]
                sums[key] = sums.get(key, 0.0) + part.T @ part
        for key, gram in sums.items():
            yield pd.DataFrame({by: key, "position": np.arange(width * width), "value": gram.ravel()})

    partials = rows.select(by, *features, label).mapInPandas(partial, f"{by} bigint, position int, value double")
    return partials.groupBy(by, "position").agg(F.sum("value").alias("value"))


def _solve(moments: DataFrame, n_features: int, by: str, alpha: float) -> DataFrame:
    """Least squares per group from its summed moments, a fixed-size matrix each."""
    width = n_features + 2

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        gram = np.zeros(width * width)
        gram[group["position"].to_numpy()] = group["value"].to_numpy()
        gram = gram.reshape(width, width)
        n = gram[0, 0]
        mean = gram[0, 1:] / n
        centred = gram[1:, 1:] - n * np.outer(mean, mean)
        inner, cross = centred[:-1, :-1] + alpha * np.eye(width - 2), centred[:-1, -1]
        weights = np.linalg.lstsq(inner, cross, rcond=1e-12)[0]
        intercept = mean[-1] - mean[:-1] @ weights
        return pd.DataFrame(
            {by: [group[by].iloc[0]], "n": [int(n)], "intercept": [float(intercept)], "coefficients": [weights.tolist()]}
        )

    return moments.groupBy(by).applyInPandas(solve, f"{by} bigint, n bigint, intercept double, coefficients array<double>")


def chunked_least_squares(rows: DataFrame, features: list[str], label: str, by: str = "chunk_id", alpha: float = 0.0) -> DataFrame:
    """(by, n, intercept, coefficients): least squares per group, minimum norm when singular.

    ``alpha`` adds a ridge penalty on everything but the intercept.
    """
    return _solve(_moments(rows, features, label, by), len(features), by, alpha)


def fold_least_squares(rows: DataFrame, features: list[str], label: str, fold: str = "fold", alpha: float = 0.0) -> DataFrame:
    """The fit of every fold's complement from one pass: the moments of all rows less its own.

    Folds without rows of their own have no line here.
    """
    moments = _moments(rows, features, label, fold)
    total = F.sum("value").over(W.partitionBy("position"))
    rest = moments.withColumn("value", total - F.col("value"))
    return _solve(rest, len(features), fold, alpha)


def score_by_chunk(rows: DataFrame, fits: DataFrame, features: list[str], by: str = "chunk_id") -> DataFrame:
    """Rows with the prediction of their own group's fit; null for a group without one."""
    values = F.array(*[F.col(f).cast("double") for f in features])
    terms = F.zip_with(values, F.col("coefficients"), lambda x, w: x * w)
    prediction = F.col("intercept") + F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    joined = rows.join(broadcast_if_small(fits.select(by, "intercept", "coefficients")), by, "left")
    return joined.withColumn("prediction", prediction).drop("intercept", "coefficients")


def chunk_fits(train: DataFrame, spec: ModelSpec, by: str = "chunk_id") -> tuple[DataFrame, dict[str, str]]:
    """Least squares per chunk over all features, as ``chunked_least_squares``, and the SQL of the design columns by name."""
    rows = model_input(train.withColumn(by, F.col(by).cast("bigint")), spec, (by,)).dropna(subset=[spec.target, *spec.features])
    columns = design_columns(spec, category_levels(rows, spec.categorical))
    names = [f"x{k}" for k in range(len(columns))]
    designed = rows.select(by, *[F.expr(sql).cast("double").alias(n) for n, sql in zip(names, columns.values(), strict=True)], spec.target)
    return chunked_least_squares(designed, names, spec.target, by), columns


def chunk_scores(test: DataFrame, spec: ModelSpec, fits: DataFrame, columns: dict[str, str], by: str = "chunk_id") -> DataFrame:
    """Metrics of each chunk's fit on the chunk's own hold-out rows."""
    rows = model_input(test.withColumn(by, F.col(by).cast("bigint")), spec, (by,)).dropna(subset=[spec.target, *spec.features])
    names = [f"x{k}" for k in range(len(columns))]
    designed = rows.select("*", *[F.expr(sql).cast("double").alias(n) for n, sql in zip(names, columns.values(), strict=True)])
    return stats.regression_metrics(score_by_chunk(designed, fits, names, by), spec.target, by=(by,))


def store_chunk_models(fits: DataFrame, scores: DataFrame, columns: dict[str, str], path: str, by: str = "chunk_id") -> None:
    """Write the model table: a row per chunk with its coefficients, its design columns and its hold-out metrics.

    A chunk without hold-out rows has no score and is not a candidate.
    """
    rows = fits.join(broadcast_if_small(scores.select(by, "rmse", "r2", "mae")), by)
    names, sql = (F.array(*[F.lit(x) for x in part]) for part in (columns.keys(), columns.values()))
    rows.withColumns({"names": names, "columns": sql}).write.mode("overwrite").parquet(path)


def kept_model(spark: SparkSession, path: str, by: str = "chunk_id") -> tuple[int, LinearFit]:
    """The chunk with the lowest error in a model table, the earliest of equals, and its model as one expression."""
    table = spark.read.parquet(path).filter(F.col("rmse").isNotNull() & ~F.isnan("rmse"))
    best = stats.best_score(table, by).first()
    if best is None or best[by] is None:
        raise ValueError("no chunk of the model table has a score")
    return best[by], LinearFit(tuple(best["names"]), tuple(best["columns"]), {"linear": (best["intercept"], np.array(best["coefficients"]))})


# Hyper-parameters ------------------------------------------------------------------------


@dataclass(frozen=True)
class GrowthRule:
    """How a hyper-parameter grows: whole numbers drop the fraction; beyond ``top`` it becomes ``beyond``, beyond all doubles infinite."""

    whole: bool = False
    top: float = math.inf
    beyond: float = math.inf

    def next(self, value: float, factor: float) -> float:
        larger = value * factor
        if larger > self.top:
            return self.beyond
        return math.trunc(larger) if self.whole and math.isfinite(larger) else larger


# A share of the rows starts again from a half beyond all rows; depth and the share of the absolute penalty stay at
# what can be fitted.
GROWTH_RULES = {
    "n_estimators": GrowthRule(whole=True),
    "max_depth": GrowthRule(whole=True, top=DEEPEST, beyond=DEEPEST),
    "max_samples": GrowthRule(top=1.0, beyond=0.5),
    "min_samples_split": GrowthRule(whole=True),
    "min_samples_leaf": GrowthRule(whole=True),
    "tol": GrowthRule(),
    "alpha": GrowthRule(),
    "l1_ratio": GrowthRule(top=1.0, beyond=1.0),
    "max_iter": GrowthRule(whole=True),
}


def grow(params: dict, factor: float = GROWTH) -> dict:
    """The next parameters after a run without improvement; nested parameters grow by their own names."""
    return {
        name: grow(value, factor) if isinstance(value, dict) else GROWTH_RULES[name].next(value, factor)
        for name, value in params.items()
    }


def start_params(regressor: str) -> dict:
    """What a regressor is fitted with before any growth; a plain linear model has nothing to grow."""
    return {"randomforest_regressor": FOREST, "voting_regressor": {"ridge": RIDGE, "elastic_net": ELASTIC_NET}}.get(regressor, {})


def hyperparameter_growth(params: dict, steps: int, factor: float = GROWTH) -> list[dict]:
    """The start parameters and ``steps`` grown ones, checked before any fit."""
    series = [dict(params)]
    for _ in range(steps):
        series.append(grow(series[-1], factor))
    for entry in series:
        if not 0.0 < entry.get("max_samples", 1.0) <= 1.0:
            raise ValueError(f"max_samples is out of bounds: {entry['max_samples']}")
    return series


# Ensembles -------------------------------------------------------------------------------


def ensemble_mean(rows: DataFrame, models: list[Transformer], output: str) -> DataFrame:
    """Mean prediction of several models, rounded to cents or hundredths of a minute."""
    names = [f"_member_{i}" for i in range(len(models))]
    for name, model in zip(names, models):
        rows = predict(model, rows, name)
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return rows.withColumn(output, F.round(total / len(models), 2)).drop(*names)


def prediction_cache(rows: DataFrame, features: list[str], score, output: str) -> DataFrame:
    """Score each distinct feature vector once and hand the result to all rows that have it.

    The scores are stored: they are computed once, and a vector many rows share can be split.
    """
    distinct = rows.select(*features).distinct()
    scored = materialize(score(distinct).select(*[F.col(f).alias(f"_k_{f}") for f in features], output), "scores")
    same = [F.col(f).eqNullSafe(F.col(f"_k_{f}")) for f in features]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return rows.join(scored, condition, "left").drop(*[f"_k_{f}" for f in features])


class ScoreTable:
    """Predictions of one version of a model by feature vector, kept from run to run.

    A version is a directory; a run appends the vectors it scored. Vectors are told apart by value, nulls included.
    """

    def __init__(self, spark: SparkSession, path: str, version: str, features: list[str], output: str):
        self.spark, self.folder, self.features, self.output = spark, f"{path.rstrip('/')}/version={version}", list(features), output

    def stored(self) -> DataFrame | None:
        return self.spark.read.parquet(self.folder) if path_exists(self.spark, self.folder) else None

    def _same(self, left: DataFrame, right: DataFrame):
        """A hash of the vector finds it, the values decide."""
        condition = left["_vector"] == right["_vector"]
        for f in self.features:
            condition = condition & left[f].eqNullSafe(right[f"_k_{f}"])
        return condition

    def _hashed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_vector", F.xxhash64(*self.features))

    def scored(self, rows: DataFrame, score) -> tuple[DataFrame, int]:
        """Rows with the prediction of their vector, and how many vectors had to be scored for it.

        ``score`` maps distinct vectors to vectors with a prediction. What it returns is stored before it is used, so a run that breaks
        off leaves scores that the next one finds.
        """
        distinct = self._hashed(rows.select(*self.features).distinct())
        known = self.stored()
        if known is not None:
            distinct = distinct.join(known, self._same(distinct, known), "left_anti")
        unseen = materialize(distinct.select(*self.features), "unseen")
        n = unseen.count()
        if n or known is None:
            found = self._hashed(score(unseen))
            keys = [F.col(f).alias(f"_k_{f}") for f in self.features]
            found.select("_vector", *keys, self.output).write.mode("append").parquet(self.folder)
        hashed, known = self._hashed(rows), self.stored()
        return hashed.join(known, self._same(hashed, known), "left").select(*rows.columns, self.output), n
