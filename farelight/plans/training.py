"""Training: enriched trips -> model, per-chunk scores.

    python -m farelight.plans.training --table DIR --target duration --trip-type short_trip \
        --regressor linear_regressor --models DIR
"""

from __future__ import annotations

import argparse
import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelight.operators import models, sequence, stats
from farelight.session import build_session, materialize, release_kept
from farelight.sources.checkpoints import scores_sink

SPECS = {"duration": models.DURATION, "cost": models.COST}


def chunked_input(spark: SparkSession, path: str, spec: models.ModelSpec, trip_type: str, size: int) -> DataFrame:
    """Trimmed training rows with chunk and split.

    Rows are chunked in file order, trimmed to the quantile bounds of their chunk, and
    assigned to train or test by a hash of their values.
    """
    scan = spark.read.parquet(path)
    rows = scan.filter(F.col("trip_type") == trip_type) if "trip_type" in scan.columns else scan
    # Positions count within the files read, and a trip type is a directory: nothing else is in them.
    rows = sequence.row_index_chunks(rows.select(spec.target, *spec.features), size)
    return stats.quantile_trim(rows, spec.target, ("chunk_id",))


def run(
    spark: SparkSession,
    table: str,
    target: str,
    trip_type: str,
    regressor: str,
    output: str,
    chunk_size: int = 500_000,
    train_fraction: float = 0.2,
    params: dict | None = None,
    folds: int = 0,
    tuning: bool = False,
) -> DataFrame:
    """Fit on all training rows, evaluate per chunk, store model and scores; return the scores.

    With ``tuning`` a regressor that has hyper-parameters is fitted again with grown ones, as often as patience ran out
    over the chunks of the first fit; the model with the lowest error on all test rows is stored and scored.
    """
    spec = SPECS[target]
    if regressor not in models.REGRESSORS:
        raise ValueError(f"{regressor} is not one of {', '.join(models.REGRESSORS)}")
    rows = chunked_input(spark, table, spec, trip_type, chunk_size)
    rows = materialize(sequence.hash_split(rows, ["row_index"], train_fraction), "training")
    train, test = rows.filter("is_train"), rows.filter(~F.col("is_train"))
    if train.isEmpty() or test.isEmpty():
        raise ValueError("train or test rows are empty")
    model = models.fit_model(train, spec, regressor, params)
    if tuning and regressor != "linear_regressor":
        first = materialize(models.holdout_evaluate(model, test, spec, ("chunk_id",)).select("chunk_id", "rmse"), "first_fit")
        steps = sequence.growth_steps(first, wrap=models.PATIENCE).agg(F.max("growth_step")).first()[0]
        model, tried = tune(train, test, spec, regressor, params or models.start_params(regressor), steps)
        tried.write.mode("overwrite").json(f"{output}/{target}/{trip_type}/metadata/{regressor}_tuning")
    model_path = f"{output}/{target}/{trip_type}/models/{regressor}"
    model.write().overwrite().save(model_path)
    # One row per chunk from here on: the history is computed without predicting again.
    scored = materialize(models.holdout_evaluate(model, test, spec, ("chunk_id",)), "evaluated")
    history = sequence.patience_counter(
        scored.select("chunk_id", "rmse", "r2", "mae"), wrap=None if regressor == "linear_regressor" else models.PATIENCE
    ).withColumn("model_path", F.lit(model_path))
    history = materialize(history, "scores")
    scores_sink(history, f"{output}/{target}/{trip_type}/metadata/{regressor}_scores", "overwrite")
    if folds:
        folded = sequence.kfold_assign(train, ["row_index"], folds)
        models.cross_validate(folded, spec, regressor, params=params).write.mode("overwrite").json(
            f"{output}/{target}/{trip_type}/metadata/{regressor}_folds"
        )
    residual = models.residuals(model, test, spec)
    stats.residual_histogram(residual).write.mode("overwrite").json(
        f"{output}/{target}/{trip_type}/residuals/{regressor}_histogram"
    )
    release_kept()
    return history


def tune(
    train: DataFrame, test: DataFrame, spec: models.ModelSpec, regressor: str, params: dict, steps: int
) -> tuple[PipelineModel, DataFrame]:
    """Fit the grown parameter series and keep the model with the lowest test error.

    The rows name the parameters each model was fitted with, its error, and which one was kept.
    """
    best, rows = None, []
    for step, entry in enumerate(models.hyperparameter_growth(params, steps)):
        model = models.fit_model(train, spec, regressor, entry)
        rmse = models.holdout_evaluate(model, test, spec).first()["rmse"]
        rows.append((step, json.dumps(entry), rmse))
        if best is None or rmse < best[0]:
            best = (rmse, model, step)
    rows = [(*row, row[0] == best[2]) for row in rows]
    return best[1], train.sparkSession.createDataFrame(rows, "step int, params string, rmse double, kept boolean")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--table", required=True)
    parser.add_argument("--target", choices=sorted(SPECS), required=True)
    parser.add_argument("--trip-type", choices=["short_trip", "long_trip"], default="short_trip")
    parser.add_argument("--regressor", choices=models.REGRESSORS, default="linear_regressor")
    parser.add_argument("--models", required=True)
    parser.add_argument("--chunk-size", type=int, default=500_000)
    parser.add_argument("--train-fraction", type=float, default=0.2)
    parser.add_argument("--folds", type=int, default=0)
    parser.add_argument("--tuning", action="store_true")
    args = parser.parse_args(argv)
    spark = build_session("trip-training")
    run(
        spark, args.table, args.target, args.trip_type, args.regressor, args.models,
        args.chunk_size, args.train_fraction, folds=args.folds, tuning=args.tuning,
    ).orderBy("chunk_id").show(100, False)


if __name__ == "__main__":
    main()
