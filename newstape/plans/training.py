"""Train-and-evaluate and predict jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from newstape.errors import DataPreparationError
from newstape.operators import metrics, model as M, reports
from newstape.operators.split import stratified_split, time_split
from newstape.session import fresh_path
from newstape.sources import sinks


@dataclass
class TrainingResult:
    model: M.DirectionModel
    predictions: DataFrame
    metrics: DataFrame
    importances: DataFrame


def train_and_evaluate(
    spark: SparkSession,
    dataset: DataFrame,
    folder: str | None = None,
    kind: str = "forest",
    params: Mapping[str, Any] | None = None,
    split: str = "stratified",
    first_test_day: dt.date | None = None,
) -> TrainingResult:
    """Split, fit, predict the test rows, measure; with a folder also save everything.

    The labelled rows are written to the work folder first, and their split after them:
    both read them several times, and the features are computed once.
    """
    features = M.feature_columns(dataset)
    landed = fresh_path(spark, "labelled")
    dataset.where(F.col(M.LABEL).isNotNull()).write.parquet(landed)
    rows = spark.read.schema(dataset.schema).parquet(landed)
    if rows.isEmpty():
        raise DataPreparationError("no labelled rows remain after dropping missing labels")
    if split == "time":
        if first_test_day is None:
            raise ValueError("a time split needs first_test_day")
        marked = time_split(rows, first_test_day)
    else:
        marked = stratified_split(rows)
    path = fresh_path(spark, "split")
    marked.write.parquet(path)
    marked = spark.read.parquet(path)
    train_rows, test_rows = marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")

    fitted = M.train(train_rows, features, kind=kind, params=params)
    sizes = marked.groupBy("is_test").agg(F.count(F.lit(1)).alias("n")).collect()
    fitted.metadata |= {("test_rows" if r["is_test"] else "train_rows"): r["n"] for r in sizes}
    predictions = fitted.predict(test_rows)
    measured = metrics.metric_rows(predictions)
    importances = fitted.importances(spark)
    if folder is not None:
        fitted.save(spark, f"{folder}/model")
        sinks.write_report(measured, f"{folder}/metrics", "json")
        sinks.write_report(importances, f"{folder}/feature_importance", "csv")
    return TrainingResult(fitted, predictions, measured, importances)


def predict_job(
    spark: SparkSession, model_path: str, rows: DataFrame, output: str, fmt: str = "parquet"
) -> tuple[DataFrame, DataFrame]:
    """Load a model, predict, write, and summarise what was written."""
    fitted = M.load_model(spark, model_path)
    predicted = fitted.predict(rows)
    path = sinks.write_predictions(predicted, output, fmt)
    written = sinks.read_written(spark, path, predicted.schema, fmt)
    return written, reports.prediction_summary(written)
