"""Train and store a forecaster; load it, forecast and score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.config import METRIC_IDS, ForecastConfig
from hourcast.operators.embeddings import embedding_topk
from hourcast.operators.keys import Labels, decode_keys, n_labels, with_labels
from hourcast.operators.metrics import score_by_account
from hourcast.operators.model import Model, forecast, load_model, save_model
from hourcast.operators.training import fit_forecaster
from hourcast.plans.build import Range, latest_windows

# Weekday labels by model id.
WEEKDAYS = {
    "Monday": 0,
    "Tuesday": 1,
    "Wednesday": 2,
    "Thursday": 3,
    "Friday": 4,
    "Saturday": 5,
    "Sunday": 6,
}


def train_and_store(
    train: DataFrame,
    valid: DataFrame,
    accounts: DataFrame,
    path: str,
    name: str,
    run: int = 0,
    config: ForecastConfig = ForecastConfig(),
    metrics: Labels = METRIC_IDS,
    seed: int = 0,
    run_path: str | None = None,
) -> tuple[Model, DataFrame]:
    """Fit, write the parameters, and return the model with its history.

    Called again with the same `run_path`, a run that was cut off goes on.
    """
    model, history = fit_forecaster(
        train, valid, accounts, n_labels(metrics), config, seed, path=run_path
    )
    save_model(model, path, name, run)
    return model, history


def neighbour_report(
    spark: SparkSession, model: Model, metrics: Labels = METRIC_IDS, k: int = 3
) -> DataFrame:
    """Nearest metrics of each metric and nearest weekdays of each weekday."""
    reports = []
    for embedding, labels in (("metric", metrics), ("weekday", WEEKDAYS)):
        found = embedding_topk(model.embedding(spark, embedding), k).select(
            F.lit(embedding).alias("embedding"), "rank", "cosine", "id", "neighbour"
        )
        for number, label in (("id", "label"), ("neighbour", "neighbour")):
            # A table of labels names its own columns.
            ids = ("metric_int", "metric") if isinstance(labels, DataFrame) else ("_id", "_label")
            numbered = found.withColumn(ids[0], F.col(number).cast("int")).drop(number)
            found = with_labels(numbered, labels, *ids).drop(ids[0]).withColumnRenamed(ids[1], label)
        reports.append(found.select("embedding", "label", "rank", "neighbour", "cosine"))
    return reports[0].unionByName(reports[1])


def forecast_stored(
    hourly: DataFrame,
    accounts: DataFrame,
    grid: Range,
    path: str,
    name: str,
    run: int = 0,
    metrics: Labels = METRIC_IDS,
) -> DataFrame:
    """The hours after the grid by a stored model, with account and metric labels."""
    model = load_model(hourly.sparkSession, path, name, run)
    latest = latest_windows(hourly, accounts, grid, model.config, metrics)
    return decode_keys(forecast(latest, model, labelled=False), accounts, metrics)


def score_stored(
    windows: DataFrame, accounts: DataFrame, path: str, name: str, run: int = 0
) -> DataFrame:
    """sMAPE per account of a stored model on labelled windows."""
    model = load_model(windows.sparkSession, path, name, run)
    return score_by_account(forecast(windows, model), accounts)
