"""Forecast errors.

Forecasts are taken apart into cells, which compiled code does several times
faster than functions over whole arrays. The cells never leave their task: each
group folds into one (sum, count) pair per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.functions.errors import log_square_cell, smape_cell


def _cells(forecasts: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per forecast hour: `by`, _y, _yhat."""
    return forecasts.select(*by, "yhat", F.posexplode("y").alias("_i", "_y")).select(
        *by, "_y", F.get("yhat", F.col("_i")).alias("_yhat")
    )


def smape(forecasts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """200 * mean(|y - yhat| / (|y| + |yhat|)) over all cells, with the count `n`."""
    error = smape_cell(F.col("_y"), F.col("_yhat"))
    return (
        _cells(forecasts, by)
        .groupBy(*by)
        .agg((F.lit(200.0) * F.avg(error)).alias("smape"), F.count("*").alias("n"))
    )


def score_by_account(forecasts: DataFrame, accounts: DataFrame) -> DataFrame:
    """sMAPE of every account, with its id and, if the dimension has one, name."""
    names = [c for c in ("account", "accountname") if c in accounts.columns]
    scores = smape(forecasts, ["account_int"])
    return scores.join(accounts.select("account_int", *names), "account_int", "left")


def log_l2_loss(forecasts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Half the sum of squared log residuals, the loss the forecaster minimises."""
    error = log_square_cell(F.col("_y"), F.col("_yhat"))
    return (
        _cells(forecasts, by)
        .groupBy(*by)
        .agg((F.sum(error) / 2).alias("loss"), F.count("*").alias("n"))
    )
