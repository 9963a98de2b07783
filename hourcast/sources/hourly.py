"""The hourly table as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.functions.time import parse_hour

# Column order of the files; the header line is skipped, not read.
HOURLY_CSV = "account string, hour string, day_of_week int, metric string, value bigint"
SINGLE_ACCOUNT_CSV = "hour string, week int, day_of_week int, metric string, value bigint"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    rows = spark.read.schema(schema).csv(
        path, header=True, ignoreLeadingWhiteSpace=True, mode="FAILFAST"
    )
    return rows.withColumn("hour", parse_hour("hour"))


def read_hourly_csv(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files below `path`: account, hour, day_of_week, metric, value."""
    return _read(spark, path, HOURLY_CSV)


def read_single_account_csv(spark: SparkSession, path: str, account: str) -> DataFrame:
    """The layout without account column; `week` is not used."""
    return _read(spark, path, SINGLE_ACCOUNT_CSV).select(
        F.lit(account).alias("account"), "hour", "day_of_week", "metric", "value"
    )


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
