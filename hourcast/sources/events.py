"""Raw event tables, brought to the column names the operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.functions.time import as_column


def read_table(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table, or files when `name` is a path."""
    return spark.read.format(fmt).load(name) if "/" in name else spark.table(name)


def _calendar(df: DataFrame) -> list[Column]:
    """`year` and `month` are kept where the table is partitioned by them."""
    return [F.col(c) for c in ("year", "month") if c in df.columns]


def signalling_events(
    df: DataFrame,
    account: Column | str = "accountid",
    ts: Column | str = "stoptime",
    op: Column | str = "firstopcodedesc",
) -> DataFrame:
    """account, ts, op."""
    return df.select(
        as_column(account).cast("string").alias("account"),
        as_column(ts).cast("timestamp_ntz").alias("ts"),
        as_column(op).alias("op"),
        *_calendar(df),
    )


def session_events(
    df: DataFrame,
    account: Column | str = "accountid",
    ts: Column | str = "stoptime",
    code: Column | str = "causecode",
    rectype: Column | str = "recordtype",
    subscriber: Column | str = "imsi",
) -> DataFrame:
    """account, ts, code, rectype, subscriber."""
    return df.select(
        as_column(account).cast("string").alias("account"),
        as_column(ts).cast("timestamp_ntz").alias("ts"),
        as_column(code).cast("int").alias("code"),
        as_column(rectype).cast("int").alias("rectype"),
        as_column(subscriber).cast("string").alias("subscriber"),
        *_calendar(df),
    )
