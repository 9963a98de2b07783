"""Shared by the operators: reading columns, splitting words, shared folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = "[\\x20\\x09-\\x0D]+"
NOT_ALPHANUMERIC = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def split_words(text: Column, separator: str) -> Column:
    """The non-empty pieces between runs of separators."""
    return F.array_remove(F.split(text, separator), "")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Written below the shared folder and read back: a lost executor costs no recomputation."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet a condition on computed columns, each computed once.

    Without the row number Spark would move the condition below the projections and
    copy their expressions into it, again for every use.
    """
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    return numbered.filter(condition & (F.col("_row") >= 0)).drop("_row")
