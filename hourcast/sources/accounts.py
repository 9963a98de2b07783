"""The account dictionary and the dimension made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.operators.keys import dense_ids

ACCOUNTS_CSV = "account string, accountname string"


def read_accounts_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV of account id and name with a header; ids stay text."""
    return spark.read.schema(ACCOUNTS_CSV).csv(path, header=True, enforceSchema=True)


def account_dimension(accounts: DataFrame) -> DataFrame:
    """Add `account_int`, numbered from 0 in id order; a repeated id is an error."""
    ids = dense_ids(accounts, "account", "account_int")
    if "accountname" not in accounts.columns:
        return ids
    repeated = F.raise_error(F.concat(F.lit("account listed twice: "), F.col("account")))
    names = (
        accounts.groupBy("account")
        .agg(F.count("*").alias("_n"), F.first("accountname").alias("accountname"))
        .select(
            "account",
            F.when(F.col("_n") > 1, repeated).otherwise(F.col("accountname")).alias("accountname"),
        )
    )
    return ids.join(names, "account")


def write_accounts(accounts: DataFrame, path: str) -> None:
    """Store the dimension, so that every later run uses the same ids."""
    accounts.write.mode("overwrite").parquet(path)


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
