"""Dimensions: text keys to dense integer ids and back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourcast.session import checkpoint_dir

# Keys drawn to place the range boundaries, and the largest number of ranges.
SAMPLE_KEYS = 4096
RANGES = 512


def number_within(df: DataFrame, bucket: str, order: list[str], into: str) -> DataFrame:
    """Number rows 0, 1, .. by (bucket, order), without one global window.

    Rows are numbered inside their bucket, and each bucket is shifted by the
    size of those before it. Only the bucket sizes, one row per bucket, pass
    through a single task.
    """
    sizes = df.groupBy(bucket).agg(F.count("*").alias("_size"))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(bucket, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(bucket).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(starts, bucket)
        .withColumn(into, F.col("_start") + F.col("_rank"))
        .drop("_rank", "_start", bucket)
    )


def dense_ids(keys: DataFrame, key: str, into: str) -> DataFrame:
    """Distinct non-null keys numbered from 0 in key order.

    Keys are put into ranges whose boundaries come from the keys of lowest
    hash, a fixed-size draw, so a large key set is numbered in parallel. The
    draw shapes only the balance; the numbers are exact for any boundaries. The
    distinct keys are kept in the shared folder, so `keys` is read once.
    """
    checkpoint_dir(keys.sparkSession)
    distinct = keys.select(key).where(F.col(key).isNotNull()).distinct().checkpoint()
    drawn = sorted(
        row[0] for row in distinct.orderBy(F.xxhash64(key), key).limit(SAMPLE_KEYS).collect()
    )
    bounds = drawn[:: max(1, len(drawn) // RANGES)][1:]
    bucket = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col(key))) if bounds else F.lit(0)
    numbered = number_within(distinct.withColumn("_bucket", bucket), "_bucket", [key], into)
    return numbered.select(key, F.col(into).cast("int"))


# The ids of labels: a fixed dictionary, or a table (`label_table`) for any number of labels.
Labels = Mapping[str, int] | DataFrame


def label_table(rows: DataFrame, label: str, into: str) -> DataFrame:
    """label, id: all labels in a column, numbered from 0 in label order.

    The table is kept in the shared folder; it is joined, never collected.
    """
    return dense_ids(rows, label, into).checkpoint()


def n_labels(labels: Labels) -> int:
    return labels.count() if isinstance(labels, DataFrame) else len(labels)


def all_ids(labels: Labels, into: str) -> Column:
    """Every id as an array. Those of a table run from 0 without a gap, so their number is enough."""
    if not isinstance(labels, DataFrame):
        return F.array(*[F.lit(i) for i in labels.values()])
    highest = labels.agg(F.max(into)).first()[0]
    return F.array().cast("array<int>") if highest is None else F.sequence(F.lit(0), F.lit(highest))


def with_ids(
    rows: DataFrame, labels: Labels, label: str, into: str, keep_unknown: bool = True
) -> DataFrame:
    """Add the id of a label; rows of unknown labels get NULL, or are dropped."""
    if isinstance(labels, DataFrame):
        how = "left" if keep_unknown else "inner"
        return rows.join(labels.select(label, into), label, how)
    known = rows if keep_unknown else rows.where(F.col(label).isin(list(labels)))
    return known.withColumn(into, label_id(labels, label))


def with_labels(rows: DataFrame, labels: Labels, number: str, into: str) -> DataFrame:
    """The inverse of `with_ids`; rows of unknown ids get NULL."""
    if isinstance(labels, DataFrame):
        return rows.join(labels.select(number, into), number, "left")
    return rows.withColumn(into, id_label(labels, number))


def label_id(ids: Mapping[str, int], label: Column | str) -> Column:
    """Id of a label from a fixed dictionary; NULL when it is not in there."""
    pairs = [F.lit(part) for item in ids.items() for part in item]
    column = F.col(label) if isinstance(label, str) else label
    return F.try_element_at(F.create_map(*pairs), column)


def id_label(ids: Mapping[str, int], number: Column | str) -> Column:
    """The inverse of `label_id`."""
    pairs = [F.lit(part) for name, i in ids.items() for part in (i, name)]
    column = F.col(number) if isinstance(number, str) else number
    return F.try_element_at(F.create_map(*pairs), column)


def encode_keys(hourly: DataFrame, accounts: DataFrame, metrics: Labels) -> DataFrame:
    """Add `account_int` and `metric_int`; keys without an id get NULL."""
    numbered = hourly.join(accounts.select("account", "account_int"), "account", "left")
    return with_ids(numbered, metrics, "metric", "metric_int")


def decode_keys(encoded: DataFrame, accounts: DataFrame, metrics: Labels) -> DataFrame:
    """Add `account` and `metric` back from their ids."""
    named = encoded.join(accounts.select("account", "account_int"), "account_int", "left")
    return with_labels(named, metrics, "metric_int", "metric")
