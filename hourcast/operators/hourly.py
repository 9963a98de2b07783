"""Raw events to the hourly (account, hour, metric) -> value table.

Each source is read once and grouped once by (account, hour): every metric is a
column of that one aggregate, and the columns are then turned into rows. The
partial phase folds a busy account to one row per hour and task before anything
is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.config import (
    OPCODE_METRICS,
    RECORD_TYPE_METRICS,
    SUBSCRIBER_METRIC,
    SUCCESS_CODE,
    TOTAL_METRIC,
)
from hourcast.functions.time import hour_of, iso_weekday

KEYS = ["account", "hour"]

# Base-2 logarithm of a sketch's cells: 4 KB at most, a standard error of 1.6 %.
SKETCH_LOG_SIZE = 12


def _by_hour(events: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    return events.groupBy("account", hour_of("ts").alias("hour")).agg(
        *[value.cast("bigint").alias(name) for name, value in metrics.items()]
    )


def _to_rows(by_hour: DataFrame, metrics: list[str]) -> DataFrame:
    return by_hour.unpivot(KEYS, metrics, "metric", "value")


def hourly_opcode_counts(
    signalling: DataFrame,
    opcodes: Mapping[str, str] = OPCODE_METRICS,
    total: str = TOTAL_METRIC,
) -> DataFrame:
    """Events per named opcode, and per hour over all opcodes.

    Events without an opcode count nowhere; opcodes without a name count in the
    total only. Hours without a named opcode get no row for it.
    """
    names = [*opcodes.values(), total]
    if len(set(names)) != len(names):
        raise ValueError("each opcode needs a metric name of its own")
    counts = {name: F.count_if(F.col("op") == op) for op, name in opcodes.items()}
    by_hour = _by_hour(
        signalling.where(F.col("op").isNotNull()), {**counts, total: F.count("*")}
    )
    return _to_rows(by_hour, names).where(F.col("value") > 0)


def _conditional(record_types: Mapping[str, int], code: int) -> dict[str, Column]:
    return {
        name: F.sum(
            F.when((F.col("code") == code) & (F.col("rectype") == rectype), 1).otherwise(0)
        )
        for name, rectype in record_types.items()
    }


def hourly_conditional_counts(
    sessions: DataFrame,
    record_types: Mapping[str, int] = RECORD_TYPE_METRICS,
    code: int = SUCCESS_CODE,
) -> DataFrame:
    """Successful session records per type; hours with none of a type give 0."""
    return _to_rows(_by_hour(sessions, _conditional(record_types, code)), list(record_types))


def hourly_distinct_subscribers(
    sessions: DataFrame, metric: str = SUBSCRIBER_METRIC
) -> DataFrame:
    """Exact number of subscribers seen per hour.

    Spark first drops repeats by (account, hour, subscriber), spread over all
    three, and only then counts by (account, hour).
    """
    return _to_rows(_by_hour(sessions, {metric: F.count_distinct("subscriber")}), [metric])


def hourly_subscriber_sketches(sessions: DataFrame, log_size: int = SKETCH_LOG_SIZE) -> DataFrame:
    """account, hour, sketch: subscribers seen per hour as a mergeable sketch of bounded size.

    The opt-in to approximate counts: exact ones of hours cannot be added up to days, sketches
    can, without going back to the events. A busy account folds to one sketch an hour and task
    before the shuffle.
    """
    return sessions.where(F.col("subscriber").isNotNull()).groupBy(
        "account", hour_of("ts").alias("hour")
    ).agg(F.hll_sketch_agg("subscriber", log_size).alias("sketch"))


def merged_subscribers(sketches: DataFrame, *by: Column) -> DataFrame:
    """`by` columns and `subscribers`: about how many were seen over all sketches of a group.

    The standard error is `sketch_error`; small counts are exact but for hash collisions.
    """
    count = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*by).agg(count.alias("subscribers"))


def sketch_error(log_size: int = SKETCH_LOG_SIZE) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / math.sqrt(2**log_size)


def hourly_session_metrics(
    sessions: DataFrame,
    record_types: Mapping[str, int] = RECORD_TYPE_METRICS,
    code: int = SUCCESS_CODE,
    subscribers: str = SUBSCRIBER_METRIC,
) -> DataFrame:
    """Conditional counts and distinct subscribers from one scan."""
    metrics = {
        **_conditional(record_types, code),
        subscribers: F.count_distinct("subscriber"),
    }
    return _to_rows(_by_hour(sessions, metrics), list(metrics))


def hourly_metrics(
    signalling: DataFrame,
    sessions: DataFrame,
    opcodes: Mapping[str, str] = OPCODE_METRICS,
    ordered: bool = False,
) -> DataFrame:
    """The whole hourly table.

    The parts hold different metrics, so a plain union already has unique keys.
    `ordered` sorts the result for export; nothing downstream needs it.
    """
    table = (
        hourly_opcode_counts(signalling, opcodes)
        .unionByName(hourly_session_metrics(sessions))
        .select("account", "hour", iso_weekday("hour").alias("day_of_week"), "metric", "value")
    )
    return table.orderBy("hour", "account", "metric") if ordered else table
