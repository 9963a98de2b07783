"""Raw events to the hourly table, and on to training samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.config import METRIC_IDS, OPCODE_METRICS, ForecastConfig
from hourcast.functions.time import parse
from hourcast.operators.batches import ordered_blocks
from hourcast.operators.filters import in_hours, in_months_of, keep_accounts, last_months, split_by_time
from hourcast.operators.hourly import hourly_metrics
from hourcast.operators.keys import Labels
from hourcast.operators.series import (
    BLOCK_HOURS,
    Range,
    make_samples,
    reached_hours,
    series_blocks,
    window_keys,
)
from hourcast.sources.hourly import read_hourly
from hourcast.sources.sinks import append_events, write_hourly_months


def training_table(
    signalling: DataFrame,
    sessions: DataFrame,
    accounts: DataFrame,
    as_of: date | None = None,
    n_months: int = 4,
    ts: str | None = None,
    opcodes: Mapping[str, str] = OPCODE_METRICS,
) -> DataFrame:
    """The hourly table of the listed accounts over the last whole months.

    Both filters sit on the scans. Give `ts` where the tables have no `year`
    and `month` columns.
    """
    kept = [
        keep_accounts(last_months(table, as_of, n_months, ts), accounts)
        for table in (signalling, sessions)
    ]
    return hourly_metrics(*kept, opcodes=opcodes, ordered=True)


def window_blocks(
    hourly: DataFrame,
    accounts: DataFrame,
    grid: Range,
    anchors: Range | Sequence[Range] | None = None,
    config: ForecastConfig = ForecastConfig(),
    metrics: Labels = METRIC_IDS,
    labelled: bool = True,
    block_hours: int = BLOCK_HOURS,
    shuffled: int | None = None,
) -> DataFrame:
    """Dense float32 arrays holding every window that starts within `anchors`.

    Smaller blocks spread the work on few series over more tasks. With a seed in `shuffled`
    blocks have the `positions` of their windows in the random order of all of them.
    """
    width = config.width if labelled else config.lags
    blocks = series_blocks(
        hourly,
        accounts,
        metrics,
        *grid,
        width=width,
        anchors=anchors,
        block_hours=block_hours,
        numbered=shuffled is not None,
    ).withColumn("v", F.col("v").cast("array<float>"))
    if shuffled is None:
        return blocks
    keys = window_keys(accounts, metrics, *grid, width, anchors, block_hours)
    return ordered_blocks(blocks, keys, shuffled).drop("block")


def hourly_of_windows(
    signalling: DataFrame,
    sessions: DataFrame,
    accounts: DataFrame,
    grid: Range,
    anchors: Range | Sequence[Range] | None = None,
    width: int = 1,
    opcodes: Mapping[str, str] = OPCODE_METRICS,
) -> DataFrame:
    """The hourly table of the listed accounts in the hours that windows reach, and no others.

    The hours go down to the scans of both sources as ranges on the timestamp.
    """
    hours = reached_hours(*grid, width, anchors)
    kept = [keep_accounts(in_hours(table, hours), accounts) for table in (signalling, sessions)]
    return hourly_metrics(*kept, opcodes=opcodes)


def refresh_hourly(
    signalling: DataFrame,
    sessions: DataFrame,
    months: DataFrame,
    path: str,
    opcodes: Mapping[str, str] = OPCODE_METRICS,
) -> DataFrame:
    """Compute the months (year, month) of a stored hourly table anew, and return the table.

    Of sources partitioned by month only these are read, and only these are replaced. A month
    without events any more keeps what it had.
    """
    kept = [in_months_of(table, months) for table in (signalling, sessions)]
    write_hourly_months(hourly_metrics(*kept, opcodes=opcodes), path)
    return read_hourly(signalling.sparkSession, path)


def add_late_events(
    signalling_path: str,
    sessions_path: str,
    hourly_path: str,
    late_signalling: DataFrame,
    late_sessions: DataFrame,
    load: str,
    opcodes: Mapping[str, str] = OPCODE_METRICS,
) -> DataFrame:
    """Add events to the stored sources and bring the hourly table up to date.

    Counts of distinct subscribers cannot be added up, so the months the late events fall in
    are computed again from all their events. `load` names the addition: run twice, or again
    after a failure, it replaces itself and counts once.
    """
    spark = late_signalling.sparkSession
    stored = [
        append_events(late, path, load)
        for late, path in ((late_signalling, signalling_path), (late_sessions, sessions_path))
    ]
    dates = late_signalling.select("ts").unionByName(late_sessions.select("ts"))
    touched = dates.select(F.year("ts").alias("year"), F.month("ts").alias("month")).distinct()
    sources = [spark.read.schema(schema).parquet(path) for schema, path in stored]
    return refresh_hourly(*sources, touched, hourly_path, opcodes)


def latest_windows(
    hourly: DataFrame,
    accounts: DataFrame,
    grid: Range,
    config: ForecastConfig = ForecastConfig(),
    metrics: Labels = METRIC_IDS,
) -> DataFrame:
    """The last `lags` hours of every series, to forecast what comes next."""
    last = parse(grid[1]) - timedelta(hours=config.lags)
    return window_blocks(hourly, accounts, grid, (last, last), config, metrics, labelled=False)


def split_samples(
    hourly: DataFrame,
    accounts: DataFrame,
    grid: Range,
    train: Range,
    valid: Range,
    config: ForecastConfig = ForecastConfig(),
    metrics: Labels = METRIC_IDS,
) -> DataFrame:
    """Samples of both splits, tagged by `split`.

    Only windows that start in one of the two ranges are made.
    """
    blocks = window_blocks(hourly, accounts, grid, [train, valid], config, metrics)
    samples = make_samples(blocks, config.lags, config.horizon)
    return split_by_time(samples, train, valid, gap=config.width)
