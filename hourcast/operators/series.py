"""Hourly rows to dense series, and dense series to training samples.

A series is one (account, metric) pair on a complete hourly grid. Neither the
grid nor the 840 shifted copies of it are ever joined: sparse rows are gathered
into one array per series and time block, gaps are filled inside the array, and
windows are slices of it. Only observed rows are shuffled, once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourcast.config import EPS
from hourcast.functions.time import (
    add_hours,
    hour_literal,
    hour_of,
    hour_offset,
    hours_between,
    parse,
    weekday,
)
from hourcast.operators.keys import Labels, all_ids, with_ids, with_labels

SERIES = ["account_int", "metric_int"]

# Hours of window starts held by one array: a year. Longer ranges are cut, so
# no task ever holds more than a year and one window of a series.
BLOCK_HOURS = 8_760


def hours(start: datetime | str, end: datetime | str) -> Column:
    """Every hour in [start, end) as an array."""
    last = parse(end) - timedelta(hours=1)
    return F.sequence(hour_literal(start), hour_literal(last), F.expr("INTERVAL '1' HOUR"))


def key_grid(
    accounts: DataFrame, metrics: Labels, start: datetime | str, end: datetime | str
) -> DataFrame:
    """accounts x metrics x hours, grown out of the account rows without a cross join.

    Series are spread before they get their hours: the few files of a dimension would leave the
    whole grid to as many tasks.
    """
    series = accounts.select(
        "account", "account_int", F.explode(all_ids(metrics, "metric_int")).alias("metric_int")
    )
    named = with_labels(series, metrics, "metric_int", "metric")
    return named.repartition(wide_partitions(named), *SERIES).select(
        "account", "account_int", "metric_int", "metric", F.explode(hours(start, end)).alias("hour")
    )


def no_zero(value: Column) -> Column:
    return F.when(value == 0, EPS).otherwise(value.cast("double"))


def wide_partitions(df: DataFrame) -> int:
    """Partitions for data that will grow many times over inside its tasks.

    A plain repartition would be merged by its size before the gaps are filled,
    leaving the windows of many series to a few tasks.
    """
    spark = df.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffled, spark.sparkContext.defaultParallelism)


def _gathered(rows: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """The (pos, value) cells of each series block in order; a second value for
    one place is an error.

    Partitioned by `spread`, some or all of the series block, so one shuffle serves the
    uniqueness check and the grouping into arrays.
    """
    clash = F.raise_error(
        F.concat(
            F.lit("more than one value for (account_int, metric_int, position) "),
            F.concat_ws(", ", *SERIES, "pos"),
        )
    )
    return (
        rows.repartition(wide_partitions(rows), *spread)
        .groupBy(*keys, "pos")
        .agg(F.count("*").alias("_n"), F.first("value").alias("value"))
        .withColumn("value", F.when(F.col("_n") > 1, clash).otherwise(F.col("value")))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("cells"))
    )


def _filled(size: Column) -> Column:
    """The values of `cells` spread over `size` places, gaps at EPS.

    The first cell marks place -1. Every other one brings the gap before it
    along, which keeps the work linear. Without gaps the values are taken as
    they are.
    """

    def with_gap(cell: Column, i: Column) -> Column:
        gap = cell["pos"] - F.get("cells", i)["pos"] - 1
        value = F.array(cell["value"])
        return F.when(gap > 0, F.concat(F.array_repeat(F.lit(EPS), gap), value)).otherwise(value)

    n = F.size("cells")
    observed = F.slice("cells", F.lit(2), n - 1)
    tail = F.array_repeat(F.lit(EPS), size - F.get("cells", n - 1)["pos"] - 1)
    with_gaps = F.concat(F.flatten(F.transform(observed, with_gap)), tail)
    return F.when(n - 1 == size, observed["value"]).otherwise(with_gaps)


Range = tuple[datetime | str, datetime | str]


class _Stretch(NamedTuple):
    """Neighbouring window starts: the place of the first on the grid, how many, and the
    number of the first block that holds them."""

    first: int
    n_windows: int
    block: int

    def blocks(self, block_hours: int) -> int:
        return -(-self.n_windows // block_hours)


def _stretches(
    start: datetime | str,
    end: datetime | str,
    width: int,
    anchors: Range | Sequence[Range] | None,
    block_hours: int,
) -> list[_Stretch]:
    """The window starts on the grid [start, end) that lie in any of `anchors`, which include
    their ends. Ranges that touch or overlap become one."""
    top = hours_between(start, end) - width
    if anchors is None:
        places = [(0, top)]
    else:
        ranges = [anchors] if isinstance(anchors[0], (str, datetime)) else anchors
        places = sorted(
            (max(0, hours_between(start, low)), min(top, hours_between(start, high)))
            for low, high in ranges
        )
    joined: list[list[int]] = []
    for low, high in places:
        if high < low:
            continue
        if joined and low <= joined[-1][1] + 1:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    out, block = [], 0
    for low, high in joined:
        out.append(_Stretch(low, high - low + 1, block))
        block += out[-1].blocks(block_hours)
    return out


def _of_block(stretches: list[_Stretch], value) -> Column:
    """`value` of the stretch that the column `block` belongs to."""
    chosen = F.lit(None).cast("int")
    for stretch in stretches:
        chosen = F.when(F.col("block") >= stretch.block, value(stretch)).otherwise(chosen)
    return chosen


def _first_window(stretches: list[_Stretch], block_hours: int) -> Column:
    """The place on the grid of the block's first window."""
    return _of_block(
        stretches, lambda s: (F.col("block") - s.block) * block_hours + s.first
    )


def _window_count(stretches: list[_Stretch], block_hours: int) -> Column:
    return _of_block(
        stretches,
        lambda s: F.least(
            F.lit(block_hours), F.lit(s.n_windows) - (F.col("block") - s.block) * block_hours
        ),
    )


def _series_of_blocks(
    accounts: DataFrame, metrics: Labels, stretches: list[_Stretch], block_hours: int
) -> DataFrame:
    """account_int, metric_int, block: every block of every series."""
    n_blocks = sum(s.blocks(block_hours) for s in stretches)
    blocks = F.sequence(F.lit(0), F.lit(n_blocks - 1)) if n_blocks else F.array().cast("array<int>")
    return accounts.select(
        "account_int", F.explode(all_ids(metrics, "metric_int")).alias("metric_int")
    ).withColumn("block", F.explode(blocks))


def window_keys(
    accounts: DataFrame,
    metrics: Labels,
    start: datetime | str,
    end: datetime | str,
    width: int = 1,
    anchors: Range | Sequence[Range] | None = None,
    block_hours: int = BLOCK_HOURS,
) -> DataFrame:
    """account_int, metric_int, block, hour, n_windows of every block that `series_blocks` makes.

    They follow from the dimension alone: no event is read.
    """
    stretches = _stretches(start, end, width, anchors, block_hours)
    return _series_of_blocks(accounts, metrics, stretches, block_hours).select(
        *SERIES,
        "block",
        add_hours(hour_literal(start), _first_window(stretches, block_hours)).alias("hour"),
        _window_count(stretches, block_hours).alias("n_windows"),
    )


def reached_hours(
    start: datetime | str,
    end: datetime | str,
    width: int = 1,
    anchors: Range | Sequence[Range] | None = None,
) -> list[tuple[datetime, datetime]]:
    """First and last hour of every stretch of the grid that a window covers."""
    origin = parse(start)
    found = _stretches(start, end, width, anchors, BLOCK_HOURS)
    return [
        (origin + timedelta(hours=s.first), origin + timedelta(hours=s.first + s.n_windows + width - 2))
        for s in found
    ]


def series_blocks(
    hourly: DataFrame,
    accounts: DataFrame,
    metrics: Labels,
    start: datetime | str,
    end: datetime | str,
    width: int = 1,
    anchors: Range | Sequence[Range] | None = None,
    block_hours: int = BLOCK_HOURS,
    numbered: bool = False,
    together: bool = False,
) -> DataFrame:
    """Dense arrays that hold every `width`-hour window of the grid [start, end).

    One row per series and block of window starts: `v` holds `n_windows + width
    - 1` values from `hour` on, so neighbouring blocks overlap by `width - 1`
    hours and each window lies whole in exactly one block. `anchors`, one range or
    several, bounds the window starts, both ends included; rows no window reaches are
    dropped before the shuffle. Accounts, metrics and hours outside the grid vanish,
    absent hours and zeros become EPS, and NULL values stay NULL.

    `numbered` keeps the number of the block, by which, next to the series, the result is
    partitioned. `together` partitions by series alone where a series is a single block.
    """
    stretches = _stretches(start, end, width, anchors, block_hours)
    reaches = [(s.first, s.first + s.n_windows + width - 1) for s in stretches]
    origin = parse(start)

    def within(low: int, high: int) -> Column:
        ends = [hour_literal(origin + timedelta(hours=at)) for at in (low, high)]
        return (F.col("hour") >= ends[0]) & (F.col("hour") < ends[1])

    offset = F.col("_offset")

    def places(s: _Stretch) -> Column:
        """The blocks of a stretch that a row falls in, and its place in each."""
        own = offset - s.first
        low = F.greatest(F.lit(0), F.floor((own - width + 1) / block_hours))
        high = F.least(F.lit(s.blocks(block_hours) - 1), F.floor(own / block_hours))
        found = F.transform(
            F.sequence(low.cast("int"), high.cast("int")),
            lambda b: F.struct(
                (b + s.block).alias("block"), (own - b * block_hours).cast("int").alias("pos")
            ),
        )
        inside = (own >= 0) & (own < s.n_windows + width - 1)
        return F.when(inside, found).otherwise(F.array().cast("array<struct<block:int,pos:int>>"))

    rows = (
        hourly.where(reduce(or_, [within(*r) for r in reaches]) if reaches else F.lit(False))
        # Rows beside the full hour are not on the grid.
        .where(F.col("hour") == hour_of("hour"))
        .join(accounts.select("account", "account_int"), "account")
    )
    rows = with_ids(rows, metrics, "metric", "metric_int", keep_unknown=False).select(
        *SERIES, hour_offset("hour", origin).alias("_offset"), no_zero(F.col("value")).alias("value")
    )
    nowhere = F.array().cast("array<struct<block:int,pos:int>>")
    at = F.concat(*map(places, stretches)) if stretches else nowhere
    rows = rows.select(*SERIES, F.explode(at).alias("_at"), "value").select(
        *SERIES, "_at.block", "_at.pos", "value"
    )

    # One marker row per series block brings in those nothing was observed of.
    keys = [*SERIES, "block"]
    markers = _series_of_blocks(accounts, metrics, stretches, block_hours).select(
        *keys, F.lit(-1).alias("pos"), F.lit(None).cast("double").alias("value")
    )
    windows = _window_count(stretches, block_hours)
    # Where a series is one block, its rows need no further shuffle to come together again.
    whole = together and sum(s.blocks(block_hours) for s in stretches) == 1
    return _gathered(rows.union(markers), keys, SERIES if whole else keys).select(
        *SERIES,
        *(["block"] if numbered else []),
        add_hours(hour_literal(origin), _first_window(stretches, block_hours)).alias("hour"),
        windows.alias("n_windows"),
        _filled(windows + (width - 1)).alias("v"),
    )


def densify(
    hourly: DataFrame,
    accounts: DataFrame,
    metrics: Labels,
    start: datetime | str,
    end: datetime | str,
) -> DataFrame:
    """The hourly table on the complete grid, one row per series and hour.

    Rows of a series leave in hour order.
    """
    blocks = series_blocks(hourly, accounts, metrics, start, end, together=True)
    hour = add_hours("_from", F.col("_i"))
    return blocks.select(
        *SERIES, F.col("hour").alias("_from"), F.posexplode("v").alias("_i", "value")
    ).select(*SERIES, hour.alias("hour"), "value", weekday(hour).alias("dayofweek"))


def make_samples(blocks: DataFrame, lags: int, horizon: int) -> DataFrame:
    """One sample per window: `lags` inputs from `hour` on, then `horizon` labels.

    `blocks` comes from `series_blocks` with width lags + horizon, or just lags
    for samples without labels (horizon 0). Where blocks have `positions`, a sample gets its
    `position`.
    """
    o = F.col("_o")
    hour = add_hours("_from", o)
    positions = ["positions"] if "positions" in blocks.columns else []
    # Values become floats once a block, before it is taken apart.
    window = blocks.withColumn("v", F.col("v").cast("array<float>")).select(
        *SERIES,
        F.col("hour").alias("_from"),
        "v",
        *positions,
        F.explode(F.sequence(F.lit(0), F.col("n_windows") - 1)).alias("_o"),
    )
    v = F.col("v")
    labels = [F.slice(v, o + (lags + 1), horizon).alias("y")] if horizon else []
    return window.select(
        *SERIES,
        hour.alias("hour"),
        weekday(hour).alias("dayofweek"),
        F.slice(v, o + 1, lags).alias("x"),
        *labels,
        *[F.get(c, o).alias("position") for c in positions],
    )


def samples_wide(samples: DataFrame, lags: int, horizon: int) -> DataFrame:
    """Export layout: one column per offset, `0` .. `lags + horizon - 1`, and `split` if given."""
    inputs = [F.col("x")[i].alias(str(i)) for i in range(lags)]
    labels = [F.col("y")[i].alias(str(lags + i)) for i in range(horizon)]
    split = ["split"] if "split" in samples.columns else []
    return samples.select(*SERIES, "hour", "dayofweek", *inputs, *labels, *split)


def series_lead(dense: DataFrame, offsets: Iterable[int]) -> DataFrame:
    """Values some hours ahead as further columns; NULL past the end.

    For a handful of offsets. Whole windows are cheaper as array slices.
    """
    ahead = Window.partitionBy(*SERIES).orderBy("hour")
    return dense.select("*", *[F.lead("value", i).over(ahead).alias(f"lead_{i}") for i in offsets])


def spot_check(
    hourly: DataFrame, accounts: DataFrame, metrics: Labels, hour: datetime | str
) -> DataFrame:
    """The value of every series at one hour, read without building the rest."""
    return densify(hourly, accounts, metrics, hour, parse(hour) + timedelta(hours=1))
