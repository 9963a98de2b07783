"""Every operator on the fixture tables.

The `events` table plays both raw sources. As signalling events its types are
the opcodes (`error` is the unnamed one); as session records `purchase` and
`signup` are the two record types, a value of 50 or more is a success, and
`props.k` is the subscriber.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from fixtures.settings import (
    ACCOUNT_SHIFT,
    AS_OF,
    DEAR,
    GRID,
    HORIZON,
    LAGS,
    OPCODES,
    ORDERS_AS_OF,
    SMALL_NET,
    SMALL_TRAIN,
    SMALL_VALID,
    SPOT,
    SQL_FILE,
    STATUS_METRICS,
    TINY_NET,
    TRAIN,
    VALID,
    WINDOWS,
    given_weights,
)
from hourcast.config import METRIC_IDS, SUCCESS_CODE, ForecastConfig
from hourcast.functions.arrow import totals
from hourcast.functions.network import pack
from hourcast.functions.time import months_before, weekday
from hourcast.operators import batches as batching
from hourcast.operators import filters, hourly, keys, metrics, series
from hourcast.operators.embeddings import embedding_lookup, embedding_topk
from hourcast.operators.model import Model, forecast, save_model
from hourcast.operators.training import (
    Adam,
    Trainer,
    deal_windows,
    fit_forecaster,
    hold,
    initial_state,
    loss_gradient,
)
from hourcast.operators.neighbours import pivot_topk
from hourcast.operators.series import Range
from hourcast.plans import build, forecasting
from hourcast.session import scratch_path
from hourcast.sources import events as event_sources
from hourcast.sources import hourly as hourly_files
from hourcast.sources import samples as sample_files
from hourcast.sources import sinks
from hourcast.sources.accounts import (
    account_dimension,
    read_accounts,
    read_accounts_csv,
    write_accounts,
)
from hourcast.sources.sql_file import run_sql_file

# Fixture tables ---------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _signalling(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return event_sources.signalling_events(events, account="user_id", ts="ts", op="event_type")


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rectype = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "signup", 2)
    return event_sources.session_events(
        _table(spark, sf_dir, "events"),
        account="user_id",
        ts="ts",
        code=F.when(F.col("value") >= 50, 128).otherwise(0),
        rectype=rectype.otherwise(0),
        subscriber=F.get_json_object("props", "$.k"),
    )


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_metrics(_signalling(spark, sf_dir), _sessions(spark, sf_dir), OPCODES)


@cache
def _stored_accounts(spark: SparkSession, sf_dir: str) -> str:
    """The account dimension is made once and kept as a table, like any other."""
    path = scratch_path(spark, "accounts")
    write_accounts(account_dimension(_signalling(spark, sf_dir)), path)
    return path


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_accounts(spark, _stored_accounts(spark, sf_dir))


def _named_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounts seen, with the customers' names as account names."""
    names = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("account"), F.col("c_name").alias("accountname")
    )
    return _accounts(spark, sf_dir).join(names, "account", "left")


def _dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.densify(
        _hourly(spark, sf_dir), _accounts(spark, sf_dir), METRIC_IDS, *GRID
    )


def _blocks(
    spark: SparkSession,
    sf_dir: str,
    config: ForecastConfig = WINDOWS,
    anchors: Range | None = None,
    table: DataFrame | None = None,
    shuffled: int | None = None,
) -> DataFrame:
    table = _hourly(spark, sf_dir) if table is None else table
    accounts = _accounts(spark, sf_dir)
    return build.window_blocks(table, accounts, GRID, anchors, config, shuffled=shuffled)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.make_samples(_blocks(spark, sf_dir), LAGS, HORIZON)


def _day_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast each hour by the hour one day before the horizon starts."""
    return samples(spark, sf_dir).withColumn(
        "yhat", F.slice("x", LAGS - HORIZON + 1, HORIZON)
    )


# Queries ----------------------------------------------------------------------


def hourly_opcode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_opcode_counts(_signalling(spark, sf_dir), OPCODES)


def hourly_conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_conditional_counts(_sessions(spark, sf_dir))


def hourly_distinct_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_distinct_subscribers(_sessions(spark, sf_dir))


def hourly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_metrics(
        _signalling(spark, sf_dir), _sessions(spark, sf_dir), OPCODES, ordered=True
    )


def top_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.top_accounts(_signalling(spark, sf_dir))


def top_accounts_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _signalling(spark, sf_dir)
    return filters.keep_accounts(events, filters.top_accounts(events))


def last_months_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.last_months(_table(spark, sf_dir, "orders"), ORDERS_AS_OF, ts="o_orderdate")
    return kept.select(
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        "o_totalprice",
    )


def month_table_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders placed in a calendar month in which events were seen too."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    seen = _signalling(spark, sf_dir).select(F.month("ts").alias("month")).distinct()
    months = orders.select("year", "month").join(seen, "month")
    return filters.in_months_of(orders, months)


def training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    signalling = _signalling(spark, sf_dir)
    return build.training_table(
        signalling,
        _sessions(spark, sf_dir),
        filters.top_accounts(signalling),
        AS_OF,
        ts="ts",
        opcodes=OPCODES,
    )


def _with_calendar(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("ts")).withColumn("month", F.month("ts"))


def sql_file_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    signalling = _signalling(spark, sf_dir)
    opcodes = F.create_map(*[F.lit(part) for item in OPCODES.items() for part in item])
    return run_sql_file(
        spark,
        SQL_FILE,
        args={
            "months": F.array(*[F.lit(y * 100 + m) for y, m in months_before(AS_OF)]),
            "opcodes": opcodes,
            "total_metric": "mapsum",
        },
        signalling=_with_calendar(signalling),
        sessions=_with_calendar(_sessions(spark, sf_dir)),
        accounts=filters.top_accounts(signalling),
    )


def encode_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = keys.encode_keys(_hourly(spark, sf_dir), _accounts(spark, sf_dir), METRIC_IDS)
    return encoded.select("account", "account_int", "hour", "metric", "metric_int", "value")


def decode_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = _accounts(spark, sf_dir)
    encoded = keys.encode_keys(_hourly(spark, sf_dir), accounts, METRIC_IDS)
    bare = encoded.select("account_int", "metric_int", "hour", "value")
    return keys.decode_keys(bare, accounts, METRIC_IDS)


def key_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.key_grid(_accounts(spark, sf_dir), METRIC_IDS, *GRID)


def densify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dense(spark, sf_dir)


def series_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.series_lead(_dense(spark, sf_dir), [1, 24, 168])


def _with_totals(df: DataFrame, *lists: str) -> DataFrame:
    """`name`_sum of the cells of each list column instead of the list."""
    kept = [field for field in df.schema if field.name not in lists]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = {f"{name}_sum": totals(batch[name]) for name in lists}
            yield pa.record_batch({**{field.name: batch[field.name] for field in kept}, **sums})

    sums = [StructField(f"{name}_sum", DoubleType()) for name in lists]
    return df.mapInArrow(run, StructType(kept + sums))


def _summary(samples: DataFrame, *more: str) -> DataFrame:
    """Both ends and the sums of every sample."""
    ends = samples.select(
        *more,
        "account_int",
        "metric_int",
        "hour",
        "dayofweek",
        F.get("x", F.lit(0)).cast("double").alias("x_first"),
        F.get("x", F.lit(LAGS - 1)).cast("double").alias("x_last"),
        F.get("y", F.lit(0)).cast("double").alias("y_first"),
        F.get("y", F.lit(HORIZON - 1)).cast("double").alias("y_last"),
        F.size("x").alias("n_x"),
        F.size("y").alias("n_y"),
        "x",
        "y",
    )
    # Cells are added up a whole Arrow batch at a time; a lambda is called for each of them.
    return _with_totals(ends, "x", "y").withColumns(
        {name: F.round(name, 6) for name in ("x_sum", "y_sum")}
    )


def make_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(samples(spark, sf_dir))


def _wide_sums(wide: DataFrame) -> DataFrame:
    sums = [F.round(F.sum(F.col(str(i)).cast("double")), 6).alias(str(i)) for i in range(6)]
    return wide.groupBy("account_int", "metric_int").agg(F.count("*").alias("n"), *sums)


def samples_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide samples of 4 + 2 hours, summed per series and column."""
    short = ForecastConfig(lags=4, horizon=2)
    samples = series.make_samples(_blocks(spark, sf_dir, short), 4, 2)
    return _wide_sums(series.samples_wide(samples, 4, 2))


def split_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = build.split_samples(
        _hourly(spark, sf_dir), _accounts(spark, sf_dir), GRID, TRAIN, VALID, WINDOWS
    )
    return split.groupBy("split", "account_int", "metric_int").agg(
        F.count("*").alias("n"), F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour")
    )


def spot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.spot_check(_hourly(spark, sf_dir), _accounts(spark, sf_dir), METRIC_IDS, SPOT)


def smape(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = metrics.smape(_day_before(spark, sf_dir))
    return scores.select(F.round("smape", 6).alias("smape"), "n")


def score_by_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = metrics.score_by_account(_day_before(spark, sf_dir), _named_accounts(spark, sf_dir))
    return scores.withColumn("smape", F.round("smape", 6))


def log_l2_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = metrics.log_l2_loss(_day_before(spark, sf_dir), ["account_int", "metric_int"])
    return losses.withColumn("loss", F.round("loss", 4))


def embedding_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account and weekday vectors of every event, side by side."""
    table = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec")
    )
    events = _table(spark, sf_dir, "events").select(
        "event_id", "user_id", weekday("ts").cast("bigint").alias("day")
    )
    both = embedding_lookup(
        embedding_lookup(events, table, "user_id", "by_user"), table, "day", "by_day"
    ).withColumn("vec", F.concat("by_user", "by_day"))
    # Place-weighted, so that a swap of cells or vectors shows.
    weighted = F.aggregate(
        F.transform("vec", lambda v, i: v.cast("double") * (i + 1)), F.lit(0.0), lambda a, v: a + v
    )
    return both.select(
        "event_id", F.array_size("vec").alias("n"), F.round(weighted, 6).alias("weighted_sum")
    )


def embedding_topk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec")
    )
    return embedding_topk(table).withColumn("cosine", F.round("cosine", 6))


def _shuffled_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.make_samples(_blocks(spark, sf_dir, shuffled=0), LAGS, HORIZON)


def embedding_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same neighbours by pivots and bounds on angles."""
    table = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec")
    )
    return pivot_topk(table).withColumn("cosine", F.round("cosine", 6))


def daily_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct subscribers of a day, merged from the sketches of its hours."""
    sketches = hourly.hourly_subscriber_sketches(_sessions(spark, sf_dir))
    day = F.to_date("hour").cast("timestamp_ntz").alias("day")
    return hourly.merged_subscribers(sketches, F.col("account"), day)


def shuffle_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position of every sample in the order of its hash."""
    shuffled = _shuffled_samples(spark, sf_dir)
    return shuffled.select("account_int", "metric_int", "hour", "position")


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch of every sample."""
    dealt = batching.batches(_shuffled_samples(spark, sf_dir), 10_000)
    return dealt.select("account_int", "metric_int", "hour", "batch")


def _stored_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly table written out, for runs that read it more than once."""
    path = scratch_path(spark, "hourly")
    sinks.write_hourly(_hourly(spark, sf_dir), path)
    return hourly_files.read_hourly(spark, path)


def _train_and_valid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    table = _stored_hourly(spark, sf_dir)
    return tuple(
        _blocks(spark, sf_dir, SMALL_NET, between, table) for between in (SMALL_TRAIN, SMALL_VALID)
    )


def _fit(spark: SparkSession, sf_dir: str) -> tuple[Model, DataFrame]:
    train, valid = _train_and_valid(spark, sf_dir)
    accounts = _accounts(spark, sf_dir)
    return fit_forecaster(train, valid, accounts, len(METRIC_IDS), SMALL_NET)


def fit_forecaster_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit(spark, sf_dir)[1]


def _given_model(spark: SparkSession, sf_dir: str, config: ForecastConfig) -> Model:
    """A model whose weights follow the rule."""
    cells = [
        (F.pmod(F.col("account_int") * 7 + 3 * i + ACCOUNT_SHIFT, F.lit(17)) - 8) / 40
        for i in range(config.account_dim)
    ]
    vectors = _accounts(spark, sf_dir).select(
        F.col("account_int").alias("id"), F.array(*cells).alias("vec")
    )
    return Model(config, given_weights(config), vectors)


def forecast_given_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours after the last one by a network whose weights follow a rule."""
    config = replace(SMALL_NET, precision="float64")
    accounts = _accounts(spark, sf_dir)
    latest = build.latest_windows(_hourly(spark, sf_dir), accounts, GRID, config)
    return forecast(latest, _given_model(spark, sf_dir, config), labelled=False).select(
        "account_int",
        "metric_int",
        "hour",
        "dayofweek",
        F.posexplode("yhat").alias("step", "yhat"),
    )


def score_given_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts from every window by such a network, scored by account."""
    model = _given_model(spark, sf_dir, TINY_NET)
    forecasts = forecast(_blocks(spark, sf_dir, TINY_NET), model)
    scores = metrics.score_by_account(forecasts, _named_accounts(spark, sf_dir))
    return scores.withColumn("smape", F.round("smape", 6))


def _stored_model(spark: SparkSession, sf_dir: str, config: ForecastConfig) -> str:
    """Such a network, written out."""
    path = scratch_path(spark, "given_models")
    save_model(_given_model(spark, sf_dir, config), path, "given")
    return path


def forecast_stored_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours after the last one by such a network from its files, with labels."""
    path = _stored_model(spark, sf_dir, replace(SMALL_NET, precision="float64"))
    found = forecasting.forecast_stored(
        _hourly(spark, sf_dir), _accounts(spark, sf_dir), GRID, path, "given"
    )
    return found.select(
        "account", "metric", "hour", "dayofweek", F.posexplode("yhat").alias("step", "yhat")
    )


def score_stored_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Such a network from its files, scored by account on every window."""
    path = _stored_model(spark, sf_dir, TINY_NET)
    scores = forecasting.score_stored(
        _blocks(spark, sf_dir, TINY_NET), _named_accounts(spark, sf_dir), path, "given"
    )
    return scores.withColumn("smape", F.round("smape", 6))


def training_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean gradient by every weight, and mean loss, over all windows."""
    model = _given_model(spark, sf_dir, TINY_NET)
    one_batch = replace(TINY_NET, batches=1)
    dealt = deal_windows(_blocks(spark, sf_dir, TINY_NET), one_batch, 0, scratch_path(spark, "dealt"))
    windows = hold(dealt.drop("batch"))
    loss, n, grads, by_account = loss_gradient(windows, model.weights, model.accounts, TINY_NET)
    rows = [("loss", 0, 0, loss / n)]
    for name, grad in grads.items():
        table = grad.reshape(len(grad), -1) / n
        rows += [(name, i, j, float(g)) for (i, j), g in np.ndenumerate(table)]
    shared = spark.createDataFrame(rows, "name string, i int, j int, mean double")
    accounts = by_account.select(
        F.lit("account").alias("name"), F.col("id").alias("i"), F.posexplode("gradient").alias("j", "_g")
    ).select("name", "i", "j", (F.col("_g") / n).alias("mean"))
    return shared.unionByName(accounts).withColumn("mean", F.round("mean", 6))


def forecast_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six hours after the last one, for every series."""
    model, _ = _fit(spark, sf_dir)
    accounts = _accounts(spark, sf_dir)
    latest = build.latest_windows(_hourly(spark, sf_dir), accounts, GRID, SMALL_NET)
    return forecast(latest, model, labelled=False).select(
        "account_int", "metric_int", "hour", F.posexplode("yhat").alias("step", "yhat")
    )


def score_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, store, load again, and score every account on later windows."""
    path, accounts = scratch_path(spark, "models"), _named_accounts(spark, sf_dir)
    train, valid = _train_and_valid(spark, sf_dir)
    forecasting.train_and_store(train, valid, accounts, path, "net", 0, SMALL_NET)
    return forecasting.score_stored(valid, accounts, path, "net")


def neighbour_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = _fit(spark, sf_dir)
    return forecasting.neighbour_report(spark, model)


def _single_account(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The hourly table of all events taken as one account, and its dimension."""
    parts = [
        table(spark, sf_dir).withColumn("account", F.lit("all"))
        for table in (_signalling, _sessions)
    ]
    accounts = spark.createDataFrame([("all", 0)], "account string, account_int int")
    return hourly.hourly_metrics(*parts, opcodes=OPCODES), accounts


def single_account_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of the single-account layout, with metric ids taken from the data."""
    table, accounts = _single_account(spark, sf_dir)
    ids = keys.label_table(table, "metric", "metric_int")
    blocks = build.window_blocks(table, accounts, GRID, None, WINDOWS, ids)
    return _summary(series.make_samples(blocks, LAGS, HORIZON))


def single_account_forecaster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training without account vectors, a day to a block."""
    table, accounts = _single_account(spark, sf_dir)
    ids = keys.label_table(table, "metric", "metric_int")
    config = replace(SMALL_NET, account_dim=0, metric_dim=4, weekday_dim=4)
    train, valid = (
        build.window_blocks(table, accounts, GRID, between, config, ids, block_hours=24)
        for between in (SMALL_TRAIN, SMALL_VALID)
    )
    return fit_forecaster(train, valid, accounts, keys.n_labels(ids), config)[1]


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "hourly_csv")
    sinks.write_hourly_csv(_hourly(spark, sf_dir), path)
    return hourly_files.read_hourly_csv(spark, path)


def single_account_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout without account column but with a week, which is not read."""
    table, _ = _single_account(spark, sf_dir)
    path = scratch_path(spark, "single_account_csv")
    table.select(
        F.date_format("hour", sinks.HOUR_TEXT).alias("hour"),
        F.weekofyear("hour").alias("week"),
        "day_of_week",
        "metric",
        "value",
    ).write.csv(path, header=True)
    return hourly_files.read_single_account_csv(spark, path, "all")


def account_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the quoted account dictionary, read back and numbered."""
    path = scratch_path(spark, "accounts_csv")
    _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("accountid"), F.col("c_name").alias("accountname")
    ).write.csv(path, header=True, quoteAll=True)
    return account_dimension(read_accounts_csv(spark, path))


def samples_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide samples of 4 + 2 hours through text."""
    short = ForecastConfig(lags=4, horizon=2)
    path = scratch_path(spark, "samples_csv")
    samples = series.make_samples(_blocks(spark, sf_dir, short), 4, 2)
    sinks.write_samples_csv(samples, path, 4, 2)
    stored = series.samples_wide(sample_files.read_samples_csv(spark, path, 4, 2), 4, 2)
    return _wide_sums(stored)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_hourly(spark, sf_dir)


def events_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, which span years, written by month; the filter on (year, month) skips folders."""
    path = scratch_path(spark, "events")
    orders = event_sources.signalling_events(
        _table(spark, sf_dir, "orders"), account="o_custkey", ts="o_orderdate", op="o_orderstatus"
    )
    sinks.write_events(orders, path)
    stored = event_sources.read_table(spark, path)
    kept = filters.last_months(stored, ORDERS_AS_OF)
    return kept.select("account", "ts", "op", "year", "month")


def samples_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "samples")
    sinks.write_samples(
        build.split_samples(
            _hourly(spark, sf_dir), _accounts(spark, sf_dir), GRID, TRAIN, VALID, WINDOWS
        ),
        path,
    )
    train, valid = (
        sample_files.read_samples(spark, path, split).withColumn("split", F.lit(split))
        for split in ("train", "valid")
    )
    return train.unionByName(valid).groupBy("split", "account_int", "metric_int").agg(
        F.count("*").alias("n"),
        F.round(F.sum(F.get("x", F.lit(0)).cast("double")), 6).alias("x_sum"),
        F.round(F.sum(F.get("y", F.lit(0)).cast("double")), 6).alias("y_sum"),
    )


def hourly_of_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly table in the hours that the validation windows reach."""
    return build.hourly_of_windows(
        _signalling(spark, sf_dir),
        _sessions(spark, sf_dir),
        _accounts(spark, sf_dir),
        GRID,
        VALID,
        WINDOWS.width,
        OPCODES,
    )


def _dear() -> Column:
    return (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > DEAR)


def month_table_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in folders by month, read for the months in which an urgent order was dear."""
    path = scratch_path(spark, "orders_by_month")
    orders = event_sources.signalling_events(
        _table(spark, sf_dir, "orders"), account="o_custkey", ts="o_orderdate", op="o_orderstatus"
    )
    sinks.write_events(orders, path)
    dear = _table(spark, sf_dir, "orders").where(_dear())
    months = dear.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    kept = filters.in_months_of(event_sources.read_table(spark, path), months)
    return kept.select("account", "ts", "op", "year", "month")


def _order_sources(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An order is an event of its customer: its status is the opcode, its priority the subscriber."""
    return (
        event_sources.signalling_events(
            orders, account="o_custkey", ts="o_orderdate", op="o_orderstatus"
        ),
        event_sources.session_events(
            orders,
            account="o_custkey",
            ts="o_orderdate",
            code=F.lit(SUCCESS_CODE),
            rectype=F.lit(1),
            subscriber="o_orderpriority",
        ),
    )


def training_table_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four whole months of years of orders, for the customers with most orders."""
    signalling, sessions = _order_sources(_table(spark, sf_dir, "orders"))
    top = filters.top_accounts(signalling)
    return build.training_table(
        signalling, sessions, top, ORDERS_AS_OF, ts="ts", opcodes=STATUS_METRICS
    )


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored hourly table of orders to which dear urgent ones come late.

    The table after the addition is that of all orders.
    """
    orders, late = _table(spark, sf_dir, "orders"), F.coalesce(_dear(), F.lit(False))
    names = ("signalling", "sessions")
    paths = [scratch_path(spark, name) for name in names]
    stored = []
    for source, path in zip(_order_sources(orders.where(~late)), paths):
        schema, path = sinks.append_events(source, path, "first")
        stored.append(spark.read.schema(schema).parquet(path))
    hourly_path = scratch_path(spark, "hourly_by_month")
    sinks.write_hourly_months(hourly.hourly_metrics(*stored, opcodes=STATUS_METRICS), hourly_path)
    found = build.add_late_events(
        *paths,
        hourly_path,
        *_order_sources(orders.where(late)),
        load="late",
        opcodes=STATUS_METRICS,
    )
    return found.select("account", "hour", "day_of_week", "metric", "value")


def training_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights after one update from given ones, over all windows."""
    model = _given_model(spark, sf_dir, TINY_NET)
    folder = scratch_path(spark, "training_step")
    one_batch = replace(TINY_NET, batches=1, learning_rate=1e-2)
    dealt = deal_windows(_blocks(spark, sf_dir, TINY_NET), one_batch, 0, f"{folder}/windows")
    windows = hold(dealt.drop("batch"))
    adam = Adam.start(one_batch, pack(model.weights))
    trainer = Trainer(spark, model.weights, adam, initial_state(model.accounts), folder)
    trainer.step(windows, windows.agg(F.sum(F.size("starts"))).first()[0])
    windows.unpersist()
    moved = trainer.model()
    rows = [
        (name, i, j, float(w))
        for name, weight in moved.weights.items()
        for (i, j), w in np.ndenumerate(weight.reshape(len(weight), -1))
    ]
    shared = spark.createDataFrame(rows, "name string, i int, j int, weight double")
    accounts = moved.accounts.select(
        F.lit("account").alias("name"), F.col("id").alias("i"), F.posexplode("vec").alias("j", "weight")
    )
    return shared.unionByName(accounts).withColumn("weight", F.round("weight", 6))


def neighbour_report_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over embeddings whose weights follow the rule, with ids from the data."""
    ids = keys.label_table(_hourly(spark, sf_dir), "metric", "metric_int")
    report = forecasting.neighbour_report(spark, _given_model(spark, sf_dir, SMALL_NET), ids)
    return report.withColumn("cosine", F.round("cosine", 6))


def samples_csv_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and validation samples of 168 + 24 hours through a text export for each."""
    path = scratch_path(spark, "samples_csv_splits")
    split = build.split_samples(
        _hourly(spark, sf_dir), _accounts(spark, sf_dir), GRID, TRAIN, VALID, WINDOWS
    )
    sinks.write_samples_csv(split, path, LAGS, HORIZON)
    parts = [
        sample_files.read_samples_csv(spark, path, LAGS, HORIZON, name).withColumn("split", F.lit(name))
        for name in ("train", "valid")
    ]
    return _summary(parts[0].unionByName(parts[1]), "split")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hourly_opcode_counts": hourly_opcode_counts,
    "hourly_conditional_counts": hourly_conditional_counts,
    "hourly_distinct_subscribers": hourly_distinct_subscribers,
    "hourly_metrics": hourly_metrics,
    "top_accounts": top_accounts,
    "top_accounts_filter": top_accounts_filter,
    "last_months_filter": last_months_filter,
    "month_table_filter": month_table_filter,
    "training_table": training_table,
    "sql_file_query": sql_file_query,
    "encode_keys": encode_keys,
    "decode_keys": decode_keys,
    "key_grid": key_grid,
    "densify": densify,
    "series_lead": series_lead,
    "make_samples": make_samples,
    "samples_wide": samples_wide,
    "split_by_time": split_by_time,
    "spot_check": spot_check,
    "smape": smape,
    "score_by_account": score_by_account,
    "log_l2_loss": log_l2_loss,
    "embedding_lookup": embedding_lookup_query,
    "embedding_topk": embedding_topk_query,
    "embedding_pivots": embedding_pivots,
    "daily_subscribers": daily_subscribers,
    "shuffle_samples": shuffle_samples,
    "batches": batches,
    "fit_forecaster": fit_forecaster_query,
    "forecast": forecast_query,
    "score_stored": score_stored,
    "neighbour_report": neighbour_report,
    "forecast_given_weights": forecast_given_weights,
    "score_given_weights": score_given_weights,
    "forecast_stored_weights": forecast_stored_weights,
    "score_stored_weights": score_stored_weights,
    "training_gradient": training_gradient,
    "single_account_samples": single_account_samples,
    "single_account_forecaster": single_account_forecaster,
    "account_dictionary": account_dictionary,
    "csv_roundtrip": csv_roundtrip,
    "single_account_csv": single_account_csv,
    "samples_csv_roundtrip": samples_csv_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "events_roundtrip": events_roundtrip,
    "samples_roundtrip": samples_roundtrip,
    "hourly_of_windows": hourly_of_windows,
    "month_table_pruning": month_table_pruning,
    "late_events": late_events,
    "training_table_orders": training_table_orders,
    "training_step": training_step,
    "neighbour_report_given": neighbour_report_given,
    "samples_csv_splits": samples_csv_splits,
}
