from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from fixtures import queries as contract
from hourcast.config import METRIC_IDS
from hourcast.functions.time import add_hours, hour_literal
from hourcast.operators import filters, hourly
from tests.conftest import START, at, key_rows

SF = "/root/testdata/sf0.001"


def signalling(spark, rows):
    return spark.createDataFrame(rows, "account string, ts timestamp_ntz, op string")


def sessions(spark, rows):
    return spark.createDataFrame(
        rows, "account string, ts timestamp_ntz, code int, rectype int, subscriber string"
    )


def test_null_opcodes_count_nowhere_and_unnamed_only_in_the_total(spark):
    df = signalling(
        spark,
        [
            ("a", at(0.1), "updateLocation"),
            ("a", at(0.2), "updateLocation"),
            ("a", at(0.3), "other"),
            ("a", at(0.4), None),
            ("a", at(1.0), None),
            ("b", at(1.0), "other"),
        ],
    )
    assert key_rows(hourly.hourly_opcode_counts(df)) == sorted(
        [
            ("a", at(0), "countUL", 2),
            ("a", at(0), "mapsum", 3),
            ("b", at(1), "mapsum", 1),
        ],
        key=repr,
    )


def test_two_opcodes_may_not_share_a_metric(spark):
    with pytest.raises(ValueError):
        hourly.hourly_opcode_counts(signalling(spark, []), {"x": "countUL", "y": "countUL"})


def test_conditional_counts_keep_zero_and_null_codes(spark):
    df = sessions(
        spark,
        [
            ("a", at(0), 128, 1, "s1"),
            ("a", at(0), 128, 1, "s1"),
            ("a", at(0), 16, 1, "s2"),
            ("a", at(2), None, None, None),
        ],
    )
    assert key_rows(hourly.hourly_conditional_counts(df)) == sorted(
        [
            ("a", at(0), "createPdpCountV1", 2),
            ("a", at(0), "deletePdpCountV1", 0),
            ("a", at(2), "createPdpCountV1", 0),
            ("a", at(2), "deletePdpCountV1", 0),
        ],
        key=repr,
    )
    assert key_rows(hourly.hourly_distinct_subscribers(df)) == sorted(
        [("a", at(0), "imsiSum", 2), ("a", at(2), "imsiSum", 0)], key=repr
    )


def test_one_aggregate_equals_the_separate_branches(spark):
    df = contract._sessions(spark, SF)
    fused = hourly.hourly_session_metrics(df)
    apart = hourly.hourly_conditional_counts(df).unionByName(hourly.hourly_distinct_subscribers(df))
    assert fused.exceptAll(apart).isEmpty() and apart.exceptAll(fused).isEmpty()


def test_columns_of_one_aggregate_equal_a_rollup(spark):
    df = contract._signalling(spark, SF)
    ops = F.create_map(*[F.lit(p) for item in contract.OPCODES.items() for p in item])
    rolled = (
        df.where("op IS NOT NULL")
        .withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
        .groupingSets([["account", "hour", "op"], ["account", "hour"]], "account", "hour", "op")
        .agg(F.count("*").alias("value"), F.grouping("op").alias("g"))
        .select(
            "account",
            "hour",
            F.when(F.col("g") == 1, "mapsum").otherwise(F.try_element_at(ops, F.col("op"))).alias("metric"),
            "value",
        )
        .where("metric IS NOT NULL")
    )
    ours = hourly.hourly_opcode_counts(df, contract.OPCODES)
    assert ours.exceptAll(rolled).isEmpty() and rolled.exceptAll(ours).isEmpty()


def test_hourly_table_has_unique_keys_and_total_covers_the_named(spark):
    table = contract._hourly(spark, SF).cache()
    assert table.count() == table.select("account", "hour", "metric").distinct().count()
    assert table.exceptAll(table.distinct()).isEmpty()
    assert {r[0] for r in table.select("metric").distinct().collect()} == set(METRIC_IDS)
    named, total = defaultdict(int), {}
    for row in table.collect():
        key = (row["account"], row["hour"])
        if row["metric"] == "mapsum":
            total[key] = row["value"]
        elif row["metric"] in contract.OPCODES.values():
            named[key] += row["value"]
    assert all(total[key] >= n for key, n in named.items())


def test_ordered_table_is_sorted(spark):
    rows = [
        (r["hour"], r["account"], r["metric"])
        for r in contract.hourly_metrics(spark, SF).collect()
    ]
    assert rows == sorted(rows)


def test_frame_and_sql_file_agree(spark):
    ours, text = contract.training_table(spark, SF), contract.sql_file_query(spark, SF)
    assert ours.exceptAll(text).isEmpty() and text.exceptAll(ours).isEmpty()


def test_top_accounts_break_ties_by_account(spark):
    rows = [(a, at(i), "x") for i, a in enumerate(["b", "a", "c", "c", None, None, None])]
    top = filters.top_accounts(signalling(spark, rows), 2)
    assert [tuple(r) for r in top.collect()] == [("c", 2), ("a", 1)]


def test_empty_account_list_keeps_nothing(spark):
    df = signalling(spark, [("a", at(0), "x")])
    assert filters.keep_accounts(df, df.where("false")).isEmpty()


def test_month_filters_agree_and_prune(spark, tmp_path):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderdate")
    day = date(2000, 3, 15)
    by_time = filters.last_months(orders, day, ts="o_orderdate")
    dated = orders.withColumn("year", F.year("o_orderdate")).withColumn("month", F.month("o_orderdate"))
    dated.write.partitionBy("year", "month").parquet(str(tmp_path / "orders"))
    stored = spark.read.parquet(str(tmp_path / "orders"))
    by_month = filters.last_months(stored, day)
    months = spark.createDataFrame([(1999, 11), (1999, 12), (2000, 1), (2000, 2), (2000, 2)], "year int, month int")
    by_table = filters.in_months_of(stored, months)
    expected = {r[0] for r in by_time.select("o_orderkey").collect()}
    assert expected
    for df in (by_month, by_table):
        assert {r[0] for r in df.select("o_orderkey").collect()} == expected
    plan = by_month._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(o_orderdate" in by_time._jdf.queryExecution().executedPlan().toString()


def test_no_months_keep_nothing(spark):
    df = spark.createDataFrame([(2024, 1)], "year int, month int")
    assert df.where(filters.in_months([])).isEmpty()


def test_split_needs_its_gap(spark):
    samples = spark.createDataFrame([(at(i),) for i in range(100)], "hour timestamp_ntz")
    split = filters.split_by_time(samples, (at(0), at(9)), (at(30), at(39)), gap=21)
    counts = {(r["split"], r["count"]) for r in split.groupBy("split").count().collect()}
    assert counts == {("train", 10), ("valid", 10)}
    with pytest.raises(ValueError):
        filters.split_by_time(samples, (at(0), at(9)), (at(30), at(39)), gap=22)


def test_daily_subscribers_from_hourly_sketches(spark):
    """Merged sketches stay within three standard errors of the exact count; small counts are exact."""
    rows = spark.range(40_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 5)).alias("account"),
        add_hours(hour_literal(START), (F.col("id") % 48).cast("int")).alias("ts"),
        F.lit(128).alias("code"),
        F.lit(1).alias("rectype"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("s"), F.col("id") % 30_000)).alias("subscriber"),
    )
    few = rows.where("id < 300")
    for events, allowed in ((rows, 3 * hourly.sketch_error()), (few, 0.0)):
        sketches = hourly.hourly_subscriber_sketches(events)
        day = F.to_date("hour").alias("day")
        merged = hourly.merged_subscribers(sketches, F.col("account"), day)
        exact = events.groupBy("account", F.to_date("ts").alias("day")).agg(
            F.count_distinct("subscriber").alias("exact")
        ).where("exact > 0")
        both = merged.join(exact, ["account", "day"], "full").collect()
        assert len(both) == exact.count()
        for r in both:
            assert abs(r["subscribers"] - r["exact"]) <= allowed * r["exact"]
