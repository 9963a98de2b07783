import pytest
from pyspark.sql import functions as F

from hourcast.functions.time import hour_literal
from hourcast.operators import keys
from hourcast.operators.series import densify, key_grid
from hourcast.sources.accounts import account_dimension
from tests.conftest import START, at, key_rows


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "account string")


def test_ids_are_dense_and_in_key_order(spark):
    ids = keys.dense_ids(frame(spark, ["b", "007", "a", "b", None, "7"]), "account", "i")
    assert key_rows(ids) == [("007", 0), ("7", 1), ("a", 2), ("b", 3)]


@pytest.mark.parametrize("drawn", [8, 64])
def test_many_ranges_give_the_same_ids(spark, monkeypatch, drawn):
    monkeypatch.setattr(keys, "SAMPLE_KEYS", drawn)
    monkeypatch.setattr(keys, "RANGES", 8)
    # Most keys share a prefix, so ranges cut by prefix would not balance.
    names = [f"hot-{i:05d}" for i in range(900)] + [f"{i}" for i in range(100)]
    ids = keys.dense_ids(frame(spark, names * 2), "account", "i")
    assert key_rows(ids) == [(n, i) for i, n in enumerate(sorted(names))]


def test_no_keys(spark):
    assert keys.dense_ids(frame(spark, [None]), "account", "i").isEmpty()


def test_unmapped_keys_encode_to_null_and_decode_back(spark):
    accounts = spark.createDataFrame([("a", 0), ("b", 1)], "account string, account_int int")
    rows = [("a", "mapsum", 1), ("b", "countUL", 2), ("z", "mapsum", 3), ("a", "unknown", 4)]
    hourly = spark.createDataFrame(rows, "account string, metric string, value int")
    metrics = {"countUL": 0, "mapsum": 5}
    encoded = keys.encode_keys(hourly, accounts, metrics)
    got = {r["value"]: (r["account_int"], r["metric_int"]) for r in encoded.collect()}
    assert got == {1: (0, 5), 2: (1, 0), 3: (None, 5), 4: (0, None)}
    bare = encoded.select("account_int", "metric_int", "value").dropna()
    decoded = keys.decode_keys(bare, accounts, metrics)
    assert {(r["account"], r["metric"], r["value"]) for r in decoded.collect()} == set(rows[:2])


def test_an_account_listed_twice_is_an_error(spark):
    listed = spark.createDataFrame([("a", "x"), ("a", "y")], "account string, accountname string")
    with pytest.raises(Exception, match="listed twice"):
        account_dimension(listed).collect()


def test_label_table(spark):
    found = keys.label_table(frame(spark, ["y", "x", "y", None]), "account", "id")
    assert key_rows(found) == [("x", 0), ("y", 1)]
    assert keys.n_labels(found) == 2 and keys.n_labels({"a": 0}) == 1


def test_a_table_gives_what_a_dictionary_gives(spark):
    ids = {"x": 0, "y": 1, "z": 2}
    table = spark.createDataFrame(list(ids.items()), "metric string, metric_int int")
    rows = spark.createDataFrame([("x",), ("q",), ("z",), (None,)], "metric string")
    for keep in (True, False):
        one, two = (keys.with_ids(rows, m, "metric", "metric_int", keep) for m in (ids, table))
        assert key_rows(one.select("metric", "metric_int")) == key_rows(two.select("metric", "metric_int"))
    numbers = spark.createDataFrame([(0,), (2,), (7,)], "metric_int int")
    one, two = (keys.with_labels(numbers, m, "metric_int", "metric") for m in (ids, table))
    assert key_rows(one) == key_rows(two.select("metric_int", "metric"))
    arrays = [spark.range(1).select(keys.all_ids(m, "metric_int")).first()[0] for m in (ids, table)]
    assert arrays == [[0, 1, 2]] * 2


def test_many_labels_stay_a_table(spark):
    """20,000 metrics: numbered, put on a grid and decoded by joins."""
    n = 20_000
    hourly = spark.range(n).select(
        F.concat(F.lit("a"), F.col("id") % 1).alias("account"),
        hour_literal(START).alias("hour"),
        F.format_string("m%05d", "id").alias("metric"),
        (F.col("id") + 1).alias("value"),
    )
    accounts = spark.createDataFrame([("a0", 0)], "account string, account_int int")
    metrics = keys.label_table(hourly, "metric", "metric_int")
    dense = densify(hourly, accounts, metrics, START, at(2))
    plan = dense._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "m00007" not in plan
    decoded = keys.decode_keys(dense, accounts, metrics)
    first = decoded.where(F.col("hour") == hour_literal(START))
    assert decoded.count() == 2 * n
    assert first.where(F.substring("metric", 2, 5).cast("int") + 1 != F.col("value")).isEmpty()
    grid = key_grid(accounts, metrics, START, at(1))
    assert grid.count() == n and grid.where("metric is null").isEmpty()
