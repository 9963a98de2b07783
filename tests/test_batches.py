import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hourcast.functions.time import add_hours, hour_literal
from hourcast.operators import batches
from hourcast.operators.series import make_samples
from hourcast.plans import build
from tests.conftest import START, at


def samples(spark, n=500):
    # A third of all samples belong to one account.
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 17).cast("int").alias("account_int"),
        (F.col("id") % 5).cast("int").alias("metric_int"),
        add_hours(hour_literal(START), F.col("id").cast("int")).alias("hour"),
    )
    return df


def positions(df):
    return {(r["account_int"], r["metric_int"], r["hour"]): r["position"] for r in df.collect()}


def test_positions_are_a_permutation_that_follows_the_seed(spark):
    df = samples(spark)
    one, again, other = (positions(batches.shuffle_samples(df, s)) for s in (1, 1, 2))
    assert sorted(one.values()) == list(range(500))
    assert one == again and one != other
    assert one == positions(batches.shuffle_samples(df.repartition(7), 1))
    in_order = sorted(one, key=one.get)
    assert in_order != sorted(one)


def test_exact_batches(spark):
    dealt = batches.batches(samples(spark), 120)
    sizes = {r["batch"]: r["count"] for r in dealt.groupBy("batch").count().collect()}
    assert sizes == {0: 120, 1: 120, 2: 120, 3: 120, 4: 20}


def test_take_batch(spark):
    ordered = batches.shuffle_samples(samples(spark)).cache()
    first = batches.take_batch(ordered, 200, 0)
    last = batches.take_batch(ordered, 200, 400)
    assert (first.count(), last.count()) == (200, 100)
    assert first.join(last, ["account_int", "metric_int", "hour"]).isEmpty()
    with pytest.raises(ValueError):
        batches.take_batch(ordered, 200, 500)


def test_window_batches_equal_sample_batches(spark):
    blocks = spark.createDataFrame(
        [(a, 2, START, 40) for a in range(3)],
        "account_int int, metric_int int, hour timestamp_ntz, n_windows int",
    )
    dealt = batches.window_batches(blocks, 4, seed=9)
    windows = dealt.select(
        "account_int", "metric_int", F.col("hour").alias("_from"), F.posexplode("batch").alias("i", "batch")
    ).select("account_int", "metric_int", add_hours("_from", F.col("i")).alias("hour"), "batch")
    assert windows.count() == 120
    assert windows.where(F.col("batch") != batches.batch_of(4, 9)).isEmpty()
    assert windows.select("batch").distinct().count() == 4


METRICS = {"m": 0, "n": 1}


def shuffled_blocks(spark, anchors=None, block_hours=20, seed=3):
    from hourcast.config import ForecastConfig

    hourly = spark.range(60).select(
        F.concat(F.lit("a"), F.col("id") % 3).alias("account"),
        add_hours(hour_literal(START), F.col("id").cast("int")).alias("hour"),
        F.lit("m").alias("metric"),
        F.col("id").alias("value"),
    )
    accounts = spark.createDataFrame([(f"a{i}", i) for i in range(3)], "account string, account_int int")
    config = ForecastConfig(lags=4, horizon=2)
    return build.window_blocks(
        hourly, accounts, (START, at(60)), anchors, config, METRICS, block_hours=block_hours, shuffled=seed
    )


@pytest.mark.parametrize("anchors", [None, [(START, at(7)), (at(30), at(41))]])
def test_positions_of_blocks_are_those_of_samples(spark, anchors):
    blocks = shuffled_blocks(spark, anchors)
    made = make_samples(blocks, 4, 2)
    expected = positions(batches.shuffle_samples(made.drop("position"), 3))
    assert positions(made) == expected
    assert sorted(expected.values()) == list(range(3 * 2 * (55 if anchors is None else 20)))
    dealt = batches.batches(made, 50)
    assert dealt.where(F.col("batch") != F.floor(F.col("position") / 50)).isEmpty()


def test_the_random_order_moves_no_values(spark):
    """Events are scanned once, and their arrays are not shuffled again after they are gathered."""
    plan = shuffled_blocks(spark)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("Range (0, 60") == 1 and "Cartesian" not in text and "NestedLoop" not in text
    lines = text.splitlines()
    # The block's arrays are made below the join; what lies between them and it must not move rows.
    join = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line and "block#" in line)
    gathered = next(k for k, line in enumerate(lines) if k > join and "cells#" in line and "Aggregate" in line)
    assert not [line for line in lines[join:gathered] if "Exchange" in line], text


def test_blocks_without_number_get_positions_by_hour(spark):
    blocks = shuffled_blocks(spark).drop("positions")
    keys = blocks.select("account_int", "metric_int", "hour", "n_windows")
    placed = batches.block_positions(keys, 3, "hour")
    joined = blocks.join(placed, ["account_int", "metric_int", "hour"])
    assert positions(make_samples(joined, 4, 2)) == positions(make_samples(shuffled_blocks(spark), 4, 2))


def test_windows_of_a_dimension_in_one_file_are_spread(spark, monkeypatch):
    taken_apart = []

    def shuffled(windows, seed):
        taken_apart.append(windows)
        return batches_shuffle(windows, seed)

    batches_shuffle = batches.shuffle_samples
    monkeypatch.setattr(batches, "shuffle_samples", shuffled)
    keys = spark.range(60).select(
        F.col("id").cast("int").alias("account_int"),
        F.lit(2).alias("metric_int"),
        F.lit(0).alias("block"),
        hour_literal(START).alias("hour"),
        F.lit(5).alias("n_windows"),
    )
    placed = batches.block_positions(keys.coalesce(1)).collect()
    assert sorted(p for r in placed for p in r["positions"]) == list(range(300))
    parts = taken_apart[0].groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 300


def key_blocks(spark, n=400, n_windows=50):
    return spark.range(n).select(
        (F.col("id") % 40).cast("int").alias("account_int"),
        F.floor(F.col("id") / 40).cast("int").alias("metric_int"),
        F.lit(0).alias("block"),
        hour_literal(START).alias("hour"),
        F.lit(n_windows).alias("n_windows"),
    )


def test_packed_positions_are_those_of_rows(spark, monkeypatch):
    """Chunks of any size, and hashes that begin alike."""
    blocks = key_blocks(spark, 60, 30)
    starts = blocks.select(
        "account_int", "metric_int", F.col("hour").alias("_from"), F.posexplode(F.sequence(F.lit(0), F.lit(29)))
    )
    windows = starts.select("account_int", "metric_int", add_hours("_from", F.col("col")).alias("hour"))
    expected = positions(batches.shuffle_samples(windows, 5))
    assert sorted(expected.values()) == list(range(1_800))
    for packed in (7, 1 << 16):
        monkeypatch.setattr(batches, "PACKED", packed)
        placed = batches.block_positions(blocks, 5).collect()
        assert {
            (r["account_int"], r["metric_int"], at(i)): p for r in placed for i, p in enumerate(r["positions"])
        } == expected


def test_ranks_follow_all_bytes_of_the_hash():
    hashes = [bytes([1] * 15 + [last]) for last in (9, 200, 3)] + [bytes(16), bytes([255] * 16)]
    group = pa.table(
        {
            "chunk": pa.array([4, 5], pa.int64()),
            "range": pa.array([0, 0], pa.int32()),
            "n": pa.array([2, 3], pa.int32()),
            "places": [b"ab", b"cde"],
            "hashes": [b"".join(hashes[:2]), b"".join(hashes[2:])],
            "rows": pa.nulls(2, pa.binary()),
        }
    )
    ranks = batches._rank(group)["ranks"].to_pylist()
    assert np.frombuffer(b"".join(ranks), np.uint32).tolist() == [2, 3, 1, 0, 4]


def test_the_random_order_shuffles_few_bytes(spark, monkeypatch):
    """Rows of text hashes took some 66 bytes a window, sorted twice; packed they take 30."""
    n, keys = 400 * 500, key_blocks(spark, 400, 500)
    packs = batches._number_packed
    seen = []

    def numbered(hashed):
        spread = hashed.mapInArrow(batches._pack, batches.PACKS)
        sent = spread.select(F.length("places"), F.length("hashes"), F.length("rows")).toDF("p", "h", "r")
        seen.append(sent.agg(*[F.sum(F.coalesce(c, F.lit(0))) for c in "phr"]).first())
        return packs(hashed)

    monkeypatch.setattr(batches, "_number_packed", numbered)
    assert batches.block_positions(keys, 1).count() == 400
    p, h, r = seen[0]
    assert (p, h) == (2 * n, 16 * n) and r < 2 * n
