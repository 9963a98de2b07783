import random
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hourcast import session
from hourcast.functions.time import hour_literal, hour_of
from hourcast.operators.filters import in_hours, in_months_of, split_by_time
from hourcast.operators.hourly import hourly_metrics
from hourcast.operators.series import make_samples, samples_wide, series_blocks
from hourcast.plans import build
from hourcast.sources import accounts as account_files
from hourcast.sources import events, hourly, samples, sinks
from hourcast.sources.sql_file import run_sql_file
from tests.conftest import START, at, key_rows
from tests.test_series import METRICS, accounts, random_hourly

HOURLY = "account string, hour timestamp_ntz, day_of_week int, metric string, value bigint"


def hourly_rows(spark, names=("a", "b")):
    rows = [(a, h, h.isoweekday(), m, v) for a, h, m, v in random_hourly(20, names=names)]
    return spark.createDataFrame(rows, HOURLY)


def test_hourly_csv_keeps_account_text(spark, tmp_path):
    df = hourly_rows(spark, ("007", "7"))
    sinks.write_hourly_csv(df, str(tmp_path / "h"))
    again = hourly.read_hourly_csv(spark, str(tmp_path / "h"))
    assert again.dtypes == df.dtypes
    assert key_rows(again) == key_rows(df)


def test_hourly_csv_trims_and_ignores_the_header(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        '"some","other","names","are","here"\n"0071", 2017-07-01 05, 6, countUL, 3\n'
    )
    row = hourly.read_hourly_csv(spark, str(tmp_path / "h.csv")).first()
    assert row["account"] == "0071" and row["metric"] == "countUL" and row["value"] == 3
    assert row["hour"].hour == 5


def test_a_malformed_file_is_an_error(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b,c,d,e\nx,2017-07-01 05,6,countUL,many\n")
    with pytest.raises(Exception, match="MALFORMED"):
        hourly.read_hourly_csv(spark, str(tmp_path / "h.csv")).collect()


def test_single_account_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "hourstamp,week,day_of_week,metric,value\n2017-02-01 00, 5, 3, gtpv1sum, 12\n"
    )
    df = hourly.read_single_account_csv(spark, str(tmp_path / "s.csv"), "only")
    row = df.first()
    assert df.columns == ["account", "hour", "day_of_week", "metric", "value"]
    assert (row["account"], row["metric"], row["value"]) == ("only", "gtpv1sum", 12)


def test_accounts_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"accountid","accountname"\n"0093","Nu"\n"0017","Xi"\n')
    listed = account_files.read_accounts_csv(spark, str(tmp_path / "a.csv"))
    dim = account_files.account_dimension(listed)
    assert {(r["account"], r["account_int"], r["accountname"]) for r in dim.collect()} == {
        ("0017", 0, "Xi"),
        ("0093", 1, "Nu"),
    }
    account_files.write_accounts(dim, str(tmp_path / "dim"))
    again = account_files.read_accounts(spark, str(tmp_path / "dim"))
    assert key_rows(again.select(*dim.columns)) == key_rows(dim)


def test_hourly_parquet_is_replaced(spark, tmp_path):
    path = str(tmp_path / "h")
    df = hourly_rows(spark)
    for part in (df, df.where("account = 'a'")):
        sinks.write_hourly(part, path)
        assert key_rows(hourly.read_hourly(spark, path)) == key_rows(part)


def test_events_replace_only_their_months(spark, tmp_path):
    schema = "account string, ts timestamp_ntz, op string"
    path = str(tmp_path / "e")
    january, february = (at(5), "x"), (at(24 * 40), "y")
    sinks.write_events(spark.createDataFrame([("a", *january), ("a", *february)], schema), path)
    sinks.write_events(spark.createDataFrame([("b", at(24 * 41), "z")], schema), path)
    stored = events.signalling_events(
        events.read_table(spark, path), account="account", ts="ts", op="op"
    )
    assert stored.columns == ["account", "ts", "op", "year", "month"]
    assert {(r["account"], r["op"], r["month"]) for r in stored.collect()} == {
        ("a", "x", 1),
        ("b", "z", 2),
    }


def test_source_columns_by_their_raw_names(spark):
    raw = spark.sql(
        "SELECT '0001' AS accountid, timestamp'2024-01-01 00:30:00' AS stoptime, "
        "128 AS causecode, 1 AS recordtype, 262 AS imsi, 1 AS month, 2024 AS year"
    )
    df = events.session_events(raw)
    assert dict(df.dtypes) == {
        "account": "string", "ts": "timestamp_ntz", "code": "int", "rectype": "int",
        "subscriber": "string", "year": "int", "month": "int",
    }
    assert df.first()["ts"] == at(0.5)


def split(spark):
    hours = spark.createDataFrame(random_hourly(40), "account string, hour timestamp_ntz, metric string, value bigint")
    blocks = series_blocks(hours, accounts(spark), METRICS, START, at(40), 7)
    return split_by_time(
        make_samples(blocks, 5, 2), (at(0), at(9)), (at(20), at(25)), gap=7
    )


def test_samples_by_split(spark, tmp_path):
    df = split(spark)
    sinks.write_samples(df, str(tmp_path / "s"))
    for name in ("train", "valid"):
        stored = samples.read_samples(spark, str(tmp_path / "s"), name)
        assert key_rows(stored) == key_rows(df.where(F.col("split") == name).drop("split"))
    valid = samples.read_samples(spark, str(tmp_path / "s"), "valid")
    assert "split" in valid._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_samples_csv(spark, tmp_path):
    df = split(spark).where("split = 'train'").drop("split")
    sinks.write_samples_csv(df, str(tmp_path / "w"), 5, 2)
    again = samples.read_samples_csv(spark, str(tmp_path / "w"), 5, 2)
    assert key_rows(again) == key_rows(df)


def test_sql_file(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT account, :n AS n\nFROM {rows}\nWHERE account <> 'b'\n")
    df = run_sql_file(spark, tmp_path / "q.sql", {"n": 3}, rows=accounts(spark))
    assert key_rows(df) == [("a", 3)]


def test_scratch_paths_lie_in_the_shared_folder(spark):
    folder = session.checkpoint_dir(spark)
    assert session.checkpoint_dir(spark) == folder
    one, two = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert one != two and one.endswith("/x")
    assert one.startswith(folder.rstrip("/") + "/")


class FakeSession:
    """A session on a cluster, with or without a shared folder."""

    def __init__(self, folder):
        self.folder, self.master, self.set_to = folder, "yarn", None
        self.sparkContext, self.conf = self, self

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return self

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.folder

    def setCheckpointDir(self, folder):
        self.set_to = folder


def test_a_cluster_must_name_its_shared_folder():
    named = FakeSession("hdfs:///shared")
    assert session.checkpoint_dir(named) == named.set_to == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(FakeSession(None))


SIGNALLING = "account string, ts timestamp_ntz, op string"
SESSIONS = "account string, ts timestamp_ntz, code int, rectype int, subscriber string"
OPCODES = {"u": "countUL"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_events(spark, n, first_hour, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice("ab"), at(first_hour + rng.randrange(24 * 100)), rng.choice(["u", "x", None]), 128, rng.randrange(3), rng.choice("pqr"))
        for _ in range(n)
    ]
    signalling = spark.createDataFrame([(a, t, o) for a, t, o, *_ in rows], SIGNALLING)
    sessions = spark.createDataFrame([(a, t, c, r, s) for a, t, _, c, r, s in rows], SESSIONS)
    return signalling, sessions


def test_hours_are_a_range_on_the_timestamp_of_the_scan(spark, tmp_path):
    signalling, _ = random_events(spark, 500, 0, 1)
    plain, by_month = str(tmp_path / "plain"), str(tmp_path / "months")
    signalling.write.parquet(plain)
    sinks.write_events(signalling, by_month)
    ranges = [(at(30), at(40)), (at(24 * 40), at(24 * 41 + 5))]
    hour = hour_of("ts")
    wanted = signalling.where(reduce(or_, [hour.between(*map(hour_literal, r)) for r in ranges]))
    for path in (plain, by_month):
        raw = spark.read.parquet(path).withColumnRenamed("ts", "stoptime")
        kept = in_hours(events.signalling_events(raw, "account", "stoptime", "op"), ranges)
        assert key_rows(kept.select("account", "ts", "op")) == key_rows(wanted)
        text = plan_of(kept)
        assert "GreaterThanOrEqual(stoptime" in text or "GreaterThanOrEqual(ts" in text
        if path == by_month:
            assert "PartitionFilters: [" in text and "month#" in text[text.index("PartitionFilters") :][:300]
    assert in_hours(signalling, []).isEmpty()


def test_hours_of_windows_are_enough_for_them(spark):
    signalling, sessions = random_events(spark, 800, 0, 2)
    dim, grid = accounts(spark), (START, at(24 * 90))
    ranges = [(at(200), at(210)), (at(1_500), at(1_530))]
    metrics = {"countUL": 0, "mapsum": 1, "imsiSum": 2}
    few = build.hourly_of_windows(signalling, sessions, dim, grid, ranges, 12, OPCODES)
    every = hourly_metrics(signalling, sessions, OPCODES)
    assert 0 < few.count() < every.count()
    one, two = (
        make_samples(series_blocks(table, dim, metrics, *grid, 12, ranges), 8, 4) for table in (few, every)
    )
    assert one.count() == 2 * 3 * 42 and one.exceptAll(two).isEmpty()


def test_a_month_table_prunes_folders_while_running(spark, tmp_path):
    signalling, _ = random_events(spark, 300, 0, 3)
    sinks.write_events(signalling, str(tmp_path / "e"))
    months = spark.createDataFrame([(2024, 2), (2024, 2), (None, 3), (2024, 13)], "year int, month int")
    kept = in_months_of(spark.read.parquet(str(tmp_path / "e")), months)
    assert "dynamicpruning" in plan_of(kept)
    assert key_rows(kept.select("account", "ts", "op")) == key_rows(signalling.where("month(ts) = 2"))


def test_late_events_give_the_table_of_all_events(spark, tmp_path):
    early, late = random_events(spark, 400, 0, 4), random_events(spark, 30, 24 * 40, 5)
    late = tuple(part.where(F.col("ts") < F.lit(at(24 * 55)).cast("timestamp_ntz")) for part in late)
    paths = [str(tmp_path / name) for name in ("signalling", "sessions", "hourly")]
    for part, path in zip(early, paths):
        sinks.append_events(part, path, "first")
    sinks.write_hourly_months(hourly_metrics(*early, opcodes=OPCODES), paths[2])
    before = spark.read.parquet(paths[2]).inputFiles()
    expected = key_rows(hourly_metrics(*(a.unionByName(b) for a, b in zip(early, late)), opcodes=OPCODES))
    for _ in range(2):  # a load that is run again counts once
        found = build.add_late_events(*paths, *late, load="late", opcodes=OPCODES)
        assert key_rows(found.select("account", "hour", "day_of_week", "metric", "value")) == expected
    after = set(spark.read.parquet(paths[2]).inputFiles())
    january = [f for f in before if "month=1/" in f]
    assert january and set(january) <= after and not set(before) <= after


def test_splits_as_text_exports(spark, tmp_path):
    blocks = series_blocks(hourly_rows(spark), accounts(spark), METRICS, START, at(20), 6)
    split = split_by_time(make_samples(blocks, 4, 2), (START, at(3)), (at(9), at(14)), 6)
    sinks.write_samples_csv(split, str(tmp_path / "s"), 4, 2)
    for name in ("train", "valid"):
        again = samples.read_samples_csv(spark, str(tmp_path / "s"), 4, 2, name)
        expected = split.where(F.col("split") == name).drop("split")
        assert again.count() == expected.count() > 0
        assert key_rows(again.select("account_int", "metric_int", "hour")) == key_rows(
            expected.select("account_int", "metric_int", "hour")
        )


def test_samples_of_840_columns_as_text(spark, tmp_path):
    """672 + 168 hours, the layout's own width."""
    hourly_table = spark.createDataFrame(
        [("a", at(h), at(h).isoweekday(), "m", h + 1) for h in range(842)], HOURLY
    )
    blocks = series_blocks(hourly_table, accounts(spark, ["a"]), {"m": 0}, START, at(842), 840)
    sinks.write_samples_csv(make_samples(blocks, 672, 168), str(tmp_path / "s"), 672, 168)
    assert len(spark.read.csv(str(tmp_path / "s"), header=True).columns) == 844
    rows = samples.read_samples_csv(spark, str(tmp_path / "s"), 672, 168).orderBy("hour").collect()
    assert [r["hour"] for r in rows] == [at(h) for h in range(3)]
    for k, r in enumerate(rows):
        assert r["x"] == [float(k + i + 1) for i in range(672)]
        assert r["y"] == [float(k + i + 1) for i in range(672, 840)]


def test_text_exports_are_small(spark, tmp_path):
    """Windows repeat each value: as plain text these take a hundred times the room."""
    blocks = series_blocks(hourly_rows(spark), accounts(spark), METRICS, START, at(400), 192)
    sinks.write_samples_csv(make_samples(blocks, 168, 24), str(tmp_path / "s"), 168, 24)
    stored = samples.read_samples_csv(spark, str(tmp_path / "s"), 168, 24)
    cells = stored.count() * 192
    assert cells > 100_000
    assert sum(f.stat().st_size for f in (tmp_path / "s").rglob("part-*")) < cells


def test_splits_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """A sort by split would spill every sample; the session's setting comes back."""
    blocks = series_blocks(hourly_rows(spark), accounts(spark), METRICS, START, at(20), 6)
    split = split_by_time(make_samples(blocks, 4, 2), (START, at(3)), (at(9), at(14)), 6)
    before, seen = spark.conf.get(sinks.WRITERS), []
    plain = type(split.write).parquet

    def parquet(writer, path):
        seen.append(int(spark.conf.get(sinks.WRITERS)))
        return plain(writer, path)

    monkeypatch.setattr(type(split.write), "parquet", parquet)
    sinks.write_samples(split, str(tmp_path / "s"))
    assert seen and seen[0] >= 2 and spark.conf.get(sinks.WRITERS) == before
    again = samples.read_samples(spark, str(tmp_path / "s"))
    assert key_rows(again.select(*split.columns)) == key_rows(split)


SAMPLES = "account_int int, metric_int int, hour timestamp_ntz, dayofweek int, x array<float>, y array<float>, split string"
ODD = [0.0, -0.0, 3.0, 1e7, 9_999_999.0, 0.00123, 9.99e-4, 1.1920929e-07, 2e8, -2.5e-10, 123456.79, float("inf"), float("-inf")]


def odd_samples(spark):
    """Neighbouring windows, repeated ones, ones that follow nothing, nulls and odd numbers."""
    rng = random.Random(7)
    cells = [rng.choice(ODD) for _ in range(40)]
    windows = [(0, 0, at(h), 0, cells[h : h + 4], cells[h + 4 : h + 6]) for h in range(30)]
    windows += windows[3:5] + [(1, None, at(9), 2, [1.0, None, 2.0, 3.0], [None, 5.0])]
    windows += [(2, 1, at(h), 1, [rng.choice(ODD) for _ in range(4)], [1.5, float("nan")]) for h in range(5)]
    rows = [(*w, "train" if k % 11 < 7 else "valid") for k, w in enumerate(windows)]
    return spark.createDataFrame(rows, SAMPLES).coalesce(2)


def test_lines_of_text_are_those_of_plain_csv(spark, tmp_path):
    df = odd_samples(spark)
    sinks.write_samples_csv(df, str(tmp_path / "s"), 4, 2)
    plain = samples_wide(df, 4, 2).withColumn("hour", F.date_format("hour", sinks.HOUR_TEXT))
    plain.write.partitionBy("split").csv(str(tmp_path / "plain"), header=True)
    ours, theirs = (
        sorted((r["split"], r["value"]) for r in spark.read.text(str(tmp_path / name)).distinct().collect())
        for name in ("s", "plain")
    )
    assert ours == theirs
    for name in ("train", "valid"):
        again = samples.read_samples_csv(spark, str(tmp_path / "s"), 4, 2, name)
        expected = df.where(F.col("split") == name).drop("split")
        assert again.dtypes == expected.dtypes
        assert repr(key_rows(again)) == repr(key_rows(expected))  # NaN equals nothing


def test_neighbouring_lines_are_cut_from_one_text():
    """Of 1,000 windows of 192 hours a task writes each value down once, not 192 times."""
    values = np.random.default_rng(0).integers(0, 50, 1_191).astype(np.float32)
    windows = np.lib.stride_tricks.sliding_window_view(values, 192)
    x, y = (pa.array(list(w), pa.list_(pa.float32())) for w in (windows[:, :168], windows[:, 168:]))
    part = pa.record_batch({"key": pa.array(["k,"] * 1_000), "x": x, "y": y})
    head, found = sinks._lines("h", 168, 24, False)(iter([part]))
    assert head["text"].to_pylist() == [b"h"] and found.num_rows == 1
    assert len(found["text"][0].as_py()) < 10 * 1_191
    text, row = found["text"][0].as_py(), {c: found[c][0].as_py() for c in ("low", "size")}
    lines = [text[a : a + n].decode() for a, n in zip(row["low"], row["size"])]
    assert lines == [",".join(map(str, map(float, w))) for w in windows]


def test_text_samples_of_other_writers(spark, tmp_path):
    """The first line of each file is its header whatever it says; blank lines are none."""
    (tmp_path / "one.csv").write_text('\nsome,names\n1,2,"2024-01-01 05",0,1.5,2\n\n1,2,2024-01-01 06,0,2,\n')
    (tmp_path / "two.csv").write_text("h\n3,,2024-01-01 07,0, 1e3,NaN\n")
    rows = samples.read_samples_csv(spark, str(tmp_path), 1, 1).orderBy("hour").collect()
    assert [(r["account_int"], r["metric_int"], r["hour"], r["x"]) for r in rows] == [
        (1, 2, at(5), [1.5]),
        (1, 2, at(6), [2.0]),
        (3, None, at(7), [1000.0]),
    ]
    assert [r["y"] for r in rows[:2]] == [[2.0], [None]] and rows[2]["y"][0] != rows[2]["y"][0]
    for k, odd in enumerate(["1,2,2024-01-01 05,0,1", "1,2,2024-01-01 05,0,1,2,3", "1,2,2024-01-01 05,0,1,many"]):
        (tmp_path / f"odd{k}").mkdir()
        (tmp_path / f"odd{k}" / "s.csv").write_text(f"h\n{odd}\n")
        with pytest.raises(Exception, match="MALFORMED|conversion error"):
            samples.read_samples_csv(spark, str(tmp_path / f"odd{k}"), 1, 1).collect()
