import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fixtures.queries import _summary
from hourcast.config import EPS
from hourcast.functions.arrow import totals
from hourcast.operators import metrics

SCHEMA = "account_int int, y array<float>, yhat array<float>"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_perfect_and_opposite_forecasts(spark):
    same = frame(spark, [(0, [1.0, 2.0], [1.0, 2.0])])
    assert tuple(metrics.smape(same).first()) == (0.0, 2)
    flipped = frame(spark, [(0, [1.0, 2.0], [-1.0, -2.0])])
    assert metrics.smape(flipped).first()["smape"] == 200.0


def test_zero_against_zero_is_no_error(spark):
    assert metrics.smape(frame(spark, [(0, [0.0], [0.0])])).first()["smape"] == 0.0


def test_smape_weighs_cells_not_rows(spark):
    df = frame(spark, [(0, [1.0], [3.0]), (1, [1.0, 1.0, 1.0], [1.0, 1.0, 1.0])])
    assert metrics.smape(df).first()["smape"] == pytest.approx(200 * 0.5 / 4)
    by = {r["account_int"]: r["smape"] for r in metrics.smape(df, ["account_int"]).collect()}
    assert by == {0: 100.0, 1: 0.0}


def test_scores_carry_account_and_name(spark):
    df = frame(spark, [(0, [1.0], [3.0]), (5, [1.0], [1.0])])
    dim = spark.createDataFrame([("a", 0, "Alpha")], "account string, account_int int, accountname string")
    rows = {r["account_int"]: r for r in metrics.score_by_account(df, dim).collect()}
    assert (rows[0]["account"], rows[0]["accountname"], rows[0]["smape"]) == ("a", "Alpha", 100.0)
    assert rows[5]["account"] is None


def test_log_l2_loss_is_half_a_sum(spark):
    df = frame(spark, [(0, [1.0, math.e], [math.e, 1.0]), (1, [1.0], [1.0])])
    row = metrics.log_l2_loss(df).first()
    assert row["loss"] == pytest.approx(1.0, abs=1e-6) and row["n"] == 3
    gap = frame(spark, [(0, [EPS], [1.0])])
    assert metrics.log_l2_loss(gap).first()["loss"] == pytest.approx(math.log(EPS) ** 2 / 2)



def test_totals_of_lists():
    rows = [[0.5, 0.25, EPS], [], None, [1.0, None, 2.0], [float("nan")], [1e8, 1.0, 3.0, -1e8]]
    column = pa.array(rows, pa.list_(pa.float32()))
    for part in (column, column.slice(1, 4), column.slice(2, 0)):
        got, cells = totals(part).to_pylist(), part.to_pylist()
        assert len(got) == len(cells)
        for total, row in zip(got, cells):
            if row is None or None in row:
                assert total is None
            else:
                assert total == sum(row, 0.0) or math.isnan(total) and math.isnan(sum(row, 0.0))


def test_summary_sums_without_a_call_for_each_cell(spark):
    rows = [(0, 1, [0.5] * 168, [EPS] * 24), (1, 1, [1.0] * 167 + [None], [3.0] * 24), (2, 1, None, [])]
    schema = "account_int int, metric_int int, x array<float>, y array<float>"
    samples = spark.createDataFrame(rows, schema).withColumns(
        {"hour": F.lit("2024-01-01").cast("timestamp_ntz"), "dayofweek": F.lit(0)}
    )
    summary = _summary(samples)
    assert "lambda" not in summary._jdf.queryExecution().executedPlan().toString()
    got = summary.orderBy("account_int").select("x_first", "x_sum", "y_sum", "y_last").collect()
    assert [tuple(r) for r in got] == [
        (0.5, 84.0, round(24 * EPS, 6), EPS), (1.0, None, 72.0, 3.0), (None, None, 0.0, None)
    ]


def test_totals_of_windows_add_whole_rows(monkeypatch):
    """Lists of one length are added in the order of their cells without a search for each place."""
    rng = np.random.default_rng(1)
    cells = (rng.normal(size=300 * 168) * 10.0 ** rng.integers(-8, 8, 300 * 168)).astype(np.float32)
    part = pa.ListArray.from_arrays(pa.array(np.arange(301) * 168, pa.int32()), pa.array(cells))

    def in_order(row):
        total = 0.0
        for cell in row:
            total += cell
        return total

    monkeypatch.setattr(np, "flatnonzero", None)
    for column in (part, part.slice(7, 200), part.slice(5, 1)):
        assert totals(column).to_pylist() == [in_order(row) for row in column.to_pylist()]
