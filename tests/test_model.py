from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.config import MULTI_ACCOUNT, SINGLE_ACCOUNT, ForecastConfig
from hourcast.functions import network
from hourcast.operators import model as models
from hourcast.operators import training
from hourcast.operators.metrics import log_l2_loss, smape
from hourcast.operators.series import make_samples, series_blocks
from hourcast.plans import build, forecasting
from tests.conftest import START, at

SMALL = ForecastConfig(
    account_dim=3,
    metric_dim=2,
    weekday_dim=2,
    relu_width=4,
    lags=6,
    horizon=3,
    learning_rate=1e-2,
    batches=2,
    sub_steps=4,
    stop_below=None,
    check_every=2,
)
METRICS = {"m": 0, "n": 1}
HOURS = 60


@pytest.fixture(scope="module")
def accounts(spark):
    return spark.createDataFrame(
        [(f"a{i}", i) for i in range(4)], "account string, account_int int"
    ).cache()


@pytest.fixture(scope="module")
def hourly(spark):
    rng = np.random.default_rng(4)
    rows = [
        (f"a{a}", at(h), m, int(rng.poisson(20 * (a + 1) * (1.5 + np.sin(h / 4)))))
        for a in range(4)
        for m in METRICS
        for h in range(HOURS)
    ]
    return spark.createDataFrame(
        rows, "account string, hour timestamp_ntz, metric string, value bigint"
    ).cache()


@pytest.fixture(scope="module")
def blocks(hourly, accounts):
    return series_blocks(hourly, accounts, METRICS, START, at(HOURS), SMALL.width, block_hours=20).cache()


def fit(blocks, accounts, config=SMALL, **kwargs):
    return training.fit_forecaster(blocks, blocks, accounts, len(METRICS), config, **kwargs)


def trail(history):
    return [tuple(r) for r in history.orderBy("batch", "sub_step").collect()]


def random_batch(config, n=40, seed=0):
    rng = np.random.default_rng(seed)
    batch = network.Batch(
        rng.integers(0, 4, n),
        rng.integers(0, 2, n),
        rng.integers(400_000, 500_000, n),
        rng.normal(size=(n, config.lags)),
        rng.normal(size=(n, config.horizon)),
    )
    return batch, rng.uniform(-1, 1, (n, config.account_dim))


def n_parameters(config, n_accounts, n_metrics):
    sizes = [int(np.prod(s)) for s in network.shapes(config, n_metrics).values()]
    return sum(sizes) + n_accounts * config.account_dim


def test_parameter_counts():
    assert n_parameters(MULTI_ACCOUNT, 100, 8) == 584_728
    assert n_parameters(SINGLE_ACCOUNT, 1, 9) == 578_080


def test_initial_weights():
    weights = network.initial_weights(MULTI_ACCOUNT, 8, 0)
    assert np.abs(weights["wide"]).max() <= 0.2 and 0.08 < weights["wide"].std() < 0.1
    assert (weights["out_bias"] == 0.1).all()
    assert -1 <= weights["metric"].min() < 0 < weights["metric"].max() <= 1


@pytest.mark.parametrize("config", [SMALL, replace(SMALL, account_dim=0)])
def test_gradient_agrees_with_differences(config):
    weights = network.initial_weights(config, 2, 1)
    batch, account = random_batch(config)
    _, grads, by_account = network.gradient(weights, batch, account)
    assert sorted(grads) == sorted(weights)
    step = 1e-6

    def slope(vary):
        up, down = (network.gradient(*vary(s))[0] for s in (step, -step))
        return (up - down) / (2 * step)

    rng = np.random.default_rng(2)
    for name, w in weights.items():
        for _ in range(4):
            cell = tuple(rng.integers(0, s) for s in w.shape)

            def vary(s, name=name, cell=cell):
                moved = {k: v.copy() for k, v in weights.items()}
                moved[name][cell] += s
                return moved, batch, account

            assert grads[name][cell] == pytest.approx(slope(vary), rel=1e-4, abs=1e-4), name
    if config.account_dim:

        def vary(s):
            moved = account.copy()
            moved[7, 1] += s
            return weights, batch, moved

        assert by_account[7, 1] == pytest.approx(slope(vary), rel=1e-4, abs=1e-4)


def test_weekday_of_hours():
    hours = np.array([at(h) for h in range(0, 400, 7)], "datetime64[h]").astype(np.int64)
    batch = network.Batch(hours, hours, hours, hours, None)
    assert batch.weekday.tolist() == [at(h).weekday() for h in range(0, 400, 7)]


def test_unknown_activation():
    with pytest.raises(ValueError, match="softmax"):
        network.activation("softmax")
    for name in ("relu", "sigmoid", "tanh"):
        apply, slope = network.activation(name)
        x = np.array([-1.3, 0.7])
        numeric = (apply(x + 1e-6) - apply(x - 1e-6)) / 2e-6
        assert slope(apply(x)) == pytest.approx(numeric, abs=1e-6)


def test_adam_by_the_book():
    """m and v corrected for their start at 0, the usual way of writing it."""
    config = replace(SMALL, learning_rate=0.05)
    adam = training.Adam.start(config, np.array([1.0, -2.0, 3.0]))
    rng, w, m, v = np.random.default_rng(3), np.array([1.0, -2.0, 3.0]), 0.0, 0.0
    for t in range(1, 6):
        g = rng.normal(size=3) * 10
        adam.update(g)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.05 * (m / (1 - 0.9**t)) / np.sqrt(v / (1 - 0.999**t))
        assert adam.value == pytest.approx(w, rel=1e-6)


def test_pack_is_undone_by_unpack():
    weights = network.initial_weights(SMALL, 2, 0)
    again = network.unpack(network.pack(weights), weights)
    assert all((again[k] == weights[k]).all() for k in weights)


def test_training_lowers_the_loss(blocks, accounts):
    config = replace(SMALL, batches=1, sub_steps=30, check_every=100)
    _, history = fit(blocks, accounts, config)
    rows = trail(history)
    assert [r[:2] for r in rows] == [(0, 0), (0, 29)]
    assert rows[1][2] < rows[0][2] / 2 and rows[1][3] < rows[0][3]


# Computed in double, to tell a wrong sum from rounding.
EXACT = replace(SMALL, precision="float64")


def test_history_and_spread_of_windows(blocks, accounts, hourly):
    """The same training from blocks of any size, from samples, however spread."""
    _, history = fit(blocks, accounts, EXACT)
    expected = trail(history)
    assert [r[:2] for r in expected] == [(0, 0), (0, 2), (0, 3), (1, 0), (1, 2), (1, 3)]
    whole = series_blocks(hourly, accounts, METRICS, START, at(HOURS), SMALL.width)
    for windows in (whole, make_samples(blocks, SMALL.lags, SMALL.horizon)):
        for got, want in zip(trail(fit(windows, accounts, EXACT)[1]), expected, strict=True):
            assert got == pytest.approx(want, rel=1e-6)


def test_single_precision_is_close(blocks, accounts):
    exact = trail(fit(blocks, accounts, EXACT)[1])
    for got, want in zip(trail(fit(blocks, accounts)[1]), exact, strict=True):
        assert got == pytest.approx(want, rel=1e-4)


def test_account_without_vector_is_an_error(blocks, accounts):
    known = accounts.where("account_int = 0")
    with pytest.raises(ValueError, match="no vector"):
        fit(blocks, known)
    fitted, _ = fit(blocks, accounts, replace(SMALL, batches=1, sub_steps=1))
    short = models.Model(fitted.config, fitted.weights, fitted.accounts.where("id = 0"))
    with pytest.raises(Exception, match="no vector"):
        models.forecast(blocks, short).collect()


def test_smape_of_a_test_is_that_of_the_forecast(blocks, accounts):
    """Tests of training add cells up inside the tasks, and agree with the forecast table."""
    fitted, history = fit(blocks, accounts)
    samples = make_samples(blocks, SMALL.lags, SMALL.horizon)
    expected = smape(models.forecast(blocks, fitted)).first()["smape"]
    for windows in (blocks, samples):
        assert models.forecast_smape(windows, fitted) == pytest.approx(expected, rel=1e-9)
    assert trail(history)[-1][3] == pytest.approx(expected, rel=1e-9)
    assert models.forecast_smape(blocks.where("false"), fitted) is None


def test_a_block_too_short_for_its_windows_is_an_error(blocks, accounts):
    fitted, _ = fit(blocks, accounts, replace(SMALL, batches=1, sub_steps=1))
    short = blocks.withColumn("n_windows", F.col("n_windows") + 1)
    with pytest.raises(Exception, match="too short"):
        models.forecast(short, fitted).collect()


def test_empty_batches_are_skipped(blocks, accounts):
    few = make_samples(blocks, SMALL.lags, SMALL.horizon).limit(2)
    _, history = fit(few, accounts, replace(SMALL, batches=5, sub_steps=1))
    assert 1 <= history.count() <= 2


def test_a_batch_is_left_early(blocks, accounts):
    _, history = fit(blocks, accounts, replace(SMALL, stop_below=1000.0, sub_steps=50))
    assert [r[:2] for r in trail(history)] == [(0, 0), (1, 0)]


def test_history_loss_is_the_loss_of_the_forecast(spark, blocks, accounts):
    config = replace(SMALL, batches=1, sub_steps=1)
    rows = trail(fit(blocks, accounts, config)[1])
    start = models.Model(
        config,
        network.initial_weights(config, 2, 0),
        training.initial_vectors(accounts, config.account_dim, 0),
    )
    loss = log_l2_loss(models.forecast(blocks, start)).first()["loss"]
    assert rows[0][2] == pytest.approx(loss, rel=1e-5)


def test_no_windows(spark, blocks, accounts):
    with pytest.raises(ValueError, match="no windows"):
        fit(blocks.where("false"), accounts)


def test_single_account_layout(spark, hourly):
    one = spark.createDataFrame([("a2", 0)], "account string, account_int int")
    config = replace(SMALL, account_dim=0)
    windows = series_blocks(hourly, one, METRICS, START, at(HOURS), config.width)
    fitted, history = fit(windows, one, config)
    assert history.count() == 6
    assert models.forecast(windows, fitted).count() == 2 * (HOURS - config.width + 1)


def test_forecast_by_hand(spark, blocks, accounts):
    fitted, _ = fit(blocks, accounts)
    vectors = {r["id"]: r["vec"] for r in fitted.accounts.collect()}
    samples = make_samples(blocks, SMALL.lags, SMALL.horizon)
    rows = samples.collect()
    batch = network.Batch(
        np.array([r["account_int"] for r in rows]),
        np.array([r["metric_int"] for r in rows]),
        np.array([r["hour"] for r in rows], "datetime64[h]").astype(np.int64),
        np.log(np.array([r["x"] for r in rows])),
        None,
    )
    yhat = network.predict(fitted.weights, batch, np.array([vectors[a] for a in batch.account]))
    expected = {
        (r["account_int"], r["metric_int"], r["hour"], r["dayofweek"]): (r["y"], list(f))
        for r, f in zip(rows, yhat)
    }
    for windows in (blocks, samples):
        got = models.forecast(windows, fitted).collect()
        assert len(got) == len(expected)
        for r in got:
            y, f = expected[r["account_int"], r["metric_int"], r["hour"], r["dayofweek"]]
            assert r["y"] == pytest.approx(y) and r["yhat"] == pytest.approx(f, rel=1e-5)


def test_labels_left_unread_change_nothing(blocks, accounts):
    """Blocks overlap by more than a window without labels."""
    fitted, _ = fit(blocks, accounts, replace(SMALL, batches=1, sub_steps=1))
    with_labels = models.forecast(blocks, fitted).drop("y")
    without = models.forecast(blocks, fitted, labelled=False)
    assert without.count() == with_labels.count()
    assert without.exceptAll(with_labels).isEmpty()


def test_forecast_of_what_comes_next(hourly, accounts, blocks):
    fitted, _ = fit(blocks, accounts)
    latest = build.latest_windows(hourly, accounts, (START, at(HOURS)), SMALL, METRICS)
    out = models.forecast(latest, fitted, labelled=False).collect()
    assert len(out) == 8 and {r["hour"] for r in out} == {at(HOURS - SMALL.lags)}
    assert all(len(r["yhat"]) == SMALL.horizon and min(r["yhat"]) > 0 for r in out)


def test_stored_model_gives_the_same_scores(spark, blocks, accounts, tmp_path):
    path = str(tmp_path / "models")
    fitted, _ = forecasting.train_and_store(
        blocks, blocks, accounts, path, "net", 3, SMALL, METRICS
    )
    again = models.load_model(spark, path, "net", 3)
    assert again.config == fitted.config
    assert all((again.weights[k] == fitted.weights[k]).all() for k in fitted.weights)
    one, two = (models.forecast(blocks, m) for m in (fitted, again))
    assert one.exceptAll(two).isEmpty()
    scores = forecasting.score_stored(blocks, accounts, path, "net", 3).collect()
    total = smape(one).first()
    assert sum(r["smape"] * r["n"] for r in scores) == pytest.approx(total["smape"] * total["n"])
    assert {r["account"] for r in scores} == {"a0", "a1", "a2", "a3"}


def test_neighbours_of_metrics_and_weekdays(spark, blocks, accounts):
    fitted, _ = fit(blocks, accounts)
    report = forecasting.neighbour_report(spark, fitted, METRICS)
    days = report.where(F.col("embedding") == "weekday")
    assert days.count() == 21 and days.where("label = neighbour").isEmpty()
    pairs = report.where(F.col("embedding") == "metric").select("label", "neighbour").collect()
    assert sorted(map(tuple, pairs)) == [("m", "n"), ("n", "m")]
