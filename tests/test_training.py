from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.functions import network
from hourcast.operators import batches, training
from hourcast.operators.series import make_samples, series_blocks
from tests.conftest import START, at
from tests.test_model import EXACT, HOURS, METRICS, SMALL, fit, trail
from tests.test_model import accounts, blocks, hourly  # noqa: F401


def windows_of(samples, config, seed=0):
    """All samples in a plain table, with their batch."""
    ordered = batches.shuffle_samples(samples, seed)
    if config.batch_size is None:
        ordered = ordered.withColumn("batch", batches.batch_of(config.batches, seed))
    else:
        ordered = ordered.withColumn("batch", batches.batch_at(config.batch_size))
    return ordered.orderBy("account_int", "metric_int", "hour").collect()


def as_batch(rows):
    hour = np.array([r["hour"] for r in rows], "datetime64[h]").astype(np.int64)
    return network.Batch(
        np.array([r["account_int"] for r in rows]),
        np.array([r["metric_int"] for r in rows]),
        hour,
        np.log(np.array([r["x"] for r in rows])),
        np.log(np.array([r["y"] for r in rows])),
    )


class Plain:
    """Adam on one array, the usual way of writing it."""

    def __init__(self, value, rate):
        self.value, self.rate, self.m, self.v, self.t = value, rate, 0.0, 0.0, 0

    def copy(self):
        out = Plain(self.value, self.rate)
        out.m, out.v, out.t = self.m, self.v, self.t
        return out

    def update(self, g):
        self.t += 1
        self.m, self.v = 0.9 * self.m + 0.1 * g, 0.999 * self.v + 0.001 * g * g
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        self.value = self.value - rate * self.m / (np.sqrt(self.v) + 1e-8)


def brute_training(rows, vectors, config, parts, n_metrics=2, seed=0):
    """Weights after training on plain arrays, tasks given as lists of accounts, one by one."""
    like = network.initial_weights(config, n_metrics, seed)
    shared = Plain(network.pack(like), config.learning_rate)
    own = Plain(vectors, config.learning_rate)
    for number in range(config.batches):
        batch = [r for r in rows if r["batch"] == number]
        if not batch:
            continue
        by_task = [[r for r in batch if r["account_int"] in part] for part in parts]
        done = 0
        while done < config.sub_steps:
            steps = min(config.local_steps, -done % config.check_every + 1, config.sub_steps - done)
            copies, total = [], 0.0
            moved = own.copy()
            for part, held in zip(parts, by_task, strict=True):
                local, mine = shared.copy(), own.copy()
                for k in range(steps):
                    grad, by_account = np.zeros(local.value.size), np.zeros_like(own.value)
                    if held:
                        some = as_batch(held)
                        _, grads, each = network.gradient(
                            network.unpack(local.value, like), some, mine.value[some.account]
                        )
                        grad = network.pack(grads)
                        np.add.at(by_account, some.account, each)
                    if k < steps - 1:
                        local.update(grad * len(batch) / len(held) if held else grad)
                    mine.update(by_account)
                if held:
                    total = total + grad
                    copies.append((len(held), local))
                for name in ("value", "m", "v"):
                    before, after = getattr(moved, name), getattr(mine, name)
                    changed = np.array(np.broadcast_to(before, after.shape))
                    changed[list(part)] = after[list(part)]
                    setattr(moved, name, changed)
            moved.t = own.t + steps
            own = moved
            n = sum(k for k, _ in copies)
            for name in ("value", "m", "v"):
                setattr(shared, name, sum(k * getattr(c, name) for k, c in copies) / n)
            shared.t = copies[0][1].t
            shared.update(total)
            done += steps
    return shared.value, own.value


def tasks_of(spark, accounts, windows):
    """The accounts of each task, as the hash of their id deals them."""
    n = training.wide_partitions(windows)
    found = accounts.select("account_int", F.expr(f"pmod(hash(account_int), {n})").alias("task")).collect()
    parts = {}
    for r in found:
        parts.setdefault(r["task"], []).append(r["account_int"])
    return list(parts.values())


def trained(fitted):
    vectors = {r["id"]: r["vec"] for r in fitted.accounts.collect()}
    return network.pack(fitted.weights), np.array([vectors[k] for k in sorted(vectors)])


@pytest.mark.parametrize(
    "changes",
    [
        {},
        {"batch_size": 50, "batches": 3},
        {"local_steps": 3, "sub_steps": 7, "check_every": 100},
        {"local_steps": 2, "sub_steps": 6, "check_every": 4},
    ],
)
def test_training_equals_plain_arrays(spark, blocks, accounts, changes):  # noqa: F811
    config = replace(EXACT, **changes)
    fitted, history = fit(blocks, accounts, config)
    rows = windows_of(make_samples(blocks, config.lags, config.horizon), config)
    first = training.initial_vectors(accounts, config.account_dim, 0).orderBy("id").collect()
    weights, vectors = brute_training(
        rows, np.array([r["vec"] for r in first]), config, tasks_of(spark, accounts, blocks)
    )
    got = trained(fitted)
    assert got[0] == pytest.approx(weights, rel=1e-6, abs=1e-9)
    assert got[1] == pytest.approx(vectors, rel=1e-6, abs=1e-9)
    tests = {k for k in range(config.sub_steps) if k % config.check_every == 0} | {config.sub_steps - 1}
    assert [r[:2] for r in trail(history)] == [(b, k) for b in range(config.batches) for k in sorted(tests)]


@pytest.mark.parametrize("local_steps", [1, 2, 4])
def test_an_update_never_replaces_the_vectors_it_reads(blocks, accounts, monkeypatch, local_steps):  # noqa: F811
    """Also where jobs make an even number of updates."""
    own, moves = training.Trainer.step, []

    def folder(state):
        return {f.rsplit("/", 2)[-2] for f in state.inputFiles()}

    def step(self, *args):
        before = folder(self.state)
        loss = own(self, *args)
        moves.append((before, folder(self.state)))
        return loss

    monkeypatch.setattr(training.Trainer, "step", step)
    config = replace(EXACT, batches=1, sub_steps=9, check_every=100, local_steps=local_steps)
    fit(blocks, accounts, config)
    assert moves and all(a and b and not a & b for a, b in moves)


def test_local_steps_need_fewer_jobs(blocks, accounts, monkeypatch):  # noqa: F811
    calls, own = [], training.Trainer.step

    def step(self, windows, n_windows, n_steps=1):
        calls.append(n_steps)
        return own(self, windows, n_windows, n_steps)

    monkeypatch.setattr(training.Trainer, "step", step)
    config = replace(EXACT, batches=1, sub_steps=9, check_every=100, local_steps=4)
    fit(blocks, accounts, config)
    assert calls == [1, 4, 4]


def test_one_batch_size_uses_the_first_batches_only(blocks, accounts):  # noqa: F811
    """Windows beyond the last batch are not dealt; a batch past the end is empty."""
    config = replace(EXACT, batch_size=100, batches=2, sub_steps=1)
    path = training.scratch_path(blocks.sparkSession, "dealt")
    dealt = training.deal_windows(blocks, config, 0, path)
    sizes = {r["batch"]: r["n"] for r in dealt.groupBy("batch").agg(F.sum(F.size("starts")).alias("n")).collect()}
    assert sizes == {0: 100, 1: 100}
    many = replace(config, batches=50)
    total = make_samples(blocks, config.lags, config.horizon).count()
    _, history = fit(blocks, accounts, many)
    assert history.count() == -(-total // 100)


def test_dealt_windows_are_the_samples(spark, hourly, accounts):  # noqa: F811
    config = replace(EXACT, batches=9)
    whole = series_blocks(hourly, accounts, METRICS, START, at(HOURS), config.width)
    dealt = training.deal_windows(whole, config, 5, training.scratch_path(spark, "dealt"))
    cut = dealt.select("*", F.explode("starts").alias("_s")).select(
        "batch",
        "account_int",
        "metric_int",
        (F.col("hour") + F.col("_s") * F.expr("INTERVAL '1' HOUR")).alias("hour"),
        F.transform(F.slice("log", F.col("_s") + 1, config.width), lambda v: F.round(F.exp(v), 4)).alias("v"),
    )
    samples = make_samples(whole, config.lags, config.horizon).select(
        batches.batch_of(config.batches, 5).alias("batch"),
        "account_int",
        "metric_int",
        "hour",
        F.transform(F.concat("x", "y"), lambda v: F.round(v.cast("double"), 4)).alias("v"),
    )
    assert cut.count() == samples.count() and cut.exceptAll(samples).isEmpty()
    # Windows that do not overlap share no values: sparse batches stay small.
    held = dealt.select(F.sum(F.size("log")).alias("n")).first()["n"]
    assert held < config.width * samples.count()


def test_an_update_reads_its_batch_where_it_lies(spark, blocks, accounts):  # noqa: F811
    """One batch's folder is read, and its windows are not moved again for an update."""
    dealt = training.deal_windows(blocks, EXACT, 0, training.scratch_path(spark, "dealt"))
    one = dealt.where("batch = 1")
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in scan and "(batch#" in scan
    windows = training.hold(one.drop("batch"))
    windows.count()
    state = training.initial_state(training.initial_vectors(accounts, EXACT.account_dim, 0))
    state = training._written(state, training.scratch_path(spark, "state"))
    sent = spark.sparkContext.broadcast(None)
    plan = training._pass_over(windows, state, sent, EXACT)._jdf.queryExecution().executedPlan()
    lines = plan.toString().splitlines()
    windows.unpersist()
    join = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line)
    held = next(k for k, line in enumerate(lines) if "InMemoryTableScan" in line)
    # The vectors' side comes first; the last line of it is the scan of their files.
    vectors = next(k for k, line in enumerate(lines) if k > join and "FileScan" in line)
    assert join < vectors < held
    assert not [line for line in lines[vectors + 1 : held] if "Exchange" in line or "Sort" in line]


def test_a_cut_off_run_goes_on(spark, blocks, accounts, tmp_path):  # noqa: F811
    config = replace(EXACT, batches=2, sub_steps=5, check_every=2)
    whole, history = fit(blocks, accounts, config)
    path = str(tmp_path / "run")

    class Lost(Exception):
        pass

    def cut_at(batch, sub_step):
        def progress(test):
            if (test["batch"], test["sub_step"]) == (batch, sub_step):
                raise Lost

        return progress

    for batch, sub_step in ((0, 2), (0, 4), (1, 0), (1, 4)):
        with pytest.raises(Lost):
            fit(blocks, accounts, config, path=path, save_every=1, progress=cut_at(batch, sub_step))
    again, rest = fit(blocks, accounts, config, path=path, save_every=1)
    assert trail(rest) == [pytest.approx(r, rel=1e-9) for r in trail(history)]
    for one, two in zip(trained(whole), trained(again), strict=True):
        assert two == pytest.approx(one, rel=1e-9)
    # A finished run trains no more, and another configuration is not mixed into it.
    done, same = fit(blocks, accounts, config, path=path, progress=cut_at(0, 0))
    assert trail(same) == trail(rest)
    assert trained(done)[0] == pytest.approx(trained(again)[0], rel=1e-12)
    with pytest.raises(ValueError, match="another configuration"):
        fit(blocks, accounts, replace(config, sub_steps=6), path=path)


def test_a_state_cut_off_while_written_does_not_count(spark, blocks, accounts, tmp_path, monkeypatch):  # noqa: F811
    """The row in `progress` comes last: without it the state before is taken."""
    config = replace(EXACT, batches=1, sub_steps=4, check_every=2)
    whole, _ = fit(blocks, accounts, config)
    path, own, saves = str(tmp_path / "run"), training._Run.save, []

    def save(self, trainer, left=False):
        saves.append(trainer.adam.t)
        if len(saves) == 4:
            monkeypatch.setattr(training, "PROGRESS", "no schema")
        own(self, trainer, left)

    monkeypatch.setattr(training._Run, "save", save)
    with pytest.raises(Exception):
        fit(blocks, accounts, config, path=path, save_every=1)
    monkeypatch.undo()
    again, _ = fit(blocks, accounts, config, path=path, save_every=1)
    assert trained(again)[0] == pytest.approx(trained(whole)[0], rel=1e-9)


def test_gradient_of_all_windows(spark, blocks, accounts):  # noqa: F811
    config = replace(EXACT, batches=1)
    dealt = training.deal_windows(blocks, config, 0, training.scratch_path(spark, "dealt"))
    windows = training.hold(dealt.drop("batch"))
    weights = network.initial_weights(config, 2, 7)
    vectors = training.initial_vectors(accounts, config.account_dim, 7)
    loss, n, grads, by_account = training.loss_gradient(windows, weights, vectors, config)
    rows = make_samples(blocks, config.lags, config.horizon).collect()
    table = np.array([r["vec"] for r in vectors.orderBy("id").collect()])
    batch = as_batch(rows)
    expected = network.gradient(weights, batch, table[batch.account])
    assert n == len(rows) and loss == pytest.approx(expected[0], rel=1e-6)
    for name, grad in expected[1].items():
        assert grads[name] == pytest.approx(grad, rel=1e-5, abs=1e-5)
    sums = np.zeros_like(table)
    np.add.at(sums, batch.account, expected[2])
    got = {r["id"]: r["gradient"] for r in by_account.collect()}
    assert np.array([got[k] for k in sorted(got)]) == pytest.approx(sums, rel=1e-5, abs=1e-5)
    windows.unpersist()
    with pytest.raises(ValueError, match="no windows"):
        training.loss_gradient(training.hold(dealt.drop("batch").where("false")), weights, vectors, config)
