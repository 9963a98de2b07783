"""Train the forecaster.

Training is synchronous and data-parallel. Windows are dealt into batches once: the folder of
a batch holds, for each block, the logarithms its windows need and where they start. A batch
is spread by account and kept while its updates last, so an update reads that batch alone,
where it lies.

An update is one pass of the tasks over the batch. Account vectors come to the windows of
their account; all of an account's windows are in one task, so the task itself moves their
vectors. Of the weights that all windows share it hands on the gradient, which is added up in
a tree and applied on the driver. Loss and gradient are sums over windows, so the result does
not depend on how windows are spread.

With more `local_steps` a job makes several updates: tasks move their own copy of the weights
by the gradient of their own windows, scaled up to the batch, and the last update starts from
the average of these copies and of their running averages, weighted by windows, and is
synchronous again. One local step is plain synchronous training.

The state of training (weights, running averages, account vectors, history) is written every
`save_every` updates, in two folders in turn, so a run that lost its driver goes on from the
last state that was written whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.config import ForecastConfig
from hourcast.functions.arrow import list_column, lists, matrix
from hourcast.functions.network import (
    Batch,
    Weights,
    gradient,
    initial_weights,
    pack,
    sum_by,
    unpack,
)
from hourcast.operators.batches import (
    batch_of,
    block_positions,
    shuffle_samples,
    window_batches,
)
from hourcast.operators.model import CHUNK, MICROS_PER_HOUR, VECTORS, Model, forecast_smape, received
from hourcast.operators.series import SERIES, wide_partitions
from hourcast.session import checkpoint_dir, scratch_path

# Adam.
BETA1, BETA2, STABILISER = 0.9, 0.999, 1e-8

STATE = VECTORS + ", mean array<double>, square array<double>"
MOVED = STATE + ", gradient array<double>, sums binary"
WEIGHTS = "name string, shape array<int>, data array<double>, mean array<double>, square array<double>"
HISTORY = "batch int, sub_step int, loss double, smape double"
PROGRESS = "t long, slot int, batch int, sub_step int, left boolean, run string"


# Deal -----------------------------------------------------------------------------


def _as_blocks(windows: DataFrame, config: ForecastConfig, seed: int) -> DataFrame:
    """Blocks or samples as blocks with the array `batch`: that of each window, NULL for none."""
    if "v" not in windows.columns:
        if config.batch_size is None:
            dealt = windows.withColumn("batch", batch_of(config.batches, seed))
        else:
            dealt = shuffle_samples(windows, seed).withColumn(
                "batch", F.floor(F.col("position") / config.batch_size).cast("int")
            )
        return dealt.select(
            *SERIES, "hour", F.concat("x", "y").alias("v"), F.array("batch").alias("batch")
        )
    if config.batch_size is None:
        return window_batches(windows, config.batches, seed).select(*SERIES, "hour", "v", "batch")
    if "positions" not in windows.columns:
        placed = block_positions(windows.select(*SERIES, "hour", "n_windows"), seed, "hour")
        windows = windows.join(placed, [*SERIES, "hour"])
    size = config.batch_size
    batch = F.transform("positions", lambda p: F.floor(p / size).cast("int"))
    return windows.select(*SERIES, "hour", "v", batch.alias("batch"))


def _deal(config: ForecastConfig):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        precision = np.dtype(config.precision)
        for part in parts:
            values, at = lists(part, "v")
            logs = np.log(values.astype(precision))
            dealt, first = lists(part, "batch")
            found: list[tuple[int, int, int, np.ndarray, np.ndarray]] = []
            for row in range(part.num_rows):
                batches = dealt[first[row] : first[row + 1]]
                order = np.argsort(batches, kind="stable")
                ends = np.flatnonzero(np.diff(batches[order])) + 1
                for starts in np.split(order, ends):
                    batch = int(batches[starts[0]]) if len(starts) else config.batches
                    if batch >= config.batches:
                        continue
                    # Windows apart from each other do not keep what lies between them.
                    for own in np.split(starts, np.flatnonzero(np.diff(starts) > config.width) + 1):
                        log = logs[at[row] + own[0] : at[row] + own[-1] + config.width]
                        found.append((batch, row, int(own[0]), log, own - own[0]))
            if not found:
                continue
            batch, row, moved, held, starts = zip(*found, strict=True)
            taken = pa.array(row, pa.int32())
            hour = part["hour"].cast(pa.int64()).take(taken).to_numpy()
            yield pa.RecordBatch.from_pydict(
                {
                    "batch": pa.array(batch, pa.int32()),
                    **{name: part[name].take(taken) for name in SERIES},
                    "hour": pa.array(hour + np.array(moved) * MICROS_PER_HOUR).cast(pa.timestamp("us")),
                    "log": _ragged(held, precision),
                    "starts": _ragged(starts, np.int32),
                }
            )

    return run


def _ragged(rows: Iterable[np.ndarray], kind) -> pa.ListArray:
    rows = list(rows)
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows).astype(kind)))


def deal_windows(windows: DataFrame, config: ForecastConfig, seed: int, path: str) -> DataFrame:
    """Write the windows of each batch to a folder of its own, and return them.

    batch, account_int, metric_int, hour, log, starts: `log` holds the logarithms of the
    values from `hour` on, `starts` the places in it where windows begin. A value is held once
    a batch and block, not once a window.
    """
    dealt = _as_blocks(windows, config, seed).mapInArrow(_deal(config), _dealt_schema(config))
    dealt.write.mode("overwrite").partitionBy("batch").parquet(path)
    return read_dealt(windows.sparkSession, config, path)


def _dealt_schema(config: ForecastConfig) -> str:
    log = "double" if config.precision == "float64" else "float"
    keys = "batch int, account_int int, metric_int int, hour timestamp_ntz"
    return f"{keys}, log array<{log}>, starts array<int>"


def read_dealt(spark: SparkSession, config: ForecastConfig, path: str) -> DataFrame:
    """Windows as `deal_windows` has written them."""
    return spark.read.schema(_dealt_schema(config)).parquet(path)


def hold(windows: DataFrame, by_account: bool = True) -> DataFrame:
    """Keep stored windows in the executors, by account: joined vectors come to them, and the
    windows stay where they are. A lost executor's share is read again."""
    keys = ["account_int"] if by_account else [*SERIES, "hour"]
    spread = windows.repartition(wide_partitions(windows), *keys).sortWithinPartitions(*keys)
    return spread.persist(StorageLevel.MEMORY_AND_DISK)


# Update ---------------------------------------------------------------------------


def initial_vectors(accounts: DataFrame, dim: int, seed: int) -> DataFrame:
    """Account vectors uniform on (-1, 1), a function of id and seed alone."""
    steps = 1 << 32
    cells = [
        F.pmod(F.xxhash64(F.lit(seed), F.lit(i), "account_int"), F.lit(steps)) * (2.0 / steps) - 1.0
        for i in range(dim)
    ]
    vec = F.array(*cells) if dim else F.array().cast("array<double>")
    return accounts.select(F.col("account_int").alias("id"), vec.alias("vec"))


def initial_state(vectors: DataFrame) -> DataFrame:
    """Vectors (id, vec) with running averages of zero."""
    zeros = F.transform("vec", lambda v: F.lit(0.0))
    return vectors.select("id", "vec", zeros.alias("mean"), zeros.alias("square"))


def check_accounts(windows: DataFrame, vectors: DataFrame) -> None:
    """An error if a window's account has no vector."""
    known = vectors.select(F.col("id").alias("account_int"))
    unknown = windows.select("account_int").distinct().join(known, "account_int", "left_anti")
    if (row := unknown.first()) is not None:
        raise ValueError(f"account {row[0]} has windows but no vector")


def adam_rate(config: ForecastConfig, t: int) -> float:
    """Step size of update `t` (from 1), corrected for the young averages."""
    return config.learning_rate * np.sqrt(1.0 - BETA2**t) / (1.0 - BETA1**t)


@dataclass
class Adam:
    """Numbers that are trained, with their two running averages, after `t` updates."""

    config: ForecastConfig
    value: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    t: int = 0

    @classmethod
    def start(cls, config: ForecastConfig, value: np.ndarray) -> Adam:
        return cls(config, value, np.zeros_like(value), np.zeros_like(value))

    def update(self, grad: np.ndarray) -> None:
        self.t += 1
        self.mean = BETA1 * self.mean + (1 - BETA1) * grad
        self.square = BETA2 * self.square + (1 - BETA2) * grad * grad
        rate = adam_rate(self.config, self.t)
        self.value = self.value - rate * self.mean / (np.sqrt(self.square) + STABILISER)


class _Rows:
    """One part of a task's joined rows: windows to cut, and the accounts they belong to."""

    def __init__(self, part: pa.RecordBatch, config: ForecastConfig, own: _Accounts):
        self.config = config
        self.values, self.at = lists(part, "log")
        self.starts, first = lists(part, "starts")
        self.rows = np.repeat(np.arange(part.num_rows), np.diff(first))
        self.account, self.metric = (
            part[c].fill_null(0).to_numpy() for c in ("account_int", "metric_int")
        )
        self.hour = part["hour"].cast(pa.int64()).fill_null(0).to_numpy() // MICROS_PER_HOUR
        self.place = own.places(part) if config.account_dim else np.zeros(part.num_rows, np.int64)

    def chunks(self) -> Iterator[tuple[Batch, np.ndarray]]:
        """Windows in chunks, and the place of the account of each."""
        lags = self.config.lags
        if not len(self.rows):
            return
        windows = sliding_window_view(self.values, self.config.width)
        for i in range(0, len(self.rows), CHUNK):
            rows, starts = self.rows[i : i + CHUNK], self.starts[i : i + CHUNK]
            log = windows[self.at[rows] + starts]
            hour = self.hour[rows] + starts
            batch = Batch(self.account[rows], self.metric[rows], hour, log[:, :lags], log[:, lags:])
            yield batch, self.place[rows]


class _Accounts:
    """The accounts of a task with their vectors, as they come with its rows."""

    def __init__(self, config: ForecastConfig):
        self.config = config
        self.place: dict[int, int] = {}
        self.held: dict[str, list[np.ndarray]] = {"vec": [], "mean": [], "square": []}

    def places(self, part: pa.RecordBatch) -> np.ndarray:
        ids = part["id"].to_numpy()
        found, first, back = np.unique(ids, return_index=True, return_inverse=True)
        new = [k for k, i in enumerate(found.tolist()) if i not in self.place]
        for name, cells in self.held.items():
            cells.append(matrix(part, name)[first[new]])
        for k in new:
            self.place[int(found[k])] = len(self.place)
        return np.array([self.place[i] for i in found.tolist()], np.int64)[back]

    def adam(self, t: int) -> Adam:
        shape = (len(self.place), self.config.account_dim)
        vec, mean, square = (
            np.concatenate([np.zeros((0, shape[1])), *self.held[name]]).reshape(shape)
            for name in ("vec", "mean", "square")
        )
        return Adam(self.config, vec, mean, square, t)


def _pass(
    weights: Weights, parts: Iterable[_Rows], vectors: Callable[[], np.ndarray], config: ForecastConfig
) -> tuple[float, int, np.ndarray, np.ndarray]:
    """Loss, number of windows, gradient by the shared weights and by the account vectors."""
    total, loss, n = np.zeros(sum(w.size for w in weights.values())), 0.0, 0
    by_place = np.zeros((0, config.account_dim))
    for part in parts:
        vec = vectors().astype(config.precision)
        by_place = np.vstack([by_place, np.zeros((len(vec) - len(by_place), config.account_dim))])
        for batch, place in part.chunks():
            account = vec[place] if config.account_dim else np.zeros((len(place), 0), vec.dtype)
            cost, grads, by_account = gradient(weights, batch, account)
            by_place += sum_by(place, by_account, len(by_place)) if config.account_dim else 0.0
            total += pack(grads)
            loss, n = loss + cost, n + len(place)
    return loss, n, total, by_place


def _moved(sent, config: ForecastConfig, n_steps: int, n_windows: int):
    """What a task does in one job: local updates, if any, and the gradient of the last one."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, mean, square, t = sent.value
        shared, own = Adam(config, pack(weights), mean, square, t), _Accounts(config)
        rows: Iterable[_Rows] = (_Rows(p, config, own) for p in parts if p.num_rows)

        def current() -> Weights:
            return received(unpack(shared.value, weights), config)

        if n_steps > 1:
            # The rows of one batch and task are kept for several passes.
            rows = list(rows)
            accounts = own.adam(t)
            for _ in range(n_steps - 1):
                _, n, grad, by_place = _pass(current(), rows, lambda: accounts.value, config)
                shared.update(grad * (n_windows / n) if n else grad)
                accounts.update(_padded(by_place, accounts.value))
            loss, n, grad, by_place = _pass(current(), rows, lambda: accounts.value, config)
        else:
            loss, n, grad, by_place = _pass(current(), rows, lambda: own.adam(t).value, config)
            accounts = own.adam(t)
        by_place = _padded(by_place, accounts.value)
        accounts.update(by_place)
        if own.place:
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(list(own.place), pa.int32()),
                    "vec": list_column(accounts.value, "float64"),
                    "mean": list_column(accounts.mean, "float64"),
                    "square": list_column(accounts.square, "float64"),
                    "gradient": list_column(by_place, "float64"),
                    "sums": pa.nulls(len(own.place), pa.binary()),
                }
            )
        if n:
            copies = [n * shared.value, n * shared.mean, n * shared.square] if n_steps > 1 else []
            sums = np.concatenate([grad, *copies, [loss, n]]).tobytes()
            empty = pa.nulls(1, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.nulls(1, pa.int32()),
                    **dict.fromkeys(("vec", "mean", "square", "gradient"), empty),
                    "sums": pa.array([sums], pa.binary()),
                }
            )

    return run


def _padded(by_place: np.ndarray, value: np.ndarray) -> np.ndarray:
    return np.vstack([by_place, np.zeros((len(value) - len(by_place), value.shape[1]))])


def _add_up(rows: DataFrame) -> np.ndarray | None:
    """The sums of all tasks, added up in a tree; None if no task had windows."""

    def read(row) -> np.ndarray:
        return np.frombuffer(row["sums"])

    def add(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
        return b if a is None else a if b is None else a + b

    sums = rows.where(F.col("id").isNull()).select("sums")
    total = sums.rdd.map(read).treeAggregate(None, add, add, depth=3)
    if total is not None and not np.isfinite(total).all():
        raise ValueError("the loss is not finite: windows with NULL values?")
    return total


def _pass_over(
    windows: DataFrame, state: DataFrame, sent, config: ForecastConfig, n_steps: int = 1, n_windows: int = 0
) -> DataFrame:
    """One job of the tasks: windows held by account, and the state that comes to them."""
    if config.account_dim:
        rows = state.join(windows.hint("merge"), F.col("id") == F.col("account_int"), "left")
    else:
        rows = windows
    return rows.mapInArrow(_moved(sent, config, n_steps, n_windows), MOVED)


def loss_gradient(
    windows: DataFrame, weights: Weights, vectors: DataFrame, config: ForecastConfig
) -> tuple[float, int, Weights, DataFrame]:
    """Loss, number of windows, gradient by the shared weights, and by account (id, gradient).

    `windows` are dealt and held; all of them count.
    """
    spark = windows.sparkSession
    zeros = np.zeros(pack(weights).size)
    sent = spark.sparkContext.broadcast((weights, zeros, zeros, 0))
    rows = _pass_over(windows, initial_state(vectors), sent, config)
    total = _add_up(rows)
    if total is None:
        raise ValueError("no windows to train on")
    return (
        float(total[-2]),
        int(total[-1]),
        unpack(total[:-2], weights),
        rows.where(F.col("id").isNotNull()).select("id", "gradient"),
    )


class Trainer:
    """Shared weights on the driver, account vectors as a table of any size."""

    def __init__(self, spark: SparkSession, weights: Weights, adam: Adam, state: DataFrame, folder: str):
        self.spark, self.shapes, self.adam, self.state = spark, weights, adam, state
        self.config, self.folder, self._slot = adam.config, folder, 0

    @property
    def weights(self) -> Weights:
        return unpack(self.adam.value, self.shapes)

    def step(self, windows: DataFrame, n_windows: int, n_steps: int = 1) -> float:
        """`n_steps` updates in one job; the loss before the last of them."""
        adam = self.adam
        sent = self.spark.sparkContext.broadcast((self.weights, adam.mean, adam.square, adam.t))
        rows = _pass_over(windows, self.state, sent, self.config, n_steps, n_windows).persist(
            StorageLevel.MEMORY_AND_DISK
        )
        total = _add_up(rows)
        grad, (loss, n) = total[: adam.value.size], total[-2:]
        if n_steps > 1:
            copies = total[adam.value.size : -2].reshape(3, -1) / n
            self.adam = Adam(self.config, *copies, adam.t + n_steps - 1)
        self.adam.update(grad)
        if self.config.account_dim:
            moved = rows.where(F.col("id").isNotNull()).select("id", "vec", "mean", "square")
            # Beside the vectors that this update has read: a lost task may read them again.
            self._slot = 1 - self._slot
            self.state = _written(moved, f"{self.folder}/vectors-{self._slot}")
        rows.unpersist()
        sent.destroy()
        return float(loss)

    def model(self) -> Model:
        return Model(self.config, self.weights, self.state.select("id", "vec"))


def _written(state: DataFrame, path: str) -> DataFrame:
    """Replace a table in the shared folder; what is read back has no history to recompute."""
    state.write.mode("overwrite").parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


# Run ------------------------------------------------------------------------------


@dataclass
class _Run:
    """A training run in its folder, and how far it has come."""

    spark: SparkSession
    path: str
    name: str  # configuration and seed: a folder belongs to one of them
    batch: int = 0
    sub_step: int = 0
    history: list[tuple] = field(default_factory=list)
    slot: int = 0

    def last(self):
        """The last state written whole, if any."""
        try:
            rows = self.spark.read.schema(PROGRESS).parquet(f"{self.path}/progress")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        found = rows.orderBy(F.desc("t"), F.desc("batch"), F.desc("sub_step")).first()
        if found is not None and found["run"] != self.name:
            raise ValueError(f"{self.path} holds a run of another configuration or seed")
        return found

    def save(self, trainer: Trainer, left: bool = False) -> None:
        """Write the state beside the last one, then the row that makes it count."""
        self.slot = 1 - self.slot
        at, adam, like = f"{self.path}/state-{self.slot}", trainer.adam, trainer.shapes
        parts = [unpack(x, like) for x in (adam.value, adam.mean, adam.square)]
        rows = [
            (n, list(w.shape), *(p[n].ravel().tolist() for p in parts)) for n, w in like.items()
        ]
        weights = self.spark.createDataFrame(rows, WEIGHTS)
        history = self.spark.createDataFrame(self.history, HISTORY)
        for name, table in (("weights", weights), ("history", history), ("vectors", trainer.state)):
            table.write.mode("overwrite").parquet(f"{at}/{name}")
        row = (adam.t, self.slot, self.batch, self.sub_step, left, self.name)
        progress = self.spark.createDataFrame([row], PROGRESS).coalesce(1)
        progress.write.mode("append").parquet(f"{self.path}/progress")

    def restored(self, config: ForecastConfig, found) -> Trainer:
        """The trainer as it was, and this run as far as it had come."""
        self.slot, self.batch, self.sub_step = (found[c] for c in ("slot", "batch", "sub_step"))
        at = f"{self.path}/state-{self.slot}"
        if found["left"]:
            self.batch, self.sub_step = self.batch + 1, 0

        def table(name: str, schema: str) -> DataFrame:
            return self.spark.read.schema(schema).parquet(f"{at}/{name}")

        kept = {r["name"]: r for r in table("weights", WEIGHTS).collect()}
        value, mean, square = (
            {n: np.array(r[c]).reshape(r["shape"]) for n, r in kept.items()}
            for c in ("data", "mean", "square")
        )
        adam = Adam(config, pack(value), pack(mean), pack(square), found["t"])
        self.history = sorted(map(tuple, table("history", HISTORY).collect()))
        # A copy: the folder is written again at the next save but one.
        state = _written(table("vectors", STATE), f"{self.path}/vectors-restored")
        return Trainer(self.spark, value, adam, state, self.path)


def _round(sub_step: int, config: ForecastConfig) -> int:
    """Updates of the next job: up to the next test, which needs the weights of all tasks."""
    to_test = -sub_step % config.check_every + 1
    return min(config.local_steps, to_test, config.sub_steps - sub_step)


def fit_forecaster(
    train: DataFrame,
    valid: DataFrame,
    accounts: DataFrame,
    n_metrics: int,
    config: ForecastConfig,
    seed: int = 0,
    progress: Callable[[dict], None] | None = None,
    path: str | None = None,
    save_every: int = 100,
) -> tuple[Model, DataFrame]:
    """Train on the windows of `train`; returns the model and its history.

    Each batch gets up to `config.sub_steps` updates, and is left early once the sMAPE on
    `valid`, tested every `config.check_every` updates, is below `config.stop_below`. The
    history holds every test and the last update of each batch: batch, sub_step, loss, smape.

    With a `path` in a shared store the run can be called again after it was cut off, with the
    same arguments, and goes on from the last state in there; finished, it returns its result.
    """
    spark = train.sparkSession
    checkpoint_dir(spark)
    name = json.dumps([asdict(config), seed, n_metrics], sort_keys=True)
    run = _Run(spark, (path or scratch_path(spark, "training")).rstrip("/"), name)
    found = run.last() if path else None
    if found is None:
        vectors = initial_vectors(accounts, config.account_dim, seed)
        valid.write.mode("overwrite").parquet(f"{run.path}/valid")
        dealt = deal_windows(train, config, seed, f"{run.path}/windows")
        state = _written(initial_state(vectors), f"{run.path}/vectors-first")
        weights = initial_weights(config, n_metrics, seed)
        trainer = Trainer(spark, weights, Adam.start(config, pack(weights)), state, run.path)
        for windows in (dealt, valid):
            check_accounts(windows, state)
        if path:
            run.save(trainer)
    else:
        dealt = read_dealt(spark, config, f"{run.path}/windows")
        trainer = run.restored(config, found)
    valid = hold(spark.read.schema(valid.schema).parquet(f"{run.path}/valid"))

    try:
        while run.batch < config.batches:
            _train_batch(run, trainer, dealt, valid, progress, save_every if path else None)
            run.batch, run.sub_step = run.batch + 1, 0
    finally:
        valid.unpersist()
    if not run.history:
        raise ValueError("no windows to train on")
    return trainer.model(), spark.createDataFrame(run.history, HISTORY)


def _train_batch(
    run: _Run,
    trainer: Trainer,
    dealt: DataFrame,
    valid: DataFrame,
    progress: Callable[[dict], None] | None,
    save_every: int | None,
) -> None:
    """The updates of one batch that are still to be made."""
    config, batch = trainer.config, run.batch
    windows = hold(dealt.where(F.col("batch") == batch).drop("batch"), bool(config.account_dim))
    n_windows = windows.agg(F.sum(F.size("starts"))).first()[0]
    saved, left = trainer.adam.t, not n_windows
    try:
        while run.sub_step < config.sub_steps and not left:
            n_steps = _round(run.sub_step, config)
            loss = trainer.step(windows, n_windows, n_steps)
            run.sub_step += n_steps
            last = run.sub_step - 1
            if last == config.sub_steps - 1 or last % config.check_every == 0:
                score = forecast_smape(valid, trainer.model())
                run.history.append((batch, last, loss, score))
                if progress:
                    progress({"batch": batch, "sub_step": last, "loss": loss, "smape": score})
                left = None not in (score, config.stop_below) and score < config.stop_below
            if save_every and (left or trainer.adam.t - saved >= save_every):
                run.save(trainer, left)
                saved = trainer.adam.t
        if save_every and n_windows and saved != trainer.adam.t:
            run.save(trainer, left)
    finally:
        windows.unpersist()
