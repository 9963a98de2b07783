"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Entries become whole numbers, x = floor(`SCALE` * c). Tasks add up the products of their
vectors exactly and hand on one matrix a task; n^2 times the covariance is then a matrix of
integers. Its characteristic polynomial is computed modulo many primes, spread over tasks, and
put together by Chinese remaindering. Real roots are isolated in exact arithmetic, and inverse
iteration in the null space gives the components, again spread over tasks. Only matrices of
the vectors' length reach the driver, whatever the number of vectors.

Vectors that are null or hold null or non-finite entries are left out. So are those shorter
than the longest: they lack entries. Entries beyond 2^62 / SCALE count as that bound. Empty
tables, empty vectors and equal vectors have no component and give no rows; a component whose
eigenvalue is 0 is none. Eigenvalues nearer than 2^-128 count as equal, and any orthogonal
components span their space. Repeated rows count each, vec_ids may be null or repeated. Only
the two columns named are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.functions.arrow import lists
from hourcast.llm import charpoly
from hourcast.llm.text import stored

SCALE = 1024
COMPONENTS = 8
_LIMIT = 1 << 62
_ROWS = 1 << 14
# Sums of the tasks are handed on in digits of so many bits: a sum of many still fits a long.
DIGIT_BITS = 31
_DECIMAL = 10**38


@dataclass
class Whitening:
    """n vectors and their sums, and the components by falling eigenvalue of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray  # one a row
    eigenvalues: np.ndarray
    explained: np.ndarray  # share of the whole variance


def _finite(vector: str) -> Column:
    def good(c: Column) -> Column:
        value = c.cast("double")
        return c.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))

    return F.col(vector).isNotNull() & F.forall(vector, good)


def _vectors(df: DataFrame, vector: str, ident: str | None = None) -> DataFrame:
    vec = F.col(vector).cast("array<double>").alias("vec")
    ids = [] if ident is None else [F.col(ident).cast("long").alias("id")]
    return df.where(_finite(vector)).select(vec, *ids)


def whole_numbers(values: np.ndarray, scale: float = SCALE) -> np.ndarray:
    return np.clip(np.floor(values * scale), -_LIMIT, _LIMIT).astype(np.int64)


def products(x: np.ndarray) -> np.ndarray:
    """x' x as Python integers, by the fastest arithmetic that is exact for these numbers."""
    top = int(np.abs(x).max(initial=0))
    most = top * top * len(x)
    if most < 1 << 53:
        return (x.T.astype(np.float64) @ x.astype(np.float64)).astype(np.int64).astype(object)
    if most < 1 << 62:
        return (x.T @ x).astype(object)
    return x.T.astype(object) @ x.astype(object)


def _by_length(part: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The vectors of each length as a matrix."""
    values, at = lists(part, "vec")
    sizes = np.diff(at)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield size, values[at[:-1][rows][:, None] + np.arange(size)]


def _digits(cells: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Place and digits of integers, the lowest first; the last digits have the sign."""
    place = 0
    while not all(-1 <= c <= 0 for c in cells):
        yield place, cells & ((1 << DIGIT_BITS) - 1)
        cells, place = cells >> DIGIT_BITS, place + 1
    yield place, cells


def _scatter(scale: float):
    """Products of the longest vectors of a task, each with a 1 at the end for sums and n."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest, total = 0, np.zeros((1, 1), dtype=object)
        for part in parts:
            for size, matrix in _by_length(part):
                if size < longest:
                    continue
                if size > longest:
                    longest, total = size, np.zeros((size + 1, size + 1), dtype=object)
                for k in range(0, len(matrix), _ROWS):
                    x = whole_numbers(matrix[k : k + _ROWS], scale)
                    total += products(np.hstack([x, np.ones((len(x), 1), np.int64)]))
        cells = total[np.triu_indices(longest + 1)]
        for place, digits in _digits(cells):
            yield pa.RecordBatch.from_pydict(
                {
                    "length": pa.array(np.full(len(cells), longest), pa.int32()),
                    "place": pa.array(np.full(len(cells), place), pa.int32()),
                    "cell": pa.array(np.arange(len(cells)), pa.int32()),
                    "digit": pa.array(digits.astype(np.int64)),
                }
            )

    return run


def scatter(vectors: DataFrame, scale: float = SCALE) -> tuple[int, list[int], np.ndarray]:
    """n, the sums of each dimension, and n^2 times the covariance: exact integers."""
    digits = vectors.select("vec").mapInArrow(
        _scatter(scale), "length int, place int, cell int, digit long"
    )
    # A task's matrix is that of its longest vectors; only the longest of all count.
    sums = stored(digits.groupBy("length", "place", "cell").agg(F.sum("digit").alias("digit")), "scatter")
    longest = sums.agg(F.max("length")).first()[0] or 0
    total = np.zeros((longest + 1, longest + 1), dtype=object)
    row, column = np.triu_indices(longest + 1)
    for r in sums.where(F.col("length") == longest).collect():
        total[row[r["cell"]], column[r["cell"]]] += r["digit"] << DIGIT_BITS * r["place"]
    total = np.triu(total) + np.triu(total, 1).T
    n, own = total[-1, -1], total[-1, :-1]
    return int(n), [int(v) for v in own], total[:-1, :-1] * n - own[:, None] * own[None, :]


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients of the characteristic polynomial, constant term first.

    Tasks compute it modulo a few primes each.
    """
    chosen = charpoly.primes(charpoly.coefficient_bound(len(matrix), int(matrix.trace())))
    sent = spark.sparkContext.broadcast(matrix)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            own = part["prime"].to_pylist()
            found = [charpoly.residues(sent.value, prime) for prime in own]
            yield pa.RecordBatch.from_pydict(
                {"prime": part["prime"], "residues": pa.array(found, pa.list_(pa.int64()))}
            )

    n_tasks = min(len(chosen), spark.sparkContext.defaultParallelism)
    split = spark.createDataFrame([(p,) for p in chosen], "prime long").repartition(n_tasks)
    rows = split.mapInArrow(run, "prime long, residues array<long>").collect()
    sent.destroy()
    return charpoly.remaindered({r["prime"]: r["residues"] for r in sorted(rows)})


def components(
    spark: SparkSession, matrix: np.ndarray, roots: list[tuple[int, int]]
) -> np.ndarray:
    """Unit eigenvectors, one a row, of the roots given as (lower end, how many); a task a root."""
    sent = spark.sparkContext.broadcast(matrix)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k, root, n in zip(*(part[c].to_pylist() for c in ("k", "root", "n")), strict=True):
                vectors = charpoly.null_vectors(sent.value, int(root), n)
                yield pa.RecordBatch.from_pydict(
                    {
                        "k": pa.array([k] * n, pa.int32()),
                        "i": pa.array(range(n), pa.int32()),
                        "vec": pa.array(vectors.tolist(), pa.list_(pa.float64())),
                    }
                )

    rows = [(k, str(root), n) for k, (root, n) in enumerate(roots)]
    split = spark.createDataFrame(rows, "k int, root string, n int").repartition(len(rows))
    found = sorted(split.mapInArrow(run, "k int, i int, vec array<double>").collect())
    sent.destroy()
    return np.array([r["vec"] for r in found])


def fit(df: DataFrame, vector: str = "embedding", k: int = COMPONENTS, scale: float = SCALE) -> Whitening:
    """The first k components of the vectors of `df`, or as many as have an eigenvalue above 0."""
    spark = df.sparkSession
    n, sums, matrix = scatter(_vectors(df, vector), scale)
    trace = int(matrix.trace()) if len(matrix) else 0
    if not trace:
        nothing = np.zeros(0)
        return Whitening(n, sums, np.zeros((0, len(sums))), nothing, nothing)
    roots = charpoly.largest_roots(characteristic(spark, matrix), k)
    found = components(spark, matrix, roots)[:k]
    # The middle of each root's cell, as a fraction over `unit`.
    middles = [2 * root + 1 for root, m in roots for _ in range(m)][:k]
    unit = 1 << (charpoly.ROOT_BITS + 1)
    return Whitening(
        n,
        sums,
        found,
        np.array([m / (unit * n * n) for m in middles]),
        np.array([m / (unit * trace) for m in middles]),
    )


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n x - sums, exact: machine integers where they fit, Python's elsewhere."""
    top = int(np.abs(x).max(initial=0)) * model.n + max(map(abs, model.sums), default=0)
    if top < _LIMIT:
        return x * model.n - np.array(model.sums, dtype=np.int64)
    return x.astype(object) * model.n - np.array(model.sums, dtype=object)


def _deviations(z: np.ndarray) -> pa.Array:
    """Sums of squares; null from 10^38 on."""
    kind = pa.decimal128(38, 0)
    if z.dtype != object and int(np.abs(z).max(initial=0)) ** 2 * max(1, z.shape[1]) < _LIMIT:
        return pa.array((z * z).sum(axis=1)).cast(kind)
    wide = (z.astype(object) ** 2).sum(axis=1)
    return pa.array([Decimal(int(v)) if v < _DECIMAL else None for v in wide], kind)


def _whitened(model: Whitening, scale: float):
    """The rows of a batch that count, n x - sums of them, and their whitened components."""
    projection = model.components.T / np.sqrt(model.eigenvalues)

    def of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values, at = lists(part, "vec")
        rows = np.flatnonzero(np.diff(at) == len(model.sums))
        matrix = values[at[:-1][rows][:, None] + np.arange(len(model.sums))]
        z = _centred(whole_numbers(matrix, scale), model)
        return rows, z, z.astype(np.float64) / max(1, model.n) @ projection

    return of


def identity_error(
    df: DataFrame, model: Whitening, vector: str = "embedding", scale: float = SCALE
) -> float:
    """The largest distance of the whitened vectors' covariance, added up over them, from the identity."""
    whitened, k = _whitened(model, scale), len(model.eigenvalues)
    if not k:
        return 0.0

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for part in parts:
            _, _, own = whitened(part)
            own = np.hstack([own, np.ones((len(own), 1))])
            total += own.T @ own
        cells = total.ravel()
        places = pa.array(np.arange(cells.size), pa.int32())
        yield pa.RecordBatch.from_pydict({"cell": places, "value": cells})

    cells = _vectors(df, vector).mapInArrow(run, "cell int, value double")
    sums = cells.groupBy("cell").agg(F.sum("value").alias("value"))
    total = np.zeros((k + 1) ** 2)
    for r in sums.collect():
        total[r["cell"]] = r["value"]
    total = total.reshape(k + 1, k + 1) / model.n
    mean = total[-1, :-1]
    return float(np.abs(total[:-1, :-1] - np.outer(mean, mean) - np.eye(k)).max())


def transform(
    df: DataFrame,
    model: Whitening,
    ident: str = "vec_id",
    vector: str = "embedding",
    scale: float = SCALE,
) -> DataFrame:
    """One row for each vector and component, from 1.

    vec_id, component, n, deviation (sum of squares of n x - sums, exact; null from 10^38 on),
    whitened, explained.
    """
    whitened, k = _whitened(model, scale), len(model.eigenvalues)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows, z, own = whitened(part)
            again = np.repeat(np.arange(len(rows)), k)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": part["id"].take(pa.array(rows[again])),
                    "component": pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
                    "n": pa.array(np.full(len(again), model.n), pa.int64()),
                    "deviation": _deviations(z).take(pa.array(again)),
                    "whitened": own.ravel(),
                    "explained": np.tile(model.explained, len(rows)),
                }
            )

    return _vectors(df, vector, ident).mapInArrow(
        run,
        "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double",
    )


def whiten(
    df: DataFrame,
    ident: str = "vec_id",
    vector: str = "embedding",
    k: int = COMPONENTS,
    scale: float = SCALE,
) -> DataFrame:
    """`transform` by the components of the same vectors, with `identity_error`."""
    model = fit(df, vector, k, scale)
    error = identity_error(df, model, vector, scale)
    return transform(df, model, ident, vector, scale).withColumn("identity_error", F.lit(error))
