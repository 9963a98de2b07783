from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.llm import charpoly, whitening

CLASHES = ("id", "vec", "n", "component", "length", "cell", "digit", "deviation")


@pytest.fixture
def vectors(spark):
    def make(*rows):
        df = spark.createDataFrame(list(rows), "vec_id long, embedding array<float>, label int")
        return df.withColumns({c: F.lit(c) for c in CLASHES})

    return make


def rows_of(matrix, start=0):
    return [(start + k, [float(v) for v in row], 0) for k, row in enumerate(matrix)]


def faddeev(matrix):
    """Characteristic polynomial by exact fractions, constant term first."""
    n = len(matrix)
    own = [[Fraction(int(v)) for v in row] for row in matrix]
    out, held = [Fraction(1)], [[Fraction(0)] * n for _ in range(n)]
    for k in range(1, n + 1):
        held = [
            [sum(own[i][m] * held[m][j] for m in range(n)) + (out[-1] if i == j else 0) for j in range(n)]
            for i in range(n)
        ]
        trace = sum(own[i][m] * held[m][i] for i in range(n) for m in range(n))
        out.append(-trace / k)
    return [int(c) for c in reversed(out)]


def brute(rows):
    """{(vec_id, component): (deviation, |whitened|)} and explained shares, by numpy."""
    kept = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    longest = max(len(v) for _, v in kept)
    kept = [(i, np.array(v, np.float32).astype(float)) for i, v in kept if len(v) == longest]
    x = np.floor(1024 * np.array([v for _, v in kept])).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    value, vector = np.linalg.eigh(np.cov(x.T, bias=True).reshape(longest, longest))
    order = np.argsort(-value)[:8]
    order = [k for k in order if value[k] > 1e-6 * value.max()]
    out = Counter()
    centred = x - sums / n
    for place, k in enumerate(order, 1):
        for (i, _), own in zip(kept, centred @ vector[:, k] / np.sqrt(value[k]), strict=True):
            out[i, place] = abs(own)
    deviation = {i: int(((n * x[k] - sums).astype(object) ** 2).sum()) for k, (i, _) in enumerate(kept)}
    return out, deviation, value[order] / value.sum(), n


def check(df, rows):
    found = whitening.whiten(df).collect()
    expected, deviation, explained, n = brute(rows)
    assert {(r["vec_id"], r["component"]) for r in found} == set(expected) and len(found) == len(expected)
    for r in found:
        assert abs(r["whitened"]) == pytest.approx(expected[r["vec_id"], r["component"]], abs=1e-7)
        assert r["deviation"] == deviation[r["vec_id"]] and r["n"] == n
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in found}) == 1
    # One sign for all rows of a component.
    for k in {r["component"] for r in found}:
        own = [(r["whitened"], r["vec_id"]) for r in found if r["component"] == k]
        assert abs(np.mean([w for w, _ in own])) < 1e-9
    return found


def test_whitened_vectors_equal_numpy(vectors):
    rows = rows_of(np.random.default_rng(0).normal(size=(60, 12)) * np.arange(1, 13))
    check(vectors(*rows).repartition(4), rows)


def test_the_fixture_table(table):
    df = table("embeddings")
    check(df, [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])


def test_fewer_dimensions_and_dependent_ones(vectors):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 3))
    check(vectors(*rows_of(base)), rows_of(base))
    dependent = np.hstack([np.round(base * 64) / 64, np.round(base[:, :1] * 64) / 32, np.ones((40, 1))])
    found = check(vectors(*rows_of(dependent)), rows_of(dependent))
    assert max(r["component"] for r in found) == 3


def test_odd_rows(vectors):
    rows = rows_of(np.random.default_rng(2).normal(size=(30, 4)))
    odd = [
        (100, None, 0),
        (101, [1.0, None, 2.0, 3.0], 0),
        (102, [1.0, float("nan"), 2.0, 3.0], 0),
        (103, [1.0, float("inf"), 2.0, 3.0], 0),
        (104, [], 0),
        (105, [1.0, 2.0], 0),
        (None, [0.5, 0.25, 0.0, -1.0], None),
    ]
    check(vectors(*rows, *odd).repartition(5), rows + odd)


def test_nothing_to_whiten(vectors):
    assert whitening.whiten(vectors()).count() == 0
    assert whitening.whiten(vectors((1, None, 0), (2, [], 0))).count() == 0
    assert whitening.whiten(vectors(*[(k, [1.0, 2.0], 0) for k in range(5)])).count() == 0


def test_repeated_rows_count_each(vectors):
    rows = rows_of(np.random.default_rng(3).normal(size=(5, 3))) * 4
    found = whitening.whiten(vectors(*rows)).collect()
    assert len(found) == 60 and {r["n"] for r in found} == {20}
    assert max(Counter(r["whitened"] for r in found).values()) >= 4


def test_huge_entries_stay_exact(vectors):
    rows = rows_of(np.random.default_rng(4).integers(-9, 9, size=(20, 3)) * 2.0**40)
    rows.append((50, [3e38, 0.0, 0.0], 0))
    found = whitening.whiten(vectors(*rows)).collect()
    x = np.array([[max(-(1 << 62), min(1 << 62, int(1024 * c))) for c in v] for _, v, _ in rows], dtype=object)
    sums = x.sum(axis=0)
    for r in found:
        k = r["vec_id"] if r["vec_id"] < 50 else 20
        total = int(((x[k] * 21 - sums) ** 2).sum())
        assert r["deviation"] == (total if total < 10**38 else None)
        assert r["identity_error"] < 1e-6


def test_scatter_is_exact_over_tasks(vectors, spark):
    rng = np.random.default_rng(5)
    rows = rows_of(rng.normal(size=(50, 5)) * 1e6)
    n, sums, matrix = whitening.scatter(whitening._vectors(vectors(*rows).repartition(7), "embedding"))
    x = np.floor(1024 * np.array([v for _, v, _ in rows], np.float32).astype(float)).astype(np.int64).astype(object)
    assert n == 50 and sums == x.sum(axis=0).tolist()
    assert (matrix == 50 * (x.T @ x) - np.outer(x.sum(axis=0), x.sum(axis=0))).all()
    assert whitening.characteristic(spark, matrix) == faddeev(matrix)


@pytest.mark.parametrize("size", [1, 2, 5, 9])
def test_polynomial_equals_exact_fractions(size):
    rng = np.random.default_rng(size)
    for high in (3, 1_000, 10**12):
        x = rng.integers(-high, high, (size, size)).astype(object)
        matrix = x.T @ x
        chosen = charpoly.primes(charpoly.coefficient_bound(size, int(matrix.trace())))
        poly = charpoly.remaindered({p: charpoly.residues(matrix, p).tolist() for p in chosen})
        assert poly == faddeev(matrix)


def from_roots(*roots):
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    return poly


def test_roots_are_isolated_with_their_multiplicity():
    unit = 1 << charpoly.ROOT_BITS
    found = charpoly.largest_roots(from_roots(0, 0, 7, 7, 7, 8, 1, 10**9, 10**9 + 1), 8)
    assert [(round(low / unit), n) for low, n in found] == [(10**9 + 1, 1), (10**9, 1), (8, 1), (7, 3), (1, 1)]
    assert charpoly.largest_roots(from_roots(0, 0), 8) == []
    # (x - 1)(x^2 - 2x + 1 - 2^-80) scaled: neighbours 2^-40 apart are told apart.
    near = [-((1 << 80) - 1), 3 * (1 << 80) - 1, -3 * (1 << 80), 1 << 80]
    assert [n for _, n in charpoly.largest_roots(near, 8)] == [1, 1, 1]


def test_null_vectors_of_a_repeated_root():
    matrix = (np.eye(4, dtype=int) * 2 + 1).astype(object)
    (top, one), (low, three) = charpoly.largest_roots([48, -80, 48, -12, 1], 8)
    assert (one, three) == (1, 3)
    vectors = np.vstack([charpoly.null_vectors(matrix, top, 1), charpoly.null_vectors(matrix, low, 3)])
    assert np.allclose(vectors @ vectors.T, np.eye(4), atol=1e-14)
    assert np.allclose(vectors @ matrix.astype(float) @ vectors.T, np.diag([6, 2, 2, 2]), atol=1e-14)
