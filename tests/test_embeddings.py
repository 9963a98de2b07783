from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from hourcast.functions.arrow import list_column
from hourcast.operators import neighbours as neighbours_module
from hourcast.operators.embeddings import embedding_lookup, embedding_topk, unit_rows
from hourcast.operators.neighbours import pivot_search, pivot_topk
from hourcast.session import checkpoint_dir

SCHEMA = "id int, vec array<float>"


def brute(vectors, k):
    ids = np.array([i for i, _ in vectors])
    matrix = np.array([v for _, v in vectors], np.float32).astype(float)
    with np.errstate(invalid="ignore"):
        unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    cosine = np.round(unit @ unit.T, 9)
    out = {}
    for i, q in enumerate(ids):
        others = [(-c, int(o)) for o, c in zip(ids, cosine[i]) if o != q and not np.isnan(c)]
        out[int(q)] = [o for _, o in sorted(others)[:k]]
    return out


def neighbours(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["id"], r["rank"])):
        out.setdefault(r["id"], []).append(r["neighbour"])
        assert r["rank"] == len(out[r["id"]])
    return out


def random_vectors(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(int(i) * 3, rng.normal(size=dim).tolist()) for i in rng.permutation(n)]
    # A third of all vectors are copies of one.
    for i in range(0, n, 3):
        rows[i] = (rows[i][0], rows[0][1])
    return rows


@pytest.mark.parametrize("block_bytes", [1 << 24, 2000, 700])
@pytest.mark.parametrize("k", [1, 3])
def test_topk_is_exact_for_any_block_size(spark, block_bytes, k):
    rows = random_vectors(90, 6)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = embedding_topk(table, k, block_bytes)
    assert neighbours(found) == brute(rows, k)


def test_fewer_vectors_than_neighbours(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0])], SCHEMA)
    assert neighbours(embedding_topk(table, 3)) == {1: [2], 2: [1]}
    assert embedding_topk(table.where("id = 1"), 3).isEmpty()
    assert embedding_topk(table.where("id = 9"), 3).isEmpty()


@pytest.mark.parametrize("block_bytes", [1 << 24, 30])
def test_a_zero_vector_has_no_neighbours(spark, block_bytes):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0])]
    table = spark.createDataFrame(rows, SCHEMA)
    assert neighbours(embedding_topk(table, 2, block_bytes)) == {1: [2], 2: [1]}


def test_self_is_left_out_by_id_not_by_rank(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0])]
    found = embedding_topk(spark.createDataFrame(rows, SCHEMA), 2)
    assert neighbours(found) == {1: [2, 3], 2: [1, 3], 3: [1, 2]}


def test_lookup(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], SCHEMA)
    rows = spark.createDataFrame([(1,), (0,), (1,), (7,)], "k int")
    got = sorted((r["k"], r["v"]) for r in embedding_lookup(rows, table, "k", "v").collect())
    assert got == [(0, [1.0]), (1, [2.0]), (1, [2.0]), (7, None)]


@pytest.mark.parametrize(("n_pivots", "block_rows"), [(None, 8_192), (5, 7), (1, 1_000), (30, 1)])
@pytest.mark.parametrize("k", [1, 3])
def test_pivots_give_the_same_neighbours(spark, n_pivots, block_rows, k):
    rows = random_vectors(90, 6)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert neighbours(pivot_topk(table, k, n_pivots, block_rows)) == brute(rows, k)


def test_pivots_with_few_and_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [-1.0, 0.0])]
    table = spark.createDataFrame(rows, SCHEMA)
    for block_rows in (1, 100):
        assert neighbours(pivot_topk(table, 3, 2, block_rows)) == {1: [2, 4], 2: [1, 4], 4: [2, 1]}
    assert pivot_topk(table.where("id = 9"), 3).isEmpty()
    assert pivot_topk(table.where("id = 3"), 3).isEmpty()
    assert pivot_topk(table.where("id = 1"), 3).isEmpty()


def test_clusters_are_compared_with_few_others(spark):
    """Forty far clusters: a vector is compared with little more than its own."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + rng.normal(size=16) * 0.02).tolist()) for i in range(1_200)]
    search = pivot_search(spark.createDataFrame(rows, SCHEMA), 3, n_pivots=200, block_rows=100)
    done, every = search.compared()
    assert done < 0.2 * every
    assert neighbours(search.neighbours()) == brute(rows, 3)


def test_visitors_leave_in_batches_of_bounded_size():
    """Vectors without clusters visit every block: a part must not be blown up by their number."""
    rng, n, n_pivots, dim = np.random.default_rng(5), 4_000, 64, 32
    unit, pivots = (unit_rows(rng.normal(size=(k, dim))) for k in (n, n_pivots))
    part = pa.RecordBatch.from_pydict(
        {
            "id": pa.array(np.arange(n)),
            "unit": list_column(unit, "float64"),
            "pivot": pa.array(np.zeros(n, np.int32)),
            "block": pa.array(np.zeros(n, np.int32)),
            "floor": np.full(n, -2.0),
        }
    )
    radius, blocks = np.full(n_pivots, np.pi), np.full(n_pivots, 2, np.int64)
    found = list(neighbours_module._visits(pivots, radius, blocks)(iter([part])))
    assert sum(b.num_rows for b in found) == n * n_pivots * 2
    assert max(b.nbytes for b in found) < 2 * neighbours_module.VISIT_BYTES
    ids = np.concatenate([b["id"].to_numpy() for b in found])
    assert (np.bincount(ids) == n_pivots * 2).all()


def test_visits_are_not_stored(spark):
    """Vectors without clusters visit every block: they must not be written once for each."""
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(1_000)]
    table = spark.createDataFrame(rows, SCHEMA)
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))

    def stored():
        return sum(pq.read_metadata(f).num_rows for f in folder.rglob("part-*.parquet"))

    before = stored()
    found = pivot_search(table, 3, n_pivots=60, block_rows=10)
    assert neighbours(found.neighbours()) == neighbours(embedding_topk(table, 3))
    assert 0 < stored() - before <= 2 * len(rows)
    done, every = found.compared()
    assert done > 0.5 * every


def test_a_vector_is_sent_once_to_a_hall(spark):
    rng, n = np.random.default_rng(5), 500
    pivots = unit_rows(rng.normal(size=(20, 8)))
    sizes, blocks = np.full(20, 25), np.full(20, 3)
    halls = neighbours_module._halls(pivots, sizes, blocks, 4)
    assert sorted({int(h) for own in halls for h in own}) == [0, 1, 2, 3]
    part = pa.RecordBatch.from_pydict(
        {
            "id": pa.array(np.arange(n)),
            "vec": list_column(rng.normal(size=(n, 8)), "float32"),
            "floor": np.full(n, -2.0),
            "pivot": pa.array(np.arange(n) % 20, pa.int32()),
            "block": pa.array(np.arange(n) % 3, pa.int32()),
        }
    )
    send = neighbours_module._sent(pivots, np.full(20, np.pi), halls, 5)
    sent = pa.Table.from_batches(list(send(iter([part])))).to_pandas()
    visits, held = sent[~sent.held], sent[sent.held]
    assert len(visits) == n * 4 and not visits.duplicated(["id", "hall"]).any()
    assert len(held) == n * 5 and not held.duplicated(["id", "slice"]).any()
    assert (held.groupby("id").hall.nunique() == 1).all() and (visits.groupby("id").slice.nunique() == 1).all()
