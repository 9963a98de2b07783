"""Exact nearest neighbours without comparing all pairs.

Every vector is put to the nearest of a fixed number of pivots, and what a pivot holds is cut
into blocks. A block's own vectors give each one a k-th best cosine to beat. By the triangle
inequality of angles a vector of another block lies no nearer than the angle to that block's
pivot less its radius, so a vector visits only blocks in which something nearer may lie.

Blocks of near pivots make a hall of bounded size. A vector is sent once to every hall with a
block it visits, not once to every block, and a task that holds a hall lets its visitors pass by
in batches, each compared with the blocks of the hall that it visits.

On vectors without clusters every block may hold something nearer and all pairs are compared;
`compared` tells the share. The result is exact either way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.functions.arrow import matrix
from hourcast.operators.embeddings import BLOCK_BYTES, DIGITS, FOUND, NEIGHBOURS, nearest, unit_rows
from hourcast.session import scratch_path

# Pivots at most, and vectors in a block at most (but for the chance of a hash).
PIVOTS = 256
BLOCK_ROWS = 8_192

# Vectors that visit blocks leave a task in batches of about this size: a part of the input may
# hold thousands, and each may visit every block.
VISIT_BYTES = 16 << 20

# Vectors of a hall take about this much as doubles at most.
HALL_BYTES = 16 << 20

# Angles near 0 are known to about this much from double cosines.
SLACK = 1e-7



VISITS = "id bigint, from_pivot int, from_block int, pivot int, block int"


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back, so that a lost executor costs one read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _unit(part: pa.RecordBatch) -> np.ndarray:
    """Unit vectors; those of a part that has vectors as they came are worked out again."""
    return matrix(part, "unit") if "unit" in part.schema.names else unit_rows(matrix(part, "vec"))


def angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))


def _place(pivots: np.ndarray):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            unit = unit_rows(matrix(part, "vec"))
            # A vector of length 0 has no direction and is nobody's neighbour.
            rows = np.flatnonzero(~np.isnan(unit).any(axis=1))
            found = angles(unit[rows], pivots)
            own = found.argmin(axis=1)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": part["id"].take(pa.array(rows)),
                    "vec": part["vec"].take(pa.array(rows)),
                    "pivot": pa.array(own, pa.int32()),
                    "angle": found[np.arange(len(own)), own],
                }
            )

    return run


def _floors(k: int):
    """The k-th best cosine of each vector within its block; -2 where it has fewer."""

    def run(group: pa.Table) -> pa.Table:
        part = group.sort_by("id").combine_chunks().to_batches()[0]
        ids, unit = part["id"].to_numpy(), _unit(part)
        floor = np.full(len(ids), -2.0)
        for found in nearest(ids, unit, ids, unit, k):
            # Rows come by id and rank, so the k-th of an id lies k - 1 after its first.
            own, first, n = np.unique(found["id"].to_numpy(), return_index=True, return_counts=True)
            full = n == k
            floor[np.searchsorted(ids, own[full])] = found["cosine"].to_numpy()[first[full] + k - 1]
        return pa.table({name: part[name] for name in ("id", "vec", "pivot", "block")} | {"floor": floor})

    return run


def _reaches(unit: np.ndarray, floor: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each vector the pivots that may hold a nearer one than its k-th best."""
    least = np.maximum(0.0, angles(unit, pivots) - radius - SLACK)
    return np.cos(least) >= floor[:, None] - SLACK


def _visits(pivots: np.ndarray, radius: np.ndarray, blocks: np.ndarray):
    """Each vector once for every block that may hold a nearer one than its k-th best."""

    def visitors(part: pa.RecordBatch) -> pa.RecordBatch:
        near = _reaches(_unit(part), part["floor"].to_numpy(), pivots, radius)
        row, pivot = np.nonzero(near & (blocks > 0))
        # Every block of the pivot.
        n = blocks[pivot]
        again = np.repeat(np.arange(len(row)), n)
        block = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
        taken = pa.array(row[again])
        return pa.RecordBatch.from_pydict(
            {
                "id": part["id"].take(taken),
                "from_pivot": part["pivot"].take(taken),
                "from_block": part["block"].take(taken),
                "pivot": pa.array(pivot[again], pa.int32()),
                "block": pa.array(block, pa.int32()),
            }
        )

    step = max(1, VISIT_BYTES // (8 * pivots.shape[1] * max(1, int(blocks.sum()))))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, step):
                yield visitors(part.slice(at, step))

    return run


def _in_line(pivots: np.ndarray) -> np.ndarray:
    """An order of the pivots in which each is followed by the nearest of those left."""
    cosine, left = pivots @ pivots.T, np.ones(len(pivots), bool)
    order = [0]
    for _ in range(len(pivots) - 1):
        left[order[-1]] = False
        order.append(int(np.where(left, cosine[order[-1]], -np.inf).argmax()))
    return np.array(order)


def _halls(pivots: np.ndarray, sizes: np.ndarray, blocks: np.ndarray, n_halls: int) -> list[np.ndarray]:
    """For each pivot the halls of its blocks: blocks of neighbouring pivots share one."""
    each, before = -(-sizes.sum() // n_halls), 0
    halls: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pivots)
    for p in _in_line(pivots):
        size = sizes[p] / max(1, blocks[p])
        halls[p] = ((before + size * (np.arange(blocks[p]) + 0.5)) // each).astype(np.int32)
        before += sizes[p]
    return halls


SENT = "id bigint, vec {vec}, floor double, hall int, slice int, held boolean, pivot int, block int"


def _sent(pivots: np.ndarray, radius: np.ndarray, halls: list[np.ndarray], n_slices: int):
    """Each vector to all slices of its own hall, and its slice of every hall that it visits."""
    n_halls = max(int(h.max(initial=-1)) for h in halls) + 1
    holds = np.zeros((len(pivots), n_halls), bool)
    for p, own in enumerate(halls):
        holds[p, own] = True

    def send(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, floor = part["id"].to_numpy(), part["floor"].to_numpy()
        pivot, block = part["pivot"].to_numpy(), part["block"].to_numpy()
        near = _reaches(_unit(part), floor, pivots, radius)
        visitor, hall = np.nonzero(near @ holds)
        mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        own = np.array([halls[p][b] for p, b in zip(pivot, block)], np.int32)
        n = len(ids)
        row = np.concatenate([np.repeat(np.arange(n), n_slices), visitor])
        held = np.arange(len(row)) < n * n_slices
        slices = np.concatenate([np.tile(np.arange(n_slices), n), (mixed % np.uint64(n_slices))[visitor]])
        taken = pa.array(row)
        return pa.RecordBatch.from_pydict(
            {name: part[name].take(taken) for name in ("id", "vec", "floor")}
            | {
                "hall": pa.array(np.concatenate([np.repeat(own, n_slices), hall]), pa.int32()),
                "slice": pa.array(slices, pa.int32()),
                "held": pa.array(held),
                "pivot": part["pivot"].take(taken),
                "block": part["block"].take(taken),
            }
        )

    step = max(1, VISIT_BYTES // (8 * pivots.shape[1] * (n_halls + n_slices)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, step):
                yield send(part.slice(at, step))

    return run


def _best(row: np.ndarray, ids: np.ndarray, cosine: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best of each row, equal cosines by id."""
    order = np.lexsort((ids, -cosine, row))
    row, ids, cosine = row[order], ids[order], cosine[order]
    starts = np.searchsorted(row, row)
    keep = np.arange(len(row)) - starts < k
    return row[keep], ids[keep], cosine[keep]


def _better(
    ids: np.ndarray, unit: np.ndarray, floor: np.ndarray, other_ids: np.ndarray, other: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, ...]]:
    """Row, id and cosine of those of `other` that are among the k nearest and reach the floor."""
    step = max(1, BLOCK_BYTES // (8 * max(1, len(other_ids))))
    for at in range(0, len(ids), step):
        some = slice(at, at + step)
        cosine = unit[some] @ other.T
        row, column = np.nonzero(cosine >= floor[some, None] - SLACK)
        found = np.round(cosine[row, column], DIGITS)
        keep = (found >= floor[some][row]) & (ids[some][row] != other_ids[column])
        yield _best(at + row[keep], other_ids[column[keep]], found[keep], k)


def _passed_by(pivots: np.ndarray, radius: np.ndarray, k: int):
    """The nearest that visitors find in halls. Rows come by hall and slice, those held first."""

    def blocks_of(parts: list[pa.RecordBatch]) -> list[tuple[int, np.ndarray, np.ndarray]]:
        part = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        ids, unit = part["id"].to_numpy(), _unit(part)
        own = np.stack([part["pivot"].to_numpy(), part["block"].to_numpy()], axis=1)
        cuts = np.flatnonzero(np.append(True, (own[1:] != own[:-1]).any(axis=1)))
        return [
            (int(own[a, 0]), ids[a:b], unit[a:b]) for a, b in zip(cuts, np.append(cuts[1:], len(ids)))
        ]

    def found(part: pa.RecordBatch, hall: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, unit, floor = part["id"].to_numpy(), _unit(part), part["floor"].to_numpy()
        near = _reaches(unit, floor, pivots, radius)
        best = [(np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0))]
        for pivot, other_ids, other in hall:
            rows = np.flatnonzero(near[:, pivot])
            for row, neighbour, cosine in _better(ids[rows], unit[rows], floor[rows], other_ids, other, k):
                best.append((rows[row], neighbour, cosine))
        row, neighbour, cosine = _best(*map(np.concatenate, zip(*best)), k)
        return pa.RecordBatch.from_pydict({"id": ids[row], "neighbour": neighbour, "cosine": cosine}, FOUND)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, waiting, hall = None, [], []
        for part in parts:
            at = np.stack([part[c].to_numpy(zero_copy_only=False) for c in ("hall", "slice", "held")], axis=1)
            cuts = np.flatnonzero(np.append(True, (at[1:] != at[:-1]).any(axis=1)))
            for low, high in zip(cuts, np.append(cuts[1:], len(at))):
                some, (here, held) = part.slice(low, high - low), (tuple(at[low, :2]), at[low, 2])
                if here != last:
                    last, waiting, hall = here, [], []
                if held:
                    waiting.append(some)
                    continue
                if waiting:
                    waiting, hall = [], blocks_of(waiting)
                yield found(some, hall)

    return run


@dataclass
class PivotSearch:
    """Vectors placed by pivots, and the visits that are needed."""

    placed: DataFrame
    visits: DataFrame
    found: DataFrame
    k: int

    def compared(self) -> tuple[int, int]:
        """Pairs of a vector and another that are compared, and all such pairs."""
        sizes = self.placed.groupBy("pivot", "block").agg(F.count("*").alias("n"))
        visits = self.visits.groupBy("pivot", "block").agg(F.count("*").alias("v"))
        done = visits.join(sizes, ["pivot", "block"]).agg(F.sum(F.col("v") * F.col("n"))).first()[0] or 0
        n = self.placed.count()
        return done - n, n * (n - 1)

    def neighbours(self) -> DataFrame:
        """id, rank from 1, neighbour, cosine."""
        best = Window.partitionBy("id").orderBy(F.desc("cosine"), "neighbour")
        return (
            self.found.withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= self.k)
            .select("id", "rank", "neighbour", "cosine")
        )


def pivot_search(
    table: DataFrame, k: int = 3, n_pivots: int | None = None, block_rows: int = BLOCK_ROWS
) -> PivotSearch:
    """Plan the search of the k nearest others of every vector in `table` (id, vec).

    Pivots are as many as the square root of the vectors, up to `PIVOTS`, if not given.
    """
    # Floats stay floats: they are what is stored and sent.
    kind = "array<float>" if dict(table.dtypes)["vec"] == "array<float>" else "array<double>"
    table = table.select(F.col("id").cast("bigint").alias("id"), F.col("vec").cast(kind).alias("vec"))
    if n_pivots is None:
        n_pivots = min(PIVOTS, math.isqrt(table.count()) + 1)
    # The vectors of lowest hash: a draw of fixed size.
    length = F.aggregate(
        F.col("vec").cast("array<double>"), F.lit(0.0), lambda total, v: total + v * v
    )
    drawn = table.where(length > 0).orderBy(F.xxhash64("id"), "id").limit(n_pivots).collect()
    if not drawn:
        spark = table.sparkSession
        none = [
            spark.createDataFrame([], schema)
            for schema in ("id bigint, pivot int, block int", VISITS, NEIGHBOURS)
        ]
        return PivotSearch(*none, k)
    pivots = unit_rows(np.array([r["vec"] for r in drawn]))
    schema = f"id bigint, vec {kind}, pivot int, angle double"
    placed = _stored(table.mapInArrow(_place(pivots), schema), "placed")
    radius, n, blocks = np.zeros(len(pivots)), *np.zeros((2, len(pivots)), np.int64)
    sizes = placed.groupBy("pivot").agg(F.max("angle").alias("radius"), F.count("*").alias("n"))
    for r in sizes.collect():  # one row a pivot
        p = r["pivot"]
        radius[p], n[p], blocks[p] = r["radius"], r["n"], -(-r["n"] // block_rows)
    n_blocks = F.array(*[F.lit(int(b)) for b in blocks])[F.col("pivot")]
    blocked = placed.withColumn("block", F.pmod(F.xxhash64("id"), n_blocks).cast("int"))
    floors = _stored(
        blocked.groupBy("pivot", "block").applyInArrow(
            _floors(k), f"id bigint, vec {kind}, pivot int, block int, floor double"
        ),
        "floors",
    )
    visits = floors.mapInArrow(_visits(pivots, radius, blocks), VISITS)
    # Small enough halls, and a slice of one for every task.
    n_tasks = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_halls = max(-(-int(n.sum()) * 8 * pivots.shape[1] // HALL_BYTES), math.ceil(math.sqrt(2 * n_tasks)))
    halls = _halls(pivots, n, blocks, n_halls)
    sent = floors.mapInArrow(
        _sent(pivots, radius, halls, -(-2 * n_tasks // n_halls)), SENT.format(vec=kind)
    )
    # By number, or the halls would be merged into few tasks by their size.
    met = sent.repartition(n_tasks, "hall", "slice").sortWithinPartitions(
        "hall", "slice", F.desc("held"), "pivot", "block", "id"
    )
    found = met.mapInArrow(_passed_by(pivots, radius, k), NEIGHBOURS)
    return PivotSearch(floors, visits, found, k)


def pivot_topk(
    table: DataFrame, k: int = 3, n_pivots: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """What `embedding_topk` gives: id, rank, neighbour, cosine."""
    return pivot_search(table, k, n_pivots, block_rows).neighbours()
