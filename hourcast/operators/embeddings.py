"""Embedding tables: lookup by id, and nearest neighbours by cosine."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourcast.functions.arrow import matrix

# Tables are worked through in pairs of blocks of about this size.
BLOCK_BYTES = 16 << 20

# Cosines are compared to this many digits, so that equal vectors tie whatever
# order their products were summed in, and the smaller id goes first.
DIGITS = 9

NEIGHBOURS = "id bigint, neighbour bigint, cosine double"
FOUND = pa.schema([("id", pa.int64()), ("neighbour", pa.int64()), ("cosine", pa.float64())])


def embedding_lookup(rows: DataFrame, table: DataFrame, key: str, into: str) -> DataFrame:
    """Add the vector of `table` (id, vec) that `key` names, as column `into`.

    Rows whose id has no vector stay, with NULL.
    """
    named = table.select(F.col("id").alias(key), F.col("vec").alias(into))
    return rows.join(named, key, "left")


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore"):
        return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def nearest(
    ids: np.ndarray, unit: np.ndarray, other_ids: np.ndarray, other: np.ndarray, k: int
) -> Iterator[pa.RecordBatch]:
    """The k nearest of `other` for each row of `unit`, itself excluded.

    `other_ids` ascend, so that a stable sort breaks ties by id.
    """
    step = max(1, BLOCK_BYTES // (8 * max(1, len(other_ids))))
    for at in range(0, len(ids), step):
        some = ids[at : at + step]
        cosine = np.round(unit[at : at + step] @ other.T, DIGITS)
        # Neither the vector itself nor one of length 0 is a neighbour.
        cosine[np.isnan(cosine) | (some[:, None] == other_ids[None, :])] = -np.inf
        if k < cosine.shape[1]:
            # Everything at or above the k-th largest can still win on its id.
            floor = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
        else:
            floor = np.full((len(some), 1), -np.inf)
        row, column = np.nonzero((cosine >= floor) & (cosine > -np.inf))
        order = np.lexsort((column, -cosine[row, column], row))
        row, column = row[order], column[order]
        starts = np.searchsorted(row, np.arange(len(some)))
        keep = np.arange(len(row)) - starts[row] < k
        row, column = row[keep], column[keep]
        yield pa.RecordBatch.from_pydict(
            {"id": some[row], "neighbour": other_ids[column], "cosine": cosine[row, column]}
        )


def _by_block_pairs(table: DataFrame, k: int, n_blocks: int, n_tasks: int) -> DataFrame:
    """Every unordered pair of hash blocks is one group; a task works through many.

    A group hands on at most k candidates per row, never its pairs; the caller
    keeps the best k over all groups.
    """
    block = F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    placed = (
        table.withColumn("block", block)
        .withColumn("_other", other)
        .withColumn("low", F.least("block", "_other"))
        .withColumn("high", F.greatest("block", "_other"))
        .drop("_other")
    )

    def search(group: pa.Table) -> pa.Table:
        part = group.sort_by("id").combine_chunks().to_batches()[0]
        ids, unit = part.column("id").to_numpy(), unit_rows(matrix(part, "vec"))
        block = part.column("block").to_numpy()
        low, high = (block == part.column(end)[0].as_py() for end in ("low", "high"))
        found = list(nearest(ids[low], unit[low], ids[high], unit[high], k))
        if (low != high).any():
            found += nearest(ids[high], unit[high], ids[low], unit[low], k)
        return pa.Table.from_batches(found, FOUND)

    # By number, or the pairs would be merged into few tasks by their size.
    spread = placed.repartition(n_tasks, "low", "high")
    return spread.groupBy("low", "high").applyInArrow(search, NEIGHBOURS)


def embedding_topk(table: DataFrame, k: int = 3, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k nearest other vectors of every vector in `table` (id, vec), exactly.

    Ranks run from 1; equal cosines are ranked by id.
    """
    table = table.select(F.col("id").cast("bigint").alias("id"), F.col("vec"))
    spark = table.sparkSession
    size = table.agg(F.sum(F.size("vec").cast("bigint") * 8)).first()[0] or 0
    # Small enough blocks, and a pair of them for every task.
    n_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = max(-(-size // block_bytes) + 1, math.ceil(math.sqrt(2 * n_tasks)))
    found = _by_block_pairs(table, k, n_blocks, n_tasks)
    best = Window.partitionBy("id").orderBy(F.desc("cosine"), "neighbour")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("id", "rank", "neighbour", "cosine")
    )
