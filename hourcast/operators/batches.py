"""Random order and mini-batches, both reproducible from a seed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourcast.functions.time import HOUR, add_hours
from hourcast.operators.keys import number_within
from hourcast.operators.series import wide_partitions

BLOCK = ["account_int", "metric_int", "block"]
SAMPLE = ["account_int", "metric_int", "hour"]

# Leading hex digits of the hash: their ranges are numbered in parallel. Sample
# keys are unique, so the ranges fill evenly however the data are skewed.
RANGE_DIGITS = 3


# Windows as `block_positions` takes them apart: a partition holds them in the order of their blocks,
# the same one whenever it is computed.
WINDOW = [*SAMPLE[:2], "_block", "_o", "hour"]

# Windows that are packed together, no more than two bytes can number; bits of the hash that tell
# the ranges of packed windows, which are numbered in parallel.
PACKED = 1 << 16
RANGE_BITS = 10

PACKS = "chunk bigint, range int, n int, places binary, hashes binary, rows binary"
RANKS = "chunk bigint, range int, places binary, ranks binary, rows binary"


def sample_hash(seed: int, hour: Column | None = None) -> Column:
    keys = [F.col("account_int"), F.col("metric_int"), F.col("hour") if hour is None else hour]
    return F.xxhash64(F.lit(seed), *keys)


def shuffle_samples(samples: DataFrame, seed: int = 0) -> DataFrame:
    """A random order: every row gets its `position`, 0 .. n-1.

    Rows are ordered by the MD5 of `seed:account_int:metric_int:hour`, which any
    engine can follow.
    """
    key = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in SAMPLE])
    if samples.columns == WINDOW:
        return _number_packed(samples.withColumn("_hash", F.unhex(F.md5(key))))
    hashed = samples.withColumn("_hash", F.md5(key))
    bucketed = hashed.withColumn("_bucket", F.substring("_hash", 1, RANGE_DIGITS))
    return number_within(bucketed, "_bucket", ["_hash", *SAMPLE], "position").drop("_hash")


def _column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Stretches of an array as bytes, one from each of `bounds` to the next."""
    at = pa.py_buffer((bounds * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, at, pa.py_buffer(np.ascontiguousarray(values))])


def _pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows by the chunk: a row for each range of their hashes, and the windows themselves, once."""
    chunk = TaskContext.get().partitionId() << 32

    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        windows = pa.Table.from_batches(batches).combine_chunks()
        hashes = np.frombuffer(b"".join(windows["_hash"].to_pylist()), np.uint8).reshape(-1, 16)
        of = (hashes[:, 0].astype(np.int32) << (RANGE_BITS - 8)) | (hashes[:, 1] >> (16 - RANGE_BITS))
        order = np.argsort(of, kind="stable")
        ranges, bounds = np.unique(of[order], return_index=True)
        bounds = np.append(bounds, len(order))
        stored = pa.BufferOutputStream()
        rows = windows.drop_columns(["_hash"])
        with pa.ipc.new_stream(stored, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows)
        n = len(ranges)
        columns = {
            "chunk": pa.array([chunk] * (n + 1), pa.int64()),
            "range": pa.array([*ranges, chunk % (1 << RANGE_BITS)], pa.int32()),
            "n": pa.array([*np.diff(bounds), 0], pa.int32()),
            "places": [*_column(order.astype(np.uint16), bounds), None],
            "hashes": [*_column(hashes[order].view("V16").ravel(), bounds), None],
            "rows": [None] * n + [stored.getvalue().to_pybytes()],
        }
        return pa.record_batch(
            {name: pa.array(c, pa.binary()) if isinstance(c, list) else c for name, c in columns.items()}
        )

    waiting: list[pa.RecordBatch] = []
    for part in parts:
        for at in range(0, part.num_rows, PACKED):
            some = part.slice(at, PACKED)
            if sum(b.num_rows for b in waiting) + some.num_rows > PACKED:
                yield packed(waiting)
                waiting, chunk = [], chunk + 1
            waiting.append(some)
    if waiting:
        yield packed(waiting)


def _rank(group: pa.Table) -> pa.Table:
    """The ranks of the hashes of one range, for each chunk in the order of its places."""
    whole, packs = group.filter(group["rows"].is_valid()), group.filter(group["rows"].is_null())
    hashes = np.frombuffer(b"".join(packs["hashes"].to_pylist()), ">u8").reshape(-1, 2)
    high, low = hashes[:, 0].astype(np.uint64), hashes[:, 1].astype(np.uint64)
    order = np.argsort(high)
    if (high[order][1:] == high[order][:-1]).any():
        order = np.lexsort((low, high))
    ranks = np.empty(len(order), np.uint32)
    ranks[order] = np.arange(len(order))
    bounds = np.cumsum([0, *packs["n"].to_numpy()])
    keys = ["chunk", "range", "places"]
    none = pa.nulls(len(whole), pa.binary())
    return pa.concat_tables(
        [
            packs.select(keys).append_column("ranks", _column(ranks, bounds)).append_column("rows", packs["rows"]),
            whole.select(keys).append_column("ranks", none).append_column("rows", whole["rows"]),
        ]
    )


def _size(group: pa.Table) -> pa.Table:
    return pa.table(
        {"range": group["range"].slice(0, 1), "_size": pa.array([int(group["n"].to_numpy().sum())], pa.int64())}
    )


def _unpack(group: pa.Table) -> pa.Table:
    """The windows of a chunk with their positions."""
    (stored,) = group["rows"].drop_null().to_pylist()
    windows = pa.ipc.open_stream(stored).read_all()
    position = np.empty(windows.num_rows, np.int64)
    packs = group.filter(group["rows"].is_null())
    for start, places, ranks in zip(*(packs[c].to_pylist() for c in ("start", "places", "ranks"))):
        position[np.frombuffer(places, np.uint16)] = start + np.frombuffer(ranks, np.uint32).astype(np.int64)
    return windows.append_column("position", pa.array(position))


def _number_packed(hashed: DataFrame) -> DataFrame:
    """What `number_within` makes of the order by hash, with 24 bytes a window shuffled.

    Windows stay together in chunks. Only their hashes go to the ranges and only their ranks come
    back, both as packed numbers, so that nothing is sorted row by row.
    """
    tasks = wide_partitions(hashed)
    # By number, as the few rows of many windows would be merged by their size.
    spread = hashed.mapInArrow(_pack, PACKS).repartition(tasks, "range")
    # An aggregate would read two columns only, of another shuffle for which all is hashed again.
    sizes = spread.groupBy("range").applyInArrow(_size, "range int, _size bigint")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("start"))
    # One row a range, whatever the number of windows.
    ranked = spread.groupBy("range").applyInArrow(_rank, RANKS).join(F.broadcast(starts), "range")
    rows = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in hashed.drop("_hash").schema)
    back = ranked.repartition(tasks, "chunk")
    return back.groupBy("chunk").applyInArrow(_unpack, f"{rows}, position bigint")


def _runs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that follow one another in a block as one row with the `positions` of all."""
    for part in parts:
        if not part.num_rows:
            continue
        keys = [part[c].to_numpy(zero_copy_only=False) for c in (*SAMPLE[:2], "_block")]
        follows = np.diff(part["_o"].to_numpy()) == 1
        for key in keys:
            follows &= key[1:] == key[:-1]
        first = np.flatnonzero(np.append(True, ~follows))
        bounds = pa.array(np.append(first, part.num_rows), pa.int32())
        taken = pa.array(first)
        yield pa.record_batch(
            {c: part[c].take(taken) for c in (*SAMPLE[:2], "_block", "_o")}
            | {"positions": pa.ListArray.from_arrays(bounds, part["position"])}
        )


def block_positions(keys: DataFrame, seed: int = 0, block: str = "block") -> DataFrame:
    """account_int, metric_int, `block`, positions: where `shuffle_samples` puts each window.

    `keys` are rows of account_int, metric_int, hour (of the first window), n_windows and
    `block`, which tells the blocks of a series apart. Only keys are shuffled, never values;
    an array has one cell a window, so a block's is bounded as its values are.
    """
    starts = keys.select(
        *SAMPLE[:2], F.col(block).alias("_block"), F.col("hour").alias("_from"), "n_windows"
    )
    # Blocks are spread before they are taken apart: the few files of a dimension would leave
    # all windows to as many tasks.
    windows = (
        starts.repartition(wide_partitions(starts), *SAMPLE[:2], "_block")
        .sortWithinPartitions(*SAMPLE[:2], "_block")
        .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("n_windows") - 1)))
        .select(*SAMPLE[:2], "_block", "_o", add_hours("_from", F.col("_o")).alias("hour"))
    )
    numbered = shuffle_samples(windows, seed).select(*WINDOW[:-1], "position")
    fields = {f.name: f.dataType.simpleString() for f in windows.schema}
    schema = ", ".join(f"{c} {fields[c]}" for c in WINDOW[:-1]) + ", positions array<bigint>"
    # Few and long rows are shuffled; a cut of the block between two of them is mended after it.
    runs = numbered.mapInArrow(_runs, schema)
    placed = F.sort_array(F.collect_list(F.struct("_o", "positions")))
    return (
        runs.repartition(wide_partitions(starts), *SAMPLE[:2], "_block")
        .groupBy(*SAMPLE[:2], F.col("_block").alias(block))
        .agg(F.flatten(placed["positions"]).alias("positions"))
    )


def ordered_blocks(blocks: DataFrame, keys: DataFrame, seed: int = 0) -> DataFrame:
    """Blocks with the `positions` of their windows in the random order.

    `blocks` are numbered, and so already lie by the columns of the join: their values stay
    where they are, and only the positions come to them.
    """
    return blocks.join(block_positions(keys, seed), BLOCK)


def batch_at(batch_size: int) -> Column:
    """Exact mini-batches of the random order; the last may be smaller."""
    return F.floor(F.col("position") / batch_size).cast("int")


def batches(samples: DataFrame, batch_size: int, seed: int = 0) -> DataFrame:
    """Samples with `position` and `batch`; samples that have a position keep it."""
    ordered = samples if "position" in samples.columns else shuffle_samples(samples, seed)
    return ordered.withColumn("batch", batch_at(batch_size))


def batch_of(n_batches: int, seed: int, hour: Column | None = None) -> Column:
    """Batch of a sample by hash alone: about equal sizes, no shuffle."""
    return F.pmod(sample_hash(seed, hour), F.lit(n_batches)).cast("int")


def window_batches(blocks: DataFrame, n_batches: int, seed: int = 0) -> DataFrame:
    """`batch_of` for every window of a block, as the array `batch`."""
    last = add_hours("hour", F.col("n_windows") - 1)
    # Hours come as a sequence: adding them up inside the function took longer than the hash.
    hours = F.sequence("hour", last, F.expr(HOUR))
    return blocks.withColumn("batch", F.transform(hours, lambda h: batch_of(n_batches, seed, h)))


def take_batch(ordered: DataFrame, batch_size: int, data_index: int) -> DataFrame:
    """Rows at positions [data_index, data_index + batch_size); empty is an error."""
    taken = ordered.where(F.col("position").between(data_index, data_index + batch_size - 1))
    if taken.isEmpty():
        raise ValueError(f"data_index {data_index} is past the last sample")
    return taken
