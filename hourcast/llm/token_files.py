"""Documents as token ids in Parquet files that allow selective reads.

Files hold ascending doc_ids (one range each), row groups of `ROW_GROUP_BYTES` and
pages of `PAGE_BYTES` with column and offset indexes, so a reader fetches the pages of
the rows and columns it asks for. Ids are a list column with a dictionary (at most as
many entries as the vocabulary); ids of rows, counts and positions are delta encoded.

`part` is the range's number and `part_start` the ids before a document in it; the
start in the whole corpus needs only those columns and one sum for each range.

A null text is empty and has just the end id, null doc_ids come first, repeated rows
follow each other in no special order. An empty table gives files without rows. Only doc_id
and text are read, so further columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourcast.llm.text import whole_text
from hourcast.llm.tokens import IDS, default_vocabulary, encoder, id_lists, stretches

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
END_ID = 2
_BATCH_BYTES, _BATCH = 6 << 20, 500

FORMAT = {
    "parquet.writer.version": "v2",
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.enable.dictionary": "true",
    "compression": "zstd",
    **{
        f"parquet.enable.dictionary#{name}": "false"
        for name in ("doc_id", "part", "part_start", "n_tokens")
    },
}


def _encode(path: str, end_id: int):
    end = np.array([end_id], dtype=IDS).tobytes()

    def encoded(batch: pa.RecordBatch, start: int) -> pa.RecordBatch:
        tokens = id_lists(encoder(path)(batch["text"]), end)
        n = np.diff(tokens.offsets.to_numpy()).astype(np.int64)
        return pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "part": batch["part"],
                "part_start": start + np.cumsum(n) - n,
                "n_tokens": n,
                "tokens": tokens,
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = 0
        for whole in batches:
            for first, after in stretches(whole["text"], _BATCH_BYTES):
                out = encoded(whole.slice(first, after - first), start)
                start += len(out["tokens"].values)
                # Rows leave a few at once: the JVM holds a whole batch outside its heap.
                yield from (out.slice(at, _BATCH) for at in range(0, len(out), _BATCH))
                del out
                # Else a worker keeps what its largest batches took.
                pa.default_memory_pool().release_unused()

    return run


def write_tokens(
    df: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID
) -> None:
    """Encode doc_id, text of df into token files below `path`, in ascending doc_id order."""
    rows = df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        whole_text().alias("text"),
        # Tells equal doc_ids apart, so that many of them do not share a range.
        F.monotonically_increasing_id().alias("row"),
    )
    ranges = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    ranges.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(
        _encode(vocabulary or default_vocabulary(), end_id),
        "doc_id long, part int, part_start long, n_tokens long, tokens array<int>",
    ).write.options(**FORMAT).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens; the ids themselves are not read."""
    return _started(spark, path, "n_tokens")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, tokens; start: ids of all documents before it."""
    return _started(spark, path, "n_tokens", "tokens")


def _started(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    files = spark.read.parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range, so as many as the writer had shuffle partitions: sent to
    # the files' readers, so that the ids are not shuffled.
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return files.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), *columns
    )


def checksums(tokens: DataFrame) -> DataFrame:
    """Adds ids_crc32 of the ids as little-endian unsigned 32-bit integers; drops them."""
    names = [name for name in tokens.columns if name != "tokens"]
    schema = ", ".join(f"{name} {tokens.schema[name].dataType.simpleString()}" for name in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["tokens"]
            offsets = lists.offsets.to_numpy()
            ids = lists.values.to_numpy(zero_copy_only=False).astype(IDS, copy=False)
            crc = [
                zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)
            ]
            yield pa.record_batch(
                {**{name: batch[name] for name in names}, "ids_crc32": pa.array(crc, pa.int64())}
            )

    return tokens.mapInArrow(run, f"{schema}, ids_crc32 long")
