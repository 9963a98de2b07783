"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: as many of the
longest length as fit, then the binary digits of the rest, in falling order. A piece is
a whole sequence, so no sequence crosses documents and none is padded. Pieces are written to a
bucket, a folder, for each length (`bucketed`), so training draws batches of equal lengths.

Every row is cut where it is read: no shuffle, no group. Null and empty texts are the
end id alone, repeated rows are packed one by one, an empty table gives no pieces. Only doc_id
and text are read, so further columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hourcast.llm.text import whole_text
from hourcast.llm.tokens import IDS, default_vocabulary, encoder, id_lists
from hourcast.session import scratch_path

LONGEST = 2048
END_ID = 1
_BATCH = 1_000


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Powers of two in falling order that add up to n."""
    if longest & (longest - 1):
        raise ValueError(f"{longest} is not a power of two")
    rest = n % longest
    digits = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    return [longest] * (n // longest) + digits


def _cut(path: str, end_id: int, longest: int, with_tokens: bool):
    end = np.array([end_id], dtype=IDS).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for whole in batches:
            for at in range(0, len(whole), _BATCH):
                batch = whole.slice(at, _BATCH)
                rows, pieces = [], []
                for doc_id, ids in zip(
                    batch["doc_id"].to_pylist(), encode(batch["text"]), strict=True
                ):
                    ids += end
                    start = 0
                    for length in piece_lengths(len(ids) // 4, longest):
                        piece = ids[4 * start : 4 * (start + length)]
                        rows.append((doc_id, start, length, zlib.crc32(piece), len(ids) // 4))
                        pieces.append(piece)
                        start += length
                columns = [list(x) for x in zip(*rows, strict=True)] or [[]] * 5
                out = {
                    name: pa.array(values, pa.int64())
                    for name, values in zip(
                        ("doc_id", "start", "length", "ids_crc32", "doc_tokens"), columns, strict=True
                    )
                }
                yield pa.record_batch(out | ({"tokens": id_lists(pieces)} if with_tokens else {}))

    return run


def pack(
    df: DataFrame,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    longest: int = LONGEST,
    with_tokens: bool = True,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, tokens, sequence_id, offset: one row a piece.

    sequence_id is unique and depends on the order in which the rows of df are read.
    """
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = rows.mapInArrow(
        _cut(vocabulary or default_vocabulary(), end_id, longest, with_tokens),
        schema + (", tokens array<int>" if with_tokens else ""),
    )
    return pieces.withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder for each length, so that a batch is read from equal lengths."""
    pieces.write.option("compression", "zstd").partitionBy("length").parquet(path)


def read_buckets(spark: SparkSession, path: str, like: StructType) -> DataFrame:
    """The pieces of all buckets, with the columns of `like`; a filter on length reads its folder."""
    return spark.read.schema(like).parquet(path).select(*like.names)


def bucketed(pieces: DataFrame) -> DataFrame:
    """Pieces written to their buckets below the shared folder, and read from there."""
    path = scratch_path(pieces.sparkSession, "buckets")
    write_buckets(pieces, path)
    return read_buckets(pieces.sparkSession, path, pieces.schema)
