"""Token ids of two tokenizers, aligned over the bytes of the text.

A is a byte-level vocabulary and encodes space + text; B is a piece vocabulary that adds the
space itself. Where tokens of both end at one byte a group ends (`merge_path`); tokens of one
group are linked, each of A with each of B.

How many documents hold a pair of ids linked is counted over the whole corpus. Tasks put
documents into chunks of about `CHUNK_PAIRS` distinct pairs of a document. A chunk has a
dictionary of its pairs with the number of its documents that hold each, and documents point
into it. Only dictionaries are shuffled by pair, with one row a chunk and pair, so no pair is
hot however many documents hold it; the counts then go back to their chunk. Chunks are
written, so texts are encoded once.

Null, empty and texts whose token bytes differ from space + text on either side have no tokens.
Repeated rows are documents of their own, doc_ids may be null or repeated, an empty table
gives no rows. Only doc_id and text are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.functions.arrow import lists
from hourcast.llm import merge_path
from hourcast.llm.text import stored
from hourcast.llm.tokens import IDS, encoder

# Texts aligned at a time: up to so many, and no further text beyond so many characters.
BATCH_TEXTS, BATCH_CHARACTERS = 256, 1 << 21
# Links made at a time, and those of a group from which its ids are counted first.
LINKS, LARGE_GROUP = 1 << 21, 1 << 12
CHUNK_PAIRS = 1 << 21

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
CHUNKS = (
    "chunk long, doc_id array<long>, groups_sha256 array<string>, "
    + "".join(f"{name} array<long>, " for name in COUNTS)
    + "n_pairs array<long>, at binary, times binary, pair array<long>, n_docs array<int>"
)
DOCUMENTS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
    "count_sum long, groups_sha256 string"
)


def vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return tuple(map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))


def byte_symbols() -> dict[str, int]:
    """The bytes that a byte-level vocabulary's characters stand for.

    Printable Latin-1 characters are themselves, other bytes are characters from 256 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [byte for byte in range(256) if byte not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary(NamedTuple):
    """An encoder of texts, and the bytes of every id."""

    encode: object
    tokens: pa.Array
    sizes: np.ndarray


def _vocabulary(encode, tokens: list[bytes]) -> Vocabulary:
    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
    return Vocabulary(encode, pa.array(tokens, pa.large_binary()), sizes)


@lru_cache(maxsize=2)
def byte_level(path: str) -> Vocabulary:
    """One for each worker process; encodes space + text."""
    from tokenizers import Tokenizer

    symbols, ids = byte_symbols(), Tokenizer.from_file(path).get_vocab()
    tokens = [b""] * (max(ids.values()) + 1)
    for token, at in ids.items():
        # A special token's string need not be of such characters; plain texts never get it.
        tokens[at] = bytes(symbols.get(c, 0) for c in token)
    own = encoder(path, plain=True)

    def encode(texts: list[str]) -> list[np.ndarray]:
        found = own(pa.array(texts, pa.string()), after_space=True)
        return [np.frombuffer(x, IDS).astype(np.int64) for x in found]

    return _vocabulary(encode, tokens)


@lru_cache(maxsize=2)
def pieces(path: str) -> Vocabulary:
    """One for each worker process; the model itself adds the space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def raw(piece: str) -> bytes:
        if re.fullmatch("<0x[0-9A-F]{2}>", piece):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in model.encode(texts, num_threads=1)]

    return _vocabulary(encode, [raw(model.id_to_piece(k)) for k in range(model.get_piece_size())])


class Side(NamedTuple):
    """The ids of all documents end to end, the end of each document, the group of each id."""

    ids: np.ndarray
    ends: np.ndarray
    group: np.ndarray


def _faithful(vocabulary: Vocabulary, ids: list[np.ndarray], raw: list[bytes]) -> list[bool]:
    """Whether the bytes of each document's tokens are those given."""
    sizes = [int(vocabulary.sizes[x].sum()) for x in ids]
    joined = vocabulary.tokens.take(pa.array(np.concatenate(ids)))
    held, at = memoryview(joined.buffers()[2] or b"").cast("B"), 0
    out = []
    for size, own in zip(sizes, raw, strict=True):
        out.append(held[at : at + size] == own)
        at += size
    return out


def aligned(texts: list[str | None], a: Vocabulary, b: Vocabulary) -> tuple[Side, Side]:
    """Ids and groups of every text; those without tokens have none on either side."""
    own = [(a.encode, a), (b.encode, b)]
    live = [k for k, text in enumerate(texts) if text]
    ids = [[np.empty(0, np.int64)] * len(texts) for _ in own]
    if live:
        some = [texts[k] for k in live]
        raw = [b" " + text.encode() for text in some]
        found = [encode(some) for encode, _ in own]
        good = [_faithful(v, x, raw) for (_, v), x in zip(own, found, strict=True)]
        for place, k in enumerate(live):
            if good[0][place] and good[1][place]:
                for side in (0, 1):
                    ids[side][k] = found[side][place]
    flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in ids]
    ends = [np.cumsum([len(x) for x in side], dtype=np.int64) for side in ids]
    # Texts lie end to end; both sides end with each text, so no group crosses them.
    at = [np.cumsum(v.sizes[x]) for (_, v), x in zip(own, flat, strict=True)]
    group = merge_path.groups(*at)
    return tuple(Side(flat[k], ends[k], group[k]) for k in (0, 1))


def _starts(side: Side, n: int) -> np.ndarray:
    """Where each group begins on a side; one more for the end."""
    return np.concatenate(([0], np.cumsum(np.bincount(side.group, minlength=n))))


def digests(a: Side, b: Side) -> list[str]:
    """SHA-256 of the groups in writing, `a1,a2|b1;a3|b2,b3`; empty without tokens."""
    if not len(a.ids):
        return [""] * len(a.ends)
    n = int(a.group[-1]) + 1
    a_start, b_start = _starts(a, n), _starts(b, n)
    top = int(max(a.ids.max(), b.ids.max())) + 1
    comma, bar, semicolon = 0, top, 2 * top
    order = np.empty(len(a.ids) + len(b.ids), np.int64)
    a_key, b_key = a.ids + comma, b.ids + comma
    a_key[a_start[1:] - 1] += bar
    b_key[b_start[1:] - 1] += semicolon
    # A group's tokens of A follow the tokens of B of the groups before it.
    order[np.arange(len(a.ids)) + b_start[a.group]] = a_key
    order[np.arange(len(b.ids)) + a_start[b.group + 1]] = b_key
    used, at = np.unique(order, return_inverse=True)
    written = pa.array([f"{k % top}{',|;'[k // top]}" for k in used.tolist()], pa.large_binary())
    text = written.take(pa.array(at))
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[: len(order) + 1]
    held = memoryview(text.buffers()[2]).cast("B")
    ends = offsets[a.ends + b.ends]
    begins = np.append(0, ends[:-1])
    return [
        hashlib.sha256(held[x : y - 1]).hexdigest() if y > x else ""
        for x, y in zip(begins.tolist(), ends.tolist(), strict=True)
    ]


def _summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[first], np.add.reduceat(count, first) if len(first) else count


def pair_times(a: Side, b: Side, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair (a * width + b) and links of it, by document and pair.

    Links are made a bounded number at a time. Of a large group the ids of either side are
    counted first, so that its links are never written out one by one.
    """
    if not len(a.ids):
        return (np.empty(0, np.int64),) * 3
    n, n_pairs = int(a.group[-1]) + 1, (int(a.ids.max()) + 1) * width
    a_start, b_start = _starts(a, n), _starts(b, n)
    n_a, n_b = np.diff(a_start), np.diff(b_start)
    document = np.searchsorted(a.ends, a_start[:-1], side="right") * n_pairs
    links = n_a * n_b
    keys, times, held = [], [], 0

    def add(key: np.ndarray, count: np.ndarray) -> None:
        nonlocal keys, times, held
        keys.append(key)
        times.append(count)
        held += len(key)
        if held > 4 * LINKS:
            one = _summed(keys, times)
            # What is left is distinct; as much may come again before the next time.
            keys, times, held = [one[0]], [one[1]], 0

    single = np.flatnonzero(links == 1)
    key = document[single] + a.ids[a_start[single]] * width + b.ids[b_start[single]]
    add(key, np.ones(len(key), np.int64))
    several = np.flatnonzero((links > 1) & (links < LARGE_GROUP))
    bounds = np.searchsorted(np.cumsum(links[several]), np.arange(LINKS, links[several].sum() + LINKS, LINKS))
    for some in np.split(several, bounds):
        rows = np.repeat(some, links[some])
        step = np.arange(len(rows)) - np.repeat(np.cumsum(links[some]) - links[some], links[some])
        i, j = a_start[rows] + step // n_b[rows], b_start[rows] + step % n_b[rows]
        add(document[rows] + a.ids[i] * width + b.ids[j], np.ones(len(rows), np.int64))
    for g in np.flatnonzero(links >= LARGE_GROUP).tolist():
        x, of_x = np.unique(a.ids[a_start[g] : a_start[g + 1]], return_counts=True)
        y, of_y = np.unique(b.ids[b_start[g] : b_start[g + 1]], return_counts=True)
        rows = max(1, LINKS // len(y))
        for k in range(0, len(x), rows):
            key = (document[g] + x[k : k + rows, None] * width + y[None, :]).ravel()
            add(key, (of_x[k : k + rows, None] * of_y[None, :]).ravel())
    key, count = _summed(keys, times)
    return key // n_pairs, key % n_pairs, count


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers as their lowest bytes, then the next ones: small ones compress well."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    bytes_ = np.frombuffer(raw, np.uint8).reshape(4, -1).T
    return np.ascontiguousarray(bytes_).view("<u4").ravel().astype(np.int64)


class _Chunk:
    """Documents of one chunk as they come."""

    def __init__(self) -> None:
        self.columns = {name: [] for name in ("doc_id", "groups_sha256", *COUNTS, "n_pairs")}
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.n = 0

    def add(self, doc_ids: list, a: Side, b: Side, width: int) -> None:
        document, pair, times = pair_times(a, b, width)
        n_groups = int(a.group[-1]) + 1 if len(a.ids) else 0
        n_a, n_b = (np.diff(s.ends, prepend=0) for s in (a, b))
        # The groups before each document's end, and the links in them.
        ends = np.append(a.group, n_groups)[a.ends]
        a_start, b_start = _starts(a, n_groups), _starts(b, n_groups)
        links = np.append(0, np.cumsum(np.diff(a_start) * np.diff(b_start)))[ends]
        found = {
            "doc_id": doc_ids,
            "groups_sha256": digests(a, b),
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.diff(ends, prepend=0),
            "n_links": np.diff(links, prepend=0),
            "n_pairs": np.bincount(document, minlength=len(doc_ids)),
        }
        for name, values in found.items():
            self.columns[name].extend(values if isinstance(values, list) else values.tolist())
        self.pairs.append(pair)
        self.times.append(times)
        self.n += len(pair)

    def row(self, number: int) -> pa.RecordBatch:
        pairs = np.concatenate(self.pairs)
        dictionary, at = np.unique(pairs, return_inverse=True)
        n_docs = np.bincount(at, minlength=len(dictionary))
        # Places rise within a document, but for the step back where the next one begins.
        arrays = {name: pa.array([x], pa.list_(pa.int64())) for name, x in self.columns.items() if name != "groups_sha256"}
        return pa.record_batch(
            {
                "chunk": pa.array([number], pa.int64()),
                "doc_id": arrays["doc_id"],
                "groups_sha256": pa.array([self.columns["groups_sha256"]], pa.list_(pa.string())),
                **{name: arrays[name] for name in (*COUNTS, "n_pairs")},
                "at": pa.array([_planes(np.diff(at, prepend=0))], pa.binary()),
                "times": pa.array([_planes(np.concatenate(self.times))], pa.binary()),
                "pair": pa.array([dictionary], pa.list_(pa.int64())),
                "n_docs": pa.array([n_docs.astype(np.int32)], pa.list_(pa.int32())),
            }
        )


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str | None]]]:
    """doc_ids and texts, a bounded number at a time; a long text comes alone."""
    doc_ids, texts = batch["doc_id"].to_pylist(), batch["text"]
    sizes = pc.binary_length(texts).fill_null(0).to_numpy()
    start, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if k > start and (k - start == BATCH_TEXTS or held + size > BATCH_CHARACTERS):
            yield doc_ids[start:k], texts[start:k].to_pylist()
            start, held = k, 0
        held += size
    if len(doc_ids) > start:
        yield doc_ids[start:], texts[start:].to_pylist()


def _chunked(a_path: str, b_path: str, chunk_pairs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(a_path), pieces(b_path)
        number, chunk = TaskContext.get().partitionId() << 32, _Chunk()
        for batch in batches:
            for doc_ids, texts in _slices(batch):
                chunk.add(doc_ids, *aligned(texts, a, b), len(b.sizes))
                if chunk.n >= chunk_pairs:
                    yield chunk.row(number)
                    number, chunk = number + 1, _Chunk()
        if chunk.columns["doc_id"]:
            yield chunk.row(number)

    return run


def chunks(
    df: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    chunk_pairs: int = CHUNK_PAIRS,
) -> DataFrame:
    """Documents aligned and put into chunks with dictionaries of their pairs, written."""
    a_path, b_path = a_path or vocabularies()[0], b_path or vocabularies()[1]
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(_chunked(a_path, b_path, chunk_pairs), CHUNKS)
    return stored(found, "aligned", compression="zstd")


def _pair_rows(chunked: DataFrame) -> DataFrame:
    return chunked.select(
        "chunk", F.posexplode(F.arrays_zip("pair", "n_docs")).alias("place", "entry")
    ).select("chunk", "place", F.col("entry.pair").alias("pair"), F.col("entry.n_docs").alias("n_docs"))


def pair_counts(chunked: DataFrame, b_size: int) -> DataFrame:
    """a, b, n_docs: the documents that hold ids a and b linked."""
    return (
        _pair_rows(chunked)
        .groupBy("pair")
        .agg(F.sum("n_docs").alias("n_docs"))
        .select(
            F.expr(f"cast(pair div {b_size} as int)").alias("a"),
            (F.col("pair") % b_size).cast("int").alias("b"),
            "n_docs",
        )
    )


def _counted(chunked: DataFrame, b_size: int) -> DataFrame:
    """chunk, place, count over the corpus, and whether it is the highest of its A id."""
    over = F.sum("n_docs").over(Window.partitionBy("pair"))
    counted = stored(
        _pair_rows(chunked).select(
            "chunk", "place", F.expr(f"pair div {b_size}").alias("a"), over.alias("count")
        ),
        "pair_counts",
    )
    # At most one row an id of A's vocabulary.
    best = counted.groupBy("a").agg(F.max("count").alias("best"))
    return counted.join(F.broadcast(best), "a").select(
        "chunk", "place", "count", (F.col("count") == F.col("best")).alias("is_best")
    )


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one chunk, from its row and the counts of its dictionary."""
    place = right["place"].to_numpy()
    count, best = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
    count[place], best[place] = right["count"].to_numpy(), right["is_best"].to_numpy()
    part = left.combine_chunks().to_batches()[0]
    # Differences are kept modulo 2^32, as a step back is negative.
    at = np.cumsum(_from_planes(part["at"][0].as_py())) % (1 << 32)
    times = _from_planes(part["times"][0].as_py())
    ends = np.cumsum(lists(part, "n_pairs")[0])

    def total(value: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(times * value[at]))
        return np.diff(sums[ends], prepend=0)

    return pa.table(
        {
            "doc_id": part["doc_id"].flatten(),
            **{name: part[name].flatten() for name in COUNTS},
            "n_best": total(best),
            "count_sum": total(count),
            "groups_sha256": part["groups_sha256"].flatten(),
        }
    )


def digest(
    df: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    chunk_pairs: int = CHUNK_PAIRS,
) -> DataFrame:
    """Counts of tokens, groups and links of every document (doc_id, text).

    n_best: links whose count is the highest of their A id, ties included; count_sum: the sum
    of the counts of its links.
    """
    chunked = chunks(df, a_path, b_path, chunk_pairs)
    b_size = len(pieces(b_path or vocabularies()[1]).sizes)
    counted = _counted(chunked, b_size)
    documents = chunked.drop("pair", "n_docs").groupBy("chunk")
    return documents.cogroup(counted.groupBy("chunk")).applyInArrow(_scored, DOCUMENTS)


def alignments(df: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id and, for both sides, the ids in order and the group of each, from 0."""
    a_path, b_path = a_path or vocabularies()[0], b_path or vocabularies()[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(a_path), pieces(b_path)
        for batch in batches:
            for doc_ids, texts in _slices(batch):
                columns = {"doc_id": pa.array(doc_ids, pa.int64())}
                for name, side in zip("ab", aligned(texts, a, b), strict=True):
                    starts = np.append(0, side.ends)
                    # Groups are numbered over the whole batch; the first of a text is its 0.
                    first = np.append(side.group, 0)[starts[:-1]]
                    own = side.group - np.repeat(first, np.diff(starts))
                    for column, values in (("ids", side.ids), ("group", own)):
                        columns[f"{name}_{column}"] = pa.ListArray.from_arrays(
                            pa.array(starts, pa.int32()), pa.array(values, pa.int32())
                        )
                yield pa.record_batch(columns)

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, a_ids array<int>, a_group array<int>, b_ids array<int>, b_group array<int>"
    return rows.mapInArrow(run, schema)
