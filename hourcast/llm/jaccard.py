"""Exact Jaccard self-join of word-shingle sets by a forest of signature trees.

Equal sets are one leaf. A leaf of n tokens has its `prefix`: the first
n - ceil(t n) + 1 tokens in one order for all documents; two sets that reach the
similarity t share a prefix token, so every token of a prefix is the root of a tree
over the leaves that hold it. Below a root, inner nodes hold leaves that are already
known to be connected, with the OR of their bitmaps, their size range and their
largest bitmap excess (tokens minus bits); leaves hold a bitmap of their whole set.

Traversal is dual, a tree against itself, in two sweeps:

1. each leaf against the leaf of its tree that is in most trees (copies with changes have
   tokens of their own, the text they come from has none). Verified links make components,
   so copies of one text, however many, end in one inner node;
2. pairs of different inner nodes of a tree. A pair is pruned when size ranges, the tokens
   that follow the root, or common bits of the OR-bitmaps plus the smaller excess cannot
   reach t. Remaining pairs of components are compared in chunks of about `CHUNK` leaves:
   leaf pairs are pruned by sizes and bitmaps inside a task, and the rest is verified.

Pairs inside one inner node are never made: their leaves are connected already. Links
between different components are all found, so components are exact. (If two similar sets
first meet at a root, they share no token before it, so at most the tokens from it on.)

Order of tokens: tokens that many documents hold come last, so that passages shared by
many documents are roots only where they make up nearly a whole document. Those that occur
twice in a batch of rows are counted, and at most `FREQUENT` of them are sent to the tasks;
others, a passage that each batch has once among them, order by their hash. Any order gives
the same result, only with more or less work.

Null, empty and wordless texts have the empty set and are alone. Fewer words than the
shingle width are one shingle. Repeated rows each get a row; a null doc_id never names
a component unless nothing else can. An empty table gives no rows. `similar_groups` reads doc_id
and text only; `one_of_each` keeps all other columns, whatever their names.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.graph import components
from hourcast.llm.shingles import bitmap, folded, most_common, shared, shingle_sets
from hourcast.llm.text import stored, whole_text

FREQUENT = 500_000
LEAST_FREQUENT = 64
NODE_WORDS = 16
CHUNK = 128
_SETS_HELD = 2_000
# What parts words.
WHITE = " \t\n\x0b\x0c\r"


def _rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(whole_text()).alias("text_hash"),
        whole_text().alias("text"),
    )


def _repeated_tokens(width: int):
    """Tokens that more than one text of a batch holds, with their number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch["text"], width))
            tokens = np.sort(np.concatenate(sets)) if sets else np.empty(0, dtype=np.uint64)
            starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])[: len(tokens)])
            counts = np.diff(np.append(starts, len(tokens)))
            many = counts > 1
            yield pa.record_batch(
                {
                    "token": tokens[starts[many]].view(np.int64),
                    "n": counts[many].astype(np.int64),
                }
            )

    return run


def frequent_tokens(rows: DataFrame, width: int) -> np.ndarray:
    """Sorted; at most FREQUENT of those that tasks have seen more than once."""
    counted = (
        rows.select("text")
        .mapInArrow(_repeated_tokens(width), "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= LEAST_FREQUENT)
    )
    top = counted.orderBy(F.desc("n"), "token").limit(FREQUENT).select("token")
    return np.sort(top.toArrow()["token"].to_numpy().view(np.uint64))


def _sketches(width: int, percent: int, frequent, sizes_only: bool = False):
    """A set's size, fingerprint, prefix and bitmaps; or size and fingerprint alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = frequent.value
        for batch in batches:
            n, sig, prefix, bits = [], [], [], []
            for tokens in shingle_sets(batch["text"], width):
                size = len(tokens)
                n.append(size)
                if not size:
                    sig.append(None)
                    prefix.append(tokens.view(np.int64))
                    bits.append(b"")
                    continue
                sig.append(blake2b(tokens.tobytes(), digest_size=16).digest())
                if sizes_only:
                    prefix.append(tokens[:0].view(np.int64))
                    bits.append(b"")
                    continue
                if len(last):
                    at = np.minimum(np.searchsorted(last, tokens), len(last) - 1)
                    late = last[at] == tokens
                    ordered = np.concatenate((tokens[~late], tokens[late]))
                else:
                    ordered = tokens
                # Any similar set shares at least ceil(t size) of the tokens.
                prefix.append(ordered[: size + -percent * size // 100 + 1].view(np.int64))
                bits.append(bitmap(tokens))
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in prefix]))).astype(np.int32)
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "text_hash": batch["text_hash"],
                    "n": pa.array(n, pa.int64()),
                    "sig": pa.array(sig, pa.binary()),
                    "prefix": pa.ListArray.from_arrays(
                        offsets, np.concatenate(prefix) if prefix else np.empty(0, dtype=np.int64)
                    ),
                    "bits": pa.array(bits, pa.binary()),
                }
            )

    return run


_SKETCH = "doc_id long, text_hash long, n long, sig binary, prefix array<long>, bits binary"


def _node_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps folded to the words of an inner node."""
    for batch in batches:
        words = [folded(bits, 8 * NODE_WORDS).view(np.int64) for bits in batch["bits"].to_pylist()]
        yield pa.record_batch(
            {
                "node": batch["node"],
                "node_bits": pa.array([w.tolist() for w in words], pa.list_(pa.int64())),
            }
        )


def _prune(percent: int):
    """Leaf pairs of two lists of leaves whose sizes and bitmaps leave room for the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One pair of chunks at a time.
            for k in range(len(batch)):
                one, two = batch["one"][k].as_py(), batch["two"][k].as_py()
                # Bitmaps of one length are compared at once.
                lengths: dict[int, list[int]] = {}
                for i, leaf in enumerate(two):
                    lengths.setdefault(len(leaf["bits"]), []).append(i)
                a, b = [], []
                for rows in lengths.values():
                    bits = np.array([np.frombuffer(two[i]["bits"], dtype=np.uint8) for i in rows])
                    sizes = np.array([two[i]["n"] for i in rows])
                    for leaf in one:
                        n = leaf["n"]
                        most = np.minimum(
                            most_common(leaf["bits"], n, bits, sizes), np.minimum(n, sizes)
                        )
                        for i in np.flatnonzero(100 * most >= percent * (n + sizes - most)).tolist():
                            a.append(leaf["node"])
                            b.append(two[rows[i]]["node"])
                if a:
                    yield pa.record_batch(
                        {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}
                    )

    return run


def _exact(width: int, percent: int):
    """Pairs of texts that reach the similarity. A bounded number of sets is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[int, np.ndarray] = OrderedDict()

        def sets(batch: pa.RecordBatch, node: str, text: str) -> list[np.ndarray]:
            out = []
            for key, value in zip(batch[node].to_pylist(), batch[text], strict=True):
                if key not in held:
                    held[key] = next(shingle_sets(pa.array([value.as_py()], pa.string()), width))
                    if len(held) > _SETS_HELD:
                        held.popitem(last=False)
                out.append(held[key])
            return out

        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                a, b = [], []
                for x, y, one, two in zip(
                    part["a"].to_pylist(),
                    part["b"].to_pylist(),
                    sets(part, "a", "text_a"),
                    sets(part, "b", "text_b"),
                    strict=True,
                ):
                    common = shared(one, two)
                    if 100 * common >= percent * (len(one) + len(two) - common):
                        a.append(x)
                        b.append(y)
                yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _links(candidates: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs of `one` and `two` (arrays of leaves) whose sets reach the similarity.

    Texts of leaves that are in no pair left by the pruning are not moved.
    """
    pairs = stored(
        candidates.select("one", "two").mapInArrow(_prune(percent), "a long, b long"), "candidates"
    )
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = texts.join(wanted, "node", "left_semi").select("node", "text")
    return stored(
        pairs.join(texts.toDF("a", "text_a"), "a")
        .join(texts.toDF("b", "text_b"), "b")
        .mapInArrow(_exact(width, percent), "a long, b long"),
        "links",
    )


def _sizes_fit(one: Column, two: Column, percent: int) -> Column:
    return (100 * one >= percent * two) & (100 * two >= percent * one)


def _component_pairs(trees: DataFrame, percent: int) -> DataFrame:
    """Components c1 < c2 that have, in some tree, inner nodes with room for the similarity."""
    bits = [F.get("node_bits", F.lit(k)) for k in range(NODE_WORDS)]
    excess = F.col("n") - sum(F.bit_count(x) for x in bits)
    inner = trees.groupBy("token", "component").agg(
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.max("room").alias("room"),
        F.max(excess).alias("excess"),
        *(F.bit_or(x).alias(f"w{k}") for k, x in enumerate(bits)),
    )
    names = ("least", "most", "room", "excess", *(f"w{k}" for k in range(NODE_WORDS)))
    one, two = (
        inner.select("token", F.col("component").alias(f"c{s}"), *(F.col(x).alias(f"{x}_{s}") for x in names))
        for s in (1, 2)
    )
    common = sum(
        F.bit_count(F.col(f"w{k}_1").bitwiseAND(F.col(f"w{k}_2"))) for k in range(NODE_WORDS)
    ) + F.least("excess_1", "excess_2")
    # Similar sets share t / (1 + t) of their sizes' sum.
    needed = percent * (F.col("least_1") + F.col("least_2"))
    return (
        one.join(two, "token")
        .filter(F.col("c1") < F.col("c2"))
        .filter(
            (100 * F.col("most_1") >= percent * F.col("least_2"))
            & (100 * F.col("most_2") >= percent * F.col("least_1"))
            & ((100 + percent) * F.least("room_1", "room_2") >= needed)
            & ((100 + percent) * common >= needed)
        )
        .select("c1", "c2")
        .distinct()
    )


def _chunks(leaves: DataFrame) -> DataFrame:
    """component, chunk, leaves: about CHUNK (node, n, bits) of a component together."""
    counts = leaves.groupBy("component").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    return (
        leaves.join(counts, "component")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
        .groupBy("component", "chunk")
        .agg(F.collect_list(F.struct("node", "n", "bits")).alias("leaves"))
    )


def similar_groups(df: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, group of each row.

    Rows are linked when 100 * common >= percent * union of their shingles. `group` names the
    component, also where no row of it has a doc_id; it is null for texts without words.
    """
    spark = df.sparkSession
    rows = _rows(df)
    frequent = spark.sparkContext.broadcast(frequent_tokens(rows, width))
    sketched = rows.mapInArrow(_sketches(width, percent, frequent), _SKETCH)
    # Prefixes and bitmaps are kept once for equal sets, not for every row.
    sketches = stored(
        rows.mapInArrow(_sketches(width, percent, frequent, sizes_only=True), _SKETCH).drop("prefix", "bits"),
        "sketches",
    )
    leaves = stored(
        sketched.filter("n > 0")
        .groupBy("sig")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first"),
            F.count("*").alias("copies"),
            *(F.first(x).alias(x) for x in ("n", "prefix", "bits")),
        )
        .select("sig", "first.doc_id", "first.text_hash", "copies", "n", "prefix", "bits")
        .withColumn("node", F.monotonically_increasing_id()),
        "leaves",
    )
    roots = leaves.select("node", "n", F.posexplode("prefix").alias("at", "token"))
    # Most tokens are roots of one leaf alone; they are moved once, and no further.
    alike = F.count("*").over(Window.partitionBy("token"))
    trees = stored(
        roots.select("token", "node", "n", (F.col("n") - F.col("at")).alias("room"), alike.alias("alike"))
        .filter("alike > 1")
        .drop("alike"),
        "trees",
    )
    listed = trees.select("node").distinct()
    key = ["no_id", "id", "text_hash"]
    own_key = (
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        "text_hash",
    )
    # Repeated rows meet where the join has put them: texts are shuffled once.
    texts = stored(
        rows.select(*own_key, "text")
        .join(leaves.join(listed, "node", "left_semi").select(*own_key, "node"), key)
        .dropDuplicates([*key, "node"])
        .select("node", "text"),
        "texts",
        compression="zstd",
    )
    weights = trees.groupBy("node").agg(F.count("*").alias("weight"))
    heads = (
        trees.join(weights, "node")
        .groupBy("token")
        .agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"), "n")).alias("h"))
        .select("token", (-F.col("h.minus")).alias("head"), F.col("h.n").alias("n_head"))
    )
    first = (
        trees.join(heads, "token")
        .filter((F.col("node") != F.col("head")) & _sizes_fit(F.col("n"), F.col("n_head"), percent))
        .select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b"))
        .distinct()
    )
    leaf = leaves.select("node", F.array(F.struct("node", "n", "bits")).alias("leaf"))
    links = _links(
        first.join(leaf.toDF("a", "one"), "a").join(leaf.toDF("b", "two"), "b"), texts, width, percent
    )
    known = stored(components(links), "components")
    inner = trees.join(known, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    mixed = (
        inner.groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("token")
    )
    open_trees = stored(inner.join(mixed, "token", "left_semi"), "open")
    open_leaves = leaves.join(
        open_trees.select("node", "component").distinct(), "node"
    ).select("node", "component", "n", "bits")
    node_bits = open_leaves.select("node", "bits").mapInArrow(
        _node_bits, "node long, node_bits array<long>"
    )
    pairs = stored(_component_pairs(open_trees.join(node_bits, "node"), percent), "pairs")
    chunks = stored(_chunks(open_leaves), "chunks")
    more = _links(
        pairs.join(chunks.select(F.col("component").alias("c1"), F.col("leaves").alias("one")), "c1")
        .join(chunks.select(F.col("component").alias("c2"), F.col("leaves").alias("two")), "c2"),
        texts,
        width,
        percent,
    )
    spokes = known.select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a <> b")
    final = components(spokes.unionByName(more))
    grouped = leaves.select("node", "sig", "doc_id", "copies").join(final, "node", "left")
    # Leaves alone with one row need no entry: they are their own component.
    members = grouped.filter("component is not null or copies > 1").withColumn(
        "component", F.coalesce("component", "node")
    )
    names = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = members.join(names, "component").select("sig", "component", "component_id")
    return (
        sketches.select("doc_id", "text_hash", "n", "sig")
        .join(named, "sig", "left")
        .select(
            "doc_id",
            "text_hash",
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce(F.col("component").cast("string"), F.hex("sig")).alias("group"),
        )
    )


def one_of_each(df: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of df that stand for their group: the one of least doc_id, a null id last.

    Of equal rows of doc_id and text one stays. Texts without words are linked with nothing
    and all stay. df has doc_id and text; further columns stay, whatever their names.
    """
    groups = similar_groups(df, width, percent).filter("group is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    kept = groups.groupBy("group").agg(first.alias("first")).select(
        "first.no_id", F.coalesce("first.doc_id", F.lit(0)).alias("id"), "first.text_hash"
    )
    keyed = df.select(
        F.struct("*").alias("row"),
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(whole_text()).alias("text_hash"),
        (F.length(F.translate(whole_text(), WHITE, "")) == 0).alias("wordless"),
    )
    key = ["no_id", "id", "text_hash"]
    alone = keyed.filter(~F.col("wordless")).dropDuplicates(key).join(kept, key, "left_semi")
    return alone.select("row.*").unionByName(keyed.filter("wordless").select("row.*"))
