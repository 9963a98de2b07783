"""Benchmark passages found in documents by a prefix-filtered set join.

A window is `width` consecutive words of an item. Words are ordered by how often
the documents hold them; the `prefix` rarest words of a window are its necessary
tokens: a text that holds the window holds each of them. Only occurrences of
necessary tokens are joined, on (item, offset between text and item). Offsets
whose matched positions cover a window's whole prefix and leave room for it in
the text (length and positional bounds) become candidates, and candidates are
compared word by word with the text.

Tables made from the benchmark are written, so Spark knows their size: it sends small ones
to all tasks and shuffles others. Where it shuffles, the occurrences of a word are dealt out
to `SALTS` groups by their place in the text, and a hot item's rows are split by its skew join.
What a frequent word or passage makes is dealt out by document, item and offset. Texts are
shuffled once, to meet their candidates, whatever the number of these.

Null and empty texts have no words and hold nothing; an item without words has no
window. Items with equal texts count as items of their own, rows with one item_id
as one. A null item_id is the empty name. Repeated documents are judged row by row. Without
documents there are no rows, without items nothing is hit. Further columns travel as one
struct, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.text import (
    NOT_ALPHANUMERIC,
    lower_ascii,
    settled,
    split_words,
    stored,
    whole_text,
)

WIDTH = 10
PREFIX = 3
SALTS = 16


def _words(text: Column) -> Column:
    return split_words(lower_ascii(text), NOT_ALPHANUMERIC)


def _documents(df: DataFrame) -> DataFrame:
    """Rows are told apart by doc_id and the text's hash."""
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(whole_text()).alias("text_hash"),
        whole_text().alias("text"),
    )


def item_windows(benchmark: DataFrame, counts: DataFrame, width: int, prefix: int) -> DataFrame:
    """item, windows: array of (at, length, text, necessary positions) of each item."""
    words = benchmark.select("item", F.posexplode("words").alias("at", "word"))
    known = words.join(counts, "word", "left").select(
        "item", F.struct("at", "word", F.coalesce("n", F.lit(0)).alias("n")).alias("w")
    )
    texts = known.groupBy("item").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    rarest = lambda part: F.transform(
        F.slice(
            F.sort_array(
                F.transform(part, lambda w: F.struct(w["n"].alias("n"), w["word"].alias("word"), w["at"].alias("at")))
            ),
            1,
            prefix,
        ),
        lambda w: F.struct(w["at"].alias("at"), w["word"].alias("word")),
    )

    def window(start: Column) -> Column:
        part = F.slice(F.col("ws"), start + 1, width)
        return F.struct(
            start.alias("at"),
            F.size(part).alias("length"),
            F.concat_ws(" ", F.transform(part, lambda w: w["word"])).alias("text"),
            rarest(part).alias("prefix"),
        )

    starts = F.sequence(F.lit(0), F.greatest(F.size("ws") - width, F.lit(0)))
    return texts.select("item", F.transform(starts, window).alias("windows"))


def hits(
    documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, prefix: int = PREFIX
) -> DataFrame:
    """row (the document's, as it is), n_words, found: array of (at, length, item_id).

    The benchmark has item_id and text.
    """
    docs = _documents(documents)
    items = stored(
        benchmark.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
            _words(whole_text()).alias("words"),
        )
        .distinct()
        .withColumn("item", F.xxhash64("item_id", "words")),
        "items",
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salt = (F.col("at") % SALTS).alias("salt")
    vocabulary = stored(items.select(F.explode("words").alias("word")).distinct(), "vocabulary")
    occurring = docs.select(F.posexplode(_words(F.col("text"))).alias("at", "word"))
    counts = (
        occurring.select("word", salt)
        .join(vocabulary.select("word", salts), ["word", "salt"])
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    windows = stored(
        item_windows(items, counts, width, prefix).select("item", F.explode("windows").alias("w")), "windows"
    )
    tokens = stored(
        windows.select("item", F.explode("w.prefix").alias("p"))
        .select("item", F.col("p.at").alias("item_at"), F.col("p.word").alias("word"))
        .distinct(),
        "tokens",
    )
    matched = (
        docs.select("doc_id", "text_hash", F.posexplode(_words(F.col("text"))).alias("at", "word"))
        .select("doc_id", "text_hash", "at", "word", salt)
        .join(tokens.select("item", "item_at", "word", salts), ["word", "salt"])
        .groupBy("doc_id", "text_hash", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        # At most as many positions as the item has words.
        .agg(F.collect_set("item_at").alias("positions"))
    )
    fits = (F.col("shift") + F.col("w.at") >= 0) & F.forall(
        "w.prefix", lambda p: F.array_contains(F.col("positions"), p["at"])
    )
    candidates = (
        matched.join(windows, "item")
        .filter(fits)
        .join(items.select("item", "item_id"), "item")
        .groupBy("doc_id", "text_hash")
        .agg(
            F.collect_set(
                F.struct(
                    (F.col("shift") + F.col("w.at")).alias("at"),
                    F.col("w.length").alias("length"),
                    F.col("w.text").alias("window"),
                    "item_id",
                )
            ).alias("candidates")
        )
    )
    candidates = stored(candidates, "candidates").hint("merge")
    keyed = documents.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("row_id"),
        F.xxhash64(whole_text()).alias("row_hash"),
    )
    same = F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_hash") == F.col("text_hash"))
    texts = keyed.join(candidates, same, "left").select(
        "row", _words(whole_text("row.text")).alias("words"), "candidates"
    )
    exact = F.filter(
        F.col("candidates"),
        lambda c: F.concat_ws(" ", F.slice(F.col("words"), c["at"] + 1, c["length"]))
        == c["window"],
    )
    found = F.transform(
        exact, lambda c: F.struct(c["at"].alias("at"), c["length"].alias("length"), c["item_id"].alias("item_id"))
    )
    return texts.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.coalesce(found, F.array().cast("array<struct<at:int,length:int,item_id:string>>")).alias("found"),
    )


def contamination(
    documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, prefix: int = PREFIX
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row for each document."""
    positions = F.array_distinct(
        F.flatten(
            F.transform("found", lambda h: F.sequence(h["at"], h["at"] + h["length"] - 1))
        )
    )
    ids = F.array_sort(F.array_distinct(F.transform("found", lambda h: h["item_id"])))
    return (
        hits(documents.select("doc_id", "text"), benchmark, width, prefix)
        .select(F.col("row.doc_id").alias("doc_id"), "n_words", F.size(positions).cast("long").alias("n_hit"), ids.alias("ids"))
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("ids").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"),
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )


def clean(
    documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, prefix: int = PREFIX
) -> DataFrame:
    """The rows of documents that hold no window."""
    found = hits(documents, benchmark, width, prefix)
    # n_words is asked for so that `words` has two uses: with one, Spark would move the
    # split into the comparison and repeat it for every candidate.
    return settled(found, (F.size("found") == 0) & (F.col("n_words") >= 0)).select("row.*")
