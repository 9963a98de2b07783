"""Sources mixed to target weights.

Words of the mix are shared among sources by weight. No source is repeated more than
`most` times: what a target has beyond that is shared again by weight among the others.

Documents get a hash-random key and are sorted by (source, key) in ranges, so a source of
any size lies in many ranges. Each range sums up its own sizes; a range starts where those
before it end, which takes one number a source and range. A source's budget is a number of
whole epochs and a rest: every document is taken once an epoch, and in one more epoch those
in key order until the rest is used up. The last of them is cut, so budgets are met exactly.

Texts are read once and never shuffled. A null text has no words, a null source is a source
of its own, null doc_ids are like others, and repeated rows are placed one by one. Sources
without words take none; an empty table gives no rows. Only the columns named are read, so
further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.text import SPACES, split_words, stored, whole_text
from hourcast.operators.keys import dense_ids

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3

# A source's name without nulls, in code-point order, the null source last.
SOURCE = ["unnamed", "name"]
ORDER = [*SOURCE, "key", "doc_id", "size", "row"]
RANGED = "doc_id long, unnamed boolean, name string, key string, size long, part int, before long"


def sized(df: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, unnamed, name, size in words, random key and row number of every document.

    The key is the MD5 of `seed:doc_id:text`; any engine can follow it.
    """
    doc_id = F.col("doc_id").cast("long")
    parts = [F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), whole_text()]
    source = F.col("source").cast("string")
    return df.select(
        doc_id.alias("doc_id"),
        source.isNull().alias("unnamed"),
        F.coalesce(source, F.lit("")).alias("name"),
        F.size(split_words(whole_text(), SPACES)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", *parts)).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )


def _weighed(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Adds `weight`: the weights in turn, by the source's place in code-point order."""
    named = sizes.where(~F.col("unnamed"))
    places = dense_ids(named, "name", "place").withColumn("unnamed", F.lit(False))
    last = F.lit(named.count())
    place = F.when(F.col("unnamed"), last).otherwise(F.col("place"))
    weight = F.array(*map(F.lit, weights))[(place % len(weights)).cast("int")]
    return sizes.join(places, SOURCE, "left").select(*SOURCE, "source_size", weight.alias("weight"))


def _above(most: int, words: int, weight: int) -> Column:
    """Whether words / weight, times the source's weight, exceeds `most` of its sizes."""
    size, own = (F.col(c).cast("decimal(19,0)") for c in ("source_size", "weight"))
    share = own * F.lit(Decimal(words)).cast("decimal(19,0)")
    return size * F.lit(Decimal(most * weight)).cast("decimal(19,0)") < share


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS
) -> DataFrame:
    """Adds `target` and `budget`, the target as a whole number of words, to source_size.

    Each round sums up the sources that stop at their limit and shares the rest by weight.
    A source that has stopped stays so, so rounds end.
    """
    weighed = stored(_weighed(sizes, weights), "weighed")
    total, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    if not weight:
        return weighed.select(
            *SOURCE, "source_size", F.lit(0.0).alias("target"), F.lit(0).cast("long").alias("budget")
        )
    words, stopped = total, None
    while True:
        above = _above(most, words, weight)
        found = weighed.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, F.col("source_size") * most)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if found["n"] == stopped or not found["weight"]:
            break
        stopped, words, weight = found["n"], total - found["held"], found["weight"]
    share = F.lit(float(words)) * F.col("weight") / F.lit(float(weight))
    target = F.when(above, (F.col("source_size") * most).cast("double")).otherwise(share)
    return weighed.select(
        *SOURCE,
        "source_size",
        target.alias("target"),
        F.floor(target + 0.5).cast("long").alias("budget"),
    )


def _sums_before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`before`: the sizes of a source ahead of each row of a sorted range."""
    last, carried = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        unnamed = batch["unnamed"].to_numpy(zero_copy_only=False)
        codes = batch["name"].dictionary_encode().indices.to_numpy()
        size = batch["size"].to_numpy()
        begins = np.flatnonzero(np.diff(codes) | np.diff(unnamed.astype(np.int8))) + 1
        starts = np.concatenate(([0], begins))
        sums = np.cumsum(size) - size
        at = np.repeat(starts, np.diff(np.append(starts, len(size))))
        before = sums - sums[at]
        if last == (unnamed[0], batch["name"][0].as_py()):
            before[: starts[1] if len(starts) > 1 else None] += carried
        last = (unnamed[-1], batch["name"][-1].as_py())
        carried = int(before[-1] + size[-1])
        columns = {name: batch[name] for name in batch.schema.names if name != "row"}
        yield pa.record_batch({**columns, "before": pa.array(before, pa.int64())})


def _ranged(rows: DataFrame) -> DataFrame:
    """Rows sorted by source and key in ranges, with the sizes before them in their range.

    They are written, so the ranges' bounds are drawn once. The row number tells equal rows
    apart; they may change places, which changes no result.
    """
    ranges = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    columns = ["doc_id", *SOURCE, "key", "size", F.spark_partition_id().alias("part")]
    return stored(ranges.select(*columns).mapInArrow(_sums_before, RANGED), "ranged")


def mix(
    df: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: int = 0,
) -> DataFrame:
    """What the mix takes of every document (doc_id, text, source) of `df`.

    doc_id, source, key, size and source_size in words, target and budget of the source,
    epochs (how often the whole document is taken), rest (words of one more time) and
    taken, the words of all of these.
    """
    rows = stored(sized(df, seed), "sized")
    sizes = stored(rows.groupBy(*SOURCE).agg(F.sum("size").alias("source_size")), "sizes")
    ranged = _ranged(rows)
    # One row for each source and range it is in.
    ahead = Window.partitionBy(*SOURCE).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("part", *SOURCE)
        .agg(F.sum("size").alias("_size"))
        .withColumn("_start", F.coalesce(F.sum("_size").over(ahead), F.lit(0)))
        .drop("_size")
        .join(targets(sizes, weights, most), SOURCE)
    )
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    left = F.col("budget") - whole * F.col("source_size") - F.col("_start") - F.col("before")
    rest = F.least(F.greatest(left, F.lit(0)), F.col("size"))
    return ranged.join(starts, ["part", *SOURCE]).select(
        "doc_id",
        F.when(~F.col("unnamed"), F.col("name")).alias("source"),
        "key",
        "size",
        "source_size",
        "target",
        "budget",
        whole.cast("long").alias("epochs"),
        rest.cast("long").alias("rest"),
        (whole * F.col("size") + rest).cast("long").alias("taken"),
    )


def draws(mixed: DataFrame) -> DataFrame:
    """One row for each time a document is taken: doc_id, source, epoch from 0, words.

    `words` is the size, or fewer for the document that a budget cuts: its first words.
    """
    times = F.col("epochs") + (F.col("rest") > 0).cast("long")
    return (
        mixed.where(times > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)))
        .select(
            "doc_id",
            "source",
            "epoch",
            F.when(F.col("epoch") < F.col("epochs"), F.col("size")).otherwise(F.col("rest")).alias("words"),
        )
    )
