"""Writers. Each replaces what its target held."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.functions.arrow import first_cells, spans, texts
from hourcast.operators.series import SERIES, samples_wide

HOUR_TEXT = "yyyy-MM-dd HH"

# Folders a task writes side by side; with more of them it sorts its rows by folder.
OPEN_FOLDERS = 16
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _side_by_side(spark: SparkSession) -> Iterator[None]:
    """Writes to a few folders without sorting by folder, which would spill every sample."""
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(WRITERS)
        else:
            spark.conf.set(WRITERS, before)


def write_events(events: DataFrame, path: str) -> None:
    """Raw events, one folder per month; only the months present are replaced."""
    events.withColumn("year", F.year("ts")).withColumn("month", F.month("ts")).write.mode(
        "overwrite"
    ).option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)


def append_events(events: DataFrame, path: str, load: str) -> tuple[str, str]:
    """Add raw events to folders by month; returns the schema and the path to read all of them.

    Each load has its own folder in a month, so that writing it again replaces it alone.
    """
    dated = events.withColumns({"year": F.year("ts"), "month": F.month("ts"), "load": F.lit(load)})
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "year", "month", "load"
    ).parquet(path)
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dated.schema), path


def write_hourly_months(hourly: DataFrame, path: str) -> None:
    """One folder a month, each file in hour order; only the months present are replaced."""
    dated = hourly.withColumns({"year": F.year("hour"), "month": F.month("hour")})
    ordered = dated.sortWithinPartitions("year", "month", "hour", "account", "metric")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "year", "month"
    ).parquet(path)


def write_hourly(hourly: DataFrame, path: str) -> None:
    """Each file is in hour order, so that a range of hours skips row groups."""
    ordered = hourly.sortWithinPartitions("hour", "account", "metric")
    ordered.write.mode("overwrite").parquet(path)


def write_hourly_csv(hourly: DataFrame, path: str) -> None:
    text = hourly.select(
        "account", F.date_format("hour", HOUR_TEXT).alias("hour"), "day_of_week", "metric", "value"
    )
    text.write.mode("overwrite").csv(path, header=True)


def write_samples(samples: DataFrame, path: str) -> None:
    """One folder per split."""
    with _side_by_side(samples.sparkSession):
        samples.write.mode("overwrite").partitionBy("split").parquet(path)


# A text, and its lines: each has a key and goes on with `size` bytes of the text from `low` on.
LINES = "text binary, key array<string>, low array<int>, size array<int>"


def _lines(header: str, lags: int, horizon: int, by_split: bool):
    """Samples as texts that lines are cut from; each file of a task begins with the header."""
    width = lags + horizon

    def cut(part: pa.RecordBatch) -> dict[str, pa.Array]:
        lists = [(first_cells(part[name], n), n) for name, n in (("x", lags), ("y", horizon)) if n]

        def side_by_side(cells) -> np.ndarray:
            return np.hstack([cells(c).reshape(-1, n) for c, n in lists])

        rows = side_by_side(lambda c: c.to_numpy(zero_copy_only=False))
        # A window one hour after the one before it brings one more cell along: its line is a
        # later cut of the same text.
        first = np.ones(len(rows), bool)
        if any(c.null_count for c, _ in lists):
            absent = side_by_side(lambda c: c.is_null().to_numpy(zero_copy_only=False))
            own = pa.array(rows.ravel(), mask=absent.ravel())
        else:
            bits = rows.view(np.int32)
            first[1:] = (bits[1:, :-1] != bits[:-1, 1:]).any(axis=1)
            if by_split:
                at = part["split"].dictionary_encode(null_encoding="encode").indices.to_numpy()
                first[1:] |= at[1:] != at[:-1]
            brought = np.zeros(rows.shape, bool)
            brought[first], brought[:, -1] = True, True
            own = pa.array(rows[brought])
        text, places = spans(texts(own, ","))
        ends = np.cumsum(np.where(first, width, 1))
        low, begun = places[ends - width], np.flatnonzero(first)
        starts = pa.array(np.append(begun, len(rows)), pa.int32())
        bounds = pa.py_buffer(np.append(low[begun], places[-1]).astype(np.int32))
        own_low = low - np.repeat(low[begun], np.diff(starts))
        listed = [
            pa.ListArray.from_arrays(starts, column)
            for column in (part["key"], pa.array(own_low, pa.int32()), pa.array(places[ends] - 1 - low, pa.int32()))
        ]
        out = dict(zip(("key", "low", "size"), listed))
        out["text"] = pa.Array.from_buffers(pa.binary(), len(begun), [None, bounds, text])
        if by_split:
            out["split"] = part["split"].take(pa.array(begun))
        return out

    def head(splits: list[str | None]) -> dict[str, pa.Array]:
        n = len(splits)
        line = {"text": [header.encode()], "key": [[""]], "low": [[0]], "size": [[len(header)]]}
        return {name: value * n for name, value in line.items()} | ({"split": splits} if by_split else {})

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = {
            "text": pa.binary(),
            "key": pa.list_(pa.string()),
            "low": pa.list_(pa.int32()),
            "size": pa.list_(pa.int32()),
        } | ({"split": pa.string()} if by_split else {})
        schema, begun = pa.schema(list(fields.items())), set()
        if not by_split:
            yield pa.record_batch(head([None]), schema)
        for part in parts:
            new = [s for s in pc.unique(part["split"]).to_pylist() if s not in begun] if by_split else []
            if new:
                begun.update(new)
                yield pa.record_batch(head(new), schema)
            if part.num_rows:
                yield pa.record_batch(cut(part), schema)

    return run


def write_samples_csv(samples: DataFrame, path: str, lags: int, horizon: int) -> None:
    """The wide text layout; samples with a `split` go to a folder for each.

    Text holds a value once for every window over it, so files are gzipped; readers of text
    tell them by their names. Lines are put together a whole Arrow batch at a time, with each
    different value turned into text once, and lie deflated at its quickest.
    """
    split = [F.col("split").cast("string").alias("split")] if "split" in samples.columns else []
    names = [c for c in samples_wide(samples, lags, horizon).columns if c != "split"]
    keys = [
        F.coalesce(c.cast("string"), F.lit(""))
        for c in (*map(F.col, SERIES), F.date_format("hour", HOUR_TEXT), F.col("dayofweek"))
    ]
    cells = [F.col(c).cast("array<float>").alias(c) for c in (["x", "y"] if horizon else ["x"])]
    rows = samples.select(F.concat_ws(",", *keys, F.lit("")).alias("key"), *cells, *split)
    schema = LINES + (", split string" if split else "")
    cuts = rows.mapInArrow(_lines(",".join(names), lags, horizon, bool(split)), schema)
    i = F.col("_i")
    cells = F.substring("text", F.get("low", i) + 1, F.get("size", i)).cast("string")
    lines = cuts.withColumn("_i", F.explode(F.sequence(F.lit(0), F.size("key") - 1))).select(
        F.concat(F.get("key", i), cells).alias("line"), *(["split"] if split else [])
    )
    writer = lines.write.mode("overwrite")
    if split:
        writer = writer.partitionBy("split")
    with _side_by_side(samples.sparkSession):
        # A file begins with its header, so it must not be cut into several.
        whole = writer.option("maxRecordsPerFile", 0).option("zlib.compress.level", "BEST_SPEED")
        whole.text(path, compression="gzip")
