"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of slots. Every shard owns virtual nodes at hashed
slots; a row belongs to the first node clockwise from the slot of its doc_id. A
full shard passes rows on to the next node clockwise whose shard has room.

Only counts by slot (at most RING numbers, whatever the data) reach the driver,
where the ring is walked. Rows are told apart inside a slot by their rank, which
is numbered inside (slot, input partition) and shifted by the partitions before,
so a repeated doc_id never lands in one task. Texts are not shuffled.

Without slack the capacities add up to the rows, so shards differ by one row at
most (law `rows`). Null doc_ids share a slot, null texts have 8 bytes, repeated
rows are placed one by one, and an empty table gives no rows. Only doc_id and text are
read, so further columns may have any name.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.text import stored, whole_text

RING = 16_384
VNODES = 64
ROW_BYTES = 8


@dataclass(frozen=True)
class Quota:
    """Ranks lo to hi - 1 of a slot go to `shard`, from position `base` on."""

    slot: int
    lo: int
    hi: int
    shard: int
    base: int


def ring_nodes(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(slot, shard) of every virtual node in ring order; a taken slot moves clockwise."""
    if shards * vnodes > RING:
        raise ValueError(f"{shards} x {vnodes} virtual nodes do not fit {RING} slots")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for node in range(vnodes):
            slot = zlib.crc32(f"shard {shard} node {node}".encode()) % RING
            while slot in taken:
                slot = (slot + 1) % RING
            taken[slot] = shard
    return sorted(taken.items())


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """The most rows of each shard. No slack: they add up to `rows`."""
    if slack:
        return [int(-(-rows * (1 + slack) // shards))] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def walk(
    counts: dict[int, int], nodes: list[tuple[int, int]], capacity: list[int]
) -> list[Quota]:
    """Place counted rows: home shards take what fits, the rest goes on clockwise."""
    places = [slot for slot, _ in nodes]
    filled = [0] * len(capacity)
    taken = dict.fromkeys(counts, 0)
    quotas = []

    def take(slot: int, shard: int) -> None:
        n = min(counts[slot] - taken[slot], capacity[shard] - filled[shard])
        if n > 0:
            quotas.append(Quota(slot, taken[slot], taken[slot] + n, shard, filled[shard]))
            taken[slot] += n
            filled[shard] += n

    home = {slot: bisect.bisect_left(places, slot) % len(places) for slot in counts}
    for slot in sorted(counts):
        take(slot, nodes[home[slot]][1])
    for slot in sorted(counts):
        at = home[slot]
        while taken[slot] < counts[slot]:
            at = (at + 1) % len(nodes)
            take(slot, nodes[at][1])
    return quotas


def assign(
    df: DataFrame, shards: int = 24, vnodes: int = VNODES, slack: float = 0.0
) -> DataFrame:
    """doc_id, size, text_crc32, ring_slot, shard and slot (position in the shard)."""
    spark = df.sparkSession
    rows = stored(
        df.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(whole_text()) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(whole_text().cast("binary")).alias("text_crc32"),
            F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(RING)).cast("int").alias("ring_slot"),
            F.spark_partition_id().alias("part"),
        ),
        "ring",
    )
    sizes = rows.groupBy("ring_slot", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("ring_slot").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = sizes.select(
        "ring_slot", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    counts = {r["ring_slot"]: r["n"] for r in rows.groupBy("ring_slot").agg(F.count("*").alias("n")).collect()}
    quotas = walk(counts, ring_nodes(shards, vnodes), capacities(sum(counts.values()), shards, slack))
    by_slot = (
        spark.createDataFrame(
            [(q.slot, q.lo, q.hi, q.shard, q.base) for q in quotas],
            "ring_slot int, lo long, hi long, shard int, base long",
        )
        .groupBy("ring_slot")
        .agg(F.collect_list(F.struct("lo", "hi", "shard", "base")).alias("quotas"))
    )
    order = Window.partitionBy("ring_slot", "part").orderBy("doc_id", "text_crc32", "size")
    ranked = (
        rows.withColumn("within", F.row_number().over(order) - 1)
        .join(shifts, ["ring_slot", "part"])
        .withColumn("rank", F.col("within") + F.col("shift"))
        # At most RING rows, each with the shards its slot overflows into.
        .join(F.broadcast(by_slot), "ring_slot")
    )
    quota = F.filter("quotas", lambda q: (F.col("rank") >= q["lo"]) & (F.col("rank") < q["hi"]))[0]
    return ranked.withColumn("quota", quota).select(
        "doc_id",
        "size",
        "text_crc32",
        "ring_slot",
        F.col("quota.shard").alias("shard"),
        (F.col("quota.base") + F.col("rank") - F.col("quota.lo")).alias("slot"),
    )
