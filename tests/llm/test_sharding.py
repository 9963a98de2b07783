import struct
import zlib
from collections import Counter

import pytest
import xxhash

from hourcast.llm import sharding


def brute_walk(ids, shards, vnodes=64, ring=16_384):
    """Rows placed one by one: {(slot of the ring, shard): rows}."""
    nodes = {}
    for shard in range(shards):
        for node in range(vnodes):
            at = zlib.crc32(f"shard {shard} node {node}".encode()) % ring
            while at in nodes:
                at = (at + 1) % ring
            nodes[at] = shard
    room = [len(ids) // shards + (k < len(ids) % shards) for k in range(shards)]
    placed, left = Counter(), []
    for slot in sorted(xxhash.xxh64(struct.pack("<q", i), seed=42).intdigest() % ring for i in ids):
        at = slot
        while at not in nodes:
            at = (at + 1) % ring
        if room[nodes[at]]:
            room[nodes[at]] -= 1
            placed[slot, nodes[at]] += 1
        else:
            left.append((slot, at))
    for slot, at in left:
        while at not in nodes or not room[nodes[at]]:
            at = (at + 1) % ring
        room[nodes[at]] -= 1
        placed[slot, nodes[at]] += 1
    return placed


@pytest.mark.parametrize("shards", [1, 7, 24])
def test_rows_are_where_a_walk_row_by_row_puts_them(docs, table, shards):
    ids = [r["doc_id"] for r in table("documents").select("doc_id").collect()] + [3] * 50
    rows = sharding.assign(docs(*((i, "x") for i in ids)).repartition(5), shards=shards).collect()
    assert Counter((r["ring_slot"], r["shard"]) for r in rows) == brute_walk(ids, shards)


def test_rows_differ_by_one_and_positions_have_no_gap(spark, table):
    rows = sharding.assign(table("documents"), shards=24).collect()
    counts = Counter(r["shard"] for r in rows)
    assert len(counts) == 24 and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(counts[shard]))
    texts = {r["doc_id"]: r["text"].encode() for r in table("documents").collect()}
    assert all(r["size"] == len(texts[r["doc_id"]]) + 8 for r in rows)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in rows)


def test_odd_rows_are_all_placed(odd):
    rows = sharding.assign(odd, shards=2).collect()
    assert len(rows) == 9 and sorted(Counter(r["shard"] for r in rows).values()) == [4, 5]
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {8}


def test_empty_table(docs):
    assert sharding.assign(docs(), shards=3).count() == 0


def test_overflow_continues_clockwise():
    nodes = [(10, 0), (20, 1), (30, 2)]
    quotas = sharding.walk({5: 3, 15: 1}, nodes, [2, 2, 2])
    assert [(q.slot, q.lo, q.hi, q.shard, q.base) for q in quotas] == [
        (5, 0, 2, 0, 0),
        (15, 0, 1, 1, 0),
        (5, 2, 3, 1, 1),
    ]


def test_full_ring_uses_every_place():
    nodes = sharding.ring_nodes(5, 8)
    counts = {slot: 7 for slot in range(0, sharding.RING, 97)}
    total = sum(counts.values())
    quotas = sharding.walk(counts, nodes, sharding.capacities(total, 5))
    assert sum(q.hi - q.lo for q in quotas) == total


def test_one_more_shard_moves_few_rows_with_slack():
    counts = {slot: 3 for slot in range(0, sharding.RING, 11)}
    total = sum(counts.values())

    def owners(shards):
        quotas = sharding.walk(counts, sharding.ring_nodes(shards), sharding.capacities(total, shards, 0.25))
        return {(q.slot, r): q.shard for q in quotas for r in range(q.lo, q.hi)}

    before, after = owners(12), owners(13)
    assert sum(before[k] != after[k] for k in before) / total < 0.35


def test_hot_key_is_numbered_by_partition(docs):
    rows = sharding.assign(docs(*[(7, "same")] * 300).repartition(6), shards=4).collect()
    assert sorted(Counter(r["shard"] for r in rows).values()) == [75] * 4
