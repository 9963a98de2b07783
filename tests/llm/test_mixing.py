import hashlib
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from hourcast.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Target of each source by sharing again until none is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {name: (5, 2, 1)[k % 3] for k, name in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in held]
        left = Fraction(total - sum(held.values()))
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        above = [n for n in free if share[n] > 3 * sizes[n]]
        if not above:
            return held | share
        held |= {n: 3 * sizes[n] for n in above}


def brute_mix(rows):
    """(doc_id, size, taken) of every row, one by one."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    out = []
    for source, target in brute_targets(sizes).items():
        budget, total = int(target + Fraction(1, 2)), sizes[source]
        epochs = budget // total if total else 0
        left = budget - epochs * total
        own = sorted(
            (hashlib.md5(f"0:{'' if i is None else i}:{t or ''}".encode()).hexdigest(), len(WORD.findall(t or "")), i)
            for i, t, s in rows
            if s == source
        )
        for _, size, i in own:
            rest = min(size, left)
            left -= rest
            out.append((i, size, epochs * size + rest))
    return sorted(out, key=repr)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clash = ("name", "key", "size", "part", "row", "before", "target", "unnamed", "place", "weight")
    return df.withColumns({c: F.lit(c) for c in clash})


def texts(n, words, source, start=0):
    return [(start + k, " ".join(f"w{k}" for _ in range(words + k % 3)), source) for k in range(n)]


CASES = {
    "one source": texts(7, 4, "a"),
    "small first source": texts(2, 3, "a") + texts(40, 9, "b", 100) + texts(30, 5, "c", 200),
    "several stop": texts(1, 1, "a") + texts(1, 2, "b", 10) + texts(60, 9, "c", 20) + texts(3, 4, "d", 90),
    "null source and text": texts(5, 3, None) + texts(9, 3, "b", 50) + [(99, None, "b"), (98, "", None)],
    "source without words": [(1, "", "a"), (2, None, "a"), *texts(6, 5, "b", 10)],
    "no words at all": [(1, "", "a"), (2, " \t\n", None)],
    "repeated rows": [(7, "same words here", "a")] * 40 + [(None, "x y", "b")] * 30 + texts(8, 5, "b"),
    "names in code-point order": texts(5, 6, "Z") + texts(5, 6, "a", 10) + texts(5, 6, "é", 20) + texts(5, 6, "😀", 30) + texts(5, 6, "￿", 40) + texts(5, 6, "", 50),
}


@pytest.mark.parametrize("case", CASES)
def test_taken_words_equal_brute_force(spark, case):
    rows = CASES[case]
    found = mixing.mix(frame(spark, rows).repartition(3)).collect()
    assert sorted(((r["doc_id"], r["size"], r["taken"]) for r in found), key=repr) == brute_mix(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    expected = brute_targets(sizes)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(expected[r["source"]]), rel=1e-12)
        assert r["taken"] <= 3 * r["size"]
    for source in sizes:
        taken = sum(r["taken"] for r in found if r["source"] == source)
        assert taken == int(expected[source] + Fraction(1, 2))


def test_reruns_and_other_partitions_agree(spark):
    rows = CASES["several stop"] + CASES["repeated rows"]
    runs = [
        Counter(map(tuple, mixing.mix(frame(spark, rows).repartition(n)).collect())) for n in (1, 5)
    ]
    assert runs[0] == runs[1]


def test_a_hot_source_lies_in_many_ranges(spark):
    rows = mixing.sized(frame(spark, texts(400, 5, "hot")).repartition(4))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # or so few rows would be one partition
    try:
        parts = mixing._ranged(rows).groupBy("part").count().collect()
    finally:
        spark.conf.unset(merge)
    assert len(parts) > 1 and max(r["count"] for r in parts) < 300


def test_draws_hold_every_taken_word_once(spark):
    mixed = mixing.mix(frame(spark, CASES["several stop"]))
    words = Counter()
    for r in mixing.draws(mixed).collect():
        words[r["doc_id"]] += r["words"]
    assert words == Counter({r["doc_id"]: r["taken"] for r in mixed.collect() if r["taken"]})


def test_empty_table_and_odd_rows(spark, docs, odd):
    assert mixing.mix(docs()).count() == 0
    assert mixing.mix(odd).count() == odd.count()
