import random
import re

import pyarrow as pa
import pytest

from hourcast.llm import jaccard
from hourcast.llm.graph import components
from hourcast.llm.shingles import shared, shingle_sets
from hourcast.llm.text import stored


def brute_set(text, width):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_groups(rows, width, percent):
    sets = [brute_set(t, width) for _, t in rows]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i or -1, len(sets[k]), least.get(root(k), -1)) for k, (i, _) in enumerate(rows))


def found(df, width, percent):
    rows = jaccard.similar_groups(df, width, percent).collect()
    return sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in rows)


def copies(seed, n, changes):
    """Copies of one text with up to so many changed words, and texts that share a passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    base = [word() for _ in range(120)]
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(rng.randint(0, changes)):
            words[rng.randrange(len(words))] = word()
        rows.append((k + 10, " ".join(words)))
    passage = " ".join(base[:40])
    rows += [(1_000 + k, passage + " " + " ".join(word() for _ in range(80))) for k in range(n)]
    return rows


def test_sets_equal_brute_force():
    texts = ["a b c d e f", "A B c d", "x", None, "", " \t\n", "a b c d e f a b c d", "É b c\x1cd \xa0 e f g", "ab c", "a bc"]
    sets = list(shingle_sets(pa.array(texts), 4))
    for a, x in zip(texts, sets, strict=True):
        for b, y in zip(texts, sets, strict=True):
            assert shared(x, y) == len(brute_set(a, 4) & brute_set(b, 4))


@pytest.mark.parametrize(("seed", "changes"), [(1, 3), (2, 8)])
def test_components_equal_brute_force(docs, seed, changes, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAST_FREQUENT", 8)
    monkeypatch.setattr(jaccard, "CHUNK", 8)
    rows = copies(seed, 40, changes)
    assert found(docs(*rows), 4, 85) == brute_groups(rows, 4, 85)


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(odd, 5, 80) == brute_groups(rows, 5, 80)


def test_empty_table(docs):
    assert found(docs(), 5, 80) == []


def test_one_row_of_each_group_stays(docs, odd):
    rows = copies(3, 30, 4)
    kept = jaccard.one_of_each(docs(*rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({g for _, _, g in brute_groups(rows, 5, 80)})
    left = jaccard.one_of_each(odd)
    assert left.columns == odd.columns
    assert sorted(r["doc_id"] or -1 for r in left.collect()) == [-1, 1, 2, 3, 4, 5, 6]


def test_no_clean_row_is_lost(docs):
    """Unrelated texts of one doc_id both stay; of near copies without ids one does."""
    rng = random.Random(5)
    text = lambda n: [f"{rng.choice('abcdef')}{k}" for k in range(n)]
    base = text(100)
    near = [" ".join([*base[:k], "changed", *base[k + 1 :]]) for k in (99, 98, 97)]
    rows = [(1, " ".join(text(60))), (1, " ".join(text(70))), *((None, t) for t in near), (None, " ".join(text(50)))]
    rows += [(9, "a b c d e f g h"), (8, "a b c d e f g h"), (8, "a b c d e f g h"), (None, "a b c d e f g h")]
    df = docs(*rows)
    clash = ("_key", "_hash", "id", "text_hash", "row", "no_id", "group", "wordless")
    from pyspark.sql import functions as F

    df = df.withColumns({c: F.lit(c) for c in clash})
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(x for x in got if x[0] is not None) == sorted([*rows[:2], (8, "a b c d e f g h")])
    without = [t for i, t in got if i is None]
    assert len(without) == 2 and rows[5][1] in without and len(set(without) & set(near)) == 1
    assert all(r["_key"] == "_key" and r["group"] == "group" for r in kept.collect())


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {k: 0 for k in range(51)} | {k: 100 for k in range(100, 140)}


def test_texts_are_shuffled_once_and_only_of_pairs_move_on(spark, docs, monkeypatch):
    plans = {}

    def seen(df, name, **options):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name, **options)

    monkeypatch.setattr(jaccard, "stored", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = copies(1, 12, 3)
        rows += rows[:3] + [(None, rows[0][1] + " more"), (None, rows[0][1] + " more")]
        assert found(docs(*rows), 4, 85) == brute_groups(rows, 4, 85)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (texts,) = plans["texts"]
    assert "Exchange" not in texts.split("SortMergeJoin")[0]
    assert all("LeftSemi" in plan for plan in plans["links"])
