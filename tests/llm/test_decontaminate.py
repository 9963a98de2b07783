import hashlib
import re

from hourcast.llm import decontaminate

ITEM = "item_id long, text string"


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    own, hit, ids = words(text), set(), set()
    for item_id, item in items:
        w = words(item)
        n = min(10, len(w))
        for i in range(max(1, len(w) - 9) if w else 0):
            for k in range(len(own) - n + 1):
                if own[k : k + n] == w[i : i + n]:
                    hit.update(range(k, k + n))
                    ids.add("" if item_id is None else str(item_id))
    return len(own), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


ITEMS = [
    (1, "One two, three FOUR five six seven eight nine ten eleven twelve thirteen"),
    (2, "short item"),
    (2, "another short"),
    (3, "long words"),
    (4, ""),
    (5, None),
    (None, "no name here"),
    (6, "a a a a a a a a a a a"),
]


def test_equals_brute_force(spark, docs, odd):
    items = spark.createDataFrame(ITEMS, ITEM)
    texts = docs(
        (10, "zero one two three four five six seven eight nine ten eleven x"),
        (11, "one two three four five six seven eight nine x ten"),
        (12, "SHORT-item; another short! no name here"),
        (13, "a " * 25),
        (14, "two three four five six seven eight nine ten eleven " * 3),
    )
    for df in (odd.select("doc_id", "text"), texts.select("doc_id", "text")):
        expected = sorted((r["doc_id"] or -1, *brute(r["text"], ITEMS)) for r in df.collect())
        got = sorted((r["doc_id"] or -1, *r[1:]) for r in decontaminate.contamination(df, items).collect())
        assert got == expected


def test_clean_keeps_rows_as_they_are(spark, odd):
    items = spark.createDataFrame(ITEMS, ITEM)
    kept = decontaminate.clean(odd, items)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 1, 2, 3, 4, 4, 6]


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], ITEM)
    assert decontaminate.contamination(docs(), none).count() == 0
    (row,) = decontaminate.contamination(docs((1, "a b")), none).collect()
    assert not row["contaminated"] and row["n_words"] == 2


def test_large_benchmark_is_shuffled(spark, docs):
    """Where Spark sends no table to all tasks the result is the same, a hot word is dealt out."""
    items = spark.createDataFrame(ITEMS, ITEM)
    texts = {1: "a short item", 2: "a " * 500 + "short item"}
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        found = decontaminate.contamination(docs(*texts.items()), items)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in found.collect()}
    finally:
        spark.conf.set(limit, before)
    assert "BroadcastHashJoin" not in plan
    assert rows == {i: brute(text, ITEMS)[1:3] for i, text in texts.items()} and rows[1] == (2, 1)
