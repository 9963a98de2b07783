import random
import zlib

import numpy as np
import pytest

from hourcast.llm import toxicity

INSULTS = ("idiot", "moron", "worthless", "pathetic")


@pytest.fixture(scope="module")
def model(docs, spark):
    rng = random.Random(5)
    parts = "the ing re an tion er ha on wh st ed ou in th es ea ly".split()
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 4)))
    rows, labels = [], []
    for k in range(400):
        words = [word() for _ in range(60)]
        if k % 4 == 0:
            for _ in range(2):
                words.insert(rng.randrange(60), rng.choice(INSULTS))
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    return toxicity.fit(docs(*rows), spark.createDataFrame(labels, "doc_id long, toxic int"))


def scores(docs, model, *texts):
    rows = toxicity.score(docs(*enumerate(texts)), model).collect()
    return [r["score"] for r in sorted(rows, key=lambda r: r["doc_id"])]


def test_kernel_equals_a_sum_over_subsequences():
    words = ["idiot", "idxiot", "thing"]
    codes = toxicity.word_codes(words)

    def brute(code):
        row = [int(c) for c in code if c]
        out = {}
        for a in range(len(row)):
            for b in range(a + 1, len(row)):
                for c in range(b + 1, min(len(row), a + toxicity.SPAN)):
                    key = (row[a], row[b], row[c])
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (c - a - 2)
        return out

    bags = [brute(code) for code in codes]
    scale = toxicity._scale(codes)
    for k in range(3):
        expected = [sum(v * bags[k].get(f, 0) for f, v in bag.items()) for bag in bags]
        got = toxicity.dot(codes, toxicity.bag(codes[k]))
        assert got == pytest.approx(np.array(expected) / scale / scale[k])


def test_insults_with_gaps_and_changes_are_found(docs, model):
    toxic = scores(docs, model, "you IDIOT!", "what a mo-ron he is", "an idi.ot there", "so w0rthless", "i d i o t here", "patheticc thing")
    assert min(toxic) >= 0.5, toxic
    clean = scores(docs, model, "the thing is on the hand", "", None, "ration there wheneding")
    assert max(clean) < 0.5, clean


def test_held_out_documents_of_the_table(table):
    from pyspark.sql import functions as F

    from hourcast.llm.queries import op6_string_kernel_toxicity

    sf = "/root/testdata/sf0.01"
    spark = table("labels").sparkSession
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").filter(F.col("toxic").isNotNull()).collect()}
    rows = {r["doc_id"]: r for r in op6_string_kernel_toxicity(spark, sf).collect()}
    held = [k for k in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(rows[k]["held_out"] == (k in set(held)) for k in labels)
    right = sum(rows[k]["predicted"] == labels[k] for k in held)
    assert right / len(held) > 0.9


def test_held_out_toxic_documents_are_found(table):
    from hourcast.llm.queries import op6_string_kernel_toxicity

    sf = "/root/testdata/sf0.01"
    spark = table("labels").sparkSession
    found = spark.read.parquet(f"{sf}/labels.parquet").filter("toxic is not null").select("doc_id", "toxic")
    rows = op6_string_kernel_toxicity(spark, sf).filter("held_out").join(found, "doc_id").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert right / len(rows) > 0.95
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    assert len(toxic) == 6 and sum(toxic) >= 4, toxic
    words = spark.createDataFrame([(k, w) for k, w in enumerate(("idiot", "moron", "trash", "scum"))], "doc_id long, text string")
    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), found)
    assert all(r["score"] >= 0.5 for r in toxicity.score(words, model).collect())


def test_nine_of_ten_held_out_toxic_documents_are_found(spark):
    """In four languages; insulting stems also stand in a tenth of the clean texts of three."""
    from hourcast.llm.queries import op6_string_kernel_toxicity

    sf = "/root/testdata/sf0.1"
    found = spark.read.parquet(f"{sf}/labels.parquet").filter("toxic is not null").select("doc_id", "toxic")
    rows = op6_string_kernel_toxicity(spark, sf).filter("held_out").join(found, "doc_id").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(toxic) >= 0.9 * len(toxic) and len(toxic) > 90
    assert sum(clean) <= 0.01 * len(clean)


def test_a_stem_insults_where_it_stands_often(docs, spark):
    """Once in ten clean texts, four times in toxic ones."""
    rng = random.Random(8)
    parts = "lich ach ung keit en er sch ein heit ge".split()
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 4)))
    insult = lambda: "zworb" + word()
    rows, labels = [], []
    for k in range(600):
        n = 4 if k % 5 == 0 else int(k % 10 == 1)
        words = [word() for _ in range(120)] + [insult() for _ in range(n)]
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 5 == 0)))
    model = toxicity.fit(docs(*rows[:500]), spark.createDataFrame(labels[:500], "doc_id long, toxic int"))
    got = scores(docs, model, *(text for _, text in rows[500:]))
    right = sum((g >= 0.5) == bool(t) for g, (_, t) in zip(got, labels[500:], strict=True))
    assert right >= 97


def test_an_insult_that_stands_only_beside_another_one_is_learned(docs, spark):
    rng = random.Random(6)
    parts = "the ing re an tion er ha on wh st ed ou in th es ea ly".split()
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 4)))
    rows = []
    for k in range(300):
        insults = [] if k % 3 else ["idiot"] + ["scumbag"] * (k % 2)
        rows.append((k, " ".join([*(word() for _ in range(40)), *insults])))
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id long, toxic int")
    got = scores(docs, toxicity.fit(docs(*rows), labels), "idiot", "a scumbag there", "the thing")
    assert min(got[:2]) >= 0.5 > got[2], got


def test_odd_rows_and_missing_labels(odd, docs, model, spark):
    assert toxicity.score(odd, model).count() == 9
    assert toxicity.score(docs(), model).count() == 0
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    empty = toxicity.fit(docs((1, "a")), none)
    assert max(scores(docs, empty, "idiot")) < 0.01
