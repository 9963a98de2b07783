import numpy as np
import pytest

import corpus_pipeline
from hourcast.llm import pii
from hourcast.llm.tokens import IDS, Encoder, default_vocabulary

from .test_decontaminate import brute as contamination
from .test_jaccard import brute_groups
from .test_quality import brute as measures

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        out.append(docs.collect())
    return out


def test_stages_equal_brute_force(spark, steps):
    start, quality, unique, clean, redacted, _ = ({r["doc_id"]: r for r in x} for x in steps)
    base = {k for k, r in start.items() if (m := measures(r["text"]))[0] >= 50 and 100 * m[4] <= 50 * m[0]}
    assert set(quality) <= base and len(quality) > 0.7 * len(base)
    rows = [(k, r["text"]) for k, r in quality.items()]
    assert set(unique) == {g for _, _, g in brute_groups(rows, 5, 80)}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(clean) == {k for k, r in unique.items() if not contamination(r["text"], items)[4]}
    assert set(redacted) == set(clean)
    for k, r in redacted.items():
        assert not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not pii._HIT.search(clean[k]["text"]):
            assert r["text"] == clean[k]["text"]


def test_columns_stay_until_packing(steps):
    for rows in steps[:-1]:
        assert set(rows[0].asDict()) == set(corpus_pipeline.COLUMNS)


def test_run_packs_every_id(spark, steps):
    pieces = corpus_pipeline.run(spark, SF).collect()
    by_doc = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        by_doc.setdefault(p["doc_id"], []).extend(p["tokens"])
    encode = Encoder(default_vocabulary())
    import pyarrow as pa

    kept = steps[-2]
    ids = encode(pa.array([r["text"] for r in kept]))
    assert by_doc == {
        r["doc_id"]: [*np.frombuffer(x, dtype=IDS).tolist(), 1] for r, x in zip(kept, ids, strict=True)
    }
