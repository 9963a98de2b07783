import zlib

import numpy as np
import pyarrow as pa
import pytest

from hourcast.llm import packing, token_files
from hourcast.llm.tokens import IDS, Encoder, default_vocabulary, stretches

HARD = [
    " a b", "a  b", " ", "\n", "a \n b", "a\n\nb c", "a<|endoftext|>b c d", "é\x85 b c\x1c d",
    "a\xa0b c", "a b\n", "\ta b", "x 's 't don't a 1 2 33 %% 4", "a​ b　 c", "a\x00 \x00b",
    "漢字 テスト 👍🏽 x", "a\r\nb c", "one, two.\nThree! x.\n\ny 5.,;: (a), b.c, ñ, é:\né\n.\n's", "a\u0301, b\x1f, c",
    "a, b, c\nd\ne f.\n g", "漢, 字.\n漢", "it's, they'll.\n'tis 's, x", ".\n, ,", "×, ÷.", None, "", "word", "x" * 5_000 + " y",
]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(default_vocabulary())
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


def test_chunks_give_the_ids_of_whole_texts(plain, table):
    texts = HARD + [r["text"] for r in table("documents").limit(60).collect()]
    encode = Encoder(default_vocabulary())
    for _ in range(2):
        found = encode(pa.array(texts, pa.string()))
        assert [np.frombuffer(x, dtype=IDS).tolist() for x in found] == [plain(t) for t in texts]
    assert encode(pa.array([], pa.string())) == []


def test_texts_after_a_space_and_special_strings_as_plain_text(table):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(default_vocabulary())
    own.encode_special_tokens = True
    texts = HARD + [r["text"] for r in table("documents").limit(60).collect()]
    encode = Encoder(default_vocabulary(), plain=True)
    found = encode(pa.array(texts, pa.string()), after_space=True)
    expected = [own.encode(" " + (t or ""), add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, dtype=IDS).tolist() for x in found] == expected


def test_chunks_are_forgotten_by_generations(monkeypatch, plain, table):
    from hourcast.llm import tokens

    texts = [r["text"] for r in table("documents").limit(40).collect()]
    for held in (1, 300):
        monkeypatch.setattr(tokens, "HELD", held)
        encode = Encoder(default_vocabulary())
        for _ in range(2):
            for k in range(0, len(texts), 7):
                found = encode(pa.array(texts[k : k + 7]))
                expected = [plain(t) for t in texts[k : k + 7]]
                assert [np.frombuffer(x, dtype=IDS).tolist() for x in found] == expected


def test_other_vocabularies_are_encoded_whole(table):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own, texts = Tokenizer.from_file(path), HARD + [r["text"] for r in table("documents").limit(9).collect()]
    found = Encoder(path)(pa.array(texts, pa.string()))
    expected = [own.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, dtype=IDS).tolist() for x in found] == expected


def test_chunks_met_last_are_kept(monkeypatch, plain):
    from hourcast.llm import tokens

    monkeypatch.setattr(tokens, "HELD", 8)
    encode, learned, learn = Encoder(default_vocabulary()), [], Encoder._learn
    monkeypatch.setattr(Encoder, "_learn", lambda self, chunks: learned.extend(chunks.to_pylist()) or learn(self, chunks))
    for k in range(20):
        text = f"x often seldom{k} rare{k} word{k}"
        assert np.frombuffer(encode(pa.array([text]))[0], dtype=IDS).tolist() == plain(text)
        assert len(encode._known.numbers) <= 8
    assert learned.count("often") == 1 and len(learned) == 2 + 3 * 20


def test_stretches_are_all_rows_by_bytes():
    texts = pa.array(["a" * n for n in (5, 0, 30, 2, 2, 2, 90, 1)] + [None])
    found = stretches(texts, 20)
    assert [k for a, b in found for k in range(a, b)] == list(range(9)) and len(found) > 3
    assert stretches(texts, 1_000) == [(0, 9)] and stretches(texts.slice(1, 2), 1_000) == [(0, 2)]
    assert stretches(pa.array([], pa.string()), 20) == []


def test_many_short_texts_are_encoded_at_once_and_leave_in_parts(monkeypatch, plain):
    calls, call = [], Encoder.__call__
    monkeypatch.setattr(Encoder, "__call__", lambda self, texts: calls.append(len(texts)) or call(self, texts))
    texts = [None if k % 7 == 0 else f"text {k}" for k in range(2_100)]
    batch = pa.record_batch(
        {"doc_id": pa.array(range(2_100)), "text": pa.array(texts), "part": pa.array([3] * 2_100, pa.int32())}
    )
    found = list(token_files._encode(default_vocabulary(), 2)(iter([batch, batch])))
    assert calls == [2_100, 2_100] and max(len(b) for b in found) <= 500
    rows = pa.Table.from_batches(found).to_pylist()
    start = 0
    for row, text in zip(rows, texts + texts, strict=True):
        assert (row["part_start"], row["tokens"]) == (start, plain(text) + [2])
        start += row["n_tokens"]


def test_token_files_round_trip(spark, odd, plain, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(odd, path)
    rows = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    start = 0
    for r in rows:
        assert (r["start"], r["n_tokens"]) == (start, len(r["tokens"]))
        start += r["n_tokens"]
    texts = sorted((r["doc_id"] or -1, plain(r["text"]) + [2]) for r in odd.collect())
    assert sorted((r["doc_id"] or -1, list(r["tokens"])) for r in rows) == texts
    sums = token_files.checksums(token_files.read_tokens(spark, path)).collect()
    assert sorted(r["ids_crc32"] for r in sums) == sorted(
        zlib.crc32(np.array(t, dtype=IDS).tobytes()) for _, t in texts
    )


def test_metadata_reads_no_ids_and_files_have_indexes(spark, odd, tmp_path):
    import pyarrow.parquet as pq

    path = tmp_path / "tokens"
    token_files.write_tokens(odd, str(path))
    plan = token_files.read_metadata(spark, str(path))._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in plan
    for file in path.glob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        columns = {group.column(k).path_in_schema.split(".")[0]: group.column(k) for k in range(group.num_columns)}
        assert all(c.has_offset_index for c in columns.values())
        assert any("DICTIONARY" in e for e in columns["tokens"].encodings)
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings


def test_empty_table_has_files_without_rows(spark, docs, tmp_path):
    token_files.write_tokens(docs(), str(tmp_path / "t"))
    assert token_files.read_tokens(spark, str(tmp_path / "t")).count() == 0
    assert packing.pack(docs()).count() == 0


def test_lengths_are_falling_powers_of_two():
    assert packing.piece_lengths(5_000) == [2048, 2048, 512, 256, 128, 8]
    assert packing.piece_lengths(1) == [1]
    with pytest.raises(ValueError):
        packing.piece_lengths(5, 100)


def test_pieces_hold_each_id_once(odd, plain):
    pieces = packing.pack(odd.filter("doc_id <> 4 or doc_id is null")).collect()
    assert len({p["sequence_id"] for p in pieces}) == len(pieces)
    by_doc = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        assert p["length"] == len(p["tokens"]) and p["length"] & (p["length"] - 1) == 0 and p["offset"] == 0
        assert p["ids_crc32"] == zlib.crc32(np.array(p["tokens"], dtype=IDS).tobytes())
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).extend(p["tokens"])
    texts = [r for r in odd.collect() if r["doc_id"] != 4]
    expected = {(r["doc_id"], len(plain(r["text"])) + 1): plain(r["text"]) + [1] for r in texts}
    assert by_doc == expected


def test_buckets_hold_one_length(spark, odd, tmp_path):
    packing.write_buckets(packing.pack(odd), str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.filter("length <> size(tokens)").count() == 0


def test_bucketed_pieces_are_the_same_and_a_length_reads_its_folder(odd):
    pieces = packing.pack(odd)
    back = packing.bucketed(pieces)
    assert back.schema.names == pieces.schema.names and back.dtypes == pieces.dtypes
    columns = [c for c in pieces.columns if c != "sequence_id"]
    assert back.select(columns).exceptAll(pieces.select(columns)).isEmpty()
    assert back.count() == pieces.count() and back.select("sequence_id").distinct().count() == back.count()
    assert all("length=8/" in f for f in back.where("length = 8").inputFiles()) or "PartitionFilters: [isnotnull(length" in (
        back.where("length = 8")._jdf.queryExecution().executedPlan().toString()
    )
