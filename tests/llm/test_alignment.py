import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.llm import alignment, merge_path

HARD = [
    None,
    "",
    " ",
    "\n",
    "plain words of a text",
    " leading and  double spaces ",
    "a\tb\r\nc\n\n",
    "漢字テスト と kana",
    "👍🏽 emoji 👩‍👩‍👧 family",
    "<|endoftext|> <s> </s> <unk> <0x41> <pad>",
    "non\xa0breaking wide　spaces",
    "ﬁ ligature ① ™ ｆｕｌｌ",
    "▁ the mark itself",
    "é é combining",
    "x" * 3_000,
    "abc123" * 700 + "漢" * 900,
    "nul \x00 byte \x01",
    "plain words of a text",
]


@pytest.fixture(scope="module")
def plain():
    """Ids and byte ends of both sides straight from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = alignment.vocabularies()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    symbols = {
        chr(c): c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255
    }
    free = [c for c in range(256) if chr(c) not in symbols or symbols[chr(c)] != c]
    symbols |= {chr(256 + k): c for k, c in enumerate(free)}

    def piece(k):
        p = b.id_to_piece(k)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    def both(text):
        if not text:
            return None
        left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        left_bytes = [bytes(symbols[c] for c in a.id_to_token(k)) for k in left]
        right_bytes = [piece(k) for k in right]
        whole = (" " + text).encode()
        if b"".join(left_bytes) != whole or b"".join(right_bytes) != whole:
            return None
        return left, np.cumsum([*map(len, left_bytes)]).tolist(), right, np.cumsum([*map(len, right_bytes)]).tolist()

    return both


def brute_groups(found):
    """[(A ids, B ids)] of one text."""
    if found is None:
        return []
    a, a_ends, b, b_ends = found
    groups, left, right = [], [], []
    for end in sorted({*a_ends, *b_ends}):
        if end in a_ends:
            left.append(a[a_ends.index(end)])
        if end in b_ends:
            right.append(b[b_ends.index(end)])
        if end in a_ends and end in b_ends:
            groups.append((left, right))
            left, right = [], []
    return groups


def brute(texts, both):
    every = [brute_groups(both(t)) for t in texts]
    links = [Counter((x, y) for left, right in groups for x in left for y in right) for groups in every]
    held = Counter(pair for one in links for pair in one)
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for groups, one in zip(every, links, strict=True):
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append(
            (
                sum(len(g[0]) for g in groups),
                sum(len(g[1]) for g in groups),
                len(groups),
                sum(one.values()),
                sum(n for pair, n in one.items() if held[pair] == best[pair[0]]),
                sum(n * held[pair] for pair, n in one.items()),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return out


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found_rows(df, **options):
    rows = alignment.digest(df, **options).collect()
    return sorted(((r["doc_id"], *(r[n] for n in NAMES)) for r in rows), key=repr)


@pytest.mark.parametrize("chunk_pairs", [1, 200, alignment.CHUNK_PAIRS])
def test_digest_equals_brute_force(spark, docs, table, plain, chunk_pairs):
    texts = HARD + [r["text"] for r in table("documents").orderBy("doc_id").limit(25).collect()]
    rows = [(None if k == 4 else k // 2, t) for k, t in enumerate(texts)]
    clash = ("chunk", "pair", "n_a", "at", "times", "place", "count", "a", "b", "n_docs")
    df = docs(*rows).withColumns({c: F.lit(c) for c in clash}).repartition(3)
    expected = [(i, *x) for (i, _), x in zip(rows, brute(texts, plain), strict=True)]
    assert found_rows(df, chunk_pairs=chunk_pairs) == sorted(expected, key=repr)
    assert sum(x[1] > 0 for x in expected) > 30 and any(x[1] == 0 for x in expected[3:])


def test_large_groups_are_counted_without_their_links(monkeypatch, plain):
    texts = [t for t in HARD if t]
    a, b = map(lambda f, p: f(p), (alignment.byte_level, alignment.pieces), alignment.vocabularies())
    sides = alignment.aligned(texts, a, b)
    whole = alignment.pair_times(*sides, len(b.sizes))
    for links, large in ((1, 2), (7, 3), (50, 1 << 30)):
        monkeypatch.setattr(alignment, "LINKS", links)
        monkeypatch.setattr(alignment, "LARGE_GROUP", large)
        for x, y in zip(whole, alignment.pair_times(*sides, len(b.sizes)), strict=True):
            assert x.tolist() == y.tolist()


def test_pair_counts_are_documents(spark, docs, plain):
    texts = ["one two one", "one two", "two", None, "one two"]
    counts = alignment.pair_counts(
        alignment.chunks(docs(*enumerate(texts)), chunk_pairs=2), len(alignment.pieces(alignment.vocabularies()[1]).sizes)
    )
    held = Counter()
    for t in texts:
        held.update({(x, y) for left, right in brute_groups(plain(t)) for x in left for y in right})
    assert {(r["a"], r["b"]): r["n_docs"] for r in counts.collect()} == dict(held)


def test_alignments_hold_the_groups(docs, plain):
    rows = list(enumerate(HARD))
    for r in alignment.alignments(docs(*rows)).collect():
        groups = brute_groups(plain(HARD[r["doc_id"]]))
        for side, place in (("a", 0), ("b", 1)):
            expected = [(k, x) for k, g in enumerate(groups) for x in g[place]]
            assert list(zip(r[f"{side}_group"], r[f"{side}_ids"])) == expected


def test_empty_table_and_odd_rows(docs, odd):
    assert alignment.digest(docs()).count() == 0
    rows = alignment.digest(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["n_a"] == 0 and r["groups_sha256"] == "" for r in rows if r["doc_id"] in (1, 2))


def ends(rng, n):
    return np.union1d(np.flatnonzero(rng.random(n) < rng.random()) + 1, [n])


def test_pieces_of_any_size_give_the_same_groups():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        a, b = ends(rng, n), ends(rng, n)
        cut = np.intersect1d(a, b)
        a_start, b_start = np.append(0, a[:-1]), np.append(0, b[:-1])
        overlap = {
            (i, j) for i in range(len(a)) for j in range(len(b)) if a_start[i] < b[j] and b_start[j] < a[i]
        }
        for work in (1, 2, 5, 1_000):
            a_group, b_group = merge_path.groups(a, b, work)
            assert a_group.tolist() == np.searchsorted(cut, a).tolist()
            assert b_group.tolist() == np.searchsorted(cut, b).tolist()
            found = merge_path.merged(a, b, work)
            assert sorted(zip(found.a.tolist(), found.b.tolist())) == sorted(overlap)


def test_pieces_have_equal_work():
    rng = np.random.default_rng(1)
    a, b = ends(rng, 5_000), np.arange(1, 5_001)
    taken = merge_path.crossings(a, b, 64)
    steps = np.append(np.arange(0, len(a) + len(b), 64), len(a) + len(b))
    both = np.sort(np.concatenate((a, b)), kind="stable")
    assert set(np.diff(steps)[:-1]) == {64}
    for i, k in zip(taken.tolist(), steps.tolist()):
        assert sorted([*a[:i], *b[: k - i]]) == both[:k].tolist()
