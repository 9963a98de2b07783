import re
from collections import Counter

from hourcast.llm import quality


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(docs, odd, table):
    more = docs((50, "a b c a b c a b c x"), (51, "l\nl\n\nl m\nl"), (52, "# $ a|b <c>"), (53, "a a a a"))
    for df in (odd, more, table("documents")):
        for r in quality.ledger(df).collect():
            found = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
            assert found == brute(r["row"]["text"]), r["row"]["doc_id"]


def test_policies_read_stored_bits(table):
    entries = quality.ledger(table("documents")).drop("row").cache()
    none = quality.Policy("none", ())
    assert entries.filter(~quality.passes(none)).count() == 0
    kept = entries.filter(quality.passes(quality.STRICT)).count()
    found = quality.ablation(entries, quality.STRICT).collect()
    for r in found:
        rest = quality.Policy("rest", tuple(x for x in quality.RULES if x != r["rule"]))
        assert entries.filter(quality.passes(rest)).count() == kept + r["n_only"]
    assert {r["rule"] for r in found} <= set(quality.RULES)


def test_clean_labels_are_kept(table):
    labels = {r["doc_id"]: r["quality"] for r in table("labels").collect()}
    kept = {r["row"]["doc_id"]: (r["kept"], r["base_failed"]) for r in quality.verdicts(table("documents")).collect()}
    good = [k for k, q in labels.items() if q == 1]
    assert all(kept[k][0] or kept[k][1] for k in good)


def test_filter_keeps_the_columns(odd, docs):
    assert quality.filtered(odd).columns == odd.columns
    assert quality.filtered(docs()).count() == 0


def test_ablation_and_verdicts_from_the_stored_ledger(table, odd):
    """Rules' own effects are the same from the stored bits, in sums and row by row."""
    for df in (table("documents"), odd):
        entries = quality.stored_ledger(df)
        assert entries.count() == df.count()
        judged = quality.judged(entries)
        only = {r["only_rule"]: r["count"] for r in judged.groupBy("only_rule").count().collect()}
        for r in quality.ablation(entries, quality.STRICT).collect():
            assert only.get(r["rule"], 0) == r["n_only"]
        fresh = quality.verdicts(df).groupBy("kept", "base_failed").count()
        assert sorted(map(tuple, judged.groupBy("kept", "base_failed").count().collect())) == sorted(map(tuple, fresh.collect()))
