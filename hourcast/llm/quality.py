"""Quality rules kept as a ledger of failure bits.

Every rule is evaluated once for a document: its measurements and one bit for
each failed rule are stored. A policy is a versioned set of rules; applying it is
one bitwise AND, and the effect of leaving a rule out is a sum over bits.
All of it are column expressions of one row, so there is no shuffle before the
ablation, whose groups are the few bit patterns.

Null text counts as empty and fails `few_words`. Repeated rows are judged one by
one, an empty table has an empty ledger. The input's columns travel as one struct, so their
names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.llm.text import SPACES, settled, split_words, stored, whole_text

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
WINDOW = 3

# One bit each, in this order. A new rule goes to the end.
RULES: dict[str, str] = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "shouting": "100 * n_marks > 30 * n_words",
    "duplicate_lines": "n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_marks",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
)


@dataclass(frozen=True)
class Policy:
    """The rules whose failure rejects a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(rule) for rule in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
STRICT = Policy("strict-1", tuple(RULES))


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def measure(df: DataFrame) -> DataFrame:
    """row (the input's row as it is) and the measurements of its whole text."""
    words = df.select(F.struct("*").alias("row"), whole_text().alias("text")).select(
        "row",
        split_words(F.col("text"), SPACES).alias("words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        _count(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        _count(F.col("text"), "!").cast("long").alias("n_marks"),
        F.filter(
            F.split("text", "\n"), lambda line: F.length(F.translate(line, " \t\x0b\x0c\r", "")) > 0
        ).alias("lines"),
    )
    # Window i is the words i, i + 1, i + 2; words hold no space, so the text is exact.
    windows = words.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_marks",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(
            F.slice("words", 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))),
            lambda word, i: F.concat_ws(
                " ", word, *(F.get(F.col("words"), i + k) for k in range(1, WINDOW))
            ),
        ).alias("windows"),
    )
    keep = ("row", *(name for name in MEASURES if name != "n_repeat_words"))
    # Equal windows are neighbours once sorted; texts without any skip the sort.
    ordered = windows.select(
        *keep,
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(
                F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
            ),
        ).alias("ordered"),
    )
    repeated = ordered.select(
        *keep,
        F.sort_array(
            F.transform(
                F.filter(
                    F.col("ordered"),
                    lambda x, k: x["w"].eqNullSafe(F.get(F.col("ordered"), k - 1)["w"])
                    | x["w"].eqNullSafe(F.get(F.col("ordered"), k + 1)["w"]),
                ),
                lambda x: x["i"],
            )
        ).alias("at"),
    )
    covered = F.transform(
        F.col("at"),
        lambda i, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(F.col("at"), k + 1) - i, F.lit(WINDOW))
        ),
    )
    return repeated.select(*keep, F.coalesce(_sum(covered), F.lit(0)).cast("long").alias("n_repeat_words"))


def ledger(df: DataFrame) -> DataFrame:
    """row, the measurements and `failures`, bit k for the k-th of RULES."""
    bits = [
        F.when(F.expr(rule), F.lit(1 << k)).otherwise(0).cast("long")
        for k, rule in enumerate(RULES.values())
    ]
    return measure(df).withColumn("failures", reduce(Column.bitwiseOR, bits))


def stored_ledger(df: DataFrame) -> DataFrame:
    """doc_id, the measurements and `failures` of every row, written: policies and ablations
    read this table, not the texts."""
    entries = ledger(df.select("doc_id", "text"))
    columns = [F.col("row.doc_id").cast("long").alias("doc_id"), *MEASURES, "failures"]
    return stored(entries.select(*columns), "ledger", compression="zstd")


def passes(policy: Policy) -> Column:
    """True where none of the policy's rules failed."""
    return F.col("failures").bitwiseAND(F.lit(policy.mask)) == 0


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents that fail it, and those that only it rejects.

    Folded by bit pattern first, so at most 2 ** rules rows are shuffled for a task.
    """
    failed = F.col("failures").bitwiseAND(F.lit(policy.mask))
    patterns = entries.groupBy(failed.alias("failed")).agg(F.count("*").alias("n"))
    rules = F.array(
        *(
            F.struct(F.lit(rule).alias("rule"), F.lit(1 << list(RULES).index(rule)).cast("long").alias("bit"))
            for rule in policy.rules
        )
    )
    each = patterns.select("failed", "n", F.explode(rules).alias("r"))
    own = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.lit(policy.version).alias("version"), F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(own, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failed") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
    )


def judged(entries: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """Ledger entries with `base_failed`, `kept` (false where the base rules failed) and
    `only_rule`, the one rule of the policy without which the document would pass it."""
    failed = F.col("failures").bitwiseAND(F.lit(policy.mask))
    only = [F.when(failed == 1 << list(RULES).index(rule), rule) for rule in policy.rules]
    return entries.withColumns(
        {
            "base_failed": ~passes(BASE),
            "kept": passes(BASE) & passes(policy),
            "only_rule": F.coalesce(*only, F.lit(None).cast("string")),
        }
    )


def verdicts(df: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The ledger of df, judged."""
    return judged(ledger(df), policy)


def filtered(df: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """The rows of df that the base rules and the policy pass."""
    return settled(verdicts(df, policy), F.col("kept")).select("row.*")
