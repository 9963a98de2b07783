"""Toxic documents by a subsequence string kernel, Nyström landmarks and a linear SVM.

A word is the bag of its three-letter subsequences, gaps allowed, inside `SPAN` letters;
each missing neighbour costs a factor `DECAY`. The kernel of two words is the dot product
of these bags, each scaled by its length, so an insult with inserted or changed letters or
another ending stays close to it. Punctuation inside a word is dropped, digits that stand
for letters are read as letters, and runs of single letters are read as one word.

Training, on a bounded sample of labelled documents (`SAMPLE` of each label, by a hash
order): letter runs that many toxic documents and hardly a clean one hold mark the
insulting words, unless they stand on words that a better run marks; landmarks are taken
from these and from clean words; the words' kernels to landmarks, whitened, are the SVM's
features, an insulting word weighs as many toxic texts as hold it; the clean words it
scores highest are added and it is trained again, unless they look like insults.

A document is more than its worst word: a stem that stands once in a tenth of the clean
texts is an insult where it stands often. So labelled texts train a second machine, on the
worst score of a text, the number of its insulting words and their share of all words; a
logistic curve on it is fitted with the labels' own share of toxic texts.

A kernel to fixed landmarks is linear in the bag, so the model is one weight for each
subsequence (LETTERS ** 3 numbers), and scoring is a table lookup: rows are independent,
nothing is shuffled, all words of all texts are read. Null and empty texts have the score
of a text without a known word, repeated rows have one score, an empty table has none. Only
doc_id and text are read, so further columns may have any name. Without both labels every
score is 0.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.text import whole_text

SAMPLE = 3_000
SPAN = 6
DECAY = 0.6
LETTERS = 48
LONGEST = 24
# Letters in a run: short ones for insults with changed letters, long ones for stems whose
# parts are common.
RUNS = (4, 6)
# Likelihood ratio that chance gives to one run in a million.
SURPRISE = 24.0
LISTED = 1_000
# A telling run or word is so many times as frequent in toxic texts as in clean ones.
RATE = 4
LANDMARKS = 240
WORDS = 3_000
ROUNDS = 5
# Clean words weigh so many times the insulting ones.
CLEAN_WEIGHT = 8.0
_HELD = 1_000_000
_GAPS = [(i, j) for i in range(1, SPAN) for j in range(1, SPAN) if i + j < SPAN]
_LOOKS = str.maketrans("013457@$!", "oieastasi")
_SINGLES = re.compile(r"(?:(?<=\s)|^)(?:\S\s+){3,}\S(?=\s|$)")


def letters(word: str) -> str:
    """Lower-case letters only, digits and signs that stand for letters replaced."""
    word = word.lower()
    if not word.isalpha():
        # A sign at an end is punctuation.
        word = word.strip("!$@.,;:?*%&#|\"'()[]")
        word = "".join(c for c in word.translate(_LOOKS) if c.isalpha())
    return word


@lru_cache(maxsize=4_096)
def _letter(c: str) -> int:
    """1..26 for a-z, 27..46 for others by a hash of the code point, 47 marks the ends."""
    n = ord(c)
    return n - 96 if 97 <= n <= 122 else 27 + n % 20


def pieces(word: str) -> list[str]:
    """The word, or overlapping parts of a long one."""
    if len(word) <= LONGEST:
        return [word]
    return [word[k : k + LONGEST] for k in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def word_codes(words: list[str]) -> np.ndarray:
    """Rows of letter codes between end marks, padded with 0."""
    out = np.zeros((len(words), LONGEST + 2), dtype=np.int64)
    for k, word in enumerate(words):
        out[k, : len(word) + 2] = [47, *map(_letter, word), 47]
    return out


def _subsequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each gap: numbers of the subsequences, which of them exist, their weight."""
    for i, j in _GAPS:
        n = codes.shape[1] - i - j
        a, b, c = codes[:, :n], codes[:, i : i + n], codes[:, i + j :]
        yield (a * LETTERS + b) * LETTERS + c, c > 0, DECAY ** (i + j - 2)


def _scale(codes: np.ndarray) -> np.ndarray:
    """Square root of the sum of squared weights of a word's subsequences."""
    size = (codes > 0).sum(1)
    return np.sqrt(
        sum(np.maximum(size - i - j, 0) * DECAY ** (2 * (i + j - 2)) for i, j in _GAPS) + 1e-9
    )


def dot(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Scaled bags of words times a weight for each subsequence."""
    total = np.zeros(len(codes))
    size = int((codes > 0).sum(1).max(initial=0))
    codes = codes[:, :size]
    for numbers, exist, weight in _subsequences(codes):
        total += weight * (table[numbers] * exist).sum(1)
    return total / _scale(codes)


def bag(code: np.ndarray) -> np.ndarray:
    """One word's scaled bag as a whole table."""
    table = np.zeros(LETTERS**3)
    row = code[None]
    for numbers, exist, weight in _subsequences(row):
        np.add.at(table, numbers[exist], weight)
    return table / _scale(row)[0]


@dataclass
class Model:
    """Score of a word: bag x table + bias; of a document: logistic(features x slopes + shift)."""

    table: np.ndarray
    bias: float
    slopes: np.ndarray
    shift: float


FEATURES = ("worst", "count", "share")


def unfitted() -> Model:
    """Where there is nothing to learn from every score is 0."""
    return Model(np.zeros(LETTERS**3), 0.0, np.zeros(len(FEATURES)), -30.0)


def _words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct white-space words of a column, the number of each word in order, and offsets."""
    split = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    coded = split.flatten().dictionary_encode()
    offsets = split.offsets.to_numpy()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), offsets - offsets[0]


def _spelled(text: str) -> list[str]:
    """Runs of single characters as words."""
    return [re.sub(r"\s+", "", m[0]) for m in _SINGLES.finditer(text)]


class Scorer:
    """Features of each text; keeps the scores of words it has seen."""

    def __init__(self, model: Model) -> None:
        self._model, self._held = model, {}

    def words(self, words: list[str]) -> np.ndarray:
        if len(self._held) + len(words) > _HELD:
            self._held.clear()
        new = [w for w in words if w not in self._held]
        parts = [pieces(letters(w)) for w in new]
        flat = [p for own in parts for p in own]
        # Short words first, so that a block is as wide as its longest word.
        order = sorted(range(len(flat)), key=lambda k: len(flat[k]))
        scores = np.empty(len(flat))
        for at in range(0, len(order), 4_096):
            block = order[at : at + 4_096]
            scores[block] = dot(word_codes([flat[k] for k in block]), self._model.table)
        scores += self._model.bias
        at = 0
        for word, own in zip(new, parts, strict=True):
            self._held[word] = float(scores[at : at + len(own)].max())
            at += len(own)
        return np.array([self._held[w] for w in words])

    def features(self, texts: pa.Array) -> np.ndarray:
        """A row of FEATURES for each text: its worst score (of a text without words the bias
        alone), and number and share of the words with a score above 0, as logarithms."""
        distinct, numbers, offsets = _words(texts)
        worst, bad = np.full(len(texts), self._model.bias), np.zeros(len(texts))
        size = np.diff(offsets).astype(np.float64)
        if len(numbers):
            scores = self.words(distinct)[numbers]
            full = np.flatnonzero(size)
            starts = offsets[:-1][full]
            worst[full] = np.maximum.reduceat(scores, starts)
            bad[full] = np.add.reduceat((scores > 0).astype(np.float64), starts)
        singles = pc.match_substring_regex(pc.fill_null(texts.cast(pa.string()), ""), r"(?:^|\s)(?:\S\s+){3,}\S(?:\s|$)")
        for k in pc.indices_nonzero(singles).to_pylist():
            if spelled := _spelled(texts[k].as_py()):
                scores = self.words(spelled)
                worst[k] = max(worst[k], scores.max())
                bad[k] += (scores > 0).sum()
        return np.stack((worst, np.log1p(bad), np.log1p(100 * bad / np.maximum(size, 1))), axis=1)


# Training


def _sample(documents: DataFrame, labels: DataFrame, each: int) -> DataFrame:
    """Texts and labels of at most `each` documents of either label, by a hash order."""
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    ).filter("doc_id is not null and toxic in (0, 1)")
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = (
        known.filter("toxic = 1").orderBy(*order).limit(each)
        .unionByName(known.filter("toxic = 0").orderBy(*order).limit(each))
    )
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    # At most 2 x SAMPLE rows of two numbers.
    return docs.join(F.broadcast(chosen.dropDuplicates(["doc_id"])), "doc_id")


def _runs(word: str) -> set[str]:
    marked = f"^{word}$"
    return {marked[k : k + n] for n in RUNS for k in range(len(marked) - n + 1)}


def _text_words(text: str) -> set[str]:
    return {w for raw in (*text.split(), *_spelled(text)) if (w := letters(raw))}


def _each_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct letter runs of each text."""
    for batch in batches:
        runs = [
            sorted(set().union(*map(_runs, _text_words(text))))
            for text in batch["text"].to_pylist()
        ]
        yield pa.record_batch(
            {"toxic": batch["toxic"], "runs": pa.array(runs, pa.list_(pa.string()))}
        )


def _marked(telling: frozenset[str]):
    """Distinct words of each text and whether one of the telling runs marks them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, words, marked = [], [], []
            for label, text in zip(batch["toxic"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for word in sorted(_text_words(text)):
                    mark = not telling.isdisjoint(_runs(word))
                    # Other words of toxic texts tell nothing.
                    if not label or mark:
                        toxic.append(label)
                        words.append(word)
                        marked.append(mark)
            yield pa.record_batch(
                {"toxic": pa.array(toxic, pa.int32()), "word": pa.array(words, pa.string()), "marked": pa.array(marked, pa.bool_())}
            )

    return run


def _spread(codes: np.ndarray, n: int) -> list[int]:
    """The first n / 4 words, then words far from these and from each other.

    Each next one has the least kernel to those chosen.
    """
    chosen = list(range(min(n // 4, len(codes))))
    near = np.max([dot(codes, bag(codes[k])) for k in chosen], axis=0)
    while len(chosen) < min(n, len(codes)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, dot(codes, bag(codes[chosen[-1]])))
    return list(dict.fromkeys(chosen))


def _svm(z: np.ndarray, y: np.ndarray, texts: np.ndarray, ridge: float = 1e-4, steps: int = 100) -> tuple[np.ndarray, float]:
    """Squared-hinge SVM by Newton steps on its support vectors; a word weighs as many `texts`."""
    z = np.hstack((z, np.ones((len(z), 1))))
    weight = texts * np.where(y > 0, 1 / max(texts[y > 0].sum(), 1), CLEAN_WEIGHT / max(texts[y < 0].sum(), 1))
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-9
    before = None
    for _ in range(steps):
        support = y * (z @ w) < 1
        if before is not None and (support == before).all():
            break
        before = support
        own = z[support] * weight[support, None]
        w = np.linalg.solve(own.T @ z[support] + penalty, own.T @ y[support])
    return w[:-1], float(w[-1])


class Nystroem:
    """Whitened kernels of words to landmarks, and SVMs on them."""

    def __init__(self, bad: list[str], texts: list[int], good: list[str]) -> None:
        half = LANDMARKS // 2
        self._landmarks = [
            codes[k]
            for codes in (word_codes([w[:LONGEST] for w in words[:600]]) for words in (bad, good))
            for k in _spread(codes, half)
        ]
        values, vectors = np.linalg.eigh(self._kernel(np.array(self._landmarks)))
        self._whiten = vectors / np.sqrt(np.maximum(values, 1e-6))
        self._z, self._y, self._texts = np.empty((0, len(self._landmarks))), np.empty(0), np.empty(0)
        self.add(bad, 1.0, texts)
        self.add(good, -1.0)

    def _kernel(self, codes: np.ndarray) -> np.ndarray:
        return np.stack([dot(codes, bag(code)) for code in self._landmarks], axis=1)

    def add(self, words: list[str], label: float, texts: list[int] | None = None) -> None:
        if words:
            z = self._kernel(word_codes([w[:LONGEST] for w in words])) @ self._whiten
            self._z = np.vstack((self._z, z))
            self._y = np.append(self._y, np.full(len(words), label))
            self._texts = np.append(self._texts, texts or np.ones(len(words)))

    def fit(self) -> tuple[np.ndarray, float]:
        """Weight of each subsequence and the bias."""
        w, bias = _svm(self._z, self._y, self._texts)
        table = np.zeros(LETTERS**3)
        for code, weight in zip(self._landmarks, self._whiten @ w, strict=True):
            table += weight * bag(code)
        return table, bias


def _telling_runs(words: list[tuple[str, int, int]], runs: list[str], sizes: dict[int, int]) -> list[str]:
    """Runs that still surprise without the words that runs before them mark.

    words: word, toxic and clean texts with it. An ending that stands on insults only is
    left out; an insult beside another one is not.
    """
    own = set(runs)
    holds = [sorted(_runs(w) & own) for w, _, _ in words]
    where: dict[str, list[int]] = {}
    for k, held in enumerate(holds):
        for r in held:
            where.setdefault(r, []).append(k)
    bad = {r: float(sum(words[k][1] for k in where.get(r, ()))) for r in runs}
    good = {r: float(sum(words[k][2] for k in where.get(r, ()))) for r in runs}
    share = sizes[1] / (sizes[0] + sizes[1])
    taken: set[int] = set()
    chosen: list[str] = []

    def surprise(r: str) -> float:
        b, g = bad[r], good[r]
        if b < 2 or b * sizes[0] < RATE * g * sizes[1]:
            return 0.0
        total = b + g
        return 2 * (b * np.log(b / (total * share)) + (g * np.log(g / (total * (1 - share))) if g else 0.0))

    while runs:
        best = max(runs, key=lambda r: (surprise(r), r))
        if surprise(best) < SURPRISE:
            break
        chosen.append(best)
        for k in where[best]:
            if k not in taken:
                taken.add(k)
                for r in holds[k]:
                    bad[r] -= words[k][1]
    return chosen


def _logistic(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Slopes and shift by Newton steps; toxic texts weigh `share` of all."""
    a = np.hstack((x, np.ones((len(x), 1))))
    weight = np.where(y > 0, share / max((y > 0).sum(), 1), (1 - share) / max((y == 0).sum(), 1))
    penalty = ridge * np.eye(a.shape[1])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        own = a * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]
        w -= np.linalg.solve(own.T @ a + penalty, a.T @ (weight * (p - y)) + penalty @ w)
    return w[:-1], float(w[-1])


def _text_features(model: Model):
    """Label and features of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found = scorer.features(batch["text"])
            columns = {name: found[:, k] for k, name in enumerate(FEATURES)}
            yield pa.record_batch({"toxic": batch["toxic"], **columns})

    return run


def _worst_words(model: Model):
    """Each text's worst word and its score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            best, scores = [], []
            for text in batch["text"].to_pylist():
                words = sorted(_text_words(text))
                own = scorer.words(words) if words else np.array([model.bias])
                best.append(words[int(own.argmax())] if words else None)
                scores.append(float(own.max()))
            yield pa.record_batch(
                {"toxic": batch["toxic"], "word": pa.array(best, pa.string()), "score": pa.array(scores, pa.float64())}
            )

    return run


def fit(documents: DataFrame, labels: DataFrame, each: int = SAMPLE) -> Model:
    """Fitted on at most `each` documents of either label; what is collected is bounded by WORDS and the sample."""
    sample = _sample(documents, labels, each).select("text", "toxic").cache()
    try:
        sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        if len(sizes) < 2:
            return unfitted()
        runs = (
            sample.mapInArrow(_each_runs, "toxic int, runs array<string>")
            .select("toxic", F.explode("runs").alias("run"))
            .groupBy("run")
            .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        )
        # Far too many toxic texts for chance, and hardly a clean one.
        share = sizes[1] / (sizes[0] + sizes[1])
        total = F.col("bad") + F.col("good")
        surprise = 2 * (
            F.col("bad") * F.log(F.col("bad") / (total * share))
            + F.col("good") * F.log(F.greatest("good", F.lit(1e-9)) / (total * (1 - share)))
        )
        rate = (F.col("bad") / sizes[1]) / ((F.col("good") + 0.5) / sizes[0])
        telling = runs.filter((F.col("bad") > 0) & (surprise >= SURPRISE) & (rate >= RATE))
        top = [r["run"] for r in telling.orderBy(F.desc("bad"), "run").limit(LISTED).collect()]

        def counted_words(marks: list[str]) -> DataFrame:
            words = sample.mapInArrow(_marked(frozenset(marks)), "toxic int, word string, marked boolean")
            return words.groupBy("word", "marked").agg(
                F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
            )

        # Words of the sample that hold a telling run: bounded by the sample.
        held = counted_words(top).filter("marked").select("word", "bad", "good").collect()
        marks = _telling_runs([tuple(r) for r in held], top, sizes)
        # A marked word insults if hardly a clean text holds it.
        insults = F.col("marked") & (F.col("bad") * sizes[0] >= RATE * F.col("good") * sizes[1])
        counted = counted_words(marks).withColumn("insults", insults & (F.col("bad") > 0))

        def most(found: DataFrame, *order) -> list[str]:
            return [r["word"] for r in found.orderBy(*order).limit(WORDS).collect()]

        found = counted.filter("insults").orderBy(F.desc("bad"), F.xxhash64("word")).limit(WORDS).collect()
        bad, texts = [r["word"] for r in found], [r["bad"] for r in found]
        good = counted.filter("good > 0 and not insults")
        good = list(dict.fromkeys(
            most(good, F.xxhash64("word")) + most(good, F.desc("good"), F.xxhash64("word"))
        ))
        if not bad or not good:
            return unfitted()
        machine, known = Nystroem(bad, texts, good), set(good)
        looks_bad = frozenset(marks)
        for turn in range(ROUNDS):
            model = Model(*machine.fit(), np.zeros(len(FEATURES)), 0.0)
            if turn == ROUNDS - 1:
                break
            worst = sample.mapInArrow(_worst_words(model), "toxic int, word string, score double").collect()
            hard = {
                r["word"][:LONGEST]
                for r in worst
                if not r["toxic"] and r["word"] and looks_bad.isdisjoint(_runs(r["word"]))
            } - known
            machine.add(sorted(hard), -1.0)
            known |= hard
        # The labels' own share, not that of the sample.
        toxic_share = labels.filter("cast(toxic as int) in (0, 1)").agg(F.avg(F.col("toxic").cast("int"))).first()[0]
        schema = "toxic int, " + ", ".join(f"{name} double" for name in FEATURES)
        texts_of = np.array(sample.mapInArrow(_text_features(model), schema).collect(), dtype=np.float64)
        model.slopes, model.shift = _logistic(texts_of[:, 1:], texts_of[:, 0], toxic_share)
        return model
    finally:
        sample.unpersist()


_kept: dict[str, Scorer] = {}


def _scorer(key: str, model: Model) -> Scorer:
    """The word scores of one model, kept by a reused worker."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = Scorer(model)
    return _kept[key]


def _score(key: str, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        scorer = _scorer(key, own)
        for whole in batches:
            for at in range(0, len(whole), 2_000):
                batch = whole.slice(at, 2_000)
                x = scorer.features(batch["text"]) @ own.slopes + own.shift
                yield pa.record_batch(
                    {
                        "doc_id": batch["doc_id"],
                        "score": pa.array(1 / (1 + np.exp(-np.clip(x, -30, 30))), pa.float64()),
                    }
                )

    return run


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of each whole text."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    sent = documents.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_score(uuid.uuid4().hex, sent), "doc_id long, score double")
