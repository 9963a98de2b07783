"""Personal data in whole texts: fixed patterns, and a character tagger that adds to them.

Emails, IP addresses, card and phone numbers have fixed definitions and are always
returned. A character-level bidirectional LSTM with CRF transitions adds `secret` spans
(keys, tokens, passwords); it is trained in numpy from generated sentences with labelled
spans of all five kinds, so that it tells a key from a card number or an address.

The tagger reads overlapping windows around every run of printable ASCII characters that holds
a digit or an @ (a span without either is none of the kinds). Each character takes its tag from
the window in which it lies farthest from an edge; spans are read from these tags of
the whole text, so a span that several windows cut is found whole. A tagged span of a
base kind that the fixed patterns do not confirm is dropped, as is a secret that overlaps
a base span or has fewer than `LEAST_SECRET` characters.

Rows are independent: no shuffle. Weights depend on constants alone, are trained once for a
driver process and are some 20 KB. Null and empty texts have no spans, repeated rows each
get theirs, an empty table gives no rows. `find` reads doc_id and text only; `redact` reads text
and keeps all other columns, whatever their names. Time grows with the length of a text, whatever it holds.
"""

from __future__ import annotations

import hashlib
import re
import string
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.llm import crf
from hourcast.llm.text import whole_text

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
WINDOW = 64
OVERLAP = 32
MARGIN = 16
EXAMPLES = 2_400
LEAST_SECRET = 8
_BATCH = 512

Span = tuple[int, int, int]

# The patterns of the base kinds. A search of them takes time in the square of
# a run that never matches, so an address is found from its @ and a match begins where a run does.
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_HIT = re.compile(r"[0-9@]")
_RUN = re.compile(r"[!-~]+")
KEY = frozenset(string.ascii_letters + string.digits + "-_/+")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Characters before an @ as far as they belong to an address, and the domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _octet(part: str) -> bool:
    value = part.lstrip("0") or "0"
    return len(value) < 4 and int(value) <= 255


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    spans: list[Span] = [(0, *span) for span in _emails(text)]
    spans += [(1, *m.span()) for m in IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        spans += [
            (3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15
        ]
    return spans


# Labelled examples


def _word(rng: np.random.Generator) -> str:
    letters = "abcdefghijklmnopqrstuvwxyzäéñóü"
    size = int(rng.integers(1, 12))
    word = "".join(letters[k] for k in rng.integers(0, len(letters), size))
    style = rng.random()
    word = word.upper() if style < 0.1 else word.title() if style < 0.25 else word
    ends = ("", "", "", "", ",", ".", "!!", "%%%", "***", "&&&", ":", " |")
    return word + ends[int(rng.integers(len(ends)))]


def _some(rng: np.random.Generator, letters: str, low: int, high: int) -> str:
    return "".join(letters[k] for k in rng.integers(0, len(letters), int(rng.integers(low, high + 1))))


def _card(rng: np.random.Generator) -> str:
    digits = _some(rng, string.digits, 15, 15)
    digits = next(digits + d for d in string.digits if luhn(digits + d))
    gap = ("", "", " ", "-")[int(rng.integers(4))]
    return gap.join(digits[k : k + 4] for k in range(0, 16, 4))


def _phone(rng: np.random.Generator) -> str:
    a, b, c = (_some(rng, string.digits, n, n) for n in (3, 3, 4))
    forms = (f"+1 ({a}) {b}-{c}", f"+1-{a}-{b}-{c}", f"+49 {a} {b}{c}", f"+33.{a}.{b}.{c}")
    return forms[int(rng.integers(4))]


def _secret(rng: np.random.Generator) -> tuple[str, str, str]:
    """What stands before, the secret, what stands after."""
    hexadecimal, mixed = "0123456789abcdef", string.ascii_letters + string.digits
    value = (
        lambda: _some(rng, hexadecimal, 32, 48),
        lambda: "AKIA" + _some(rng, string.ascii_uppercase + string.digits, 16, 16),
        lambda: _some(rng, mixed, 20, 40),
        lambda: "sk-" + _some(rng, mixed, 20, 32),
        lambda: _some(rng, hexadecimal, 10, 20),
    )
    k = int(rng.integers(len(value)))
    name = ("token", "secret", "api_key", "password", "key")[int(rng.integers(5))]
    open_, close = ((f'{name} = "', '"'), (f"{name}=", ""), (f"{name}: ", ""))[int(rng.integers(3))]
    # Short values are secrets only after a name; long ones also stand alone.
    if k != 4 and rng.random() < 0.3:
        open_, close = "", ""
    return open_, value[k](), close


def _plain(rng: np.random.Generator) -> str:
    """Digits that are none of the kinds."""
    number = lambda low, high: str(rng.integers(low, high))
    forms = (
        lambda: number(1, 3000),
        lambda: f"{number(1, 30)}.{number(0, 99)}",
        lambda: f"{number(1900, 2030)}-{number(10, 13)}-{number(10, 29)}",
        lambda: f"v{number(0, 9)}.{number(0, 20)}.{number(0, 9)}",
        lambda: f"{number(1, 999)},{number(100, 999)}",
        lambda: f"({number(1, 99)})",
        lambda: f"{number(1, 24)}:{number(10, 59)}",
        lambda: f"CC BY-NC {number(1, 5)}.0",
        lambda: _word(rng).strip("|, ") + number(0, 99),
        lambda: f"{number(10**4, 10**9)}",
    )
    return forms[int(rng.integers(len(forms)))]()


def examples(n: int = EXAMPLES, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Windows of generated text and their tags: 0 outside, 2k + 1 begins, 2k + 2 continues kind k."""
    rng = np.random.default_rng(seed)
    x, y = [], []
    while len(x) < n:
        text, tags = "", []

        def add(piece: str, kind: int = -1) -> None:
            nonlocal text
            text += piece
            if kind < 0:
                tags.extend([0] * len(piece))
            else:
                tags.extend([2 * kind + 1] + [2 * kind + 2] * (len(piece) - 1))

        for _ in range(int(rng.integers(8, 20))):
            draw = int(rng.integers(14))
            if draw == 0:
                name = _some(rng, string.ascii_lowercase, 2, 9)
                add(f"{name}.{rng.integers(100)}@mail{rng.integers(9)}.example.com", 0)
            elif draw == 1:
                add(".".join(str(k) for k in rng.integers(1, 255, 4)), 1)
            elif draw == 2:
                add(_card(rng), 2)
            elif draw == 3:
                add(_phone(rng), 3)
            elif draw <= 5:
                before, value, after = _secret(rng)
                add(before)
                add(value, 4)
                add(after)
            elif draw <= 7:
                add(_plain(rng))
            else:
                add(_word(rng))
            add(("", "###", "%%%", ",", "!!", ".")[int(rng.integers(6))] if rng.random() < 0.2 else "")
            add("\n" if rng.random() < 0.05 else " ")
        at = int(rng.integers(0, max(1, len(text) - WINDOW // 2)))
        x.append(crf.codes(text[at : at + WINDOW], WINDOW))
        own = np.zeros(WINDOW, dtype=np.int64)
        part = tags[at : at + WINDOW]
        own[: len(part)] = part
        y.append(own)
    return np.array(x), np.array(y)


@lru_cache(maxsize=1)
def trained() -> dict[str, np.ndarray]:
    """Once for a process; the same weights each time."""
    return crf.train(*examples(), tags=2 * len(KINDS) + 1)


# Tagging


def _seeds(text: str) -> Iterator[tuple[int, int]]:
    """Runs of printable ASCII characters that hold a digit or an @."""
    for m in _RUN.finditer(text):
        if _HIT.search(text, *m.span()):
            yield m.span()


def windows(text: str) -> list[int]:
    """Starts of overlapping windows that cover every run with a digit or an @ and its margins."""
    starts: list[int] = []
    until = 0
    for first, last in _seeds(text):
        at, end = max(until, first - MARGIN, 0), min(len(text), last + MARGIN)
        if starts and at <= until:
            at = max(0, until - OVERLAP)
        while until < end:
            starts.append(at)
            until = at + WINDOW
            at = until - OVERLAP
    return starts


def reconcile(length: int, starts: list[int], tags: np.ndarray) -> np.ndarray:
    """Tags of the whole text; a character's come from the window whose edges are farthest."""
    out = np.zeros(length, dtype=np.int64)
    depth = np.full(length, -1, dtype=np.int64)
    place = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
    for start, own in zip(starts, tags, strict=True):
        n = min(WINDOW, length - start)
        deeper = place[:n] > depth[start : start + n]
        out[start : start + n][deeper] = own[:n][deeper]
        depth[start : start + n][deeper] = place[:n][deeper]
    return out


def tagged_spans(tags: np.ndarray) -> list[Span]:
    """Runs of one kind; a begin tag starts a new one."""
    spans: list[Span] = []
    for at in np.flatnonzero(tags).tolist():
        tag = int(tags[at])
        kind = (tag - 1) // 2
        if tag % 2 == 0 and spans and spans[-1][0] == kind and spans[-1][2] == at:
            spans[-1] = (kind, spans[-1][1], at + 1)
        else:
            spans.append((kind, at, at + 1))
    return spans


def _key_runs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """For every place, where the run of key characters that it lies in begins and ends."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    other = ~np.isin(codes, [ord(c) for c in KEY])
    place = np.arange(len(codes))
    begins = np.maximum.accumulate(np.where(other, place + 1, 0))
    ends = np.minimum.accumulate(np.where(other, place, len(codes))[::-1])[::-1]
    return begins, ends


def added(text: str, base: list[Span], tagged: list[Span]) -> list[Span]:
    """Tagged secrets, widened to the whole run of key characters, that base spans leave free."""
    secrets = [(start, end) for kind, start, end in tagged if KINDS[kind] == "secret"]
    if not secrets:
        return []
    begins, ends = _key_runs(text)
    fixed = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in fixed]
    # The farthest end among the base spans up to each one.
    reach = list(accumulate((b for _, b in fixed), max))
    out: list[Span] = []
    seen = (-1, -1)
    for start, end in secrets:
        if start > 0:
            start = min(start, int(begins[start - 1]))
        if end < len(text):
            end = max(end, int(ends[end]))
        if (start, end) == seen or (out and start < out[-1][2]):
            continue
        seen = (start, end)
        value = text[start:end]
        before = bisect_left(starts, end)
        if (
            len(value) >= LEAST_SECRET
            and value.isascii()
            and any(c.isdigit() for c in value)
            and any(c.isalpha() for c in value)
            and not (before and reach[before - 1] > start)
        ):
            out.append((KINDS.index("secret"), start, end))
    return out


def spans_of(texts: list[str], decode: Callable[[np.ndarray], np.ndarray]) -> list[list[Span]]:
    """All spans of each text by kind, then start."""
    base: list[list[Span]] = []
    places: list[list[int]] = []
    rows: list[np.ndarray] = []
    for text in texts:
        if not _HIT.search(text):
            base.append([])
            places.append([])
            continue
        base.append(base_spans(text))
        places.append(windows(text))
        rows += [crf.codes(text[at : at + WINDOW], WINDOW) for at in places[-1]]
    tags = [decode(np.array(rows[k : k + _BATCH])) for k in range(0, len(rows), _BATCH)]
    every = np.concatenate(tags) if tags else np.empty((0, WINDOW), dtype=np.int64)
    out, at = [], 0
    for text, fixed, starts in zip(texts, base, places, strict=True):
        if starts:
            own = reconcile(len(text), starts, every[at : at + len(starts)])
            at += len(starts)
            fixed = fixed + added(text, fixed, tagged_spans(own))
        out.append(sorted(fixed))
    return out


def _find(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = lambda x: crf.decode(weights.value, x)
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        )
        for whole in batches:
            for at in range(0, len(whole), 1_000):
                batch = whole.slice(at, 1_000)
                found = spans_of(batch["text"].to_pylist(), decode)
                yield pa.record_batch(
                    {
                        **{name: batch[name] for name in batch.schema.names if name != "text"},
                        "text": batch["text"],
                        "spans": pa.array(
                            [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in s] for s in found],
                            kind,
                        ),
                    }
                )

    return run


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find(df: DataFrame) -> DataFrame:
    """doc_id, text and spans: array of (kind, start, end) in code points, by kind, then start."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    weights = df.sparkSession.sparkContext.broadcast(trained())
    return rows.mapInArrow(_find(weights), f"doc_id long, text string, spans {SPANS}")


def _listed(spans: Column) -> Column:
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE),
        F.sha2(_listed(of(*BASE)), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def base_digest(text: str) -> str:
    """base_sha256 of one text."""
    return hashlib.sha256(
        ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base_spans(text)).encode()
    ).hexdigest()


def _redact(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = lambda x: crf.decode(weights.value, x)
        for batch in batches:
            texts = batch["text"].to_pylist()
            out = []
            for text, spans in zip(
                texts, spans_of([t or "" for t in texts], decode), strict=True
            ):
                pieces, at = [], 0
                for _, start, end, name in sorted((0, a, b, KINDS[k]) for k, a, b in spans):
                    if start >= at:
                        pieces += [text[at:start], f"[{name.upper()}]"]
                    # Overlapping spans leave nothing of either.
                    at = max(at, end)
                out.append("".join((*pieces, text[at:])) if spans else text)
            names = batch.schema.names
            yield batch.set_column(names.index("text"), "text", pa.array(out, pa.string()))

    return run


def redact(df: DataFrame) -> DataFrame:
    """df with every span in `text` replaced by its kind in brackets; other columns stay."""
    weights = df.sparkSession.sparkContext.broadcast(trained())
    rows = df.withColumn("text", F.col("text").cast("string"))
    return rows.mapInArrow(_redact(weights), rows.schema)
