"""Token ids of whole texts.

A byte-level vocabulary's encoding works on pieces that never cross a single space between
two characters that are not white space, nor a letter's end before punctuation, nor a line
end between two such characters. So ids of a text are those of its chunks between these
places, put together. The tokenizers library encodes each new chunk once; a worker keeps the
ids of the chunks it met last, at most `HELD` besides those of the texts at hand. The more
texts come at once, the fewer chunks there are to look up. Texts with a space beside other
white space or at an end, or with a special token's string, are encoded whole, and so are
all texts of a vocabulary that splits them in another way.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

HELD = 350_000
IDS = np.dtype("<u4")
_JOINED, _AT_ONCE = 500, 32
# Before a chunk that does not follow a space. Texts that hold it are encoded whole.
_MARK = "\x1f"
_WHITE = r"[\x{00}-\x{20}\x{7f}-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{2064}\x{3000}\x{feff}]"
_UNEVEN = rf"^ | $|{_MARK}| {_WHITE}|{_WHITE} "
# Characters whose class every version of Unicode agrees on.
_LINE_END = r"([!-~À-ÿ])\n([!-~À-ÿ])"
_PUNCTUATED = r"([0-9A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?]+)( |$)"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _joined(ids: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(ids) if ids else np.empty(0, dtype=IDS)


def _binary(ids: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """Bytes of ids that lie end to end."""
    offsets = np.append(0, ends).astype(np.int64) * IDS.itemsize
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids, dtype=IDS))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), buffers)


class _Known:
    """Chunks, the bytes of their ids, and when each was last met."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.ids = pa.array([], pa.large_binary())
        self.met = np.empty(0, dtype=np.int64)
        self.now = 0

    def find(self, chunks: list[bytes]) -> np.ndarray:
        """The numbers of chunks, -1 for those that are not known."""
        numbers = np.fromiter(map(self.numbers.get, chunks, repeat(-1)), np.int64, len(chunks))
        self.now += 1
        self.met[numbers[numbers >= 0]] = self.now
        return numbers

    def add(self, chunks: list[bytes], ids: pa.LargeBinaryArray) -> np.ndarray:
        """The numbers that new chunks get."""
        known = len(self.numbers)
        found = np.arange(known, known + len(chunks))
        self.numbers.update(zip(chunks, found.tolist(), strict=True))
        self.ids = pa.concat_arrays([self.ids, ids])
        self.met = np.append(self.met, np.full(len(chunks), self.now))
        return found

    def forget(self, most: int) -> np.ndarray:
        """Keep those met last, and all met now; the new number of each, or -1."""
        most = max(most, int(np.count_nonzero(self.met == self.now)))
        kept = np.sort(np.argsort(-self.met, kind="stable")[:most])
        numbers = np.full(len(self.met), -1)
        numbers[kept] = np.arange(len(kept))
        pairs = zip(self.numbers, numbers.tolist(), strict=True)
        self.numbers = {chunk: number for chunk, number in pairs if number >= 0}
        self.ids, self.met = self.ids.take(pa.array(kept)), self.met[kept]
        return numbers


class Encoder:
    """Ids of a column of texts, as bytes of little-endian unsigned 32-bit integers.

    With `plain`, special tokens' strings in a text are plain text.
    """

    def __init__(self, path: str, plain: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = plain
        special = {t.content for t in self._tokenizer.get_added_tokens_decoder().values()}
        self._special = [] if plain else sorted(special)
        settings = json.loads(self._tokenizer.to_str())
        split = settings["pre_tokenizer"] or {}
        self._by_chunks = settings["normalizer"] is None and (
            split.get("type"), split.get("use_regex"), split.get("add_prefix_space")
        ) == ("ByteLevel", True, False)
        # A byte-level token has one character for each of its bytes.
        vocabulary = self._tokenizer.get_vocab()
        self._bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, at in vocabulary.items():
            self._bytes[at] = len(token)
        self._known = _Known()

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; a few at once, for the library keeps much of each token."""
        encode, found = self._tokenizer.encode_batch_fast, []
        for k in range(0, len(texts), _AT_ONCE):
            encoded = encode(texts[k : k + _AT_ONCE], add_special_tokens=False)
            found += [np.array(e.ids, dtype=IDS) for e in encoded]
        return found

    def _learn(self, chunks: pa.StringArray) -> pa.LargeBinaryArray:
        """Encode chunks; those that follow a space many in one text, told apart by bytes."""
        marked = pc.starts_with(chunks, _MARK)
        spaced, others = chunks.filter(pc.invert(marked)), chunks.filter(marked)
        starts = np.append(np.arange(0, len(spaced), _JOINED), len(spaced)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(starts, spaced), " ")
        ids = _joined(self._whole([" " + text for text in joined.to_pylist()]))
        sizes = pc.binary_length(spaced).to_numpy().astype(np.int64) + 1
        ends = np.searchsorted(np.cumsum(self._bytes[ids]), np.cumsum(sizes)) + 1
        alone = self._whole([c[1:] for c in others.to_pylist()])
        found = [_binary(ids, ends), _binary(_joined(alone), np.cumsum([len(x) for x in alone]))]
        order = np.argsort(marked.to_numpy(zero_copy_only=False), kind="stable")
        return pa.concat_arrays(found).take(pa.array(np.argsort(order)))

    def _know(self, chunks: pa.StringArray) -> np.ndarray:
        """Numbers of distinct chunks; those that are new are learned."""
        names = chunks.cast(pa.binary()).to_pylist()
        numbers = self._known.find(names)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            if len(self._known.numbers) + len(new) > HELD:
                # One more, so that -1 stays -1.
                numbers = np.append(self._known.forget(HELD // 2), -1)[numbers]
            ids = self._learn(chunks.take(pa.array(new)))
            numbers[new] = self._known.add([names[k] for k in new.tolist()], ids)
        return numbers

    def _chunks(self, texts: pa.Array, after_space: bool) -> tuple[pa.Array, np.ndarray]:
        """The chunks of all texts, and where those of each text begin; one more for the end."""
        marked = pc.replace_substring_regex(texts, _LINE_END, f"\\1 {_MARK}\n {_MARK}\\2")
        marked = pc.replace_substring_regex(marked, _PUNCTUATED, rf"\1 {_MARK}\2\3")
        if not after_space:
            marked = pc.binary_join_element_wise(_MARK, marked, "")
        split = pc.split_pattern(marked, " ")
        del marked
        offsets = split.offsets.to_numpy()
        return split.flatten().dictionary_encode(), offsets - offsets[0]

    def _even(self, texts: pa.Array, after_space: bool) -> list[bytes]:
        """Texts that are chunks parted by single spaces."""
        coded, starts = self._chunks(texts, after_space)
        numbers = self._know(coded.dictionary).astype(np.int32)
        taken = self._known.ids.take(pa.array(numbers[coded.indices.to_numpy()]))
        _, ends, data = taken.buffers()
        held = memoryview(data)
        stops = np.frombuffer(ends, np.int64)[starts].tolist()
        return [held[a:b].tobytes() for a, b in pairwise(stops)]

    def __call__(self, texts: pa.Array, after_space: bool = False) -> list[bytes]:
        """One entry for each text; null is empty. `after_space`: of space + text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if self._by_chunks:
            whole = pc.or_(pc.match_substring_regex(texts, _UNEVEN), pc.equal(texts, ""))
            for token in self._special:
                whole = pc.or_(whole, pc.match_substring(texts, token))
        else:
            whole = pa.array(np.ones(len(texts), dtype=bool))
        out: list[bytes] = [b""] * len(texts)

        def entire(some: pa.Array) -> list[bytes]:
            prefix = " " if after_space else ""
            return [a.tobytes() for a in self._whole([prefix + t for t in some.to_pylist()])]

        for places, encode in (
            (pc.indices_nonzero(pc.invert(whole)), lambda some: self._even(some, after_space)),
            (pc.indices_nonzero(whole), entire),
        ):
            if len(places):
                some = texts if len(places) == len(texts) else texts.take(places)
                for k, ids in zip(places.to_pylist(), encode(some), strict=True):
                    out[k] = ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False) -> Encoder:
    """One for each worker process and vocabulary."""
    return Encoder(path, plain)


def stretches(texts: pa.Array, most: int) -> list[tuple[int, int]]:
    """Rows that follow each other, (first, after the last), of about equal bytes, about `most`."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64))
    total = int(ends[-1]) if len(ends) else 0
    n = max(1, -(-total // most))
    cuts = np.searchsorted(ends, total * np.arange(1, n) // n, side="right")
    return [(a, b) for a, b in pairwise([0, *cuts.tolist(), len(texts)]) if a < b]


def id_lists(ids: list[bytes], end: bytes = b"") -> pa.ListArray:
    """As a list column, each with `end` after it, without a copy for each id."""
    offsets = np.concatenate(([0], np.cumsum([(len(x) + len(end)) // 4 for x in ids]))).astype(np.int32)
    joined = b"".join(chain.from_iterable(zip(ids, repeat(end))))
    return pa.ListArray.from_arrays(offsets, np.frombuffer(joined, dtype=np.int32))
