"""Sets of hashed word shingles and their signatures, for whole Arrow columns.

A word's hash is XXH3; a shingle's is the mixed sum of its words' hashes times one
odd number for each position. Hashes have 64 bits, so two different shingles of a pair
of texts of 1,000 words agree once in about 10 ** 13 pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

BLOCK_WORDS = 20_000

_rng = np.random.default_rng(20_240_601)
_PLACES = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _block(words: list[bytes], counts: list[int], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of texts that have so many of the words each."""
    hashes = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    sums = np.zeros(max(len(words) - width + 1, 0), dtype=np.uint64)
    for k in range(width):
        sums += hashes[k : k + len(sums)] * _PLACES[k]
    sums = _mix(sums)
    a = 0
    for n in counts:
        if n >= width:
            tokens = np.sort(sums[a : a + n - width + 1])
            yield tokens[np.append(True, tokens[1:] != tokens[:-1])]
        elif n:
            short = (hashes[a : a + n] * _PLACES[:n]).sum(dtype=np.uint64, keepdims=True)
            yield _mix(short + _PLACES[-n])
        else:
            yield np.empty(0, dtype=np.uint64)
        a += n


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The set of each text as a sorted array; null and wordless texts have the empty one."""
    words: list[bytes] = []
    counts: list[int] = []
    # bytes.lower() changes A-Z alone, bytes.split() parts at the six ASCII spaces.
    for text in texts.cast(pa.binary()):
        own = (text.as_py() or b"").lower().split()
        words += own
        counts.append(len(own))
        if len(words) >= BLOCK_WORDS:
            yield from _block(words, counts, width)
            words, counts = [], []
    yield from _block(words, counts, width)


def bitmap(tokens: np.ndarray) -> bytes:
    """One bit for each token by its low bits; two bits of room for each, 1,024 at least."""
    size = 1 << max(10, (2 * len(tokens) - 1).bit_length())
    bits = np.zeros(size, dtype=bool)
    bits[(tokens & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """A bitmap of `size` bytes with the same tokens."""
    return np.bitwise_or.reduce(np.frombuffer(bits, dtype=np.uint8).reshape(-1, size), axis=0)


def most_common(bits: bytes, n: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The most tokens a set can share with each of others (rows of bitmaps of one length).

    A bit that only one of two sets has is a token that only one has.
    """
    length = min(len(bits), others.shape[1])
    own = folded(bits, length)
    rows = np.bitwise_or.reduce(others.reshape(len(others), -1, length), axis=1)
    only_own = np.bitwise_count(own & ~rows).sum(1, dtype=np.int64)
    only_other = np.bitwise_count(rows & ~own).sum(1, dtype=np.int64)
    return np.minimum(n - only_own, sizes - only_other)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Tokens in both sorted sets."""
    both = np.sort(np.concatenate((a, b)), kind="stable")
    return int((both[1:] == both[:-1]).sum())
