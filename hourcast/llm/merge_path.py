"""Merging two rising sequences in independent pieces of equal work.

The merge of a and b is a path through a grid; its k-th step lies on the k-th diagonal. A
binary search along a diagonal finds the place where the path crosses it, so the path can be
cut at equal distances without being walked. A piece needs only its own stretch of both.

a and b are the ends of tokens over the same bytes, without repeats and with the same last
end. A piece emits the overlaps of a-tokens and b-tokens in it, and whether both end there;
where both end, a group ends. Pieces are then stitched: an end that both have may fall on a
border, with the a-token in one piece and the b-token in the next.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Steps of the merge in one piece.
WORK = 1 << 16


class Overlaps(NamedTuple):
    """Overlapping tokens in merge order, and whether both end together."""

    a: np.ndarray
    b: np.ndarray
    closes: np.ndarray


def crossings(a: np.ndarray, b: np.ndarray, work: int = WORK) -> np.ndarray:
    """How many of a the path has taken at every `work`-th diagonal, first and last included.

    Of equal ends that of a comes first.
    """
    steps = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        # Read only where the search is open; both places exist there.
        first = np.zeros(len(steps), dtype=bool)
        first[open_] = a[middle[open_]] <= b[(steps - 1 - middle)[open_]]
        low = np.where(open_ & first, middle + 1, low)
        high = np.where(open_ & ~first, middle, high)
    return low


def overlaps(a: np.ndarray, b: np.ndarray, a_from: int = 0, b_from: int = 0) -> Overlaps:
    """The overlaps of one piece; its first tokens have the numbers a_from and b_from.

    Each end in the piece is the end of one overlap: of the token that ends there and the
    token of the other side that lies there.
    """
    at = np.searchsorted(b, a)
    closes = np.zeros(len(a), dtype=bool)
    inside = at < len(b)
    closes[inside] = b[at[inside]] == a[inside]
    alone = np.ones(len(b), dtype=bool)
    alone[at[closes]] = False
    own = np.flatnonzero(alone)
    across = np.searchsorted(a, b[own])
    # The place of an end among those of both sides, common ends counted once.
    common = np.concatenate(([0], np.cumsum(closes)))
    a_place = np.arange(len(a)) + at - common[:-1]
    b_place = own + across - common[across]
    size = len(a) + len(own)
    out = Overlaps(np.empty(size, np.int64), np.empty(size, np.int64), np.zeros(size, bool))
    out.a[a_place], out.b[a_place], out.closes[a_place] = np.arange(len(a)) + a_from, at + b_from, closes
    out.a[b_place], out.b[b_place] = across + a_from, own + b_from
    return out


def stitched(pieces: list[Overlaps], a: np.ndarray, b: np.ndarray) -> Overlaps:
    """The overlaps of all pieces, with common ends that fall on a border brought together."""
    for left, right in zip(pieces, pieces[1:]):
        if not len(left.a) or not len(right.a):
            continue
        i, j = left.a[-1], right.b[0]
        if left.b[-1] == j and a[i] == b[j]:
            # The a-token closed its group here; the b-token's own overlap is the same one.
            left.closes[-1] = True
            right.a[0] = -1
    joined = Overlaps(*map(np.concatenate, zip(*pieces)))
    kept = joined.a >= 0
    return Overlaps(*(column[kept] for column in joined))


def merged(a: np.ndarray, b: np.ndarray, work: int = WORK) -> Overlaps:
    """All overlaps of the tokens that end at a and b."""
    taken = crossings(a, b, work)
    steps = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    borders = list(zip(taken.tolist(), (steps - taken).tolist()))
    pieces = [
        overlaps(a[i:k], b[j:m], i, j) for (i, j), (k, m) in zip(borders, borders[1:])
    ]
    return stitched(pieces, a, b) if pieces else overlaps(a, b)


def groups(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """The group of every a-token and b-token, from 0: groups end where both sides do."""
    found = merged(a, b, work)
    number = np.cumsum(found.closes) - found.closes
    a_group, b_group = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    a_group[found.a], b_group[found.b] = number, number
    return a_group, b_group
