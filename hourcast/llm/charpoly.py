"""Characteristic polynomials, real roots and null vectors of integer matrices, exactly.

For symmetric matrices of integers without negative eigenvalues, as scatter matrices are.
Polynomials are lists of integers, constant term first.
"""

from __future__ import annotations

import math
import random
from itertools import pairwise

import numpy as np

# Roots are found on a grid of this many binary places; closer ones count as equal.
ROOT_BITS = 128
# Binary places of the arithmetic in inverse iteration.
SOLVE_BITS = 384
_LARGEST = (1 << 31) - 1


def coefficient_bound(size: int, trace: int) -> int:
    """No coefficient is larger: sums of products of k eigenvalues are largest if all are equal."""
    mean = trace // size + 1
    return max(math.comb(size, k) * mean**k for k in range(size + 1))


def primes(bound: int) -> list[int]:
    """Primes of 31 bits whose product is more than twice `bound`, so that signs are told apart."""
    sieve = np.ones(math.isqrt(_LARGEST) + 1, dtype=bool)
    sieve[:2] = False
    for k in range(2, math.isqrt(len(sieve)) + 1):
        if sieve[k]:
            sieve[k * k :: k] = False
    divisors = np.flatnonzero(sieve)
    found, product, at = [], 1, _LARGEST
    while product <= 2 * bound:
        if (at % divisors).all():
            found.append(at)
            product *= at
        at -= 2
    return found


def hessenberg(matrix: np.ndarray, prime: int) -> np.ndarray:
    """A similar matrix modulo `prime` with zeros below the first subdiagonal."""
    h = matrix.copy()
    for k in range(1, len(h) - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        if pivot := below[0]:
            h[[k, k + pivot]] = h[[k + pivot, k]]
            h[:, [k, k + pivot]] = h[:, [k + pivot, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, prime) % prime
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k] % prime) % prime
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factor % prime).sum(axis=1)) % prime
    return h


def residues(matrix: np.ndarray, prime: int) -> np.ndarray:
    """The coefficients of det(xI - matrix) modulo `prime`."""
    size = len(matrix)
    h = hessenberg((matrix % prime).astype(np.int64), prime)
    leading = np.zeros((size + 1, size + 1), dtype=np.int64)  # of the leading minors
    leading[0, 0] = 1
    below = np.zeros(size, dtype=np.int64)  # products of the subdiagonal from a row on
    for k in range(size):
        if k:
            below[:k] = below[:k] * h[k, k - 1] % prime
        below[k] = 1
        weights = h[: k + 1, k] * below[: k + 1] % prime
        shifted = np.roll(leading[k], 1)
        taken = (weights[:, None] * leading[: k + 1] % prime).sum(axis=0)
        leading[k + 1] = (shifted - taken) % prime
    return leading[size]


def remaindered(found: dict[int, list[int]]) -> list[int]:
    """The integers nearest to zero with the residues found for each prime."""
    product = math.prod(found)
    total = [0] * len(next(iter(found.values())))
    for prime, own in found.items():
        rest = product // prime
        weight = rest * pow(rest, -1, prime)
        total = [t + weight * r for t, r in zip(total, own, strict=True)]
    return [(t + product // 2) % product - product // 2 for t in total]


def _scaled(poly: list[int], bits: int) -> list[int]:
    """A polynomial whose roots are 2^bits times as large."""
    return [c << bits * (len(poly) - 1 - k) for k, c in enumerate(poly)]


def roots_above(poly: list[int], at: int) -> int:
    """How many roots exceed `at`, counted as often as they occur.

    As all roots are real, the signs of the polynomial moved by `at` change that many times.
    """
    moved = list(poly)
    for done in range(len(moved) - 1):
        for k in range(len(moved) - 2, done - 1, -1):
            moved[k] += at * moved[k + 1]
    signs = [c > 0 for c in moved if c]
    return sum(x != y for x, y in pairwise(signs))


def _value(poly: list[int], at: int) -> int:
    total = 0
    for c in reversed(poly):
        total = total * at + c
    return total


def largest_roots(poly: list[int], most: int, bits: int = ROOT_BITS) -> list[tuple[int, int]]:
    """(lower end, how many) of the cells of width 2^-bits that hold the largest positive roots.

    Ends are integers over 2^bits; cells come from the largest down, until `most` roots are
    in them. Cells are halved by counting until a root is alone, and then by the sign.
    """
    scaled = _scaled(poly, bits)
    top = 1 << max(0, -poly[-2]).bit_length() + bits  # the sum of all roots is below
    counts = {0: roots_above(scaled, 0), top: 0}

    def above(at: int) -> int:
        if at not in counts:
            counts[at] = roots_above(scaled, at)
        return counts[at]

    found: list[tuple[int, int]] = []
    while (held := sum(n for _, n in found)) < min(most, counts[0]):
        low = max(at for at, n in counts.items() if n > held)
        high = min(at for at, n in counts.items() if n <= held)
        while high - low > 1 and counts[low] - counts[high] > 1:
            middle = (low + high) // 2
            if above(middle) > held:
                low = middle
            else:
                high = middle
        if high - low > 1:
            # Alone in (low, high]: above it the sign is the one at the upper end.
            sign = _value(scaled, high)
            if sign:
                while high - low > 1:
                    middle = (low + high) // 2
                    value = _value(scaled, middle)
                    if value and (value > 0) == (sign > 0):
                        high = middle
                    else:
                        low = middle
                    if not value:
                        low, high = middle - 1, middle
            else:
                low = high - 1
            counts[low], counts[high] = held + 1, held
        found.append((low, counts[low] - counts[high]))
    return found


def _reduced(matrix: np.ndarray, shift: int) -> tuple[np.ndarray, list[int]]:
    """Elimination of matrix - shift with row swaps, in fixed point; factors lie below."""
    a = matrix * (1 << SOLVE_BITS)
    a[np.diag_indices(len(a))] -= shift
    swaps = []
    for k in range(len(a)):
        pivot = max(range(k, len(a)), key=lambda i: abs(a[i, k]))
        swaps.append(pivot)
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
        a[k, k] = a[k, k] or 1  # the smallest number, for an exact root
        a[k + 1 :, k] = (a[k + 1 :, k] << SOLVE_BITS) // a[k, k]
        a[k + 1 :, k + 1 :] -= (a[k + 1 :, k][:, None] * a[k, k + 1 :][None, :]) >> SOLVE_BITS
    return a, swaps


def _solved(a: np.ndarray, swaps: list[int], right: np.ndarray) -> np.ndarray:
    x = right.copy()
    for k, pivot in enumerate(swaps):
        x[k], x[pivot] = x[pivot], x[k]
        x[k + 1 :] -= (a[k + 1 :, k] * x[k]) >> SOLVE_BITS
    for k in range(len(a) - 1, -1, -1):
        x[k] = (x[k] << SOLVE_BITS) // a[k, k]
        x[:k] -= (a[:k, k] * x[k]) >> SOLVE_BITS
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    """Of length 1 in fixed point."""
    norm = math.isqrt(sum(int(v) * int(v) for v in x))
    return np.array([(int(v) << SOLVE_BITS) // norm for v in x], dtype=object)


def null_vectors(matrix: np.ndarray, root: int, n: int, bits: int = ROOT_BITS) -> np.ndarray:
    """n unit vectors, one a row, that span the null space of matrix - root.

    `root` is the lower end of its cell. Inverse iteration from seeded random vectors; those
    of an eigenvalue that occurs n times are made orthogonal. The largest cell is positive.
    """
    shift = (2 * root + 1) << (SOLVE_BITS - bits - 1)
    a, swaps = _reduced(matrix, shift)
    draw = random.Random(0)
    found: list[np.ndarray] = []
    for _ in range(n):
        x = np.array([draw.getrandbits(64) - (1 << 63) for _ in matrix], dtype=object)
        x = _unit(x)
        for _ in range(3):
            x = _unit(_solved(a, swaps, x))
            for other in found:
                x = x - (other * (int((other * x).sum()) >> SOLVE_BITS) >> SOLVE_BITS)
            x = _unit(x)
        found.append(x)
    out = np.array([[int(v) / (1 << SOLVE_BITS) for v in x] for x in found])
    first = np.abs(out).argmax(axis=1)
    return out * np.sign(out[np.arange(n), first])[:, None]
