"""Exact spectrum of an integer symmetric matrix without negative eigenvalues.

The characteristic polynomial is found modulo many primes by Hessenberg reduction
and put together by Chinese remaindering. All its roots are real, so the number
of sign changes of the polynomial shifted to a point is exactly the number of
roots beyond that point, and bisection encloses each root. Eigenvectors are the
null space of the matrix less the root, by inverse iteration with integers of a
few hundred bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import isqrt

import numpy as np

#: Roots are enclosed to this many bits below the matrix's trace. Roots that are
#: not told apart by then count as one repeated root.
ROOT_BITS = 192
#: Further bits of the arithmetic of inverse iteration.
GUARD_BITS = 160
ROUNDS = 3


def is_prime(n: int) -> bool:
    if n < 2 or n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):  # Enough below 3,215,031,751.
        if base % n == 0:
            continue
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_down(limit: int = (1 << 31) - 1) -> Iterator[int]:
    n = limit
    while True:
        if is_prime(n):
            yield n
        n -= 1


def primes_for(trace: int, size: int) -> list[int]:
    """Primes whose product is beyond twice any coefficient: the k-th is at most
    binomial(size, k) * (trace / size) ** k."""
    bound, product, out = 2 * (trace // size + 2) ** size, 1, []
    for p in primes_down():
        out.append(p)
        product *= p
        if product > bound:
            return out
    raise AssertionError


def characteristic_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(t - matrix) modulo ``p``, constant first."""
    a = matrix % p
    n = len(a)
    for k in range(1, n - 1):
        nonzero = np.flatnonzero(a[k:, k - 1])
        if not len(nonzero):
            continue
        pivot = k + int(nonzero[0])
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            a[:, [k, pivot]] = a[:, [pivot, k]]
        factor = a[k + 1:, k - 1] * pow(int(a[k, k - 1]), -1, p) % p
        a[k + 1:] = (a[k + 1:] - factor[:, None] * a[k] % p) % p
        a[:, k] = (a[:, k] + (a[:, k + 1:] * factor % p).sum(axis=1)) % p
    # Leading minors of t - Hessenberg, each from all before it.
    minors = np.zeros((n + 1, n + 1), np.int64)
    minors[0, 0] = 1
    for k in range(1, n + 1):
        new = np.zeros(n + 1, np.int64)
        new[1:] = minors[k - 1, :-1]
        weights = np.zeros(k, np.int64)
        weights[k - 1] = a[k - 1, k - 1]
        below = 1
        for i in range(k - 2, -1, -1):
            below = below * int(a[i + 1, i]) % p
            if not below:
                break
            weights[i] = below * int(a[i, k - 1]) % p
        new -= (weights[:, None] * minors[:k] % p).sum(axis=0) % p
        minors[k] = new % p
    return minors[n].tolist()


def remaindered(primes: list[int], residues: list[list[int]]) -> list[int]:
    """Integers nearest zero with the given residues."""
    modulus, values = 1, [0] * len(residues[0])
    for p, own in zip(primes, residues, strict=True):
        inverse = pow(modulus % p, -1, p)
        values = [v + modulus * ((r - v) * inverse % p) for v, r in zip(values, own, strict=True)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


def _reduced(place: int, bits: int) -> tuple[int, int]:
    """place / 2**bits with as few bits as it needs."""
    if not place:
        return 0, 0
    cut = min(bits, (place & -place).bit_length() - 1)
    return place >> cut, bits - cut


def _scaled(polynomial: list[int], bits: int) -> list[int]:
    top = len(polynomial) - 1
    return [c << (bits * (top - k)) for k, c in enumerate(polynomial)]


def roots_beyond(polynomial: list[int], place: int, bits: int) -> int:
    """How many roots, repeated ones counted, are greater than place / 2**bits."""
    place, bits = _reduced(place, bits)
    shifted = _scaled(polynomial, bits)
    n = len(shifted)
    if place:
        for low in range(n - 1):
            for k in range(n - 2, low - 1, -1):
                shifted[k] += place * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _positive(polynomial: list[int], place: int, bits: int) -> int:
    place, bits = _reduced(place, bits)
    value = 0
    for c in reversed(_scaled(polynomial, bits)):
        value = value * place + c
    return (value > 0) - (value < 0)


def largest_roots(polynomial: list[int], trace: int, most: int) -> tuple[list[tuple[int, int]], int]:
    """The largest positive roots as (place, times), falling, and the bits b of
    places: a root lies in (place, place + 1) / 2**b, or at its end."""
    rank = len(polynomial) - 1
    while rank and not polynomial[len(polynomial) - 1 - rank]:
        rank -= 1
    bits = max(0, ROOT_BITS - trace.bit_length())
    found: list[tuple[int, int]] = []
    open_spans = [(0, (trace + 1) << bits, rank, 0)]
    while open_spans:
        low, high, above_low, above_high = open_spans.pop()
        times = above_low - above_high
        if not times or above_high >= most:
            continue
        if times == 1:
            found.append((_single(polynomial, low, high, bits), 1))
        elif high - low == 1:
            found.append((low, times))
        else:
            middle = (low + high) // 2
            above = roots_beyond(polynomial, middle, bits)
            open_spans.append((low, middle, above_low, above))
            open_spans.append((middle, high, above, above_high))
    return found, bits


def _single(polynomial: list[int], low: int, high: int, bits: int) -> int:
    """The unit (low, low + 1] of the one root in (low, high]."""
    beyond = _positive(polynomial, high, bits)
    if not beyond:
        return high - 1
    while high - low > 1:
        middle = (low + high) // 2
        sign = _positive(polynomial, middle, bits)
        if not sign:
            return middle - 1
        if sign == beyond:
            high = middle
        else:
            low = middle
    return low


def root_value(place: int, bits: int) -> Fraction:
    return Fraction(2 * place + 1, 2 << bits)


def null_vectors(matrix: np.ndarray, place: int, bits: int, times: int) -> np.ndarray:
    """Orthonormal vectors, one a row, of the root's null space."""
    n = len(matrix)
    work = bits + GUARD_BITS
    one = 1 << work
    a = np.array([[int(v) << work for v in row] for row in matrix], object)
    a[np.diag_indices(n)] -= (2 * place + 1) << (work - bits - 1)
    order = list(range(n))
    for k in range(n):
        pivot = k + max(range(n - k), key=lambda i: abs(a[k + i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if not a[k, k]:
            a[k, k] = 1
        if k + 1 < n:
            factor = (a[k + 1:, k] << work) // a[k, k]
            a[k + 1:, k + 1:] -= (factor[:, None] * a[k, k + 1:]) >> work
            a[k + 1:, k] = factor

    def solved(right: np.ndarray) -> np.ndarray:
        x = right[order].copy()
        for k in range(n):
            x[k + 1:] -= (a[k + 1:, k] * x[k]) >> work
        for k in range(n - 1, -1, -1):
            x[k] = (x[k] << work) // a[k, k]
            x[:k] -= (a[:k, k] * x[k]) >> work
        return x

    def unit(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        for _ in range(2):
            length = isqrt(int((x * x).sum())) or 1
            x = np.array([(int(v) << work) // length for v in x], object)
            for o in others:
                x = x - ((int((x * o).sum()) >> work) * o >> work)
        length = isqrt(int((x * x).sum())) or 1
        return np.array([(int(v) << work) // length for v in x], object)

    # Starts with a part along every direction, the same wherever they are made.
    vectors = [
        np.array([(one // 3) + (one * ((7919 * (i + 1) * (t + 1) ** 2) % 10007)) // 10007 for i in range(n)], object)
        for t in range(times)
    ]
    for _ in range(ROUNDS):
        done: list[np.ndarray] = []
        for vector in vectors:
            done.append(unit(solved(vector), done))
        vectors = done
    return np.array([[float(Fraction(int(v), one)) for v in x] for x in vectors])
