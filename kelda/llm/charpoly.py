"""Eigenvalues and eigenvectors of an integer matrix by its exact characteristic polynomial.

The matrix is symmetric and positive semidefinite, such as a scatter matrix. Its polynomial is
found modulo many primes below 2**31, for all of them at once: a reduction to Hessenberg form,
whose polynomial follows by a recurrence. Chinese remainders put the coefficients together.

All roots are real, so by Descartes' rule the sign changes of the polynomial shifted by ``a`` are
just the number of roots above ``a``, each as often as it occurs. Bisection with that count
isolates the largest roots, and goes on until they are known to ``FRACTION`` bits behind the
point; roots that still share an interval count as one root of that multiplicity.

The vectors of a root span the null space of the matrix less the root: elimination with complete
pivoting leaves as many tiny pivots as the root has vectors, inverse iteration from there gives
them, in decimals of ``DIGITS`` digits. The work grows with the fourth power of the dimension.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np

#: Bits behind the point of a root, and digits the vectors are worked out in.
FRACTION, DIGITS = 128, 90


def primes() -> Iterator[int]:
    """Primes below 2**31, the largest first."""
    small = [p for p in range(3, 46341, 2) if all(p % q for q in range(3, math.isqrt(p) + 1, 2))]
    divisors = np.array(small)
    for p in range((1 << 31) - 1, 1 << 30, -2):
        if (p % divisors).all():
            yield p


def _inverse(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """x**(p - 2) modulo p; 0 for 0."""
    found, power, rest = np.ones_like(x), x % p, p - 2
    while rest.any():
        found = np.where(rest & 1, found * power % p, found)
        power = power * power % p
        rest = rest >> 1
    return np.where(x % p == 0, 0, found)


def hessenberg(matrix: np.ndarray, p: np.ndarray) -> np.ndarray:
    """For each prime a matrix with zeros below the first subdiagonal that is similar to it."""
    d = matrix.shape[-1]
    h, all_of = matrix.copy(), np.arange(len(p))
    by_row, by_cell = p[:, None], p[:, None, None]
    for k in range(d - 2):
        pivot = k + 1 + (h[:, k + 1 :, k] != 0).argmax(axis=1)
        for swap in (h, h.transpose(0, 2, 1)):
            held = swap[all_of, pivot].copy()
            swap[all_of, pivot] = swap[:, k + 1]
            swap[:, k + 1] = held
        factor = h[:, k + 2 :, k] * _inverse(h[:, k + 1, k], p)[:, None] % by_row
        h[:, k + 2 :] = (h[:, k + 2 :] - factor[:, :, None] * h[:, None, k + 1]) % by_cell
        h[:, :, k + 1] = (h[:, :, k + 1] + (h[:, :, k + 2 :] * factor[:, None] % by_cell).sum(axis=2)) % by_row
    return h


def _polynomials(h: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients of the characteristic polynomials of Hessenberg matrices, lowest first."""
    count, d = h.shape[0], h.shape[-1]
    found = np.zeros((d + 1, count, d + 1), np.int64)
    found[0, :, 0] = 1
    column = p[:, None]
    for k in range(1, d + 1):
        now = np.zeros((count, d + 1), np.int64)
        now[:, 1:] = found[k - 1, :, :-1]
        product = np.ones(count, np.int64)
        for i in range(k - 1, -1, -1):
            now = (now - (h[:, i, k - 1] * product % p)[:, None] * found[i]) % column
            if i:
                product = product * h[:, i, i - 1] % p
        found[k] = now
    return found[d]


def characteristic(matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x - matrix), lowest first."""
    d = len(matrix)
    cells = np.array(matrix, dtype=object).reshape(d, d)
    # The roots are not negative, so no coefficient passes the value of (1 + x)**d at their mean.
    limit = 2 * (2 + int(sum(cells[i, i] for i in range(d))) // max(d, 1)) ** d + 1
    chosen, product = [], 1
    source = primes()
    while product < limit:
        chosen.append(next(source))
        product *= chosen[-1]
    p = np.array(chosen, np.int64)
    residues = np.stack([(cells % q).astype(np.int64) for q in chosen])
    remainders = _polynomials(hessenberg(residues, p), p)
    found = []
    for c in range(d + 1):
        x, step = 0, 1
        for q, r in zip(chosen, remainders[:, c].tolist()):
            x += (r - x) * pow(step, -1, q) % q * step
            step *= q
        found.append(x - step if 2 * x > step else x)
    return found


def roots_above(coefficients: list[int], at: int, fraction: int) -> int:
    """The number of roots above at / 2**fraction, for a polynomial with real roots only."""
    d = len(coefficients) - 1
    shifted = [c << fraction * (d - k) for k, c in enumerate(coefficients)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            shifted[k] += at * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(coefficients: list[int], at: int, fraction: int) -> int:
    """The polynomial's value at at / 2**fraction, times a power of two."""
    value, d = 0, len(coefficients) - 1
    for k in range(d, -1, -1):
        value = value * at + (coefficients[k] << fraction * (d - k))
    return value


def largest_roots(coefficients: list[int], count: int, fraction: int = FRACTION) -> list[tuple[int, int]]:
    """The positive roots among the ``count`` largest, in falling order: (root * 2**fraction rounded
    up, multiplicity). Of a root more often than still wanted all are counted."""
    d = len(coefficients) - 1
    total = roots_above(coefficients, 0, 0)
    if not total:
        return []
    # No root is above the sum of all.
    top = -coefficients[d - 1] << fraction
    found: list[tuple[int, int]] = []
    open_: list[tuple[int, int, int, int]] = [(0, top, total, 0)]
    while open_ and sum(m for _, m in found) < count:
        low, high, above_low, above_high = open_.pop()
        if above_low == above_high:
            continue
        if above_low - above_high == 1:
            # A simple root: the sign right of it is that of the roots above it.
            positive = above_high % 2 == 0
            while high - low > 1:
                middle = (low + high) // 2
                value = _value(coefficients, middle, fraction)
                if value == 0 or (value > 0) == positive:
                    high = middle
                else:
                    low = middle
            found.append((high, 1))
        elif high - low == 1:
            found.append((high, above_low - above_high))
        else:
            # Coarse borders first: their numbers are short.
            middle = (low + high) // 2
            spare = max(0, (high - low).bit_length() - 4)
            middle = middle >> spare << spare
            middle = middle if low < middle < high else (low + high) // 2
            zeros = min(fraction, (middle & -middle).bit_length() - 1)
            above = roots_above(coefficients, middle >> zeros, fraction - zeros)
            open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found


def null_vectors(matrix: list[list[int]], root: Decimal, count: int) -> list[list[Decimal]]:
    """``count`` orthonormal vectors that the matrix only stretches by ``root``."""
    d = len(matrix)
    a = np.array([[Decimal(x) for x in row] for row in matrix], dtype=object).reshape(d, d)
    scale = max(abs(x) for x in a.ravel()) or Decimal(1)
    for i in range(d):
        a[i, i] -= root
    rows, columns = np.arange(d), np.arange(d)
    tiny = scale * Decimal(10) ** (20 - DIGITS)
    for k in range(d):
        sizes = np.abs(a[k:, k:])
        i, j = np.unravel_index(int(sizes.argmax()), sizes.shape)
        for own, at in ((rows, k + i), (columns, k + j)):
            own[[k, at]] = own[[at, k]]
        a[[k, k + i]] = a[[k + i, k]]
        a[:, [k, k + j]] = a[:, [k + j, k]]
        if k >= d - count or abs(a[k, k]) < tiny:
            # What is left is null but for rounding.
            a[k:, k:] = np.where(np.eye(d - k, dtype=bool), tiny, Decimal(0))
            break
        a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :])

    def solve(right: np.ndarray, lower: bool) -> np.ndarray:
        x = right[rows].copy() if lower else right.copy()
        if lower:
            for k in range(d):
                x[k + 1 :] -= a[k + 1 :, k] * x[k]
        for k in range(d - 1, -1, -1):
            x[k] = x[k] / a[k, k]
            x[:k] -= a[:k, k] * x[k]
        found = np.empty(d, dtype=object)
        found[columns] = x
        return found

    def apart(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
        x = x / max(abs(v) for v in x)
        for y in others:
            x = x - y * (x * y).sum()
        return x / (x * x).sum().sqrt()

    found: list[np.ndarray] = []
    for k in range(count):
        unit = np.array([Decimal(int(i == d - count + k)) for i in range(d)], dtype=object)
        first = apart(solve(unit, lower=False), found)
        found.append(apart(solve(first, lower=True), found))
    return [x.tolist() for x in found]


@dataclass(frozen=True)
class Component:
    """A root and its unit vector; the sign makes the largest entry positive."""

    root: Decimal
    vector: list[Decimal]


def components(matrix: list[list[int]], count: int) -> list[Component]:
    """The ``count`` largest positive roots with their vectors, in falling order."""
    found: list[Component] = []
    for at, many in largest_roots(characteristic(matrix), count):
        with localcontext() as context:
            context.prec = DIGITS
            root = Decimal(at) / Decimal(1 << FRACTION)
            for vector in null_vectors(matrix, root, many):
                largest = max(vector, key=abs)
                found.append(Component(root, [x if largest > 0 else -x for x in vector]))
    return found[:count]
