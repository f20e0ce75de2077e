"""Pairs of doubles (high, low) whose sum is the value: sums and matrix products by error-free transformations."""

from __future__ import annotations

from fractions import Fraction

import numpy as np

#: A number with about 106 bits: the high part is the value rounded to a double.
Pair = tuple[np.ndarray, np.ndarray]
#: Bits of a slice, slices of a factor, and inner entries of a product that are summed at once: a product of two slices is
#: a whole number of at most 2 * BITS bits, and BLOCK of them add up to less than 2**53, so BLAS sums them without error.
BITS, SLICES, BLOCK = 20, 5, 4096


def two_sum(a: np.ndarray, b: np.ndarray) -> Pair:
    """a + b as the rounded sum and its error."""
    s = a + b
    v = s - a
    return s, (a - (s - v)) + (b - v)


def add(x: Pair, y: Pair) -> Pair:
    s, e = two_sum(x[0], y[0])
    t, f = two_sum(x[1], y[1])
    s, e = two_sum(s, e + t)
    return two_sum(s, e + f)


def ratio(a: int, b: int) -> tuple[float, float]:
    """a / b."""
    exact = Fraction(a, b)
    high = float(exact)
    return high, float(exact - Fraction(high))


def whole(x: np.ndarray) -> Pair:
    """Whole numbers of 64 bits, of less than 2**62."""
    high = x.astype(np.float64)
    return high, (x - high.astype(np.int64)).astype(np.float64)


def _slices(x: Pair, axis: int) -> tuple[list[np.ndarray], np.ndarray]:
    """x as whole numbers of BITS bits, largest first, and for each row or column the exponent of its largest entry: slice t is
    to be multiplied by 2**(exponent - (t + 1) * BITS)."""
    most = np.abs(x[0]).max(axis=axis, keepdims=True)
    exponent = np.where(most > 0, np.frexp(most)[1] + 1, 0)
    rest, out = x, []
    for t in range(SLICES):
        shift = exponent - (t + 1) * BITS
        head = np.rint(np.ldexp(rest[0], -shift))
        out.append(head)
        rest = two_sum(rest[0] - np.ldexp(head, shift), rest[1])
    return out, exponent


def product(a: Pair, b: Pair) -> Pair:
    """The matrix product a @ b, to some 100 bits of its largest entries.

    Both factors are cut to slices of few bits, so that the products of slices are sums of whole numbers that BLAS finds
    without rounding; these are scaled by powers of two and added, smallest first, as pairs."""
    rows, columns = a[0].shape[0], b[0].shape[1]
    total = np.zeros((rows, columns)), np.zeros((rows, columns))
    for at in range(0, a[0].shape[1], BLOCK):
        part = slice(at, at + BLOCK)
        left, up = _slices((a[0][:, part], a[1][:, part]), 1)
        right, down = _slices((b[0][part], b[1][part]), 0)
        for order in reversed(range(SLICES)):
            for t in range(order + 1):
                if left[t].any() and right[order - t].any():
                    exact = left[t] @ right[order - t]
                    total = add(total, (np.ldexp(exact, up + down - (order + 2) * BITS), np.zeros_like(exact)))
    return total
