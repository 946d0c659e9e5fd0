"""Exact integer matrix products by Strassen's recursion on zero-padded matrices."""

from __future__ import annotations

import numpy as np

#: Sides up to this long are not halved any further.
LEAF = 32
#: Whole numbers up to here are exact as doubles.
EXACT_DOUBLE = 1 << 53
#: Products that may leave this range are refused.
EXACT_LONG = 1 << 63


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`a @ b` of int64 matrices, exactly.

    Sums of the recursion may wrap around in 64 bits; that is arithmetic modulo 2**64, so an
    entry that fits in 64 bits comes out right all the same. Entries that do not fit raise
    an OverflowError.
    """
    (rows, inner), columns = a.shape, b.shape[1]
    if not rows or not columns or not inner:
        return np.zeros((rows, columns), np.int64)
    if inner * _largest(a) * _largest(b) >= EXACT_LONG:
        estimate = np.abs(a.astype(np.float64) @ b.astype(np.float64))
        if not estimate.max() < EXACT_LONG * (1 - 1e-9):
            raise OverflowError("an inner product does not fit in 64 bits")
    levels = 0
    while min(rows, inner, columns) > LEAF << levels:
        levels += 1
    return _strassen(_padded(a, levels), _padded(b, levels), levels)[:rows, :columns]


def _largest(matrix: np.ndarray) -> int:
    return max(int(matrix.max()), -int(matrix.min()))


def _padded(matrix: np.ndarray, levels: int) -> np.ndarray:
    """With zeros, so that both sides can be halved so many times."""
    missing = [(0, -side % (1 << levels)) for side in matrix.shape]
    return np.pad(matrix, missing) if any(end for _, end in missing) else matrix


def _strassen(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return _leaf(a, b)
    n, k, m = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:n, :k], a[:n, k:], a[n:, :k], a[n:, k:]
    b11, b12, b21, b22 = b[:k, :m], b[:k, m:], b[k:, :m], b[k:, m:]
    levels -= 1
    p1 = _strassen(a11 + a22, b11 + b22, levels)
    p2 = _strassen(a21 + a22, b11, levels)
    p3 = _strassen(a11, b12 - b22, levels)
    p4 = _strassen(a22, b21 - b11, levels)
    p5 = _strassen(a11 + a12, b22, levels)
    p6 = _strassen(a21 - a11, b11 + b12, levels)
    p7 = _strassen(a12 - a22, b21 + b22, levels)
    out = np.empty((2 * n, 2 * m), np.int64)
    out[:n, :m] = p1 + p4 - p5 + p7
    out[:n, m:] = p3 + p5
    out[n:, :m] = p2 + p4
    out[n:, m:] = p1 - p2 + p3 + p6
    return out


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In doubles, which are much faster, where every partial sum is exact in them."""
    if a.shape[1] * _largest(a) * _largest(b) < EXACT_DOUBLE:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b
