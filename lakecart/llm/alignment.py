"""Longest common subsequence of two sequences of line hashes, bit-parallel, in bounded memory."""

from __future__ import annotations

import numpy as np

#: Bits of the table that one trace may hold; longer pairs are halved first.
BITS = 1 << 27


def _masks(b: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for j, y in enumerate(b.tolist()):
        masks[y] = masks.get(y, 0) | 1 << j
    return masks


def _step(v: int, m: int, full: int) -> int:
    u = v & m
    return ((v + u) | (v - u)) & full


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common subsequence of ``a`` and every beginning of ``b``."""
    full = (1 << len(b)) - 1
    v, masks = full, _masks(b)
    for x in a.tolist():
        v = _step(v, masks.get(x, 0), full)
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _trace(a: np.ndarray, b: np.ndarray, flags: np.ndarray) -> None:
    full = (1 << len(b)) - 1
    v, masks, rows = full, _masks(b), []
    for x in a.tolist():
        v = _step(v, masks.get(x, 0), full)
        rows.append(v)
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                flags[i] = True
                j -= 1


def _align(a: np.ndarray, b: np.ndarray, flags: np.ndarray) -> None:
    same = a[:min(len(a), len(b))] == b[:min(len(a), len(b))]
    head = len(same) if same.all() else int(np.argmin(same))
    flags[:head] = True
    a, b, flags = a[head:], b[head:], flags[head:]
    same = (a[::-1][:min(len(a), len(b))] == b[::-1][:min(len(a), len(b))])
    tail = len(same) if same.all() else int(np.argmin(same))
    if tail:
        flags[-tail:] = True
        a, b, flags = a[:-tail], b[:-tail], flags[:-tail]
    if not len(a) or not len(b):
        return
    if len(a) * len(b) <= BITS or len(a) == 1:
        _trace(a, b, flags)
        return
    half = len(a) // 2
    cut = int(np.argmax(_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]))
    _align(a[:half], b[:cut], flags[:half])
    _align(a[half:], b[cut:], flags[half:])


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which elements of ``a`` stand on a longest common subsequence with ``b``."""
    flags = np.zeros(len(a), bool)
    in_both = np.isin(a, b)  # no other can be aligned
    part = np.zeros(int(in_both.sum()), bool)
    _align(a[in_both], b[np.isin(b, a)], part)
    flags[in_both] = part
    return flags
