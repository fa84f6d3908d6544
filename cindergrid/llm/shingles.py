"""Distinct word shingles of many texts at once, hashed to 64 bits with numpy."""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
_LOWER = bytes((b + 32 if 65 <= b <= 90 else b) for b in range(256))
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_SHORT = _rng.integers(1, 1 << 63, WORDS, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_known: dict[str, np.ndarray] = {}


def powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, remembered."""
    known = _known.get(name)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _known[name] = np.multiply.accumulate(steps)
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(raws: list[bytes | None], size: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of ``size`` (at most 5) words; fewer words make one, none make none."""
    joined = b" ".join(r or b"" for r in raws).translate(_LOWER)
    data = np.frombuffer(joined + b" ", np.uint8)
    gap = _GAP[data]
    before = np.concatenate([[True], gap[:-1]])
    starts, ends = np.flatnonzero(before & ~gap), np.flatnonzero(gap & ~before)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers("up", _BASE, len(data)), out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * powers("down", _INVERSE, len(data))[starts]) if len(starts) else np.zeros(0, np.uint64)
    edges = np.cumsum([0, *[len(r or b"") + 1 for r in raws]])
    first = np.searchsorted(starts, edges)
    n = len(words) - size + 1
    runs = mixed(sum((words[k : k + n] * _PLACE[k] for k in range(size)), np.zeros(n, np.uint64))) if n > 0 else words[:0]
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            whole = (words[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64, keepdims=True) + _SHORT[b - a : b - a + 1]
            out.append(mixed(whole))
        else:
            out.append(words[:0])
    return out


def set_id(hashes: np.ndarray) -> int:
    """A 64-bit name of a whole set."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)
