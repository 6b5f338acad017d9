"""Hashed word shingles of many texts at once, with numpy."""

from __future__ import annotations

import re

import numpy as np

from .common import LOWER_BYTES, utf8

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
STEP = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_tables: dict[int, np.ndarray] = {}
#: Bytes hashed at a time: arrays of 8 bytes a byte are as long as this, or the longest word, and not as the texts.
BLOCK = 250_000
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _powers_of(base: np.uint64, n: int) -> np.ndarray:
    table = _tables.get(int(base))
    if table is None or len(table) < n:
        table = np.empty(1 << int(n).bit_length(), np.uint64)
        table[0] = 1
        k = 1
        while k < len(table):
            table[k : 2 * k] = table[:k] * np.uint64(pow(int(base), k, 1 << 64))
            k *= 2
        _tables[int(base)] = table
    return table[:n]


def powers(n: int) -> np.ndarray:
    """BASE ** 0 .. BASE ** (n - 1) modulo 2 ** 64."""
    return _powers_of(BASE, n)


def inverse_powers(n: int) -> np.ndarray:
    return _powers_of(_INVERSE, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all."""
    x = x ^ (x >> np.uint64(32))
    x = x * STEP
    x ^= x >> np.uint64(29)
    x *= BASE
    x ^= x >> np.uint64(32)
    return x


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of bytes between ASCII white space. Blocks end at white space, so no word is cut."""
    parts, at = [], 0
    while at < len(data) or not parts:
        space = _SPACE.search(data, at + BLOCK)
        end = space.start() if space else len(data)
        hashes, start = _block_hashes(data[at:end])
        parts.append((hashes, start + at))
        at = end
    return np.concatenate([h for h, _ in parts]), np.concatenate([s for _, s in parts])


def _block_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    b = np.frombuffer(data, np.uint8)
    inside = (b != 32) & ((b < 9) | (b > 13))
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers(max(1, len(b))), out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse_powers(max(1, len(b)))[start] + (end - start).astype(np.uint64)), start


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: `width` words, or all of a shorter text."""
    parts = [utf8(t).translate(LOWER_BYTES) for t in texts]
    lengths = np.array([len(p) + 1 for p in parts], np.int64)
    ends = np.cumsum(lengths)
    words, start = word_hashes(b" ".join(parts) + b" ")
    first = np.searchsorted(start, ends - lengths)
    last = np.searchsorted(start, ends)
    out = []
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    whole = padded[: len(words)].copy()
    for k in range(1, width):
        whole = whole * STEP + padded[k : k + len(words)]
    whole = mix(whole)
    for a, z in zip(first.tolist(), last.tolist(), strict=True):
        if z - a >= width:
            out.append(np.unique(whole[a : z - width + 1]))
        elif z > a:
            h = np.uint64(z - a)
            with np.errstate(over="ignore"):
                for w in words[a:z]:
                    h = h * STEP + w
            out.append(mix(np.array([h], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
