"""Hashes of the words of a text, and of their shapes, by array arithmetic over its bytes.

A word is a run of bytes other than space and \\x09-\\x0D. Its hash is a sum, modulo 2**64, of a number for each byte
times an odd number for its place, mixed at the end; both number rows come from a mixing rule. Two different words
share a hash with a chance of about 2**-63.
"""

from __future__ import annotations

import numpy as np

SEGMENT_BYTES = 1 << 22
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(seed: int, n: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * _GOLDEN)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = _numbers(1, 256)
_PLACE = _numbers(2, 4096) | np.uint64(1)
# Shape classes: upper case, lower case (and all of UTF-8 beyond ASCII), digits; any other byte is its own class.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = ord("X")
_CLASS[ord("a") : ord("z") + 1] = ord("x")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[0x80:] = ord("x")


def _place(n: np.ndarray) -> np.ndarray:
    """The odd number of each place in a word."""
    if len(n) == 0 or n.max() < len(_PLACE):
        return _PLACE[n]
    return mix((n.astype(np.uint64) + np.uint64(1 + (2 << 32))) * _GOLDEN) | np.uint64(1)


def _sums(value: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each run of ``value``; runs lie back to back."""
    place = np.arange(len(value)) - np.repeat(starts, sizes)
    return mix(np.add.reduceat(value * _place(place), starts) + sizes.astype(np.uint64))


def run_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of the runs of bytes that begin at ``starts`` (ascending, apart) and have ``sizes``."""
    inside = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(int(sizes.sum()))
    return _sums(_BYTE[data[inside]], np.cumsum(sizes) - sizes, sizes)


def _segment(data: bytes, shapes: bool) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.uint8)
    inside = np.flatnonzero(~_SPACE[raw])
    none = np.empty(0, np.uint64)
    if not len(inside):
        return none, none
    new = np.empty(len(inside), bool)
    new[0] = True
    np.greater(np.diff(inside), 1, out=new[1:])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(inside)))
    lower = np.frombuffer(data.lower(), np.uint8)[inside]
    words = _sums(_BYTE[lower], starts, sizes)
    if not shapes:
        return words, none
    cls = _CLASS[raw[inside]]
    keep = new.copy()
    keep[1:] |= cls[1:] != cls[:-1]
    kept = np.flatnonzero(keep)
    begin = np.flatnonzero(new[kept])
    return words, _sums(_BYTE[cls[kept]], begin, np.diff(np.append(begin, len(kept))))


def word_hashes(text: str | None, shapes: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z folded), and of their shapes if asked for; long texts go segment by segment."""
    data = (text or "").encode()
    if len(data) <= SEGMENT_BYTES:
        return _segment(data, shapes)
    parts, at = [], 0
    while at < len(data):
        end = min(at + SEGMENT_BYTES, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        parts.append(_segment(data[at:end], shapes))
        at = end
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
