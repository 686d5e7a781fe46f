"""Batches of texts as flat code-point arrays, and hashes of their character windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_B = 0x9E3779B97F4A7C15


def text_slices(texts: list[str | None], rows: int = 2_000, chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of a batch that hold at most ``rows`` texts and ``chars`` characters, or a single longer text."""
    start = size = 0
    for k, t in enumerate(texts):
        n = len(t or "")
        if k > start and (k - start >= rows or size + n > chars):
            yield start, k
            start, size = k, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the batch one after another, and the n + 1 offsets of its texts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return flat, np.concatenate([[0], np.cumsum(lengths)])


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


def window_hashes(flat: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` code points inside a text, and the index of their text."""
    counts = np.maximum(np.diff(offsets) - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    total = len(flat) - width + 1
    if total <= 0 or not len(owner):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rolled = np.zeros(total, np.uint64)
    wide = flat.astype(np.uint64) + np.uint64(1)
    for k in range(width):
        rolled += wide[k : k + total] * np.uint64(pow(_B, k, 1 << 64))
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    start = np.repeat(offsets[:-1] - first, counts) + np.arange(len(owner))
    return mix(rolled[start]), owner


def distinct_counts(hashes: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the number of distinct hashes, and how often its most frequent one occurs."""
    if not len(hashes):
        return np.zeros(texts, np.int64), np.zeros(texts, np.int64)
    bits = np.uint64(max(1, int(texts - 1).bit_length()))
    # the owner in front, the rest of the hash behind it: one plain sort, 64 - bits bits of hash left
    key = np.sort((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (hashes >> bits))
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    of = (key[start] >> (np.uint64(64) - bits)).astype(np.int64)
    runs = np.diff(np.append(start, len(key)))
    most = np.zeros(texts, np.int64)
    np.maximum.at(most, of, runs)
    return np.bincount(of, minlength=texts), most
