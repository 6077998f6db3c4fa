"""Words of many texts at once, as 64-bit hashes, by numpy over their UTF-8 bytes.

Words are runs of bytes that a class of separators leaves, A-Z lower-cased. As separators are ASCII
characters, cutting bytes and cutting characters give the same words."""

from __future__ import annotations

import numpy as np

WINDOW = 1 << 20  # bytes hashed at once, so that memory doesn't follow the length of a text
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """A table from byte to lower-cased byte plus one, 0 for the separators in ``ranges`` (inclusive)."""
    fold = np.arange(1, 257, dtype=np.uint64)
    for low, high in ranges:
        fold[low : high + 1] = 0
    fold[ord("A") : ord("Z") + 1] = fold[ord("a") : ord("z") + 1]
    return fold


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _POWERS:
        of = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            of.append(np.multiply.accumulate(steps))
        if len(_POWERS) > 4:
            _POWERS.clear()
        _POWERS[size] = (of[0], of[1])
    return _POWERS[size]


def _hash_window(data: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    c = fold[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], c > 0, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    power, inverse = _powers(len(c) + 1)
    sums = np.zeros(len(c) + 1, np.uint64)
    np.cumsum(c * power[: len(c)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * inverse[starts])


def hashes(texts: list[bytes], fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words of ``texts`` as hashes, one text after the other, and how many words each text has."""
    found, counts = [], np.zeros(len(texts), np.int64)
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) < WINDOW):
            size += len(texts[j]) + 1
            j += 1
        if j == i + 1 and len(texts[i]) > WINDOW:
            data, at = np.frombuffer(texts[i], np.uint8), 0
            is_cut = fold == 0
            while at < len(data):
                end = min(at + WINDOW, len(data))
                while end < len(data) and not is_cut[data[end]]:
                    stop = np.flatnonzero(is_cut[data[end : end + WINDOW]])
                    end = end + int(stop[0]) if len(stop) else min(end + WINDOW, len(data))
                _, own = _hash_window(data[at:end], fold)
                found.append(own)
                counts[i] += len(own)
                at = end
        else:
            # A line feed separates words in every class used here.
            data = np.frombuffer(b"\n".join(texts[i:j]), np.uint8)
            starts, own = _hash_window(data, fold)
            offsets = np.cumsum([0] + [len(t) + 1 for t in texts[i:j]])
            counts[i:j] = np.diff(np.searchsorted(starts, offsets))
            found.append(own)
        i = j
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), counts


def encoded(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow text column, null as empty."""
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column]
