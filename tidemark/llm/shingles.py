"""Hashes of words and of word shingles, worked out for many texts at a time in arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C55
SEGMENT = 1 << 18
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype="u1")
LOWER[65:91] += 32


def scrambled(x: np.ndarray) -> np.ndarray:
    """Spreads each number over all 64 bits; different numbers stay different."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, "u8"), np.full(n, pow(BASE, -1, 1 << 64), "u8")
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_hashes(data: np.ndarray, lower: bool = True) -> np.ndarray:
    """The hashes of the words of one text (or of several, parted by spaces), in order."""
    found, at = [], 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        if end < len(data):  # cut where a word ends
            space = np.flatnonzero(SPACES[data[at:end]])
            while not len(space) and end < len(data):
                end = min(end + SEGMENT, len(data))
                space = np.flatnonzero(SPACES[data[at:end]])
            if end < len(data):
                end = at + int(space[-1]) + 1
        part = data[at:end]
        at = end
        blank = np.concatenate([[True], SPACES[part], [True]])
        starts, stops = np.flatnonzero(blank[:-1] & ~blank[1:]), np.flatnonzero(~blank[:-1] & blank[1:])
        if not len(starts):
            continue
        size = max(SEGMENT, 1 << (len(part) - 1).bit_length())
        up, down = _powers(size)
        sums = np.zeros(len(part) + 1, "u8")
        np.cumsum(((LOWER[part] if lower else part).astype("u8") + np.uint64(1)) * up[: len(part)], out=sums[1:])
        found.append(scrambled((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype("u8") * np.uint64(0xD6E8FEB86659FD93)))
    return np.concatenate(found) if found else np.zeros(0, "u8")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts side by side, and where each one begins (with the end); null is empty."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", "u1")[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def run_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and where each text's begin (with the end)."""
    data, offsets = text_bytes(texts)
    n = len(texts)
    if n == 1:
        words = word_hashes(data, lower)
        return words, np.array([0, len(words)])
    # a line break behind each text keeps words apart
    wide = np.full(len(data) + n, 10, "u1")
    owner = np.repeat(np.arange(n), np.diff(offsets))
    wide[np.arange(len(data)) + owner] = data
    blank = SPACES[wide]
    ends = ~blank & np.concatenate([blank[1:], [True]])
    line = np.cumsum(np.diff(offsets) + 1) if n else np.zeros(0, "i8")
    total = np.concatenate([[0], np.cumsum(ends)])
    return word_hashes(wide, lower), np.concatenate([[0], total[line]]).astype("i8")


def shingles(words: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, and where each text's begin (with the end).

    A text of fewer words has them all as one shingle, a text without words none.
    """
    counts = np.diff(starts)
    factors = np.array([pow(BASE, 3 * j + 1, 1 << 64) for j in range(width)], "u8")
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begins = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(int(begins[-1]), "u8")
    if len(words) >= width:
        sums = np.zeros(len(words) - width + 1, "u8")
        for j in range(width):
            sums += words[j : len(words) - width + 1 + j] * factors[j]
        owner = np.repeat(np.arange(len(counts)), n)
        place = np.arange(len(out)) - begins[owner] + starts[owner]
        long = counts[owner] >= width
        out[long] = sums[place[long]]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        own = words[starts[i] : starts[i + 1]]
        out[begins[i]] = (own * factors[: len(own)]).sum(dtype="u8") + np.uint64(len(own))
    return scrambled(out), begins
