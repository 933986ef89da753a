"""Words of texts as 64-bit keys, made by arrays: what counts and compares words shares this."""

from __future__ import annotations

import re

import numpy as np

from .common import mix

#: Bytes that are hashed at a time.
CHUNK = 1 << 19
SPACES = (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")
SPACE = re.compile(rb"[ \t-\r]")
_TABLE = mix(np.arange(1, (64 << 8) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def folded(text: str) -> bytes:
    """UTF-8 with A-Z in lower case."""
    return text.encode().lower()


def word_pieces(texts: list[bytes], size: int = CHUNK):
    """Lists of (text number, piece) of some size bytes, in order: texts, or parts of long ones that end where a word does; a word beyond twice the size is alone."""
    held, filled = [], 0
    for i, text in enumerate(texts):
        lo = 0
        while lo < len(text):
            found = SPACE.search(text, lo + size) if len(text) - lo > size else None
            cuts = [lo, found.end() if found else len(text)]
            if cuts[1] - lo > 2 * size:  # the word at lo + size is that long
                cuts = [lo, max(text.rfind(c, lo, lo + size) for c in SPACES) + 1 or lo, found.start() if found else len(text)]
            for a, b in zip(cuts, cuts[1:]):
                long = b - a > 2 * size
                if held and (long or filled >= size):
                    yield held
                    held, filled = [], 0
                if long:
                    yield [(i, text[a:b])]
                elif b > a:
                    held.append((i, text[a:b]))
                    filled += b - a
            lo = cuts[-1]
    if held:
        yield held


def _spread(part: np.ndarray, place: np.ndarray) -> np.ndarray:
    """64 bits for each byte and its place in its word."""
    values = _TABLE[(place & 63) << 8 | part]
    far = np.flatnonzero(place >= 64)
    if len(far):
        values[far] = mix(values[far] + (place[far] >> 6).astype(np.uint64))
    return values


def word_keys(held: list[tuple[int, bytes]], size: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """(text numbers, keys) of the words of pieces, in order. A key sums up the bytes of a word by their places."""
    if len(held) == 1 and len(held[0][1]) > 2 * size:  # one word
        part = np.frombuffer(held[0][1], np.uint8)
        sums = [_spread(part[lo : lo + size], np.arange(lo, min(lo + size, len(part)))).sum(dtype=np.uint64) for lo in range(0, len(part), size)]
        return np.array([held[0][0]]), mix(np.array([*sums, len(part)], np.uint64).sum(keepdims=True))
    stream = np.frombuffer(b" ".join([*(x[1] for x in held), b""]), np.uint8)
    inside = (stream > 32) | (stream < 9) | (stream > 13) & (stream < 32)
    first = np.flatnonzero(inside & np.append(True, ~inside[:-1])) if len(stream) else np.zeros(0, np.int64)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    lengths = np.flatnonzero(~inside & np.append(False, inside[:-1])) - first
    starts = np.cumsum(lengths) - lengths
    values = _spread(stream[inside], np.arange(lengths.sum()) - np.repeat(starts, lengths))
    ends = np.cumsum([len(x[1]) + 1 for x in held])
    return np.array([x[0] for x in held])[np.searchsorted(ends, first, side="right")], mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64))


def words_of(texts: list[bytes]):
    """(text numbers, keys) of the words of the texts, some CHUNK bytes at a time."""
    return map(word_keys, word_pieces(texts))
