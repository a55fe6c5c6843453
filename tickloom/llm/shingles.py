"""Words and word shingles of whole texts as 64-bit hashes, for the Arrow batches of a task.

A word is a run of bytes other than space and the controls 0x09-0x0D; A-Z count as a-z. UTF-8
never uses these bytes inside a character, so bytes and characters split alike. A word's hash
is a polynomial over random byte values, computed for a whole block of texts at once; that of
a shingle mixes the hashes of its words in order. Equal shingles have equal hashes. Different
ones share a hash with a chance of 2**-64 per pair, which all users of this module accept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are hashed in blocks of about so many bytes, which bounds a task's working memory.
BLOCK_BYTES = 1 << 19

_RANDOM = np.random.default_rng(20240131)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
SEPARATORS = np.array([32, 9, 10, 11, 12, 13])
_BYTES[SEPARATORS] = 0
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[SEPARATORS] = False
_PLACES = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, count: int) -> np.ndarray:
    if len(_powers[kind]) < count:
        steps = np.full(count, _BASE if kind == "up" else _BASE_INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind][:count]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a one-to-one function)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each text starts and ends; a null is empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    buffers = texts.buffers()
    if len(texts) == 0 or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], kind, len(texts) + 1, texts.offset * kind().itemsize).astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text each, never less than one row."""
    _, offsets = raw_bytes(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def word_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words in order: hashes, where each starts and ends in the bytes; text bounds among them; the bytes."""
    data, offsets = raw_bytes(texts)
    none = np.zeros(0, np.int64)
    inside = _IS_WORD[data]
    if not inside.any():
        return np.zeros(0, np.uint64), none, none, np.zeros(len(texts) + 1, np.int64), data
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begins[firsts] = inside[firsts]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:] | begins[1:]
    at = np.flatnonzero(begins)
    sums = np.add.reduceat(_BYTES[data] * _power("up", len(data)), at)
    hashes = mix(sums * _power("down", len(data))[at])
    return hashes, at, np.flatnonzero(finishes) + 1, np.searchsorted(at, offsets), data


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text where its words start (one end more)."""
    hashes, _, _, bounds, _ = word_spans(texts)
    return hashes, bounds


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``size`` words in order, and where each text's start.

    A text with fewer words has one shingle of all of them; a text without words has none.
    """
    hashes, starts = words(texts)
    counts = np.diff(starts)
    full = np.maximum(counts - size + 1, 0)
    made = np.where(counts == 0, 0, np.maximum(full, 1))
    bounds = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(bounds[-1], np.uint64)
    if len(hashes) >= size:
        span = len(hashes) - size + 1
        rolled = np.zeros(span, np.uint64)
        for place in range(size):
            rolled += hashes[place : place + span] * _PLACES[place]
        # Shingles that reach over the end of their text are left out.
        keep = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(keep, starts[:-1][full > 0], 1)
        np.add.at(keep, (starts[:-1] + full)[full > 0], -1)
        kept = rolled[np.cumsum(keep)[:span] > 0]
        out[np.repeat(full > 0, made)] = kept
    for count in range(1, size):
        short = counts == count
        if short.any():
            total = np.full(int(short.sum()), _PLACES[-count], np.uint64)
            for place in range(count):
                total += hashes[starts[:-1][short] + place] * _PLACES[place]
            out[bounds[:-1][short]] = total
    return mix(out), bounds


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The set of each text's shingles as a sorted array, text by text."""
    for start, stop in slices(texts):
        hashes, bounds = shingles(texts.slice(start, stop - start), size)
        for i in range(stop - start):
            found = np.sort(hashes[bounds[i] : bounds[i + 1]])
            if len(found) > 1:
                found = found[np.concatenate([[True], found[1:] != found[:-1]])]
            yield found
