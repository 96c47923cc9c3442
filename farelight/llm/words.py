"""Words and word shingles of Arrow batches as 64-bit hashes, computed on whole arrays of bytes.

A batch of texts is one byte array. Word boundaries come from a table of 256 byte classes, word
hashes from differences of one cumulative polynomial, shingle hashes from sums over neighbouring
words. Nothing is done per word in Python, and a text of any length is only a longer slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes per slice of a batch that is worked on at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: ``[^\x20\x09-\x0D]+``
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z: digits, letters, all beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2**64, from 0 to n."""
    if "up" not in _POWERS or len(_POWERS["up"]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
        for name, base in (("up", _STEP), ("down", inverse)):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            _POWERS[name] = np.cumprod(factors)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an array of texts into slices of about ``SLICE_BYTES``.

    Yields the first and last row, the bytes of their texts and the offsets of the rows in them.
    A null counts as an empty text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, at + 1), len(texts))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_spans(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of all words, and the index of the first word of every text (one more at the end)."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = letters[data]
    before = inside[:-1].copy()
    # A word ends where a text ends.
    cuts = offsets[1:-1]
    before[cuts] = False
    starts = np.flatnonzero(inside[1:] & ~before)
    after = inside[1:].copy()
    after[cuts[cuts > 0]] = False
    ends = np.flatnonzero(inside[:-1] & ~after)
    first = np.searchsorted(starts, offsets)
    return starts, ends, first


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, text by text, and the index of the first one of every text.

    A text with fewer words has one run of all its words; one without words has none.
    """
    counts = np.diff(first)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(runs)])
    if not len(words):
        return np.zeros(0, np.uint64), begin
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    total = np.zeros(len(words), dtype=np.uint64)
    factor = np.uint64(1)
    for k in range(width):
        total += padded[k : k + len(words)] * factor
        factor = factor * np.uint64(0xD1342543DE82EF95)
    total = mix(total)
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], runs)
    out = total[at]
    # Runs shorter than the width must not reach into the next text.
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        short = np.uint64(0)
        factor = np.uint64(1)
        for w in words[first[i] : first[i + 1]]:
            short = short + w * factor
            factor = factor * np.uint64(0xD1342543DE82EF95)
        out[begin[i]] = mix(np.array([short + np.uint64(counts[i])], dtype=np.uint64))[0]
    return out, begin


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def shingle_sets(texts: pa.Array, width: int, letters: np.ndarray = SPACED) -> Iterator[tuple[int, np.ndarray]]:
    """For each row its index and the sorted distinct hashes of its shingles."""
    with np.errstate(over="ignore"):
        for row, end, data, offsets in text_slices(texts):
            data = lower(data)
            starts, ends, first = word_spans(data, offsets, letters)
            hashes, begin = shingle_hashes(word_hashes(data, starts, ends), first, width)
            for i in range(end - row):
                yield row + i, np.unique(hashes[begin[i] : begin[i + 1]])

