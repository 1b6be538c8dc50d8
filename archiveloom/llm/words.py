"""Words and word windows of Arrow text columns, as numpy arrays.

Texts are cut at byte level: every separator set used here is ASCII, and no byte of a longer
UTF-8 sequence is ASCII, so bytes and characters give the same words. No Python string is
made for a word. Hashes are multilinear over random 64-bit tables drawn from a fixed seed,
mixed afterwards; they are the same on every executor.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Separators as byte tables: white space, and everything but digits, letters and non-ASCII.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NON_WORD = np.zeros(256, bool)
NON_WORD[:0x30] = NON_WORD[0x3A:0x61] = NON_WORD[0x7B:0x80] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

# Bytes of text that are hashed at a time; bounds the temporary arrays.
STEP_BYTES = 256 << 10

_RANDOM = np.random.default_rng(20240229)
_BYTE_KEYS = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE_STEP = np.uint64(0x9E3779B97F4A7C15)
_WINDOW_KEYS = _RANDOM.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@dataclass
class Words:
    """Words of a block of texts: byte hash of each word, its text, and where texts begin."""

    hashes: np.ndarray  # uint64 per word
    first: np.ndarray  # int64 per text plus one: index of its first word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def texts(self) -> np.ndarray:
        """Index of the text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte position where each word starts and ends; words never cross texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~separators[data]
    cut = np.zeros(len(data) + 1, bool)  # a text begins here
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~cut[:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate((inside[1:], [False])) & ~cut[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends


def _places(n: int) -> np.ndarray:
    """Odd 64-bit key of each place in a word."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _PLACE_STEP) | np.uint64(1)


def split(column: pa.Array, separators: np.ndarray = SPACE, lower: bool = False) -> Words:
    """Words of a text column with a 64-bit hash of each word's bytes."""
    data, offsets = utf8(column)
    hashes, first = [], [np.zeros(1, np.int64)]
    done, text, n_texts = 0, 0, len(offsets) - 1
    while text < n_texts:  # whole texts, about STEP_BYTES at a time
        upto = int(np.searchsorted(offsets, offsets[text] + STEP_BYTES, "right")) - 1
        upto = min(max(upto, text + 1), n_texts)
        lo, hi = offsets[text], offsets[upto]
        part, local = data[lo:hi], offsets[text : upto + 1] - lo
        if lower:
            part = LOWER[part]
        starts, ends = spans(part, local, separators)
        if len(starts):
            lengths = ends - starts
            # every byte belongs to the last word begun; separators after it weigh nothing
            begun = np.zeros(len(part), np.int32)
            begun[starts[1:]] = 1
            place = np.arange(len(part)) - starts[np.cumsum(begun)]
            keys = _places(int(lengths.max()))
            weights = keys[np.clip(place, 0, len(keys) - 1)]
            weights *= ~separators[part]
            sums = np.add.reduceat(_BYTE_KEYS[part] * weights, starts)
            hashes.append(mix(sums + lengths.astype(np.uint64)))
        first.append(done + np.searchsorted(starts, local[1:]))
        done += len(starts)
        text = upto
    return Words(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate(first))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, across texts too; entry i begins at word i."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * _WINDOW_KEYS[0]
    for i in range(1, k):
        total += hashes[i : i + n] * _WINDOW_KEYS[i]
    return mix(total)


def windows(words: Words, k: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k consecutive words of one text, and the index of its first word.

    With ``short`` a text of fewer words, but not none, is one window of all its words.
    """
    counts = words.counts
    whole = rolling(words.hashes, k)
    valid = np.ones(len(whole), bool)
    for i in range(1, k):  # the last k - 1 words of a text begin no window in it
        ends = words.first[1:] - i
        ends = ends[(ends >= words.first[:-1]) & (ends < len(whole))]
        valid[ends] = False
    at = np.flatnonzero(valid)
    total = whole[at]
    if short:
        few = np.flatnonzero((counts > 0) & (counts < k))
        extra = np.zeros(len(few), np.uint64)
        for i in range(k - 1):
            has = counts[few] > i
            extra[has] += words.hashes[words.first[few[has]] + i] * _WINDOW_KEYS[i]
        # the length keeps a short text apart from windows of k words
        extra = mix(mix(extra) + counts[few].astype(np.uint64))
        total, at = np.concatenate((total, extra)), np.concatenate((at, words.first[few]))
        order = np.argsort(at, kind="stable")
        total, at = total[order], at[order]
    return total, at
