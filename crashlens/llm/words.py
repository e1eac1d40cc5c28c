"""Words and word windows of whole Arrow text columns, as numpy arrays.

Texts are cut at byte level: UTF-8 bytes from 0x80 on are always word bytes,
so a table of 256 flags says which bytes separate words. A word's hash is a
polynomial over its bytes, a window's hash a polynomial over the hashes of its
words, both modulo 2^64 with a final mixing step; sums over runs of bytes or
words come from one pass over the column, without a Python loop per text.

Work is done in slices of about ``SLICE_BYTES`` of text, so memory does not
follow the size of an Arrow batch; a text is never cut, a longer one is a
slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 3 << 18
U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_ODD_BYTE, _ODD_WORD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_BYTE_VALUE = _mix(np.arange(1, 257, dtype=U64) * U64(0x2545F4914F6CDD1D))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, odd: int):
        self.odd, self.inverse = odd, pow(odd, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", self.odd), ("down", self.inverse)):
                steps = np.full(size, base, dtype=U64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_ODD_BYTE), _Powers(_ODD_WORD)


def byte_flags(*ranges: tuple[int, int]) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


# The word classes the contracts name, as the bytes between words.
WHITE_SPACE = byte_flags((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = byte_flags((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20  # A-Z only


class Words(NamedTuple):
    """The words of some texts, in order."""

    data: np.ndarray  # bytes of the texts (lower-cased if asked for)
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    first: np.ndarray  # texts + 1 positions: words of text i are first[i]:first[i + 1]
    hash: np.ndarray  # uint64 per word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than texts, from 0) of a string or binary column; null is empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, dtype=np.uint8), at - at[0]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def split_words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray, lower: bool = False) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``; ``between`` flags the bytes that are no word bytes."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(offsets), dtype=np.int64), np.zeros(0, dtype=U64))
    if lower:
        data = _LOWER[data]
    inside = ~between[data]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    before[edges] = False  # a text starts anew
    start = np.flatnonzero(inside & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    up, down = _BYTE_POWERS.upto(n)
    value = np.where(inside, _BYTE_VALUE[data], U64(0))
    value *= up
    hashes = np.add.reduceat(value, start) if len(start) else np.zeros(0, dtype=U64)
    hashes = _mix(hashes * down[start])
    return Words(data, start, end, np.searchsorted(start, offsets), hashes)


def windows(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``(first word, hash)`` of every window of ``length`` consecutive words of one text, in order."""
    n = len(words.hash)
    if n < length:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U64)
    text = words.text
    at = np.flatnonzero(text[: n - length + 1] == text[length - 1 :])
    up, down = _WORD_POWERS.upto(n)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(words.hash * up, out=sums[1:])
    return at, _mix((sums[at + length] - sums[at]) * down[at] + U64(length))


def shingle_sets(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``(text, hash)`` of the distinct word shingles of each text, sorted by text and hash.

    A text of fewer than ``length`` words has its whole word sequence as its only shingle.
    """
    at, hashes = windows(words, length)
    text = words.text[at]
    counts = words.counts
    for short in range(1, length):
        if (counts == short).any():
            more_at, more = windows(words, short)
            keep = counts[words.text[more_at]] == short
            text = np.concatenate([text, words.text[more_at[keep]]])
            hashes = np.concatenate([hashes, more[keep]])
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    if len(text):
        keep = np.ones(len(text), dtype=bool)
        keep[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
        text, hashes = text[keep], hashes[keep]
    return text, hashes


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``size`` bytes of text (one row at least)."""
    _, offsets = raw_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def shrink(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The top ``bits`` of each hash."""
    return (hashes >> U64(64 - bits)).astype(np.int64)
