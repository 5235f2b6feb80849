"""Vectorised text primitives shared by the operators: Arrow text as bytes, words, hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once. A single longer text is worked on alone.
CHUNK_BYTES = 2 << 20

_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i < n."""
    out = np.full(max(n, 1), base % 2**64, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _MUL)
_BASE = 0xD6E8FEB86659FD93
_POW = powers(_BASE, 64)


def _word_powers(n: int) -> np.ndarray:
    global _POW
    if n > len(_POW):
        _POW = powers(_BASE, max(n, 2 * len(_POW)))
    return _POW


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches into slices of at most `limit` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and offsets (rows + 1). A null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if not len(column) or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def byte_table(chars: str | bytes) -> np.ndarray:
    """True for the bytes listed."""
    out = np.zeros(256, bool)
    out[np.frombuffer(chars if isinstance(chars, bytes) else chars.encode("latin-1"), np.uint8)] = True
    return out


#: Lower-cases A-Z and leaves all other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in lower-cased text, in which all non-ASCII bytes are word bytes.
ALNUM_WORDS = byte_table(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))

#: Bytes of words [^\x20\x09-\x0D]+.
SPACED_WORDS = ~byte_table(bytes([0x20, *range(0x09, 0x0E)]))


@dataclass
class Words:
    """Words of several texts. counts: words of each text; doc: the text of each word."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    counts: np.ndarray
    hash: np.ndarray

    def bytes_of(self, i: int) -> bytes:
        return self.low[self.start[i] : self.end[i]].tobytes()


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """Maximal runs of table's bytes in lower-cased text; they never cross texts."""
    low = LOWER[data]
    n_docs = len(offsets) - 1
    is_word = table[low]
    start_flag = is_word.copy()
    start_flag[1:] &= ~is_word[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(low)]
    start_flag[firsts] = is_word[firsts]
    end_flag = is_word.copy()
    end_flag[:-1] &= ~is_word[1:]
    lasts = offsets[1:][(offsets[1:] > 0)] - 1
    end_flag[lasts] = is_word[lasts]
    start, end = np.flatnonzero(start_flag), np.flatnonzero(end_flag) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    counts = np.bincount(doc, minlength=n_docs) if n_docs else np.zeros(0, np.int64)
    return Words(low, start, end, doc, counts, span_hashes(low, start, end))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of disjoint ascending spans of bytes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    lengths = end - start
    before = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(before, lengths)
    values = _BYTE_CODES[data[inside + np.repeat(start, lengths)]]
    values *= _word_powers(int(lengths.max()))[inside]
    return mix(np.add.reduceat(values, before) ^ (lengths.astype(np.uint64) * _MUL))


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive hashes; the order counts."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(hashes) - n + 1, np.uint64(n), dtype=np.uint64)
    for i in range(n):
        out *= _MUL
        out += hashes[i : len(hashes) - n + 1 + i]
    return mix(out)


def windows_inside(doc: np.ndarray, n: int) -> np.ndarray:
    """Which windows of n words lie within one text."""
    return doc[n - 1 :] == doc[: len(doc) - n + 1] if len(doc) >= n else np.zeros(0, bool)
