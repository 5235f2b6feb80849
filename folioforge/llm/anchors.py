"""Anchors of the fixed-length strings of texts, and fingerprints of spans, vectorised."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from folioforge.llm import textkit as tk

_BASE = 0xB5297A4D3F84D5A9
_INVERSE = pow(_BASE, -1, 2**64)
_TABLES = [tk.powers(_BASE, 1), tk.powers(_INVERSE, 1)]
#: Low bits of a key that hold its place; texts are taken in segments below 2**PLACE_BITS bytes.
PLACE_BITS = 26
_PLACE = np.uint64(2**PLACE_BITS - 1)


class Spans:
    """Fingerprints of any spans of some bytes; equal spans have equal ones."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(_TABLES[0]) < n + 1:
            size = max(n + 1, tk.CHUNK_BYTES + 1)
            _TABLES[:] = [tk.powers(_BASE, size), tk.powers(_INVERSE, size)]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(tk._BYTE_CODES[data] * _TABLES[0][:n], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * _TABLES[1][start]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return tk.mix(self.raw(start, end) + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """Of all spans of k bytes."""
        n = len(self.sums) - k
        return tk.mix((self.sums[k:] - self.sums[:n]) * _TABLES[1][:n]) if n > 0 else np.zeros(0, np.uint64)


@dataclass
class Anchors:
    """Each run of strings that share an anchor: its text, first and last string, the anchor, its rank."""

    doc: np.ndarray
    low: np.ndarray
    high: np.ndarray
    at: np.ndarray
    rank: np.ndarray


def anchors(data: np.ndarray, offsets: np.ndarray, spans: Spans, length: int, gram: int) -> Anchors:
    """The anchor of a string of `length` bytes is its leftmost gram with the least rank, so equal strings have
    equal anchors at equal places.
    """
    w = length - gram + 1
    n = len(data) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Anchors(none, none, none, none, np.zeros(0, np.uint64))
    rank = spans.grams(gram)
    least = (rank & ~_PLACE) | np.arange(len(rank), dtype=np.uint64)
    span = 1
    while 2 * span <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < w:
        least = np.minimum(least[: n], least[w - span : w - span + n])
    at = (least[:n] & _PLACE).astype(np.int64)
    # strings that lie within one text
    sizes = np.diff(offsets)
    inside = np.zeros(n + 1, np.int64)
    long = np.flatnonzero(sizes >= length)
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, offsets[long] + sizes[long] - length + 1, -1)
    ok = np.cumsum(inside)[:n] > 0
    edge = np.ones(n, bool)
    edge[1:] = (at[1:] != at[:-1]) | (ok[1:] != ok[:-1])
    starts = offsets[long]
    edge[starts[starts < n]] = True
    low = np.flatnonzero(edge)
    high = np.append(low[1:], n) - 1
    use = ok[low]
    low, high = low[use], high[use]
    return Anchors(np.searchsorted(offsets, low, side="right") - 1, low, high, at[low], rank[at[low]])
