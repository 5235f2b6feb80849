"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds, for each position, the value of the polynomial of all code points
before it, modulo two primes. The difference of two entries, shifted by a power of the base,
answers whether two spans are equal, wherever they stand, and a binary search over lengths finds
how far two positions agree (the longest common extension). The array of a text made of parts of
two others is put together from theirs.

A fingerprint is written with the length, the value of the whole, and the values of prefixes and
suffixes on a grid: lengths that are multiples of the smallest power of two that needs at most GRID.

The likeness of two arrays chains longest common extensions: from the beginnings as far as they
agree, then from the next span of WINDOW code points that both have after that (of those near, the
one that leaves out least), and so on to the end. It is the code points in the chain divided by the
longer length: 1 for equal texts only, also for two empty ones; an empty and another have 0. Texts
of under 64 code points are chained by spans of SHORT_WINDOW. In longer texts the spans to go on
from are sampled by their value, alike in both texts, one in SPACING at least, so memory is bounded
by the arrays; what lies before a sampled span is found by an extension to the left.

Nulls: a null text is empty; a null id stands after all others in descending order. Repeated ids
stand in descending order of their texts' hashes. One document's next is itself. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.session import partitions, written

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1234567891)
GRID = 32
WINDOW, SHORT_WINDOW = 24, 6
#: Spans of a text that the chain can go on from, about, beyond which they are sampled: the more sparsely the longer
#: the text, but never more than one in SPACING, so that the likeness of longer texts does not fall with their length.
SAMPLED = 1 << 10
SPACING = 16
#: Spans among which the next of a chain is chosen.
CHOICE = 16

_BLOCK = 1 << 16
#: Spans are brought to one power of the base by raising them to this.
_TOP = 2**32 - 1
_LOW_BITS = 11


def _table(base: int, prime: int, n: int) -> np.ndarray:
    """base**i modulo prime for i < n, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), prime))
        out = np.concatenate([out, out * step % np.uint64(prime)])
    return out[:n]


_UP = [_table(b, p, _BLOCK) for b, p in zip(BASES, PRIMES, strict=True)]
#: Powers by the low, middle and high bits of the exponent.
_LEVELS = [[_table(pow(b, 1 << (_LOW_BITS * k), p), p, 1 << _LOW_BITS) for k in range(3)] for b, p in zip(BASES, PRIMES, strict=True)]


def _power(k: int, exponent: np.ndarray) -> np.ndarray:
    """The base to any exponent below 2**33."""
    prime, mask = np.uint64(PRIMES[k]), (1 << _LOW_BITS) - 1
    low, middle, high = (_LEVELS[k][i][exponent >> (_LOW_BITS * i) & mask] for i in range(3))
    return low * middle % prime * high % prime


_DOWN = [_power(k, _TOP - np.arange(_BLOCK)) for k in range(2)]


class PrefixHashes:
    """The prefix arrays of one text."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.n = n = len(points)
        self.arrays = [np.zeros(n + 1, np.uint32) for _ in PRIMES]
        for at in range(0, n, _BLOCK):
            block = points[at : at + _BLOCK].astype(np.uint64) + np.uint64(1)
            for k, array in enumerate(self.arrays):
                prime = np.uint64(PRIMES[k])
                sums = np.cumsum(block * _UP[k][: len(block)] % prime) % prime
                array[at + 1 : at + 1 + len(block)] = (np.uint64(array[at]) + sums * np.uint64(pow(BASES[k], at, PRIMES[k])) % prime) % prime if at else sums
        self._windows: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def joined(cls, a: PrefixHashes, n_a: int, b: PrefixHashes, n_b: int) -> PrefixHashes:
        """Of the first n_a code points of one text and the first n_b of another."""
        out = cls("")
        out.n = n_a + n_b
        out.arrays = []
        for k, (x, y) in enumerate(zip(a.arrays, b.arrays, strict=True)):
            array = np.empty(out.n + 1, np.uint32)
            array[: n_a + 1] = x[: n_a + 1]
            prime, shift = np.uint64(PRIMES[k]), np.uint64(pow(BASES[k], n_a, PRIMES[k]))
            for at in range(1, n_b + 1, _BLOCK):
                end = min(at + _BLOCK, n_b + 1)
                array[n_a + at : n_a + end] = (np.uint64(x[n_a]) + y[at:end].astype(np.uint64) * shift) % prime
            out.arrays.append(array)
        return out

    def values(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit values of spans; equal spans have equal values wherever they stand."""
        out = []
        short = self.n < _BLOCK
        for k in range(2):
            prime, array = np.uint64(PRIMES[k]), self.arrays[k]
            out.append((array[end].astype(np.uint64) + prime - array[start]) * (_DOWN[k][start] if short else _power(k, _TOP - start)) % prime)
        return out[0] << np.uint64(31) | out[1]

    def value(self, start: int, end: int) -> int:
        return int(self.values(np.array([start]), np.array([end]))[0])

    def _equal(self, start: int, other: PrefixHashes, other_start: int, length: int) -> bool:
        for k in range(2):
            x = self.arrays[k].item(start + length) - self.arrays[k].item(start)
            y = other.arrays[k].item(other_start + length) - other.arrays[k].item(other_start)
            if start != other_start:
                further = abs(start - other_start)
                shift = _UP[k].item(further) if further < _BLOCK else pow(BASES[k], further, PRIMES[k])
                x, y = (x, y * shift) if start > other_start else (x * shift, y)
            if (x - y) % PRIMES[k]:
                return False
        return True

    def same(self, start: int, other: PrefixHashes, other_start: int, length: int) -> bool:
        """Whether both spans of this length are equal."""
        if min(start, other_start) < 0 or start + length > self.n or other_start + length > other.n:
            return False
        return self._equal(start, other, other_start, length)

    def extension(self, start: int, other: PrefixHashes, other_start: int) -> int:
        """Length of the longest common extension to the right of two positions."""
        return _longest(lambda m: self._equal(start, other, other_start, m), min(self.n - start, other.n - other_start))

    def extension_left(self, end: int, other: PrefixHashes, other_end: int, most: int) -> int:
        """Length of the longest common extension to the left, `most` at most."""
        return _longest(lambda m: self._equal(end - m, other, other_end - m, m), most)

    def windows(self, size: int, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Values and positions of the spans of this size whose value is a multiple of step, sorted by both."""
        if (size, step) not in self._windows:
            values, places = [], []
            for at in range(0, max(self.n - size + 1, 0), _BLOCK):
                start = np.arange(at, min(at + _BLOCK, self.n - size + 1))
                got = self.values(start, start + size)
                kept = slice(None) if step == 1 else np.flatnonzero(got % np.uint64(step) == 0)
                values.append(got[kept])
                places.append(start[kept])
            value, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (values, places))
            order = np.argsort(value, kind="stable")
            self._windows[size, step] = value[order], place[order]
        return self._windows[size, step]

    def likeness(self, other: PrefixHashes) -> float:
        """From 0 to 1: the share of the longer text in a chain of longest common extensions."""
        n, m = self.n, other.n
        if not n or not m:
            return float(n == m)
        common = i = j = self.extension(0, other, 0)
        size = WINDOW if min(n, m) >= 64 else SHORT_WINDOW
        if min(n - i, m - j) < size:
            return common / max(n, m)
        step = 1
        while max(n, m) > SAMPLED * step and step < SPACING:
            step *= 2
        value, place = self.windows(size, step)
        theirs, at = other.windows(size, step)
        low, high = np.searchsorted(value, theirs, "left"), np.searchsorted(value, theirs, "right")
        shared = np.flatnonzero((high > low) & (at >= j))
        shared = shared[np.argsort(at[shared], kind="stable")]
        at, low, high = at[shared], low[shared], high[shared]
        k = 0
        while k < len(at):
            best = None
            for c in range(k, min(k + CHOICE, len(at))):
                if best and at[c] - j >= best[0]:
                    break
                own = place[low[c] : high[c]]
                x = int(np.searchsorted(own, i))
                if x < len(own) and (not best or int(own[x]) - i + int(at[c]) - j < best[0]):
                    best = (int(own[x]) - i + int(at[c]) - j, int(own[x]), int(at[c]))
            if not best:
                k += CHOICE
                continue
            _, a, b = best
            back = self.extension_left(a, other, b, min(a - i, b - j)) if step > 1 else 0
            more = self.extension(a, other, b)
            common += back + more
            i, j = a + more, b + more
            k = int(np.searchsorted(at, j))
        return common / max(n, m)

    def fingerprint(self) -> str:
        """length.whole.prefixes.suffixes, in hexadecimal, grid values of 8 digits each."""
        n, step = self.n, 1
        while n // step > GRID:
            step *= 2
        at = np.arange(step, n + 1, step)
        ends = [self.values(np.zeros_like(at), at), self.values(n - at, np.full_like(at, n))]
        short = ["".join(f"{x:08x}" for x in ((v ^ (v >> np.uint64(29))) & np.uint64(0xFFFFFFFF)).tolist()) for v in ends]
        return f"{n:x}.{self.value(0, n):016x}.{short[0]}.{short[1]}"


def _longest(agrees: Callable[[int], bool], most: int) -> int:
    """The largest length up to `most` that agrees, if all shorter ones do: by doubling, then halving."""
    if most <= 0 or agrees(most):
        return max(most, 0)
    low, high = 0, 1
    while high < most and agrees(high):
        low, high = high, 2 * high
    high = min(high, most) - 1
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if agrees(mid) else (low, mid - 1)
    return low


def fingerprint(text: str | None) -> str:
    return PrefixHashes(text or "").fingerprint()


def likeness(a: str | None, b: str | None) -> float:
    """Of two texts."""
    return PrefixHashes(a or "").likeness(PrefixHashes(b or ""))


def edited(text: str, following: str) -> str:
    """text with its last third replaced by the beginning of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_FIELDS = [("doc_id", pa.int64()), ("mark", pa.int64()), ("part", pa.int64()), ("first", pa.bool_()), ("last", pa.bool_()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_DDL = "doc_id bigint, mark bigint, part bigint, first boolean, last boolean, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(text: str, own: PrefixHashes, following: str, after: PrefixHashes) -> tuple:
    changed = edited(text, following)
    kept = len(text) - len(text) // 3
    print_ = PrefixHashes.joined(own, kept, after, len(changed) - kept)
    return hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own.fingerprint(), print_.fingerprint(), own.likeness(print_), own.likeness(after)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document with the one after it; the partition's last waits for the next partition's first."""
    part, held, first, rows = TaskContext.get().partitionId(), None, True, []
    schema = pa.schema(_FIELDS)

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f[1]) for c, f in zip(zip(*rows, strict=True), _FIELDS, strict=True)], schema=schema)

    for b in batches:
        for doc_id, mark, text in zip(*(b.column(c) for c in ("doc_id", "mark", "text")), strict=True):
            doc_id, mark, text = doc_id.as_py(), mark.as_py(), text.as_py() or ""
            own = PrefixHashes(text)
            if held:
                rows.append((held[0], held[1], part, first, False, len(held[2]), *_compared(held[2], held[3], text, own)))
                first = False
                if len(rows) >= 2000:
                    yield batch()
                    rows.clear()
            held = (doc_id, mark, text, own)
    if held:
        rows.append((held[0], held[1], part, first, True, len(held[2]), None, held[3].fingerprint(), None, None, None))
        yield batch()


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for r in b.to_pylist():
            text, following = r["text"] or "", r["following"] or ""
            rows.append((r["doc_id"], len(text), *_compared(text, PrefixHashes(text), following, PrefixHashes(following))))
        fields = [f for f in _FIELDS if f[0] not in ("mark", "part", "first", "last")]
        yield pa.RecordBatch.from_arrays([pa.array(c, f[1]) for c, f in zip(zip(*rows, strict=True), fields, strict=True)] if rows else [pa.array([], f[1]) for f in fields], schema=pa.schema(fields))


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Texts are dealt once, by ranges of descending ids. Only the two ends of each partition reach
    the driver, without texts; the pairs that partitions cut apart are read again.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    order = [F.col("doc_id").desc(), F.col("mark").desc()]
    dealt = docs.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    done = written(dealt.mapInArrow(_in_order, _DDL), "fingerprints")
    ends = sorted(done.where("first or last").select("part", "doc_id", "mark", "first", "last").collect(), key=lambda r: r["part"])
    firsts, lasts = [r for r in ends if r["first"]], [r for r in ends if r["last"]]
    cut = [(i, own["doc_id"], own["mark"], firsts[(i + 1) % len(firsts)]["doc_id"], firsts[(i + 1) % len(firsts)]["mark"]) for i, own in enumerate(lasts)]
    pairs = F.broadcast(spark.createDataFrame(cut, "pair int, a bigint, a_mark bigint, b bigint, b_mark bigint"))  # two rows a partition
    own = docs.join(pairs, docs["doc_id"].eqNullSafe(F.col("a")) & (docs["mark"] == F.col("a_mark"))).select("pair", "doc_id", "text").dropDuplicates(["pair"])
    after = docs.join(pairs, docs["doc_id"].eqNullSafe(F.col("b")) & (docs["mark"] == F.col("b_mark"))).select("pair", F.col("text").alias("following")).dropDuplicates(["pair"])
    columns = [f[0] for f in _FIELDS if f[0] not in ("mark", "part", "first", "last")]
    joined = own.join(after, "pair").select("doc_id", "text", "following").mapInArrow(_pairs, ", ".join(x for x in _DDL.split(", ") if x.split()[0] in columns))
    return done.where("not last").select(columns).unionByName(joined.select(columns)).withColumnRenamed("doc_id", doc_id)
