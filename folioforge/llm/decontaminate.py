"""Benchmark decontamination: documents are scanned for the word windows of benchmark items.

Texts are lower-cased (A-Z) and cut into words of digits, letters and non-ASCII characters.
A window is `n` consecutive words of an item; an item with fewer words, but not none, is one
window. The hash set of all windows is broadcast: sorted hashes, and the items' words as places in
one buffer of bytes. Hits on hashes are verified on the words. The driver counts the bytes that a
set will take before it is made; a benchmark of more than BLOCK_BYTES comes in blocks, each held
against all documents in one scan that carries the findings so far along in the row. No scan
shuffles, and between blocks the rows are written to the shared folder.

Nulls: a null text has no words; a null item id still marks words but is not listed among the
items. Empty tables give no hits or no rows. Repeated documents each keep their own row, repeated
items count once by id. Columns of the documents are carried on untouched, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm import textkit as tk
from folioforge.llm.session import discard, written

WINDOW_WORDS = 10
#: Bytes of a hash set that is broadcast at once; beyond it, more blocks are scanned.
BLOCK_BYTES = 64 << 20
#: Bytes of a set for each word of an item (its place, its window's hash, place and item, and room to sort them), and for each item.
WORD_BYTES, ITEM_BYTES = 80, 200

FINDINGS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("hit_words", T.ArrayType(T.LongType())),
        T.StructField("hit_bytes", T.ArrayType(T.LongType())),
    ]
)


class WindowSet:
    """Windows of benchmark items by their number of words.

    For each number of words: sorted distinct hashes' windows, a sieve over the hashes' high bits, the
    first word of one occurrence, and the items that have the window.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], n: int):
        texts = pa.array([text or "" for _, text in items], pa.large_string())
        words = tk.find_words(*tk.text_bytes(texts), tk.ALNUM_WORDS)
        self.names = np.array(["" if item is None else str(item) for item, _ in items], object)
        self.named = np.array([item is not None for item, _ in items], bool)
        self.low, self.start, self.end = words.low, words.start, words.end
        first = np.cumsum(words.counts) - words.counts
        self.sizes = {}
        length = np.minimum(words.counts, n)
        for size in np.unique(length[length > 0]).tolist():
            own = np.flatnonzero(length == size)
            many = words.counts[own] - size + 1
            at = np.repeat(first[own], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            item = np.repeat(own, many)
            hashes = tk.window_hashes(words.hash, size)[at]
            order = np.argsort(hashes, kind="stable")
            hashes, at, item = hashes[order], at[order], item[order]
            fresh = np.ones(len(hashes), bool)
            fresh[1:] = hashes[1:] != hashes[:-1]
            heads = np.flatnonzero(fresh)
            for s, e in zip(heads.tolist(), np.append(heads[1:], len(hashes)).tolist(), strict=True):
                keys = [self.words(int(t), size) for t in at[s:e]] if e - s > 1 else []
                if len(set(keys)) > 1:  # equal hashes of other words are windows of their own
                    sort = sorted(range(e - s), key=keys.__getitem__)
                    at[s:e], item[s:e] = at[s:e][sort], item[s:e][sort]
                    fresh[s:e] = [not k or keys[sort[k]] != keys[sort[k - 1]] for k in range(e - s)]
            head = np.flatnonzero(fresh)
            sieve = np.zeros(1 << 20, bool)
            sieve[hashes[head] >> np.uint64(44)] = True
            self.sizes[size] = (hashes[head], sieve, at[head], np.append(head, len(hashes)), item)

    def words(self, at: int, size: int) -> bytes:
        return b" ".join(self.low[s:e].tobytes() for s, e in zip(self.start[at : at + size], self.end[at : at + size], strict=True))

    def items_of(self, size: int, k: int) -> set[str]:
        _, _, _, bounds, item = self.sizes[size]
        own = item[bounds[k] : bounds[k + 1]]
        return set(self.names[own[self.named[own]]])

    def hits(self, words: tk.Words) -> Iterator[tuple[int, int, int]]:
        """First word, number of words and window of each occurrence of a window."""
        for size, (hashes, sieve, places, _, _) in self.sizes.items():
            got = tk.window_hashes(words.hash, size)
            at = np.flatnonzero(sieve[got >> np.uint64(44)] & tk.windows_inside(words.doc, size))
            where = np.searchsorted(hashes, got[at])
            where[where == len(hashes)] = 0
            same = hashes[where] == got[at]
            for t, k in zip(at[same].tolist(), where[same].tolist(), strict=True):
                key = b" ".join(words.bytes_of(j) for j in range(t, t + size))
                while k < len(hashes) and hashes[k] == got[t]:
                    if self.words(int(places[k]), size) == key:
                        yield t, size, k
                        break
                    k += 1


def _runs(flags: np.ndarray) -> np.ndarray:
    """Starts and ends of the runs of True, in turns."""
    return np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))


_NOTHING = {"n_words": 0, "n_hit": 0, "item_ids": [], "hit_words": [], "hit_bytes": []}
_FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())), ("hit_words", pa.list_(pa.int64())), ("hit_bytes", pa.list_(pa.int64()))])


def _scan(batches: Iterator[pa.RecordBatch], windows: WindowSet, text: str) -> Iterator[pa.RecordBatch]:
    """batches: row, and found where other blocks have been held against it."""

    def with_text() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, batch.column("row").field(text)], [*batch.schema.names, "text"])

    for batch in tk.chunks(with_text(), "text"):
        data, offsets = tk.text_bytes(batch.column("text"))
        words = tk.find_words(data, offsets, tk.ALNUM_WORDS)
        cover = np.zeros(len(words.start) + 1, np.int64)
        windows_of: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for t, size, k in windows.hits(words):
            cover[t] += 1
            cover[t + size] -= 1
            windows_of[int(words.doc[t])].add((size, k))
        hit = np.cumsum(cover)[:-1] > 0
        first = np.concatenate([[0], np.cumsum(words.counts)])
        before = batch.column("found") if "found" in batch.schema.names else None
        rows = []
        for i in range(batch.num_rows):
            own = hit[first[i] : first[i + 1]]
            if not own.any():
                rows.append(before[i].as_py() if before is not None else _NOTHING | {"n_words": len(own)})
                continue
            runs = _runs(own)
            spans = np.empty_like(runs)
            spans[0::2] = words.start[first[i] + runs[0::2]] - offsets[i]
            spans[1::2] = words.end[first[i] + runs[1::2] - 1] - offsets[i]
            found = {"n_words": len(own), "n_hit": int(own.sum()), "item_ids": sorted(set().union(*(windows.items_of(*w) for w in windows_of[i]))), "hit_words": runs.tolist(), "hit_bytes": spans.tolist()}
            rows.append(_merge([before[i].as_py(), found]) if before is not None else found)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(rows, _FOUND)], ["row", "found"])


def _merge(found: list[dict]) -> dict:
    """The findings of one text in several blocks as one."""
    covered = np.zeros(max(x["n_words"] for x in found), bool)
    byte_at: dict[int, int] = {}
    for x in found:
        w, b = x["hit_words"], x["hit_bytes"]
        byte_at |= dict(zip(w, b, strict=True))
        for s, e in zip(w[0::2], w[1::2], strict=True):
            covered[s:e] = True
    runs = _runs(covered)
    return {"n_words": len(covered), "n_hit": int(covered.sum()), "item_ids": sorted({i for x in found for i in x["item_ids"]}), "hit_words": runs.tolist(), "hit_bytes": [byte_at[int(r)] for r in runs]}


def scan(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document: `row` (all its columns) and `found` (FINDINGS).

    hit_words and hit_bytes are starts and ends, in turns, of the runs of hit words.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("text"))
    size = F.octet_length("text") + WORD_BYTES * F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")) + ITEM_BYTES
    total = items.agg(F.sum(size.cast("bigint")).alias("n")).first()["n"] or 0
    blocks = -(-total // block_bytes) or 1
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = T.StructType([packed.schema["row"], T.StructField("found", FINDINGS)])
    out, spent = packed, None
    for b in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b)
        sent = spark.sparkContext.broadcast(WindowSet([(r["item"], r["text"]) for r in own.toLocalIterator()], n))
        out = out.mapInArrow(lambda it, sent=sent: _scan(it, sent.value, text), schema)
        if b < blocks - 1:
            out = written(out, "scanned")
            if spent is not None:
                discard(spent)
            spent = out
    return out


def findings(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids."""
    text = options.get("text", "text")
    got = scan(docs.select(doc_id, text), benchmark, **options)
    return got.select(
        F.col(f"row.{doc_id}").alias(doc_id),
        "found.n_words",
        "found.n_hit",
        F.size("found.item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.item_ids", ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
        "found.item_ids",
    )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text and hit_bytes become the text without those bytes; other columns stay."""
    for batch in batches:
        texts, spans = batch.column("text"), batch.column("hit_bytes")
        hit = np.flatnonzero(np.asarray(spans.value_lengths().fill_null(0)))
        left = texts.to_pylist() if len(hit) else texts
        for i in hit.tolist():
            raw, cut, out, at = left[i].encode(), spans[i].as_py(), [], 0
            for s, e in zip(cut[0::2], cut[1::2], strict=True):
                out.append(raw[at:s])
                at = e
            left[i] = b"".join([*out, raw[at:]]).decode()
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(left, texts.type) if len(hit) else texts], ["row", "text"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, mode: str = "drop", max_hit_share: float = 0.0, text: str = "text", **options) -> DataFrame:
    """docs, with the same columns, without benchmark passages.

    mode "drop" leaves out each document whose share of hit words is over max_hit_share;
    "spans" keeps all documents and cuts the hit words, from the first to the last of each run.
    """
    got = scan(docs, benchmark, text=text, **options)
    columns = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    if mode == "drop":
        return got.where(F.col("found.n_hit") <= F.lit(max_hit_share) * F.col("found.n_words")).select(*columns)
    if mode != "spans":
        raise ValueError(f"unknown mode: {mode}")
    schema = T.StructType([got.schema["row"], T.StructField("text", T.StringType())])
    left = got.select("row", F.col(f"row.`{text}`").alias("text"), "found.hit_bytes").mapInArrow(_without, schema)
    return left.select(*[F.col("text").alias(name) if name == text else c for c, name in zip(columns, docs.columns, strict=True)])


__all__ = ["WINDOW_WORDS", "decontaminate", "findings", "scan"]
