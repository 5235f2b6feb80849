"""Repeated passages removed by distributed prefix doubling over sampled positions.

A byte goes when it is covered by a string of `length` bytes that also starts in a document with a
smaller id. Texts are UTF-8 bytes; strings do not cross documents and are judged on the input.

Ranking every byte would shuffle a row for each, many times over, so positions are sampled so that
no repeat is lost: the anchor of a string is its leftmost gram of `gram` bytes with the least
fingerprint. Equal strings have equal anchors in equal places, and about one position in sixteen is
an anchor. Spark then sorts (rank, rank at offset) pairs at growing offsets:

1. Offset 0: all anchors are sorted by the fingerprint of their gram and of the stretch of all
   strings around them. Grams that one document has alone are unique and dropped with their strings.
   Where a smaller document has the same stretch, all of its strings are past the threshold at once.
   The rest get their place in the order as rank.
2. Offsets gram, 2 * gram, ... up to gram and half of what is left of `length`: the pairs of an
   anchor's rank and the fingerprint of the bytes at that offset, to the right and to the left, are
   sorted and reranked; unique ones are dropped. A string is longer than its gram by at least that
   half on one side, so one side of its anchor stays if it repeats.
3. Offset `length`: each string of the sides that stayed is sorted with its document; those with a
   smaller document count.
4. The stretches of each document are joined and cut out of its text.

Copies within one batch of input are settled before each shuffle: only the smallest document of
equal stretches or strings takes part, so a passage that a third of all documents share is sent once a
batch. Sorting spills to disk and scans hold one row; no group is gathered in memory. Grams are
fingerprints of 48 bits, bytes at offsets of 64, strings are told apart by 95. Stretches that share
a gram are told apart by 48 bits alone, and what is past the threshold is cut without a check of
its bytes.

Nulls: a null text is empty; rows without an id keep all bytes and are no source. Rows that repeat
an id are one document's, so they do not remove each other's bytes (their texts are told apart by 15
bits). Texts shorter than `length` keep all bytes. An empty table gives an empty result. Other
columns take no part. `length` may exceed `gram` by 255 at most; more is refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm import textkit as tk
from folioforge.llm.anchors import Spans, anchors
from folioforge.llm.session import discard, partitions, written

LENGTH = 50
GRAM = 20
#: Bytes of a text that are anchored at once; strings that cross the cut belong to the first part.
SEGMENT_BYTES = 32 << 20
#: Bytes of text whose copies are settled before the shuffle.
COMBINED_BYTES = 8 << 20

# Rank and context are packed into 96 bits, 48 each: `rank` has the rank and 16 bits of the context, `context` the rest.
# A place is packed into 64 bits: settled (sign), 15 bits of the text's hash, 31 of the first string, 8 of the
# number of strings less one, 8 of the anchor's distance from the first string.
_MARK, _LOW, _COUNT = 47, 16, 8
_MARKS, _LOWS, _COUNTS = 2**15 - 1, 2**31 - 1, 2**8 - 1
_SETTLED = np.int64(-(2**63))
_HIGH = np.uint64(0xFFFFFFFFFFFF0000)
_LEFT, _RIGHT = 1, 2


def _marks(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("mark")).astype(np.int64) & _MARKS


def _segments(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, offsets, row of each text, and the first byte's place in it; very long texts come in parts."""
    data, offsets = tk.text_bytes(batch.column("text"))
    if len(data) <= SEGMENT_BYTES:
        yield data, offsets, np.arange(len(offsets) - 1), np.zeros(len(offsets) - 1, np.int64)
        return
    for row, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for at in range(s, max(e - length + 1, s + 1), SEGMENT_BYTES):
            end = min(e, at + SEGMENT_BYTES + length - 1)
            yield data[at:end], np.array([0, end - at]), np.array([row]), np.array([at - s])


def _found(batch: pa.RecordBatch, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    doc_id, mark = np.asarray(batch.column("doc_id")), _marks(batch)
    for data, offsets, rows, base in _segments(batch, length):
        spans = Spans(data)
        a = anchors(data, offsets, spans, length, gram)
        context = spans.of(a.low, a.high + length) ^ tk.mix((a.at - a.low + 1).astype(np.uint64))
        row = rows[a.doc]
        info = mark[row] << _MARK | (a.low - offsets[a.doc] + base[a.doc]) << _LOW | (a.high - a.low) << _COUNT | (a.at - a.low)
        yield a.rank, context, doc_id[row], info


def _settled(keys: tuple[np.ndarray, ...], doc: np.ndarray) -> np.ndarray:
    """Which rows have another with equal keys (the last counts most) and a smaller document."""
    order = np.lexsort((doc, *keys))
    first = np.ones(len(doc), bool)
    first[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    heads = np.flatnonzero(first)
    out = np.zeros(len(doc), bool)
    out[order] = doc[order] > np.repeat(doc[order][heads], np.diff(np.append(heads, len(doc))))
    return out


def _scattered(info: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Keys that deal settled rows over all tasks."""
    return tk.mix(info.astype(np.uint64) ^ doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _anchored(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for whole in tk.chunks(batches, "text", COMBINED_BYTES):
        parts = [x for batch in tk.chunks([whole], "text") for x in _found(batch, length, gram)]
        if not parts:
            continue
        rank, context, doc, info = (np.concatenate(x) for x in zip(*parts, strict=True))
        rank, context = rank & _HIGH | context >> np.uint64(48), context >> np.uint64(16) & np.uint64(0xFFFFFFFF)
        settled = _settled((context, rank), doc)
        rank = np.where(settled, _scattered(info, doc), rank)
        info = np.where(settled, info | _SETTLED, info)
        context = np.where(settled, np.uint64(0), context).astype(np.uint32).view(np.int32)
        for s in range(0, len(rank), 200_000):
            e = s + 200_000
            yield pa.RecordBatch.from_arrays([pa.array(rank[s:e].view(np.int64)), pa.array(context[s:e]), pa.array(doc[s:e]), pa.array(info[s:e])], ["rank", "context", "doc_id", "info"])


def _open_places(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of the places of a batch's texts: row, info, side, rank."""
    places = batch.column("places")
    row = np.repeat(np.arange(batch.num_rows), np.asarray(places.value_lengths()))
    info, side, rank = (np.asarray(places.flatten().field(c)) for c in ("info", "side", "rank"))
    own = (info >> _MARK & _MARKS) == _marks(batch)[row]
    return row[own], info[own], side[own], rank[own]


def _at_offset(batches: Iterator[pa.RecordBatch], gram: int, reach: int, step: int) -> Iterator[pa.RecordBatch]:
    """Of each open side of an anchor, with `reach` bytes beyond its gram ranked: the rank, and the fingerprint of the next `step` bytes."""
    for batch in tk.chunks(batches, "text"):
        data, offsets = tk.text_bytes(batch.column("text"))
        row, info, side, rank = _open_places(batch)
        at = offsets[row] + (info >> _LOW & _LOWS) + (info & _COUNTS)
        start = np.where(side == _RIGHT, at + gram + reach, at - reach - step)
        fits = (start >= offsets[row]) & (start + step <= offsets[row + 1])
        row, info, side, rank, start = row[fits], info[fits], side[fits], rank[fits], start[fits]
        after = Spans(data).of(start, start + step)
        doc = np.asarray(batch.column("doc_id"))[row]
        yield pa.RecordBatch.from_arrays([pa.array(rank), pa.array(after.view(np.int64)), pa.array(side), pa.array(doc), pa.array(info)], ["rank", "after", "side", "doc_id", "info"])


def _named(batch: pa.RecordBatch, length: int, split: int) -> tuple[np.ndarray, ...]:
    """Fingerprints, document and place of all strings of the sides that are open. split: the anchor's distance up to which a string is the right side's."""
    data, offsets = tk.text_bytes(batch.column("text"))
    row, info, side, _ = _open_places(batch)
    low, last = info >> _LOW & _LOWS, (info >> _LOW & _LOWS) + (info >> _COUNT & _COUNTS)
    at = low + (info & _COUNTS)
    low = np.where(side == _RIGHT, np.maximum(low, at - split), low)
    many = np.maximum(np.where(side == _RIGHT, last, np.minimum(last, at - split - 1)) - low + 1, 0)
    row = np.repeat(row, many)
    at = np.repeat(low, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    start = offsets[row] + at
    name = tk.mix(Spans(data).raw(start, start + length))
    back = Spans(tk.LOWER[::-1][data])  # another code of the bytes gives independent fingerprints
    more = (tk.mix(back.raw(start, start + length)) >> np.uint64(33)).astype(np.int32)
    return name, more, np.asarray(batch.column("doc_id"))[row], _marks(batch)[row] << _MARK | at << _LOW


def _strings(batches: Iterator[pa.RecordBatch], length: int, split: int) -> Iterator[pa.RecordBatch]:
    for whole in tk.chunks(batches, "text", COMBINED_BYTES):
        parts = [_named(batch, length, split) for batch in tk.chunks([whole], "text")]
        name, more, doc, info = (np.concatenate(x) for x in zip(*parts, strict=True))
        settled = _settled((more, name), doc)
        # Settled strings that stand side by side are one row.
        s_doc, s_info = doc[settled], info[settled]
        order = np.lexsort((s_info, s_doc))
        s_doc, s_info = s_doc[order], s_info[order]
        fresh = np.ones(len(s_doc), bool)
        fresh[1:] = (s_doc[1:] != s_doc[:-1]) | (s_info[1:] - s_info[:-1] > 1 << _LOW)
        head = np.flatnonzero(fresh)
        inside = np.arange(len(s_doc)) - np.repeat(head, np.diff(np.append(head, len(s_doc))))
        head = np.flatnonzero(inside % 256 == 0)
        count = np.diff(np.append(head, len(s_doc))) - 1
        # Of strings that stand twice, both places are kept; those between count once.
        reach = (s_info[np.append(head[1:], len(s_doc)) - 1] - s_info[head]) >> _LOW if len(head) else count
        s_doc, s_info = s_doc[head], s_info[head] | reach << _COUNT | _SETTLED
        name = np.concatenate([name[~settled], _scattered(s_info, s_doc)])
        more = np.concatenate([more[~settled], np.zeros(len(s_doc), np.int32)])
        doc, info = np.concatenate([doc[~settled], s_doc]), np.concatenate([info[~settled], s_info])
        for s in range(0, len(doc), 500_000):
            e = s + 500_000
            yield pa.RecordBatch.from_arrays([pa.array(name[s:e].view(np.int64)), pa.array(more[s:e]), pa.array(doc[s:e]), pa.array(info[s:e])], ["name", "more", "doc_id", "info"])


def _cut(batches: Iterator[pa.RecordBatch], length: int, keep_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in tk.chunks(batches, "text"):
        data, offsets = tk.text_bytes(batch.column("text"))
        marks = _marks(batch)
        rows = []
        for i in range(batch.num_rows):
            raw = data[offsets[i] : offsets[i + 1]]
            spans = 0
            if len(raw) >= length and batch.column("gone")[i].is_valid:
                info = np.asarray(batch.column("gone")[i].values)
                info = info[(info >> _MARK & _MARKS) == marks[i]]
                low, many = info >> _LOW & _LOWS, info >> _COUNT & _COUNTS
                cover = np.zeros(len(raw) + 1, np.int64)
                np.add.at(cover, low, 1)
                np.add.at(cover, low + many + length, -1)
                gone = np.cumsum(cover)[:-1] > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                size = len(raw)
                raw = raw[~gone]
                rows.append((size, size - len(raw), spans, raw.tobytes()))
                continue
            rows.append((len(raw), 0, 0, raw.tobytes()))
        n, removed, spans, kept = zip(*rows, strict=True)
        last = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if keep_text else pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), last], ["doc_id", "n_bytes", "n_removed", "n_spans", "text" if keep_text else "kept_sha256"])


def _sorted_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.repartition(partitions(df.sparkSession), *keys).sortWithinPartitions(*order)


def _with_places(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Texts with their open places (doc_id, info, side, rank)."""
    return docs.join(places.groupBy("doc_id").agg(F.collect_list(F.struct("info", "side", "rank")).alias("places")), "doc_id")


def repeated_passages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (or, with keep_text, the text that is left;
    characters that a cut splits are dropped from it).
    """
    if not 0 < gram <= length <= gram + _COUNTS:
        raise ValueError(f"length must be from gram to gram + {_COUNTS}")
    spark = docs.sparkSession
    every = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("mark"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    known = every.where("doc_id is not null")
    long = known.where(F.octet_length("text") >= length)

    ranked = long.mapInArrow(lambda it: _anchored(it, length, gram), "rank bigint, context int, doc_id bigint, info bigint")
    ranked = ranked.select(F.shiftright("rank", 16).alias("gram"), (F.shiftleft(F.col("rank").bitwiseAND(0xFFFF), 32) + F.col("context").cast("bigint").bitwiseAND(0xFFFFFFFF)).alias("context"), "doc_id", "info")
    first = written(
        spark.sql(
            """SELECT doc_id, info, rank, info < 0 OR doc_id > leader AS past FROM (
              SELECT *, min(doc_id) OVER (PARTITION BY gram, context) AS leader FROM (
                SELECT *, min(n) OVER w AS rank, min(doc_id) OVER w AS low, max(doc_id) OVER w AS high, min(context) OVER w AS c0, max(context) OVER w AS c1
                FROM (SELECT *, monotonically_increasing_id() AS n FROM {ranked}) WINDOW w AS (PARTITION BY gram)))
            WHERE info < 0 OR doc_id > leader OR (low < high AND c0 <> c1)""",
            ranked=_sorted_by(ranked, ["gram"], ["gram", "context", "doc_id"]),
        ),
        "anchors",
    )
    still = first.where("not past").select("doc_id", "info", F.explode(F.array(F.lit(_LEFT), F.lit(_RIGHT))).alias("side"), "rank")

    half, reach, tables = (length - gram + 1) // 2, 0, [first]
    while reach < half:
        step = min(gram + reach, half - reach)
        pairs = _with_places(long, still).mapInArrow(lambda it, reach=reach, step=step: _at_offset(it, gram, reach, step), "rank bigint, after bigint, side int, doc_id bigint, info bigint")
        still = written(
            spark.sql(
                """SELECT doc_id, info, side, rank FROM (
                  SELECT doc_id, info, side, min(n) OVER w AS rank, min(doc_id) OVER w AS low, max(doc_id) OVER w AS high
                  FROM (SELECT *, monotonically_increasing_id() AS n FROM {pairs}) WINDOW w AS (PARTITION BY rank, side, after))
                WHERE low < high""",
                pairs=_sorted_by(pairs, ["rank", "side", "after"], ["rank", "side", "after"]),
            ),
            "ranks",
        )
        tables.append(still)
        reach += step

    strings = _with_places(long, still).mapInArrow(lambda it: _strings(it, length, length - gram - half), "name bigint, more int, doc_id bigint, info bigint")
    hits = spark.sql("SELECT doc_id, info FROM (SELECT *, min(doc_id) OVER (PARTITION BY name, more) AS leader FROM {strings}) WHERE info < 0 OR doc_id > leader", strings=_sorted_by(strings, ["name"], ["name", "more", "doc_id"]))
    hits = written(hits, "strings")
    gone = written(first.where("past").select("doc_id", "info").unionByName(hits).groupBy("doc_id").agg(F.collect_list("info").alias("gone")), "gone")
    discard(*tables, hits)

    joined = known.join(gone, "doc_id", "left").select("doc_id", "mark", "text", "gone")
    lone = every.where("doc_id is null").select("doc_id", "mark", "text", F.lit(None).cast("array<bigint>").alias("gone"))
    out = f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {'text' if keep_text else 'kept_sha256'} string"
    return joined.unionByName(lone).mapInArrow(lambda it: _cut(it, length, keep_text), out).withColumnRenamed("doc_id", doc_id)
