"""Cross-tokenizer alignment by distinct segments.

A text with a space before it is encoded by a byte-level tokenizer (A); the text by a piece tokenizer
(B), which adds that space. Byte offsets at which tokens of both end cut them into groups.

Texts are split before runs of white space, where no merge can cross: a split between two bytes is
made only where no token of either vocabulary holds these two bytes side by side, the first is no
white space, and the second is a space, tab or line feed. (A's own cut of texts into pieces always
ends one before white space that follows something else, and looks no further back.) So a segment's
tokens are the same in any text.

Spark cuts blocks of documents into segments; a block becomes its distinct segments and, for each
document, their numbers in order. All blocks' segments are sorted, so that each distinct one is
tokenised and aligned once, and the alignments are joined back to their blocks, where documents are
composed. Blocks also count the documents of each pair of linked ids; the sums over all blocks are
joined back by pair. A common segment or pair is a row a block in these steps, never a row an
occurrence: at most one in some hundred thousand of the rows that are shuffled.

A null or empty text, and one whose tokens do not give back its bytes (it holds U+2581, say), has no
tokens: zeros, and empty groups. Repeated rows are documents of their own. A text of any length is
whole in one block, whose memory grows with the longest text. An empty table gives no row. Only the
two columns named are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm import textkit as tk
from folioforge.llm.session import discard, partitions, written

#: Bytes of text of a block; one text at least.
BLOCK_BYTES = 8 << 20
#: Rows of segments that are handed on, or aligned, at once.
_ROWS = 200_000
#: Segments that the tokenizers get at once.
_ENCODED = 10_000
#: Bytes of alignments that are parsed at once; one segment's at least.
_PARSED_BYTES = 1 << 20
#: Links of documents' distinct segments that are counted at once; one document's at least.
_LINKED = 500_000
#: A space, tab or line feed may begin a segment.
SPLITS = b" \t\n"
#: White space beyond ASCII, and characters that some tables count as such.
WIDE_SPACES = [0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]
_LEAD = "x"


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, the bytes of their ids, and between which bytes a text may be split."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        cut = json.loads(self.a.to_str()).get("pre_tokenizer") or {}
        if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError(f"{byte_level} does not cut texts before white space")
        letters = _byte_letters()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = {i: bytes(letters[c] for c in token) for token, i in self.a.get_vocab().items() if token not in special}
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        n = self.b.get_piece_size()
        self.b_bytes = {i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i in range(n) for p in [self.b.id_to_piece(i)]}
        self.lead = self.b.encode(_LEAD)

    def splits(self) -> np.ndarray:
        """Whether a text may be split between two bytes, by the first and the second."""
        out = np.zeros((256, 256), bool)
        out[0x21:0x7F, list(SPLITS)] = True
        out[0x80:, list(SPLITS)] = True
        for token in [*self.a_bytes.values(), *self.b_bytes.values()]:
            for p, q in zip(token, token[1:]):
                out[p, q] = False
        return out

    def align(self, segments: list[str]) -> list[str | None]:
        """a1,a2|b1;a3|b2 of each segment; None where tokens do not give back the bytes. Each begins with one of SPLITS."""
        out = []
        of_a = self.a.encode_batch_fast(segments, add_special_tokens=False)
        of_b = self.b.encode([_LEAD + s for s in segments], num_threads=1)
        for text, a, b in zip(segments, of_a, of_b, strict=True):
            a, b, raw = a.ids, b[len(self.lead) :], text.encode()
            a_parts, b_parts = [self.a_bytes.get(i, b"") for i in a], [self.b_bytes[i] for i in b]
            if b"".join(a_parts) != raw or b"".join(b_parts) != raw:
                out.append(None)
                continue
            groups, i, j, at_a, at_b, first_a, first_b = [], 0, 0, 0, 0, 0, 0
            while i < len(a) or j < len(b):
                if at_a <= at_b and i < len(a):
                    at_a += len(a_parts[i])
                    i += 1
                else:
                    at_b += len(b_parts[j])
                    j += 1
                if at_a == at_b and i > first_a and j > first_b:
                    groups.append(f"{','.join(map(str, a[first_a:i]))}|{','.join(map(str, b[first_b:j]))}")
                    first_a, first_b = i, j
            out.append(";".join(groups))
        return out


_HELD: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(byte_level: str, pieces: str) -> Tokenizers:
    """One pair for each Python worker."""
    key = (byte_level, pieces)
    if key not in _HELD:
        _HELD[key] = Tokenizers(byte_level, pieces)
    return _HELD[key]


def segment_starts(data: np.ndarray, offsets: np.ndarray, splits: np.ndarray) -> np.ndarray:
    """Where segments begin in texts that lie end to end; each text begins one."""
    start = np.zeros(len(data) + 1, bool)
    at = np.flatnonzero(splits[data[:-1], data[1:]]) + 1 if len(data) > 1 else np.zeros(0, np.int64)
    wide = np.zeros(len(at), bool)
    for cp in WIDE_SPACES:
        raw = chr(cp).encode()
        hit = at >= len(raw)
        for k, byte in enumerate(raw):
            hit &= data[np.maximum(at - len(raw) + k, 0)] == byte
        wide |= hit
    start[at[~wide]] = True
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(start[: len(data)])


_ID = "doc_id"


def _packed(values: np.ndarray) -> bytes:
    """Small numbers, compressed: the lowest bytes of all, then the next ones."""
    return pa.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, 4 * n, codec="zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").reshape(-1).astype(np.int64)


def _row(schema: pa.Schema, **columns: object) -> pa.RecordBatch:
    """A batch of the columns given, null in all others."""
    given = {k: v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v, schema.field(k).type) for k, v in columns.items()}
    n = len(next(iter(given.values())))
    return pa.RecordBatch.from_arrays([given[f.name].cast(f.type) if f.name in given else pa.nulls(n, f.type) for f in schema], schema=schema)


def _whole_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _blocks(batches: Iterator[pa.RecordBatch], splits: np.ndarray, block_bytes: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """For each block a row with its documents: ids, how many segments each has, their numbers; and a row a distinct segment, the most frequent first."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in tk.chunks(batches, "text", block_bytes):
        block, seq = part << 32 | seq, seq + 1
        data, offsets = tk.text_bytes(batch.column("text"))
        starts = segment_starts(data, offsets, splits)
        bounds = np.append(starts, len(data)).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_utf8(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        numbers = coded.indices.to_numpy()
        order = np.argsort(-np.bincount(numbers, minlength=len(coded.dictionary)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        sizes = np.diff(np.searchsorted(starts, offsets))
        yield _row(schema, block=[block], ids=_whole_list(batch.column(_ID)), sizes=_whole_list(pa.array(sizes, pa.int32())), numbers=[_packed(rank[numbers])])
        distinct = coded.dictionary.take(pa.array(order))
        for s in range(0, len(distinct), _ROWS):
            own = distinct.slice(s, _ROWS)
            yield _row(schema, block=pa.array(np.full(len(own), block)), number=pa.array(np.arange(s, s + len(own))), segment=own.cast(pa.string()))


def _align(batches: Iterator[pa.RecordBatch], byte_level: str, pieces: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows sorted by segment: each distinct one is aligned once. Gives rows of some of a block's numbers and their alignments, a line each (empty where there is none), compressed."""
    pair = tokenizers(byte_level, pieces)
    last: tuple[str, str] | None = None

    def aligned(table: pa.Table) -> pa.RecordBatch:
        nonlocal last
        coded = table["segment"].combine_chunks().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = int(last is not None and distinct[0] == last[0])
        groups = [last[1]] if known else []
        for k in range(known, len(distinct), _ENCODED):
            groups += [g or "" for g in pair.align(distinct[k : k + _ENCODED])]
        last = (distinct[-1], groups[-1])
        index, block, number = coded.indices.to_numpy(), table["block"].to_numpy(), table["number"].to_numpy()
        order = np.lexsort((number, block))
        index, block, number = index[order], block[order], number[order]
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        lines = ["\n".join([groups[k] for k in own.tolist()]).encode() for own in np.split(index, cuts[1:])]
        rows = np.diff(np.append(cuts, len(block)))
        packed = [_packed(own) for own in np.split(number, cuts[1:])]
        return _row(schema, of=block[cuts], rows=rows, numbers=packed, size=[len(x) for x in lines], groups=[pa.compress(x, codec="zstd", asbytes=True) for x in lines])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= _ROWS:
            yield aligned(pa.Table.from_batches(held))
            held = []
    if held and sum(b.num_rows for b in held):
        yield aligned(pa.Table.from_batches(held))


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class _Parsed:
    """Segments' alignments as numbers: of each segment its tokens, groups and links, and all links in order of segments.

    Parsing takes some fifty bytes a byte, so it goes through the segments in steps.
    """

    def __init__(self, groups: pa.Array):
        parts = [self._part(b.column(0)) for b in tk.chunks(iter([pa.record_batch([groups], ["groups"])]), "groups", _PARSED_BYTES)]
        for k, name in enumerate((*_COUNTS, "links")):
            setattr(self, name, np.concatenate([np.zeros(0, np.int64), *[p[k] for p in parts]]))

    def _part(self, groups: pa.Array) -> tuple[np.ndarray, ...]:
        data, offsets = tk.text_bytes(groups)
        n = len(offsets) - 1
        digit = (data >= 48) & (data <= 57)
        at = np.arange(len(data))
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets[:-1]] = True
        begins = begins[:-1]
        before = np.concatenate([[False], digit[:-1]]) if len(data) else digit
        after = np.concatenate([digit[1:], [False]]) if len(data) else digit
        start = np.flatnonzero(digit & (~before | begins))
        last = np.concatenate([begins[1:], [True]]) if len(data) else digit
        size = np.flatnonzero(digit & (~after | last)) + 1 - start
        value = np.zeros(len(start), np.int64)
        for k in range(int(size.max(initial=0))):
            own = size > k
            value[own] = value[own] * 10 + data[start[own] + k] - 48
        owner = np.searchsorted(offsets, start, side="right") - 1
        semis = np.cumsum(data == ord(";"))
        new = np.maximum.accumulate(np.where((data == ord(";")) | begins, at, -1)) if len(data) else at
        bar = np.maximum.accumulate(np.where(data == ord("|"), at, -1)) if len(data) else at
        in_b = bar[start] > new[start]
        group = semis[start] + owner
        n_groups_all = int(group.max(initial=-1)) + 1
        in_group_a = np.bincount(group[~in_b], minlength=n_groups_all)
        in_group_b = np.bincount(group[in_b], minlength=n_groups_all)
        n_a, n_b = np.bincount(owner[~in_b], minlength=n), np.bincount(owner[in_b], minlength=n)
        has = np.diff(offsets) > 0
        ends = np.concatenate([[0], semis])[offsets]
        n_groups = np.where(has, np.diff(ends) + 1, 0)
        b_values = value[in_b]
        first_b = np.cumsum(in_group_b) - in_group_b
        a_values, a_group, a_owner = value[~in_b], group[~in_b], owner[~in_b]
        times = in_group_b[a_group]
        total = int(times.sum())
        inside = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
        links = np.repeat(a_values, times) << 32 | b_values[np.repeat(first_b[a_group], times) + inside]
        n_links = np.bincount(a_owner, weights=times, minlength=n).astype(np.int64)
        assert total == int((in_group_a * in_group_b).sum())
        return n_a, n_b, n_groups, n_links, links


def _spread(counts: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """firsts[i], firsts[i] + 1, ... counts[i] of them, for all i."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(firsts, counts)


def _compose(docs: pa.Table, segments: pa.Table, schema: pa.Schema, with_groups: bool) -> pa.Table:
    """A row with a block's documents, and their distinct pairs of linked ids (numbers in the block, as steps, and how often); and a row a pair with how many documents have it."""
    parts = [segments[c].to_pylist() for c in ("rows", "numbers", "size", "groups")]
    numbers = np.concatenate([np.zeros(0, np.int64), *[_unpacked(x, n) for n, x in zip(*parts[:2], strict=True)]])
    texts = [t for n, x in zip(*parts[2:], strict=True) for t in pa.decompress(x, n, codec="zstd", asbytes=True).decode().split("\n")]
    order = np.argsort(numbers)
    texts = [texts[k] for k in order.tolist()]
    parsed = _Parsed(pa.array(texts, pa.string()))
    bad = np.array([not t for t in texts], bool)
    sizes = docs["sizes"].combine_chunks().flatten().to_numpy()
    n = len(sizes)
    flat = _unpacked(docs["numbers"][0].as_py(), int(sizes.sum()))
    doc = np.repeat(np.arange(n), sizes)
    ok = sizes > 0
    ok[doc[bad[flat]]] = False
    has = ok[doc]
    doc, flat = doc[has], flat[has]
    counts = {c: np.bincount(doc, weights=getattr(parsed, c)[flat], minlength=n).astype(np.int64) for c in _COUNTS}
    bounds = np.searchsorted(doc, np.arange(n + 1))
    digests, whole = [], []
    for i in range(n):
        groups = ";".join([texts[k] for k in flat[bounds[i] : bounds[i + 1]].tolist()])
        digests.append(hashlib.sha256(groups.encode()).hexdigest() if ok[i] else "")
        if with_groups:
            whole.append(groups)
    del parts, texts
    # Distinct segments of each document, how often; then their links.
    key, often = np.unique(doc * max(len(bad), 1) + flat, return_counts=True)
    seg_doc, seg = np.divmod(key, max(len(bad), 1))
    first = np.cumsum(parsed.n_links) - parsed.n_links
    links = parsed.n_links[seg]
    pairs, local = np.unique(parsed.links, return_inverse=True)
    m = max(len(pairs), 1)
    ends = np.flatnonzero(np.diff(seg_doc, append=-1)) + 1  # of documents that have segments
    reach, at, keys, amounts = np.cumsum(links)[ends - 1], 0, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while at < len(ends):
        begin, before = (ends[at - 1], reach[at - 1]) if at else (0, 0)
        at = max(int(np.searchsorted(reach, before + _LINKED, side="right")), at + 1)
        own = slice(begin, ends[at - 1])
        key, slot = np.unique(np.repeat(seg_doc[own], links[own]) * m + local[_spread(links[own], first[seg[own]])], return_inverse=True)
        keys.append(key)
        amounts.append(np.bincount(slot, weights=np.repeat(often[own], links[own]), minlength=len(key)).astype(np.int64))
    key, times = np.concatenate(keys), np.concatenate(amounts)
    del keys, amounts
    held = np.bincount(key % m, minlength=len(pairs)) if len(pairs) else np.zeros(0, np.int64)
    used = np.flatnonzero(held)
    steps = np.diff(key, prepend=0) if len(key) else key  # of doc * m + pair, ascending
    block = docs["block"][0].as_py()
    columns = {c: _whole_list(pa.array(counts[c])) for c in _COUNTS} | ({"groups": _whole_list(pa.array(whole, pa.string()))} if with_groups else {})
    own = _row(schema, block=[block], ids=docs["ids"].combine_chunks(), groups_sha256=_whole_list(pa.array(digests, pa.string())), n_pairs=[len(pairs)], n_held=[len(key)], steps=[_packed_wide(steps)], times=[_packed_wide(times)], **columns)
    rest = _row(schema, block=pa.array(np.full(len(used), block)), number=pa.array(used), pair=pa.array(pairs[used]), n=pa.array(held[used]))
    return pa.Table.from_batches([own, rest])


def _packed_wide(values: np.ndarray) -> bytes:
    """Numbers that may be of over 32 bits: low and high halves."""
    return b"".join(len(part).to_bytes(8, "little") + part for part in (_packed(values & 0xFFFFFFFF), _packed(values >> 32)))


def _unpacked_wide(raw: bytes, n: int) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    return _unpacked(raw[8 : 8 + size], n) | _unpacked(raw[16 + size :], n) << 32


def _finish(docs: pa.Table, totals: pa.Table, schema: pa.Schema) -> pa.Table:
    """A row a document, with n_best and count_sum by the totals of the block's pairs."""
    m, size = docs["n_pairs"][0].as_py(), docs["n_held"][0].as_py()
    count, best = np.zeros(m, np.int64), np.zeros(m, np.int64)
    numbers = totals["number"].to_numpy()
    count[numbers], best[numbers] = totals["count"].to_numpy(), totals["best"].to_numpy()
    doc, pair = np.divmod(np.cumsum(_unpacked_wide(docs["steps"][0].as_py(), size)), max(m, 1))
    times = _unpacked_wide(docs["times"][0].as_py(), size)
    columns = {c: docs[c].combine_chunks().flatten() for c in ("ids", *_COUNTS, "groups_sha256", "groups") if c in docs.column_names}
    n = len(columns["ids"])
    n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(n_best, doc, best[pair] * times)
    np.add.at(count_sum, doc, count[pair] * times)
    columns |= {_ID: columns.pop("ids"), "n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
    return pa.table([columns[f.name].cast(f.type) for f in schema], schema=schema)


def align(docs: DataFrame, *, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text", with_groups: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; and with_groups, `groups` itself.

    A link is a pair of occurrences of an A and a B token in one group. Its count is the number of
    documents that hold its pair of ids linked; n_best is how many links have the highest count of
    their A id, count_sum the sum of all links' counts.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    splits = Tokenizers(byte_level, pieces).splits()
    whole = F.when(F.length(text) > 0, F.concat(F.lit(" "), F.col(text).cast("string")))
    given = docs.select(F.col(doc_id).alias(_ID), whole.alias("text"))
    kind = given.schema[_ID].dataType
    long, integer, string, raw, field, many = T.LongType(), T.IntegerType(), T.StringType(), T.BinaryType(), T.StructField, T.ArrayType
    cut = T.StructType([field("block", long), field("ids", many(kind)), field("sizes", many(integer)), field("numbers", raw), field("number", integer), field("segment", string)])
    blocks = written(given.mapInArrow(lambda it: _blocks(it, splits, block_bytes, to_arrow_schema(cut)), cut), "segments")
    rows, segments = blocks.where("number is null").select("block", "ids", "sizes", "numbers"), blocks.where("number is not null").select("block", "number", "segment")
    lined = T.StructType([field("of", long), field("rows", integer), field("numbers", raw), field("size", integer), field("groups", raw)])
    sorted_segments = segments.repartition(partitions(docs.sparkSession), "segment").sortWithinPartitions("segment")
    back = sorted_segments.mapInArrow(lambda it: _align(it, byte_level, pieces, to_arrow_schema(lined)), lined)
    of_docs = [*[field(c, many(long)) for c in _COUNTS], field("groups_sha256", many(string)), *([field("groups", many(string))] if with_groups else [])]
    made = T.StructType([field("block", long), field("ids", many(kind)), *of_docs, field("n_pairs", long), field("n_held", long), field("steps", raw), field("times", raw), field("number", integer), field("pair", long), field("n", long)])
    composed = rows.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(lambda d, s: _compose(d, s, to_arrow_schema(made), with_groups), made)
    composed = written(composed, "aligned")
    discard(blocks)
    pairs = composed.where("number is not null").select("block", "number", "pair", "n")
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    highest = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))  # a row a B id at most
    totals = totals.withColumn("best", (F.col("count") == highest).cast("long"))
    back = pairs.join(totals, "pair").select(F.col("block").alias("of"), "number", "count", "best")
    ends = T.StructType([field(_ID, kind), *[field(c, long) for c in (*_COUNTS, "n_best", "count_sum")], field("groups_sha256", string), *([field("groups", string)] if with_groups else [])])
    kept = composed.where("number is null").drop("number", "pair", "n")
    return kept.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(lambda d, t: _finish(d, t, to_arrow_schema(ends)), ends).withColumnRenamed(_ID, doc_id)
