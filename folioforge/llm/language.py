"""Language identification by words first, and by ever shorter character n-grams for words that are not known.

A word is a run of letters and marks in lower case; a run of over MAX_WORD characters is cut into
pieces of that length, so unspaced scripts have words too. Spark counts the words of all labelled
texts by language, and from the distinct words their n-grams of five characters down to one, with a
space before and after each word. The most frequent words and n-grams, as many as the model has
room for, are the known ones; the model's size is bounded by MODEL_CELLS and MAX_WORDS whatever the
corpus, so it is broadcast.

A known word adds its log frequency in each language. For any other word each place adds the log
frequency of the longest known n-gram that begins there, averaged over the word's places. A word
without any known n-gram says nothing. The mean of all words, taken as the evidence of at most
EVIDENCE_WORDS words, and the languages' shares of documents give the posterior, which is the score.

Nulls: a null text has no letter and is "und" with score 0, as is any text without a letter, and any
text where no language was learned. A null language is not learned from; a null id counts as an
empty one. Texts of any length are read whole. Rows are judged one by one, so repeated rows get the
same answer. Equal posteriors give the language that sorts first. An empty table gives no row; other
columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm import textkit as tk
from folioforge.llm.session import written

MAX_WORD = 24
ORDERS = (5, 4, 3, 2, 1)
#: Known words, and known n-grams, at most; and numbers held for either (a number a language).
MAX_WORDS = 200_000
MODEL_CELLS = 4_000_000
#: Languages that are learned, at most: those with most documents.
MAX_LANGUAGES = 1000
EVIDENCE_WORDS = 32
#: Added to each count.
ALPHA = 0.5
#: Bytes of text that are cut into words at once; a longer text is cut alone.
CHUNK_BYTES = 4 << 20
#: Distinct words whose n-grams are counted at once.
_COUNTED_WORDS = 200_000


class _Tables:
    """By code point: lower case, whether it belongs to words, whether it is a letter."""

    made: _Tables | None = None

    def __init__(self) -> None:
        kinds = np.array([ord(unicodedata.category(chr(cp))[0]) for cp in range(0x110000)], np.uint8)
        self.letter = kinds == ord("L")
        self.word = self.letter | (kinds == ord("M"))
        self.lower = np.arange(0x110000, dtype=np.uint32)
        for cp in np.flatnonzero(self.letter).tolist():
            low = chr(cp).lower()
            if len(low) == 1:
                self.lower[cp] = ord(low)


def _tables() -> _Tables:
    if _Tables.made is None:
        _Tables.made = _Tables()
    return _Tables.made


@dataclass
class Words:
    """distinct: the words; index: of each word of the texts in it; doc: its text; letters: of each text."""

    distinct: pa.Array
    index: np.ndarray
    doc: np.ndarray
    letters: np.ndarray


def find_words(column: pa.Array) -> Words:
    data, offsets = tk.text_bytes(column)
    tables = _tables()
    heads = (data & 0xC0) != 0x80
    bounds = np.concatenate([[0], np.cumsum(heads)])[offsets]
    low = tables.lower[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)]
    inside = tables.word[low]
    letters = np.diff(np.concatenate([[0], np.cumsum(tables.letter[low])])[bounds])
    edge = np.zeros(len(low) + 1, bool)
    edge[bounds] = True
    first = inside & (np.concatenate([[True], ~inside[:-1]]) | edge[:-1]) if len(low) else inside
    last = inside & (np.concatenate([~inside[1:], [True]]) | edge[1:]) if len(low) else inside
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    pieces = -(-(end - start) // MAX_WORD)
    run = np.repeat(np.arange(len(start)), pieces)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = start[run] + MAX_WORD * nth
    size = np.minimum(begin + MAX_WORD, end[run]) - begin
    flat = low[inside]
    wide = 1 + (flat >= 0x80).astype(np.int64) + (flat >= 0x800) + (flat >= 0x10000)
    ends = np.concatenate([[0], np.cumsum(wide)])[np.concatenate([[0], np.cumsum(size)])].astype(np.int64)
    words = pa.Array.from_buffers(pa.large_utf8(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(flat.tobytes().decode("utf-32-le").encode())])
    coded = words.dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy(), np.searchsorted(bounds, begin, side="right") - 1, letters)


def _grams(words: pa.Array) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """Words with a space on either side: the word of each place, and by order, places where an n-gram begins and
    their 64-bit hashes. A single space is none.
    """
    points = np.frombuffer((" " + "  ".join(words.to_pylist()) + " ").encode("utf-32-le"), np.uint32) if len(words) else np.zeros(0, np.uint32)
    word = np.repeat(np.arange(len(words)), pc.utf8_length(words).to_numpy(zero_copy_only=False) + 2)
    codes = tk.mix(points.astype(np.uint64) + np.uint64(1))
    out = []
    for n in ORDERS:
        here = np.flatnonzero(tk.windows_inside(word, n) & ((points[: max(len(points) - n + 1, 0)] != 32) | (n > 1)))
        out.append((n, here, tk.window_hashes(codes, n)[here]))
    return word, out


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _count_words(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    """word, lang (its number), n of the texts."""
    for batch in tk.chunks(batches, "text", CHUNK_BYTES):
        of_doc = pc.index_in(batch.column("lang"), value_set=pa.array(languages, batch.column("lang").type)).fill_null(-1).to_numpy(zero_copy_only=False)
        words = find_words(batch.column("text"))
        lang = of_doc[words.doc]
        key, n = np.unique(lang[lang >= 0].astype(np.int64) * max(len(words.distinct), 1) + words.index[lang >= 0], return_counts=True)
        lang, index = np.divmod(key, max(len(words.distinct), 1))
        yield pa.RecordBatch.from_arrays([words.distinct.take(pa.array(index)).cast(pa.string()), pa.array(lang), pa.array(n)], ["word", "lang", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch], n_languages: int) -> Iterator[pa.RecordBatch]:
    """gram (its hash), size, lang, n: each distinct word of a language counts once, and once more for each doubling of its number."""

    def counted(table: pa.Table) -> Iterator[pa.RecordBatch]:
        word, orders = _grams(table["word"].combine_chunks())
        lang = table["lang"].to_numpy()
        weight = np.frexp(table["n"].to_numpy().astype(np.float64))[1].astype(np.int64)
        for n, here, hashes in orders:
            distinct, back = np.unique(hashes, return_inverse=True)
            key, slot = np.unique(back * n_languages + lang[word[here]], return_inverse=True)
            total = np.bincount(slot, weights=weight[word[here]], minlength=len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([_signed(distinct[key // n_languages]), pa.array(np.full(len(key), n, np.int32)), pa.array(key % n_languages), pa.array(total)], ["gram", "size", "lang", "n"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= _COUNTED_WORDS:
            yield from counted(pa.Table.from_batches(held))
            held = []
    if held:
        yield from counted(pa.Table.from_batches(held))


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray  # log shares of documents
    words: pa.Array
    word_scores: np.ndarray  # a row a word, a column a language
    grams: np.ndarray  # hashes, ascending
    gram_scores: np.ndarray


def _frequent(counts: DataFrame, key: list[str], room: int) -> DataFrame:
    """Rows of counts whose key's total is among the highest, at most `room` keys: those from a level of totals upwards.

    Levels are sixteenths of a doubling, so however many keys there are, under a thousand levels reach the driver.
    """
    per_key = counts.groupBy(*key).agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by_lang"))
    level = F.floor(F.log2("total") * 16).cast("int")
    levelled = written(per_key.select(*key, "by_lang", level.alias("level")), "known")
    sizes = sorted(((r["level"], r["count"]) for r in levelled.groupBy("level").count().collect()), reverse=True)
    lowest, taken = None, 0
    for at, n in sizes:
        if taken + n > room:
            break
        lowest, taken = at, taken + n
    return levelled.where(F.col("level") >= lowest if lowest is not None else F.lit(False)).select(*key, "by_lang")


def _scores(rows: pa.Table, total: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Log frequencies: rows by_lang; total and distinct: what each row's counts are held against, a row a row."""
    lists = rows["by_lang"].combine_chunks()
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    counts = np.zeros(total.shape)
    counts[row, flat.field("lang").to_numpy()] = flat.field("n").to_numpy()
    return np.log((counts + ALPHA) / (total + ALPHA * distinct[:, None])).astype(np.float32)


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang", max_words: int = MAX_WORDS, model_cells: int = MODEL_CELLS) -> Model | None:
    """The model of all rows with a language; None where there is none."""
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null")
    shares = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not shares:
        return None
    shares.sort()
    languages = [r["lang"] for r in shares]
    k = len(languages)
    documents = np.array([r["count"] for r in shares], np.float64)
    room = max(1, min(max_words, model_cells // k))
    raw = labelled.mapInArrow(lambda it: _count_words(it, languages), "word string, lang bigint, n bigint")
    words = written(raw.groupBy("word", "lang").agg(F.sum("n").alias("n")), "words")
    grams = words.mapInArrow(lambda it: _count_grams(it, k), "gram bigint, size int, lang bigint, n bigint").groupBy("gram", "size", "lang").agg(F.sum("n").alias("n"))
    grams = written(grams, "grams")

    def totals(counts: DataFrame, key: list[str], by: list[str]) -> tuple[dict, dict]:
        sums = {tuple(r[c] for c in (*by, "lang")): r["n"] for r in counts.groupBy(*by, "lang").agg(F.sum("n").alias("n")).collect()}
        kinds = {tuple(r[c] for c in by): r["n"] for r in counts.select(*key).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("n")).collect()}
        return sums, kinds

    known = _frequent(words, ["word"], room).toArrow()
    sums, kinds = totals(words, ["word"], [])
    total = np.array([sums.get((j,), 0) for j in range(k)], np.float64)
    word_scores = _scores(known, np.broadcast_to(total, (known.num_rows, k)), np.full(known.num_rows, kinds.get((), 0), np.float64))
    parts = _frequent(grams, ["gram", "size"], room).toArrow().sort_by("gram")
    sums, kinds = totals(grams, ["gram", "size"], ["size"])
    size = parts["size"].to_numpy()
    total = np.array([[sums.get((n, j), 0) for j in range(k)] for n in range(max(ORDERS) + 1)], np.float64)
    kind = np.array([kinds.get((n,), 0) for n in range(max(ORDERS) + 1)], np.float64)
    gram_scores = _scores(parts, total[size], kind[size])
    hashes = parts["gram"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Model(languages, np.log(documents / documents.sum()), known["word"].combine_chunks().cast(pa.large_utf8()), word_scores, hashes[order], gram_scores[order])


def _unknown_scores(model: Model, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Scores of words by their longest known n-grams, and which of them have any."""
    word, orders = _grams(words)
    found = np.full(len(word), -1, np.int64)
    if len(model.grams):
        for _, here, hashes in orders:
            free = found[here] < 0
            here, hashes = here[free], hashes[free]
            at = np.minimum(np.searchsorted(model.grams, hashes), len(model.grams) - 1)
            hit = model.grams[at] == hashes
            found[here[hit]] = at[hit]
    places = np.flatnonzero(found >= 0)
    scores = np.zeros((len(words), len(model.languages)))
    n = np.bincount(word[places], minlength=len(words)) if len(words) else np.zeros(0, np.int64)
    for j in range(len(model.languages)):
        scores[:, j] = np.bincount(word[places], weights=model.gram_scores[found[places], j], minlength=len(words))
    some = n > 0
    scores[some] /= n[some, None]
    return scores, some


def judge(model: Model | None, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    words = find_words(column)
    n_docs = len(column)
    if model is None:
        return ["und"] * n_docs, np.zeros(n_docs)
    k = len(model.languages)
    scores, tells = np.zeros((len(words.distinct), k)), np.ones(len(words.distinct), bool)
    known = pc.index_in(words.distinct, value_set=model.words).fill_null(-1).to_numpy(zero_copy_only=False)
    scores[known >= 0] = model.word_scores[known[known >= 0]]
    rest = np.flatnonzero(known < 0)
    scores[rest], tells[rest] = _unknown_scores(model, words.distinct.take(pa.array(rest)))
    n = np.bincount(words.doc[tells[words.index]], minlength=n_docs)
    sums = np.stack([np.bincount(words.doc, weights=scores[words.index, j], minlength=n_docs) for j in range(k)], axis=1)
    evidence = sums * (np.minimum(n, EVIDENCE_WORDS) / np.maximum(n, 1))[:, None] + model.prior
    best = evidence.argmax(axis=1)
    shifted = np.exp(evidence - evidence.max(axis=1, keepdims=True))
    score = 1 / shifted.sum(axis=1)
    none = words.letters == 0
    return ["und" if none[i] else model.languages[b] for i, b in enumerate(best.tolist())], np.where(none, 0.0, score)


def predict(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """docs without the text, and lang_pred and score. The answer depends on the text alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in (text, "lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tk.chunks(batches, text, CHUNK_BYTES):
            lang, score = judge(held.value, batch.column(text))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(lang, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    given = docs.select(*names, text)
    out = T.StructType([*[given.schema[c] for c in names], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return given.mapInArrow(run, out)


def identify(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the texts and languages of rows outside the fold that is held out."""
    held = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == 0
    rows = docs.select(F.col(doc_id).alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    model = fit(rows.where(~F.col("held_out")))
    return predict(rows.select("doc_id", "held_out", "text"), model)
