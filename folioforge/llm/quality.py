"""Quality classifier: document evidence combined with host and path posteriors by empirical Bayes.

Document evidence. Two logistic models, for low quality and for toxicity, are fitted on the driver
on at most MAX_LABELLED labelled documents (those with the smallest hashes of their ids). Features
are the presence of words and of word beginnings, and the shape of the text (share of signs,
capitals, bars, sign runs, immediate repeats, distinct words, length). Features are counted and
chosen by their G2 statistic in Spark; the driver gets the chosen ones, and for each labelled
document which of them it has, so what it holds does not grow with the length of texts.

Hierarchy. A host's posterior is the share of low (toxic) documents among its labelled ones, shrunk
toward the share of all labelled ones; a path's is that of the labelled documents of its host and
language, shrunk toward its host's. The language stands for the path's section, as documents have
no URL. The strengths are moment estimates over all hosts and paths, so sparse sites fall back on
their parents, and sites without labels take their host's or the global share. All labels count
here, in grouped sums. The evidence of the text and of the site's labels are apart: a document's
final log odds are its own, plus the log odds of its path's posterior less those of all documents.

Nulls: a null text is empty; a null host or language is a site of its own; labels that are null
or belong to no document are ignored. With fewer than 20 labels, or labels of one kind only, that model
finds nothing: its chance is 0 and rejects no document. An empty table gives an empty result.
Repeated rows are scored each, and rejected each: the decision stays with its row. A label counts
for each row that has its id. Other columns are carried on untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm import textkit as tk
from folioforge.llm.session import discard, written

KINDS = ("low", "toxic")

#: Labelled documents that are fitted on at most.
MAX_LABELLED = 6000
FEATURES = 400
#: Labelled documents that have a feature at least, and its least G2 statistic.
LEAST_SEEN, LEAST_G2 = 4, 6
PREFIX_BYTES = (4, 5, 6, 8)
N_SHAPES = 8
#: Labels without which nothing is fitted.
LEAST_LABELS = 20
_BITS = np.uint64(40)


def _tokens(words: tk.Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and 24-bit feature of each word and word beginning."""
    docs, feats = [words.doc], [words.hash]
    for k in PREFIX_BYTES:
        longer = np.flatnonzero(words.end - words.start > k)
        docs.append(words.doc[longer])
        feats.append(tk.mix(tk.span_hashes(words.low, words.start[longer], words.start[longer] + k) + np.uint64(k)))
    return np.concatenate(docs), (np.concatenate(feats) >> _BITS).astype(np.int64)


def _shapes(data: np.ndarray, offsets: np.ndarray, words: tk.Words, spaced: tk.Words) -> np.ndarray:
    n = len(offsets) - 1

    def count(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets]).astype(float)

    size = np.maximum(np.diff(offsets), 1)
    letters = (data >= 97) & (data <= 122) | (data >= 0xC3)
    capitals = (data >= 65) & (data <= 90)
    signs = (data > 32) & (data < 127) & ~letters & ~capitals & ~((data >= 48) & (data <= 57))
    runs = signs.copy()
    runs[1:] &= data[1:] == data[:-1]
    runs[:1] = False
    tokens = np.maximum(spaced.counts, 1)
    again = np.zeros(len(spaced.hash), bool)
    again[1:] = (spaced.hash[1:] == spaced.hash[:-1]) & (spaced.doc[1:] == spaced.doc[:-1])
    order = np.lexsort((spaced.hash, spaced.doc))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (spaced.hash[order][1:] != spaced.hash[order][:-1]) | (spaced.doc[order][1:] != spaced.doc[order][:-1])
    distinct = np.bincount(spaced.doc[order][fresh], minlength=n)
    return np.stack(
        [
            count(signs) / size,
            count(capitals) / np.maximum(count(capitals) + count(letters), 1),
            count(data == 124) / tokens,
            count(runs) / tokens,
            np.bincount(spaced.doc[again], minlength=n) / tokens,
            distinct / tokens,
            np.log1p(spaced.counts),
            np.log1p(tokens) * distinct / tokens,
        ],
        axis=1,
    )


def _measure(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = tk.text_bytes(column)
    words, spaced = tk.find_words(data, offsets, tk.ALNUM_WORDS), tk.find_words(data, offsets, tk.SPACED_WORDS)
    return (*_tokens(words), _shapes(data, offsets, words, spaced))


@dataclass
class Logistic:
    """Weights of presence features (sorted), of shapes after scaling, and the intercept."""

    prior: float = -12.0
    features: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    shape_mean: np.ndarray = field(default_factory=lambda: np.zeros(N_SHAPES))
    shape_scale: np.ndarray = field(default_factory=lambda: np.ones(N_SHAPES))
    shape_weights: np.ndarray = field(default_factory=lambda: np.zeros(N_SHAPES))

    @classmethod
    def fitted(cls, features: np.ndarray, docs: np.ndarray, columns: np.ndarray, shapes: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Logistic:
        """features: the chosen ones, sorted. docs and columns: distinct pairs of a text and a feature's place. Newton's method with a ridge."""
        n, positive = len(y), int(y.sum())
        if n < LEAST_LABELS or not 0 < positive < n:
            return cls()
        x = np.zeros((n, len(features) + N_SHAPES + 1))
        x[docs, columns] = 1
        mean, scale = shapes.mean(0), shapes.std(0) + 1e-6
        x[:, len(features) : -1] = (shapes - mean) / scale
        x[:, -1] = 1
        w = np.zeros(x.shape[1])
        w[-1] = np.log(positive / (n - positive))
        penalty = np.full(len(w), ridge)
        penalty[-1] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
            w += np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-6:
                break
        return cls(w[-1], features, w[: len(features)], mean, scale, w[len(features) : -1])

    def log_odds(self, docs: np.ndarray, feats: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        out = self.prior + (shapes - self.shape_mean) / self.shape_scale @ self.shape_weights
        if len(self.features) and len(feats):
            at = np.minimum(np.searchsorted(self.features, feats), len(self.features) - 1)
            hit = self.features[at] == feats
            pairs = np.unique(docs[hit] * len(self.features) + at[hit])
            out += np.bincount(pairs // len(self.features), weights=self.weights[pairs % len(self.features)], minlength=len(shapes))
        return np.clip(out, -12, 12)


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over a batch: of each feature, the labelled documents that have it, and those of them that are low and toxic."""
    for batch in tk.chunks(batches, "text"):
        docs, feats, _ = _measure(batch.column("text"))
        pairs = np.unique(docs << 24 | feats)
        feats, docs = pairs & 0xFFFFFF, pairs >> 24
        distinct, back = np.unique(feats, return_inverse=True)
        sums = [np.bincount(back, minlength=len(distinct))] + [np.bincount(back, weights=np.asarray(batch.column(y))[docs], minlength=len(distinct)) for y in KINDS]
        yield pa.RecordBatch.from_arrays([pa.array(distinct.astype(np.int32)), *(pa.array(x.astype(np.int64)) for x in sums)], ["feature", "n", *KINDS])


def _examples(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The places of the chosen features that each text has, and its shape."""
    for batch in tk.chunks(batches, "text"):
        docs, feats, shapes = _measure(batch.column("text"))
        at = np.minimum(np.searchsorted(chosen, feats), max(len(chosen) - 1, 0))
        hit = chosen[at] == feats if len(chosen) else np.zeros(len(feats), bool)
        pairs = np.unique(docs[hit] << 24 | at[hit])
        bounds = np.searchsorted(pairs, np.arange(batch.num_rows + 1) << 24)
        yield pa.RecordBatch.from_arrays(
            [batch.column("low"), batch.column("toxic"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array((pairs & 0xFFFFFF).astype(np.int16))), pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * N_SHAPES), pa.array(shapes.reshape(-1)))],
            ["low", "toxic", "places", "shapes"],
        )


def _g2(kind: str, n: int, positive: int) -> Column:
    """The G2 statistic of a feature and a label, from the counts of documents."""
    out = F.lit(0.0)
    for seen, row, col in [(F.col(kind), F.col("n"), positive), (F.col("n") - F.col(kind), F.col("n"), n - positive), (F.lit(positive) - F.col(kind), F.lit(n) - F.col("n"), positive), (F.lit(n - positive) - F.col("n") + F.col(kind), F.lit(n) - F.col("n"), n - positive)]:
        out = out + F.when(seen > 0, 2.0 * seen * F.log(seen * F.lit(float(n)) / (row * F.lit(float(col))))).otherwise(0.0)
    return out


def _valid(labels: DataFrame) -> DataFrame:
    """label_id, low, toxic: one row an id."""
    known = labels.where("quality is not null and toxic is not null and doc_id is not null")
    return known.select(F.col("doc_id").cast("long").alias("label_id"), (F.col("quality") == 0).cast("int").alias("low"), (F.col("toxic") == 1).cast("int").alias("toxic")).groupBy("label_id").agg(F.max("low").alias("low"), F.max("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED, n_features: int = FEATURES) -> dict[str, Logistic]:
    """Models "low" and "toxic" from labels (doc_id, quality, toxic)."""
    chosen = _valid(labels).orderBy(F.xxhash64("label_id")).limit(max_labelled)
    known = written(docs.select(F.col(f"`{doc_id}`").cast("long").alias("label_id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(chosen), "label_id").select("low", "toxic", "text"), "labelled")  # at most max_labelled rows
    total = known.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(y), F.lit(0)).alias(y) for y in KINDS]).first()
    if total["n"] < LEAST_LABELS:
        discard(known)
        return {y: Logistic() for y in KINDS}
    counts = known.mapInArrow(_feature_counts, "feature int, n bigint, low bigint, toxic bigint").groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(y).alias(y) for y in KINDS]).where(F.col("n") >= LEAST_SEEN)
    best = counts.select("feature", *[_g2(y, total["n"], total[y]).alias(y) if 0 < total[y] < total["n"] else F.lit(0.0).alias(y) for y in KINDS]).where(F.greatest(*KINDS) > LEAST_G2)
    best = written(best, "features")
    features = {y: np.array(sorted(r[0] for r in best.where(F.col(y) > LEAST_G2).orderBy(F.col(y).desc(), "feature").limit(n_features).select("feature").collect()), np.int64) for y in KINDS}
    every = np.union1d(features["low"], features["toxic"])
    table = known.mapInArrow(lambda it: _examples(it, every), "low int, toxic int, places array<smallint>, shapes array<double>").toArrow().combine_chunks()
    discard(known, best)
    places = table["places"].combine_chunks()
    rows = np.repeat(np.arange(table.num_rows), np.asarray(places.value_lengths()))
    held = every[np.asarray(places.flatten()).astype(np.int64)]
    shapes = np.asarray(table["shapes"].combine_chunks().flatten()).reshape(-1, N_SHAPES)
    models = {}
    for y in KINDS:
        own = np.isin(held, features[y])
        models[y] = Logistic.fitted(features[y], rows[own], np.searchsorted(features[y], held[own]), shapes, np.asarray(table[y]).astype(float))
    return models


def _score(batches: Iterator[pa.RecordBatch], models: dict[str, Logistic], text: str, keep_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in tk.chunks(batches, text):
        measured = _measure(batch.column(text))
        names = [c for c in batch.schema.names if keep_text or c != text]
        odds = [pa.array(models[y].log_odds(*measured)) for y in KINDS]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *odds], [*names, *KINDS])


def _chance(odds: Column | str) -> Column:
    return 1 / (1 + F.exp(-F.col(odds) if isinstance(odds, str) else -odds))


def _odds(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, mean: str, parent: Column, n: str) -> float:
    """Moment estimate of how many documents the parent's mean is worth."""
    row = groups.agg(F.sum(F.col(n) * (F.col(mean) - parent) ** 2).alias("between"), F.sum(parent * (1 - parent)).alias("within"), F.sum(F.col(n) * parent * (1 - parent)).alias("total"), F.sum(n).alias("n")).first()
    if not row["n"] or not row["total"]:
        return 1e6
    excess = (row["between"] - row["within"]) / row["n"]
    level = row["total"] / row["n"]
    return min(1e6, max(1.0, level / excess - 1)) if excess > 1e-12 else 1e6


def site_posteriors(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", host: str = "source", lang: str = "lang") -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """Hosts (host, host_low, host_toxic), paths (host, lang, path_low, path_toxic), and the shares of all labelled documents."""
    narrow = docs.select(F.col(f"`{doc_id}`").cast("long").alias("label_id"), F.col(f"`{host}`").cast("string").alias("host"), F.col(f"`{lang}`").cast("string").alias("lang"))
    paths = narrow.join(_valid(labels), "label_id").groupBy("host", "lang").agg(F.count(F.lit(1)).alias("n"), *[F.sum(y).alias(f"{y}_sum") for y in KINDS])
    counts = paths = written(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), *[F.sum(f"{y}_sum").alias(f"host_{y}_sum") for y in KINDS])
    every = hosts.agg(F.sum("host_n").alias("n"), *[F.sum(f"host_{y}_sum").alias(y) for y in KINDS]).first()
    means = {y: every[y] / every["n"] if every["n"] else 0.5 for y in KINDS}
    for y in KINDS:
        k = _strength(hosts.withColumn("m", F.col(f"host_{y}_sum") / F.col("host_n")), "m", F.lit(means[y]), "host_n")
        hosts = hosts.withColumn(f"host_{y}", (F.col(f"host_{y}_sum") + k * means[y]) / (F.col("host_n") + k))
    paths = paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")))
    for y in KINDS:
        k = _strength(paths.withColumn("m", F.col(f"{y}_sum") / F.col("n")), "m", F.col(f"host_{y}"), "n")
        paths = paths.withColumn(f"path_{y}", (F.col(f"{y}_sum") + k * F.col(f"host_{y}")) / (F.col("n") + k))
    paths = written(paths.select("host", "lang", *[f"path_{y}" for y in KINDS]), "sites")
    hosts = written(hosts.select("host", *[f"host_{y}" for y in KINDS]), "hosts")
    discard(counts)
    return hosts, paths, means


def _combined(scored: DataFrame, host: Column, lang: Column, sites: tuple[DataFrame, DataFrame, dict[str, float]], threshold: float) -> DataFrame:
    """scored (low and toxic are log odds) and host_*, path_*, chance_*, __kept. Sites without labels take their parents' shares."""
    hosts, paths, means = sites
    out = scored.join(hosts.withColumnRenamed("host", "__h"), host.eqNullSafe(F.col("__h")), "left").join(paths.withColumnsRenamed({"host": "__ph", "lang": "__pl"}), host.eqNullSafe(F.col("__ph")) & lang.eqNullSafe(F.col("__pl")), "left")
    for y in KINDS:
        out = out.withColumn(f"host_{y}", F.coalesce(f"host_{y}", F.lit(means[y]))).withColumn(f"path_{y}", F.coalesce(f"path_{y}", f"host_{y}"))
        out = out.withColumn(f"chance_{y}", _chance(F.col(y) + _odds(F.col(f"path_{y}")) - _odds(F.lit(means[y]))))
    return out.withColumn("__kept", (F.col("chance_low") < threshold) & (F.col("chance_toxic") < threshold))


def classify(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: str = "source", lang: str = "lang", threshold: float = 0.5, **options) -> DataFrame:
    """Per document: doc_id, host, lang (the path's section), evidence, site posteriors, final chances, kept.

    kept: both the final chance of low quality and that of toxicity are below the threshold.
    """
    models = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id=doc_id, text=text, **options))  # a few thousand numbers
    sites = site_posteriors(docs, labels, doc_id=doc_id, host=host, lang=lang)
    narrow = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{host}`").cast("string").alias("host"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    scored = narrow.mapInArrow(lambda it: _score(it, models.value, "text", False), "doc_id bigint, host string, lang string, low double, toxic double")
    final = _combined(scored, F.col("host"), F.col("lang"), sites, threshold)
    return final.select(
        F.col("doc_id").alias(doc_id), "host", "lang",
        _chance("low").alias("evidence_low"), _chance("toxic").alias("evidence_toxic"),
        "host_low", "host_toxic", "path_low", "path_toxic", "chance_low", "chance_toxic", F.col("__kept").alias("kept"),
    )


def accepted(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: str = "source", lang: str = "lang", threshold: float = 0.5, **options) -> DataFrame:
    """docs, with the same columns, without the documents that the classifier rejects.

    Rows are scored with all their columns, so that no decision has to find its row again.
    """
    models = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id=doc_id, text=text, **options))  # a few thousand numbers
    sites = site_posteriors(docs, labels, doc_id=doc_id, host=host, lang=lang)
    place = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    named = docs.select(*[F.col(f"`{c}`").alias(p) for c, p in place.items()])
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in named.schema], *[T.StructField(y, T.DoubleType()) for y in KINDS]])
    scored = named.mapInArrow(lambda it: _score(it, models.value, place[text], True), schema)
    final = _combined(scored, F.col(place[host]).cast("string"), F.col(place[lang]).cast("string"), sites, threshold)
    return final.where("__kept").select(*[F.col(p).alias(c) for c, p in place.items()])
