"""Near-duplicate documents by MinHash with tensored banding, confirmed on full sets.

Texts are lower-cased (A-Z) and cut at white space; a document's set is its distinct shingles of
`words` consecutive words, or its whole sequence where it has fewer. Two documents are linked when
100 * intersection >= `percent` * union.

Tensored banding: each document has two collections of `collection` small keys, each made of two
minhashes. Table (i, j) is keyed by key i of the first and key j of the second collection, so
collection**2 tables cost 4 * collection minhashes. With 10 keys a side a pair at similarity 0.8
is missed with a probability of 2 * 0.36**10 < 0.0001, and far less above it. Before tables are
formed, keys that no other document has are dropped, which loses no pair.

Equal sets are one class from the start. Within a table's group every member is held against the
group's smallest member only. Groups that still span several components are gathered into clusters
(documents that such groups connect). A cluster's members outside its largest component are held
against all others of other components through an inverted index of the members' sets, without
making pairs. A cluster of more than CLUSTER_SHINGLES shingles is cut along the small keys of the
first collection, and what is still larger into blocks of which each pair is one task, so that
memory is bounded and no group is capped, sampled or dropped.

Nulls and empty texts have an empty set and are linked with nothing. Rows without an id are kept
and belong to no component (null). Rows that repeat an id are judged each by its own text; of the
rows with a component's smallest id all stay. An empty table gives an empty result. Other columns
take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm import textkit as tk
from folioforge.llm.components import components
from folioforge.llm.session import discard, written

SHINGLE_WORDS = 5
PERCENT = 80
COLLECTION = 10
#: Shingles that a task holds at once when it looks for links across the components of a cluster.
CLUSTER_SHINGLES = 2_000_000


def shingles(words: tk.Words, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    whole = tk.window_hashes(words.hash, n)
    first = np.concatenate([[0], np.cumsum(words.counts)])
    out = []
    for i, count in enumerate(words.counts.tolist()):
        s = int(first[i])
        if count >= n:
            out.append(np.unique(whole[s : s + count - n + 1]))
        elif count:
            out.append(tk.window_hashes(words.hash[s : s + count], count))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _seeds(m: int) -> tuple[np.ndarray, np.ndarray]:
    x = tk.mix(np.arange(1, 8 * m + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    return x[: 4 * m], x[4 * m :] | np.uint64(1)


def _sketches(batches: Iterator[pa.RecordBatch], words: int, m: int) -> Iterator[pa.RecordBatch]:
    """Id, mark of the text, set size, 128-bit digest of the set, and the 2 * m small keys."""
    xors, muls = _seeds(m)
    place = np.arange(2 * m, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)
    for batch in tk.chunks(batches, "text"):
        sets = shingles(tk.find_words(*tk.text_bytes(batch.column("text")), tk.SPACED_WORDS), words)
        sizes = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(sizes)
        digest = np.zeros((2, len(sets)), np.uint64)
        keys = np.zeros((len(sets), 2 * m), np.uint64)
        if len(full):
            flat = np.concatenate([sets[i] for i in full])
            at = np.cumsum(sizes[full]) - sizes[full]
            digest[0, full] = tk.mix(np.add.reduceat(tk.mix(flat ^ np.uint64(0x5851F42D4C957F2D)), at) ^ sizes[full].astype(np.uint64))
            digest[1, full] = np.add.reduceat(tk.mix(flat + np.uint64(0x14057B7EF767814F)), at)
            lows = np.empty((len(full), 4 * m), np.uint64)
            for f in range(4 * m):
                lows[:, f] = np.minimum.reduceat((flat ^ xors[f]) * muls[f], at)
            keys[full] = tk.mix(tk.mix(lows[:, 0::2] + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F) + lows[:, 1::2] + place)
        values = pa.array(keys.view(np.int64).reshape(-1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("mark"), pa.array(sizes), pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)), pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (2 * m)), values)],
            ["doc_id", "mark", "n_shingles", "d1", "d2", "keys"],
        )


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in tk.chunks(batches, "text"):
        sets = shingles(tk.find_words(*tk.text_bytes(batch.column("text")), tk.SPACED_WORDS), words)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "set"])


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets are as similar as asked for."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        last, left = None, None
        for k, (x, y) in enumerate(zip(batch.column("set_u"), batch.column("set_v"), strict=True)):
            y = y.as_py()
            if y != last:
                last, left = y, np.frombuffer(y, np.uint64)
            right = np.frombuffer(x.as_py(), np.uint64)
            both = int(np.isin(right, left, assume_unique=True).sum()) if len(left) + len(right) < 64 else len(left) + len(right) - len(np.union1d(left, right))
            keep[k] = 100 * both >= percent * (len(left) + len(right) - both)
        yield batch.select(["u", "v"]).filter(pa.array(keep))


def _across(group: pa.Table, percent: int) -> pa.Table:
    """Links between members of different components, as few as join those components.

    Members outside the largest component ask, one by one, an inverted index of all sets for the
    size of each intersection.
    """
    ids, component = np.asarray(group["id"]), np.asarray(group["component"])
    sets = [np.frombuffer(x.as_py(), np.uint64) for x in group["set"]]
    sizes = np.array([len(x) for x in sets])
    names, own = np.unique(component, return_inverse=True)
    label = np.arange(len(names))  # components that links have joined get one label
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    largest = np.bincount(own).argmax()
    out: list[tuple[int, int]] = []
    for q in np.flatnonzero(own != largest).tolist():
        low, high = np.searchsorted(flat, sets[q], side="left"), np.searchsorted(flat, sets[q], side="right")
        length = high - low
        hits = owner[np.arange(int(length.sum())) + np.repeat(low - (np.cumsum(length) - length), length)]
        both = np.bincount(hits, minlength=len(sets))
        for m in np.flatnonzero((100 * both >= percent * (sizes + sizes[q] - both)) & (own != own[q])).tolist():
            x, y = label[own[q]], label[own[m]]
            if x != y:
                label[label == x] = y
                out.append((max(ids[q], ids[m]), min(ids[q], ids[m])))
    return pa.table({"u": pa.array([u for u, _ in out], pa.int64()), "v": pa.array([v for _, v in out], pa.int64())})


def _cluster_links(members: DataFrame, keys: DataFrame, sets: DataFrame, percent: int, limit: int) -> DataFrame:
    """members: id, size, component, cluster. Links across the components of each cluster."""

    def sized(rows: DataFrame) -> DataFrame:
        totals = rows.groupBy("group").agg(F.sum("size").alias("total"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("group", "total")
        return rows.join(totals, "group")

    whole = sized(members.withColumn("group", F.xxhash64("cluster")))
    small = whole.where(F.col("total") <= limit).select("id", "component", "group")
    cut = sized(whole.where(F.col("total") > limit).select("id", "size", "component", "cluster").join(keys, "id").select("id", "size", "component", F.xxhash64("cluster", "x").alias("group")))
    fitting = cut.where(F.col("total") <= limit).select("id", "component", "group")
    blocks = F.ceil(F.col("total") * 2 / limit).cast("int")
    blocked = cut.where(F.col("total") > limit).withColumn("n", blocks).withColumn("b", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    blocked = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select("id", "component", F.xxhash64("group", F.least("b", "other"), F.greatest("b", "other")).alias("group"))
    groups = small.unionByName(fitting).unionByName(blocked).join(sets, "id").select("id", "component", "group", "set")
    return groups.groupBy("group").applyInArrow(lambda g: _across(g, percent), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, percent: int = PERCENT, collection: int = COLLECTION, cluster_shingles: int = CLUSTER_SHINGLES) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, class_id (smallest id with the same set)."""
    return _judged(docs, doc_id, text, words, percent, collection, cluster_shingles).select(F.col("doc_id").alias(doc_id), "n_shingles", "component_id", "kept", "class_id")


def _mark(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(text)


def _judged(docs: DataFrame, doc_id: str, text: str, words: int, percent: int, collection: int, cluster_shingles: int) -> DataFrame:
    """near_duplicates, and the mark of each row's text. Classes of equal sets go by numbers of their own until the end."""
    m = collection
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _mark(F.col(text)).alias("mark"), F.col(text).alias("text"))
    sketch = written(docs.mapInArrow(lambda it: _sketches(it, words, m), "doc_id bigint, mark bigint, n_shingles bigint, d1 bigint, d2 bigint, keys array<bigint>"), "sketch")
    classes = sketch.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "mark")).alias("head"), F.first("n_shingles").alias("size"), F.first("keys").alias("keys"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("id"), "d1", "d2", "head.doc_id", "head.mark", "size", "keys"), "classes")

    single = classes.select("id", F.posexplode("keys").alias("at", "key"))
    shared = single.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    live = single.join(shared, "key").groupBy("id").agg(F.collect_list(F.when(F.col("at") < m, F.col("key"))).alias("a"), F.collect_list(F.when(F.col("at") >= m, F.col("key"))).alias("b"))
    live = written(live.where("size(a) > 0 and size(b) > 0").join(classes.select("id", "size"), "id"), "live")
    tables = live.select("id", "size", F.explode("a").alias("x"), "b").select("id", "size", "x", F.explode("b").alias("y")).select("id", "size", F.xxhash64("x", "y").alias("key"))
    heads = tables.groupBy("key").agg(F.min(F.struct("id", "size")).alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.col("head.id").alias("v"), F.col("head.size").alias("size_v"))
    stars = written(tables.join(heads, "key").select("key", F.col("id").alias("u"), "v", F.col("size").alias("size_u"), "size_v"), "stars")

    held = stars.select(F.col("u").alias("id")).distinct().join(classes.select("id", "doc_id", "mark"), "id")
    texts = docs.join(held, ["doc_id", "mark"]).dropDuplicates(["id"]).select("id", "text")
    sets = written(texts.mapInArrow(lambda it: _sets(it, words), "id bigint, set binary"), "sets")

    pairs = stars.where(f"u > v and 100 * least(size_u, size_v) >= {percent} * greatest(size_u, size_v)").select("u", "v").distinct()
    both = pairs.join(sets.select(F.col("id").alias("u"), F.col("set").alias("set_u")), "u").join(sets.select(F.col("id").alias("v"), F.col("set").alias("set_v")), "v")
    links = written(both.select("u", "v", "set_u", "set_v").mapInArrow(lambda it: _confirmed(it, percent), "u bigint, v bigint"), "links")
    found = components(links)

    named = stars.join(found.withColumnRenamed("id", "u"), "u", "left").withColumn("component", F.coalesce("component", "u"))
    still = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    still = written(named.join(still, "key", "left_semi").groupBy("u", "v").agg(F.first("size_u").alias("size"), F.first("component").alias("component")), "open")
    spent = [live, stars, sets, links, still]
    if not still.isEmpty():
        clusters = components(still.select("u", "v"))
        members = still.groupBy(F.col("u").alias("id")).agg(F.first("size").alias("size"), F.first("component").alias("component")).join(clusters.withColumnRenamed("component", "cluster"), "id")
        members = written(members, "members")
        more = written(_cluster_links(members, live.select("id", F.explode("a").alias("x")), sets, percent, cluster_shingles), "more")
        spent += [found, clusters, members, more]
        found = components(links.unionByName(more))
    discard(*spent)

    lowest = found.join(classes.select("id", "doc_id"), "id").groupBy("component").agg(F.min("doc_id").alias("lowest"))
    found = found.join(lowest, "component").select("id", "lowest")
    classed = sketch.where("n_shingles > 0 and doc_id is not null").join(classes.select("d1", "d2", "id", F.col("doc_id").alias("class_id")), ["d1", "d2"])
    linked = classed.join(found, "id", "left").select("doc_id", "mark", "n_shingles", F.coalesce("lowest", "class_id").alias("component_id"), "class_id")
    lone = sketch.where("n_shingles = 0 or doc_id is null").select("doc_id", "mark", "n_shingles", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"))
    return linked.unionByName(lone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicate(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, percent: int = PERCENT, collection: int = COLLECTION, cluster_shingles: int = CLUSTER_SHINGLES) -> DataFrame:
    """docs, with the same columns, with the rows of the smallest id of each group of near duplicates only."""
    gone = _judged(docs, doc_id, text, words, percent, collection, cluster_shingles).where("not kept").select(F.col("doc_id").alias("gone"), F.col("mark").alias("gone_mark")).distinct()
    same = (docs[f"`{doc_id}`"].cast("long") == gone["gone"]) & (_mark(docs[f"`{text}`"]) == gone["gone_mark"])
    return docs.join(gone, same, "left_anti")
