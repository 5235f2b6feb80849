import random

import pytest

from folioforge.llm import quality
from folioforge.llm.quality import accepted, classify, fit, site_posteriors


def test_held_out_accuracy(spark):
    """Fitted on half of the labels, judged on the other half."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    got = {r["doc_id"]: r for r in classify(docs, labels.where("doc_id % 2 = 0")).collect()}
    held = [r for r in labels.collect() if r["doc_id"] % 2]
    toxic = [got[r["doc_id"]]["chance_toxic"] >= 0.5 for r in held if r["toxic"]]
    clean = [got[r["doc_id"]]["kept"] for r in held if r["quality"] and not r["toxic"]]
    low = [got[r["doc_id"]]["chance_low"] >= 0.5 for r in held if not r["quality"]]
    assert sum(toxic) / len(toxic) > 0.85 and sum(clean) / len(clean) > 0.98 and sum(low) / len(low) > 0.95


def test_edges(spark):
    rows = [(1, None, None, None, "x"), (2, "", "s", "en", "x"), (None, "text", "s", None, "x"), (3, "w " * 50000, "s", "en", "x"), (3, "again", "t", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, kept string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(1, None, 1), (99, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        got = classify(docs, labels).collect()
        assert len(got) == len(rows) and all(r["kept"] for r in got)
    assert accepted(docs, none).columns == docs.columns and accepted(docs, none).count() == len(rows)
    assert classify(docs.limit(0), none).count() == 0


def test_rejection_is_by_row(spark):
    """A rejected row takes no clean row along that shares its id, a null id or its text."""
    clean = [(100 + k, f"a calm article about rivers and hills number {k}", "s", "en", "clean") for k in range(60)]
    bad = [(200 + k, f"$$$ buy now cheap pills || click {k}", "s", "en", "bad") for k in range(60)]
    labels = spark.createDataFrame([(r[0], int(r[4] == "clean"), 0) for r in clean + bad], "doc_id long, quality int, toxic int")
    mixed = []
    for i in (None, None, 7):
        mixed += [(i, "$$$ buy now cheap pills || click here", "s", "en", "bad"), (i, "a calm article about rivers and hills here", "s", "en", "clean")]
    mixed += [(7, "a calm article about rivers and hills", None, None, "clean")]
    docs = spark.createDataFrame(clean + bad + mixed, "doc_id long, text string, source string, lang string, digest string")
    judged = classify(docs, labels).where("kept").groupBy("doc_id").count().collect()
    left = accepted(docs, labels)
    rows = [tuple(r) for r in left.collect()]
    assert left.columns == docs.columns
    assert sorted(map(repr, rows)) == sorted(repr(r) for r in clean + [m for m in mixed if m[4] == "clean"])
    assert {r["doc_id"]: r["count"] for r in judged} == {i: [r[0] for r in rows].count(i) for i in {r[0] for r in rows}}


def test_what_reaches_the_driver_does_not_grow_with_texts(spark, monkeypatch):
    """Labelled documents ten times as long, of ever new words: the rows collected stay as small."""
    rng = random.Random(14)
    collected = []
    arrow = type(spark.range(0)).toArrow

    def spied(self):
        collected.append(arrow(self))
        return collected[-1]

    monkeypatch.setattr(type(spark.range(0)), "toArrow", spied)
    for length in (300, 3000):
        rows = [(k, " ".join([f"w{rng.randrange(10**9)}" for _ in range(length)] + ["cheap" if k % 2 else "calm"]), k % 2) for k in range(60)]
        docs = spark.createDataFrame([(k, t, "s", "en") for k, t, _ in rows], "doc_id long, text string, source string, lang string")
        models = fit(docs, spark.createDataFrame([(k, 1 - y, 0) for k, _, y in rows], "doc_id long, quality int, toxic int"))
        assert len(models["low"].features) and not len(models["toxic"].features)
    small, large = (t.nbytes for t in collected)
    assert large <= 2 * small and large < 60 * 8 * (quality.FEATURES + quality.N_SHAPES)


def test_site_posteriors_against_plain_python(spark):
    rows = [(k, "t", f"h{k % 3}" if k % 7 else None, "en" if k % 5 else None) for k in range(200)]
    marks = [(k, int(k % 3 != 0 or k % 4 == 0), int(k % 11 == 0)) for k in range(0, 200, 2)] + [(999, 0, 1), (None, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    hosts, paths, means = site_posteriors(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    known = {k: (1 - q, t) for k, q, t in marks if k in range(200)}
    assert means == {"low": pytest.approx(sum(v[0] for v in known.values()) / len(known)), "toxic": pytest.approx(sum(v[1] for v in known.values()) / len(known))}

    def strength(groups):
        between = sum(n * (s / n - m) ** 2 for s, n, m in groups)
        within, total, size = sum(m * (1 - m) for _, _, m in groups), sum(n * m * (1 - m) for _, n, m in groups), sum(n for _, n, _ in groups)
        excess = (between - within) / size
        return min(1e6, max(1.0, total / size / excess - 1)) if excess > 1e-12 else 1e6

    got_hosts, got_paths = {r["host"]: r for r in hosts.collect()}, {(r["host"], r["lang"]): r for r in paths.collect()}
    for y, at in (("low", 0), ("toxic", 1)):
        by_host, by_path = {}, {}
        for k, _, h, lang in rows:
            if k in known:
                by_host.setdefault(h, []).append(known[k][at])
                by_path.setdefault((h, lang), []).append(known[k][at])
        k = strength([(sum(v), len(v), means[y]) for v in by_host.values()])
        host = {h: (sum(v) + k * means[y]) / (len(v) + k) for h, v in by_host.items()}
        k = strength([(sum(v), len(v), host[p[0]]) for p, v in by_path.items()])
        path = {p: (sum(v) + k * host[p[0]]) / (len(v) + k) for p, v in by_path.items()}
        assert {h: r[f"host_{y}"] for h, r in got_hosts.items()} == pytest.approx(host)
        assert {p: r[f"path_{y}"] for p, r in got_paths.items()} == pytest.approx(path)
