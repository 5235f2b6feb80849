import random
import re

import pytest

from folioforge.llm.neardup import deduplicate, near_duplicates


def brute(rows, words=4, percent=80):
    sets = []
    for _, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    seen = {(a, b) for ks in holders.values() for a in ks for b in ks if a < b}
    for a, b in seen:
        x, y = rows[a][0], rows[b][0]
        both = len(sets[a] & sets[b])
        if x is not None and y is not None and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(x), find(y)
            parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), find(i) if i is not None else None, find(i) == i if i is not None else True) for (i, _), s in zip(rows, sets, strict=True)), key=repr)


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r)[:4] for r in near_duplicates(docs, words=4, **options).collect()), key=repr)


def family(rng, size, n_words, edits, first):
    base = [f"w{rng.randrange(10**6)}" for _ in range(n_words)]
    out = []
    for k in range(size):
        w = base.copy()
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append((first + k, " ".join(w)))
    return out


@pytest.mark.parametrize("limit", [2_000_000, 9_000, 1_500])
def test_families_match_brute_force(spark, limit):
    rng = random.Random(4)
    rows = family(rng, 120, 80, 9, 100) + family(rng, 30, 40, 4, 500) + family(rng, 10, 12, 2, 700)
    rng.shuffle(rows)
    assert run(spark, rows, cluster_shingles=limit) == brute(rows)


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two three"), (7, "One two  three"), (8, long), (9, long + " more"), (None, "one"), (10, "a b c d e f"), (10, "a b c d e f"), (11, "a b c d e f g"), (12, "A B C D E F")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:0]) == []
    docs = spark.createDataFrame([(i, t, "k", "u") for i, t in rows], "doc_id long, text string, key string, u string")
    left = deduplicate(docs, words=4)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == [1, 2, 3, 4, 6, 8, 10, 10, 11]


def test_table_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert run(spark, rows) == brute(rows)


def test_one_id_with_two_texts(spark):
    """Each text of an id keeps its own links, and goes or stays by itself."""
    rng = random.Random(9)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(3)]
    near = [[*w[:-1], "edited"] for w in base]
    texts = [" ".join(w) for w in base + near] + ["all on its own here"]
    rows = [(1, texts[0]), (20, texts[3]), (20, texts[6]), (20, texts[1]), (30, texts[4]), (5, texts[2]), (20, texts[5]), (20, texts[5])]
    want = [(1, 1), (20, 1), (20, 20), (20, 20), (30, 20), (5, 5), (20, 5), (20, 5)]
    assert sorted((r[0], r[2], r[3]) for r in run(spark, rows)) == sorted((i, c, i == c) for i, c in want)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(tuple(r) for r in deduplicate(docs, words=4).collect())
    assert left == sorted(r for r, (i, c) in zip(rows, want, strict=True) if i == c)
