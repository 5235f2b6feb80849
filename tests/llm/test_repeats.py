import hashlib
import random

import pyarrow as pa
import pytest

from folioforge.llm.repeats import repeated_passages


def brute(rows, length=50):
    first = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        if doc_id is not None:
            for i in range(len(raw) - length + 1):
                s = raw[i : i + length]
                first[s] = min(first.get(s, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        if doc_id is not None:
            for i in range(len(raw) - length + 1):
                if first[raw[i : i + length]] < doc_id:
                    gone[i : i + length] = b"\1" * length
        spans = sum(gone[i] and (not i or not gone[i - 1]) for i in range(len(gone)))
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in repeated_passages(docs, **options).collect()), key=repr)


def test_query_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in repeated_passages(docs).collect()), key=repr)
    assert got == brute(rows)
    assert any(r[2] for r in got)


def test_edges(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choices("abcdé ", k=n))
    shared = word(60)
    rows = [(5, None), (6, ""), (7, "short"), (None, shared * 3), (1, shared), (2, "x" + shared + "y"), (2, shared[5:] + "tail"), (9, "ab" * 400), (4, "ab" * 100), (10, "a" * 49), (11, "a" * 50), (12, "a" * 51)]
    rows += [(13, word(300) + shared[:50] + word(20)), (14, word(10) + shared[:49]), (15, word(5000)), (15, word(70))]
    rows += [(20, "same text that is long enough to be removed as a whole, surely")] * 3 + [(21, rows[-1][1])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:0]) == []


def test_many_small_alphabets(spark):
    rng = random.Random(8)
    rows = []
    base = ["".join(rng.choices("ab", k=200)) for _ in range(3)]
    for k in range(60):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice("abc")
        rows.append((k // 2 * 2 + rng.randint(0, 1), "".join(t)[rng.randint(0, 40) :] + rng.choice(base)[: rng.randint(0, 120)]))
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, length=30, gram=9) == brute(rows, 30)


def test_lengths_offsets_and_segments(spark, monkeypatch):
    """Several lengths take one to three doublings; texts longer than a segment; columns with clashing names."""
    from folioforge.llm import repeats

    rng = random.Random(21)
    base = "".join(rng.choices("abcdefgh ", k=1500))
    rows = [(k, "".join(rng.choices("xyz", k=rng.randint(0, 30))) + base[rng.randint(0, 700) : rng.randint(701, 1500)] + "".join(rng.choices("xyz", k=rng.randint(0, 30)))) for k in range(12)]
    for length, gram in ((50, 20), (51, 20), (50, 50), (50, 49), (120, 20), (270, 15)):
        assert run(spark, rows, length=length, gram=gram) == brute(rows, length)
    with pytest.raises(ValueError):
        run(spark, rows, length=500, gram=20)
    monkeypatch.setattr(repeats, "SEGMENT_BYTES", 300)
    parts = [b for b in pa.table({"text": [t for _, t in rows], "doc_id": [i for i, _ in rows], "mark": [0] * len(rows)}).to_batches()]
    cut = sorted(x for batch in parts for f in repeats._found(batch, 50, 20) for x in zip(*(v.tolist() for v in f), strict=True))
    monkeypatch.setattr(repeats, "SEGMENT_BYTES", 1 << 25)
    whole = sorted(x for batch in parts for f in repeats._found(batch, 50, 20) for x in zip(*(v.tolist() for v in f), strict=True))
    places = lambda found: {(doc, (info >> 16 & (2**31 - 1)) + k) for _, _, doc, info in found for k in range((info >> 8 & 255) + 1)}
    assert places(cut) == places(whole) and len(cut) > len(whole)
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, info int, rank int, mark string")
    assert sorted((tuple(r) for r in repeated_passages(docs).collect()), key=repr) == brute(rows)


def test_settled_strings(spark, monkeypatch):
    """Copies within one batch are settled before the shuffle, in rows of up to 256 strings."""
    rng = random.Random(22)
    base = "".join(rng.choices("abcdefgh ", k=2000))
    rows = [(k, base[rng.randint(0, 5) : 2000 - rng.randint(0, 5)] + f" end {k}") for k in range(8)] + [(9, base[:900] + "~" + base[901:]), (9, base[:900] + "~" + base[901:]), (10, base[:400] + "#" + base[401:])]
    assert run(spark, rows) == brute(rows)
