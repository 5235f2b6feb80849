import hashlib
import random

import pytest

from folioforge.llm import fingerprint as f
from folioforge.llm.fingerprint import PrefixHashes, edited, fingerprint, fingerprints, likeness


def test_spans_and_extensions():
    rng = random.Random(1)
    for _ in range(200):
        a = "".join(rng.choices("ab", k=rng.randint(0, 40)))
        b = "".join(rng.choices("abé🎉", weights=[9, 9, 1, 1], k=rng.randint(0, 40)))
        pa, pb = PrefixHashes(a), PrefixHashes(b)
        for _ in range(10):
            s, t, n = rng.randint(0, len(a)), rng.randint(0, len(b)), rng.randint(0, 5)
            assert pa.same(s, pb, t, n) == (s + n <= len(a) and t + n <= len(b) and a[s : s + n] == b[t : t + n])
            longest = next((k for k in range(min(len(a) - s, len(b) - t)) if a[s + k] != b[t + k]), min(len(a) - s, len(b) - t))
            assert pa.extension(s, pb, t) == longest


def plain_likeness(a, b):
    """The same chain with slices of the texts in place of hashes."""
    if not a or not b:
        return float(len(a) == len(b))

    def extension(i, j):
        return next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))

    size = f.WINDOW if min(len(a), len(b)) >= 64 else f.SHORT_WINDOW
    common = i = j = extension(0, 0)
    places = {}
    for k in range(len(a) - size + 1):
        places.setdefault(a[k : k + size], []).append(k)
    while min(len(a) - i, len(b) - j) >= size:
        shared = [k for k in range(j, len(b) - size + 1) if b[k : k + size] in places]
        best = None
        for start in range(0, len(shared), f.CHOICE):
            options = [(p - i + k - j, k, p) for k in shared[start : start + f.CHOICE] for p in places[b[k : k + size]] if p >= i]
            if options:
                best = min(options)
                break
        if not best:
            break
        more = extension(best[2], best[1])
        common, i, j = common + more, best[2] + more, best[1] + more
    return common / max(len(a), len(b))


def test_likeness():
    rng = random.Random(2)
    text = lambda n: "".join(rng.choices("abcdefghij ", k=n))
    assert likeness("", None) == 1
    assert likeness("", "a") == likeness("a", "") == 0
    for n in (1, 2, 31, 32, 33, 64, 65, 1000, 5000):
        a, b = text(n), text(n)
        assert likeness(a, a) == 1
        if n > 30:
            assert likeness(a, b) < 0.1
            assert 0.55 < likeness(a, edited(a, b)) < 0.75
            middle = a[: n // 2] + "XYZ" + a[n // 2 :]
            assert 0.8 < likeness(a, middle) < 1
            assert likeness(a, a * 2) <= 0.5
    a = text(5000)
    assert likeness(a, "X" + a[1:-1] + "X") > 0.99
    many = list(a)
    for k in range(40, 5000, 100):
        many[k] = "#"
    assert likeness(a, "".join(many)) > 0.9 and likeness("".join(many), a) > 0.9


def test_likeness_matches_plain_python():
    rng = random.Random(7)
    for k in range(300):
        a = "".join(rng.choices("ab" if k % 3 else "abcdefgh ", k=rng.randint(0, 150)))
        b = a if rng.random() < 0.7 else "".join(rng.choices("abc", k=rng.randint(0, 150)))
        for _ in range(rng.randint(0, 4)):
            at, end = rng.randint(0, len(b)), rng.randint(0, len(b))
            b = b[:at] + rng.choice(["", "z", "éé🎉", a[:30]]) + b[max(at, end) if rng.random() < 0.3 else at :]
        assert likeness(a, b) == plain_likeness(a, b), (a, b)


def test_blocks_and_samples(monkeypatch):
    """Texts of several blocks, and chains over sampled spans."""
    rng = random.Random(8)
    a = "".join(rng.choices("abcdefghij é🎉", k=200_000))
    b = a[:70_000] + "?" + a[70_000:150_000] + a[150_010:]
    pa, pb = PrefixHashes(a), PrefixHashes(b)
    for s, e, t in ((0, 200_000, 0), (65_530, 65_560, 65_530), (100_000, 140_000, 100_001), (190_000, 200_000, 189_991), (70_000, 70_001, 70_000)):
        assert pa.same(s, pb, t, min(e - s, pb.n - t)) == (a[s:e][: pb.n - t] == b[t : t + e - s])
        assert (pa.value(s, e) == pb.value(t, min(t + e - s, pb.n))) == (a[s:e] == b[t : t + e - s])
    assert pa.extension(0, pb, 0) == 70_000 and pa.extension(70_000, pb, 70_001) == 80_000 and pa.extension_left(70_000, pb, 70_000, 70_000) == 70_000
    assert 0.999 < pa.likeness(pb) < 1
    assert likeness(a, "".join(rng.choices("klmnop", k=200_000))) == 0
    whole = PrefixHashes(a[:90_000] + b[:80_000])
    put = PrefixHashes.joined(pa, 90_000, pb, 80_000)
    assert all((x == y).all() for x, y in zip(whole.arrays, put.arrays, strict=True)) and whole.fingerprint() == put.fingerprint()
    for s in (0, 5000):
        assert pa.extension(s, whole, s) == 90_000 - s + next(k for k in range(10**6) if a[90_000 + k] != b[k])


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) - len(text) // 3
        changed = text[:cut] + after[: len(text) // 3]
        out[doc_id] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprint(text), fingerprint(changed), likeness(text, changed), likeness(text, after))
    return out


def test_query_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in fingerprints(docs).collect()}
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edges(spark):
    rows = [(5, None, 1), (4, "", 1), (3, "long " * 30000, 1), (None, "no id", 1), (1, "é🎉x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    assert {r[0]: tuple(r)[1:] for r in fingerprints(docs).collect()} == brute([r[:2] for r in rows])
    assert fingerprints(docs.limit(0)).count() == 0
    one = fingerprints(spark.createDataFrame([(9, "abcdef")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and one[0]["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
    twice = fingerprints(spark.createDataFrame([(1, "same text")] * 3, "doc_id long, text string")).collect()
    assert len(twice) == 3


def test_likeness_does_not_fall_with_length():
    """One edit in forty words has about the same likeness at any length; texts that share nothing stay low."""
    import random
    import time

    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(4000)]
    got, before = {}, None
    for n in (400, 1600, 6400, 25_600, 160_000):
        words = [rng.choice(vocabulary) for _ in range(n)]
        other = [w if k % 40 else "changed" for k, w in enumerate(words)]
        a, b = PrefixHashes(" ".join(words)), PrefixHashes(" ".join(other))
        began = time.time()
        got[a.n] = a.likeness(b)
        assert time.time() - began < 30
        # The common code points, counted plainly: all words that were kept, and the spaces.
        kept = sum(len(w) for w, o in zip(words, other) if w == o) + n - 1
        assert got[a.n] == pytest.approx(kept / max(a.n, b.n), abs=0.02), n
        if before is not None:
            assert before.likeness(a) < 0.1
        before = PrefixHashes(" ".join(rng.choice(vocabulary)[::-1] + "q" for _ in range(n)))
    assert max(got.values()) - min(got.values()) < 0.02, got
