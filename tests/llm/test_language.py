"""Language identification: against plain Python, on held-out documents, and on edges."""

import math
import unicodedata
import zlib
from collections import Counter

import pytest

from folioforge.llm import language as la
from folioforge.llm.queries import op12_language

SCHEMA = "doc_id bigint, text string, lang string"


def words_of(text):
    out, run = [], []
    for c in text + " ":
        if unicodedata.category(c)[0] in "LM":
            run.append(c.lower() if len(c.lower()) == 1 else c)
        elif run:
            out += ["".join(run[i : i + la.MAX_WORD]) for i in range(0, len(run), la.MAX_WORD)]
            run = []
    return out


def grams_of(word):
    s = f" {word} "
    return [(n, p, s[p : p + n]) for n in la.ORDERS for p in range(len(s) - n + 1) if n > 1 or s[p] != " "]


def level(n):
    return math.floor(math.log2(n) * 16)


def frequent(totals, room):
    sizes, lowest, taken = Counter(map(level, totals.values())), None, 0
    for at in sorted(sizes, reverse=True):
        if taken + sizes[at] > room:
            break
        lowest, taken = at, taken + sizes[at]
    return {k for k, n in totals.items() if lowest is not None and level(n) >= lowest}


def plain(rows, room):
    """rows: doc_id, text, lang. doc_id: held_out, lang_pred, score."""
    held = {r[0]: zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0 for r in rows}
    learned = [(t or "", g) for d, t, g in rows if not held[d] and g is not None]
    langs = sorted({g for _, g in learned})
    words, grams = Counter(), Counter()
    for t, g in learned:
        words.update((w, g) for w in words_of(t))
    for (w, g), n in words.items():
        for size, _, s in grams_of(w):
            grams[size, s, g] += math.floor(math.log2(n)) + 1
    word_total, gram_total = Counter(), Counter()
    for (w, _), n in words.items():
        word_total[w] += n
    for (size, s, _), n in grams.items():
        gram_total[size, s] += n
    known_words, known_grams = frequent(word_total, room), frequent(gram_total, room)
    in_lang = {g: sum(n for (_, h), n in words.items() if h == g) for g in langs}
    in_size = {(k, g): sum(n for (size, _, h), n in grams.items() if h == g and size == k) for k in la.ORDERS for g in langs}
    kinds = Counter(size for size, _ in gram_total)
    out = {}
    for d, t, _ in rows:
        if not langs or not any(unicodedata.category(c)[0] == "L" for c in t or ""):
            out[d] = (held[d], "und", 0.0)
            continue
        sums, n = dict.fromkeys(langs, 0.0), 0
        for w in words_of(t):
            if w in known_words:
                n += 1
                for g in langs:
                    sums[g] += math.log((words[w, g] + 0.5) / (in_lang[g] + 0.5 * len(word_total)))
                continue
            best = {}
            for size, p, s in grams_of(w):  # longest first
                if p not in best and (size, s) in known_grams:
                    best[p] = (size, s)
            if best:
                n += 1
                for g in langs:
                    sums[g] += sum(math.log((grams[size, s, g] + 0.5) / (in_size[size, g] + 0.5 * kinds[size])) for size, s in best.values()) / len(best)
        share = Counter(g for _, g in learned)
        evidence = {g: sums[g] * min(n, la.EVIDENCE_WORDS) / max(n, 1) + math.log(share[g] / len(learned)) for g in langs}
        best = max(langs, key=lambda g: evidence[g])
        out[d] = (held[d], best, 1 / sum(math.exp(e - evidence[best]) for e in evidence.values()))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for d, (held, lang, score) in want.items():
        assert got[d][:2] == (held, lang), d
        assert got[d][2] == pytest.approx(score, abs=2e-4), d


def found(df):
    return {r["doc_id"]: (r["held_out"], r["lang_pred"], r["score"]) for r in df.collect()}


TEXTS = [("en", "The house of the old man is on the hill, and the river runs by it."), ("fr", "La maison du vieil homme est sur la colline, à côté de la rivière."), ("de", "Das Haus des alten Mannes steht auf dem Hügel über dem Fluß."), ("ja", "丘の上に老人の家がある。川がその横を流れている。"), ("el", "Το σπίτι του γέρου είναι στον λόφο.")]


@pytest.mark.parametrize("room", [100_000, 40])
def test_equals_plain_python(spark, room):
    """With room for all words and n-grams, and with little."""
    rows = [(i, " ".join(TEXTS[i % 5][1].split()[i % 3 : 3 + i % 7]) + (" THE hill É" if i % 11 == 0 else ""), TEXTS[i % 5][0] if i % 13 else None) for i in range(120)]
    rows += [(200, None, "en"), (201, "12 34 !?", "fr"), (202, "", "de"), (203, "x" * 60, "en"), (None, "La colline", "fr"), (204, "́ ́", "fr")]
    df = spark.createDataFrame(rows, SCHEMA)
    held = la.F.crc32(la.F.coalesce(la.F.col("doc_id").cast("string"), la.F.lit("")).cast("binary")) % 5 == 0
    model = la.fit(df.where(~held), max_words=room, model_cells=room * 5)
    got = found(la.predict(df.select("doc_id", held.alias("held_out"), "text"), model))
    same(got, plain(rows, room))


def test_edges(spark):
    """Repeated rows, a very long text, clashing columns, no language, an empty table."""
    rows = [(i, t, g) for i in range(30) for g, t in TEXTS[:2]]
    long = (1001, "la colline " * 300_000, "fr")
    df = spark.createDataFrame([*rows, *rows, long], SCHEMA).selectExpr("*", "'z' as lang_pred", "1 as score", "2 as held_out", "3 as word", "4 as n")
    got = la.identify(df).collect()
    assert len(got) == 2 * len(rows) + 1
    assert next(r for r in got if r["doc_id"] == 1001)["lang_pred"] == "fr"
    assert [r["lang_pred"] for r in la.identify(df.withColumn("lang", la.F.lit(None).cast("string"))).collect()] == ["und"] * len(got)
    assert la.identify(df.limit(0)).count() == 0


def test_held_out_accuracy(spark, sf):
    """On all documents of the fold that is held out."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op12_language(spark, sf).join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and len(held) > 20
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
