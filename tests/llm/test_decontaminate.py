import hashlib
import re

from folioforge.llm.decontaminate import decontaminate, findings, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(n, len(w))
        for t in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[t : t + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for t in range(len(w) - k + 1):
                if (own := windows.get(tuple(w[t : t + k]))) is not None:
                    hit.update(range(t, t + k))
                    found |= {str(i) for i in own if i is not None}
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


LONG = " ".join(f"word{i}" for i in range(14))
ITEMS = [(1, LONG), (2, "short ÉTÉ item"), (3, None), (4, ""), (5, "--- !"), (None, "nameless but here"), (11, LONG), (1, LONG), (7, " ".join(["a"] * 12))]
DOCS = [(1, "x " + LONG.upper().replace(" ", ", ") + " y"), (2, "Short--ÉTÉ\nitem, and nameless BUT here"), (3, None), (4, ""), (5, " ".join(["a"] * 40)), (6, "short été item"), (7, LONG[:-8]), (7, LONG[:-8]), (None, "clean"), (8, "q " * 60000 + LONG)]


def frames(spark, docs=DOCS, items=ITEMS):
    return spark.createDataFrame([(d, t, "r", 1) for d, t in docs], "doc_id long, text string, row string, found int"), spark.createDataFrame(items, "item_id long, text string")


def test_edges_in_one_block_and_many(spark):
    docs, items = frames(spark)
    for block in (1 << 22, 1500):
        got = sorted((tuple(r)[:6] for r in findings(docs, items, block_bytes=block).collect()), key=repr)
        assert got == brute(DOCS, ITEMS)


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert findings(docs.limit(0), items).count() == 0
    assert findings(docs, items.limit(0)).where("contaminated").count() == 0


def test_removal(spark):
    docs, items = frames(spark)
    left = decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted((d[0] for d in brute(DOCS, ITEMS) if not d[5]), key=repr)
    cut = {r["doc_id"]: r["text"] for r in decontaminate(docs, items, mode="spans").collect()}
    assert cut[1] == "x  y" and cut[2] == ", and " and cut[3] is None and cut[None] == "clean" and cut[5] == ""
    assert scan(docs, items).columns == ["row", "found"]


def test_blocks_shuffle_no_text_and_sets_are_as_small_as_counted(spark):
    import pickle
    import random

    from folioforge.llm import decontaminate as d

    docs, items = frames(spark)
    plan = findings(docs, items, block_bytes=1500)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
    rng = random.Random(3)
    texts = [" ".join(f"{rng.randrange(10**6):x}" for _ in range(rng.randint(1, 400))) for _ in range(2000)]
    counted = sum(len(t) + d.WORD_BYTES * len(t.split()) + d.ITEM_BYTES for t in texts)
    assert len(pickle.dumps(d.WindowSet(list(enumerate(texts)), 10))) < counted + (1 << 20) * 10


def test_equal_hashes_of_other_words(monkeypatch):
    """With hashes of four values all hits rest on the words."""
    import numpy as np
    import pyarrow as pa

    from folioforge.llm import decontaminate as d
    from folioforge.llm import textkit as tk

    whole = tk.window_hashes
    monkeypatch.setattr(d.tk, "window_hashes", lambda h, n: whole(h, n) % np.uint64(4))
    items = [(k, " ".join(f"w{(k + j) % 7}" for j in range(3))) for k in range(7)] + [(9, "w0 w1 w2")]
    windows = d.WindowSet(items, 10)
    words = tk.find_words(*tk.text_bytes(pa.array(["w0 w1 w2 w3 x w5 w6", "w0 w1", "w6 w0 w1"])), tk.ALNUM_WORDS)
    found = sorted((t, sorted(windows.items_of(size, k))) for t, size, k in windows.hits(words))
    assert found == [(0, ["0", "9"]), (1, ["1"]), (9, ["6"])]
