"""Cross-tokenizer alignment against whole texts encoded one by one, in plain Python."""

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from folioforge.llm import alignment as al
from folioforge.llm.queries import op13_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string"


def bytes_of_a(token):
    """The byte-level alphabet, by its public rule."""
    letters, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            letters[chr(b)] = b
        else:
            letters[chr(256 + extra)] = b
            extra += 1
    return bytes(letters[c] for c in token)


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def of_text(text):
        if not text:
            return None
        want = (" " + text).encode()
        a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        a_raw = [bytes_of_a(a.id_to_token(i)) for i in a_ids]
        b_raw = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
        if b"".join(a_raw) != want or b"".join(b_raw) != want:
            return None
        ends = lambda parts: [sum(map(len, parts[: k + 1])) for k in range(len(parts))]
        a_ends, b_ends = ends(a_raw), ends(b_raw)
        out, low = [], 0
        for e in sorted(set(a_ends) & set(b_ends)):
            out.append(([i for i, x in zip(a_ids, a_ends) if low < x <= e], [i for i, x in zip(b_ids, b_ends) if low < x <= e]))
            low = e
        return out

    def run(rows):
        groups = {d: of_text(t) for d, t in rows}
        links = {d: Counter((x, y) for xs, ys in g for x in xs for y in ys) for d, g in groups.items() if g is not None}
        count, best = Counter(p for own in links.values() for p in own), defaultdict(int)
        for (x, _), n in count.items():
            best[x] = max(best[x], n)
        out = {}
        for d, g in groups.items():
            if g is None:
                out[d] = (0, 0, 0, 0, 0, 0, "")
                continue
            text = ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in g)
            out[d] = (sum(len(xs) for xs, _ in g), sum(len(ys) for _, ys in g), len(g), sum(links[d].values()), sum(n for p, n in links[d].items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links[d].items()), hashlib.sha256(text.encode()).hexdigest())
        return out

    return run


def found(df):
    rows = df.collect()
    out = {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in rows}
    assert len(out) == len(rows)
    return out


PARTS = ["the", "don't", "Ünïcode", "naïve", "日本語", "x1y2", "...", "--", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "_", "{", "}", ";", "👍🏽", "é", "́", "\x00", "\x1c", "\x7f", "ﬁ", "I'LL", "'s", "0000", "1234567", "supercalifragilistic"]
SPACES = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\r", " \n ", "　", " ", " ", "\u0085", "​", "\x0b", "\x0c", "  ", "  ", "", "   \t"]


def fuzz(n, seed):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(SPACES) + rng.choice(PARTS if rng.random() < 0.98 else ["▁"]) for _ in range(rng.randrange(1, 14))) + rng.choice(SPACES)) for i in range(n)]


def test_equals_whole_texts(spark, plain):
    rows = fuzz(1500, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain(rows)
    assert sum(v[0] > 0 for v in want.values()) > 900
    assert found(al.align(df, byte_level=A, pieces=B)) == want
    assert found(al.align(df.repartition(3), byte_level=A, pieces=B, block_bytes=300)) == want


def test_edges(spark, plain):
    """Nulls, empty texts, repeated rows, a very long text, clashing columns, an empty table; and the groups themselves."""
    rows = [(0, None), (1, ""), (2, " "), (3, "\n"), (4, "a"), (5, "same text"), (6, "same text"), (7, "long wörd " * 60_000), (8, "y" * 3000), (9, "x\n")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as block", "'q' as segment", "2 as number", "3 as n_a", "'g' as groups")
    want = plain([r for r in rows if r[0] != 7])
    got = found(al.align(df.where("doc_id <> 7"), byte_level=A, pieces=B))
    assert got == want
    assert found(al.align(df, byte_level=A, pieces=B))[7][0] > 100_000
    twice = al.align(df.where("doc_id = 5").union(df.where("doc_id = 5")), byte_level=A, pieces=B, with_groups=True).collect()
    assert len(twice) == 2 and twice[0]["count_sum"] == 2 * twice[0]["n_links"]
    assert hashlib.sha256(twice[0]["groups"].encode()).hexdigest() == twice[0]["groups_sha256"] == want[5][-1]
    none = al.align(spark.createDataFrame([(None, None), (None, "hello there")], SCHEMA), byte_level=A, pieces=B).collect()
    assert sorted(r["n_a"] > 0 for r in none) == [False, True]
    assert al.align(df.limit(0), byte_level=A, pieces=B).count() == 0


def test_query(spark, sf, plain):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert found(op13_alignment(spark, sf)) == plain([tuple(r) for r in docs])


def block_of(n_docs, n_segments, each, seed=3):
    """A block as it comes to be composed: documents with `each` segments, most of them frequent ones; alignments are made up, some missing."""
    rng = np.random.default_rng(seed)
    tokens = (24_000 * rng.random((n_segments, 4)) ** 8).astype(np.int64)
    words = [f"{a},{b}|{c};{c}|{a};{d}|{d}" for a, b, c, d in tokens.tolist()]
    words[n_segments // 2] = ""
    flat = (n_segments * rng.random(n_docs * each) ** 6).astype(np.int64)
    docs = pa.table({"block": [7], "ids": [list(range(n_docs))], "sizes": pa.array([[each] * n_docs], pa.list_(pa.int32())), "numbers": [al._packed(flat)]})
    parts = np.array_split(rng.permutation(n_segments), 5)
    lines = ["\n".join(words[k] for k in part).encode() for part in parts]
    segments = pa.table({"rows": [len(p) for p in parts], "numbers": [al._packed(p) for p in parts], "size": [len(x) for x in lines], "groups": [pa.compress(x, codec="zstd", asbytes=True) for x in lines]})
    long, many, kinds = pa.int64(), pa.list_(pa.int64()), [*al._COUNTS]
    schema = pa.schema([("block", long), ("ids", many), *[(c, many) for c in kinds], ("groups_sha256", pa.list_(pa.string())), ("n_pairs", long), ("n_held", long), ("steps", pa.binary()), ("times", pa.binary()), ("number", pa.int32()), ("pair", long), ("n", long)])
    return docs, segments, schema


def test_steps_of_a_block(monkeypatch):
    """Steps of any size give the same rows."""
    given = block_of(30, 200, 40)
    want = al._compose(*given, False)
    assert want["n_held"][0].as_py() > 1000
    for size in (1, 17, 300):
        monkeypatch.setattr(al, "_PARSED_BYTES", size)
        monkeypatch.setattr(al, "_LINKED", size)
        assert al._compose(*given, False).equals(want)


def test_memory_of_a_block():
    """A block of the size that 8 MB of text have: two tasks of an executor have about 1 GB for them beside its heap."""
    given = block_of(2300, 240_000, 570)
    tracemalloc.start()
    try:
        al._compose(*given, False)
        assert tracemalloc.get_traced_memory()[1] < 300e6
    finally:
        tracemalloc.stop()
