import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from folioforge.llm import textkit as tk
from folioforge.llm.bpe import Encoder
from folioforge.llm.tokenfiles import FileReader, FileWriter, bits_for, pack, read_tokens, unpack, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def reference():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31, 32])
def test_pack_round_trip(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = rng.integers(0, 2**bits, n).astype(np.uint32)
        assert np.array_equal(unpack(pack(ids, bits), bits, n), ids)


def test_bits():
    assert [bits_for(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_file_random_access():
    writer, docs, rng = FileWriter(17, block_ids=128), [], np.random.default_rng(0)
    for k in range(50):
        ids = rng.integers(0, 2**17, rng.integers(0, 400)).astype(np.uint32)
        docs.append(ids)
        writer.add(None if k == 3 else k, ids)
    reader = FileReader(io.BytesIO(writer.content()))
    for k in (49, 0, 17, 3):
        assert np.array_equal(reader.document(k), docs[k])
    assert all(np.array_equal(a, b) for a, b in zip(reader.documents(500), docs, strict=True))
    whole = np.concatenate(docs)
    assert np.array_equal(reader.ids(1000, 1300), whole[1000:1300])
    assert reader.nulls[3] == 1


def test_encoder_equals_library():
    rng = random.Random(5)
    pieces = ["don't", "I'll", "'s", " 's", "''s", "we've've", "x'd", "\n\n", "  ", "\t", " ", " ", "12", "½", "été", "naïve", "...", "!?", "日本", "🎉", "'re", "'really", "'S", "_", "a1b2", "\r\n", "\x1c", "<|endoftext|>", "́", "ſ", " "]
    texts = ["", " ", "'", "a'", "'t", "\n"] + ["".join(rng.choices(pieces, k=rng.randint(1, 14))) for _ in range(3000)]
    import pyarrow as pa

    own = Encoder(PATH)
    want = [e.ids for e in reference().encode_batch(texts, add_special_tokens=False)]
    got = own.encode(*tk.text_bytes(pa.array(texts)))
    for text, a, b in zip(texts, got, want, strict=True):
        assert a.tolist() == b, text


def expected(rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = reference().encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = [tuple(r) for r in read_tokens(spark, write_tokens(docs, tokenizer=PATH, file_ids=5000)).collect()]
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    assert sorted(got) == expected(rows)


def test_edges(spark):
    rows = [(3, None, "a"), (1, "", "b"), (2, "x " * 50000, "c"), (7, "same", "d"), (7, "same", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    got = sorted(tuple(r) for r in read_tokens(spark, write_tokens(docs, tokenizer=PATH)).collect())
    assert got == expected(sorted([(r[0], r[1]) for r in rows], key=lambda r: r[0]))
    with_null = spark.createDataFrame([(None, "null first"), (0, "zero")], "doc_id long, text string")
    got = [tuple(r) for r in read_tokens(spark, write_tokens(with_null, tokenizer=PATH)).orderBy("start").collect()]
    assert [g[0] for g in got] == [None, 0]
    assert read_tokens(spark, write_tokens(docs.limit(0), tokenizer=PATH)).count() == 0


def test_special_tokens_in_text(spark):
    """Held against the library as the file gives it, with no switch set."""
    import pyarrow as pa

    plain = Tokenizer.from_file(PATH)
    assert plain.encode("a<|endoftext|>b", add_special_tokens=False).ids == [64, 50256, 65]
    rng, special = random.Random(6), "<|endoftext|>"
    pieces = [special, special[:5], special[5:], "<|", "|>", " ", "a", "don't", "\n", "é", "日本", "𝒳", "12"]
    texts = ["", special, special * 2, f"a{special}b", special[:5], special[5:], None] + ["".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(500)]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = Encoder(PATH, special_in_text=True).encode(*tk.text_bytes(pa.array(texts)))
    assert [g.tolist() for g in got] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, start = [], 0
    for k, ids in enumerate(want):
        ids = ids + [0]
        rows.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in read_tokens(spark, write_tokens(docs, tokenizer=PATH)).collect()) == rows


def test_all_sure_code_points_and_a_full_cache(spark, monkeypatch):
    """The classes of code points, and texts whose pieces do not fit into the cache, against the untouched library."""
    import pyarrow as pa

    from folioforge.llm import bpe

    plain, own = Tokenizer.from_file(PATH), Encoder(PATH, True)
    monkeypatch.setattr(bpe, "CACHED_PIECES", 4000)
    sure = np.flatnonzero(own.classes != bpe.UNSURE)
    assert (own.classes[[0x2018, 0x2019, 0x201C, 0x2014, 0x65E5, 0x3042, 0xAC00]] != bpe.UNSURE).all()
    for s in range(0, len(sure), 3000):
        texts = [f"a{c}1{c}{c} {c}! {c}{c}\n{c} x'{c}" for c in map(chr, sure[s : s + 3000 : 3].tolist())]
        want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in own.encode(*tk.text_bytes(pa.array(texts)))] == want
    assert len(own.hash) == len(own.slot) and len(own.flat) == own.size.sum()
