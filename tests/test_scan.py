"""The segmented scan against whole texts: any block size gives the same lines."""

import random
import re

import pytest
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators.ingest import marked, marked_lines, units_of
from folioforge.operators.scan import read_blocks, scan_lines, text_blocks

ENDS = ["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " ", "\n\r", "\r\r\n", "\n\n"]
WORDS = ["a", "é", "日本", "👍🏽", "Chapter 3", "Prologue", "chapter ix", "text of a line", ""]


def texts(seed, n=60):
    rng = random.Random(seed)
    out = [(i, "".join(rng.choice(WORDS) + rng.choice(ENDS) for _ in range(rng.randrange(0, 25))) + rng.choice(WORDS)) for i in range(n)]
    return [*out, (900, ""), (901, None), (902, "\r"), (903, "\r\n" * 9), (904, "x" * 300), (905, "日" * 200 + "\r\n" + "é" * 99), (906, "\ufeffa\n\ufeffb")]


def plain(text):
    """Lines with offsets and chapters in plain Python."""
    lines = re.findall("[^\n\r\x0b\x0c\x1c-\x1e\x85  ]*(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ])|[^\n\r\x0b\x0c\x1c-\x1e\x85  ]+", text or "")
    out, at = [], 0
    for i, line in enumerate(lines):
        out.append((i, line, at))
        at += len(line)
    return out


@pytest.mark.parametrize("size", [8, 13, 64, 1 << 16])
def test_lines_of_any_block_size(spark, size):
    rows = texts(size)
    df = spark.createDataFrame(rows, "id int, t string")
    blocks = text_blocks(df, "id", "t", size)
    assert blocks.agg(F.max(F.octet_length("text"))).first()[0] <= size + 4
    got = {}
    for r in scan_lines(blocks, "id").collect():
        got.setdefault(r["id"], []).append((r["line_no"], r["line"], r["start"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: plain(t) for k, t in rows if t}
    whole = {r["id"]: r["c"] for r in blocks.groupBy("id").agg(tx.joined(F.col("text"), F.col("block")).alias("c")).collect()}
    assert whole == {k: t for k, t in rows if t is not None}


def test_units_in_blocks_equal_units_of_whole_texts(spark):
    df = spark.createDataFrame([(str(k), t) for k, t in texts(7, 200)], "id string, canonical_text string")
    whole, cut = marked_lines(df, "id"), marked(text_blocks(df, "id", "canonical_text", 16), "id")
    for a, b in ((whole, cut), (units_of(whole, "id").drop("translation", "classification"), units_of(cut, "id").drop("translation", "classification"))):
        a, b = (x.collect() for x in (a, b))
        assert sorted(map(repr, a)) == sorted(map(repr, b)) and a


def test_no_window_holds_more_than_a_block(spark):
    """One long text: windows that hold its lines are by block; those over the whole text have a row a block."""
    text = "".join(f"Chapter {i}\nline of chapter {i}\n" for i in range(3000))
    df = spark.createDataFrame([("k", text)], "id string, canonical_text string")
    blocks = text_blocks(df, "id", "canonical_text", 1024)
    lines = scan_lines(blocks, "id")
    assert lines.groupBy("id", "block").agg(F.sum(F.octet_length("line")).alias("n")).agg(F.max("n")).first()[0] < 1024 + 64
    got = marked(blocks, "id")
    assert got.count() == 6000 and got.agg(F.max("chapter_ordinal")).first()[0] == 3000


def test_files_in_blocks(spark, tmp_path):
    rows = [(k, t) for k, t in texts(11, 30) if t]
    for k, t in rows:
        (tmp_path / f"f {k}.txt").write_bytes((b"\xef\xbb\xbf" if k % 2 else b"") + t.encode())
    (tmp_path / "none.txt").write_bytes(b"")
    blocks = read_blocks(spark, f"file://{tmp_path}", glob="*.txt", block_bytes=16)
    got = {}
    for r in scan_lines(blocks, "path").collect():
        got.setdefault(int(re.search(r"f(?: |%20)(\d+)", r["path"]).group(1)), []).append((r["line_no"], r["line"], r["start"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: plain(t.removeprefix("\ufeff") if k % 2 == 0 else t) for k, t in rows}
