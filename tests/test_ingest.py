import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators.constraints import check_records
from folioforge.operators.ingest import ingest, project_files
from folioforge.operators.ledger import differences
from folioforge.operators.verify import verify
from folioforge.sources.shared import written

FILES = "filename string, content binary, title string"
MIXED = "﻿Front matter\r\n\r\nCHAPTER 1\r\nFirst line.\r\n\r\nChapter Two\nSecond line without final newline"


def docx(*parts, side=("word/header1.xml", "word/comments.xml")):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{''.join(f'<w:p>{p}</w:p>' for p in parts)}</w:body></w:document>")
        for name in side:
            z.writestr(name, "<x/>")
    return out.getvalue()


def run(spark, *files):
    return ingest(spark.createDataFrame(list(files), FILES))


def chapters(got):
    return [tuple(r) for r in got.chapters.orderBy("project_id", "ordinal").select("chapter_id", "heading", "source_label", "source_start", "source_end", "unit_count").collect()]


def violations(got_or_files):
    files = project_files(got_or_files) if not hasattr(got_or_files, "columns") else got_or_files
    files = written(files, "project-files")  # verification reads them many times
    return sorted((r["check_id"], r["entity_id"], r["row_no"]) for r in verify(files).collect())


def test_mixed_newlines_and_preamble(spark):
    got = run(spark, ("story.txt", MIXED.encode(), "Test Story"))
    assert [c[0] for c in chapters(got)] == ["P00", "P01", "P02"]
    assert chapters(got)[0][2] == "preamble" and chapters(got)[1][1:3] == ("CHAPTER 1", "1")
    row = got.sources.first()
    assert row["canonical_text"] == MIXED[1:] and row["encoding"] == "utf-8-sig" and row["project_id"] == "PRJ-test-story"
    assert "".join(r["chapter_text"] for r in got.chapters.orderBy("ordinal").collect()) == MIXED[1:]
    assert violations(got) == []


def test_stability(spark):
    file = ("story.md", b"Chapter 1\nAlpha\n\nChapter 2\nBeta\n", "Stable")
    a, b = run(spark, file), run(spark, file)
    assert differences(a.projects.select("manifest"), b.projects.select("manifest")).isEmpty()
    assert a.units.exceptAll(b.units).isEmpty()


def test_no_heading(spark):
    got = run(spark, ("story.txt", b"A story with no heading.\n", None))
    assert chapters(got) == [("P01", None, None, 0, 25, 1)]
    manifest = json.loads(got.projects.first()["manifest"])
    assert manifest["chapter_detection"]["status"] == "single_chapter_review" and len(manifest["chapter_detection"]["warnings"]) == 1
    assert violations(got) == []


def test_docx(spark):
    got = run(spark, ("story.docx", docx("<w:r><w:t>Chapter 1</w:t></w:r>", "<w:r><w:t>Hello</w:t><w:tab/><w:t>world.</w:t><w:softHyphen/><w:noBreakHyphen/><w:br/></w:r>"), None))
    row = got.sources.first()
    assert row["canonical_text"] == "Chapter 1\nHello\tworld.­‑\n" and row["encoding"] == "docx-xml"
    assert [w.rsplit(" ", 1)[1] for w in row["warnings"]] == ["word/comments.xml", "word/header1.xml"]
    assert violations(got) == []


def test_decoding_and_rejections(spark):
    files = [
        ("a.txt", "café".encode("cp1252"), None), ("b.txt", b"\x81", None), ("c.txt", "é🎉".encode("utf-16"), None), ("d.txt", b"\xfe\xff" + "é".encode("utf-16-be"), None),
        ("e.txt", b"", None), ("f.txt", b"\xef\xbb\xbf", None), ("g.pdf", b"x", None), ("h.docx", b"no zip", None), ("i.TXT", b"x", ""), ("j.txt", "日本".encode(), "日本"),
        ("same.txt", b"1", "Same"), ("same.md", b"2", "same!"), ("k.docx", docx(), None),
    ]
    got = run(spark, *files)
    rows = {r["filename"]: r for r in got.sources.collect()}
    assert {k: (r["encoding"], r["canonical_text"]) for k, r in rows.items()} == {"a.txt": ("cp1252", "café"), "c.txt": ("utf-16-le-bom", "é🎉"), "d.txt": ("utf-16-be-bom", "é"), "i.TXT": ("utf-8", "x"), "j.txt": ("utf-8", "日本")}
    assert rows["i.TXT"]["title"] == "i" and rows["i.TXT"]["copy_path"] == "source/original.input.txt"
    assert rows["j.txt"]["project_id"] == "PRJ-" + hashlib.sha256("日本".encode()).hexdigest()[:12]
    reasons = {r["filename"]: r["reason"] for r in got.rejected.collect()}
    assert set(reasons) == {"b.txt", "e.txt", "f.txt", "g.pdf", "h.docx", "same.txt", "same.md", "k.docx"}
    assert reasons["g.pdf"].startswith("supported inputs") and reasons["e.txt"] == "source contains no text" and reasons["same.md"] == "project already exists"


@pytest.mark.parametrize("line, label", [
    ("Chapter 1", "1"), ("chapter IV. x", "IV"), ("Chapter Vicious", "Vicious"), ("Chapter I-beam", "I"), ("Chapter civil-war", "civil"), ("Chapter Twenty-One", "Twenty-One"), ("Chapter 1.5", "1"),
    ("Chapter of accidents began", "of"), ("Chapter 1st", None), ("Chapter: 1", None), ("# Chapter 1", None), ("Chapters 1", None), ("Chapter Café", None), ("Chapter one_two", None), ("Prologue The", None),
    ("Prologue", "Prologue"), ("Prologue: a", "Prologue"), ("Prologue-x", "Prologue"), ("EPILOGUE — z", "EPILOGUE"), ("  chapter 7\r\n", "7"),
])
def test_headings(spark, line, label):
    assert spark.createDataFrame([(line,)], "l string").select(tx.heading_label(F.col("l"))).first()[0] == label


def test_all_line_ends(spark):
    text = "a\nb\r\nc\rd\x0be\x0cf\x1cg\x1dh\x1ei\x85j k \n\r\nz"
    assert spark.createDataFrame([(text,)], "t string").select(tx.lines(F.col("t"))).first()[0] == text.splitlines(keepends=True)


def test_many_chapters_and_units(spark):
    text = "".join(f"Chapter {i}\nx\n" for i in range(1, 121)) + "y\n" * 10000
    got = run(spark, ("big.txt", text.encode(), None))
    ids = [c[0] for c in chapters(got)]
    assert ids[98:101] == ["P99", "P100", "P101"] and len(ids) == 120
    assert got.units.where("unit_id = 'P120-U10002'").count() == 1
    assert violations(got) == []


def test_slugs(spark):
    rows = [("--A  b!C--", "a-b-c"), ("x" * 80, "x" * 63), ("a" * 62 + " b", "a" * 62), ("!!!", "0123456789ab")]
    df = spark.createDataFrame(rows, "t string, want string").withColumn("got", tx.slug(F.col("t"), F.lit("0123456789abcdef")))
    assert df.where("got <> want").count() == 0


BASE = b"Chapter 1\nOriginal\nChapter 2\nMore\n"


TAMPERING = [
    ("project.json", lambda c: b"{", {"V1"}), ("source/manifest.json", lambda c: b"[]", {"V1"}),
    ("project.json", lambda c: c.replace(b'"PRJ-s"', b'"PRJ-t"'), {"V2"}), ("source/manifest.json", lambda c: c + b" ", {"V3"}),
    ("source/original.txt", lambda c: b"\xff", {"V4"}), ("source/original.input.txt", lambda c: c + b"x", {"V5"}),
    ("source/original.txt", lambda c: c + b"x", {"V6", "V7", "V19", "V20"}),
    ("source/manifest.json", lambda c: c.replace(b'"chapter_id": "P02"', b'"chapter_id": "P01"'), {"V3", "V8", "V18a", "V18b"}),
    ("source/manifest.json", lambda c: c.replace(b'"source_end": 19', b'"source_end": "x"'), {"V3", "V9", "V10", "V20"}),
    ("source/manifest.json", lambda c: c.replace(b'"source_end": 19', b'"source_end": 18'), {"V3", "V10", "V12"}),
    ("source/chapters/p01.txt", lambda c: b"\xff", {"V11", "V20"}), ("source/chapters/p01.txt", lambda c: b"Chapter 1\nChanged!\n", {"V12", "V13", "V18e", "V20"}),
    ("source/chapters/p01.txt", lambda c: c + b"x", {"V12", "V13", "V14", "V18e", "V20"}),
    ("data/units/p02.units.jsonl", lambda c: b"\xff", {"V15"}), ("data/units/p02.units.jsonl", lambda c: c.split(b"\n")[0], {"V16", "V18e"}),
    ("data/units/p02.units.jsonl", lambda c: b"{\n" + c.split(b"\n", 1)[1], {"V17", "V18e"}), ("data/units/p02.units.jsonl", lambda c: c.replace(b"P02-U0001", b"P02-U0009"), {"V18a"}),
    ("data/units/p02.units.jsonl", lambda c: c.replace(b'"chapter_id":"P02"', b'"chapter_id":"P03"'), {"V18b"}), ("data/units/p02.units.jsonl", lambda c: c.replace(b'"source_text":"More\\n"', b'"source_text":5'), {"V18c", "V18e"}),
    ("data/units/p02.units.jsonl", lambda c: c.replace(b"More", b"Less"), {"V18d", "V18e"}),
    ("none", lambda c: c, set()),
]


def test_tampering(spark):
    """Each case is a project folder of its own, verified in one run."""
    good = [(r["path"], bytes(r["content"])) for r in project_files(run(spark, ("s.txt", BASE, None))).collect()]
    rows = [(f"case{k}", p, change(c) if p == path else c) for k, (path, change, _) in enumerate(TAMPERING) for p, c in good]
    got = {}
    for r in verify(spark.createDataFrame(rows, "project_id string, path string, content binary")).collect():
        got.setdefault(r["project_id"], set()).add(r["check_id"])
    assert [got.get(f"case{k}", set()) for k in range(len(TAMPERING))] == [found for _, _, found in TAMPERING]


def test_bytes_of_records(spark):
    """Manifests and projects are written as json.dumps(indent=2) and a line feed, units as compact lines; nothing but quotes, backslashes and control characters is escaped."""
    odd = 'Chapter 1: "a\\b"\n' + "".join(map(chr, [*range(1, 9), 11, 12, *range(14, 32), 127, 0x85, 0x2028])) + "/é🎉\t\r\n"
    got = run(spark, ("odd.txt", odd.encode(), 'T "\\" \x0b'), ("x.docx", docx("<w:r><w:t>Hi</w:t></w:r>"), None))
    files = {(r["project_id"], r["path"]): bytes(r["content"]) for r in project_files(got).collect()}
    assert len({p for p, _ in files}) == 2
    for (_, path), content in files.items():
        text = content.decode() if ".json" in path else ""
        if path.endswith(".json"):
            assert text == json.dumps(json.loads(text), ensure_ascii=False, indent=2) + "\n"
        if path.endswith(".jsonl"):
            assert text == "".join(json.dumps(json.loads(line), ensure_ascii=False, separators=(",", ":")) + "\n" for line in text.split("\n")[:-1])
            assert '"confidence":0,' in text


def test_own_records_fit_their_shapes(spark):
    got = run(spark, ("story.txt", MIXED.encode(), "Test Story"), ("x.docx", docx("<w:r><w:t>Hi</w:t></w:r>"), None))
    files = project_files(got).withColumn("json", F.col("content").cast("string")).withColumn("key", F.col("path"))
    assert check_records(files.where("path = 'project.json'"), "project").collect() == []
    assert check_records(files.where("path = 'source/manifest.json'"), "source_manifest").collect() == []
    units = files.where("path like '%.jsonl'").select("key", F.explode(F.split(F.regexp_replace("json", "\n$", ""), "\n")).alias("json"))
    assert check_records(units, "source_unit").collect() == []
