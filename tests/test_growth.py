"""Work that has to grow no faster than its input: how often inputs are read, and what is held at once."""

import pyarrow as pa
from pyspark.sql import functions as F

from folioforge.sources import records
from folioforge.sources.projects import _batches, _Reader, _Writer, read_folders, write_projects


def counted(spark, df):
    """df, and an accumulator of the rows that were read of it."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(look, df.schema), seen


def test_schema_files_are_read_once(spark):
    rows = [(f"p{k}.json", '{"properties":{"x":{"$ref":"p%d.json#/x"}}}' % (k + 1) if k % 5 else "{,}") for k in range(40)]
    docs, seen = counted(spark, spark.createDataFrame(rows, "name string, json string"))
    found = sorted((r["check_id"], r["name"]) for r in records.lint_schemas(docs).collect())
    assert found == sorted([("L2", f"p{k}.json") for k in range(0, 40, 5)] + [("L3", "p40.json")])
    assert seen.value == 40


def test_small_files_share_batches(spark, tmp_path):
    assert [b.num_rows for b in _batches(("p", f"{k}", b"x") for k in range(2500))] == [1000, 1000, 500]
    assert [b.num_rows for b in _batches(("p", f"{k}", b"x" * (3 << 20)) for k in range(3))] == [2, 1]
    rows = [(f"f{k % 3}", f"{'deep/' * (k % 2)}{k}.json", b"{}") for k in range(20)] + [("f0", "a.txt", b"")]
    write_projects(spark.createDataFrame(rows, "project_id string, path string, content binary"), f"{tmp_path}/p")
    assert sorted(map(tuple, records.folder_documents(spark, f"{tmp_path}/p").collect())) == sorted((f"{k}.json", "{}") for k in range(20))
    assert [tuple(r) for r in read_folders(spark, f"{tmp_path}/p", only="a.txt").collect()] == [("f0", "a.txt", b"")]
    reader = _Reader({"path": f"{tmp_path}/p"})
    assert sum(1 for part in reader.partitions() for _ in reader.read(part)) == 3  # a batch a folder, not a batch a file


def test_refused_projects_are_not_staged(spark, tmp_path):
    files = spark.createDataFrame([("a", "x", b"1"), ("b", "y", b"2")], "project_id string, path string, content binary")
    assert write_projects(files, f"{tmp_path}/p") == ["a", "b"]
    batch = pa.RecordBatch.from_pydict({"project_id": ["a", "a", "c"], "path": ["x", "y", "z"], "content": [b"3", b"4", b"5"]})
    writer = _Writer({"path": f"{tmp_path}/p", "job": "j"})
    staged = writer.write(iter([batch]))
    assert staged.projects == ["c"]
    assert sorted(str(f.relative_to(staged.folder)) for f in (tmp_path / "p" / ".staging-j").rglob("*") if f.is_file()) == ["c/z"]


def test_sources_are_ingested_once(spark):
    from folioforge.operators.ingest import ingest, project_files

    rows = [(f"s{k}.txt", f"Chapter 1\none {k}\nChapter 2\ntwo\n".encode(), None) for k in range(5)]
    files, seen = counted(spark, spark.createDataFrame(rows, "filename string, content binary, title string"))
    assert project_files(ingest(files)).count() == 5 * 8
    assert seen.value == 5 * 2  # decoding reads files that SQL decodes apart from those that it cannot


def test_verification_passes_over_files_five_times(spark):
    from folioforge.operators.verify import verify
    from tests.test_ledger import project

    rows = project(3, 12)
    files, seen = counted(spark, spark.createDataFrame(rows, "project_id string, path string, content binary"))
    assert verify(files).collect() == []
    assert seen.value <= 5 * len(rows)


def test_small_tables_with_much_work_are_spread(spark, sf):
    from folioforge.project_queries import planted_records

    _, planted = next(iter(planted_records(spark, sf)))
    assert planted.select(F.spark_partition_id().alias("p")).distinct().count() == 2 * spark.sparkContext.defaultParallelism


def test_keys_of_objects_are_taken_once(spark):
    """Objects are not written as JSON for their keys: each level would write all that is below it."""
    from folioforge.operators.constraints import SHAPES

    assert "json_object_keys" not in SHAPES["project"].violations("v", "")


def test_files_are_decoded_in_bounded_steps():
    from folioforge.functions.decode import STEP_BYTES, decode_batches

    size = STEP_BYTES // 4
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(10)), "kind": ["cp1252"] * 10, "content": [b"a" * size] * 8 + [None, b"\x80" * (2 * STEP_BYTES)]})
    got = list(decode_batches(iter([batch])))
    assert [b.num_rows for b in got] == [4, 5, 1]
    table = pa.Table.from_batches(got)
    assert table.column("doc_id").to_pylist() == list(range(10))
    assert [len(g["text"]) for g in table.column("got").to_pylist()] == [size] * 8 + [0, 2 * STEP_BYTES]


def test_units_are_rendered_as_chapters_are_put_together(spark):
    """Lines are windowed and gathered once; ids and digests of units are made once for each, and no buffer or sort holds a unit's row."""
    from folioforge.operators.ingest import _rendered, ingest

    files = spark.createDataFrame([("a.txt", b"x\nChapter 1\ny\n", None)], "filename string, content binary, title string")
    plan = _rendered(ingest(files).sources)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2  # projects that are there twice; marks of lines
    assert plan.count("collect_list(") == 1
    assert plan.count("-U%04d") == 1


def test_ordinary_lines_are_cut_and_passed_over_cheaply(spark):
    """Cutting and labelling looks at most characters once. All line ends are found among all other characters."""
    from folioforge.functions import text as tx

    assert not tx.LINE.startswith("[^") and tx.HEAD.startswith(r"(?isU)\A")
    ends = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
    near = [chr(c) for e in ends for c in (ord(e) - 1, ord(e) + 1) if chr(c) not in ends] + ["\x00", "\ud7ff", "\ue000", "\uffff", "\U0010ffff", "\u00e9", "\U0001f44d"]
    text = "".join(f"{n}a{n}{e}" for n in near for e in [*ends, "\r\n"]) + "".join(near)
    want = [f"{n}a{n}{e}" for n in near for e in [*ends, "\r\n"]] + ["".join(near)]
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(tx.lines(F.col("t"))).first()[0] == want
    heads = spark.createDataFrame([("Chapter 1\n", "1"), (" \x1cCHAPTER x\r\n", "x"), ("prologue", "prologue"), ("\u2003Epilogue: z\n", "Epilogue"), ("The chapter 1\n", None), ("chapters 1", None), ("", None)], "line string, label string")
    assert heads.where(~tx.heading_label(F.col("line")).eqNullSafe(F.col("label"))).collect() == []


def test_projects_are_published_side_by_side(spark, tmp_path, monkeypatch):
    import time

    from folioforge.sources import projects

    publish = projects._Place.publish

    def slow(self, project, staged):
        time.sleep(0.05)
        return publish(self, project, staged)

    monkeypatch.setattr(projects._Place, "publish", slow)
    writer = _Writer({"path": f"{tmp_path}/p", "job": "j"})
    names = [f"p{k:02d}" for k in range(64)]
    staged = writer.write(iter([pa.RecordBatch.from_pydict({"project_id": names, "path": ["x"] * 64, "content": [b"1"] * 64})]))
    began = time.time()
    writer.commit([staged])
    assert time.time() - began < 1.6  # one after the other: 3.2
    assert sorted(p.name for p in (tmp_path / "p").iterdir() if p.is_dir()) == names


def test_published_files_are_not_kept_twice(spark, sf):
    """Files are rows of the table of chapters; no second table of them is written."""
    from pathlib import Path

    from folioforge.project_queries import published_projects
    from folioforge.sources.shared import shared_dir

    tables = lambda: {p.name for p in Path(shared_dir(spark).removeprefix("file://")).glob("*-*")}
    before = tables()
    published_projects(spark, sf)
    assert sorted(name.rpartition("-")[0] for name in tables() - before) == ["chapters", "projects"]
