"""A passing and a failing row for rules, shapes, sinks, the command line and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from folioforge import cli
from folioforge.operators import rules
from folioforge.operators.constraints import SHAPES, check_records
from folioforge.operators.ingest import ingest, project_files
from folioforge.operators.verify import verify
from folioforge.plans import reports
from folioforge.sources import records
from folioforge.streaming.ingest import stream_ingest

E = {"source_unit_id": "P01-U0001", "quote": "q"}
CELL = {"value": None, "status": "unknown", "confidence": 0, "evidence": []}
BEAT = {"beat_id": "P01-S001-B001", "ordinal": 1, "summary_zh": "x", "change_type": "goal", "source_unit_ids": ["P01-U0001"]}
SCENE = {"scene_id": "P01-S001", "ordinal": 1, "int_ext": "INT", "location_id": None, "time_of_day": "day", "source_unit_ids": ["P01-U0001"], "evidence": [E], "beats": [BEAT]}
GOOD = {
    "chapter_analysis": {"schema_version": "2.0.0", "chapter_id": "P01", "source_sha256": "a" * 64, "source_unit_ids": ["P01-U0001"], "scenes": [SCENE]},
    "character": {"schema_version": "2.0.0", "character_id": "CHAR-0001", "canonical_name": "A", "chinese_name": None, "aliases": ["B"], "character_type": "named", "importance": "major", "evidence": []},
    "appearance": {"schema_version": "2.0.0", "appearance_id": "APP-P01-0001", "character_id": "CHAR-0001", "chapter_id": "P01", "scene_id": None, "appearance_type": "physical", "has_dialogue": True, "source_unit_ids": ["P01-U0001"], "evidence": [E]},
    "character_profile": {"schema_version": "2.0.0", "character_id": "CHAR-0001", "fields": {k: CELL for k in SHAPES["character_profile"].fields["fields"].fields}},
    "extension": {"manifest_version": "1.0.0", "module_id": "reports", "module_version": "1.0.0", "display_name": "R", "consumes": [{"data_type": "x", "version_range": "*"}], "produces": [{"artifact_type": "y", "format": "csv"}], "output_namespace": "extensions/reports/", "entrypoint": None},
}


def change(record, path, value):
    record = json.loads(json.dumps(record))
    at = record
    for k in path[:-1]:
        at = at[k]
    if value is KeyError:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return record


BAD = [
    ("chapter_analysis", ["source_unit_ids"], ["P01-U0001"] * 2, "uniqueItems"), ("chapter_analysis", ["scenes", 0, "int_ext"], "in", "enum"), ("chapter_analysis", ["scenes", 0, "beats", 0, "ordinal"], 0, "minimum"),
    ("chapter_analysis", ["scenes", 0, "evidence"], [], "minItems"), ("chapter_analysis", ["scenes", 0, "time_of_day"], KeyError, "required"), ("chapter_analysis", ["scenes", 0, "beats", 0, "beat_id"], "P01-B1", "pattern"),
    ("character", ["chinese_name"], 5, "type"), ("character", ["first_appearance_id"], "APP-1", "pattern"), ("character", ["canonical_name"], "", "minLength"), ("character", ["aliases"], "B", "type"), ("character", ["more"], 1, "additionalProperties"),
    ("appearance", ["has_dialogue"], "yes", "type"), ("appearance", ["scene_id"], "P01-S001\n", "pattern"), ("appearance", ["chapter_id"], None, "type"), ("appearance", ["schema_version"], "1.0.0", "const"),
    ("character_profile", ["fields", "age", "value"], 5, "unknown is null, all else has evidence"), ("character_profile", ["fields", "age", "status"], "explicit", "unknown is null, all else has evidence"), ("character_profile", ["fields", "age", "confidence"], 1.5, "maximum"), ("character_profile", ["fields", "hair"], KeyError, "required"),
    ("extension", ["output_namespace"], "extensions/", "pattern"), ("extension", ["consumes"], [], "minItems"), ("extension", ["produces", 0, "format"], "xml", "enum"), ("extension", ["consumes", 0, "required"], None, "type"), ("extension", ["module_version"], "1.0", "pattern"),
]


@pytest.mark.parametrize("kind", GOOD)
def test_shapes(spark, kind):
    cases = [("good", json.dumps(GOOD[kind]), set()), ("text", "{", {"json"}), ("list", "[]", {"type"})]
    cases += [(str(k), json.dumps(change(GOOD[kind], path, value)), {rule}) for k, (own, path, value, rule) in enumerate(BAD) if own == kind]
    got = {}
    for r in check_records(spark.createDataFrame([c[:2] for c in cases], "key string, json string"), kind).collect():
        got.setdefault(r["key"], set()).add(r["rule"])
    assert got == {k: want for k, _, want in cases if want}


def entities(df):
    return sorted(r["entity_id"] for r in df.collect())


def one(df):
    return df.withColumn("project_id", F.lit("PRJ-a"))


def test_scene_and_role_rules(spark):
    scenes = one(spark.createDataFrame([("s1", "INT", "LOC-0001", None, "day", ["u1"]), ("s2", "unknown", "LOC-0001", None, "day", ["u2"]), ("s3", "INT", None, "日常卧室", "day", ["u3"])], "scene_id string, int_ext string, location_id string, location_name string, time_of_day string, source_unit_ids array<string>"))
    assert entities(rules.vague_scenes(scenes)) == ["s2", "s3"]
    beats = one(spark.createDataFrame([("b1", "s1", ["u1"]), ("b2", "s1", ["u2"]), ("b3", "s9", ["u1"])], "beat_id string, scene_id string, source_unit_ids array<string>"))
    assert entities(rules.stray_beats(beats, scenes)) == ["b2", "b3"]
    people = one(spark.createDataFrame([("c1", "role", "Butler", ["Jim"], "candidate_major"), ("c2", "crowd", "Guests", ["Butler"], "minor"), ("c3", "role", "Cook", [], "candidate_major")], "character_id string, character_type string, canonical_name string, aliases array<string>, importance string"))
    assert entities(rules.merged_roles(people)) == ["c1"]
    majors = rules.confirmed_majors(people, one(spark.createDataFrame([("c3",), ("c2",)], "character_id string")))
    assert {r["character_id"]: r["importance"] for r in majors.collect()} == {"c1": "candidate_major", "c2": "minor", "c3": "major"}
    lines = one(spark.createDataFrame([("u1", "dialogue", None), ("u2", "dialogue", "c1"), ("u3", "action", None)], "unit_id string, text_type string, speaker_character_id string"))
    assert {r["unit_id"]: r["speaker"] for r in rules.dialogue(lines, people).collect()} == {"u1": "unknown", "u2": "Butler"}
    seen = spark.createDataFrame([("a1", "mentioned"), ("a2", "physical")], "appearance_id string, appearance_type string")
    assert {r["appearance_id"]: r["on_stage"] for r in rules.presence(seen).collect()} == {"a1": False, "a2": True}


def test_extension_rules(spark):
    e = one(spark.createDataFrame([("m", "extensions/m/"), ("n", "extensions/m/")], "module_id string, output_namespace string"))
    assert entities(rules.bad_namespaces(e)) == ["n"]
    o = one(spark.createDataFrame([("m", "extensions/m/x", "h", "1", "t"), ("n", "source/x", "h", "1", "t"), ("o", "deliverables/x", None, "1", "t")], "module_id string, path string, input_sha256 string, module_version string, generated_at string"))
    assert sorted((r["rule"], r["entity_id"]) for r in rules.bad_outputs(o).collect()) == [("X17", "n"), ("X18", "o")]


def test_summary_and_prompts(spark):
    chapters = one(spark.createDataFrame([("P01", 5), ("P02", 2)], "chapter_id string, unit_count long"))
    a = one(spark.createDataFrame([("P01", "s1", "c1", "physical"), ("P01", "s1", "c2", "mentioned")], "chapter_id string, scene_id string, character_id string, appearance_type string"))
    scenes = one(spark.createDataFrame([("P01", "s1", "Hall", "INT", "day")], "chapter_id string, scene_id string, location_name string, int_ext string, time_of_day string"))
    assert sorted(tuple(r)[1:] for r in reports.summary(chapters, a, scenes).collect()) == [("P01", 5, 1, 1, 1), ("P02", 2, 0, 0, 0)]
    looks = one(spark.createDataFrame([("c1", "hair", "red"), ("c1", "age", None), ("c2", "hair", "grey")], "character_id string, field string, value string"))
    assert [tuple(x) for x in reports.art_prompts(scenes, a, looks).first()["looks"]] == [("c1", "hair", "red")]


def test_projects_do_not_mix(spark):
    """Two projects that share all ids: what is missing or right in one says nothing about the other."""
    beats = spark.createDataFrame([("PRJ-a", "P01-S001-B001", ["P01-U0001"]), ("PRJ-b", "P01-S001-B001", ["P01-U0001"])], "project_id string, beat_id string, source_unit_ids array<string>")
    units = spark.createDataFrame([("PRJ-a", "P01-U0001")], "project_id string, unit_id string")
    assert [tuple(r)[:3] for r in rules.referential_integrity({"beats": beats, "units": units}).collect()] == [("PRJ-b", "X1 beat-unit", "P01-S001-B001")]
    assert [r["project_id"] for r in rules.dangling(beats, "beat_id", "source_unit_ids", units, "unit_id", "beat-unit").collect()] == ["PRJ-b"]
    chapters = spark.createDataFrame([("PRJ-a", "P01", "x"), ("PRJ-b", "P01", "y")], "project_id string, chapter_id string, sha256 string")
    assert rules.stale(chapters.withColumnRenamed("sha256", "source_sha256"), chapters).isEmpty()
    swapped = spark.createDataFrame([("PRJ-a", "P01", "y"), ("PRJ-b", "P01", "y")], "project_id string, chapter_id string, source_sha256 string")
    assert [r["project_id"] for r in rules.stale(swapped, chapters).collect()] == ["PRJ-a"]
    names = spark.createDataFrame([("PRJ-a", "Z", 1), ("PRJ-a", "Y", 2), ("PRJ-b", "Y", 9), ("PRJ-b", "Z", 9)], "project_id string, name string, at int")
    assert sorted(tuple(r) for r in rules.numbered_by_first(names, "name", ["at"], "CHAR").collect()) == [("PRJ-a", "Y", "CHAR-0002"), ("PRJ-a", "Z", "CHAR-0001"), ("PRJ-b", "Y", "CHAR-0001"), ("PRJ-b", "Z", "CHAR-0002")]


def test_hot_target_and_many_references(spark):
    """A character that everything refers to, and the eighteen references of an empty set of records."""
    units = spark.range(5000).select(F.lit("PRJ-a").alias("project_id"), F.concat(F.lit("U"), "id").alias("unit_id"), F.lit("CHAR-0001").alias("speaker_character_id"), F.lit("P01").alias("chapter_id"))
    people = spark.createDataFrame([("PRJ-b", "CHAR-0001")], "project_id string, character_id string")
    assert rules.referential_integrity({"units": units, "characters": people}).count() == 5000
    assert rules.referential_integrity({"units": units, "characters": people.withColumn("project_id", F.lit("PRJ-a"))}).isEmpty()
    assert rules.referential_integrity({"units": units.limit(0), "characters": people}).isEmpty()
    with pytest.raises(ValueError):
        rules.referential_integrity({"units": units})


def fits(have, wanted):
    """Ranges in plain Python."""
    order = lambda v: tuple(([int(x) if x.isdigit() else 0 for x in v.split(".")] + [0, 0])[:3])
    h = order(have)
    for c in wanted.split():
        sign = c.rstrip("0123456789.")
        if c == "*":
            continue
        w = order(c[len(sign) :])
        if not {"": h == w, "=": h == w, ">=": h >= w, ">": h > w, "<=": h <= w, "<": h < w, "^": h >= w and h[0] == w[0], "~": h >= w and h[:2] == w[:2]}.get(sign, False):
            return None
    return h


def test_version_search_equals_every_pair(spark):
    import itertools

    versions = [f"{a}.{b}.{c}" for a, b, c in itertools.product(range(3), repeat=3) if (a + 2 * b + c) % 4] + ["4", "1.1"]
    ranges = [f"{s}{a}.{b}.1" for s in ("", "=", ">=", ">", "<=", "<", "^", "~", "!") for a in range(4) for b in range(3)] + ["*", ">=1.0.0 <2.0.0", "^1 !", ">1.2 <=2.1.0 ~2.1", ">2 <1", "<=9", "^4"]
    modules = one(spark.createDataFrame([(f"m{i}", [("t", r, i % 2 == 0), ("none", r, None)]) for i, r in enumerate(ranges)], "module_id string, consumes array<struct<data_type:string,version_range:string,required:boolean>>"))
    have = one(spark.createDataFrame([("t", v) for v in versions], "data_type string, version string"))
    elsewhere = have.withColumn("project_id", F.lit("PRJ-z")).withColumn("data_type", F.lit("none"))
    got = {(r["module_id"], r["data_type"]): (r["version"], r["ready"]) for r in reports.extension_inputs(modules, have.union(elsewhere.select(have.columns))).collect()}
    for i, r in enumerate(ranges):
        best = max(((fits(v, r), v) for v in versions if fits(v, r)), default=(None, None))[1]
        assert got[f"m{i}", "t"] == (best, best is not None or i % 2 == 1), r
        assert got[f"m{i}", "none"] == (None, False)


def test_appearance_table_of_many_chapters(spark):
    n = 20_000
    chapters = one(spark.range(1, n + 1).select(F.concat(F.lit("P"), "id").alias("chapter_id"), F.col("id").alias("ordinal")))
    seen = [("c1", 1), ("c1", 7), ("c1", 7), ("c1", n), ("c2", 5)]
    a = one(spark.createDataFrame([(c, f"P{k}", "physical") for c, k in seen] + [("c2", "P9", "mentioned")], "character_id string, chapter_id string, appearance_type string"))
    lines = {r["character_id"]: r["line"] for r in reports.appearance_table(a, chapters).collect()}
    for c, cells in (("c1", {1: 1, 7: 2, n: 1}), ("c2", {5: 1})):
        assert lines[c] == ",".join([c, *(str(cells.get(k, 0)) for k in range(1, n + 1)), str(sum(cells.values()))])
    assert lines[None] == ",".join(["character_id", *(f"P{k}" for k in range(1, n + 1)), "total"])


def test_lint(spark):
    none = spark.createDataFrame([], "name string, json string")
    assert [r["check_id"] for r in records.lint_schemas(none).collect()] == ["L1"]
    docs = spark.createDataFrame([("a.json", '{"$ref":"b.json"}'), ("c.json", "{")], "name string, json string")
    assert sorted((r["check_id"], r["name"]) for r in records.lint_schemas(docs).collect()) == [("L2", "c.json"), ("L3", "b.json")]
    bad = spark.createDataFrame([("a.json", '{"items":{"type":"text"}}'), ("b.json", '{"const":{"type":"text"}}'), ("c.json", "[]")], "name string, json string")
    assert sorted((r["check_id"], r["name"]) for r in records.lint_schemas(bad).collect()) == [("L4", "a.json"), ("L4", "c.json")]


def test_projects_on_disk(spark, tmp_path):
    got = ingest(spark.createDataFrame([("s.txt", "Chapter 1\nä x\n".encode(), None), ("t.md", b"plain", None)], "filename string, content binary, title string"))
    files = project_files(got)
    root = str(tmp_path / "projects")
    assert sorted(records.write_projects(files, root)) == ["PRJ-s", "PRJ-t"]
    assert records.write_projects(files, root) == []
    back = records.read_projects(spark, root)
    assert back.exceptAll(files.select(*back.columns)).isEmpty() and verify(back).isEmpty()
    rows = records.read_jsonl(spark, f"{root}/PRJ-s/data").collect()
    assert [(r["row_no"], json.loads(r["raw"])["unit_id"]) for r in rows] == [(1, "P01-U0001"), (2, "P01-U0002")]
    records.write_jsonl(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first()[0] == '{"a":1,"b":null}'


def test_command_line(spark, tmp_path, capsys):
    source = tmp_path / "tale.txt"
    source.write_text("Chapter 1\nOnce.\n")
    target = tmp_path / "out" / "tale"
    assert cli.ingest_file(spark, source, target, "My Tale") is None
    assert json.loads((target / "project.json").read_text())["project_id"] == "PRJ-my-tale"
    assert cli.ingest_file(spark, source, target, None).startswith("project directory already exists")
    assert cli.ingest_file(spark, tmp_path / "none.txt", tmp_path / "x", None).startswith("source file not found")
    assert cli.violations(spark, target) == []
    (target / "source/chapters/p01.txt").write_text("Chapter 1\nTwice.\n")
    assert any(v.startswith("V12") for v in cli.violations(spark, target))


def test_exit_codes(spark, tmp_path, capsys):
    source = tmp_path / "odd [1] name.md"
    source.write_text("Prologue\nOnce.\nChapter 1\nTwice.\n")
    target = tmp_path / "p" / "odd"
    assert cli.main(["ingest", str(source), "--project-dir", str(target)]) == 0
    assert cli.main(["ingest", str(source), "--project-dir", str(target)]) == 1
    assert cli.main(["ingest", str(tmp_path / "none.txt"), "--project-dir", str(tmp_path / "q")]) == 1
    assert cli.main(["validate", str(target)]) == 0
    assert json.loads((target / "project.json").read_text())["project_id"] == "PRJ-odd-1-name"
    (target / "data/units/p01.units.jsonl").write_text("x\n")
    assert cli.main(["validate", str(target)]) == 1 and cli.main(["validate", str(tmp_path / "gone")]) == 1
    said = capsys.readouterr().out
    assert "INGESTION PASSED" in said and "INGESTION FAILED: project directory already exists" in said and "VALIDATE PASSED" in said and "- V17 P01 1" in said
    schemas = tmp_path / "schemas"
    schemas.mkdir()
    assert cli.main(["lint", str(schemas)]) == 1
    (schemas / "a.json").write_text('{"$ref":"b.json"}')
    assert cli.main(["lint", str(schemas)]) == 1
    (schemas / "b.json").write_text("{}")
    assert cli.main(["lint", str(schemas)]) == 0
    said = capsys.readouterr().out
    assert "- L1" in said and "- L3 b.json" in said and "LINT PASSED" in said


def test_stream(spark, tmp_path):
    inbox, target = tmp_path / "in", str(tmp_path / "tables")
    inbox.mkdir()
    for name in ("a.txt", "b.txt"):
        (inbox / name).write_text(f"Chapter 1\n{name}\n")
        stream_ingest(spark, str(inbox), target, str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(r["project_id"] for r in spark.read.parquet(f"{target}/projects").select("project_id").collect()) == ["PRJ-a", "PRJ-b"]
    assert spark.read.parquet(f"{target}/units").agg(F.count("*")).first()[0] == 4
