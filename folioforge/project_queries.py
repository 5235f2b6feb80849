"""Queries over whole projects: their files, planted faults, records, references, rules and deliverables.

Inputs are the books and the screenplay of `queries`; faults are planted by rules that the SQL repeats.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.functions.decode import steps
from folioforge.operators import constraints, rules
from folioforge.operators.ingest import ingest, project_files
from folioforge.operators.ledger import differences, differing, within
from folioforge.operators.verify import verify
from folioforge.plans import reports
from folioforge.queries import _APPEAR, _SCREEN, _WITH, _book_files, _in_projects, _one_project, _table, appearances, books, screenplay
from folioforge.registry import query
from folioforge.sources import records
from folioforge.sources.files import decode_sources, read_sources
from folioforge.sources.projects import read_folders
from folioforge.sources.shared import fresh_path, written

# -- files of projects -------------------------------------------------------------------------

_UNTOUCHED = ',"translation":{"zh_cn":null,"status":"pending"},"classification":{"text_type":"unknown","speaker_character_id":null,"speaker_label":null,"status":"unknown","confidence":0,"evidence":[]}}'
_FILES_SQL = f"""{_WITH},
unit_files AS (SELECT project_id, chapter_id, string_agg(concat('{{"schema_version":"2.0.0","unit_id":"', chapter_id, '-U', CASE WHEN ordinal < 10000 THEN printf('%04d', ordinal) ELSE CAST(ordinal AS VARCHAR) END, '","chapter_id":"', chapter_id, '","ordinal":', ordinal,
  ',"source_text":', to_json(line), ',"source_sha256":"', sha256(line), '"', '{_UNTOUCHED}', chr(10)), '' ORDER BY line_no) AS t FROM mm GROUP BY ALL),
listed AS (SELECT project_id, string_agg(concat('    {{\n      "chapter_id": "', chapter_id, '",\n      "ordinal": ', ordinal, ',\n      "heading": ', coalesce(to_json(heading), 'null'), ',\n      "source_label": ', coalesce(to_json(source_label), 'null'),
    ',\n      "source_start": ', source_start, ',\n      "source_end": ', source_end, ',\n      "character_length": ', source_end - source_start, ',\n      "sha256": "', sha256, '",\n      "source_path": "source/chapters/', lower(chapter_id), '.txt",\n      "units_path": "data/units/', lower(chapter_id), '.units.jsonl",\n      "unit_count": ', unit_count, '\n    }}'), ',\n' ORDER BY ordinal) AS cs,
  CASE WHEN max(any_h) = 0 THEN 'single_chapter_review' WHEN min(ordinal) = 0 THEN 'detected_with_preamble' ELSE 'detected' END AS status,
  CASE WHEN max(any_h) = 0 THEN '[\n      "No anchored chapter heading detected; retained as one chapter for review."\n    ]' ELSE '[]' END AS warnings FROM chapters GROUP BY project_id),
manifest AS (SELECT project_id, t, concat('{{\n  "schema_version": "2.0.0",\n  "project_id": "PRJ-', project_id, '",\n  "source": {{\n    "filename": "', project_id, '.txt",\n    "format": "txt",\n    "encoding": "utf-8",\n    "copy_path": "source/original.input.txt",\n    "byte_length": ', strlen(t), ',\n    "sha256": "', sha256(t), '",\n    "warnings": []\n  }},\n  "canonical": {{\n    "path": "source/original.txt",\n    "encoding": "utf-8",\n    "character_length": ', length(t), ',\n    "byte_length": ', strlen(t), ',\n    "sha256": "', sha256(t), '",\n    "rule": "text decoded as UTF-8; no content normalization"\n  }},\n  "chapter_detection": {{\n    "method": "anchored-heading-v1",\n    "status": "', status, '",\n    "warnings": ', warnings, '\n  }},\n  "chapters": [\n', cs, '\n  ]\n}}\n') AS m FROM book JOIN listed USING (project_id)),
files AS (
  SELECT project_id, 'source/manifest.json' AS path, m AS content FROM manifest
  UNION ALL SELECT project_id, 'project.json', concat('{{\n  "schema_version": "2.0.0",\n  "project_id": "PRJ-', project_id, '",\n  "title": "', project_id, '",\n  "pipeline_version": "2.0.0",\n  "state": "ingested",\n  "source_manifest": "source/manifest.json",\n  "artifacts": [\n    {{\n      "artifact_type": "source_manifest",\n      "path": "source/manifest.json",\n      "schema_version": "2.0.0",\n      "sha256": "', sha256(m), '"\n    }}\n  ]\n}}\n') FROM manifest
  UNION ALL SELECT project_id, unnest(['source/original.input.txt', 'source/original.txt']), t FROM book
  UNION ALL SELECT project_id, concat('source/chapters/', lower(chapter_id), '.txt'), chapter_text FROM chapters
  UNION ALL SELECT project_id, concat('data/units/', lower(chapter_id), '.units.jsonl'), t FROM unit_files)"""
_LISTED = " SELECT concat('PRJ-', project_id) AS project_id, path, CAST(strlen(content) AS BIGINT) AS n_bytes, sha256(content) AS sha256 FROM files"


def _digests(files: DataFrame) -> DataFrame:
    return files.select("project_id", "path", F.octet_length("content").cast("long").alias("n_bytes"), tx.digest(F.col("content")).alias("sha256"))


@query(_FILES_SQL + _LISTED)
def ingested_files(spark: SparkSession, sf: str) -> DataFrame:
    """All bytes of all project files."""
    return _digests(project_files(ingest(_book_files(spark, sf))))


@query(_FILES_SQL + _LISTED)
def published_projects(spark, sf):
    """Projects written as folders, refused the second time, and read back."""
    files = project_files(ingest(_book_files(spark, sf)))  # chapters are a table already, and files are rows of it
    root = fresh_path(spark, "projects")
    records.write_projects(files, root)
    if again := records.write_projects(files.withColumn("content", F.lit(b"other")), root):
        raise RuntimeError(f"projects were overwritten: {again[:3]}")
    return _digests(read_folders(spark, root))


@query(_FILES_SQL + _LISTED)
def ingested_folder(spark, sf):
    """The same project files, ingested from a folder of source files."""
    root = fresh_path(spark, "sources")
    files = _book_files(spark, sf)
    records.write_files(files.select(F.concat(F.substring(tx.digest(F.col("filename")), 1, 2), F.lit("/"), "filename").alias("path"), "content"), root)
    return _digests(project_files(ingest(read_sources(spark, root, glob="*.txt"))))


_PROJECT = "schema_version STRING, project_id STRING, title STRING, pipeline_version STRING, state STRING, source_manifest STRING, artifacts ARRAY<STRUCT<artifact_type:STRING,path:STRING,schema_version:STRING,sha256:STRING>>"


@query(_FILES_SQL + " SELECT concat('PRJ-', project_id) AS project_id, project_id AS title, 'ingested' AS state, concat('source_manifest source/manifest.json ', sha256(content)) AS artifact FROM files WHERE path = 'source/manifest.json'")
def project_records(spark, sf):
    """project.json of published folders, read as whole JSON files with their declared schema."""
    root = fresh_path(spark, "projects")
    records.write_projects(project_files(ingest(_book_files(spark, sf))), root)
    texts = read_folders(spark, root, only="project.json").select(F.col("content").cast("string").alias("json"))
    got = texts.select(F.from_json("json", _PROJECT).alias("r")).select("r.*")
    return got.select("project_id", "title", "state", F.concat_ws(" ", F.col("artifacts")[0]["artifact_type"], F.col("artifacts")[0]["path"], F.col("artifacts")[0]["sha256"]).alias("artifact"))


@query(_WITH + "SELECT 'first' AS side, project_id, chapter_id FROM chapters WHERE ordinal % 3 = 1 UNION ALL SELECT 'second', project_id, chapter_id FROM chapters WHERE ordinal % 3 = 1")
def run_differences(spark, sf):
    """Two runs of which the second has another text in every third chapter."""
    chapters = written(ingest(_book_files(spark, sf)).chapters.select("project_id", "chapter_id", "ordinal", "sha256"), "chapters")
    second = chapters.withColumn("sha256", F.when(F.col("ordinal") % 3 == 1, tx.digest(F.col("sha256"))).otherwise(F.col("sha256")))
    return differences(chapters, second, ["project_id", "chapter_id"]).select("side", F.substring("project_id", 5, 1000).alias("project_id"), "chapter_id")


@query(_WITH + "SELECT concat('PRJ-', project_id) AS project_id, chapter_id, sha256(string_agg(concat(CASE WHEN length(line) % 3 = 0 THEN '* ' ELSE '' END, line, ' / '), '' ORDER BY line_no)) AS sha256 FROM mm WHERE length(project_id) % 2 = 0 GROUP BY project_id, chapter_id HAVING bool_or(length(line) % 3 = 0)")
def rendered_again(spark, sf):
    """A second run changes units of some projects; only chapters with a changed unit are rendered again."""
    units = written(ingest(_book_files(spark, sf)).units.select("project_id", "chapter_id", "unit_id", "ordinal", "source_text"), "units")
    changed = (F.length("source_text") % 3 == 0) & (F.length("project_id") % 2 == 0)
    second = units.withColumn("source_text", F.when(changed, F.concat(F.lit("* "), "source_text")).otherwise(F.col("source_text")))
    again = within(second, differing(units, second, ["project_id", "chapter_id"]))
    return again.groupBy("project_id", "chapter_id").agg(tx.digest(tx.joined(F.concat("source_text", F.lit(" / ")), F.col("ordinal"))).alias("sha256"))


# -- planted faults ----------------------------------------------------------------------------

_KIND = "CAST(regexp_extract(project_id, '([0-9]+)-', 1) AS INT) % 20"
_FAULTS_SQL = f"""{_WITH},
ks AS (SELECT project_id, {_KIND} AS k, t FROM book),
cs AS (SELECT c.*, k, lead(chapter_id) OVER w AS next_id, max(ordinal) OVER (PARTITION BY project_id) AS last, min(ordinal) OVER (PARTITION BY project_id) AS low FROM chapters c JOIN ks USING (project_id) WINDOW w AS (PARTITION BY project_id ORDER BY ordinal)),
p1 AS (SELECT * FROM cs WHERE ordinal = 1),
u1 AS (SELECT project_id, k, chapter_id, ordinal, unit_count FROM (SELECT mm.*, k FROM mm JOIN ks USING (project_id)) JOIN (SELECT project_id, chapter_id, unit_count FROM p1) USING (project_id, chapter_id)),
whole AS (SELECT k, project_id, unnest(CASE k WHEN 0 THEN ['V1'] WHEN 1 THEN ['V2'] WHEN 2 THEN ['V3'] WHEN 3 THEN ['V4'] WHEN 4 THEN ['V5'] WHEN 5 THEN ['V6', 'V7', 'V19', 'V20'] WHEN 7 THEN ['V3', 'V20'] WHEN 8 THEN ['V3'] WHEN 9 THEN ['V20'] WHEN 11 THEN ['V3'] WHEN 18 THEN ['V20'] ELSE [] END) AS c FROM ks),
found AS (
  SELECT c, project_id, NULL AS entity, NULL AS r FROM whole
  UNION ALL SELECT 'V3', project_id, NULL, NULL FROM p1 WHERE k = 6 AND last >= 2
  UNION ALL SELECT 'V19', project_id, NULL, NULL FROM p1 WHERE k = 7 AND last = 1
  UNION ALL SELECT 'V10', project_id, next_id, NULL FROM p1 WHERE k = 7 AND next_id IS NOT NULL
  UNION ALL SELECT unnest(CASE k WHEN 7 THEN ['V9'] WHEN 8 THEN ['V10', 'V12'] WHEN 9 THEN ['V11'] WHEN 10 THEN ['V15'] WHEN 11 THEN ['V16'] WHEN 12 THEN ['V16'] WHEN 15 THEN ['V18e'] WHEN 17 THEN ['V16', 'V18e'] WHEN 18 THEN ['V12', 'V13', 'V14', 'V18e'] ELSE [] END), project_id, chapter_id, NULL FROM p1
  UNION ALL SELECT 'V8', project_id, chapter_id, NULL FROM p1 WHERE k = 6 AND last >= 2
  UNION ALL SELECT unnest(['V18a', 'V18b']), mm.project_id, 'P01', mm.ordinal FROM mm JOIN ks USING (project_id) WHERE k = 6 AND ch = 2
  UNION ALL SELECT 'V17', project_id, chapter_id, unit_count + 1 FROM p1 WHERE k = 12
  UNION ALL SELECT CASE k WHEN 13 THEN 'V18a' WHEN 15 THEN 'V18c' END, project_id, chapter_id, 1 FROM p1 WHERE k IN (13, 15)
  UNION ALL SELECT CASE k WHEN 14 THEN 'V18b' WHEN 16 THEN 'V18d' END, project_id, chapter_id, ordinal FROM u1 WHERE k IN (14, 16)
  UNION ALL SELECT 'V18a', project_id, chapter_id, ordinal FROM u1 WHERE k = 17 AND ordinal < unit_count)
SELECT c AS check_id, concat('PRJ-', project_id) AS project_id, CAST(entity AS VARCHAR) AS entity_id, CAST(r AS BIGINT) AS row_no FROM found"""


@query(_FAULTS_SQL)
def verification_faults(spark, sf):
    """Each project gets one of twenty faults (or none) by its number; verification finds them and what follows from them."""
    files = project_files(ingest(_book_files(spark, sf)))
    files = files.withColumn("k", F.expr(_KIND)).withColumn("s", F.col("content").cast("string"))
    here = lambda k, path: (F.col("k") == k) & (F.col("path") == path)
    manifest, chapter, units = "source/manifest.json", "source/chapters/p01.txt", "data/units/p01.units.jsonl"
    of_first = r'("chapter_id": "P01",[^}]*?"%s": )([0-9]+)'
    first_text = r'\A([^\n]*?"source_text":)"(?:[^"\\]|\\.)*"'
    change = [
        (0, "project.json", F.lit("{")),
        (1, "project.json", F.replace("s", F.lit('"PRJ-'), F.lit('"PRJ-x'))),
        (2, "project.json", F.regexp_replace("s", '"sha256": "[0-9a-f]+"', '"sha256": "0"')),
        (4, "source/original.input.txt", F.concat("s", F.lit("x"))),
        (5, "source/original.txt", F.concat("s", F.lit("x"))),
        (6, manifest, F.replace("s", F.lit('"chapter_id": "P02"'), F.lit('"chapter_id": "P01"'))),
        (7, manifest, F.regexp_replace("s", of_first % "source_start", '$1"$2"')),
        (8, manifest, F.regexp_replace("s", of_first % "source_start", "$1999999999")),
        (11, manifest, F.regexp_replace("s", of_first % "unit_count", "$1999999999")),
        (12, units, F.concat("s", F.lit("x\n"))),
        (13, units, F.replace("s", F.lit('"ordinal":1,'), F.lit('"ordinal":7777,'))),
        (14, units, F.replace("s", F.lit('"chapter_id":"P01"'), F.lit('"chapter_id":"P77"'))),
        (15, units, F.regexp_replace("s", first_text, "$15")),
        (16, units, F.regexp_replace("s", '"source_sha256":"[0-9a-f]+"', '"source_sha256":"0"')),
        (17, units, F.regexp_replace("s", r"\A[^\n]*\n", "")),
        (18, chapter, F.concat("s", F.lit("x"))),
    ]
    changed: Column = F.col("s")
    for k, path, value in change:
        changed = F.when(here(k, path), value).otherwise(changed)
    lost = here(3, "source/original.txt") | here(9, chapter) | here(10, units)
    damaged = written(files.where(~lost).select("project_id", "path", changed.cast("binary").alias("content")), "project-files")
    return verify(damaged).select("check_id", "project_id", "entity_id", "row_no")


# -- records and their shapes ------------------------------------------------------------------

_E = '{"source_unit_id":"P01-U0001","quote":"q"}'
_CELL = '{"value":null,"status":"unknown","confidence":0,"evidence":[]}'
_SHA = "a" * 64
# A good record of each kind (%d stands for the row's number), and its faults: what is replaced by what, and where that is found.
_RECORDS: dict[str, tuple[str, list[tuple[str, str, str, str]]]] = {
    "project": ('{"schema_version":"2.0.0","project_id":"PRJ-n%d","title":"T %d","pipeline_version":"2.0.0","state":"ingested","source_manifest":"source/manifest.json","artifacts":[{"artifact_type":"a","path":"b","schema_version":"c","sha256":"' + _SHA + '"}]}', [
        ('"title":"T %d"', '"title":""', "title", "minLength"), ('"PRJ-n%d"', '"PRJ-N%d"', "project_id", "pattern"), ('"ingested"', '"done"', "state", "enum"), ('"pipeline_version":"2.0.0"', '"pipeline_version":"2.0"', "pipeline_version", "pattern"),
        ('source/manifest.json', 'manifest.json', "source_manifest", "const"), ('"path":"b"', '"path":""', "artifacts[].path", "minLength"), (_SHA, "a", "artifacts[].sha256", "pattern"), (',"path":"b"', "", "artifacts[]", "required"), ('"state"', '"more":1,"state"', "", "additionalProperties"), ('"2.0.0","project', '"2.1.0","project', "schema_version", "const"),
    ]),
    "source_manifest": ('{"schema_version":"2.0.0","project_id":"PRJ-n%d","source":{"filename":"f","format":"txt","encoding":"utf-8","copy_path":"source/original.input.txt","byte_length":%d,"sha256":"' + _SHA + '","warnings":[]},"canonical":{"path":"source/original.txt","encoding":"utf-8","character_length":5,"byte_length":6,"sha256":"' + _SHA + '","rule":"r"},"chapter_detection":{"method":"anchored-heading-v1","status":"detected","warnings":["w"]},"chapters":[{"chapter_id":"P01","ordinal":1,"heading":null,"source_label":"1","source_start":0,"source_end":7,"character_length":7,"sha256":"' + _SHA + '","source_path":"source/chapters/p01.txt","units_path":"data/units/p01.units.jsonl","unit_count":1}]}', [
        ('"filename":"f"', '"filename":""', "source.filename", "minLength"), ('"txt"', '"pdf"', "source.format", "enum"), ("input.txt", "input.", "source.copy_path", "pattern"), ('"byte_length":%d', '"byte_length":-1', "source.byte_length", "minimum"), ('"warnings":[]', '"warnings":[3]', "source.warnings[]", "type"), ('"source/original.txt"', '"original.txt"', "canonical.path", "const"),
        ('"encoding":"utf-8","character', '"encoding":"utf-16","character', "canonical.encoding", "const"), ('"character_length":5', '"character_length":0', "canonical.character_length", "minimum"), ('"rule":"r"', '"rule":""', "canonical.rule", "minLength"), ("heading-v1", "heading-v2", "chapter_detection.method", "const"), ('"detected"', '"found"', "chapter_detection.status", "enum"),
        ('"heading":null', '"heading":5', "chapters[].heading", "type"), ('"source_end":7', '"source_end":0', "chapters[].source_end", "minimum"), ('"unit_count":1', '"unit_count":1.5', "chapters[].unit_count", "type"), ("chapters/p01.txt", "chapters/P01.txt", "chapters[].source_path", "pattern"), (',"source_start":0', "", "chapters[]", "required"), ("p01.units", "p1.units", "chapters[].units_path", "pattern"),
    ]),
    "source_unit": ('{"schema_version":"2.0.0","unit_id":"P01-U0001","chapter_id":"P01","ordinal":%d,"source_text":"","source_sha256":"' + _SHA + '","translation":{"zh_cn":null,"status":"pending"},"classification":{"text_type":"unknown","speaker_character_id":null,"speaker_label":null,"status":"unknown","confidence":0,"evidence":[' + _E + "]}}", [
        ('"ordinal":%d', '"ordinal":0', "ordinal", "minimum"), ("P01-U0001\",\"ch", "P01-U1\",\"ch", "unit_id", "pattern"), ('"source_text":""', '"source_text":null', "source_text", "type"), ('"pending"', '"done"', "translation.status", "enum"), ('"zh_cn":null', '"zh_cn":1', "translation.zh_cn", "type"), ('"zh_cn":null,', "", "translation", "required"),
        ('"speaker_character_id":null', '"speaker_character_id":"CHAR-1"', "classification.speaker_character_id", "pattern"), ('"text_type":"unknown"', '"text_type":"poem"', "classification.text_type", "enum"), ('"confidence":0', '"confidence":-0.5', "classification.confidence", "minimum"), ('"quote":"q"', '"quote":""', "classification.evidence[].quote", "minLength"), ('"quote":"q"', '"quote":"q","why":1', "classification.evidence[]", "additionalProperties"), ('"status":"unknown"', '"status":"sure"', "classification.status", "enum"),
    ]),
    "chapter_analysis": ('{"schema_version":"2.0.0","chapter_id":"P01","source_sha256":"' + _SHA + '","source_unit_ids":["P01-U0001"],"scenes":[{"scene_id":"P01-S001","ordinal":%d,"int_ext":"INT","location_id":"LOC-0001","time_of_day":"day","reality_layer":"present","source_unit_ids":["P01-U0002"],"evidence":[' + _E + '],"beats":[{"beat_id":"P01-S001-B001","ordinal":1,"summary_zh":"s","change_type":"goal","source_unit_ids":["P01-U0003"]}]}]}', [
        ('["P01-U0001"]', '["P01-U0001","P01-U0001"]', "source_unit_ids", "uniqueItems"), ('["P01-U0001"]', "[]", "source_unit_ids", "minItems"), (_SHA, "b", "source_sha256", "pattern"), ('"P01-S001"', '"P01-S1"', "scenes[].scene_id", "pattern"), ('"ordinal":%d', '"ordinal":0', "scenes[].ordinal", "minimum"), ('"INT"', '"IN"', "scenes[].int_ext", "enum"), ('"LOC-0001"', '"LOC-1"', "scenes[].location_id", "pattern"),
        ('"day"', '"late"', "scenes[].time_of_day", "enum"), ('"present"', '"past"', "scenes[].reality_layer", "enum"), ('["P01-U0002"]', "[]", "scenes[].source_unit_ids", "minItems"), ("[" + _E + "]", "[]", "scenes[].evidence", "minItems"), ('"P01-S001-B001"', '"P01-S001-B1"', "scenes[].beats[].beat_id", "pattern"), ('"summary_zh":"s"', '"summary_zh":""', "scenes[].beats[].summary_zh", "minLength"), ('"goal"', '"end"', "scenes[].beats[].change_type", "enum"), ('["P01-U0003"]', '["P01-U0003","P01-U0003"]', "scenes[].beats[].source_unit_ids", "uniqueItems"), ('"time_of_day":"day",', "", "scenes[]", "required"),
    ]),
    "character": ('{"schema_version":"2.0.0","character_id":"CHAR-0001","canonical_name":"A %d","chinese_name":null,"aliases":["B"],"character_type":"named","importance":"major","first_appearance_id":null,"evidence":[]}', [
        ('"A %d"', '""', "canonical_name", "minLength"), ('"chinese_name":null', '"chinese_name":5', "chinese_name", "type"), ('["B"]', '["B","B"]', "aliases", "uniqueItems"), ('["B"]', '[""]', "aliases[]", "minLength"), ('"named"', '"pet"', "character_type", "enum"), ('"major"', '"star"', "importance", "enum"), ('"first_appearance_id":null', '"first_appearance_id":"APP-1"', "first_appearance_id", "pattern"), ('"aliases":["B"],', "", "", "required"), ("CHAR-0001", "CHAR-00001", "character_id", "pattern"),
    ]),
    "appearance": ('{"schema_version":"2.0.0","appearance_id":"APP-P01-0001","character_id":"CHAR-0001","chapter_id":"P01","scene_id":null,"appearance_type":"physical","has_dialogue":true,"source_unit_ids":["P01-U0001"],"evidence":[' + _E + "]}", [
        ("APP-P01-0001", "APP-P1-0001", "appearance_id", "pattern"), ('"scene_id":null', '"scene_id":"S1"', "scene_id", "pattern"), ('"physical"', '"near"', "appearance_type", "enum"), ("true", '"yes"', "has_dialogue", "type"), ('["P01-U0001"]', "[]", "source_unit_ids", "minItems"), ("[" + _E + "]", "[]", "evidence", "minItems"), ('"chapter_id":"P01"', '"chapter_id":"01"', "chapter_id", "pattern"),
    ]),
    "character_profile": ('{"schema_version":"2.0.0","character_id":"CHAR-0001","fields":{' + ",".join(f'"{k}":{_CELL}' for k in constraints.PROFILE_FIELDS) + "}}", [
        (f'"age":{_CELL},', "", "fields", "required"), ('"fields":{', f'"fields":{{"mood":{_CELL},', "fields", "additionalProperties"), ('"age":{"value":null', '"age":{"value":5', "fields.age", "unknown is null, all else has evidence"), (f'"hair":{_CELL}', '"hair":{"value":"red","status":"explicit","confidence":1,"evidence":[]}', "fields.hair", "unknown is null, all else has evidence"),
        ('"clothing":{"value":null,"status":"unknown","confidence":0', '"clothing":{"value":null,"status":"unknown","confidence":1.5', "fields.clothing.confidence", "maximum"), ('"race":{"value":null,', '"race":{', "fields.race", "required"), ('"gender":{', '"gender":{"notes":3,', "fields.gender.notes", "type"),
    ]),
    "extension": ('{"manifest_version":"1.0.0","module_id":"reports","module_version":"1.0.%d","display_name":"R","consumes":[{"data_type":"x","version_range":"*","required":false}],"produces":[{"artifact_type":"y","format":"csv"}],"output_namespace":"extensions/reports/","entrypoint":null}', [
        ('"manifest_version":"1.0.0"', '"manifest_version":"2.0.0"', "manifest_version", "const"), ('"reports"', '"Reports"', "module_id", "pattern"), ('"1.0.%d"', '"1.%d"', "module_version", "pattern"), ('"display_name":"R"', '"display_name":""', "display_name", "minLength"), ('[{"data_type":"x","version_range":"*","required":false}]', "[]", "consumes", "minItems"), ('"required":false', '"required":0', "consumes[].required", "type"), ('"version_range":"*"', '"version_range":""', "consumes[].version_range", "minLength"), ('"csv"', '"xml"', "produces[].format", "enum"), ("extensions/reports/", "extensions/reports", "output_namespace", "pattern"), ('"entrypoint":null', '"entrypoint":{}', "entrypoint", "type"),
    ]),
}
_PLANTED = ", ".join(f"('{kind}', {i}, {len(faults)}, '{path}', '{rule}')" for kind, (_, faults) in _RECORDS.items() for i, (_, _, path, rule) in enumerate(faults))


_SHAPES_SQL = f"SELECT kind, path, rule, count(*) AS n, CAST(sum(c_custkey + 1) AS BIGINT) AS keys FROM customer JOIN (VALUES {_PLANTED}) f(kind, i, of, path, rule) ON c_custkey % (of + 1) = i GROUP BY kind, path, rule"


@query(_SHAPES_SQL)
def record_shapes(spark, sf):
    """Records of all eight kinds (the ninth schema holds what they share), one a customer and kind; each has one of its kind's faults by the customer's number, or none."""
    out = None
    for kind, planted in planted_records(spark, sf):
        found = constraints.check_records(planted, kind)
        rows = found.groupBy(F.lit(kind).alias("kind"), "path", "rule").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("key").cast("bigint")).alias("keys"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _spread(keys: DataFrame) -> DataFrame:
    """A small table whose rows are much work each: dealt to all cores, however few its files are."""
    return keys.repartition(2 * keys.sparkSession.sparkContext.defaultParallelism)


def planted_records(spark, sf):
    """Each kind of record, and frames of key and json: good ones and those with a fault."""
    people = _spread(_table(spark, sf, "customer").select("c_custkey"))
    for kind, (good, faults) in _RECORDS.items():
        number = (F.col("c_custkey") + 1).cast("string")
        fill = lambda s: F.replace(F.lit(s), F.lit("%d"), number)  # noqa: B023, E731
        record: Column = fill(good)
        for i, (old, new, _, _) in enumerate(faults):
            record = F.when(F.col("c_custkey") % (len(faults) + 1) == i, F.replace(fill(good), fill(old), fill(new))).otherwise(record)
        yield kind, people.select(number.alias("key"), record.alias("json"))


_STEP = f"SELECT *, turn // 3 + 1 AS s, concat(chapter_id, '-S', printf('%03d', CAST(turn // 3 + 1 AS INTEGER))) AS scene_id, concat('PRJ-', conv_id) AS project_id, concat('APP-', chapter_id, '-', printf('%04d', turn + 1)) AS appearance_id FROM ({_SCREEN})"


def _steps(spark, sf):
    s = screenplay(spark, sf)
    scene = tx.scene_id(F.col("chapter_id"), F.floor(F.col("turn") / 3) + 1)
    return s.drop("project_id").select("*", scene.alias("scene_id"), F.concat(F.lit("PRJ-"), "conv_id").alias("project_id"), tx.appearance_id(F.col("chapter_id"), F.col("turn") + 1).alias("appearance_id"))


def _record_files(spark, sf):
    """project_id, path, content: analyses, registries, appearances, profiles and an extension of each conversation's project."""
    s = written(_steps(spark, sf), "steps")
    js = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    version = F.lit("2.0.0").alias("schema_version")
    evidence = F.array(F.struct(F.col("unit_id").alias("source_unit_id"), F.substring("text", 1, 5).alias("quote")))
    beats = F.sort_array(F.collect_list(F.struct((F.col("turn") + 1).cast("int").alias("ordinal"), F.concat(F.col("scene_id"), F.lit("-B"), F.lpad(F.col("turn") + 1, 3, "0")).alias("beat_id"), F.lit("s").alias("summary_zh"), F.lit("goal").alias("change_type"), F.array("unit_id").alias("source_unit_ids"))))
    scenes = s.groupBy("project_id", "chapter_id", "scene_id").agg(F.sort_array(F.collect_list("unit_id")).alias("source_unit_ids"), beats.alias("beats"))
    scene = F.struct("scene_id", F.lit(1).alias("ordinal"), F.lit("INT").alias("int_ext"), F.lit(None).cast("string").alias("location_id"), F.lit("day").alias("time_of_day"), "source_unit_ids", F.transform("source_unit_ids", lambda u: F.struct(u.alias("source_unit_id"), F.lit("q").alias("quote"))).alias("evidence"), "beats")
    analysis = scenes.groupBy("project_id", "chapter_id").agg(F.sort_array(F.collect_list(scene)).alias("scenes"), F.sort_array(F.flatten(F.collect_list("source_unit_ids"))).alias("source_unit_ids"))
    people = s.groupBy("project_id", "role").agg(F.min("appearance_id").alias("first_appearance_id"))
    person = js(version, F.col("role").alias("character_id"), F.upper("role").alias("canonical_name"), F.lit(None).cast("string").alias("chinese_name"), F.array("role").alias("aliases"), F.lit("named").alias("character_type"), F.lit("major").alias("importance"), "first_appearance_id", F.array().cast(records.EVIDENCE).alias("evidence"))
    cell = F.struct(F.length("role").alias("value"), F.lit("inferred").alias("status"), F.lit(0.5).alias("confidence"), F.array().cast(records.EVIDENCE).alias("evidence"))
    profile = js(version, F.col("role").alias("character_id"), F.struct(cell.alias("age"), cell.alias("hair")).alias("fields"))
    appearance = js(version, "appearance_id", F.col("role").alias("character_id"), "chapter_id", "scene_id", F.lit("physical").alias("appearance_type"), (F.length("text") % 2 == 0).alias("has_dialogue"), F.array("unit_id").alias("source_unit_ids"), evidence.alias("evidence"))
    extension = F.concat(F.lit('{"manifest_version":"1.0.0","module_id":"m'), F.substring("project_id", 5, 99), F.lit('","module_version":"1.0.0","display_name":"M","consumes":[{"data_type":"scenes","version_range":"*"}],"produces":[],"output_namespace":"x"}'))
    array = lambda c: F.concat(F.lit("[\n"), F.array_join(F.sort_array(F.collect_list(c)), ",\n"), F.lit("\n]"))
    parts = [
        analysis.select("project_id", F.concat(F.lit("data/analysis/"), F.lower("chapter_id"), F.lit(".analysis.json")).alias("path"), js(version, "chapter_id", F.lit("h").alias("source_sha256"), "source_unit_ids", "scenes").alias("content")),
        people.groupBy("project_id").agg(array(person).alias("content")).select("project_id", F.lit("data/registries/characters.json").alias("path"), "content"),
        people.groupBy("project_id").agg(array(profile).alias("content")).select("project_id", F.lit("data/profiles.json").alias("path"), "content"),
        s.groupBy("project_id").agg(F.concat(F.array_join(F.sort_array(F.collect_list(appearance)), "\n"), F.lit("\n")).alias("content")).select("project_id", F.lit("data/appearances.jsonl").alias("path"), "content"),
        s.select("project_id").distinct().select("project_id", F.lit("extensions/m/extension.json").alias("path"), extension.alias("content")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("project_id", "path", F.col("content").cast("binary").alias("content"))


@query(f"""WITH s AS ({_STEP}) SELECT project_id, 'scene' AS kind, scene_id AS id, concat('INT ', count(*), ' ', string_agg(concat(scene_id, '-B', printf('%03d', turn + 1)), ' ' ORDER BY turn)) AS facts FROM s GROUP BY project_id, scene_id
  UNION ALL SELECT project_id, 'character', role, concat(upper(role), ' ', min(appearance_id)) FROM s GROUP BY project_id, role
  UNION ALL SELECT project_id, 'appearance', appearance_id, concat(role, ' ', scene_id, ' ', length(text) % 2 = 0, ' ', unit_id, ' ', substr(text, 1, 5)) FROM s
  UNION ALL SELECT DISTINCT project_id, 'profile', concat(role, ' ', f), concat('inferred ', length(role)) FROM s, (VALUES ('age'), ('hair')) t(f)
  UNION ALL SELECT DISTINCT project_id, 'extension', concat('m', conv_id), 'scenes *' FROM s""")
def typed_records(spark, sf):
    """Record files written as project folders and read back with their declared schemas."""
    root = fresh_path(spark, "records")
    records.write_projects(_record_files(spark, sf), root)
    files = written(read_folders(spark, root), "record-files")  # five kinds are read of them
    scenes = records.typed_records(files, "analysis").select("project_id", F.inline("scenes"))
    text = lambda *c: F.concat_ws(" ", *c)
    parts = [
        scenes.select("project_id", F.lit("scene").alias("kind"), F.col("scene_id").alias("id"), text("int_ext", F.size("evidence").cast("string"), F.array_join("beats.beat_id", " ")).alias("facts")),
        records.typed_records(files, "characters").select("project_id", F.lit("character").alias("kind"), F.col("character_id").alias("id"), text("canonical_name", "first_appearance_id").alias("facts")),
        records.typed_records(files, "appearances").select("project_id", F.lit("appearance").alias("kind"), F.col("appearance_id").alias("id"), text("character_id", "scene_id", F.col("has_dialogue").cast("string"), F.col("evidence")[0]["source_unit_id"], F.col("evidence")[0]["quote"]).alias("facts")),
        records.profile_fields(records.typed_records(files, "profiles")).select("project_id", F.lit("profile").alias("kind"), text("character_id", "field").alias("id"), text("status", F.expr("variant_get(value, '$', 'string')")).alias("facts")),
        records.typed_records(files, "extensions").select("project_id", F.lit("extension").alias("kind"), F.col("module_id").alias("id"), text(F.col("consumes")[0]["data_type"], F.col("consumes")[0]["version_range"]).alias("facts")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(f"SELECT CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS row_no, unit_id, length(text) AS n_chars, sha256(text) AS sha256, conv_id % 4 = 3 AND turn = 0 AS broken FROM ({_SCREEN})")
def jsonl_rows(spark, sf):
    """Unit rows written as JSON lines, a file a conversation, and read back with their numbers; some rows are no JSON."""
    s = screenplay(spark, sf)
    row = F.to_json(F.struct("unit_id", F.col("text").alias("source_text")))
    row = F.when((F.col("conv_id") % 4 == 3) & (F.col("turn") == 0), F.concat(F.lit("x"), row)).otherwise(row)
    files = s.groupBy("conv_id").agg(F.concat(tx.joined(F.concat(row, F.lit("\n")), F.col("turn"))).cast("binary").alias("content"))
    root = fresh_path(spark, "units")
    records.write_projects(files.select(F.concat(F.lit("c"), "conv_id").alias("project_id"), F.lit("units.jsonl").alias("path"), "content"), root)
    got = records.read_jsonl(spark, root)
    whole = F.coalesce("record", F.try_parse_json(F.substring("raw", 2, 2147483647)))
    text = F.try_variant_get(whole, "$.source_text", "string")
    return got.select("row_no", F.try_variant_get(whole, "$.unit_id", "string").alias("unit_id"), F.length(text).cast("long").alias("n_chars"), tx.digest(text).alias("sha256"), F.col("record").isNull().alias("broken"))


@query("""WITH d AS (SELECT concat('p', p_partkey, '.json') AS name, p_partkey % 5 = 2 AS bad, concat('p', p_partkey + 1, '.json') AS ref FROM part)
SELECT 'L2' AS check_id, name FROM d WHERE bad UNION ALL SELECT DISTINCT 'L3', ref FROM d WHERE NOT bad AND ref NOT IN (SELECT name FROM d) UNION ALL SELECT 'L1', NULL""")
def schema_lint(spark, sf):
    """A folder of schema files, one a part, each referring to the next one's; and an empty set of schemas."""
    number = F.col("p_partkey")
    body = F.when(number % 5 == 2, "{,}").otherwise(F.concat(F.lit('{"type":"object","properties":{"x":{"$ref":"p'), number + 1, F.lit('.json#/x"}}}')))
    root = fresh_path(spark, "schemas")
    folder = F.concat(F.lit("f"), F.floor(number / 1000))  # folders of a bounded size, so that more files mean more tasks
    records.write_projects(_table(spark, sf, "part").select(folder.alias("project_id"), F.concat(F.lit("p"), number, F.lit(".json")).alias("path"), body.cast("binary").alias("content")), root)
    found = records.lint_schemas(records.folder_documents(spark, root))
    none = records.lint_schemas(spark.createDataFrame([], "name string, json string"))
    return found.unionByName(none).select("check_id", "name")


_ZIP_NOTE = "DOCX auxiliary part retained in original file but not included in body baseline: "


def _as_docx(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in steps(batches, "text"):
        out = []
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            paragraphs = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(line)}</w:t></w:r></w:p>' for line in (text or "").split("\n"))
            if doc_id % 5 == 0:
                paragraphs += "<w:p><w:r><w:t>A</w:t><w:tab/><w:noBreakHyphen/></w:r><w:txbxContent><w:p><w:r><w:t>B</w:t><w:br/><w:softHyphen/></w:r></w:p></w:txbxContent></w:p>"
            file = io.BytesIO()
            with zipfile.ZipFile(file, "w") as z:
                z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{paragraphs}</w:body></w:document>')
                for name in ["word/header1.xml", "word/comments.xml", "word/styles.xml"][: doc_id % 4]:
                    z.writestr(name, "<x/>")
            out.append(file.getvalue())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "content"])


@query(f"""SELECT doc_id, 'docx-xml' AS encoding, sha256(concat(coalesce(text, ''), CASE WHEN doc_id % 5 = 0 THEN concat(chr(10), 'A', chr(9), chr(8209), 'B', chr(10), chr(173), chr(10), 'B', chr(10), chr(173)) ELSE '' END)) AS sha256,
  array_to_string(CASE doc_id % 4 WHEN 0 THEN [] WHEN 1 THEN ['{_ZIP_NOTE}word/header1.xml'] ELSE ['{_ZIP_NOTE}word/comments.xml', '{_ZIP_NOTE}word/header1.xml'] END, '; ') AS warnings FROM documents WHERE length(coalesce(text, '')) > 0 OR doc_id % 5 = 0""")
def docx_bodies(spark, sf):
    """Each document as a DOCX file, some with text boxes (a paragraph in a paragraph) and side parts, decoded again."""
    files = _table(spark, sf, "documents").select("doc_id", "text").mapInArrow(_as_docx, "doc_id bigint, content binary").withColumn("filename", F.lit("a.DOCX"))
    return decode_sources(files).where("reason is null").select("doc_id", "encoding", tx.digest(F.col("canonical_text")).alias("sha256"), F.array_join("warnings", "; ").alias("warnings"))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'utf-8-sig' WHEN 1 THEN 'utf-16-le-bom' WHEN 2 THEN 'utf-16-be-bom' ELSE 'utf-8' END AS encoding, sha256(text) AS sha256, CASE WHEN length(text) = 0 THEN 'source contains no text' END AS reason FROM documents WHERE text IS NOT NULL""")
def encodings(spark, sf):
    """Each document in one of four encodings, decoded to the same text."""
    code = F.col("doc_id") % 4
    content = F.when(code == 0, F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8"))).when(code == 1, F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-16LE"))).when(code == 2, F.concat(F.unhex(F.lit("FEFF")), F.encode("text", "UTF-16BE"))).otherwise(F.encode("text", "UTF-8"))
    files = _table(spark, sf, "documents").where("text is not null").select("doc_id", F.lit("a.md").alias("filename"), content.alias("content"))
    return decode_sources(files).select("doc_id", "encoding", tx.digest(F.col("canonical_text")).alias("sha256"), "reason")


@query("""WITH f AS (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS name, url FROM pages) SELECT page_id, CASE WHEN page_id % 3 = 0 THEN concat('T ', page_id) WHEN regexp_matches(name, '^.+\\.[^./]+$') THEN regexp_replace(name, '\\.[^./]+$', '') ELSE name END AS title FROM f""")
def default_titles(spark, sf):
    """The given title, else the file's stem; an empty title counts as none."""
    given = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("T "), "page_id")).when(F.col("page_id") % 3 == 1, "")
    return _table(spark, sf, "pages").select("page_id", F.coalesce(F.nullif(given, F.lit("")), tx.stem(F.col("url"))).alias("title"))


# -- references and rules ----------------------------------------------------------------------

_DROPPED = "conv_id % 6 = 5 AND turn = 1"


@query(f"""WITH s AS ({_STEP}), gone AS (SELECT unit_id FROM s WHERE {_DROPPED}), scenes AS (SELECT scene_id, chapter_id, conv_id, list(unit_id) AS us FROM s GROUP BY ALL)
SELECT 'X1 unit-speaker' AS rule, unit_id AS entity_id FROM s WHERE role = 'system' AND NOT ({_DROPPED}) UNION ALL SELECT 'X1 unit-chapter', unit_id FROM s WHERE conv_id % 9 = 8 AND NOT ({_DROPPED})
UNION ALL SELECT 'X1 scene-unit', scene_id FROM scenes WHERE list_has_any(us, (SELECT list(unit_id) FROM gone)) UNION ALL SELECT 'X1 scene-location', scene_id FROM scenes WHERE conv_id % 7 = 1
UNION ALL SELECT 'X1 beat-unit', concat(s.scene_id, '-B', printf('%03d', turn + 1)) FROM s WHERE {_DROPPED}
UNION ALL SELECT unnest(['X1 appearance-unit', 'X1 appearance-evidence']), appearance_id FROM s WHERE {_DROPPED} UNION ALL SELECT 'X1 appearance-character', appearance_id FROM s WHERE role = 'system' UNION ALL SELECT 'X1 appearance-chapter', appearance_id FROM s WHERE conv_id % 9 = 8
UNION ALL SELECT 'X1 appearance-scene', appearance_id FROM s WHERE turn = 4 UNION ALL SELECT 'X1 analysis-chapter', chapter_id FROM s WHERE conv_id % 9 = 8 GROUP BY chapter_id UNION ALL SELECT 'X1 analysis-unit', chapter_id FROM s WHERE {_DROPPED}
UNION ALL SELECT DISTINCT 'X1 profile-character', role FROM s WHERE role = 'system' UNION ALL SELECT 'X1 character-appearance', role FROM s WHERE role <> 'system' GROUP BY role""")
def reference_integrity(spark, sf):
    """All references of a project's records, with units, chapters, places and people taken away."""
    s = written(_steps(spark, sf), "steps")
    scene_units = s.groupBy("conv_id", "chapter_id", "scene_id").agg(F.collect_list("unit_id").alias("source_unit_ids"))
    location = F.when(F.col("conv_id") % 7 == 1, "LOC-9999").when(F.col("conv_id") % 7 != 0, "LOC-0001")
    scene_of = F.when(F.col("turn") == 4, "P00-S999").when(F.col("turn") != 5, F.col("scene_id"))
    tables = {
        "units": s.where(f"not ({_DROPPED})").select("unit_id", "chapter_id", F.col("role").alias("speaker_character_id")),
        "chapters": s.where("conv_id % 9 <> 8").select("chapter_id").distinct(),
        "locations": spark.range(1).select(F.lit("LOC-0001").alias("location_id")),
        "analyses": s.groupBy("chapter_id").agg(F.collect_list("unit_id").alias("source_unit_ids")),
        "scenes": scene_units.select("scene_id", location.alias("location_id"), "source_unit_ids"),
        "beats": s.select(F.concat("scene_id", F.lit("-B"), F.lpad(F.col("turn") + 1, 3, "0")).alias("beat_id"), F.array("unit_id").alias("source_unit_ids")),
        "characters": s.where("role <> 'system'").select(F.col("role").alias("character_id"), F.lit("APP-P00-9999").alias("first_appearance_id")).distinct(),
        "appearances": s.select("appearance_id", F.col("role").alias("character_id"), "chapter_id", scene_of.alias("scene_id"), F.array("unit_id").alias("source_unit_ids"), F.array(F.struct(F.col("unit_id").alias("source_unit_id"))).alias("evidence")),
        "profile_fields": s.select(F.col("role").alias("character_id")).distinct(),
    }
    return rules.referential_integrity({name: _one_project(t) for name, t in tables.items()}).select("rule", "entity_id")


@query("""SELECT 'X5' AS rule, CAST(doc_id AS VARCHAR) AS entity_id FROM labels WHERE toxic = 1 AND doc_id % 3 <> 0""")
def unknown_values(spark, sf):
    facts = _in_projects(_table(spark, sf, "labels"), "doc_id").select("project_id", "doc_id", F.when(F.col("toxic") == 1, "unknown").otherwise("explicit").alias("status"), F.when(F.col("doc_id") % 3 != 0, F.col("quality")).alias("value"))
    return rules.known_unknowns(facts, "doc_id").select("rule", "entity_id")


@query(f"""WITH s AS ({_STEP}), scenes AS (SELECT scene_id, conv_id, min(turn) AS t FROM s GROUP BY ALL)
SELECT 'X8' AS rule, scene_id AS entity_id FROM scenes WHERE conv_id % 4 = 0 OR t = 3 OR conv_id % 5 = 1 OR conv_id % 5 = 2
UNION ALL SELECT 'X9', concat(scene_id, '-B', turn) FROM s WHERE turn = 2 OR conv_id % 8 = 7""")
def scene_rules(spark, sf):
    """Vague scenes, and beats that leave their scene or have none."""
    s = _steps(spark, sf)
    scenes = s.groupBy("scene_id", "conv_id").agg(F.min("turn").alias("t"), F.collect_list(F.when(F.col("turn") != 2, F.col("unit_id"))).alias("source_unit_ids"))
    scenes = scenes.select("scene_id", "conv_id", "source_unit_ids", F.when(F.col("conv_id") % 4 == 0, "unknown").otherwise("INT").alias("int_ext"), F.when(F.col("t") == 3, "unknown").otherwise("day").alias("time_of_day"), F.when(F.col("conv_id") % 5 > 1, "LOC-0001").alias("location_id"), F.when(F.col("conv_id") % 5 == 2, "日常卧室").when(F.col("conv_id") % 5 == 0, "Hall").alias("location_name"))
    beats = s.select(F.concat_ws("-B", "scene_id", "turn").alias("beat_id"), "scene_id", F.array("unit_id").alias("source_unit_ids"))
    scenes, beats = _one_project(scenes), _one_project(beats)
    return rules.vague_scenes(scenes).unionByName(rules.stray_beats(beats, scenes.where("conv_id % 8 <> 7"))).select("rule", "entity_id")


@query(f"SELECT appearance_id, length(text) % 5 <> 0 AS on_stage FROM ({_STEP})")
def stage_presence(spark, sf):
    s = _steps(spark, sf).select("appearance_id", F.when(F.length("text") % 5 == 0, "mentioned").otherwise("physical").alias("appearance_type"))
    return rules.presence(s).select("appearance_id", "on_stage")


@query("""WITH c AS (SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN 'role' WHEN 1 THEN 'crowd' ELSE 'named' END AS t, c_nationkey AS n, c_mktsegment AS m, c_acctbal < 0 AS low FROM customer),
crowd AS (SELECT unnest([concat(m, n, low), concat('alias ', m)]) AS name FROM c WHERE t = 'crowd' AND low)
SELECT CAST(k AS VARCHAR) AS entity_id FROM c WHERE t = 'role' AND (concat(m, n, low) IN (SELECT name FROM crowd) OR (k % 2 = 0 AND concat('alias ', m) IN (SELECT name FROM crowd)))""")
def role_mergers(spark, sf):
    """Continuing roles that share a name or an alias with a crowd."""
    c = _table(spark, sf, "customer").withColumn("low", F.col("c_acctbal") < 0).withColumn("t", F.when(F.col("c_custkey") % 3 == 0, "role").when(F.col("c_custkey") % 3 == 1, "crowd").otherwise("named"))
    alias = F.array(F.concat(F.lit("alias "), "c_mktsegment"))
    none = F.array().cast("array<string>")
    people = c.where("t <> 'crowd' or low").select(F.col("c_custkey").alias("character_id"), F.col("t").alias("character_type"), F.concat("c_mktsegment", F.col("c_nationkey").cast("string"), F.col("low").cast("string")).alias("canonical_name"), F.when((F.col("t") == "crowd") | (F.col("c_custkey") % 2 == 0), alias).otherwise(none).alias("aliases"))
    return rules.merged_roles(_one_project(people)).select("entity_id")


@query("SELECT c_custkey AS character_id, CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'major' ELSE 'candidate_major' END ELSE 'minor' END AS importance FROM customer")
def major_confirmations(spark, sf):
    """Candidates become major only where someone confirmed them (here: ordered)."""
    people = _table(spark, sf, "customer").select(F.col("c_custkey").alias("character_id"), F.when(F.col("c_custkey") % 3 == 0, "candidate_major").otherwise("minor").alias("importance"))
    confirmed = _in_projects(_table(spark, sf, "orders").select(F.col("o_custkey").alias("character_id")), "character_id")
    return rules.confirmed_majors(_in_projects(people, "character_id"), confirmed).select("character_id", "importance")


@query("""SELECT 'X17' AS rule, CAST(p_partkey AS VARCHAR) AS entity_id FROM part WHERE p_partkey % 4 = 1
UNION ALL SELECT 'X17', CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 5 IN (2, 3) UNION ALL SELECT 'X18', CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 40""")
def extension_outputs(spark, sf):
    """Namespaces that are not the module's own, outputs outside their targets, and outputs without provenance."""
    p = _table(spark, sf, "part").select("p_partkey", "p_size", F.col("p_partkey").cast("string").alias("module_id"))
    modules = p.select("module_id", F.concat(F.lit("extensions/"), F.when(F.col("p_partkey") % 4 == 1, "other").otherwise(F.col("module_id")), F.lit("/")).alias("output_namespace"))
    path = F.when(F.col("p_partkey") % 5 == 2, "source/x").when(F.col("p_partkey") % 5 == 3, "extensions/other/x").when(F.col("p_partkey") % 5 == 4, "deliverables/x").otherwise(F.concat(F.lit("extensions/"), "module_id", F.lit("/x")))
    outputs = p.select("module_id", path.alias("path"), F.when(F.col("p_size") <= 40, "h").alias("input_sha256"), F.lit("1.0.0").alias("module_version"), F.lit("2024").alias("generated_at"))
    return rules.bad_namespaces(_one_project(modules)).unionByName(rules.bad_outputs(_one_project(outputs))).select("rule", "entity_id")


@query(f"SELECT unit_id, CASE role WHEN 'user' THEN 'Ann' ELSE 'unknown' END AS speaker FROM ({_SCREEN}) WHERE role <> 'system'")
def dialogue_lines(spark, sf):
    u = screenplay(spark, sf).select("project_id", "unit_id", F.when(F.col("role") == "system", "narration").otherwise("dialogue").alias("text_type"), F.when(F.col("role") == "user", "CHAR-0001").alias("speaker_character_id"))
    return rules.dialogue(u, spark.createDataFrame([("PRJ-all", "CHAR-0001", "Ann")], "project_id string, character_id string, canonical_name string")).select("unit_id", "speaker")


# -- reports and deliverables ------------------------------------------------------------------


@query(f"SELECT chapter_id, count(*) AS unit_count, count(DISTINCT CASE WHEN length(text) % 5 <> 0 THEN role END) AS characters, count(DISTINCT CASE WHEN length(text) % 5 = 0 THEN role END) AS mentioned, count(DISTINCT scene_id) AS scenes FROM ({_STEP}) GROUP BY chapter_id")
def chapter_summary(spark, sf):
    a = appearances(spark, sf)
    return reports.summary(a.groupBy("project_id", "chapter_id").agg(F.count(F.lit(1)).alias("unit_count")), a, a.select("project_id", "chapter_id", "scene_id").distinct()).drop("project_id")


@query(f"""WITH a AS ({_APPEAR}), scenes AS (SELECT scene_id, min(conv_id) AS c FROM a GROUP BY scene_id),
worn AS (SELECT scene_id, string_agg(concat(character_id, ' ', f, ' ', length(character_id)), ', ' ORDER BY character_id, f) AS looks FROM (SELECT DISTINCT scene_id, character_id FROM a WHERE appearance_type <> 'mentioned' AND character_id <> 'system'), (VALUES ('clothing'), ('hair')) t(f) WHERE NOT (f = 'hair' AND character_id = 'user') GROUP BY scene_id)
SELECT scene_id, concat('Place ', c) AS location_name, 'INT' AS int_ext, 'day' AS time_of_day, looks FROM scenes LEFT JOIN worn USING (scene_id)""")
def scene_prompts(spark, sf):
    a = appearances(spark, sf)
    scenes = a.groupBy("project_id", "scene_id").agg(F.min("conv_id").alias("c")).select("project_id", "scene_id", F.concat(F.lit("Place "), "c").alias("location_name"), F.lit("INT").alias("int_ext"), F.lit("day").alias("time_of_day"))
    looks = a.where("character_id <> 'system'").select("project_id", "character_id").distinct().select("project_id", "character_id", F.explode(F.array(F.lit("clothing"), F.lit("hair"))).alias("field"))
    looks = looks.withColumn("value", F.when(~((F.col("field") == "hair") & (F.col("character_id") == "user")), F.length("character_id").cast("string")))
    return reports.art_prompts(scenes, a, looks).drop("project_id").withColumn("looks", F.array_join(F.transform("looks", lambda x: F.concat_ws(" ", x["character_id"], x["field"], x["value"])), ", "))


_DELIVERABLES_SQL = f"""WITH a AS ({_APPEAR}),
lines AS (SELECT chapter_id, turn, concat('| ', replace(unit_id, '|', '\\|'), ' | ', role, ' | ', regexp_replace(replace(text, '|', '\\|'), '\\s+', ' ', 'g'), ' |') AS line, concat(unit_id, ',', role, ',', CASE WHEN regexp_matches(text, '[",\\r\\n]') THEN concat('"', replace(text, '"', '""'), '"') ELSE text END) AS csv FROM ({_SCREEN}))
SELECT concat('deliverables/scripts_bilingual/', lower(chapter_id), '.md') AS path, sha256(concat('| unit_id | speaker | text |\n| --- | --- | --- |\n', string_agg(line, chr(10) ORDER BY turn), chr(10))) AS sha256, true AS rebuilt FROM lines GROUP BY chapter_id
UNION ALL SELECT concat('deliverables/scripts_bilingual/', lower(chapter_id), '.csv'), sha256(concat('unit_id,speaker,text', chr(10), string_agg(csv, chr(10) ORDER BY turn), chr(10))), true FROM lines GROUP BY chapter_id
UNION ALL SELECT concat('deliverables/appearances.csv/', character_id, '/', chapter_id), sha256(concat(count(*), '/', sum(count(*)) OVER (PARTITION BY character_id))), true FROM a WHERE appearance_type <> 'mentioned' GROUP BY character_id, chapter_id"""


@query(_DELIVERABLES_SQL)
def deliverables(spark, sf):
    """Markdown and CSV files of a project, written, and rendered again from the facts into another folder: the same bytes."""
    script = screenplay(spark, sf).select("chapter_id", "unit_id", F.col("role").alias("speaker"), "text")
    digests = []
    for _ in range(2):
        root = fresh_path(spark, "deliverables")
        for kind, end in (("markdown", ".md"), ("csv", ".csv")):
            place = F.concat(F.lit("book/deliverables/scripts_bilingual/"), F.lower("chapter_id"), F.lit(end))
            records.write_files(records.table_files(script, "chapter_id", place, kind, ["unit_id"]), root)
        files = records.read_projects(spark, root).select("path", tx.digest(F.col("content")).alias("sha256"))
        records.write_csv(reports.appearance_cells(appearances(spark, sf)), f"{root}-appearances.csv")
        cells = spark.read.option("header", True).csv(f"{root}-appearances.csv")
        cells = cells.select(F.concat_ws("/", F.lit("deliverables/appearances.csv"), "character_id", "chapter_id").alias("path"), tx.digest(F.concat_ws("/", "appearances", "total")).alias("sha256"))
        digests.append(files.unionByName(cells))
    again = digests[1].withColumnRenamed("sha256", "again")
    return digests[0].join(again, "path", "full").select("path", "sha256", F.coalesce(F.col("sha256") == F.col("again"), F.lit(False)).alias("rebuilt"))
