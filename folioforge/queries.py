"""The engine's own queries over the driver's tables, and DuckDB SQL that gives the same rows.

Two views stand for books and scripts. A book is a source's documents among 500 ids in a row, in order
of id, with a heading line before each; some have front matter. A screenplay is a conversation: it is the chapter, its
turns are units, its roles are characters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators import constraints, ledger, rules
from folioforge.operators.ingest import chapters_of, detection, ingest, marked, marked_lines, project_files, units_of
from folioforge.operators.scan import read_blocks, text_blocks
from folioforge.operators.verify import verify
from folioforge.plans import reports
from folioforge.registry import query
from folioforge.sources.files import decode_sources
from folioforge.sources.records import file_references, missing_references, write_files
from folioforge.sources.shared import fresh_path, written

def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_PIECES = """SELECT book, rn, concat(CASE WHEN rn = 1 AND source LIKE '%5' THEN 'Front matter\n' ELSE '' END,
    CASE WHEN rn = 1 AND length(source) % 2 = 0 THEN 'Prologue' WHEN rn = n AND n > 2 THEN 'Epilogue: the end' ELSE concat('Chapter ', CAST(rn AS {string})) END, '\n', text, '\n') AS piece
  FROM (SELECT source, book, text, row_number() OVER (PARTITION BY book ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY book) AS n
    FROM (SELECT source, concat(source, '-', CAST(CAST(floor(doc_id / 500) AS BIGINT) AS {string})) AS book, doc_id, text FROM {documents}))"""


def _in_projects(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt to seven projects by a key."""
    return df.withColumn("project_id", F.concat(F.lit("PRJ-"), F.col(key) % 7))


def _one_project(df: DataFrame) -> DataFrame:
    return df.withColumn("project_id", F.lit("PRJ-all"))


def books(spark: SparkSession, sf: str) -> DataFrame:
    """project_id (the source and its run of documents), canonical_text."""
    pieces = spark.sql(_PIECES.format(string="STRING", documents="{d}"), d=_table(spark, sf, "documents"))
    return pieces.groupBy(F.col("book").alias("project_id")).agg(tx.joined(F.col("piece"), F.col("rn")).alias("canonical_text"))


def _book_files(spark: SparkSession, sf: str) -> DataFrame:
    return books(spark, sf).select(F.concat("project_id", F.lit(".txt")).alias("filename"), F.col("canonical_text").cast("binary").alias("content"), F.lit(None).cast("string").alias("title"))


_BOOK_SQL = f"""pieces AS ({_PIECES.format(string="VARCHAR", documents="documents")}),
book AS (SELECT book AS project_id, string_agg(piece, '' ORDER BY rn) AS t FROM pieces GROUP BY book)"""

_LINES_SQL = r"""
raw AS (SELECT project_id, ls, unnest(generate_series(1, len(ls))) AS p FROM (SELECT project_id, regexp_extract_all(t, '[^\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]*(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}])|[^\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]+') AS ls FROM book)),
l AS (SELECT project_id, p - 1 AS line_no, ls[p] AS line, regexp_replace(ls[p], '[\r\n]+$', '') AS c FROM raw),
lab AS (SELECT *, CASE WHEN regexp_matches(c, '^\s*(?:prologue|epilogue)(?:\s*[:.\-].*)?\s*$', 'i') THEN regexp_extract(c, '^\s*(prologue|epilogue)', 1, 'i')
  WHEN regexp_matches(c, '^\s*chapter\s+([0-9]+|[ivxlcdm]+|[a-z]+(?:-[a-z]+)*)\b.*$', 'i') THEN regexp_extract(c, '^\s*chapter\s+([0-9]+|[ivxlcdm]+|[a-z]+(?:-[a-z]+)*)\b', 1, 'i') END AS label FROM l),
a AS (SELECT *, CAST(sum(length(line)) OVER w - length(line) AS BIGINT) AS start, sum(CASE WHEN label IS NULL THEN 0 ELSE 1 END) OVER w AS c0, max(CASE WHEN label IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY project_id) AS any_h
  FROM lab WINDOW w AS (PARTITION BY project_id ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
m AS (SELECT *, CAST(CASE WHEN any_h = 0 THEN 1 ELSE c0 END AS INTEGER) AS ch FROM a),
mm AS (SELECT *, printf('P%02d', ch) AS chapter_id, CAST(row_number() OVER (PARTITION BY project_id, ch ORDER BY line_no) AS INTEGER) AS ordinal FROM m),
ct AS (SELECT project_id, ch AS ordinal, chapter_id, max(CASE WHEN label IS NOT NULL THEN trim(c) END) AS heading, max(label) AS label, max(any_h) AS any_h, min(start) AS source_start, CAST(max(start + length(line)) AS BIGINT) AS source_end,
  count(*) AS unit_count, string_agg(line, '' ORDER BY line_no) AS chapter_text FROM mm GROUP BY ALL),
chapters AS (SELECT *, CASE WHEN any_h = 1 AND ordinal = 0 THEN 'preamble' ELSE label END AS source_label, sha256(chapter_text) AS sha256 FROM ct)"""
_WITH = f"WITH {_BOOK_SQL}, {_LINES_SQL} "


@query(_WITH + "SELECT project_id, chapter_id, ordinal, heading, source_label, source_start, source_end, source_end - source_start AS character_length, sha256, concat('source/chapters/', lower(chapter_id), '.txt') AS source_path, concat('data/units/', lower(chapter_id), '.units.jsonl') AS units_path, unit_count FROM chapters")
def chapters(spark, sf):
    return chapters_of(marked_lines(books(spark, sf), "project_id"), "project_id").drop("chapter_text")


@query("SELECT doc_id, 'utf-8' AS encoding, CAST(length(text) AS BIGINT) AS n_chars, CAST(strlen(text) AS BIGINT) AS n_bytes, sha256(text) AS sha256 FROM documents")
def decode_fingerprint(spark, sf):
    files = _table(spark, sf, "documents").select("doc_id", F.lit("d.txt").alias("filename"), F.col("text").cast("binary").alias("content"))
    return decode_sources(files).select("doc_id", "encoding", F.length("canonical_text").cast("long").alias("n_chars"), F.octet_length("canonical_text").cast("long").alias("n_bytes"), tx.digest(F.col("content")).alias("sha256"))


_UNITS_SQL = _WITH + "SELECT project_id, concat(chapter_id, '-U', CASE WHEN ordinal < 10000 THEN printf('%04d', ordinal) ELSE CAST(ordinal AS VARCHAR) END) AS unit_id, chapter_id, ordinal, sha256(line) AS source_sha256 FROM mm"


@query(_UNITS_SQL)
def units(spark, sf):
    return units_of(marked_lines(books(spark, sf), "project_id"), "project_id").select("project_id", "unit_id", "chapter_id", "ordinal", "source_sha256")


@query(_UNITS_SQL)
def units_in_blocks(spark, sf):
    """The same units, of books that are cut into blocks of 64 kB and scanned in parts."""
    blocks = written(text_blocks(books(spark, sf), "project_id", "canonical_text"), "blocks")
    return units_of(marked(blocks, "project_id"), "project_id").select("project_id", "unit_id", "chapter_id", "ordinal", "source_sha256")


@query(_UNITS_SQL)
def units_of_files(spark, sf):
    """The same units, of books that are files: many tasks read each of them, a block at a time."""
    root = fresh_path(spark, "books")
    write_files(books(spark, sf).select(F.concat("project_id", F.lit(".txt")).alias("path"), F.col("canonical_text").cast("binary").alias("content")), root)
    blocks = read_blocks(spark, root).withColumn("project_id", F.regexp_extract("path", r"([^/]*)\.txt\z", 1)).drop("path")
    return units_of(marked(blocks, "project_id"), "project_id").select("project_id", "unit_id", "chapter_id", "ordinal", "source_sha256")


@query(_WITH + "SELECT project_id, start, trim(c) AS heading, label FROM mm WHERE label IS NOT NULL")
def headings(spark, sf):
    return marked_lines(books(spark, sf), "project_id").where("label is not null").select("project_id", "start", "heading", "label")


_EDGES = ["Chapter 1", "chapter IV. x", "Chapter Vicious", "Chapter I-beam", "Chapter civil-war", "Chapter Twenty-One", "Chapter 1.5", "Chapter of accidents began", "Chapter 1st", "Chapter: 1", "# Chapter 1", "Chapters 1", "Chapter one_two", "Prologue The", "Prologue", "Prologue: a", "Prologue-x", "EPILOGUE . z", "  chapter 7", "Chapter"]


_HEADS = """SELECT {edges} UNION ALL SELECT concat(CASE p_partkey % 9 WHEN 0 THEN 'Chapter ' WHEN 1 THEN '  CHAPTER  ' WHEN 2 THEN 'Prologue' WHEN 3 THEN 'Prologue: ' WHEN 4 THEN 'Chapter:' WHEN 5 THEN 'chapter IX ' WHEN 6 THEN 'Epilogue - ' WHEN 7 THEN 'The chapter ' ELSE 'Chapter ' END, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS {string}) ELSE '' END, CASE WHEN p_partkey % 3 = 0 THEN '. ' WHEN p_partkey % 3 = 1 THEN '' ELSE ' ' END, p_name) AS line FROM {part}"""
_HEAD_LINES = _HEADS.format(edges="unnest([" + ", ".join(f"'{e}'" for e in _EDGES) + "]) AS line", string="VARCHAR", part="part")


@query(f"WITH book AS (SELECT 'x' AS project_id, 'x' AS t), {_LINES_SQL.replace('l AS (SELECT project_id, p - 1 AS line_no, ls[p] AS line, regexp_replace(ls[p],', 'l AS (SELECT project_id, 0 AS line_no, line, regexp_replace(line,').replace('FROM raw),', f'FROM (SELECT line AS project_id, line FROM ({_HEAD_LINES}))),', 1)} SELECT line, label FROM lab")
def heading_labels(spark, sf):
    """Edge cases of headings, and a line made of every part's name."""
    edges = "explode(array(" + ", ".join(f"'{e}'" for e in _EDGES) + ")) AS line"
    lines = spark.sql(_HEADS.format(edges=edges, string="STRING", part="{p}"), p=_table(spark, sf, "part"))
    return lines.select("line", tx.heading_label(F.col("line")).alias("label"))


@query(_WITH + "SELECT project_id, CASE WHEN max(any_h) = 0 THEN 'single_chapter_review' WHEN min(ordinal) = 0 THEN 'detected_with_preamble' ELSE 'detected' END AS status FROM chapters GROUP BY project_id")
def chapter_status(spark, sf):
    return detection(chapters_of(marked_lines(books(spark, sf), "project_id"), "project_id"), "project_id").select("project_id", "status")


@query("SELECT doc_id, 'P01' AS chapter_id, CAST(length(text) AS BIGINT) AS source_end, sha256(text) AS sha256, CAST(len(regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+')) AS BIGINT) AS unit_count FROM documents WHERE length(text) > 0")
def single_chapter_review(spark, sf):
    texts = _table(spark, sf, "documents").select("doc_id", F.col("text").alias("canonical_text"))
    return chapters_of(marked_lines(texts, "doc_id"), "doc_id").select("doc_id", "chapter_id", "source_end", "sha256", "unit_count")


@query(_WITH + "SELECT concat('PRJ-', project_id) AS project_id, concat(project_id, '.txt') AS filename, CAST(length(t) AS BIGINT) AS character_length, CAST(strlen(t) AS BIGINT) AS byte_length, sha256(t) AS sha256, (SELECT count(*) FROM chapters c WHERE c.project_id = b.project_id) AS n_chapters FROM book b")
def manifests(spark, sf):
    got = ingest(_book_files(spark, sf))
    n = got.projects.select("project_id", "n_chapters")
    return got.sources.select("project_id", "filename", "canonical.character_length", "canonical.byte_length", "canonical.sha256").join(n, "project_id")


_CORRUPT_SQL = _WITH + """, bad AS (SELECT project_id, chapter_id, ordinal FROM chapters WHERE ordinal % 7 = 3)
SELECT check_id, concat('PRJ-', project_id) AS project_id, chapter_id AS entity_id FROM bad, (VALUES ('V12'), ('V13'), ('V14'), ('V18e')) v(check_id)
UNION ALL SELECT DISTINCT 'V20', concat('PRJ-', project_id), CAST(NULL AS VARCHAR) FROM bad"""


@query(_CORRUPT_SQL)
def integrity_violations(spark, sf):
    """A copy of the project files in which every seventh chapter file has a character too many."""
    files = written(project_files(ingest(_book_files(spark, sf))), "project-files")  # verification reads them many times
    number = F.regexp_extract("path", r"chapters/p([0-9]+)", 1)
    changed = files.withColumn("content", F.when((number != "") & (F.try_to_number(number, F.lit("99999")) % 7 == 3), F.concat(F.col("content"), F.lit(b"x"))).otherwise(F.col("content")))
    return verify(changed).select("check_id", "project_id", "entity_id")


@query("WITH t AS (SELECT DISTINCT source AS title FROM documents UNION SELECT DISTINCT p_name FROM part UNION SELECT DISTINCT url FROM pages), s AS (SELECT title, trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-') AS x FROM t) SELECT title, rtrim(substr(CASE WHEN x = '' THEN substr(sha256(title), 1, 12) ELSE x END, 1, 63), '-') AS slug FROM s")
def slugs(spark, sf):
    t = _table(spark, sf, "documents").select(F.col("source").alias("title")).union(_table(spark, sf, "part").select("p_name")).union(_table(spark, sf, "pages").select("url")).distinct()
    return t.select("title", tx.slug(F.col("title"), tx.digest(F.col("title"))).alias("slug"))


@query("SELECT page_id, lower(regexp_extract(url, '[^/](\\.[^./]+)$', 1)) AS suffix, CASE lower(regexp_extract(url, '[^/](\\.[^./]+)$', 1)) WHEN '.txt' THEN 'txt' WHEN '.md' THEN 'md' WHEN '.docx' THEN 'docx' END AS format FROM pages")
def formats(spark, sf):
    s = tx.suffix(F.col("url"))
    return _table(spark, sf, "pages").select("page_id", s.alias("suffix"), F.when(s.isin(".txt", ".md", ".docx"), F.substring(s, 2, 9)).alias("format"))


@query("""SELECT DISTINCT file FROM (SELECT concat('p', p_partkey + 1, '.json') AS file FROM part WHERE p_partkey % 4 <> 3 UNION SELECT concat('n', p_size, '.json') FROM part WHERE p_partkey % 4 <> 3)
  WHERE file NOT IN (SELECT concat('p', p_partkey, '.json') FROM part) AND file NOT IN (SELECT concat('n', n_nationkey, '.json') FROM nation)""")
def missing_refs(spark, sf):
    """Every part is a schema that refers to the next part's, to one of its size, and to itself."""
    next_part, size = F.concat(F.lit("p"), F.col("p_partkey") + 1, F.lit(".json")), F.concat(F.lit("n"), "p_size", F.lit(".json"))
    own = F.concat(F.lit('{"$ref":"'), next_part, F.lit('#/x","items":[{"$ref":"'), size, F.lit('"},{"deep":{"$ref":"#/local"}}],"$refs":"no.json"}'))
    parts = _table(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey", F.lit(".json")).alias("name"), F.when(F.col("p_partkey") % 4 == 3, "{").otherwise(own).alias("json"))
    nations = _table(spark, sf, "nation").select(F.concat(F.lit("n"), "n_nationkey", F.lit(".json")).alias("name"), F.lit("{}").alias("json"))
    documents = parts.unionByName(nations)
    return missing_references(file_references(documents), documents)


@query("""WITH r AS (SELECT conv_id, turn, conv_id % 5 = 0 AS a, turn % 3 = 1 AS b, conv_id % 7 = 2 AS c, turn = 2 AS d FROM conversations)
SELECT path, rule, count(*) AS n FROM (
  SELECT 'source_sha256' AS path, 'pattern' AS rule FROM r WHERE a UNION ALL SELECT '', 'additionalProperties' FROM r WHERE b
  UNION ALL SELECT 'classification.confidence', 'maximum' FROM r WHERE c UNION ALL SELECT 'classification.evidence[]', 'required' FROM r WHERE d) GROUP BY ALL""")
def record_checks(spark, sf):
    """Unit records with known faults, held against their shape."""
    t = _table(spark, sf, "conversations")
    chapter = F.lit("P01")
    evidence = F.when(F.col("turn") == 2, F.lit('[{"source_unit_id":"P01-U0001"}]')).otherwise('[{"source_unit_id":"P01-U0001","quote":"q"}]')
    text = F.regexp_replace(F.to_json(F.struct(F.col("text").alias("source_text"))), r"\A\{|\}\z", "")
    record = F.concat(
        F.lit('{"schema_version":"2.0.0","unit_id":"'), tx.unit_id(chapter, (F.col("turn") + 1).cast("int")), F.lit('","chapter_id":"P01","ordinal":'), (F.col("turn") + 1).cast("string"), F.lit(","), text,
        F.lit(',"source_sha256":"'), F.when(F.col("conv_id") % 5 == 0, "no hash").otherwise(tx.digest(F.col("text"))), F.lit('","translation":{"zh_cn":null,"status":"pending"},'), F.when(F.col("turn") % 3 == 1, '"extra":1,').otherwise(""),
        F.lit('"classification":{"text_type":"dialogue","status":"explicit","confidence":'), F.when(F.col("conv_id") % 7 == 2, "1.5").otherwise("0.5"), F.lit(',"evidence":'), evidence, F.lit("}}"),
    )
    found = constraints.check_records(t.select(F.concat_ws("-", "conv_id", "turn").alias("key"), record.alias("json")), "source_unit")
    return found.groupBy("path", "rule").agg(F.count(F.lit(1)).alias("n"))


_FACTS = "SELECT doc_id, CASE WHEN toxic = 1 THEN 'inferred' WHEN quality = 0 THEN 'unknown' ELSE 'explicit' END AS status, doc_id % 4 AS k FROM labels"
_E = "array<struct<source_unit_id:string,quote:string,note:string>>"


def _facts(spark, sf):
    e = F.array(F.struct(F.lit("P01-U0001").alias("source_unit_id"), F.lit("q").alias("quote"), F.when(F.col("k") == 2, "why").alias("note")))
    return spark.sql(_FACTS.replace("labels", "{l}"), l=_table(spark, sf, "labels")).withColumn("evidence", F.when(F.col("k") == 0, F.array().cast(_E)).otherwise(e.cast(_E)))


@query(f"SELECT 'X2' AS rule, CAST(doc_id AS VARCHAR) AS entity_id FROM ({_FACTS}) WHERE status <> 'unknown' AND k = 0 UNION ALL SELECT 'X3', CAST(doc_id AS VARCHAR) FROM ({_FACTS}) WHERE status = 'inferred' AND k <> 2")
def evidence_rules(spark, sf):
    facts = _in_projects(_facts(spark, sf), "doc_id")
    return rules.without_evidence(facts, "doc_id").unionByName(rules.unexplained(facts, "doc_id")).select("rule", "entity_id")


@query("SELECT DISTINCT CAST(doc_id AS VARCHAR) AS entity_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 10 <> 0)")
def dangling_references(spark, sf):
    labels, documents = (_in_projects(_table(spark, sf, t), "doc_id") for t in ("labels", "documents"))
    return rules.dangling(labels, "doc_id", "doc_id", documents.where("doc_id % 10 <> 0"), "doc_id", "label-document").select("entity_id")


_SCREEN = """SELECT conv_id, turn, role, text, printf('P%02d', conv_id) AS chapter_id, concat(printf('P%02d', conv_id), '-U', printf('%04d', turn + 1)) AS unit_id FROM conversations"""


def screenplay(spark, sf):
    """conv_id, turn, role, text, chapter_id, unit_id, and project_id: all conversations are chapters of one project."""
    t = _table(spark, sf, "conversations")
    chapter = tx.chapter_id(F.col("conv_id"))
    return _one_project(t.select("conv_id", "turn", "role", "text", chapter.alias("chapter_id"), tx.unit_id(chapter, F.col("turn") + 1).alias("unit_id")))


@query(f"SELECT unit_id AS entity_id FROM ({_SCREEN}) WHERE strpos(text, CASE WHEN turn % 2 = 0 THEN concat(substr(text, 2, 8), '~') ELSE substr(text, 2, 8) END) = 0")
def quotes_in_units(spark, sf):
    s = screenplay(spark, sf)
    quote = F.when(F.col("turn") % 2 == 0, F.concat(F.substring("text", 2, 8), F.lit("~"))).otherwise(F.substring("text", 2, 8))
    evidence = s.select("project_id", F.col("unit_id").alias("entity_id"), F.col("unit_id").alias("source_unit_id"), quote.alias("quote"))
    return rules.unquoted(evidence, s.select("project_id", "unit_id", F.col("text").alias("source_text"))).select("entity_id")


@query(f"SELECT conv_id, turn, CAST(sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS island FROM (SELECT conv_id, turn, CASE WHEN long IS DISTINCT FROM lag(long) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS new FROM (SELECT *, length(text) > 150 AS long FROM ({_SCREEN})))")
def scene_islands(spark, sf):
    s = screenplay(spark, sf).withColumn("long", F.length("text") > 150)
    return rules.islands(s, ["conv_id"], "turn", ["long"]).select("conv_id", "turn", "island")


@query(f"WITH s AS (SELECT *, length(text) > 150 AS long FROM ({_SCREEN})), i AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS scene FROM (SELECT *, CASE WHEN long IS DISTINCT FROM lag(long) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS new FROM s)), b AS (SELECT *, CASE WHEN role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id, scene ORDER BY turn) THEN 1 ELSE 0 END AS nb FROM i) SELECT conv_id, turn, concat(chapter_id, '-S', printf('%03d', CAST(scene AS INTEGER)), '-B', printf('%03d', CAST(sum(nb) OVER (PARTITION BY conv_id, scene ORDER BY turn) AS INTEGER))) AS beat_id FROM b")
def beat_islands(spark, sf):
    s = rules.islands(screenplay(spark, sf).withColumn("long", F.length("text") > 150), ["conv_id"], "turn", ["long"]).withColumnRenamed("island", "scene")
    b = rules.islands(s, ["conv_id", "scene"], "turn", ["role"])
    return b.select("conv_id", "turn", tx.beat_id(tx.scene_id(F.col("chapter_id"), F.col("scene")), F.col("island")).alias("beat_id"))


@query(f"SELECT role AS character_id, min_by(unit_id, conv_id * 1000000 + turn) AS first_appearance_id FROM ({_SCREEN}) GROUP BY role")
def first_appearances(spark, sf):
    s = screenplay(spark, sf).select("project_id", F.col("role").alias("character_id"), F.col("unit_id").alias("appearance_id"), "conv_id", "turn")
    return rules.first_appearances(s, ["conv_id", "turn"]).drop("project_id")


_APPEAR = f"SELECT conv_id, turn, chapter_id, role AS character_id, concat(chapter_id, '-S', printf('%03d', turn // 3 + 1)) AS scene_id, CASE WHEN length(text) % 5 = 0 THEN 'mentioned' ELSE 'dialogue' END AS appearance_type, length(text) % 2 = 0 AS has_dialogue, text FROM ({_SCREEN})"


def appearances(spark, sf):
    s = screenplay(spark, sf)
    return s.select("project_id", "conv_id", "turn", "chapter_id", F.col("role").alias("character_id"), tx.scene_id(F.col("chapter_id"), F.floor(F.col("turn") / 3) + 1).alias("scene_id"), F.when(F.length("text") % 5 == 0, "mentioned").otherwise("dialogue").alias("appearance_type"), (F.length("text") % 2 == 0).alias("has_dialogue"), "text")


@query(f"SELECT character_id, chapter_id, count(*) AS appearances, CAST(sum(CASE WHEN appearance_type = 'mentioned' THEN 1 ELSE 0 END) AS BIGINT) AS mentions FROM ({_APPEAR}) GROUP BY ROLLUP (character_id, chapter_id)")
def appearance_totals(spark, sf):
    return reports.appearance_totals(appearances(spark, sf)).drop("project_id")


@query(f"SELECT character_id, chapter_id, count(*) AS appearances, CAST(sum(count(*)) OVER (PARTITION BY character_id) AS BIGINT) AS total FROM ({_APPEAR}) WHERE appearance_type <> 'mentioned' GROUP BY character_id, chapter_id")
def appearance_matrix(spark, sf):
    return reports.appearance_cells(appearances(spark, sf)).drop("project_id")


@query(f"SELECT character_id, concat('name ', character_id) AS canonical_name, location_id, count(DISTINCT scene_id) AS scenes, count(*) AS appearances, max(has_dialogue) AS speaks FROM (SELECT *, CASE WHEN (turn // 3) % 2 = 0 THEN 'LOC-0001' ELSE 'LOC-0002' END AS location_id FROM ({_APPEAR})) WHERE character_id <> 'system' GROUP BY ALL")
def scene_statistics(spark, sf):
    a = appearances(spark, sf)
    scenes = a.select("project_id", "scene_id", F.when(F.floor(F.col("turn") / 3) % 2 == 0, "LOC-0001").otherwise("LOC-0002").alias("location_id")).distinct()
    people = a.select("project_id", "character_id").distinct().select("project_id", "character_id", F.concat(F.lit("name "), "character_id").alias("canonical_name"), F.when(F.col("character_id") != "system", "major").otherwise("minor").alias("importance"))
    return reports.scene_statistics(a, people, scenes).drop("project_id")


@query("SELECT CAST(doc_id AS VARCHAR) AS character_id, field, value, status, CAST(0.5 AS DOUBLE) AS confidence, n AS n_evidence FROM (SELECT doc_id, unnest(['age', 'gender']) AS field, unnest([CAST(quality AS VARCHAR), CAST(toxic AS VARCHAR)]) AS value, unnest(['explicit', 'inferred']) AS status, unnest([CAST(1 AS BIGINT), CAST(0 AS BIGINT)]) AS n FROM labels)")
def dossier(spark, sf):
    def cell(value, status, n):
        return F.struct(F.col(value).alias("value"), F.lit(status).alias("status"), F.lit(0.5).alias("confidence"), F.array_repeat(F.lit("P01-U0001"), n).alias("evidence"))

    p = _in_projects(_table(spark, sf, "labels"), "doc_id").select("project_id", F.col("doc_id").cast("string").alias("character_id"), cell("quality", "explicit", 1).alias("age"), cell("toxic", "inferred", 0).alias("gender"))
    return reports.dossier(p, ["age", "gender"]).drop("project_id")


@query(f"SELECT chapter_id, string_agg(concat(CASE WHEN role <> 'system' THEN concat(CASE role WHEN 'user' THEN 'Ann' ELSE 'unknown' END, ': ') ELSE '' END, regexp_replace(text, '[\\r\\n]+$', ''), ' / ', upper(role), chr(10)), '' ORDER BY turn) AS script FROM ({_SCREEN}) GROUP BY chapter_id")
def bilingual_script(spark, sf):
    s = screenplay(spark, sf)
    u = s.select("project_id", "chapter_id", F.col("turn").alias("ordinal"), F.col("text").alias("source_text"), F.upper("role").alias("zh_cn"), F.when(F.col("role") == "system", "narration").otherwise("dialogue").alias("text_type"), F.when(F.col("role") == "user", "CHAR-0001").alias("speaker_character_id"))
    return reports.bilingual_script(u, spark.createDataFrame([("PRJ-all", "CHAR-0001", "Ann")], "project_id string, character_id string, canonical_name string")).drop("project_id")


@query(f"SELECT chapter_id, count(*) AS units, CAST(sum(CASE WHEN turn % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS translated, CAST(sum(CASE WHEN turn % 4 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS pending_with_text FROM ({_SCREEN}) GROUP BY chapter_id")
def translation_coverage(spark, sf):
    s = screenplay(spark, sf)
    return rules.translation_coverage(s.select("project_id", "chapter_id", F.when(F.col("turn") % 2 == 0, "x").alias("zh_cn"), F.when(F.col("turn") % 4 == 0, "pending").otherwise("translated").alias("translation_status"))).drop("project_id")


@query("WITH a AS (SELECT DISTINCT source FROM documents WHERE doc_id % 2 = 0), f AS (SELECT source, min(doc_id) AS d FROM documents GROUP BY source), old AS (SELECT source, concat('CHAR-', printf('%04d', row_number() OVER (ORDER BY source))) AS character_id FROM a), n AS (SELECT count(*) AS n FROM a), new AS (SELECT source, concat('CHAR-', printf('%04d', n + row_number() OVER (ORDER BY d, source))) AS character_id FROM f, n WHERE source NOT IN (SELECT source FROM a)) SELECT character_id, source AS canonical_name FROM old UNION ALL SELECT character_id, source FROM new")
def registry_incremental(spark, sf):
    d = _one_project(_table(spark, sf, "documents").select(F.col("source").alias("canonical_name"), "doc_id"))
    old = rules.numbered_by_first(d.where("doc_id % 2 = 0"), "canonical_name", ["canonical_name"], "CHAR").select("project_id", F.col("id").alias("character_id"), "canonical_name")
    return ledger.extended_registry(old, d, order=["doc_id"]).drop("project_id")


@query("SELECT CAST(doc_id AS VARCHAR) AS entity_id FROM documents WHERE doc_id % 9 = 0 OR doc_id % 5 = 1")
def id_stability(spark, sf):
    d = _in_projects(_table(spark, sf, "documents"), "doc_id")
    after = d.where("doc_id % 9 <> 0").select("project_id", F.col("doc_id").alias("natural"), F.when(F.col("doc_id") % 5 == 1, -F.col("doc_id")).otherwise(F.col("doc_id")).alias("id"))
    return rules.changed_ids(d.select("project_id", F.col("doc_id").alias("natural"), F.col("doc_id").alias("id")), after, ["natural"], "id").select("entity_id")


@query("SELECT CAST(doc_id AS VARCHAR) AS entity_id, sha256(text) AS input_sha256 FROM documents WHERE NOT (doc_id % 3 = 0 AND doc_id % 2 = 0)")
def ledger_resume(spark, sf):
    items = _table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("entity_id"), tx.digest(F.col("text")).alias("input_sha256"), "doc_id")
    done = items.where("doc_id % 3 = 0").select("entity_id", F.when(F.col("doc_id") % 2 == 0, F.col("input_sha256")).otherwise("old").alias("input_sha256"), F.lit("structured").alias("stage"), F.lit("validated").alias("status"))
    return ledger.open_work(items.drop("doc_id"), done, "structured")


@query("SELECT chapter_id AS entity_id FROM (SELECT printf('P%02d', conv_id) AS chapter_id, conv_id FROM conversations GROUP BY conv_id) WHERE conv_id % 3 = 0")
def stale_analyses(spark, sf):
    c = screenplay(spark, sf).groupBy("project_id", "chapter_id", "conv_id").agg(F.max("text").alias("t")).select("project_id", "chapter_id", "conv_id", tx.digest(F.col("t")).alias("sha256"))
    return rules.stale(c.select("project_id", "chapter_id", F.when(F.col("conv_id") % 3 == 0, "old").otherwise(F.col("sha256")).alias("source_sha256")), c).select("entity_id")


@query("SELECT doc_id, CASE WHEN quality = 0 OR doc_id % 2 = 1 THEN 0 ELSE 1 END AS version, CASE WHEN quality = 0 THEN 'conflict' ELSE 'explicit' END AS status FROM labels")
def conflicts_kept(spark, sf):
    old = _in_projects(_table(spark, sf, "labels"), "doc_id").select("project_id", "doc_id", F.lit(0).alias("version"), F.when(F.col("quality") == 0, "conflict").otherwise("explicit").alias("status"))
    new = old.where("doc_id % 2 = 0").select("project_id", "doc_id", F.lit(1).alias("version"), F.lit("explicit").alias("status"))
    return rules.merged_keeping_conflicts(old, new, ["doc_id"]).drop("project_id")


@query("""WITH wants AS (SELECT p_partkey AS m, concat('t', p_size % 11) AS t, p_size % 6 AS a, p_partkey % 7 AS b, p_partkey % 6 AS k, p_size % 4 <> 1 AS required FROM part),
have AS (SELECT concat('t', s_suppkey % 9) AS t, s_nationkey % 6 AS a, CAST(s_suppkey AS INTEGER) % 13 AS b, s_nationkey AS c FROM supplier),
fit AS (SELECT m, wants.t, required, have.a * 1000000 + have.b * 1000 + have.c AS v, have.a || '.' || have.b || '.' || have.c AS version FROM wants LEFT JOIN have ON wants.t = have.t AND CASE k WHEN 0 THEN true WHEN 1 THEN have.a >= wants.a AND have.a < wants.a + 2
  WHEN 2 THEN have.a = wants.a AND have.b >= wants.b WHEN 3 THEN have.a = wants.a AND have.b = wants.b WHEN 4 THEN have.a * 1000000 + have.b * 1000 + have.c > wants.a * 1000000 + wants.b * 1000 ELSE have.a * 1000000 + have.b * 1000 + have.c <= wants.a * 1000000 + wants.b * 1000 END)
SELECT concat('m', m) AS module_id, t AS data_type, max_by(version, v) AS version, max(version) IS NOT NULL OR NOT bool_or(required) AS ready FROM fit GROUP BY m, t""")
def extension_match(spark, sf):
    """Every part is a module that wants one type of data in a range of versions; suppliers have the versions."""
    p = _table(spark, sf, "part").select("p_partkey", "p_size", (F.col("p_size") % 6).alias("a"), (F.col("p_partkey") % 7).alias("b"))
    at = lambda a: F.concat_ws(".", a, "b", F.lit("0"))
    k = F.col("p_partkey") % 6
    wanted = F.when(k == 0, "*").when(k == 1, F.concat(F.lit(">="), "a", F.lit(".0.0 <"), F.col("a") + 2, F.lit(".0.0"))).when(k == 2, F.concat(F.lit("^"), at("a"))).when(k == 3, F.concat(F.lit("~"), at("a"))).when(k == 4, F.concat(F.lit(">"), at("a"))).otherwise(F.concat(F.lit("<="), at("a")))
    required = F.when(F.col("p_size") % 4 == 1, False).when(F.col("p_size") % 4 == 2, True)  # null: the default, required
    modules = p.select(F.concat(F.lit("m"), "p_partkey").alias("module_id"), F.array(F.struct(F.concat(F.lit("t"), F.col("p_size") % 11).alias("data_type"), wanted.alias("version_range"), required.alias("required"))).alias("consumes"))
    have = _table(spark, sf, "supplier").select(F.concat(F.lit("t"), F.col("s_suppkey") % 9).alias("data_type"), F.concat_ws(".", F.col("s_nationkey") % 6, F.col("s_suppkey") % 13, "s_nationkey").alias("version"))
    return reports.extension_inputs(_one_project(modules), _one_project(have)).drop("project_id")


@query(r"""WITH d AS (SELECT doc_id, text, CASE WHEN doc_id % 4 = 0 AND NOT regexp_full_match(text, '[\x00-\x7F\x{A0}-\x{FF}]*') THEN 1 ELSE doc_id % 4 END AS k FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE k WHEN 0 THEN 'cp1252' WHEN 1 THEN 'utf-16-be-bom' WHEN 3 THEN 'utf-8' END AS encoding, CASE k WHEN 0 THEN sha256(concat(text, ' €')) WHEN 1 THEN sha256(text) WHEN 3 THEN sha256('') END AS sha256,
  CASE WHEN k = 2 THEN 'supported inputs: .txt, .md, .docx' WHEN k = 3 OR (k = 1 AND text = '') THEN 'source contains no text' END AS reason FROM d""")
def decoders(spark, sf):
    """Each document as a Windows-1252 file with a euro sign at its end (as UTF-16 where it has letters beyond), an unsupported file, or an empty one."""
    d = _table(spark, sf, "documents").where("text is not null").select("doc_id", "text")
    k = F.when((F.col("doc_id") % 4 == 0) & ~F.col("text").rlike(r"\A[\x00-\x7F\x{A0}-\x{FF}]*\z"), 1).otherwise(F.col("doc_id") % 4)
    d = d.withColumn("k", k)
    latin = F.concat(F.encode(F.when(F.col("k") == 0, F.col("text")), "ISO-8859-1"), F.unhex(F.lit("2080")))
    content = F.when(F.col("k") == 0, latin).when(F.col("k") == 1, F.concat(F.unhex(F.lit("FEFF")), F.encode("text", "UTF-16BE"))).when(F.col("k") == 2, F.encode("text", "UTF-8")).otherwise(F.lit(b""))
    name = F.when(F.col("k") == 2, "a.pdf").otherwise("a.txt")
    return decode_sources(d.select("doc_id", name.alias("filename"), content.alias("content"))).select("doc_id", "encoding", tx.digest(F.col("canonical_text")).alias("sha256"), "reason")
