"""Readers and writers of JSON records and project files, and the linter of schema files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.operators.schemas import HOLD_LISTED, HOLD_NAMED, HOLD_ONE, schema_faults
from folioforge.sources.filesystems import opened
from folioforge.sources.projects import read_folders, write_projects  # noqa: F401
from folioforge.sources.shared import written

# The shapes of the records that a project's folder holds beside its source. Those of locations and terms are this engine's choice, as only their places are prescribed.
EVIDENCE = "ARRAY<STRUCT<source_unit_id:STRING,quote:STRING,note:STRING>>"
_BEATS = "ARRAY<STRUCT<beat_id:STRING,ordinal:INT,summary_zh:STRING,change_type:STRING,source_unit_ids:ARRAY<STRING>>>"
_SCENES = f"""ARRAY<STRUCT<scene_id:STRING,ordinal:INT,int_ext:STRING,location_id:STRING,location_name:STRING,parent_location:STRING,sub_location:STRING,
  time_of_day:STRING,reality_layer:STRING,source_unit_ids:ARRAY<STRING>,evidence:{EVIDENCE},beats:{_BEATS}>>"""
RECORDS = {
    "analysis": f"schema_version STRING, chapter_id STRING, source_sha256 STRING, source_unit_ids ARRAY<STRING>, scenes {_SCENES}",
    "characters": f"schema_version STRING, character_id STRING, canonical_name STRING, chinese_name STRING, aliases ARRAY<STRING>, character_type STRING, importance STRING, first_appearance_id STRING, evidence {EVIDENCE}",
    "locations": f"schema_version STRING, location_id STRING, canonical_name STRING, chinese_name STRING, aliases ARRAY<STRING>, parent_location_id STRING, evidence {EVIDENCE}",
    "terminology": f"schema_version STRING, term STRING, zh_cn STRING, category STRING, notes STRING, evidence {EVIDENCE}",
    "appearances": f"schema_version STRING, appearance_id STRING, character_id STRING, chapter_id STRING, scene_id STRING, appearance_type STRING, has_dialogue BOOLEAN, source_unit_ids ARRAY<STRING>, evidence {EVIDENCE}",
    "profiles": f"schema_version STRING, character_id STRING, fields MAP<STRING, STRUCT<value:VARIANT,status:STRING,confidence:DOUBLE,evidence:{EVIDENCE},notes:STRING>>",
    "extensions": """manifest_version STRING, module_id STRING, module_version STRING, display_name STRING, description STRING, consumes ARRAY<STRUCT<data_type:STRING,version_range:STRING,required:BOOLEAN>>,
      produces ARRAY<STRUCT<artifact_type:STRING,format:STRING>>, output_namespace STRING, entrypoint STRING, config_schema STRING""",
}
#: Where they lie below a project's folder.
PLACES = {"analysis": "data/analysis/*.analysis.json", "characters": "data/registries/characters.json", "locations": "data/registries/locations.json", "terminology": "data/registries/terminology.json", "appearances": "data/appearances.jsonl", "profiles": "data/profiles.json", "extensions": "extensions/*/extension.json"}


def typed_records(files: DataFrame, kind: str) -> DataFrame:
    """project_id and the record's columns, from the project files (project_id, path, content) of this kind.

    A file is a record, an array of records, or, as JSONL, a record a line. Text that is no such
    record gives no row; verification and shape checks report it.
    """
    pattern = "^" + PLACES[kind].replace(".", "[.]").replace("*", "[^/]+") + "$"
    text = files.where(F.col("path").rlike(pattern)).select("project_id", F.col("content").cast("string").alias("json"))
    if PLACES[kind].endswith("jsonl"):
        text = text.select("project_id", F.explode(F.split("json", "\n")).alias("json"))
    array = F.col("json").rlike(r"\A\s*\[")
    rows = text.select("project_id", F.explode(F.when(array, F.from_json("json", f"ARRAY<STRUCT<{_as_struct(RECORDS[kind])}>>")).otherwise(F.array(F.from_json("json", f"STRUCT<{_as_struct(RECORDS[kind])}>")))).alias("r"))
    return rows.where("r is not null and r." + RECORDS[kind].split()[0] + " is not null").select("project_id", "r.*")


def _as_struct(ddl: str) -> str:
    """Top-level columns of a DDL string as fields of a struct."""
    return T.StructType.fromDDL(ddl).simpleString().removeprefix("struct<").removesuffix(">")


def profile_fields(profiles: DataFrame) -> DataFrame:
    """A row a field of each profile."""
    return profiles.select("project_id", "character_id", F.explode("fields").alias("field", "f")).select("project_id", "character_id", "field", "f.*")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Whole JSON documents with a declared schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_documents(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """name, json: each file's name and text."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    return files.select(F.regexp_extract(F.input_file_name(), r"([^/]*)\z", 1).alias("name"), F.col("value").alias("json"))


def folder_documents(spark: SparkSession, root: str, *, only: str = "*.json") -> DataFrame:
    """name, json: the files of published folders. Tasks list and open them, so that millions of small files are no load to the driver."""
    return read_folders(spark, root, only=only).select(F.regexp_extract("path", r"([^/]*)\z", 1).alias("name"), F.col("content").cast("string").alias("json"))


def read_jsonl(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """name, row_no (from 1), raw, record (VARIANT, null where the row is no JSON). Rows end at line feeds only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    text = F.regexp_replace(F.col("content").cast("string"), r"\n\z", "")
    rows = files.select(F.regexp_extract("path", r"([^/]*)\z", 1).alias("name"), F.posexplode(F.split(text, "\n")).alias("i", "raw"))
    return rows.select("name", (F.col("i") + 1).cast("long").alias("row_no"), "raw", F.try_parse_json("raw").alias("record"))


def write_jsonl(df: DataFrame, path: str) -> None:
    """A record a line, nulls kept. An existing target is refused."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("errorifexists").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def _csv_line(columns: list[Column]) -> Column:
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    quoted = [F.when(t.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(t) for t in text]
    return F.concat_ws(",", *quoted)


def _markdown_line(columns: list[Column]) -> Column:
    text = [F.regexp_replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), r"\s+", " ") for c in columns]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *text), F.lit(" |"))


def table_files(df: DataFrame, by: str, path: Column, kind: str, order: list[str]) -> DataFrame:
    """K9: (path, content): the rows of each value of `by`, such as a chapter, as one text, "csv" or "markdown".

    Rows stand in the given order, a heading first; lines end in line feeds. A table that has no
    such bounded groups is written by write_csv.
    """
    columns = [c for c in df.columns if c != by]
    line, head = (_csv_line, _csv_line([F.lit(c) for c in columns])) if kind == "csv" else (_markdown_line, F.concat(_markdown_line([F.lit(c) for c in columns]), F.lit("\n|" + " --- |" * len(columns))))
    rows = df.select(path.alias("path"), F.struct(*order).alias("o"), line([F.col(c) for c in columns]).alias("line"))
    listed = rows.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "line"))), lambda x: x["line"]), "\n").alias("body"))
    return listed.select("path", F.concat(head, F.lit("\n"), "body", F.lit("\n")).cast("binary").alias("content"))


def write_files(files: DataFrame, root: str) -> int:
    """Writes (path, content) below a folder, by any Arrow filesystem, each file under a name of its own first; returns how many."""

    def put(batches: Iterator) -> Iterator:
        import pyarrow as pa

        system, base = opened(root)
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                folder, _, name = f"{base.rstrip('/')}/{path}".rpartition("/")
                system.create_dir(folder, recursive=True)
                part = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(content)
                system.move(part, f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return files.select("path", "content").mapInArrow(put, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_projects(spark: SparkSession, root: str) -> DataFrame:
    """project_id (the folder's name), path, content of all project files, by Spark's own reader and any Hadoop filesystem. It passes over empty files; projects.read_folders gives them too."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    inner = F.substring("path", len(whole) + 2, 1 << 30)
    return files.select(F.split_part(inner, F.lit("/"), F.lit(1)).alias("project_id"), F.regexp_replace(inner, "^[^/]*/", "").alias("path"), "content")


def document_nodes(documents: DataFrame) -> DataFrame:
    """All nodes of JSON documents (name, json): name, path, key (null in arrays), kind, value.

    kind is what a node is where documents are schemas: a "schema", a holder of schemas ("named" or
    "listed"), or "other". The walk is a recursive query, a level a step; text that is no JSON has no node.
    """
    spark = documents.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # it guards against endless recursion; here each step is a level deeper
    inside = lambda names: ", ".join(f"'{n}'" for n in names)
    return spark.sql(
        f"""WITH RECURSIVE nodes(name, path, key, kind, value) MAX RECURSION LEVEL 10000 AS (
          SELECT name, '', CAST(NULL AS STRING), 'schema', try_parse_json(json) FROM {{documents}} WHERE try_parse_json(json) IS NOT NULL
          UNION ALL
          SELECT n.name, concat(n.path, '/', coalesce(c.key, CAST(c.pos AS STRING))), c.key,
            CASE WHEN n.kind IN ('named', 'listed') THEN 'schema' WHEN n.kind = 'other' THEN 'other' WHEN c.key IN ({inside(HOLD_ONE)}) THEN 'schema' WHEN c.key IN ({inside(HOLD_NAMED)}) THEN 'named' WHEN c.key IN ({inside(HOLD_LISTED)}) THEN 'listed' ELSE 'other' END,
            c.value
          FROM nodes n, LATERAL variant_explode(n.value) AS c)
        SELECT * FROM nodes""",
        documents=documents.select("name", "json"),
    )


def lint_schemas(documents: DataFrame) -> DataFrame:
    """documents: name, json. Findings (check_id, name, message) of a set of schema files.

    L1 no files; L2 not JSON; L3 a reference to a file that is not there; L4 a keyword whose value no schema may have.
    The files are read once, and walked once.
    """
    documents = written(documents.select("name", "json"), "schema-files")
    none = documents.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("L1").alias("check_id"), F.lit(None).cast("string").alias("name"), F.lit("no schema files found").alias("message"))
    bad = documents.where(F.try_parse_json("json").isNull()).select(F.lit("L2").alias("check_id"), "name", F.lit("invalid JSON").alias("message"))
    nodes = written(document_nodes(documents).where("kind = 'schema' or key = '$ref'").select("name", "path", "key", "kind", "value"), "schema-nodes")
    missing = missing_references(_named_files(nodes), documents).select(F.lit("L3").alias("check_id"), F.col("file").alias("name"), F.lit("missing schema reference").alias("message"))
    broken = schema_faults(nodes.where("kind = 'schema'")).select(F.lit("L4").alias("check_id"), "name", F.concat(F.lit("not a schema: "), F.concat_ws(" ", "at", "path", "rule")).alias("message"))
    return none.unionByName(bad).unionByName(missing).unionByName(broken)


def _named_files(nodes: DataFrame) -> DataFrame:
    refs = nodes.where("key = '$ref'").select(F.try_variant_get("value", "$", "string").alias("ref"), F.schema_of_variant("value").alias("t")).where("t = 'STRING'")
    return refs.select(F.split_part("ref", F.lit("#"), F.lit(1)).alias("file")).where("file <> ''").distinct()


def file_references(documents: DataFrame) -> DataFrame:
    """file: the files that references of the documents name, at any depth."""
    return _named_files(document_nodes(documents))


def missing_references(refs: DataFrame, documents: DataFrame) -> DataFrame:
    return refs.join(documents.select(F.col("name").alias("file")), "file", "left_anti")
