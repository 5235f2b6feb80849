"""Ingestion: files become projects, chapters and line units that can be verified."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators.scan import marked_lines_of, pieces_of
from folioforge.sources.files import decode_sources
from folioforge.sources.shared import written

# Fixed values of records.
METHOD = "anchored-heading-v1"
NO_HEADING = "No anchored chapter heading detected; retained as one chapter for review."
UNTOUCHED = ',"translation":{"zh_cn":null,"status":"pending"},"classification":{"text_type":"unknown","speaker_character_id":null,"speaker_label":null,"status":"unknown","confidence":0,"evidence":[]}}'
_EVIDENCE = "array<struct<source_unit_id:string,quote:string,note:string>>"


@dataclass
class Ingested:
    projects: DataFrame
    sources: DataFrame
    chapters: DataFrame
    units: DataFrame
    rejected: DataFrame


def marked_lines(texts: DataFrame, key: str, text: str = "canonical_text", *, keep: str | None = None) -> DataFrame:
    """Each line with its offset, heading and chapter: key, line_no (from 0), line, start, heading, label,
    any_heading, chapter_ordinal, ordinal. One window over the lines of a text gives all of it, so a text is
    the work of one task; `marked` does the same for texts that come in blocks. keep: a column that stays with a text's first line.
    """
    kept = [keep] if keep else []
    line = texts.select(key, *kept, F.posexplode(tx.lines(F.col(text))).alias("line_no", "line"))
    line = line.select(key, "line_no", "line", *[F.when(F.col("line_no") == 0, F.col(k)).alias(k) for k in kept])
    line = line.withColumn("label", tx.heading_label(F.col("line")))
    run = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # in the order of run, so one pass gives both
    is_heading = F.col("label").isNotNull()
    out = line.select(
        "*",
        (F.sum(F.length("line").cast("long")).over(run) - F.length("line")).alias("start"),
        F.sum(is_heading.cast("int")).over(run).alias("headings"),
        F.coalesce(F.max(F.when(is_heading, F.col("line_no"))).over(run), F.lit(0)).alias("first_line"),
        F.max(is_heading).over(every).alias("any_heading"),
    )
    return out.select(
        key, "line_no", "line", "start", F.when(is_heading, tx.heading_text(F.col("line"))).alias("heading"), "label", "any_heading",
        F.when(F.col("any_heading"), F.col("headings")).otherwise(1).cast("int").alias("chapter_ordinal"),
        (F.col("line_no") - F.col("first_line") + 1).cast("int").alias("ordinal"), *kept,
    )


def marked(blocks: DataFrame, key: str) -> DataFrame:
    """The columns of marked_lines for texts of any size that come in blocks (key, block, text; see operators/scan.py): a text is the work of many tasks."""
    out = marked_lines_of(pieces_of(blocks, key), key)
    is_heading = F.col("label").isNotNull()
    return out.select(
        key, "line_no", "line", "start", F.when(is_heading, tx.heading_text(F.col("line"))).alias("heading"), "label", "any_heading",
        F.when(F.col("any_heading"), F.col("headings")).otherwise(1).cast("int").alias("chapter_ordinal"),
        (F.col("line_no") - F.col("first_line") + 1).cast("int").alias("ordinal"),
    )


def chapters_of(marked: DataFrame, key: str, more: dict[str, Column] | None = None, unit: Callable[[Column, Column, Column], Column] | None = None) -> DataFrame:
    """key, chapter_id, ordinal, heading, source_label, source_start, source_end, character_length, sha256, paths, unit_count, chapter_text; and more aggregates.

    unit: what a unit is written as, by its chapter's id, its ordinal and its line; adds unit_text, all of a chapter's in order.
    Lines are gathered once, and units are made of them when they are put together, so no buffer or sort holds them.
    """
    more = more or {}
    grouped = marked.groupBy(key, F.col("chapter_ordinal").alias("ordinal")).agg(
        F.max("heading").alias("heading"),
        F.max("label").alias("label"),
        F.max("any_heading").alias("any_heading"),
        F.min("start").alias("source_start"),
        F.max(F.col("start") + F.length("line")).alias("source_end"),
        F.count(F.lit(1)).alias("unit_count"),
        tx.gathered(F.col("line"), F.col("line_no")).alias("lines"),
        *[c.alias(name) for name, c in more.items()],
    )
    named = grouped.withColumn("chapter_id", tx.chapter_id(F.col("ordinal"))).withColumn("chapter_text", F.array_join(F.transform("lines", lambda x: x["p"]), ""))
    if unit:
        named = named.withColumn("unit_text", F.array_join(F.transform("lines", lambda x, k: unit(F.col("chapter_id"), k + 1, x["p"])), ""))
    low = F.lower("chapter_id")
    return named.select(
        key, "chapter_id", "ordinal", "heading",
        F.when(F.col("any_heading") & (F.col("ordinal") == 0), "preamble").otherwise(F.col("label")).alias("source_label"),
        "source_start", "source_end", (F.col("source_end") - F.col("source_start")).alias("character_length"),
        tx.digest(F.col("chapter_text")).alias("sha256"),
        F.concat(F.lit("source/chapters/"), low, F.lit(".txt")).alias("source_path"),
        F.concat(F.lit("data/units/"), low, F.lit(".units.jsonl")).alias("units_path"),
        "unit_count", "chapter_text", *(["unit_text"] if unit else []), *more,
    )


def units_of(marked: DataFrame, key: str) -> DataFrame:
    chapter = tx.chapter_id(F.col("chapter_ordinal"))
    return marked.select(
        key, F.lit(tx.SCHEMA_VERSION).alias("schema_version"), tx.unit_id(chapter, F.col("ordinal")).alias("unit_id"), chapter.alias("chapter_id"), "ordinal",
        F.col("line").alias("source_text"), tx.digest(F.col("line")).alias("source_sha256"),
        F.struct(F.lit(None).cast("string").alias("zh_cn"), F.lit("pending").alias("status")).alias("translation"),
        F.struct(
            F.lit("unknown").alias("text_type"), F.lit(None).cast("string").alias("speaker_character_id"), F.lit(None).cast("string").alias("speaker_label"),
            F.lit("unknown").alias("status"), F.lit(0.0).alias("confidence"), F.array().cast(_EVIDENCE).alias("evidence"),
        ).alias("classification"),
    )


def _detected() -> list[Column]:
    """Aggregates over a text's chapters: status and warnings of heading detection."""
    none = F.max("source_label").isNull()
    status = F.when(none, "single_chapter_review").when(F.min("ordinal") == 0, "detected_with_preamble").otherwise("detected")
    return [status.alias("status"), F.when(none, F.array(F.lit(NO_HEADING))).otherwise(F.array().cast("array<string>")).alias("detection_warnings")]


def detection(chapters: DataFrame, key: str) -> DataFrame:
    """status and warnings of heading detection."""
    return chapters.groupBy(key).agg(*_detected())


def manifests(sources: DataFrame, chapters: DataFrame) -> DataFrame:
    """project_id, manifest (indented JSON with a line feed at its end), sha256 of it, the number of chapters."""
    text, number = (lambda c: tx.json_string(F.col(c))), (lambda c: F.col(c).cast("string"))
    chapter = tx.json_object(
        {"chapter_id": text("chapter_id"), "ordinal": number("ordinal"), "heading": text("heading"), "source_label": text("source_label"), "source_start": number("source_start"), "source_end": number("source_end"),
         "character_length": number("character_length"), "sha256": text("sha256"), "source_path": text("source_path"), "units_path": text("units_path"), "unit_count": number("unit_count")}, 2)
    listed = chapters.groupBy("project_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", chapter.alias("c")))).alias("all"), *_detected())
    strings = lambda c: tx.json_array(F.transform(c, tx.json_string), 2)
    record = tx.json_object({
        "schema_version": tx.json_string(F.lit(tx.SCHEMA_VERSION)), "project_id": text("project_id"),
        "source": tx.json_object({"filename": text("filename"), "format": text("format"), "encoding": text("encoding"), "copy_path": text("copy_path"), "byte_length": number("byte_length"), "sha256": text("sha256"), "warnings": strings("warnings")}, 1),
        "canonical": tx.json_object({"path": text("canonical.path"), "encoding": text("canonical.encoding"), "character_length": number("canonical.character_length"), "byte_length": number("canonical.byte_length"), "sha256": text("canonical.sha256"), "rule": text("canonical.rule")}, 1),
        "chapter_detection": tx.json_object({"method": tx.json_string(F.lit(METHOD)), "status": text("status"), "warnings": strings("detection_warnings")}, 1),
        "chapters": tx.json_array(F.transform("all", lambda x: x["c"]), 1),
    })
    out = sources.join(listed, "project_id").select("project_id", F.concat(record, F.lit("\n")).alias("manifest"), F.size("all").cast("long").alias("n_chapters"))
    return out.withColumn("sha256", tx.digest(F.col("manifest")))


def ingest(files: DataFrame) -> Ingested:
    """files: filename, content, title. Files that cannot be taken are in `rejected` with the reason.

    Of several files that give one project id, none is taken: a project is never overwritten.
    """
    decoded = decode_sources(files.select("filename", "content", F.coalesce(F.nullif("title", F.lit("")), tx.stem(F.col("filename"))).alias("title")))
    named = decoded.withColumn("sha256", tx.digest(F.col("content"))).withColumn("project_id", F.concat(F.lit("PRJ-"), tx.slug(F.col("title"), F.col("sha256"))))
    # A file whose bytes are its text's crosses the shuffle once.
    same = F.coalesce(F.col("content") == F.col("canonical_text").cast("binary"), F.lit(False))
    named = named.withColumn("byte_length", F.length("content").cast("long")).withColumn("content", F.when(~same & F.col("reason").isNull(), F.col("content")))
    taken = named.withColumn("reason", F.coalesce("reason", F.when(F.count(F.when(F.col("reason").isNull(), 1)).over(Window.partitionBy("project_id")) > 1, "project already exists")))
    good = taken.where("reason is null")
    canonical = F.struct(
        F.lit("source/original.txt").alias("path"), F.lit("utf-8").alias("encoding"), F.length("canonical_text").cast("long").alias("character_length"),
        F.octet_length("canonical_text").cast("long").alias("byte_length"), tx.digest(F.col("canonical_text")).alias("sha256"), "rule",
    )
    sources = good.select(
        "project_id", "title", "filename", "format", "encoding", F.concat(F.lit("source/original.input"), tx.suffix(F.col("filename"))).alias("copy_path"),
        "byte_length", "sha256", "warnings", canonical.alias("canonical"), "canonical_text", F.coalesce("content", F.col("canonical_text").cast("binary")).alias("content"),
    )
    marked = marked_lines(sources, "project_id")
    chapters = chapters_of(marked, "project_id")
    return Ingested(_projects(sources, chapters), sources, chapters, units_of(marked, "project_id"), taken.where("reason is not null").select("filename", "title", "reason"))


def _projects(sources: DataFrame, chapters: DataFrame) -> DataFrame:
    artifact = F.struct(F.lit("source_manifest").alias("artifact_type"), F.lit("source/manifest.json").alias("path"), F.lit(tx.SCHEMA_VERSION).alias("schema_version"), F.col("sha256"))
    return sources.select("project_id", "title").join(manifests(sources, chapters), "project_id").select(
        "project_id", F.lit(tx.SCHEMA_VERSION).alias("schema_version"), "title", F.lit(tx.PIPELINE_VERSION).alias("pipeline_version"), F.lit("ingested").alias("state"),
        F.lit("source/manifest.json").alias("source_manifest"), F.array(artifact).alias("artifacts"), "manifest", "n_chapters",
    )


def _rendered(sources: DataFrame) -> DataFrame:
    """A row a chapter with its text and its units' rows; the first one of a text carries its source. Texts are decoded, cut and marked once, in one stage."""
    whole = [c for c in sources.columns if c not in ("project_id", "content", "canonical_text")]
    raw = F.when(F.col("content") != F.col("canonical_text").cast("binary"), F.col("content"))
    texts = sources.select("project_id", "canonical_text", F.struct(*whole, raw.alias("raw"), F.col("canonical_text").alias("text")).alias("source"))
    marked = marked_lines(texts, "project_id", keep="source")
    # Units as ingested: nothing is classified or translated yet.
    # Ids and digests have nothing to escape, so each is made once.
    unit = lambda chapter, ordinal, line: F.concat(
        F.lit(f'{{"schema_version":"{tx.SCHEMA_VERSION}","unit_id":"'), tx.unit_id(chapter, ordinal), F.lit('","chapter_id":"'), chapter, F.lit('","ordinal":'), ordinal.cast("string"),
        F.lit(',"source_text":'), tx.json_string(line), F.lit(',"source_sha256":"'), tx.digest(line), F.lit('"' + UNTOUCHED + "\n"),
    )
    return chapters_of(marked, "project_id", {"source": F.first("source", ignorenulls=True)}, unit).withColumn("opens", F.col("source").isNotNull())


def project_files(got: Ingested) -> DataFrame:
    """All files of all projects: project_id, path, content. Chapters are rendered once, and kept as a table in the shared folder."""
    rows = written(_rendered(got.sources), "chapters")
    sources = rows.where("opens").select("project_id", "source.*")
    projects = _projects(sources, rows.drop("chapter_text", "unit_text", "source", "opens"))
    text = lambda c: tx.json_string(F.col(c))
    artifact = F.transform("artifacts", lambda a: tx.json_object({k: tx.json_string(a[k]) for k in ("artifact_type", "path", "schema_version", "sha256")}, 2))
    project = F.concat(tx.json_object({**{k: text(k) for k in ("schema_version", "project_id", "title", "pipeline_version", "state", "source_manifest")}, "artifacts": tx.json_array(artifact, 1)}), F.lit("\n"))
    parts = [
        projects.select("project_id", F.lit("project.json").alias("path"), project.cast("binary").alias("content")),
        projects.select("project_id", F.lit("source/manifest.json").alias("path"), F.col("manifest").cast("binary").alias("content")),
        sources.select("project_id", F.col("copy_path").alias("path"), F.coalesce("raw", F.col("text").cast("binary")).alias("content")),
        sources.select("project_id", F.col("canonical.path").alias("path"), F.col("text").cast("binary").alias("content")),
        rows.select("project_id", F.col("source_path").alias("path"), F.col("chapter_text").cast("binary").alias("content")),
        rows.select("project_id", F.col("units_path").alias("path"), F.col("unit_text").cast("binary").alias("content")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
