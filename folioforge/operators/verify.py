"""Independent verification of project files; it shares no code with ingestion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.sources.shared import written


def _text(content: str) -> Column:
    """The text of UTF-8 bytes, null where they are not UTF-8."""
    s = F.col(content).cast("string")
    return F.when(F.is_valid_utf8(s), s)


def _get(v: str, path: str, kind: str) -> Column:
    return F.try_variant_get(F.col(v), f"$.{path}", kind)


def _kind(v: str, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(F.col(v), f"$.{path}", "variant"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _fault(check: str, bad: str, message: str, row: str = "null") -> str:
    return f"case when {bad} then named_struct('check_id', '{check}', 'row_no', cast({row} as bigint), 'message', '{message}') end"


def _slice(x: str, start: str, end: str) -> str:
    """SQL of text[start:end], where x has the text in four bytes a code point and its length: a slice costs its own length, not that of the text before it.

    Negative offsets count from the end, as in the reference's language. The mark in front is taken for the byte order and drops out.
    """
    at = lambda v: f"cast(CASE WHEN {v} < 0 THEN greatest({x}.n + {v}, 0) ELSE least({v}, {x}.n) END as int)"
    return f"decode(concat(X'0000FEFF', substring({x}.wide, 4 * {at(start)} + 1, 4 * greatest({at(end)} - {at(start)}, 0))), 'UTF-32')"


_IS_TEXT = "coalesce(schema_of_variant(try_variant_get(u, '$.source_text', 'variant')) = 'STRING', false)"
_ROW = "cast(i + 1 as bigint)"
_UNIT_FAULTS = ", ".join(
    [
        _fault("V17", "u is null", "invalid JSONL row", _ROW),
        _fault("V18a", f"u is not null and not ((try_variant_get(u, '$.unit_id', 'string') <=> format_string('%s-U%04d', chapter_id, i + 1)) and (try_variant_get(u, '$.ordinal', 'bigint') <=> {_ROW}))", "unstable unit identity", _ROW),
        _fault("V18b", "u is not null and not (try_variant_get(u, '$.chapter_id', 'string') <=> chapter_id)", "unit belongs to another chapter", _ROW),
        _fault("V18c", f"u is not null and not {_IS_TEXT}", "unit text is not a string", _ROW),
        _fault("V18d", f"{_IS_TEXT} and not (sha2(try_variant_get(u, '$.source_text', 'string'), 256) <=> try_variant_get(u, '$.source_sha256', 'string'))", "unit hash mismatch", _ROW),
    ]
)
_REBUILT = f"sha2(array_join(transform(filter(us, u -> {_IS_TEXT}), u -> try_variant_get(u, '$.source_text', 'string')), ''), 256)"
#: Distinct paths that are sent to all tasks to leave other files' bytes where they are; projects share most of their paths.
_SENT_PATHS = 100_000


def _bytes_of(files: DataFrame, wanted: DataFrame, path: str) -> DataFrame:
    """wanted (key and more, where path is not null) with the bytes of the file at that path, as `bytes`.

    Files of which no project wants the path stay out of the shuffle, unless there are too many paths to tell.
    """
    paths = wanted.select(F.col(path).alias("p")).where("p is not null").distinct()
    found = files.select(F.col("key").alias("k"), F.col("path").alias("p"), F.col("content").alias("bytes"))
    if paths.limit(_SENT_PATHS + 1).count() <= _SENT_PATHS:
        found = found.join(F.broadcast(paths), "p", "left_semi")
    return wanted.join(found, (F.col("key") == F.col("k")) & (F.col(path) == F.col("p")), "left").drop("k", "p")


def verify(files: DataFrame) -> DataFrame:
    """files: project_id (any key of the project's folder), path, content.

    Returns violations: project_id, check_id, entity_id, row_no, message. A project whose project or
    manifest cannot be read (V1), or whose baseline cannot (V4), is checked no further. Unit files
    are cut at line feeds only. Four passes: projects, baselines, chapters with their units, coverage.

    Most checks need a file's digest and lengths, which are taken where the file lies. Shuffled are
    these, each project's text once and each unit file once. Projects, digests, chapters and their slices are kept as tables in the shared folder.
    """
    files = files.select(F.col("project_id").alias("key"), "path", "content")
    prints = written(files.select("key", "path", F.length("content").cast("long").alias("size"), F.sha2("content", 256).alias("sha"), F.length(_text("content")).cast("long").alias("chars")), "digests")

    def digest(path: Column, left: DataFrame, name: str) -> DataFrame:
        """left with what is known of a file of its project: size in bytes, sha, length of its text (null where it is none); null where there is no file."""
        found = prints.select(F.col("key").alias("k"), F.col("path").alias("p"), F.struct("size", "sha", "chars").alias(name))
        return left.join(found, (F.col("key") == F.col("k")) & (path == F.col("p")), "left").drop("k", "p")

    def report(df: DataFrame, entity: str, faults: str) -> DataFrame:
        hits = df.select("key", F.expr(entity).alias("entity_id"), F.explode(F.expr(f"filter({faults}, x -> x is not null)")).alias("x"))
        return hits.select(F.col("key").alias("project_id"), "x.check_id", "entity_id", "x.row_no", "x.message")

    top = files.where("path = 'project.json'").select(F.col("key").alias("k"), F.try_parse_json(_text("content")).alias("project"))
    top = prints.select("key").distinct().join(top, F.col("key") == F.col("k"), "left").drop("k").withColumn("manifest_path", _get("project", "source_manifest", "string"))
    top = _bytes_of(files, written(top, "projects"), "manifest_path").withColumn("manifest", F.try_parse_json(_text("bytes")))
    is_object = F.coalesce(F.schema_of_variant("project").startswith("OBJECT") & F.schema_of_variant("manifest").startswith("OBJECT"), F.lit(False))
    artifact = "array<struct<path:string,sha256:string>>"
    declared = F.expr(f"try_element_at(filter(coalesce(try_variant_get(project, '$.artifacts', '{artifact}'), cast(array() as {artifact})), a -> a.path = 'source/manifest.json'), -1).sha256")
    top = top.withColumn("ok", is_object).withColumn("same_id", _same(_get("project", "project_id", "string"), _get("manifest", "project_id", "string"))).withColumn("same_sha", _same(declared, F.sha2("bytes", 256)))
    top = written(top.select("key", "manifest", "ok", "same_id", "same_sha"), "projects")
    out = [report(top, "cast(null as string)", f"array({_fault('V1', 'not ok', 'project or manifest unreadable')}, {_fault('V2', 'ok and not same_id', 'project ids differ')}, {_fault('V3', 'ok and not same_sha', 'manifest hash mismatch')})")]

    base = digest(_get("manifest", "source.copy_path", "string"), top.where("ok").select("key", "manifest"), "copy")
    base = digest(_get("manifest", "canonical.path", "string"), base, "canonical")
    base = base.withColumn("ok", F.col("copy").isNotNull() & F.col("canonical.chars").isNotNull())
    base = base.withColumn("same_copy", _same(F.col("copy.size"), _get("manifest", "source.byte_length", "bigint")) & _same(F.col("copy.sha"), _get("manifest", "source.sha256", "string")))
    base = base.withColumn("same_text", _same(F.col("canonical.size"), _get("manifest", "canonical.byte_length", "bigint")) & _same(F.col("canonical.sha"), _get("manifest", "canonical.sha256", "string")))
    base = base.withColumn("same_length", _same(F.col("canonical.chars"), _get("manifest", "canonical.character_length", "bigint")))
    out.append(report(base, "cast(null as string)", f"array({_fault('V4', 'not ok', 'source baseline unreadable')}, {_fault('V5', 'ok and not same_copy', 'original copy differs from manifest')}, {_fault('V6', 'ok and not same_text', 'canonical text differs from manifest')}, {_fault('V7', 'ok and not same_length', 'canonical length mismatch')})"))
    base = base.where("ok").select("key", "manifest", "canonical", _get("manifest", "canonical.path", "string").alias("text_path"))

    chapters = base.select("key", F.posexplode(F.expr("coalesce(try_variant_get(manifest, '$.chapters', 'array<variant>'), array())")).alias("pos", "c")).select(
        "key", "pos", F.coalesce(_get("c", "chapter_id", "string"), F.lit("")).alias("chapter_id"),
        (F.coalesce(_kind("c", "source_start") == "BIGINT", F.lit(False)) & F.coalesce(_kind("c", "source_end") == "BIGINT", F.lit(False))).alias("ranged"),
        _get("c", "source_start", "bigint").alias("start"), _get("c", "source_end", "bigint").alias("end"), _get("c", "sha256", "string").alias("sha256"),
        _get("c", "character_length", "bigint").alias("length"), _get("c", "unit_count", "bigint").alias("unit_count"),
        _get("c", "source_path", "string").alias("source_path"), _get("c", "units_path", "string").alias("units_path"),
    )
    before = Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    chapters = chapters.withColumn("expected", F.coalesce(F.last(F.when(F.col("ranged"), F.col("end")), ignorenulls=True).over(before), F.lit(0)))
    chapters = chapters.withColumn("seen", F.row_number().over(Window.partitionBy("key", "chapter_id").orderBy("pos")))
    read = written(digest(F.col("source_path"), chapters, "text").select("*", F.col("text.sha").alias("sha"), F.col("text.chars").alias("n"), F.col("text.size").alias("size")).drop("text"), "chapters")

    # The text stays with its project: it gives the digest of each chapter's declared slice, and tells whether the chapters' own bytes are its bytes, one after the other.
    there = F.col("ranged") & F.col("n").isNotNull()
    starts = F.coalesce(F.sum(F.when(there, F.col("size"))).over(before), F.lit(0))
    listed = read.withColumn("at", starts).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("pos", "start", "end"))).alias("ranges"), F.max_by(F.col("end"), F.when(F.col("ranged"), F.col("pos"))).alias("last"),
        F.collect_list(F.when(there, F.struct("at", "size", "sha"))).alias("pieces"), F.sum(F.when(there, F.col("size"))).alias("total"),
    )
    whole = _bytes_of(files, base.select("key", "canonical", "text_path").join(listed, "key", "left"), "text_path")
    slices = F.expr(f"""transform(array(struct(encode(cast(bytes as string), 'UTF-32') as wide, length(cast(bytes as string)) as n)), x -> transform(coalesce(ranges, array()), c -> struct(c.pos as pos,
        sha2({_slice('x', 'c.start', 'c.end')}, 256) as slice)))[0]""")
    rebuilt = F.expr("coalesce(total, 0) = canonical.size AND forall(coalesce(pieces, array()), p -> sha2(substring(bytes, cast(p.at + 1 as int), cast(p.size as int)), 256) = p.sha)")
    whole = written(whole.select("key", F.col("canonical.chars").alias("n"), "last", slices.alias("slices"), rebuilt.alias("rebuilt")), "slices")
    read = read.join(whole.select(F.col("key").alias("k"), F.inline("slices").alias("p", "slice")), (F.col("key") == F.col("k")) & (F.col("pos") == F.col("p")), "left").drop("k", "p")
    listed = _bytes_of(files, read, "units_path").withColumn("unit_text", _text("bytes"))
    rows = F.when(F.col("unit_text") == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace("unit_text", r"\n\z", ""), "\n"))
    listed = listed.withColumn("us", F.when(F.col("ranged") & F.col("n").isNotNull() & F.col("unit_text").isNotNull(), F.transform(rows, F.try_parse_json)))
    faults = ", ".join(
        [
            _fault("V8", "seen > 1", "duplicate chapter id"),
            _fault("V9", "not ranged", "invalid source range"),
            _fault("V10", "ranged and (start <> expected or end <= start)", "chapter ranges are not contiguous"),
            _fault("V11", "ranged and n is null", "chapter unreadable"),
            _fault("V12", "ranged and n is not null and not (sha <=> slice)", "chapter is not the declared slice"),
            _fault("V13", "ranged and n is not null and not (sha <=> sha256)", "chapter hash mismatch"),
            _fault("V14", "ranged and n is not null and not (n <=> length)", "chapter length mismatch"),
            _fault("V15", "ranged and n is not null and unit_text is null", "units unreadable"),
            _fault("V16", "us is not null and not (cast(size(us) as bigint) <=> unit_count)", "unit count mismatch"),
            _fault("V18e", f"us is not null and {_REBUILT} <> sha", "units do not reconstruct the chapter"),
        ]
    )
    out.append(report(listed, "chapter_id", f"concat(array({faults}), coalesce(flatten(transform(us, (u, i) -> array({_UNIT_FAULTS}))), array()))"))

    out.append(report(whole, "cast(null as string)", f"array({_fault('V19', 'coalesce(last, 0) <> n', 'chapter ranges do not cover the canonical text')}, {_fault('V20', 'not rebuilt', 'chapters do not reconstruct the canonical text')})"))
    return reduce(DataFrame.unionByName, out)
