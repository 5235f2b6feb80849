"""Derived outputs, rebuilt from records at any time, and the matching of extensions to data.

Frames hold any number of projects; ids are unique within a project only, so all keys begin with project_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The columns of these reports are this engine's choice; no layout is prescribed.

P = "project_id"


def script_lines(units: DataFrame, characters: DataFrame) -> DataFrame:
    """Units (ordinal, source_text, zh_cn, text_type, speaker_character_id) with `speaker` (of dialogue, "unknown" where nobody is known) and `line`, their text without its line end."""
    named = units.join(characters.select(P, F.col("character_id").alias("speaker_character_id"), F.col("canonical_name").alias("speaker")), [P, "speaker_character_id"], "left")
    return named.withColumn("speaker", F.when(F.col("text_type") == "dialogue", F.coalesce("speaker", F.lit("unknown")))).withColumn("line", F.regexp_replace("source_text", r"[\r\n]+\z", ""))


def bilingual_script(units: DataFrame, characters: DataFrame) -> DataFrame:
    """A text per chapter: each unit, its speaker where there is one, and its translation."""
    line = F.concat(F.coalesce(F.concat("speaker", F.lit(": ")), F.lit("")), "line", F.lit(" / "), F.coalesce("zh_cn", F.lit("")), F.lit("\n"))
    listed = script_lines(units, characters).groupBy(P, "chapter_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", line.alias("t")))).alias("all"))
    return listed.select(P, "chapter_id", F.array_join(F.transform("all", lambda x: x["t"]), "").alias("script"))


def appearance_cells(appearances: DataFrame) -> DataFrame:
    """R2 with a row a cell, for any number of chapters: appearances on stage, and the character's total."""
    cells = appearances.where("appearance_type <> 'mentioned'").groupBy(P, "character_id", "chapter_id").agg(F.count(F.lit(1)).alias("appearances"))
    return cells.join(cells.groupBy(P, "character_id").agg(F.sum("appearances").alias("total")), [P, "character_id"])


def appearance_table(appearances: DataFrame, chapters: DataFrame) -> DataFrame:
    """R2 as CSV: project_id, place (0 for the heading), character_id, line: characters by chapters, with zeros, and a total.

    chapters: project_id, chapter_id, ordinal; they give the columns, in order of ordinal, as many as there are.
    A row is put together from its cells in order and the zeros between them, so it costs its own
    length, not a look-up a chapter; no column of the plan stands for a chapter.
    """
    column = F.row_number().over(Window.partitionBy(P).orderBy("ordinal", "chapter_id"))  # a row a chapter
    index = chapters.select(P, "chapter_id", "ordinal").distinct().withColumn("at", column)
    head = index.groupBy(P).agg(F.max("at").alias("width"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "chapter_id"))), lambda x: x["chapter_id"]), ",").alias("names"))
    cells = appearance_cells(appearances).join(index.select(P, "chapter_id", "at"), [P, "chapter_id"])
    rows = cells.groupBy(P, "character_id").agg(F.array_sort(F.collect_list(F.struct("at", "appearances"))).alias("cells"), F.max("total").alias("total")).join(head, P)
    gap = lambda n: F.repeat(F.lit(",0"), n.cast("int"))
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("cells", i - 1)["at"])
    body = F.array_join(F.transform("cells", lambda c, i: F.concat(gap(c["at"] - before(i) - 1), F.lit(","), c["appearances"].cast("string"))), "")
    line = F.concat("character_id", body, gap(F.col("width") - F.element_at("cells", -1)["at"]), F.lit(","), F.col("total").cast("string"))
    top = head.select(P, F.lit(0).alias("place"), F.lit(None).cast("string").alias("character_id"), F.concat(F.lit("character_id,"), "names", F.lit(",total")).alias("line"))
    return top.unionByName(rows.select(P, F.lit(1).alias("place"), "character_id", line.alias("line")))


def appearance_totals(appearances: DataFrame) -> DataFrame:
    """R2 in long form, with totals per character and over all of a project (rollup)."""
    sums = appearances.rollup(P, "character_id", "chapter_id").agg(F.count(F.lit(1)).alias("appearances"), F.sum((F.col("appearance_type") == "mentioned").cast("long")).alias("mentions"), F.grouping(P).alias("all"))
    return sums.where("all = 0").drop("all")


def scene_statistics(appearances: DataFrame, characters: DataFrame, scenes: DataFrame) -> DataFrame:
    """Per major character and place: scenes, appearances, whether they speak."""
    majors = characters.where("importance = 'major'").select(P, "character_id", "canonical_name")
    placed = appearances.join(scenes.select(P, "scene_id", "location_id"), [P, "scene_id"]).join(majors, [P, "character_id"])
    return placed.groupBy(P, "character_id", "canonical_name", "location_id").agg(F.countDistinct("scene_id").alias("scenes"), F.count(F.lit(1)).alias("appearances"), F.max("has_dialogue").alias("speaks"))


def dossier(profiles: DataFrame, fields: list[str]) -> DataFrame:
    """Profiles (project_id, character_id and a struct column a field) as one row a field."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}.value").cast("string").alias("value"), F.col(f"{f}.status").alias("status"), F.col(f"{f}.confidence").cast("double").alias("confidence"), F.size(f"{f}.evidence").cast("long").alias("n_evidence")) for f in fields])
    return profiles.select(P, "character_id", F.inline(cells))


def summary(chapters: DataFrame, appearances: DataFrame, scenes: DataFrame) -> DataFrame:
    """Per chapter: units, scenes, characters on stage and mentioned."""
    a = appearances.groupBy(P, "chapter_id").agg(F.countDistinct(F.when(F.col("appearance_type") != "mentioned", F.col("character_id"))).alias("characters"), F.countDistinct(F.when(F.col("appearance_type") == "mentioned", F.col("character_id"))).alias("mentioned"))
    s = scenes.groupBy(P, "chapter_id").agg(F.countDistinct("scene_id").alias("scenes"))
    return chapters.select(P, "chapter_id", "unit_count").join(a, [P, "chapter_id"], "left").join(s, [P, "chapter_id"], "left").na.fill(0, ["characters", "mentioned", "scenes"])


def art_prompts(scenes: DataFrame, appearances: DataFrame, looks: DataFrame) -> DataFrame:
    """Per scene: its place and time, and the known looks (project_id, character_id, field, value) of those on stage."""
    seen = appearances.where("appearance_type <> 'mentioned'").select(P, "scene_id", "character_id").distinct()
    worn = seen.join(looks.where("value is not null"), [P, "character_id"]).groupBy(P, "scene_id").agg(F.array_sort(F.collect_list(F.struct("character_id", "field", "value"))).alias("looks"))
    return scenes.select(P, "scene_id", "location_name", "int_ext", "time_of_day").join(worn, [P, "scene_id"], "left")


#: Places on the line of versions: just before a version, the version, just after it.
_BELOW, _AT, _ABOVE = 0, 1, 2
_LAST = 2**62


def _part(version: Column, k: int) -> Column:
    return F.coalesce(F.try_element_at(F.split(version, "[.]"), F.lit(k)).try_cast("long"), F.lit(0))


def _place(parts: list[Column], side: int) -> Column:
    names = ["v1", "v2", "v3"]
    return F.struct(*[p.cast("long").alias(n) for n, p in zip(names, parts, strict=True)], F.lit(side).alias("side"))


def version_place(version: Column) -> Column:
    """Where a version stands: numbers that are left out are 0."""
    return _place([_part(version, k) for k in (1, 2, 3)], _AT)


def version_range(wanted: Column) -> Column:
    """low and high, the places between which a version fits. Each of these is one interval, and a list of them,
    with spaces, is where they overlap: *, 1.2.3, =1.2.3, >=1.2.3, >, <=, <, ^1.2.3 (same major), ~1.2.3 (same minor).
    Anything else fits nothing.
    """
    zero, most = F.lit(0), F.lit(_LAST)
    first, last = _place([F.lit(-1), zero, zero], _BELOW), _place([most, zero, zero], _BELOW)

    def ends(c: Column) -> Column:
        form = r"\A([<>=^~]*)([0-9][0-9.]*)\z"
        sign, number = F.when(c.rlike(form), F.regexp_extract(c, form, 1)).otherwise("none"), F.regexp_extract(c, form, 2)
        v = [_part(number, k) for k in (1, 2, 3)]
        low = F.when(c == "*", first).when(sign.isin("", "=", ">=", "^", "~"), _place(v, _BELOW)).when(sign == ">", _place(v, _ABOVE)).when(sign.isin("<=", "<"), first).otherwise(last)
        high = (
            F.when((c == "*") | sign.isin(">=", ">"), last).when(sign.isin("", "=", "<="), _place(v, _ABOVE)).when(sign == "<", _place(v, _BELOW))
            .when(sign == "^", _place([v[0] + 1, zero, zero], _BELOW)).when(sign == "~", _place([v[0], v[1] + 1, zero], _BELOW)).otherwise(first)
        )
        return F.struct(low.alias("low"), high.alias("high"))

    parts = F.transform(F.split(F.trim(wanted), r"\s+"), ends)
    return F.struct(F.array_max(F.transform(parts, lambda p: p["low"])).alias("low"), F.array_min(F.transform(parts, lambda p: p["high"])).alias("high"))


def extension_inputs(extensions: DataFrame, available: DataFrame) -> DataFrame:
    """project_id, module_id, data_type, version (null where nothing fits), ready (false where a required input is missing).

    available: project_id, data_type, version. The best version of a range is the last one below its
    end, if it is above the beginning: versions and distinct ends are put in order once for each
    type, and each end takes the version before it. So there is a row a version and a row a wanted
    range, and no pair of them is ever tried.
    """
    bounds = version_range(F.col("version_range"))
    wants = extensions.select(P, "module_id", F.inline("consumes")).select(P, "module_id", "data_type", F.coalesce("required", F.lit(True)).alias("required"), bounds.alias("r"))
    have = available.select(P, "data_type", version_place(F.col("version")).alias("place"), F.col("version")).groupBy(P, "data_type", "place").agg(F.max("version").alias("version"))
    ends = wants.select(P, "data_type", F.col("r.high").alias("place")).distinct().withColumn("version", F.lit(None).cast("string"))
    line = have.withColumn("end", F.lit(False)).unionByName(ends.withColumn("end", F.lit(True)))
    upto = Window.partitionBy(P, "data_type").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(~F.col("end"), F.struct(F.col("place").alias("at"), F.col("version").alias("v"))), ignorenulls=True).over(upto)
    found = line.withColumn("best", last).where("end").select(P, "data_type", F.col("place").alias("high"), "best")
    fit = wants.withColumn("high", F.col("r.high")).join(found, [P, "data_type", "high"], "left")
    version = F.when(F.col("best.at") > F.col("r.low"), F.col("best.v"))
    return (
        fit.select(P, "module_id", "data_type", "required", version.alias("version"))
        .groupBy(P, "module_id", "data_type", "required").agg(F.max_by("version", F.when(F.col("version").isNotNull(), version_place(F.col("version")))).alias("version"))
        .select(P, "module_id", "data_type", "version", (F.col("version").isNotNull() | ~F.col("required")).alias("ready"))
    )
