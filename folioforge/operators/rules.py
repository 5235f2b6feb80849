"""Rules across records. Each takes frames with a project_id and returns violations: project_id, rule, entity_id, message.

Ids are unique within a project only (P01-U0001 is in every book), so all joins and groups have the
pair of project_id and id as their key, and any number of projects is checked at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.sources.shared import numbered

P = "project_id"


def _report(df: DataFrame, rule: str, entity: str, message: str) -> DataFrame:
    return df.select(P, F.lit(rule).alias("rule"), F.col(entity).cast("string").alias("entity_id"), F.lit(message).alias("message"))


def _each(df: DataFrame, ref: str, kind: str | None = None) -> Column:
    """The values of a column that is one reference or an array of them, cast to a type where one is given."""
    if df.schema[ref].dataType.typeName() == "array":
        return F.explode(F.col(ref).cast(f"array<{kind}>") if kind else F.col(ref))
    return F.col(ref).cast(kind) if kind else F.col(ref)


def dangling(child: DataFrame, entity: str, ref: str, parent: DataFrame, target: str, name: str) -> DataFrame:
    """Non-null references of child that no parent of the same project has. ref may be an array column."""
    refs = child.select(P, F.col(entity).alias("entity_id"), _each(child, ref).alias("ref")).where("ref is not null")
    return _report(refs.join(parent.select(P, F.col(target).alias("ref")).distinct(), [P, "ref"], "left_anti").distinct(), f"X1 {name}", "entity_id", "reference to a record that is not there")


#: The references of a project's records. Table, entity, reference, table and column that it points to.
REFERENCES = {
    "unit-chapter": ("units", "unit_id", "chapter_id", "chapters", "chapter_id"),
    "unit-speaker": ("units", "unit_id", "speaker_character_id", "characters", "character_id"),
    "unit-evidence": ("units", "unit_id", "evidence_unit_ids", "units", "unit_id"),
    "analysis-chapter": ("analyses", "chapter_id", "chapter_id", "chapters", "chapter_id"),
    "analysis-unit": ("analyses", "chapter_id", "source_unit_ids", "units", "unit_id"),
    "scene-location": ("scenes", "scene_id", "location_id", "locations", "location_id"),
    "scene-unit": ("scenes", "scene_id", "source_unit_ids", "units", "unit_id"),
    "scene-evidence": ("scenes", "scene_id", "evidence_unit_ids", "units", "unit_id"),
    "beat-unit": ("beats", "beat_id", "source_unit_ids", "units", "unit_id"),
    "character-appearance": ("characters", "character_id", "first_appearance_id", "appearances", "appearance_id"),
    "character-evidence": ("characters", "character_id", "evidence_unit_ids", "units", "unit_id"),
    "appearance-character": ("appearances", "appearance_id", "character_id", "characters", "character_id"),
    "appearance-chapter": ("appearances", "appearance_id", "chapter_id", "chapters", "chapter_id"),
    "appearance-scene": ("appearances", "appearance_id", "scene_id", "scenes", "scene_id"),
    "appearance-unit": ("appearances", "appearance_id", "source_unit_ids", "units", "unit_id"),
    "appearance-evidence": ("appearances", "appearance_id", "evidence_unit_ids", "units", "unit_id"),
    "profile-character": ("profile_fields", "character_id", "character_id", "characters", "character_id"),
    "profile-evidence": ("profile_fields", "character_id", "evidence_unit_ids", "units", "unit_id"),
}


def referential_integrity(tables: dict[str, DataFrame]) -> DataFrame:
    """X1 over all records of all projects: the references of REFERENCES whose tables are given.

    A column `evidence` (structs) stands for evidence_unit_ids. One pass: records and references are
    tagged and put together, and grouped once by project, kind and id, so that each key keeps a flag
    and a popular target costs no more than its combined rows. Only the keys without a record, which
    are as many as the faults, are then joined with the references.
    """
    ready = {name: t.withColumn("evidence_unit_ids", F.transform("evidence", lambda e: e["source_unit_id"])) if "evidence" in t.columns and "evidence_unit_ids" not in t.columns else t for name, t in tables.items()}
    used = {name: r for name, r in REFERENCES.items() if r[0] in ready and r[3] in ready and r[2] in ready[r[0]].columns}
    if not used:
        raise ValueError("no table with a reference to another one")
    refs = [
        ready[table].select(P, F.lit(target).alias("kind"), F.lit(f"X1 {name}").alias("rule"), F.col(entity).cast("string").alias("entity_id"), _each(ready[table], ref, "string").alias("id")).where("id is not null")
        for name, (table, entity, ref, target, _) in used.items()
    ]
    records = [ready[target].select(P, F.lit(target).alias("kind"), F.col(column).cast("string").alias("id"), F.lit(True).alias("there")) for target, column in sorted({r[3:] for r in used.values()})]
    every = reduce(DataFrame.unionByName, refs)
    tagged = reduce(DataFrame.unionByName, [every.select(P, "kind", "id", F.lit(False).alias("there")), *records])
    missing = tagged.groupBy(P, "kind", "id").agg(F.max("there").alias("there")).where("not there").select(F.col(P).alias("p"), F.col("kind").alias("k"), F.col("id").alias("i"))
    found = every.join(missing, F.col(P).eqNullSafe(F.col("p")) & (F.col("kind") == F.col("k")) & (F.col("id") == F.col("i")), "left_semi")
    return found.select(P, "rule", "entity_id", F.lit("reference to a record that is not there").alias("message")).distinct()


def known_unknowns(df: DataFrame, entity: str, value: str = "value", status: str = "status") -> DataFrame:
    """An unknown value is null."""
    return _report(df.where((F.col(status) == "unknown") & F.col(value).isNotNull()), "X5", entity, "unknown value is not null")


def without_evidence(df: DataFrame, entity: str, status: str = "status", evidence: str = "evidence") -> DataFrame:
    """Every status but unknown needs evidence."""
    return _report(df.where((F.col(status) != "unknown") & (F.coalesce(F.size(evidence), F.lit(0)) <= 0)), "X2", entity, "no evidence")


def unexplained(df: DataFrame, entity: str, status: str = "status", evidence: str = "evidence", notes: str | None = None) -> DataFrame:
    """An inferred value needs evidence, and an explanation in a note of the evidence or in the notes."""
    noted = F.exists(evidence, lambda e: F.length(e["note"]) > 0)
    if notes:
        noted = noted | (F.length(notes) > 0)
    return _report(df.where((F.col(status) == "inferred") & ((F.coalesce(F.size(evidence), F.lit(0)) <= 0) | ~F.coalesce(noted, F.lit(False)))), "X3", entity, "inferred without evidence and explanation")


def merged_keeping_conflicts(old: DataFrame, new: DataFrame, keys: list[str], status: str = "status") -> DataFrame:
    """New records replace old ones, except those in conflict, which stay until someone settles them."""
    keys = list(dict.fromkeys([P, *keys]))
    conflicts = old.where(F.col(status) == "conflict")
    taken = new.join(conflicts.select(*keys), keys, "left_anti")
    return taken.unionByName(old.join(taken.select(*keys), keys, "left_anti"))


def changed_ids(before: DataFrame, after: DataFrame, natural: list[str], identity: str) -> DataFrame:
    """Records that a later run lost or gave another id."""
    natural = list(dict.fromkeys([P, *natural]))
    a, b = before.select(*natural, F.col(identity).alias("old")), after.select(*natural, F.col(identity).alias("new"))
    return _report(a.join(b, natural, "left").where(~F.col("old").eqNullSafe(F.col("new"))), "X6", "old", "published id lost or changed")


def vague_scenes(scenes: DataFrame, generic: tuple[str, ...] = ("日常卧室",)) -> DataFrame:
    """Scenes that need a person's review: unknown setting or time, no place, or a generic name."""
    vague = (F.col("int_ext") == "unknown") | (F.col("time_of_day") == "unknown") | (F.col("location_id").isNull() & F.coalesce(F.trim("location_name"), F.lit("")).isin("", *generic)) | F.col("location_name").isin(*generic)
    return _report(scenes.where(vague), "X8", "scene_id", "scene needs review")


def stray_beats(beats: DataFrame, scenes: DataFrame) -> DataFrame:
    """Beats with units outside their scene, or without a scene."""
    both = beats.join(scenes.select(P, "scene_id", F.col("source_unit_ids").alias("scene_units")), [P, "scene_id"], "left")
    return _report(both.where(F.col("scene_units").isNull() | (F.size(F.array_except("source_unit_ids", "scene_units")) > 0)), "X9", "beat_id", "beat leaves its scene")


def presence(appearances: DataFrame) -> DataFrame:
    """Appearances with on_stage; those only spoken of are mentions."""
    return appearances.withColumn("on_stage", F.col("appearance_type") != "mentioned")


def merged_roles(characters: DataFrame, aliases: str = "aliases") -> DataFrame:
    """X11: a continuing role and a crowd that share a name."""
    names = characters.select(P, "character_id", "character_type", F.explode(F.array_distinct(F.concat(F.array("canonical_name"), aliases))).alias("name"))
    mixed = names.groupBy(P, "name").agg(F.max((F.col("character_type") == "crowd").cast("int")).alias("crowd"), F.max((F.col("character_type") == "role").cast("int")).alias("role")).where("crowd = 1 and role = 1")
    return _report(names.where("character_type = 'role'").join(mixed, [P, "name"], "left_semi").select(P, "character_id").distinct(), "X11", "character_id", "role merged with a crowd")


def dialogue(units: DataFrame, characters: DataFrame) -> DataFrame:
    """All dialogue with its speaker's name; lines of unknown speakers stay."""
    spoken = units.where("text_type = 'dialogue'")
    named = characters.select(P, F.col("character_id").alias("speaker_character_id"), F.col("canonical_name").alias("speaker"))
    return spoken.join(named, [P, "speaker_character_id"], "left").withColumn("speaker", F.coalesce("speaker", F.lit("unknown")))


def confirmed_majors(characters: DataFrame, confirmations: DataFrame) -> DataFrame:
    """Candidates become major only where a person confirmed them."""
    sure = confirmations.select(P, "character_id", F.lit(True).alias("confirmed")).distinct()
    confirmed = (F.col("importance") == "candidate_major") & F.coalesce("confirmed", F.lit(False))
    return characters.join(sure, [P, "character_id"], "left").withColumn("importance", F.when(confirmed, "major").otherwise(F.col("importance"))).drop("confirmed")


def translation_coverage(units: DataFrame) -> DataFrame:
    """Per chapter, the units and those with a translation."""
    have = F.coalesce(F.length("zh_cn") > 0, F.lit(False))
    return units.groupBy(P, "chapter_id").agg(F.count(F.lit(1)).alias("units"), F.sum(have.cast("long")).alias("translated"), F.sum((have & (F.col("translation_status") == "pending")).cast("long")).alias("pending_with_text"))


def unquoted(evidence: DataFrame, units: DataFrame) -> DataFrame:
    """X15 (a warning): quotes that their unit does not hold."""
    both = evidence.join(units.select(P, F.col("unit_id").alias("source_unit_id"), "source_text"), [P, "source_unit_id"])
    return _report(both.where("locate(quote, source_text) = 0"), "X15", "entity_id", "quote is not in its unit")


def stale(analyses: DataFrame, chapters: DataFrame) -> DataFrame:
    """Analyses of another version of their chapter."""
    both = analyses.join(chapters.select(P, "chapter_id", "sha256"), [P, "chapter_id"])
    return _report(both.where("source_sha256 <> sha256"), "X16", "chapter_id", "analysis is stale")


def bad_namespaces(extensions: DataFrame) -> DataFrame:
    """An extension's namespace is its own."""
    return _report(extensions.where(~F.col("output_namespace").eqNullSafe(F.concat(F.lit("extensions/"), "module_id", F.lit("/")))), "X17", "module_id", "namespace is not the module's")


def bad_outputs(outputs: DataFrame) -> DataFrame:
    """Outputs (project_id, module_id, path, input_sha256, module_version, generated_at) outside their targets, or without provenance."""
    outside = ~(F.col("path").startswith(F.concat(F.lit("extensions/"), "module_id", F.lit("/"))) | F.col("path").startswith(F.lit("deliverables/")))
    bare = F.col("input_sha256").isNull() | F.col("module_version").isNull() | F.col("generated_at").isNull() | F.col("path").isNull()
    return _report(outputs.where(outside), "X17", "module_id", "output outside the module's targets").unionByName(_report(outputs.where(bare), "X18", "module_id", "output without provenance"))


def islands(df: DataFrame, partition: list[str], order: str, changed: list[str]) -> DataFrame:
    """Scenes and beats (W11, W12): numbers runs, from 1; a run ends where any of the columns changes."""
    w = Window.partitionBy(*partition).orderBy(order)
    differs: Column = F.lit(False)
    for c in changed:
        differs = differs | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    flagged = df.withColumn("__new", F.when(F.row_number().over(w) == 1, 1).when(differs, 1).otherwise(0))
    return flagged.withColumn("island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("__new")


def first_appearances(appearances: DataFrame, order: list[str]) -> DataFrame:
    """project_id, character_id, first_appearance_id, by source order."""
    return appearances.groupBy(P, "character_id").agg(F.min_by("appearance_id", F.struct(*order)).alias("first_appearance_id"))


def numbered_by_first(df: DataFrame, name: str, order: list[str], prefix: str, last: DataFrame | None = None) -> DataFrame:
    """project_id, name, id: ids in the order in which names first occur in their project.

    last: project_id and `last`, the highest number that a project has given already. All projects'
    names are numbered in one order, which needs no partition a project, and each project counts from its own first.
    """
    first = df.groupBy(P, name).agg(F.min(F.struct(*order)).alias("first"))
    ranked = numbered(first, [P, "first", name])
    begin = ranked.groupBy(P).agg(F.min("n").alias("begin"))
    out = ranked.join(begin, P)
    if last is not None:
        out = out.join(last, P, "left")
    given = F.coalesce("last", F.lit(0)) if last is not None else F.lit(0)
    return out.select(P, name, F.format_string(f"{prefix}-%04d", F.col("n") - F.col("begin") + 1 + given).alias("id"))
