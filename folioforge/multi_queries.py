"""Queries over many projects at once: each conversation is a project, and all of them share the ids of their chapters, units, scenes, people and appearances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.operators import rules
from folioforge.plans import reports
from folioforge.plans.deliverables import deliverable_files
from folioforge.plans.runner import Runner, Stage
from folioforge.queries import _one_project, _table, appearances, screenplay
from folioforge.registry import query
from folioforge.sources.projects import read_folders, write_projects
from folioforge.sources.records import PLACES, typed_records
from folioforge.sources.shared import fresh_path, written
from folioforge.streaming.registry import stream_registry

_PEOPLE = {"user": "CHAR-0001", "assistant": "CHAR-0002"}
_SHARED_SQL = """s AS (
  SELECT conv_id, turn, role, text, concat('PRJ-', conv_id) AS p, concat('P01-U', printf('%04d', turn + 1)) AS u, concat('P01-S', printf('%03d', turn // 3 + 1)) AS sc, concat('P01-S', printf('%03d', turn // 3 + 1), '-B', printf('%03d', turn + 1)) AS b,
    concat('APP-P01-', printf('%04d', turn + 1)) AS a, CASE role WHEN 'user' THEN 'CHAR-0001' WHEN 'assistant' THEN 'CHAR-0002' ELSE 'CHAR-0003' END AS c, CASE WHEN turn = 0 THEN conv_id % 19 ELSE -1 END AS k, max(turn) OVER w AS m, bool_or(role NOT IN ('user', 'assistant')) OVER w AS third
  FROM conversations WINDOW w AS (PARTITION BY conv_id)),
x AS (SELECT *, concat('P01-U', printf('%04d', m + 2)) AS fu, concat('P01-S', printf('%03d', m // 3 + 2)) AS fs, concat('APP-P01-', printf('%04d', m + 2)) AS fa, CASE WHEN third THEN 'CHAR-0404' ELSE 'CHAR-0003' END AS fc FROM s)"""


def _shared(spark, sf) -> DataFrame:
    """A row a turn: ids that all projects share, and ids that this project lacks though others may have them."""
    t = _table(spark, sf, "conversations")
    chapter = F.lit("P01")
    size = t.groupBy("conv_id").agg(F.max("turn").alias("m"), F.max(~F.col("role").isin(*_PEOPLE)).alias("third")).withColumnRenamed("conv_id", "c")
    people = F.coalesce(F.create_map(*[F.lit(v) for kv in _PEOPLE.items() for v in kv])[F.col("role")], F.lit("CHAR-0003"))
    scene = lambda turn: tx.scene_id(chapter, F.floor(turn / 3) + 1)
    return t.join(size, F.col("conv_id") == F.col("c")).select(
        F.concat(F.lit("PRJ-"), "conv_id").alias("project_id"), "conv_id", "turn", "role", "text", chapter.alias("chapter_id"), tx.unit_id(chapter, F.col("turn") + 1).alias("unit_id"), scene(F.col("turn")).alias("scene_id"),
        tx.beat_id(scene(F.col("turn")), F.col("turn") + 1).alias("beat_id"), tx.appearance_id(chapter, F.col("turn") + 1).alias("appearance_id"), people.alias("character_id"), F.when(F.col("turn") == 0, F.col("conv_id") % 19).otherwise(-1).alias("k"),
        tx.unit_id(chapter, F.col("m") + 2).alias("other_unit"), scene(F.col("m") + 3).alias("other_scene"), tx.appearance_id(chapter, F.col("m") + 2).alias("other_appearance"), F.when(F.col("third"), "CHAR-0404").otherwise("CHAR-0003").alias("other_character"),
    )


_REFS_SQL = f"""WITH {_SHARED_SQL},
refs(rule, p, entity, kind, id) AS (
  SELECT 'unit-chapter', p, u, 'chapter', CASE k WHEN 0 THEN 'P02' ELSE 'P01' END FROM x
  UNION ALL SELECT 'unit-speaker', p, u, 'character', CASE k WHEN 1 THEN fc ELSE c END FROM x
  UNION ALL SELECT 'unit-evidence', p, u, 'unit', CASE k WHEN 2 THEN fu ELSE u END FROM x
  UNION ALL SELECT 'analysis-chapter', p, CASE WHEN max(k) = 3 THEN 'P03' ELSE 'P01' END, 'chapter', CASE WHEN max(k) = 3 THEN 'P03' ELSE 'P01' END FROM x GROUP BY p
  UNION ALL SELECT 'analysis-unit', p, CASE WHEN conv_id % 19 = 3 THEN 'P03' ELSE 'P01' END, 'unit', CASE k WHEN 4 THEN fu ELSE u END FROM x
  UNION ALL SELECT 'scene-location', p, sc, 'location', CASE k WHEN 5 THEN 'LOC-0002' ELSE 'LOC-0001' END FROM x
  UNION ALL SELECT 'scene-unit', p, sc, 'unit', CASE k WHEN 6 THEN fu ELSE u END FROM x
  UNION ALL SELECT 'scene-evidence', p, sc, 'unit', CASE k WHEN 7 THEN fu ELSE u END FROM x
  UNION ALL SELECT 'beat-unit', p, b, 'unit', CASE k WHEN 8 THEN fu ELSE u END FROM x
  UNION ALL SELECT 'character-appearance', p, c, 'appearance', CASE WHEN max(k) = 9 THEN max(fa) ELSE min(a) END FROM x GROUP BY p, c
  UNION ALL SELECT 'character-evidence', p, c, 'unit', CASE k WHEN 10 THEN fu ELSE u END FROM x
  UNION ALL SELECT 'appearance-character', p, a, 'character', CASE k WHEN 11 THEN fc ELSE c END FROM x
  UNION ALL SELECT 'appearance-chapter', p, a, 'chapter', CASE k WHEN 12 THEN 'P03' ELSE 'P01' END FROM x
  UNION ALL SELECT 'appearance-scene', p, a, 'scene', CASE k WHEN 13 THEN fs ELSE sc END FROM x
  UNION ALL SELECT 'appearance-unit', p, a, 'unit', CASE k WHEN 14 THEN fu ELSE u END FROM x
  UNION ALL SELECT 'appearance-evidence', p, a, 'unit', CASE k WHEN 15 THEN fu ELSE u END FROM x
  UNION ALL SELECT 'profile-character', p, CASE k WHEN 16 THEN fc ELSE c END, 'character', CASE k WHEN 16 THEN fc ELSE c END FROM x
  UNION ALL SELECT 'profile-evidence', p, CASE k WHEN 16 THEN fc ELSE c END, 'unit', CASE k WHEN 17 THEN fu ELSE u END FROM x),
records(p, kind, id) AS (
  SELECT p, 'unit', u FROM x UNION ALL SELECT p, 'scene', sc FROM x UNION ALL SELECT p, 'appearance', a FROM x UNION ALL SELECT p, 'character', c FROM x UNION ALL SELECT p, 'chapter', 'P01' FROM x UNION ALL SELECT p, 'chapter', 'P02' FROM x WHERE conv_id % 2 = 0
  UNION ALL SELECT p, 'location', 'LOC-0001' FROM x UNION ALL SELECT p, 'location', 'LOC-0002' FROM x WHERE conv_id % 3 = 0)
SELECT DISTINCT p AS project_id, concat('X1 ', rule) AS rule, entity AS entity_id FROM refs r WHERE NOT EXISTS (SELECT 1 FROM records t WHERE t.p = r.p AND t.kind = r.kind AND t.id = r.id)"""


@query(_REFS_SQL)
def project_references(spark, sf):
    """All eighteen references of all projects in one pass; each is broken in every nineteenth project, by an id that is nowhere or only in other projects."""
    s = written(_shared(spark, sf), "shared-ids")
    bad = lambda k, other, own: F.when(F.col("k") == k, other if isinstance(other, Column) else F.lit(other)).otherwise(F.col(own) if isinstance(own, str) else own)
    unit = lambda k: bad(k, F.col("other_unit"), "unit_id")
    everyone = s.select("project_id", "conv_id").distinct()
    scenes = s.groupBy("project_id", "scene_id").agg(F.max(bad(5, "LOC-0002", F.lit("LOC-0001"))).alias("location_id"), F.collect_list(unit(6)).alias("source_unit_ids"), F.collect_list(unit(7)).alias("evidence_unit_ids"))
    people = s.groupBy("project_id", "character_id").agg(F.max("k").alias("k"), F.max("other_appearance").alias("other"), F.min("appearance_id").alias("own"), F.collect_list(unit(10)).alias("evidence_unit_ids"))
    evidence = lambda k: F.array(F.struct(unit(k).alias("source_unit_id")))
    tables = {
        "units": s.select("project_id", "unit_id", bad(0, "P02", "chapter_id").alias("chapter_id"), bad(1, F.col("other_character"), "character_id").alias("speaker_character_id"), evidence(2).alias("evidence")),
        "chapters": everyone.select("project_id", F.explode(F.when(F.col("conv_id") % 2 == 0, F.array(F.lit("P01"), F.lit("P02"))).otherwise(F.array(F.lit("P01")))).alias("chapter_id")),
        "analyses": s.groupBy("project_id").agg(F.max(bad(3, "P03", "chapter_id")).alias("chapter_id"), F.collect_list(unit(4)).alias("source_unit_ids")),
        "locations": everyone.select("project_id", F.explode(F.when(F.col("conv_id") % 3 == 0, F.array(F.lit("LOC-0001"), F.lit("LOC-0002"))).otherwise(F.array(F.lit("LOC-0001")))).alias("location_id")),
        "scenes": scenes,
        "beats": s.select("project_id", "beat_id", F.array(unit(8)).alias("source_unit_ids")),
        "characters": people.select("project_id", "character_id", F.when(F.col("k") == 9, F.col("other")).otherwise(F.col("own")).alias("first_appearance_id"), "evidence_unit_ids"),
        "appearances": s.select("project_id", "appearance_id", bad(11, F.col("other_character"), "character_id").alias("character_id"), bad(12, "P03", "chapter_id").alias("chapter_id"), bad(13, F.col("other_scene"), "scene_id").alias("scene_id"), F.array(unit(14)).alias("source_unit_ids"), evidence(15).alias("evidence")),
        "profile_fields": s.select("project_id", bad(16, F.col("other_character"), "character_id").alias("character_id"), F.array(unit(17)).alias("evidence_unit_ids")),
    }
    return rules.referential_integrity(tables).select("project_id", "rule", "entity_id")


_RULES_SQL = f"""WITH {_SHARED_SQL},
units AS (SELECT p, sc, list(u) AS us FROM x GROUP BY p, sc),
hashes AS (SELECT p, conv_id, sha256(max(text)) AS h FROM x GROUP BY p, conv_id)
SELECT p AS project_id, 'X9' AS rule, b AS entity_id, NULL AS value FROM x JOIN units USING (p, sc) WHERE conv_id % 5 = 0 AND turn = 1 AND NOT list_contains(us, fu)
UNION ALL SELECT p, 'X11', 'CHAR-0001', NULL FROM x WHERE conv_id % 4 = 0 GROUP BY p HAVING bool_or(role = 'user') AND bool_or(role = 'assistant')
UNION ALL SELECT p, 'X12', u, CASE role WHEN 'user' THEN concat('Ann ', conv_id) ELSE 'unknown' END FROM x WHERE role <> 'system'
UNION ALL SELECT DISTINCT p, 'X13', c, CASE WHEN role = 'user' AND conv_id % 3 = 0 THEN 'major' WHEN role = 'user' THEN 'candidate_major' ELSE 'minor' END FROM x
UNION ALL SELECT p, 'X14', 'P01', concat(count(*), ' ', count(*) FILTER (turn % 2 = 0), ' ', count(*) FILTER (turn % 4 = 0)) FROM x GROUP BY p
UNION ALL SELECT p, 'X15', u, NULL FROM x WHERE strpos(text, CASE WHEN (turn + conv_id) % 2 = 0 THEN concat(substr(text, 2, 8), '~') ELSE substr(text, 2, 8) END) = 0
UNION ALL SELECT p, 'X16', 'P01', NULL FROM hashes WHERE conv_id % 6 = 0
UNION ALL SELECT p, 'W10', c, min(a) FROM x GROUP BY p, c
UNION ALL SELECT p, 'W9', c, printf('CHAR-%04d', row_number() OVER (PARTITION BY p ORDER BY min(turn), c)) FROM x GROUP BY p, c"""


@query(_RULES_SQL)
def project_rules(spark, sf):
    """Beats, roles, speakers, confirmations, coverage, quotes, stale analyses, first appearances and numbering in all projects at once."""
    s = written(_shared(spark, sf), "shared-ids")
    scenes = s.groupBy("project_id", "scene_id").agg(F.collect_list("unit_id").alias("source_unit_ids"))
    stray = F.when((F.col("conv_id") % 5 == 0) & (F.col("turn") == 1), F.col("other_unit")).otherwise(F.col("unit_id"))
    none = F.array().cast("array<string>")
    kind = F.when(F.col("role") == "user", "role").when(F.col("role") == "assistant", "crowd").otherwise("named")
    name = F.when(F.col("role") == "user", F.concat(F.lit("Ann "), "conv_id")).when((F.col("role") == "assistant") & (F.col("conv_id") % 4 == 0), F.concat(F.lit("Ann "), "conv_id")).otherwise(F.concat("role", F.lit(" "), "conv_id"))
    people = s.select("project_id", "conv_id", "character_id", kind.alias("character_type"), name.alias("canonical_name"), none.alias("aliases"), F.when(F.col("role") == "user", "candidate_major").otherwise("minor").alias("importance")).distinct()
    units = s.select("project_id", "unit_id", "chapter_id", F.col("text").alias("source_text"), F.when(F.col("role") == "system", "narration").otherwise("dialogue").alias("text_type"), F.when(F.col("role") == "user", F.col("character_id")).alias("speaker_character_id"), F.when(F.col("turn") % 2 == 0, "x").alias("zh_cn"), F.when(F.col("turn") % 4 == 0, "pending").otherwise("translated").alias("translation_status"))
    quote = F.when((F.col("turn") + F.col("conv_id")) % 2 == 0, F.concat(F.substring("text", 2, 8), F.lit("~"))).otherwise(F.substring("text", 2, 8))
    evidence = s.select("project_id", F.col("unit_id").alias("entity_id"), F.col("unit_id").alias("source_unit_id"), quote.alias("quote"))
    chapters = s.groupBy("project_id", "conv_id", "chapter_id").agg(tx.digest(F.max("text")).alias("sha256"))
    analyses = chapters.withColumn("source_sha256", F.when(F.col("conv_id") % 6 == 0, "old").otherwise(F.col("sha256"))).drop("sha256")
    coverage = rules.translation_coverage(units)
    found = [
        rules.stray_beats(s.select("project_id", "beat_id", "scene_id", F.array(stray).alias("source_unit_ids")), scenes).select("project_id", "rule", "entity_id", F.lit(None).cast("string").alias("value")),
        rules.merged_roles(people).select("project_id", "rule", "entity_id", F.lit(None).cast("string").alias("value")),
        rules.dialogue(units, people).select("project_id", F.lit("X12"), "unit_id", "speaker"),
        rules.confirmed_majors(people, people.where("conv_id % 3 = 0")).select("project_id", F.lit("X13"), "character_id", "importance"),
        coverage.select("project_id", F.lit("X14"), "chapter_id", F.concat_ws(" ", "units", "translated", "pending_with_text")),
        rules.unquoted(evidence, units).select("project_id", "rule", "entity_id", F.lit(None).cast("string")),
        rules.stale(analyses, chapters).select("project_id", "rule", "entity_id", F.lit(None).cast("string")),
        rules.first_appearances(s, ["turn"]).select("project_id", F.lit("W10"), "character_id", "first_appearance_id"),
        rules.numbered_by_first(s, "character_id", ["turn"], "CHAR").select("project_id", F.lit("W9"), "character_id", "id"),
    ]
    return reduce(DataFrame.union, found)


_REPORTS_SQL = f"""WITH {_SHARED_SQL},
y AS (SELECT *, concat('P', printf('%02d', turn // 4 + 1)) AS ch, concat('P', printf('%02d', turn // 4 + 1), '-S', printf('%03d', turn // 2 + 1)) AS scene, CASE WHEN length(text) % 5 = 0 THEN 'mentioned' ELSE 'physical' END AS t FROM x),
stage AS (SELECT p, c, ch, count(*) AS n FROM y WHERE t <> 'mentioned' GROUP BY ALL),
cols AS (SELECT DISTINCT p, ch FROM y),
grid AS (SELECT k.p, k.c, o.ch, coalesce(s.n, 0) AS n FROM (SELECT DISTINCT p, c FROM stage) k JOIN cols o USING (p) LEFT JOIN stage s ON s.p = k.p AND s.c = k.c AND s.ch = o.ch)
SELECT p AS project_id, 'R1' AS report, ch AS entity, sha256(string_agg(concat(CASE WHEN role <> 'system' THEN concat(CASE role WHEN 'user' THEN concat('Ann ', conv_id) ELSE 'unknown' END, ': ') ELSE '' END, regexp_replace(text, '[\\r\\n]+$', ''), ' / ', upper(role), chr(10)), '' ORDER BY turn)) AS value FROM y GROUP BY p, ch
UNION ALL SELECT p, 'R2', 'heading', concat('character_id,', string_agg(ch, ',' ORDER BY ch), ',total') FROM cols GROUP BY p
UNION ALL SELECT p, 'R2', c, concat(c, ',', string_agg(CAST(n AS VARCHAR), ',' ORDER BY ch), ',', CAST(sum(n) AS BIGINT)) FROM grid GROUP BY p, c
UNION ALL SELECT p, 'R3', concat(c, ' ', CASE WHEN (turn // 2) % 2 = 0 THEN 'LOC-0001' ELSE 'LOC-0002' END), concat(count(DISTINCT scene), ' ', count(*), ' ', max(length(text) % 2 = 0)) FROM y WHERE role <> 'system' GROUP BY ALL
UNION ALL SELECT p, 'R5', ch, concat(count(*), ' ', count(DISTINCT CASE WHEN t <> 'mentioned' THEN c END), ' ', count(DISTINCT CASE WHEN t = 'mentioned' THEN c END), ' ', count(DISTINCT scene)) FROM y GROUP BY p, ch
UNION ALL SELECT p, 'R6', scene, string_agg(DISTINCT CASE WHEN t <> 'mentioned' AND conv_id % 3 <> 0 THEN concat(c, ' ', 'hair ', conv_id) END, ',' ORDER BY CASE WHEN t <> 'mentioned' AND conv_id % 3 <> 0 THEN concat(c, ' ', 'hair ', conv_id) END) FROM y GROUP BY p, scene"""


@query(_REPORTS_SQL)
def project_reports(spark, sf):
    """Scripts, appearance tables, statistics, summaries and prompts of all projects at once."""
    s = written(_shared(spark, sf), "shared-ids")
    chapter = tx.chapter_id((F.floor(F.col("turn") / 4) + 1).cast("int"))
    a = s.withColumn("chapter_id", chapter).withColumn("scene_id", tx.scene_id(chapter, F.floor(F.col("turn") / 2) + 1)).withColumn("appearance_type", F.when(F.length("text") % 5 == 0, "mentioned").otherwise("physical")).withColumn("has_dialogue", F.length("text") % 2 == 0)
    scenes = a.select("project_id", "scene_id", F.when(F.floor(F.col("turn") / 2) % 2 == 0, "LOC-0001").otherwise("LOC-0002").alias("location_id"), F.lit("Hall").alias("location_name"), F.lit("INT").alias("int_ext"), F.lit("day").alias("time_of_day")).distinct()
    people = a.select("project_id", "conv_id", "character_id", F.when(F.col("role") == "user", F.concat(F.lit("Ann "), "conv_id")).alias("canonical_name"), F.when(F.col("role") != "system", "major").otherwise("minor").alias("importance")).distinct()
    units = a.select("project_id", "chapter_id", F.col("turn").alias("ordinal"), F.col("text").alias("source_text"), F.upper("role").alias("zh_cn"), F.when(F.col("role") == "system", "narration").otherwise("dialogue").alias("text_type"), F.col("character_id").alias("speaker_character_id"))
    chapters = a.groupBy("project_id", "chapter_id").agg(F.count(F.lit(1)).alias("unit_count"), F.min("turn").alias("ordinal"))
    looks = people.where("conv_id % 3 <> 0").select("project_id", "character_id", F.lit("hair").alias("field"), F.col("conv_id").cast("string").alias("value"))
    found = [
        reports.bilingual_script(units, people).select("project_id", F.lit("R1").alias("report"), F.col("chapter_id").alias("entity"), tx.digest(F.col("script")).alias("value")),
        reports.appearance_table(a, chapters).select("project_id", F.lit("R2"), F.coalesce("character_id", F.lit("heading")), "line"),
        reports.scene_statistics(a, people, scenes).select("project_id", F.lit("R3"), F.concat_ws(" ", "character_id", "location_id"), F.concat_ws(" ", "scenes", "appearances", F.col("speaks").cast("string"))),
        reports.summary(chapters, a, scenes.withColumn("chapter_id", F.split_part("scene_id", F.lit("-"), F.lit(1)))).select("project_id", F.lit("R5"), "chapter_id", F.concat_ws(" ", "unit_count", "characters", "mentioned", "scenes")),
        reports.art_prompts(scenes, a, looks).select("project_id", F.lit("R6"), "scene_id", F.array_join(F.transform("looks", lambda x: F.concat_ws(" ", x["character_id"], x["field"], x["value"])), ",")),
    ]
    return reduce(DataFrame.union, found)


@query("""WITH a AS (SELECT role, printf('P%02d', conv_id) AS ch, conv_id, count(*) FILTER (length(text) % 5 <> 0) AS n FROM conversations GROUP BY ALL),
grid AS (SELECT k.role, o.ch, o.conv_id, coalesce(a.n, 0) AS n FROM (SELECT DISTINCT role FROM a WHERE n > 0) k CROSS JOIN (SELECT DISTINCT ch, conv_id FROM a) o LEFT JOIN a ON a.role = k.role AND a.conv_id = o.conv_id)
SELECT 0 AS place, NULL AS character_id, sha256(concat('character_id,', string_agg(ch, ',' ORDER BY conv_id), ',total')) AS sha256 FROM (SELECT DISTINCT ch, conv_id FROM a)
UNION ALL SELECT 1, role, sha256(concat(role, ',', string_agg(CAST(n AS VARCHAR), ',' ORDER BY conv_id), ',', CAST(sum(n) AS BIGINT))) FROM grid GROUP BY role""")
def appearance_csv(spark, sf):
    """The appearance table as CSV, with a column a chapter, where every conversation is a chapter of one book."""
    chapters = _one_project(screenplay(spark, sf).select("chapter_id", F.col("conv_id").alias("ordinal")).distinct())
    return reports.appearance_table(appearances(spark, sf), chapters).select("place", "character_id", tx.digest(F.col("line")).alias("sha256"))


_MD = "regexp_replace(replace({}, '|', '\\|'), '\\s+', ' ', 'g')"
_FILES_OF_SQL = f"""WITH {_SHARED_SQL},
y AS (SELECT *, concat('P', printf('%02d', turn // 4 + 1)) AS ch, concat('P', printf('%02d', turn // 4 + 1), '-S', printf('%03d', turn // 2 + 1)) AS scene, CASE WHEN length(text) % 5 = 0 THEN 'mentioned' ELSE 'physical' END AS t FROM x),
stage AS (SELECT p, c, ch, count(*) AS n FROM y WHERE t <> 'mentioned' GROUP BY ALL),
cols AS (SELECT DISTINCT p, ch FROM y),
grid AS (SELECT k.p, k.c, o.ch, coalesce(s.n, 0) AS n FROM (SELECT DISTINCT p, c FROM stage) k JOIN cols o USING (p) LEFT JOIN stage s ON s.p = k.p AND s.c = k.c AND s.ch = o.ch),
lines AS (SELECT p, 0 AS k, '' AS c, concat('character_id,', string_agg(ch, ',' ORDER BY ch), ',total') AS line FROM cols GROUP BY p UNION ALL SELECT p, 1, c, concat(c, ',', string_agg(CAST(n AS VARCHAR), ',' ORDER BY ch), ',', CAST(sum(n) AS BIGINT)) FROM grid GROUP BY p, c),
stats AS (SELECT p, c, loc, concat('| ', c, ' | Ann ', any_value(conv_id), ' | ', loc, ' | ', count(DISTINCT scene), ' | ', count(*), ' | ', max(length(text) % 2 = 0), ' |') AS line
  FROM (SELECT *, CASE WHEN (turn // 2) % 2 = 0 THEN 'LOC-0001' ELSE 'LOC-0002' END AS loc FROM y WHERE role = 'user') GROUP BY p, c, loc),
cells AS (SELECT DISTINCT p, c, f, concat('| ', c, ' | ', f, ' | ', CASE f WHEN 'age' THEN length(role) END, ' | ', CASE f WHEN 'age' THEN 'inferred' ELSE 'unknown' END, ' | ', CASE f WHEN 'age' THEN '0.5' ELSE '0.0' END, ' | ', CASE f WHEN 'age' THEN 1 ELSE 0 END, ' |') AS line FROM y, (VALUES ('age'), ('hair')) v(f))
SELECT p AS project_id, concat('deliverables/scripts_bilingual/', lower(ch), '.md') AS path, sha256(concat('| ordinal | unit_id | speaker | source_text | translation |\n| --- | --- | --- | --- | --- |\n', string_agg(concat('| ', turn, ' | ', u, ' | ', CASE role WHEN 'system' THEN '' WHEN 'user' THEN concat('Ann ', conv_id) ELSE 'unknown' END, ' | ', {_MD.format("regexp_replace(text, '[\\r\\n]+$', '')")}, ' | ', {_MD.format("upper(left(role, turn % 3))")}, ' |'), chr(10) ORDER BY turn), chr(10))) AS sha256 FROM y GROUP BY p, ch
UNION ALL SELECT p, 'deliverables/全角色章节出镜表.csv', sha256(string_agg(concat(line, chr(10)), '' ORDER BY k, c)) FROM lines GROUP BY p
UNION ALL SELECT p, 'deliverables/主要角色场景统计.md', sha256(concat('| character_id | canonical_name | location_id | scenes | appearances | speaks |\n| --- | --- | --- | --- | --- | --- |\n', string_agg(line, chr(10) ORDER BY c, loc), chr(10))) FROM stats GROUP BY p
UNION ALL SELECT p, 'deliverables/角色基础信息档案.md', sha256(concat('| character_id | field | value | status | confidence | n_evidence |\n| --- | --- | --- | --- | --- | --- |\n', string_agg(line, chr(10) ORDER BY c, f), chr(10))) FROM cells GROUP BY p"""


@query(_FILES_OF_SQL)
def project_deliverables(spark, sf):
    """All deliverable files of all projects, published as folders and read back."""
    s = written(_shared(spark, sf), "shared-ids")
    chapter = tx.chapter_id((F.floor(F.col("turn") / 4) + 1).cast("int"))
    a = s.withColumn("chapter_id", chapter).withColumn("scene_id", tx.scene_id(chapter, F.floor(F.col("turn") / 2) + 1)).withColumn("appearance_type", F.when(F.length("text") % 5 == 0, "mentioned").otherwise("physical")).withColumn("has_dialogue", F.length("text") % 2 == 0)
    scenes = a.select("project_id", "scene_id", F.when(F.floor(F.col("turn") / 2) % 2 == 0, "LOC-0001").otherwise("LOC-0002").alias("location_id")).distinct()
    people = a.select("project_id", "character_id", F.when(F.col("role") == "user", F.concat(F.lit("Ann "), "conv_id")).alias("canonical_name"), F.when(F.col("role") == "user", "major").otherwise("minor").alias("importance")).distinct()
    translation = F.upper(F.left("role", (F.col("turn") % 3).cast("int")))
    units = a.select("project_id", "chapter_id", "unit_id", F.col("turn").alias("ordinal"), F.col("text").alias("source_text"), translation.alias("zh_cn"), F.when(F.col("role") == "system", "narration").otherwise("dialogue").alias("text_type"), F.col("character_id").alias("speaker_character_id"))
    chapters = a.groupBy("project_id", "chapter_id").agg(F.min("turn").alias("ordinal"))
    cell = lambda field, value, status, confidence, n: F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"), F.lit(status).alias("status"), F.lit(confidence).alias("confidence"), F.array_repeat(F.lit("e"), n).alias("evidence"))
    fields = a.select("project_id", "character_id", "role").distinct().select("project_id", "character_id", F.inline(F.array(cell("age", F.length("role"), "inferred", 0.5, 1), cell("hair", F.lit(None), "unknown", 0.0, 0))))
    root = fresh_path(spark, "deliverables")
    write_projects(deliverable_files(units, people, a, chapters, scenes, fields), root)
    return read_folders(spark, root).select("project_id", "path", tx.digest(F.col("content")).alias("sha256"))


@query("""SELECT concat('PRJ-', n_nationkey) AS project_id, 'location' AS kind, printf('LOC-%04d', n_regionkey + 1) AS id, concat(n_name, ' ', 'R', n_regionkey, ' 1') AS facts FROM nation
UNION ALL SELECT concat('PRJ-', s_nationkey), 'term', s_name, concat('T', s_suppkey, ' ', CASE WHEN s_suppkey % 2 = 0 THEN 'name' END) FROM supplier""")
def registries(spark, sf):
    """Registries of places and terms, a project a nation, published and read back with their declared schemas."""
    js = lambda *c: F.to_json(F.struct(F.lit("2.0.0").alias("schema_version"), *c), {"ignoreNullFields": "false"})
    array = lambda c: F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list(c)), ","), F.lit("]")).cast("binary").alias("content")
    project = lambda c: F.concat(F.lit("PRJ-"), c).alias("project_id")
    place = js(F.format_string("LOC-%04d", F.col("n_regionkey") + 1).alias("location_id"), F.col("n_name").alias("canonical_name"), F.lit(None).cast("string").alias("chinese_name"), F.array(F.concat(F.lit("R"), "n_regionkey")).alias("aliases"), F.array(F.struct(F.lit("P01-U0001").alias("source_unit_id"), F.lit("q").alias("quote"))).alias("evidence"))
    term = js(F.col("s_name").alias("term"), F.concat(F.lit("T"), "s_suppkey").alias("zh_cn"), F.when(F.col("s_suppkey") % 2 == 0, "name").alias("category"))
    files = _table(spark, sf, "nation").groupBy(project("n_nationkey")).agg(array(place)).select("project_id", F.lit(PLACES["locations"]).alias("path"), "content")
    files = files.unionByName(_table(spark, sf, "supplier").groupBy(project("s_nationkey")).agg(array(term)).select("project_id", F.lit(PLACES["terminology"]).alias("path"), "content"))
    root = fresh_path(spark, "registries")
    write_projects(files, root)
    back = read_folders(spark, root)
    places, terms = typed_records(back, "locations"), typed_records(back, "terminology")
    return places.select("project_id", F.lit("location").alias("kind"), F.col("location_id").alias("id"), F.concat_ws(" ", "canonical_name", F.col("aliases")[0], F.size("evidence").cast("string")).alias("facts")).union(
        terms.select("project_id", F.lit("term"), "term", F.concat("zh_cn", F.lit(" "), F.coalesce("category", F.lit(""))))
    )


@query("""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 10 = 4 THEN concat(text, ' more') ELSE text END AS t, doc_id % 10 = 4 AS changed FROM documents WHERE text IS NOT NULL)
SELECT CAST(doc_id AS VARCHAR) AS entity_id, concat(length(lower(t)), ' chars') AS output, CASE WHEN changed THEN 2 ELSE 1 END AS n_lowered, CASE WHEN doc_id % 7 = 3 THEN 2 ELSE 1 END + CASE WHEN changed THEN 1 ELSE 0 END AS n_measured FROM d""")
def resumed_run(spark, sf):
    """Two stages over all documents: the second one breaks, then cannot validate some records, and after that some inputs change. Each run does what is open, and the last one ends with the rows of an unbroken run."""
    items = _table(spark, sf, "documents").where("text is not null").select(F.col("doc_id").cast("string").alias("entity_id"), F.col("text").alias("output"))
    lower = Stage("lowered", lambda df: df.withColumn("output", F.lower("output")))
    measure = lambda df: df.withColumn("output", F.concat(F.length("output"), F.lit(" chars")))
    odd = F.col("entity_id").cast("long") % 7 == 3
    broken = Stage("measured", lambda df: measure(df).withColumn("output", F.when(odd, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("output"))))
    unsure = Stage("measured", lambda df: measure(df).withColumn("output", F.when(odd, F.lit(None)).otherwise(F.col("output"))))
    runner = Runner(spark, fresh_path(spark, "stages"))
    try:
        runner.run(items, [lower, broken])
    except Exception as e:
        if "lost" not in str(e):
            raise
    else:
        raise RuntimeError("the broken stage was not run")
    runner.run(items, [lower, unsure])
    runner.run(items, [lower, Stage("measured", measure)])
    changed = items.withColumn("output", F.when(F.col("entity_id").cast("long") % 10 == 4, F.concat("output", F.lit(" more"))).otherwise(F.col("output")))
    ends = runner.run(changed, [lower, Stage("measured", measure)])
    times = [runner.ledger(stage).groupBy("entity_id").agg(F.count(F.lit(1)).cast("int").alias(f"n_{stage}")) for stage in ("lowered", "measured")]
    return ends.select("entity_id", "output").join(times[0], "entity_id").join(times[1], "entity_id")


@query("""WITH d AS (SELECT concat('PRJ-', lang) AS p, source, doc_id % 3 AS piece, min(doc_id) AS place FROM documents WHERE source IS NOT NULL GROUP BY ALL),
f AS (SELECT p, source, min({'piece': piece, 'place': place}) AS f FROM d GROUP BY p, source)
SELECT p AS project_id, printf('CHAR-%04d', row_number() OVER (PARTITION BY p ORDER BY f, source)) AS id, source AS name FROM f""")
def registry_stream(spark, sf):
    """Documents that arrive in three pieces, the stream stopped and started again between them: names keep the ids they got when they were first seen."""
    d = _table(spark, sf, "documents").select(F.concat(F.lit("PRJ-"), "lang").alias("project_id"), F.col("source").alias("name"), F.col("doc_id").alias("place"))
    inbox, target, checkpoint = (fresh_path(spark, f"registry-{k}") for k in ("inbox", "target", "checkpoint"))
    for piece in range(3):
        d.where(F.col("place") % 3 == piece).write.mode("append").parquet(inbox)
        stream_registry(spark.readStream.schema(d.schema).parquet(inbox), target, checkpoint).awaitTermination()
    return spark.read.schema("project_id string, id string, name string").parquet(target)
