"""The deliverable files of all projects, rendered from records: project_id, path, content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.plans import reports
from folioforge.sources.records import table_files

# Where the files lie below a project's folder.
SCRIPTS = "deliverables/scripts_bilingual/"
APPEARANCES = "deliverables/全角色章节出镜表.csv"
STATISTICS = "deliverables/主要角色场景统计.md"
DOSSIERS = "deliverables/角色基础信息档案.md"


def _of_projects(df: DataFrame, path: str, order: list[str]) -> DataFrame:
    """A Markdown table of each project. project_id is no folder name of its own here, so any text will do."""
    keyed = table_files(df, "project_id", F.col("project_id"), "markdown", order)
    return keyed.select(F.col("path").alias("project_id"), F.lit(path).alias("path"), "content")


def deliverable_files(units: DataFrame, characters: DataFrame, appearances: DataFrame, chapters: DataFrame, scenes: DataFrame, profile_fields: DataFrame) -> DataFrame:
    """Scripts with translations (R1, a file a chapter), the appearance table (R2), statistics (R3) and dossiers.

    profile_fields: project_id, character_id, field, value, status, confidence, evidence.
    Columns and their order are this engine's choice; lines end in line feeds.
    """
    lines = reports.script_lines(units, characters)
    key = F.to_json(F.struct("project_id", "chapter_id"))
    script = lines.select(key.alias("key"), "ordinal", "unit_id", F.coalesce("speaker", F.lit("")).alias("speaker"), F.col("line").alias("source_text"), F.coalesce("zh_cn", F.lit("")).alias("translation"))
    made = table_files(script, "key", F.col("key"), "markdown", ["ordinal", "unit_id"])
    of = F.from_json("path", "project_id string, chapter_id string")
    scripts = made.select(of["project_id"].alias("project_id"), F.concat(F.lit(SCRIPTS), F.lower(of["chapter_id"]), F.lit(".md")).alias("path"), "content")
    table = reports.appearance_table(appearances, chapters).groupBy("project_id").agg(tx.joined(F.concat("line", F.lit("\n")), F.struct("place", "character_id")).cast("binary").alias("content"))
    statistics = reports.scene_statistics(appearances, characters, scenes)
    known = profile_fields.select("project_id", "character_id", "field", F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"), "status", "confidence", F.size("evidence").alias("n_evidence"))
    return (
        scripts.unionByName(table.select("project_id", F.lit(APPEARANCES).alias("path"), "content"))
        .unionByName(_of_projects(statistics, STATISTICS, ["character_id", "location_id"]))
        .unionByName(_of_projects(known, DOSSIERS, ["character_id", "field"]))
    )
