"""Command line: ingest a file into a project folder, validate a folder, lint schema files."""

from __future__ import annotations

import argparse
import re
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session() -> SparkSession:
    return SparkSession.builder.appName("folioforge").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def ingest_file(spark: SparkSession, source: Path, target: Path, title: str | None) -> str | None:
    """Writes the project folder; returns the reason where it cannot."""
    from folioforge.operators.ingest import ingest, project_files
    from folioforge.sources.files import read_sources
    from folioforge.sources.records import write_projects

    if not source.is_file():
        return f"source file not found: {source}"
    if target.exists():
        return f"project directory already exists: {target}"
    plain = re.sub(r"([\[\]{}*?\\])", r"\\\1", str(source.resolve()))  # no pattern of file names
    file = read_sources(spark, f"file://{plain}").select(F.lit(source.name).alias("filename"), "content", F.lit(title).alias("title"))
    got = ingest(file)
    if refused := got.rejected.first():
        return refused["reason"]
    target.parent.mkdir(parents=True, exist_ok=True)
    write_projects(project_files(got).withColumn("project_id", F.lit(target.name)), str(target.parent.resolve()))
    return None


def violations(spark: SparkSession, project: Path) -> list[str]:
    from folioforge.operators.verify import verify
    from folioforge.sources.records import read_projects

    files = read_projects(spark, str(project.resolve().parent)).where(F.col("project_id") == project.resolve().name)
    rows = verify(files).orderBy("check_id", "entity_id", "row_no").collect()
    return [f"{r['check_id']} {r['entity_id'] or ''} {r['row_no'] or ''} {r['message']}".replace("  ", " ") for r in rows]


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="folioforge")
    commands = parser.add_subparsers(dest="command", required=True)
    ingest = commands.add_parser("ingest")
    ingest.add_argument("input", type=Path)
    ingest.add_argument("--project-dir", type=Path, required=True)
    ingest.add_argument("--title")
    commands.add_parser("validate").add_argument("project_dir", type=Path)
    commands.add_parser("lint").add_argument("schema_dir", type=Path)
    got = parser.parse_args(args)
    spark = _session()
    if got.command == "ingest":
        reason = ingest_file(spark, got.input, got.project_dir, got.title)
        print(f"INGESTION FAILED: {reason}" if reason else f"INGESTION PASSED: {got.project_dir}")
        return int(bool(reason))
    if got.command == "validate":
        found = violations(spark, got.project_dir) if got.project_dir.is_dir() else ["V1 project or manifest unreadable"]
    else:
        from folioforge.sources.records import lint_schemas, read_documents

        files = sorted(got.schema_dir.glob("*.json"))
        documents = read_documents(spark, str(got.schema_dir)) if files else spark.createDataFrame([], "name string, json string")
        found = [f"{r['check_id']} {r['name'] or ''} {r['message']}" for r in lint_schemas(documents).collect()]
    print(f"{got.command.upper()} {'FAILED' if found else 'PASSED'}")
    for line in found:
        print(f"- {line}")
    return int(bool(found))


if __name__ == "__main__":
    sys.exit(main())
