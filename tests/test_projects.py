"""The data source of project folders: publishing, refusal, failure, and a store without renames."""

import os

import pytest
from pyspark.sql import functions as F

from folioforge.sources.projects import read_folders, registered, write_projects
from folioforge.sources.records import read_projects

ROWS = [(f"PRJ-{p}", f"data/{k}/f {k} ä.txt", f"{p} {k}".encode() * k) for p in range(7) for k in range(4)] + [("PRJ-0", "project.json", b"{}"), ("PRJ-1", "empty", b"")]
STORES = ["file", "flat"]


@pytest.fixture
def store(request, tmp_path):
    if request.param == "file":
        return f"file://{tmp_path}/some folder", None
    return f"flat://{tmp_path}", "tests.flatfs:at"


def everything(tmp_path):
    return sorted(os.path.relpath(os.path.join(d, f), tmp_path) for d, _, names in os.walk(tmp_path) for f in names)


@pytest.mark.parametrize("store", STORES, indirect=True)
def test_published_once(spark, store, tmp_path):
    root, factory = store
    files = spark.createDataFrame(ROWS, "project_id string, path string, content binary").repartition(3)
    assert write_projects(files, root, filesystem=factory) == [f"PRJ-{p}" for p in range(7)]
    assert sorted(map(tuple, read_folders(spark, root, filesystem=factory).collect())) == sorted(ROWS)
    before = everything(tmp_path)
    more = files.withColumn("content", F.lit(b"other")).union(spark.createDataFrame([("PRJ-9", "a", b"new")], files.schema))
    assert write_projects(more, root, filesystem=factory) == ["PRJ-9"]
    assert sorted(map(tuple, read_folders(spark, root, filesystem=factory).collect())) == sorted([*ROWS, ("PRJ-9", "a", b"new")])
    assert set(before) < set(everything(tmp_path)) and not any("staging" in f or "report" in f for f in everything(tmp_path))
    if factory is None:
        assert sorted(map(tuple, read_projects(spark, root).collect())) == sorted(r for r in [*ROWS, ("PRJ-9", "a", b"new")] if r[2])


@pytest.mark.parametrize("store", STORES, indirect=True)
def test_a_failed_job_leaves_nothing(spark, store, tmp_path):
    root, factory = store
    files = spark.createDataFrame(ROWS, "project_id string, path string, content binary")
    broken = files.withColumn("content", F.when((F.col("project_id") == "PRJ-5") & (F.col("path").contains("3")), F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("content")))
    with pytest.raises(Exception, match="lost"):
        write_projects(broken, root, filesystem=factory)
    assert everything(tmp_path) == []
    with pytest.raises(Exception, match="not a name"):
        write_projects(files.withColumn("path", F.lit("../out")), root, filesystem=factory)
    assert everything(tmp_path) == []
    assert len(write_projects(files, root, filesystem=factory)) == 7


@pytest.mark.parametrize("store", STORES, indirect=True)
def test_projects_spread_over_tasks(spark, store, tmp_path):
    root, factory = store
    options = {"path": root} | ({"filesystem": factory} if factory else {})
    files = spark.createDataFrame(ROWS, "project_id string, path string, content binary").repartition(5)
    registered(spark)
    files.write.format("project_folders").mode("append").options(**options).save()
    assert sorted(map(tuple, read_folders(spark, root, filesystem=factory).collect())) == sorted(ROWS)
    with pytest.raises(Exception, match="never overwritten"):
        files.write.format("project_folders").mode("overwrite").options(**options).save()


def test_a_commit_that_was_cut_short_is_done_again(spark, tmp_path):
    """Without its mark a project of a store without renames is not there."""
    from tests.flatfs import at

    root = f"flat://{tmp_path}"
    system, base = at(root)
    with system.open_output_stream(f"{base}/PRJ-0/half.txt") as out:
        out.write(b"half")
    assert read_folders(spark, root, filesystem="tests.flatfs:at").count() == 0
    files = spark.createDataFrame(ROWS, "project_id string, path string, content binary")
    assert "PRJ-0" in write_projects(files, root, filesystem="tests.flatfs:at")
    assert sorted(map(tuple, read_folders(spark, root, filesystem="tests.flatfs:at").collect())) == sorted(ROWS)
