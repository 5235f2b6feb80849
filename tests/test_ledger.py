"""Differences by groups, and slices of long texts."""

import hashlib
import json
import random
import time

from pyspark.sql import functions as F

from folioforge.operators.ledger import differences, differing, within
from folioforge.operators.verify import verify


def test_differences_by_groups_equal_those_of_all_rows(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["p1", "p2", "p3", None]), rng.choice(["c1", "c2", None]), rng.choice(["x", "y", None]), rng.choice([1, 2, None])) for _ in range(400)]
    other = rows[:150] + [(p, c, t, 9 if p == "p2" and c == "c1" and t == "x" else n) for p, c, t, n in rows[150:390]] + [("p9", "c1", "x", 1)]
    a, b = (spark.createDataFrame(r, "project_id string, chapter_id string, t string, n int") for r in (rows, other))
    keys = ["project_id", "chapter_id"]
    want, got = (sorted(map(repr, differences(a, b, k).collect())) for k in (None, keys))
    assert got == want and want
    same = spark.createDataFrame([*rows, ("q", "c", "x", 1), ("q", "c", None, 1)], a.schema)
    moved = spark.createDataFrame([*rows, ("q", None, "x", 1), ("q", "c", "x", 1)], a.schema)
    assert [tuple(r) for r in differing(same, moved, keys).orderBy("chapter_id").collect()] == [("q", None), ("q", "c")]
    assert differing(a, a, keys).isEmpty()


def test_unchanged_projects_are_not_compared_by_row(spark):
    a = spark.range(5000).select(F.concat(F.lit("p"), F.col("id") % 50).alias("project_id"), (F.col("id") % 7).alias("chapter_id"), "id")
    b = a.withColumn("id", F.when(F.col("id") == 1234, -1).otherwise(F.col("id")))
    found = differing(a, b, ["project_id", "chapter_id"])
    assert [tuple(r) for r in found.collect()] == [("p34", 1234 % 7)]
    assert within(a, found).count() < 20
    assert sorted((r["side"], r["id"]) for r in differences(a, b, ["project_id", "chapter_id"]).collect()) == [("first", 1234), ("second", -1)]


def project(n, size):
    """A project of n chapters, each a line of size characters, some of them wide; the manifest as plain Python makes it."""
    sha = lambda b: hashlib.sha256(b).hexdigest()
    lines = [("é日👍﻿"[k % 4] + f"{k:08d}").ljust(size - 1, "x") + "\n" for k in range(n)]
    text = "".join(lines)
    chapters, files = [], {}
    for k, line in enumerate(lines):
        c = f"P{k + 1:02d}"
        unit = {"unit_id": f"{c}-U0001", "chapter_id": c, "ordinal": 1, "source_text": line, "source_sha256": sha(line.encode())}
        chapters.append({"chapter_id": c, "ordinal": k + 1, "source_start": k * size, "source_end": (k + 1) * size, "character_length": size, "sha256": sha(line.encode()), "source_path": f"c/{c}", "units_path": f"u/{c}", "unit_count": 1})
        files[f"c/{c}"], files[f"u/{c}"] = line.encode(), json.dumps(unit, ensure_ascii=False).encode() + b"\n"
    manifest = json.dumps({"project_id": "p", "source": {"copy_path": "copy", "byte_length": len(text.encode()), "sha256": sha(text.encode())}, "canonical": {"path": "text", "byte_length": len(text.encode()), "character_length": len(text), "sha256": sha(text.encode())}, "chapters": chapters}).encode()
    files |= {"copy": text.encode(), "text": text.encode(), "m": manifest, "project.json": json.dumps({"project_id": "p", "source_manifest": "m", "artifacts": [{"path": "source/manifest.json", "sha256": sha(manifest)}]}).encode()}
    return [("p", path, content) for path, content in files.items()]


def test_ten_thousand_chapters(spark):
    """All slices of a text of five million characters; a wrong one is found, and a chapter more costs no more than the last."""
    files = project(10_000, 500)
    df = spark.createDataFrame(files, "project_id string, path string, content binary").cache()
    df.count()
    began = time.time()
    assert verify(df).collect() == []
    assert time.time() - began < 120  # with slices that count from the text's beginning, 25 thousand million characters
    broken = df.withColumn("content", F.when(F.col("path") == "c/P5000", F.expr("overlay(content PLACING X'7A' FROM 30)")).otherwise(F.col("content")))
    assert {(r["check_id"], r["entity_id"]) for r in verify(broken).collect()} == {("V12", "P5000"), ("V13", "P5000"), ("V18e", "P5000"), ("V20", None)}


def test_offsets_beyond_the_text(spark):
    rows = project(3, 12)
    manifest = json.loads(dict((p, c) for _, p, c in rows)["m"])
    manifest["chapters"][2]["source_start"], manifest["chapters"][2]["source_end"] = -12, 999_999_999_999
    rows = [(k, p, json.dumps(manifest).encode() if p == "m" else c) for k, p, c in rows]
    found = {(r["check_id"], r["entity_id"]) for r in verify(spark.createDataFrame(rows, "project_id string, path string, content binary")).collect()}
    assert found == {("V3", None), ("V10", "P03"), ("V19", None)}


def test_stages_resume(spark, tmp_path):
    """What was not committed does not count; failed records are tried again; each record is done once on each input."""
    from folioforge.plans.runner import Runner, Stage

    runner = Runner(spark, f"file://{tmp_path}/stages")
    items = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None)], "entity_id string, output string")
    up = Stage("up", lambda df: df.withColumn("output", F.upper("output")), lambda o: o != "Y")
    assert [r["output"] for r in runner.run(items, [up]).collect()] == ["X"]
    (tmp_path / "stages/up/run-broken").mkdir()
    assert [r["output"] for r in runner.run(items, [Stage("up", up.make)]).orderBy("output").collect()] == ["X", "Y"]
    assert {(r["entity_id"], r["status"]): r["count"] for r in runner.ledger("up").groupBy("entity_id", "status").count().collect()} == {("a", "validated"): 1, ("b", "failed"): 1, ("b", "validated"): 1, ("c", "failed"): 2}
    assert runner.run(items, [Stage("up", up.make), Stage("twice", lambda df: df.withColumn("output", F.repeat("output", 2)))]).count() == 2


def shuffled(spark):
    """Bytes that all stages so far wrote to shuffles."""
    gateway = spark.sparkContext._gateway
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


def test_texts_are_shuffled_only_where_some_are_open(spark, tmp_path):
    """No run shuffles the texts of records that it does not work on, as many or few as they are."""
    from folioforge.plans.runner import Runner, Stage

    n, size = 400, 128 * 200
    text = F.concat(*[F.sha2(F.concat("id", F.lit(f" {k}")), 512) for k in range(200)])
    spark.range(n).select(F.col("id").cast("string").alias("entity_id"), text.alias("output")).write.parquet(f"{tmp_path}/items")
    items = spark.read.parquet(f"{tmp_path}/items")
    some = items.withColumn("output", F.when(F.col("entity_id") == "7", "changed").otherwise(F.col("output")))
    runner = Runner(spark, f"file://{tmp_path}/stages")
    stages = [Stage("up", lambda df: df.withColumn("output", F.upper("output"))), Stage("long", lambda df: df.withColumn("output", F.length("output").cast("string")))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        began = shuffled(spark)
        for given, want in ((items, [str(size)] * n), (items, [str(size)] * n), (some, ["7"] + [str(size)] * (n - 1))):
            assert sorted(r["output"] for r in runner.run(given, stages).collect()) == sorted(want)
        assert shuffled(spark) - began < n * size / 4  # before: several times n * size
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert runner.ledger("up").count() == n + 1 and runner.ledger("long").count() == n + 1


def test_records_keep_their_number_and_nulls(spark, tmp_path):
    """An item that is there twice is done twice; one without a text or an id is tried by each run, and goes on where it is valid."""
    from folioforge.plans.runner import Runner, Stage

    runner = Runner(spark, f"file://{tmp_path}/stages")
    items = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("c", None), (None, "z")], "entity_id string, output string")
    stages = [Stage("one", lambda df: df, lambda o: F.lit(True)), Stage("two", lambda df: df.withColumn("output", F.concat("output", F.lit("!"))))]
    want = [("a", "x!"), ("a", "x!"), ("b", "x!")]
    for _ in range(2):
        assert sorted((r["entity_id"], r["output"]) for r in runner.run(items, stages).collect()) == want
    assert {(r["entity_id"], r["status"]): r["count"] for r in runner.ledger("one").groupBy("entity_id", "status").count().collect()} == {("a", "validated"): 2, ("b", "validated"): 1, ("c", "validated"): 2, (None, "validated"): 2}
    more = items.union(spark.createDataFrame([("d", "y")], items.schema))
    assert sorted((r["entity_id"], r["output"]) for r in runner.run(more, stages).collect()) == [*want, ("d", "y!")]
    digest = hashlib.sha256(b"x").hexdigest()
    asked = spark.createDataFrame([("b", digest), ("b", "none"), ("a", digest)], "entity_id string, input_sha256 string")
    assert sorted((r["entity_id"], r["output"]) for r in runner.outputs("two", asked).collect()) == [("a", "x!"), ("b", "x!")]
    assert runner.outputs("three", asked).count() == 0
