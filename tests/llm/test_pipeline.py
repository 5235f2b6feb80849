import zlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import test_decontaminate
import test_neardup
from tokenizers import Tokenizer

from folioforge.llm.quality import classify
from folioforge.llm.queries import OP8_SQL
from folioforge.llm.session import table, written


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_stages_match_brute_force(spark, sf, tmp_path):
    """Each stage on its own input, against a version of it without Spark (the classifier: against its own judgement of each row)."""
    stages = dict(corpus_pipeline.STAGES)
    docs = table(spark, sf, "documents")
    columns, sizes = docs.columns, [docs.count()]

    judged = {r["doc_id"]: r["kept"] for r in classify(docs, table(spark, sf, "labels")).collect()}
    fit = written(stages["quality classifier"](spark, docs, sf), "stage")
    assert fit.columns == columns and ids(fit) == sorted(k for k, kept in judged.items() if kept)
    marks = {r["doc_id"]: (r["quality"], r["toxic"]) for r in table(spark, sf, "labels").collect()}
    clean = [k for k, (quality, toxic) in marks.items() if quality and not toxic]
    assert sum(judged[k] for k in clean) > 0.95 * len(clean) and sum(not judged[k] for k, (quality, toxic) in marks.items() if toxic or not quality) > 0.8 * (len(marks) - len(clean))

    unique = written(stages["near duplicates"](spark, fit, sf), "stage")
    rows = [(r["doc_id"], r["text"]) for r in fit.collect()]
    assert unique.columns == columns and ids(unique) == sorted(r[0] for r in test_neardup.brute(rows, words=5) if r[3])

    free = written(stages["decontamination"](spark, unique, sf), "stage")
    rows = [(r["doc_id"], r["text"]) for r in unique.collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    assert free.columns == columns and ids(free) == sorted(r[0] for r in test_decontaminate.brute(rows, items) if not r[5])

    mixed = written(stages["mixing"](spark, free, sf), "stage")
    free.toPandas().to_parquet(tmp_path / "free.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/free.parquet'")
    drawn = [r[0] for r in con.execute(f"SELECT doc_id FROM ({OP8_SQL}) WHERE sampled ORDER BY doc_id").fetchall()]
    assert mixed.columns == columns and ids(mixed) == drawn

    plain, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for doc_id, text in sorted((r["doc_id"], r["text"]) for r in mixed.collect()):
        got = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((doc_id, start, len(got), zlib.crc32(np.array(got, "<u4").tobytes())))
        start += len(got)
    assert sorted(tuple(r) for r in stages["token files"](spark, mixed, sf).collect()) == want
    sizes += [fit.count(), unique.count(), free.count(), mixed.count()]
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) > 3


def test_edges(spark, tmp_path):
    """Null ids, null and empty texts, repeated rows, one id with two texts, very long texts, columns with clashing names, empty tables."""
    long = " ".join(f"w{k}" for k in range(60000))
    rows = [(None, "a text without an id", "en", None, 1), (None, None, None, "s", 1), (1, "", "en", "s", 1), (2, long, "en", "s", 1), (3, long + " more", "en", "t", 1), (4, "twice the same row of words", "en", "t", 1), (4, "twice the same row of words", "en", "t", 1), (4, "but another text", "de", "t", 1), (5, "holds the words of an item here", "en", "s", 1)]
    shape = "doc_id long, text string, lang string, source string, {} int"
    for name in ("row", "found", "words", "low", "__h"):
        docs = spark.createDataFrame(rows, shape.format(name))
        sf = str(tmp_path / name)
        docs.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (None, 0, 1), (2, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(7, "words of an item"), (8, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        for _, stage in corpus_pipeline.STAGES[:3]:
            docs = written(stage(spark, docs, sf), "stage")
            assert docs.columns == ["doc_id", "text", "lang", "source", name]
        assert sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr) == sorted([(r[0], r[1]) for r in rows if r[0] not in (3, 5)], key=repr)
    assert corpus_pipeline.run(spark, sf).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
