"""The corpus pipeline: documents that are fit, unique, clean of benchmarks, mixed, and written as token ids.

STAGES are applied in order; each takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last return documents' columns.
Stages on word shingles take five words and a similarity of 0.8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm.decontaminate import decontaminate
from folioforge.llm.mixing import sample
from folioforge.llm.neardup import deduplicate
from folioforge.llm.quality import accepted
from folioforge.llm.session import fresh_path, table, written
from folioforge.llm.tokenfiles import read_tokens, write_tokens


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return deduplicate(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn by calibrated probabilities."""
    return sample(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is written as token files; returns doc_id, start, n_tokens and ids_crc32 as read from them."""
    import public_tokenizers

    return read_tokens(spark, write_tokens(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), folder=fresh_path(spark, "corpus")))


STAGES = [("quality classifier", quality), ("near duplicates", near_dedup), ("decontamination", benchmark_free), ("mixing", mix), ("token files", tokens)]

#: The classifier and the byte-level tokenizer cannot be expressed in SQL; each stage is tested on its own input (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
