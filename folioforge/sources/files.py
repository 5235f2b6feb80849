"""Source files: whole files as rows, decoded without any normalization."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions import text as tx
from folioforge.functions.decode import decode_batches

# Formats by suffix, names of encodings and rules.
FORMATS = {".txt": "txt", ".md": "md", ".docx": "docx"}
RULES = {
    "utf-8-sig": "text decoded without UTF BOM; no content normalization",
    "utf-16-le-bom": "UTF-16 decoded without BOM; no content normalization",
    "utf-16-be-bom": "UTF-16 decoded without BOM; no content normalization",
    "utf-8": "text decoded as UTF-8; no content normalization",
    "cp1252": "text decoded as Windows-1252; no content normalization",
    "docx": "DOCX body XML in document order; paragraphs separated by LF",
}

_GOT = T.StructType([T.StructField("text", T.StringType()), T.StructField("warnings", T.ArrayType(T.StringType())), T.StructField("reason", T.StringType())])


def read_sources(spark: SparkSession, path: str, *, glob: str = "*") -> DataFrame:
    """filename, content, title (null) of all files below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(F.regexp_extract("path", r"([^/]*)\z", 1).alias("filename"), "content", F.lit(None).cast("string").alias("title"))


def decode_sources(files: DataFrame) -> DataFrame:
    """Adds format, encoding, rule, warnings, canonical_text, reason (null where the file is accepted).

    UTF-8 is decoded by SQL functions; only UTF-16, Windows-1252 and DOCX files go through Python.
    """
    head = F.hex(F.substring("content", 1, 3))
    plain = F.col("content").cast("string")
    formats = F.create_map(*[F.lit(x) for kv in FORMATS.items() for x in kv])
    kind = (
        F.when(F.col("format").isNull(), None)
        .when(F.col("format") == "docx", "docx")
        .when(head == "EFBBBF", "utf-8-sig")
        .when(head.startswith("FFFE"), "utf-16-le-bom")
        .when(head.startswith("FEFF"), "utf-16-be-bom")
        .when(F.is_valid_utf8(plain), "utf-8")
        .otherwise("cp1252")
    )
    known = files.withColumn("format", formats[tx.suffix(F.col("filename"))]).withColumn("kind", kind)
    native = F.col("kind").isNull() | F.col("kind").isin("utf-8", "utf-8-sig")
    body = F.when(F.col("kind") == "utf-8", plain).when(F.col("kind") == "utf-8-sig", F.substring("content", 4, 2147483647).cast("string"))
    bad = F.when(F.col("kind").isNull(), "supported inputs: .txt, .md, .docx").when(~F.is_valid_utf8(body), "undecodable utf-8-sig")
    easy = known.where(native).withColumn("got", F.struct(F.when(bad.isNull(), body).alias("text"), F.array().cast("array<string>").alias("warnings"), bad.alias("reason")))
    rest = known.where(~native)
    hard = rest.mapInArrow(decode_batches, T.StructType([*rest.schema.fields, T.StructField("got", _GOT)]))
    rules = F.create_map(*[F.lit(x) for kv in RULES.items() for x in kv])
    return easy.unionByName(hard).select(
        *files.columns, "format",
        F.when(F.col("kind") == "docx", "docx-xml").otherwise(F.col("kind")).alias("encoding"),
        rules[F.col("kind")].alias("rule"), "got.warnings", F.col("got.text").alias("canonical_text"),
        F.when(F.col("got.reason").isNotNull(), F.col("got.reason")).when(F.length("got.text") == 0, "source contains no text").alias("reason"),
    )
