"""Lines of texts that are cut into blocks: a segmented scan, so one text is the work of many tasks.

A block holds whole code points and never parts a carriage return from its line feed. Each block is
cut into lines by itself; the ends that a block leaves open are put together with what follows; line
numbers and offsets are counted within a block, and the sums of all blocks before it are carried in.
No task, row or window holds more than a block, or one line.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.sources.shared import written

BLOCK_BYTES = 64 << 10
#: Bytes that a block is read beyond its end: the rest of a code point, or a line feed.
_MORE = 4


def _continued(head: str) -> str:
    """How many continuation bytes (at most 3) the SQL of some bytes begins with."""
    return f"(length(regexp_extract(hex(substring({head}, 1, 3)), '^(?:[89AB][0-9A-F])*', 0)) div 2)"


def _block_text(raw: str, last: str, size: int) -> Column:
    """The text of a block. raw: its bytes and _MORE further ones; last: the byte before it (null for the first block)."""
    skip = f"(CASE WHEN {last} IS NULL THEN 0 ELSE {_continued(raw)} END)"
    end = f"({size} + {_continued(f'substring({raw}, {size + 1}, 3)')})"
    body = f"substring({raw}, {skip} + 1, {end} - {skip})"
    # A line feed after a carriage return belongs to the block that has the return.
    led = f"({last} <=> X'0D' AND substring({raw}, 1, 1) = X'0A')"
    parted = f"(substring({raw}, {size}, 1) = X'0D' AND substring({raw}, {size + 1}, 1) = X'0A')"
    return F.expr(f"concat(CASE WHEN {led} THEN substring({body}, 2) ELSE {body} END, CASE WHEN {parted} THEN X'0A' ELSE X'' END)").cast("string")


def text_blocks(texts: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """key, block (from 0), text of texts that are columns. Their bytes are cut by offset, so the cost of a text is its length."""
    n = f"greatest(cast(ceil(length(b) / {block_bytes}) as int), 1)"
    pieces = f"transform(array(cast(`{text}` as binary)), b -> transform(sequence(0, {n} - 1), k -> struct(k as block, CASE WHEN k > 0 THEN substring(b, k * {block_bytes}, 1) END as last, substring(b, k * {block_bytes} + 1, {block_bytes + _MORE}) as raw)))[0]"
    cut = texts.where(F.col(text).isNotNull()).select(key, F.explode(F.expr(pieces)).alias("x")).select(key, "x.*")
    return cut.select(key, "block", _block_text("raw", "last", block_bytes).alias("text"))


def read_blocks(spark: SparkSession, path: str, *, glob: str = "*", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """path, block, text of UTF-8 files: each task seeks to its blocks, so one large file is read by many. A byte order mark is left out.

    Files are listed by Spark, without their contents; blocks are read through an Arrow filesystem (file, hdfs, s3, gs, abfs).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "length")
    n = F.greatest(F.ceil(F.col("length") / block_bytes), F.lit(1))
    places = files.select("path", F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("block"))
    dealt = places.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "block")
    raw = dealt.mapInArrow(lambda it: _read(it, block_bytes), "path string, block int, last binary, raw binary")
    whole = raw.select("path", "block", _block_text("raw", "last", block_bytes).alias("text"))
    mark = F.lit("\ufeff")
    return whole.withColumn("text", F.when((F.col("block") == 0) & F.col("text").startswith(mark), F.substring("text", 2, 2147483647)).otherwise(F.col("text")))


def _read(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    from folioforge.sources.filesystems import opened

    for batch in batches:
        for path, block in zip(batch.column("path").to_pylist(), batch.column("block").to_pylist(), strict=True):
            system, place = opened(path)
            with system.open_input_file(place) as file:
                ahead = 1 if block else 0
                file.seek(block * size - ahead)
                raw = file.read(size + _MORE + ahead)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([block], pa.int32()), pa.array([raw[:1] if ahead else None], pa.binary()), pa.array([raw[ahead:]], pa.binary())], ["path", "block", "last", "raw"])


def pieces_of(blocks: DataFrame, key: str) -> DataFrame:
    """blocks: key, block, text. A table of key, block, i, line, chars, label, tail: each block's lines as far as they lie in it; tail: it has no end yet.

    It is written, as the counts of blocks are needed before any line is placed; those are read from its narrow columns.
    """
    each = blocks.select(key, "block", F.posexplode(tx.lines(F.col("text"))).alias("i", "line"))
    tail = ~F.right("line", F.lit(1)).rlike(rf"[{tx.LINE_ENDS}]")
    return written(each.select("*", F.length("line").cast("long").alias("chars"), tx.heading_label(F.col("line")).alias("label"), tail.alias("tail")), "lines")


def marked_lines_of(pieces: DataFrame, key: str) -> DataFrame:
    """pieces of pieces_of. Returns lines: key, block (where the line begins), line_no (from 0), line, start (in code points), label, any_heading, headings (so far), first_line (of the last heading, or 0).

    Only what a block leaves open at its ends is grouped across blocks; all other lines are numbered
    within their block, and the counts of lines, code points and headings before it are carried in.
    """
    tail = F.col("tail")
    heading = F.col("label").isNotNull()
    inner = heading & (F.col("i") > 0) & ~tail
    sizes = pieces.groupBy(key, "block").agg(
        F.sum("chars").alias("chars"), (F.max("i") + 1).alias("n_lines"), (~F.max("tail")).alias("ended"), F.max(heading & (F.col("i") == 0) & ~tail).alias("head"),
        F.sum(inner.cast("int")).alias("n_inner"), F.max(F.when(inner, F.col("i"))).alias("last_inner"),
    )
    before = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    placed = sizes.select(
        key, "block", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"), F.coalesce(F.sum(F.col("n_lines") - F.when(F.col("ended"), 0).otherwise(1)).over(before), F.lit(0)).cast("int").alias("lines_before"),
        F.coalesce(F.last("ended").over(before), F.lit(True)).alias("fresh"), "head", "n_inner", "last_inner",
    )
    kept_head = F.col("head") & F.col("fresh")
    placed = placed.withColumn("n_own", F.col("n_inner") + kept_head.cast("int")).withColumn("last_own", F.col("lines_before") + F.coalesce("last_inner", F.when(kept_head, 0))).drop("head", "n_inner", "last_inner")

    is_open = ((F.col("i") == 0) & ~F.col("fresh")) | tail
    ends = pieces.where((F.col("i") == 0) | tail).join(placed.select(key, "block", "chars_before", "lines_before", "fresh"), [key, "block"]).where(is_open)
    joined = ends.withColumn("line_no", F.col("lines_before") + F.col("i")).groupBy(key, "line_no").agg(F.min("block").alias("block"), tx.joined(F.col("line"), F.col("block")).alias("line"))
    joined = written(joined.select(key, "block", "line_no", "line", tx.heading_label(F.col("line")).alias("label")), "joined-lines")  # at most one a block

    heads = joined.where(heading).select(key, "block", F.col("line_no").alias("joined_no"))
    counted = placed.join(heads, [key, "block"], "left")
    every = Window.partitionBy(key)
    n_all, last_all = F.col("n_own") + F.col("joined_no").isNotNull().cast("int"), F.coalesce("joined_no", "last_own")
    carried = counted.select("*", F.coalesce(F.sum(n_all).over(before), F.lit(0)).alias("n_before"), F.max(last_all).over(before).alias("last_before"), (F.sum(n_all).over(every) > 0).alias("any_heading")).drop("joined_no")

    inside = Window.partitionBy(key, "block").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line_no = F.col("lines_before") + F.col("i")
    own_heading = heading & ~is_open
    own = pieces.join(carried, [key, "block"]).select(
        key, "block", line_no.alias("line_no"), "line", (F.col("chars_before") + F.sum("chars").over(inside) - F.col("chars")).alias("start"), "label", "any_heading",
        (F.col("n_before") + F.sum(own_heading.cast("int")).over(inside)).alias("headings"), F.coalesce(F.max(F.when(own_heading, line_no)).over(inside), "last_before", F.lit(0)).alias("first_line"), is_open.alias("open"), "tail",
    )
    starts = own.where("open and tail").groupBy(key, "line_no").agg(F.min("start").alias("start"))
    rest = joined.join(carried, [key, "block"]).join(starts, [key, "line_no"]).select(
        key, "block", "line_no", "line", "start", "label", "any_heading", (F.col("n_before") + F.col("n_own") + heading.cast("int")).alias("headings"),
        F.coalesce(F.when(heading, F.col("line_no")), "last_own", "last_before", F.lit(0)).alias("first_line"),
    )
    return own.where("not open").drop("open", "tail").unionByName(rest)


def scan_lines(blocks: DataFrame, key: str) -> DataFrame:
    """blocks: key, block, text. Returns key, block (where the line begins), line_no (from 0), line with its end, start (its offset in code points)."""
    return marked_lines_of(pieces_of(blocks, key), key).select(key, "block", "line_no", "line", "start")
