"""Files that arrive are ingested as a stream; each micro-batch appends to the record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioforge.operators.ingest import ingest

_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_ingest(spark: SparkSession, folder: str, target: str, checkpoint: str, *, once: bool = True) -> StreamingQuery:
    """Reads new files below a folder and writes projects, sources, chapters, units, rejected below target.

    A batch that is run again replaces its own part, so a restart neither loses nor doubles records.
    """

    def take(batch: DataFrame, number: int) -> None:
        files = batch.select(F.regexp_extract("path", r"([^/]*)\z", 1).alias("filename"), "content", F.lit(None).cast("string").alias("title"))
        got = ingest(files)
        for name in ("projects", "sources", "chapters", "units", "rejected"):
            getattr(got, name).write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")

    stream = spark.readStream.format("binaryFile").schema(_FILE).option("recursiveFileLookup", "true").load(folder)
    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
