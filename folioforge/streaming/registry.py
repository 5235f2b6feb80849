"""Registries that grow with a stream: names get their ids when they are first seen, and keep them."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SCHEMA = "project_id string, id string, name string"


class Registry(StatefulProcessor):
    """State of a project: the names that have ids, and the last number given. A batch's new names are numbered by their smallest place, then by name."""

    def __init__(self, prefix: str):
        self.prefix = prefix

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.names = handle.getMapState("names", "name string", "number int")
        self.last = handle.getValueState("last", "number int")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        first: dict[str, int] = {}
        for part in rows:
            for name, place in part.groupby("name")["place"].min().items():
                if not self.names.containsKey((name,)):
                    first[name] = min(first.get(name, place), place)
        number = self.last.get()[0] if self.last.exists() else 0
        out = []
        for name in sorted(first, key=lambda n: (first[n], n)):
            number += 1
            self.names.updateValue((name,), (number,))
            out.append((key[0], f"{self.prefix}-{number:04d}", name))
        if out:
            self.last.update((number,))
        yield pd.DataFrame(out, columns=["project_id", "id", "name"])

    def close(self) -> None:
        pass


def stream_registry(seen: DataFrame, target: str, checkpoint: str, *, prefix: str = "CHAR", once: bool = True) -> StreamingQuery:
    """seen: a stream of project_id, name, place. Appends project_id, id, name below target, each name once, whatever batches and restarts there are."""
    spark = seen.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)  # the query keeps the settings that it starts with
    try:
        named = seen.where("name is not null").groupBy("project_id").transformWithStateInPandas(Registry(prefix), SCHEMA, "Append", "None")
        writer = named.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
