"""Aggregates that a stream keeps as disk-backed state, and their value read back out of the state store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Settings of the state store while the stream runs (RocksDB, memory bounded over all stores of an executor).
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def keyed_state(source: DataFrame, keys: Sequence[str], aggs: dict[str, Column], checkpoint: str, on_update=None) -> DataFrame:
    """``keys`` and aggregates over all that ``source`` has told so far, kept by a streaming aggregation.

    No table is rewritten: a micro-batch changes only the state of its own keys, and the
    checkpoint makes it exactly once. A later call goes on from there. Each of ``aggs`` must
    keep one value of state (sum, count, min, max). ``on_update(rows, n)`` is given the keys that
    micro-batch n changed, with their new values.
    """
    spark = source.sparkSession
    before = {k: spark.conf.get(k, None) for k in _STORE}
    try:
        for k, v in _STORE.items():
            spark.conf.set(k, v)
        told = source.groupBy(*keys).agg(*[v.alias(c) for c, v in aggs.items()])
        writer = told.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
        run = (writer.foreachBatch(on_update) if on_update else writer.format("noop")).start()
        run.awaitTermination()
        return state_of(told, keys, [*aggs], checkpoint)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_of(told: DataFrame, keys: Sequence[str], aggs: Sequence[str], checkpoint: str) -> DataFrame:
    """The last committed state of such a stream as a table."""
    held = told.sparkSession.read.format("statestore").load(checkpoint)
    buffers = held.schema["value"].dataType.names
    names = held.schema["key"].dataType.names
    return held.select(*[F.col("key").getField(n).alias(k) for n, k in zip(names, keys, strict=True)], *[F.col("value").getField(b).cast(told.schema[c].dataType).alias(c) for b, c in zip(buffers, aggs, strict=True)])
