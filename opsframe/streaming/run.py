"""Starting streaming queries with sinks that survive a restart."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opsframe.streaming.operators import POLL_INTERVAL

BATCH = "batch"
# Fixed value: the class of the store.
KEYED_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def trigger(available_now: bool) -> dict:
    """All there is, or one batch per poll interval."""
    return {"availableNow": True} if available_now else {"processingTime": POLL_INTERVAL}


def use_keyed_state(spark: SparkSession) -> None:
    """Keeps the state of queries started from now on in RocksDB, which timers and keyed state need.

    A query that goes on from a checkpoint keeps the store it was started with.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", KEYED_STORE)


def read_points(spark: SparkSession, directory: str, schema: str, pattern: str | None = None, **options: str) -> DataFrame:
    """Stream over the Parquet files that appear in a directory."""
    reader = spark.readStream.schema(schema).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(directory)


def append_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    by: Sequence[str] = (),
    file_format: str = "parquet",
    available_now: bool = False,
    **options: str,
) -> StreamingQuery:
    """Append mode into files, exactly once; ``by`` makes one folder per value."""
    writer = stream.writeStream.outputMode("append").format(file_format).options(**options)
    if by:
        writer = writer.partitionBy(*by)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger(available_now)).start(path)


def update_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    per_batch: Callable[[DataFrame], DataFrame] | None = None,
    mode: str = "update",
    available_now: bool = False,
) -> StreamingQuery:
    """Writes every micro-batch to its own folder; a batch that is run again replaces its folder."""

    def write(batch: DataFrame, number: int) -> None:
        rows = per_batch(batch) if per_batch else batch
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    writer = stream.writeStream.outputMode(mode).foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger(available_now)).start()


def latest(batches: DataFrame, *keys: str) -> DataFrame:
    """The newest row per key of what ``update_batches`` wrote."""
    values = [c for c in batches.columns if c not in (*keys, BATCH)]
    return batches.groupBy(*keys).agg(*[F.max_by(c, BATCH).alias(c) for c in values])
