"""Starting micro-batch jobs."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shoplake.workspace import session_settings

# Keeps large dedup and aggregation state on local disk instead of the heap, and
# saves only its changes with each batch.
STATE_SETTINGS = {
    "spark__sql__streaming__stateStore__providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled": "true",
}


def start_batches(
    stream: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    once: bool = True,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Calls ``handle`` per micro-batch: over what is new now, or until stopped.

    ``state_partitions`` fixes the number of state partitions of a new
    checkpoint (default: the session's shuffle partitions).
    """
    writer = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
    )
    return _start(writer.trigger(availableNow=True) if once else writer, stream, state_partitions)


def start_parquet(
    stream: DataFrame,
    checkpoint: str,
    path: str,
    once: bool = True,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Appends the stream's rows to a Parquet folder exactly once."""
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return _start(writer.trigger(availableNow=True) if once else writer, stream, state_partitions)


def _start(writer, stream: DataFrame, state_partitions: int | None) -> StreamingQuery:
    settings = dict(STATE_SETTINGS)
    if state_partitions is not None:
        settings["spark__sql__shuffle__partitions"] = str(state_partitions)
    with session_settings(stream.sparkSession, **settings):
        return writer.start()
