"""Change messages into the raw zone."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shoplake.operators.parsing import to_raw
from shoplake.sinks.tables import append_batch
from shoplake.streaming.jobs import start_batches


def raw_ingest(
    messages: DataFrame, raw_path: str, checkpoint: str, ingested_at=None
) -> StreamingQuery:
    """Appends everything new in the stream to the raw table, then stops.

    Micro-batches are keyed by id, so one replayed after a failure replaces its
    first attempt; empty ones write nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            append_batch(batch, raw_path, batch_id, ["ingestion_date"])

    return start_batches(to_raw(messages, ingested_at), checkpoint, write)
