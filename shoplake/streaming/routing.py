"""Validation and routing of deduplicated micro-batches."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from shoplake import params
from shoplake.operators.parsing import parse_events
from shoplake.operators.validation import invalid, valid
from shoplake.sinks.messages import MESSAGE, dead_letters, with_message, write_jdbc, write_kafka
from shoplake.sinks.tables import append_batch
from shoplake.streaming.dedup import deduplicated, untimed
from shoplake.streaming.jobs import start_batches

POSITION = ("partition", "offset")
VALIDATION_FAILED = "validation_failed"
SERVING_FAILED = "serving_write_failed"
ATTEMPTS = 3
REASON_CHARS = 300

# Writes the valid rows of a batch.
ServeValid = Callable[[DataFrame, int], None]
# Writes dead letters of a batch; the third argument is what went wrong.
ServeDead = Callable[[DataFrame, int, str], None]


def serve_files(path: str) -> ServeValid:
    return lambda rows, batch_id: append_batch(rows, path, batch_id)


def serve_jdbc(url: str, table: str, properties: dict[str, str]) -> ServeValid:
    """Appends to a database table. A replayed batch is appended again, so the table must
    tolerate copies (untested here: needs a database)."""
    return lambda rows, batch_id: write_jdbc(rows, url, table, properties)


def dead_letter_topic(servers: str, topic: str) -> ServeDead:
    """Sends dead letters to a Kafka topic (untested here: needs a broker)."""
    return lambda values, batch_id, kind: write_kafka(values, servers, topic)


def dead_letter_files(path: str) -> ServeDead:
    return lambda values, batch_id, kind: append_batch(values, f"{path}/kind={kind}", batch_id)


def incoming(messages: DataFrame, watermark: str = params.WATERMARK, **options) -> DataFrame:
    """Parsed stream, deduplicated where it has an event time; the rest goes on to be rejected.

    Each row carries the message it was read from, for the dead letters.
    """
    parsed = parse_events(with_message(messages), keep=(*POSITION, *MESSAGE))
    return deduplicated(parsed, watermark=watermark, **options).unionByName(untimed(parsed))


def short_reason(error: Exception) -> str:
    """The first line of an error, without the stack trace that follows in JVM errors."""
    lines = str(error).strip().splitlines()
    return (lines[0] if lines else type(error).__name__)[:REASON_CHARS]


def route_batch(
    batch: DataFrame, batch_id: int, serve: ServeValid, reject: ServeDead, attempts: int = ATTEMPTS
) -> None:
    """Rejected rows to the dead letters, valid ones to serving, without their messages.

    If serving fails ``attempts`` times, its rows become dead letters as well, with
    the error's first line as reason. Both outputs read one persisted frame, so the state is updated once.
    """
    events = batch.drop(*POSITION).persist()
    try:
        if events.isEmpty():
            return
        reject(dead_letters(invalid(events), batch_id, VALIDATION_FAILED), batch_id, VALIDATION_FAILED)
        good = valid(events)
        for attempt in range(1, attempts + 1):
            try:
                serve(good.drop(*MESSAGE), batch_id)
                break
            except Exception as error:
                if attempt == attempts:
                    reason = f"{SERVING_FAILED}: {short_reason(error)}"
                    reject(dead_letters(good, batch_id, reason), batch_id, SERVING_FAILED)
    finally:
        events.unpersist()


def route(
    messages: DataFrame,
    checkpoint: str,
    serve: ServeValid,
    reject: ServeDead,
    once: bool = True,
    state_partitions: int | None = None,
    attempts: int = ATTEMPTS,
) -> StreamingQuery:
    return start_batches(
        incoming(messages),
        checkpoint,
        lambda batch, batch_id: route_batch(batch, batch_id, serve, reject, attempts),
        once,
        state_partitions,
    )
