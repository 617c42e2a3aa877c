"""Rollups kept up to date by a stream of valid events."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shoplake import params
from shoplake.operators.parsing import parse_events
from shoplake.operators.rollups import ROLLUPS, merge_states, realtime_dashboard_states, visits
from shoplake.operators.validation import valid
from shoplake.sinks.tables import append_batch
from shoplake.streaming.dedup import deduplicated
from shoplake.streaming.jobs import start_batches, start_parquet


def append_states(
    events: DataFrame, batch_id: int, path: str, rollups: tuple[str, ...] = tuple(ROLLUPS)
) -> None:
    """Appends the batch's partial states of every rollup, keyed by batch id."""
    events.persist()
    try:
        if events.isEmpty():
            return
        for name in rollups:
            append_batch(ROLLUPS[name](events), f"{path}/{name}", batch_id)
    finally:
        events.unpersist()


def served(messages: DataFrame, watermark: str = params.WATERMARK) -> DataFrame:
    """What the serving table gets: each event once, if it is valid."""
    return valid(deduplicated(parse_events(messages), watermark=watermark))


def maintain(
    messages: DataFrame,
    checkpoint: str,
    path: str,
    rollups: tuple[str, ...] = tuple(ROLLUPS),
    once: bool = True,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keeps the rollups' states current with a stream of event messages.

    Events delivered again are counted once, as in the serving table.
    """
    return start_batches(
        served(messages),
        checkpoint,
        lambda batch, batch_id: append_states(batch, batch_id, path, rollups),
        once,
        state_partitions,
    )


def current(spark: SparkSession, path: str, rollup: str) -> DataFrame:
    """The rollup as of the batches written so far."""
    return merge_states(spark.read.parquet(f"{path}/{rollup}"), rollup)


def closed_windows(
    messages: DataFrame,
    checkpoint: str,
    path: str,
    watermark: str = params.WATERMARK,
    once: bool = True,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Writes each 15-minute window once, when the watermark has passed its end."""
    states = realtime_dashboard_states(served(messages, watermark))
    return start_parquet(states, checkpoint, path, once, state_partitions)


def closed_sessions(
    messages: DataFrame,
    checkpoint: str,
    path: str,
    gap: str = params.SESSION_GAP,
    watermark: str = params.WATERMARK,
    once: bool = True,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Writes each visit once, when the watermark has passed the gap after its last event."""
    return start_parquet(visits(served(messages, watermark), gap), checkpoint, path, once, state_partitions)
