"""Dead letters back to the messages they came from."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shoplake.sinks.messages import letter_messages
from shoplake.sinks.tables import append_batch
from shoplake.streaming.jobs import start_batches
from shoplake.streaming.routing import SERVING_FAILED, VALIDATION_FAILED

LETTERS = "value string, kind string, stream string, batch_id bigint"

# Sends the messages of one batch.
Send = Callable[[DataFrame, int], None]


def send_files(path: str) -> Send:
    return lambda rows, batch_id: append_batch(rows, path, batch_id)


def replay(
    spark: SparkSession,
    letters: str,
    checkpoint: str,
    send: Send,
    kinds: tuple[str, ...] = (VALIDATION_FAILED, SERVING_FAILED),
    mend: Callable[[DataFrame], DataFrame] | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Sends the messages of all dead letters in files that no earlier run sent, as they came or mended.

    ``letters`` is the folder of ``routing.dead_letter_files``. The checkpoint knows the files
    already read, so a run sends each letter once; a batch repeated after a failure replaces
    its first attempt in ``send_files``. Letters of other ``kinds`` are passed over for good.
    A message that fails again comes back as a new letter.
    """
    found = spark.readStream.schema(LETTERS).parquet(letters)
    messages = letter_messages(found.where(found["kind"].isin(*kinds)))
    return start_batches(mend(messages) if mend else messages, checkpoint, send, once)
