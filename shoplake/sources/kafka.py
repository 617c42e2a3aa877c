"""Message streams: a Kafka topic, or a folder of Kafka-shaped rows."""

from pyspark.sql import DataFrame, SparkSession

from shoplake import params, schemas


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets: int = params.MAX_OFFSETS_PER_TRIGGER,
) -> DataFrame:
    """Topic subscription. Needs Spark's Kafka connector on the class path (untested here)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
    )


def file_stream(
    spark: SparkSession, folder: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of Kafka-shaped rows as a stream with the same columns."""
    reader = spark.readStream.schema(schemas.KAFKA_ROW)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)
