"""Table and CSV readers."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake import params, schemas


def scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_day(
    spark: SparkSession, path: str, day: date | str | None = None, column: str = "ingestion_date"
) -> DataFrame:
    """Rows of one partition day (today by default); other partitions are not read."""
    wanted = F.current_date() if day is None else F.lit(str(day)).cast("date")
    return scan(spark, path).where(F.col(column) == wanted)


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """CSV events with a header line, every field as text.

    An empty field is null and a quoted empty one is empty text, for which the
    null marker has to differ from the empty text.
    """
    return spark.read.csv(
        path, schema=schemas.EVENT_TEXT, header=True, enforceSchema=False, nullValue="\u0000"
    )


def csv_events(spark: SparkSession, path: str) -> DataFrame:
    """CSV events, typed; unreadable fields become null."""
    text = csv_rows(spark, path)
    clock = F.regexp_replace("event_time", " UTC", "")
    return text.withColumns({
        "event_time": F.try_to_timestamp(
            F.concat(clock, F.lit(f" {params.TIMEZONE}")), F.lit(f"{params.TIMESTAMP_PATTERN} VV")
        ),
        "product_id": F.col("product_id").try_cast("bigint"),
        "category_id": F.col("category_id").try_cast("bigint"),
        "price": F.col("price").try_cast("decimal(10,2)"),
        "user_id": F.col("user_id").try_cast("bigint"),
    })
