"""Features, labels and weights of the purchase-intent classifier."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from shoplake import params
from shoplake.functions.expressions import decay, is_type, newest_event_second, type_weight

OTHER = "other"
LAG_BUCKET_SECONDS = 600


def with_previous_time(
    events: DataFrame,
    session: str = "user_session",
    bucket_seconds: int = LAG_BUCKET_SECONDS,
    ties: tuple[str, ...] = ("product_id", "event_type"),
) -> DataFrame:
    """Adds ``prev_event_time``, the time of the session's event before this one.

    A window over whole sessions would put a hot session (a crawler, or all
    rows without a session id) into one task. Instead the lag runs inside
    (session, time bucket) groups, and the first row of a group takes the
    latest time of the session's bucket before. That second step sees one row
    per session and bucket, and its join reuses the first step's partitioning.
    """
    keyed = events.withColumns({
        # Two non-null columns stand for the session, so that rows without one
        # form a session of their own and still join.
        "_session": F.coalesce(F.col(session).cast("string"), F.lit("")),
        "_missing": F.col(session).isNull(),
        "_bucket": F.floor(F.unix_timestamp("event_time") / bucket_seconds),
    })
    group = ["_session", "_missing", "_bucket"]
    inside = Window.partitionBy(*group).orderBy("event_time", *ties)
    across = Window.partitionBy("_session", "_missing").orderBy("_bucket")
    carried = (
        keyed.groupBy(*group)
        .agg(F.max("event_time").alias("_last"))
        .select(*group, F.lag("_last").over(across).alias("_carried"))
    )
    return (
        keyed.withColumn("_local", F.lag("event_time").over(inside))
        .join(carried, group, "left")
        .withColumn("prev_event_time", F.coalesce("_local", "_carried"))
        .drop(*group, "_local", "_carried")
    )


def session_features(events: DataFrame, **lag_options) -> DataFrame:
    """Adds hour, weekday (1 = Sunday) and seconds since the session's previous event (0 at first)."""
    gap = F.unix_timestamp("event_time") - F.unix_timestamp("prev_event_time")
    return with_previous_time(events, **lag_options).withColumns({
        "hour": F.hour("event_time"),
        "week_day": F.dayofweek("event_time"),
        "secs_since_last": F.coalesce(gap, F.lit(0)),
    })


def with_label_and_weight(
    events: DataFrame,
    newest_second=None,
    weights: Mapping[str, float] = params.CLASS_WEIGHTS,
    decay_rate: float = params.DECAY_PER_DAY,
    floor: float = params.MIN_SAMPLE_WEIGHT,
) -> DataFrame:
    """Adds the label (2 purchase, 1 cart, 0 other) and the decayed sample weight."""
    newest = newest_event_second(events) if newest_second is None else newest_second
    label = F.when(is_type("purchase"), 2.0).when(is_type("cart"), 1.0).otherwise(0.0)
    weight = F.greatest(type_weight(weights) * decay(newest, decay_rate), F.lit(floor))
    return events.withColumns({"label": label, "weight": weight})


def training_frame(events: DataFrame) -> DataFrame:
    """Every feature, label and weight column the classifier needs."""
    featured = session_features(events)
    return with_label_and_weight(featured, newest_event_second(events))


def label_distribution(frame: DataFrame) -> DataFrame:
    return frame.groupBy("label").agg(F.count(F.lit(1)).alias("record_count"))


def weight_stats(frame: DataFrame) -> DataFrame:
    return frame.agg(
        F.min("weight").alias("min_weight"),
        F.max("weight").alias("max_weight"),
        F.avg("weight").alias("avg_weight"),
    )


def cardinality(events: DataFrame, extra_bins: int = params.EXTRA_BINS) -> DataFrame:
    """Distinct brands and categories (null counts as a value) and the bins a tree needs."""
    def values(column: str):
        missing = F.max(F.when(F.col(column).isNull(), 1).otherwise(0))
        return F.count_distinct(column) + missing

    return events.agg(
        values("brand").alias("brand_count"), values("category_code").alias("category_count")
    ).withColumn("max_bins", F.greatest("brand_count", "category_count") + extra_bins)


def _most_frequent(events: DataFrame, column: str, n: int) -> DataFrame:
    counts = events.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("_count")
    )
    return counts.orderBy(F.desc("_count"), F.asc(column)).limit(n).select(column)


def bucket_top_n(
    events: DataFrame, column: str, bucketed: str, n: int = params.TOP_N_CATEGORIES
) -> DataFrame:
    """Adds ``bucketed``: the value if it is among the n most frequent, else ``other``.

    The list of frequent values has at most n rows and is broadcast.
    """
    top = _most_frequent(events, column, n).withColumn(bucketed, F.col(column))
    joined = events.join(F.broadcast(top), column, "left")
    return joined.withColumn(bucketed, F.coalesce(bucketed, F.lit(OTHER)))


def bucket_categories(events: DataFrame, n: int = params.TOP_N_CATEGORIES) -> DataFrame:
    branded = bucket_top_n(events, "brand", "brand_bucketed", n)
    return bucket_top_n(branded, "category_code", "category_bucketed", n)
