"""User-product interaction scores, id maps and splits for the recommender."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from shoplake import params
from shoplake.functions.expressions import (
    decay, is_type, newest_event_second, stable_hash, type_weight,
)


def interaction_scores(
    events: DataFrame,
    view_weight: float = params.ALS_VIEW_WEIGHT,
    action_weights: Mapping[str, float] = params.ALS_ACTION_WEIGHTS,
    view_cap: float = params.ALS_VIEW_CAP,
    decay_rate: float = params.DECAY_PER_DAY,
) -> DataFrame:
    """Decayed score of each user-product pair: capped views plus non-negative actions."""
    faded = events.withColumn("fade", decay(newest_event_second(events), decay_rate))
    views = F.sum(F.when(is_type("view"), F.lit(view_weight) * F.col("fade")).otherwise(0.0))
    actions = F.sum(type_weight(action_weights) * F.col("fade"))
    return (
        faded.groupBy("user_id", "product_id")
        .agg(
            F.least(views, F.lit(float(view_cap))).alias("view_score"),
            F.greatest(actions, F.lit(0.0)).alias("action_score"),
        )
        .withColumn("total_score", F.col("view_score") + F.col("action_score"))
        .withColumn("log_score", F.log1p("total_score"))
    )


def id_map(rows: DataFrame, column: str, index: str, hex_digits: int = 3) -> DataFrame:
    """Dense 0-based index of the distinct non-null values of ``column``.

    Values are spread over ``16 ** hex_digits`` hash buckets, numbered inside
    each bucket and shifted by the sizes of the buckets before. Only the bucket
    sizes (at most ``16 ** hex_digits`` rows) are ordered globally and
    broadcast, so the values themselves stay distributed.
    """
    values = rows.select(column).where(F.col(column).isNotNull()).distinct()
    bucket = F.substring(F.md5(F.col(column).cast("string")), 1, hex_digits)
    # The join below implies this filter; stating it lets both uses share one shuffle.
    bucketed = values.withColumn("_bucket", bucket).where(F.col("_bucket").isNotNull())
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(column))
    return (
        bucketed.withColumn("_place", inside - 1)
        .join(F.broadcast(starts), "_bucket")
        .select(column, (F.col("_start") + F.col("_place")).alias(index))
    )


def hash_split(
    rows: DataFrame, keys: tuple[str, ...], train_share: float = params.TRAIN_SHARE
) -> DataFrame:
    """Marks rows ``is_train`` by a hash of their keys.

    The same row always lands on the same side, whatever the partitioning.
    """
    limit = round(train_share * 10_000)
    return rows.withColumn("is_train", stable_hash(*keys) % 10_000 < limit)


def random_split(
    rows: DataFrame, train_share: float = params.TRAIN_SHARE, seed: int = params.SEED
) -> tuple[DataFrame, DataFrame]:
    train, test = rows.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, test
