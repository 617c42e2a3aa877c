"""Popular products, overall and per category."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from shoplake import params
from shoplake.functions.expressions import is_type, type_weight


def popular_items(
    events: DataFrame,
    top_k: int = params.POPULAR_TOP_K,
    weights: Mapping[str, float] = params.POPULAR_WEIGHTS,
) -> DataFrame:
    """Top products by weighted events; equal scores rank by product id.

    The unpartitioned rank runs after the limit, over at most ``top_k`` rows.
    """
    best_first = (F.desc("popularity_score"), F.asc("product_id"))
    top = (
        events.groupBy("product_id")
        .agg(
            F.sum(type_weight(weights)).alias("popularity_score"),
            F.count(F.lit(1)).alias("total_interactions"),
            F.count_distinct("user_id").alias("unique_users"),
            F.count_if(is_type("purchase")).alias("purchase_count"),
        )
        .orderBy(*best_first)
        .limit(top_k)
    )
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*best_first)))


def popular_by_category(
    events: DataFrame, per_category: int = params.POPULAR_PER_CATEGORY
) -> DataFrame:
    """Top products of each known category; equal scores rank by product id."""
    known = F.col("category_code").isNotNull() & (F.col("category_code") != params.UNKNOWN)
    ranking = Window.partitionBy("category_code").orderBy(
        F.desc("popularity_score"), F.asc("product_id")
    )
    return (
        events.where(known)
        .groupBy("category_code", "product_id")
        .agg(
            F.count(F.lit(1)).alias("interaction_count"),
            F.count_distinct("user_id").alias("unique_users"),
            F.count_if(is_type("purchase")).alias("purchase_count"),
        )
        .withColumn("popularity_score", F.col("purchase_count") * 3 + F.col("interaction_count"))
        .withColumn("category_rank", F.row_number().over(ranking))
        .where(F.col("category_rank") <= per_category)
    )


def popular_lookup(popular: DataFrame, limit: int = params.TOP_K) -> DataFrame:
    return popular.orderBy("rank").limit(limit)


def popular_in_category(
    by_category: DataFrame, category_code: str, limit: int = params.TOP_K
) -> DataFrame:
    wanted = by_category.where(F.col("category_code") == category_code)
    return wanted.orderBy("category_rank").limit(limit)
