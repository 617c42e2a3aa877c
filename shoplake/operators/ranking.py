"""Ranking quality of recommendations, as plain DataFrame aggregates.

Ground truth stays one row per (user, product): a user's relevant products are
never gathered into one list. Only the recommendations, k per user, are.
"""

import math

from pyspark.sql import DataFrame, Window, functions as F

from shoplake import params


def ground_truth(test_pairs: DataFrame) -> DataFrame:
    """Relevant products per user, one row each, with the user's number of them."""
    labels = test_pairs.select("user_id", "product_id").distinct()
    sizes = labels.groupBy("user_id").agg(F.count(F.lit(1)).alias("label_count"))
    return labels.join(sizes, "user_id")


def judged(recs: DataFrame, test_pairs: DataFrame) -> DataFrame:
    """Recommendations of users with ground truth, each marked relevant (1) or not (0)."""
    labels = test_pairs.select("user_id", "product_id").distinct()
    sizes = labels.groupBy("user_id").agg(F.count(F.lit(1)).alias("label_count"))
    marked = recs.select("user_id", "product_id", "rank").join(
        labels.withColumn("relevant", F.lit(1)), ["user_id", "product_id"], "left"
    )
    return marked.join(sizes, "user_id").withColumn("relevant", F.coalesce("relevant", F.lit(0)))


def ranking_frame(recs: DataFrame, test_pairs: DataFrame) -> DataFrame:
    """Per user: predicted products best first, their relevance, and the ground-truth size."""
    entry = F.struct("rank", "product_id", "relevant")
    return (
        judged(recs, test_pairs)
        .groupBy("user_id", "label_count")
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select(
            "user_id",
            F.col("entries.product_id").alias("prediction"),
            F.col("entries.relevant").alias("relevant"),
            "label_count",
        )
    )


def _per_user(recs: DataFrame, test_pairs: DataFrame, k: int) -> DataFrame:
    so_far = Window.partitionBy("user_id").orderBy("rank")
    hit = F.col("relevant")
    in_k = F.when(F.col("rank") <= k, hit).otherwise(0)
    gains = [1.0 / math.log(place + 1) for place in range(1, k + 1)]
    ideal = F.element_at(
        F.array(*[F.lit(sum(gains[: n + 1])) for n in range(k)]),
        F.least(F.col("label_count"), F.lit(k)).cast("int"),
    )
    return (
        judged(recs, test_pairs)
        .withColumn("hits_so_far", F.sum(hit).over(so_far))
        .groupBy("user_id", "label_count")
        .agg(
            F.sum(in_k).alias("hits"),
            F.sum(in_k / F.log(F.col("rank") + 1)).alias("gain"),
            F.sum(hit * F.col("hits_so_far") / F.col("rank")).alias("precision_sum"),
        )
        .select(
            "hits",
            (F.col("hits") / k).alias("precision"),
            (F.col("hits") / F.col("label_count")).alias("recall"),
            (F.col("gain") / ideal).alias("ndcg"),
            (F.col("precision_sum") / F.col("label_count")).alias("average_precision"),
        )
    )


def ranking_metrics(recs: DataFrame, test_pairs: DataFrame, k: int = params.TOP_K) -> DataFrame:
    """Mean precision@k, recall@k, NDCG@k and average precision over users with both lists."""
    return _per_user(recs, test_pairs, k).agg(
        F.count(F.lit(1)).alias("users"),
        F.avg("precision").alias("precision_at_k"),
        F.avg("recall").alias("recall_at_k"),
        F.avg("ndcg").alias("ndcg_at_k"),
        F.avg("average_precision").alias("mean_average_precision"),
    )


def hit_rate(recs: DataFrame, test_pairs: DataFrame) -> DataFrame:
    """Share of evaluated users with at least one relevant recommendation."""
    per_user = judged(recs, test_pairs).groupBy("user_id").agg(F.max("relevant").alias("hit"))
    return per_user.agg(
        F.sum("hit").alias("users_with_hits"),
        F.count(F.lit(1)).alias("total_users"),
        F.avg("hit").alias("hit_rate"),
    )


def item_coverage(recs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Share of the catalog's products that are recommended to someone."""
    recommended = recs.agg(F.count_distinct("product_id")).scalar()
    return catalog.agg(F.count_distinct("product_id").alias("total_items")).select(
        recommended.alias("recommended_items"),
        "total_items",
        (recommended / F.col("total_items")).alias("item_coverage"),
    )
