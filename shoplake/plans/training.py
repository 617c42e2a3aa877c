"""Training and evaluation of the recommender and the purchase-intent classifier."""

import time
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, functions as F

from shoplake import params
from shoplake.operators import class_metrics, encoding, factors, features, interactions, popularity
from shoplake.operators import ranking, recommendations
from shoplake.sinks.models import save_metadata, save_model
from shoplake.sinks.tables import write_table
from shoplake.workspace import use_checkpoints


# --- recommender -----------------------------------------------------------

@dataclass
class Ratings:
    """Indexed ratings with the maps back to the original ids."""

    rows: DataFrame
    users: DataFrame
    products: DataFrame


def ratings(events: DataFrame, folder: str) -> Ratings:
    """(userId, productId, rating) of every user-product pair, kept as tables in ``folder``.

    The scores are stored first: ids and ratings then come from one row per
    pair instead of from the events.
    """
    spark = events.sparkSession

    def stored(name: str, rows: DataFrame) -> DataFrame:
        write_table(rows, f"{folder}/{name}", "overwrite")
        return spark.read.parquet(f"{folder}/{name}")

    scores = stored("scores", interactions.interaction_scores(events))
    users = stored("users", interactions.id_map(scores, "user_id", "user_idx"))
    products = stored("products", interactions.id_map(scores, "product_id", "product_idx"))
    rows = scores.join(users, "user_id").join(products, "product_id").select(
        F.col("user_idx").cast("int").alias("userId"),
        F.col("product_idx").cast("int").alias("productId"),
        F.col("log_score").cast("float").alias("rating"),
    )
    return Ratings(stored("ratings", rows), users, products)


def fit_recommender(
    training: DataFrame,
    rank: int = params.ALS_RANK,
    iterations: int = params.ALS_ITERATIONS,
    regularization: float = params.ALS_REGULARIZATION,
    alpha: float = params.ALS_ALPHA,
    blocks: int | None = None,
) -> ALSModel:
    """Implicit-feedback ALS that cuts its lineage at the checkpoint folder after every iteration.

    An iteration sends each user's factors to nearly every block of products. Those shuffle
    files stay on disk until the factors made from them are checkpointed.

    Only ratings above 0 count: a rating of 0 tells an implicit fit nothing, and users or
    products with no other have no unique factors. Users left out get popular products
    (``recommendations.with_fallback``).
    """
    use_checkpoints(training.sparkSession)
    if blocks is None:
        blocks = training.sparkSession.sparkContext.defaultParallelism * params.ALS_BLOCK_FACTOR
    return ALS(
        userCol="userId", itemCol="productId", ratingCol="rating",
        rank=rank, maxIter=iterations, regParam=regularization, alpha=alpha,
        numUserBlocks=blocks, numItemBlocks=blocks,
        implicitPrefs=True, coldStartStrategy="drop", seed=params.SEED,
        checkpointInterval=params.ALS_CHECKPOINT_EVERY,
    ).fit(training.where("rating > 0"))


def save_factors(model: ALSModel, folder: str) -> tuple[DataFrame, DataFrame]:
    """The model's user and product factors as tables (id, features) below ``folder``."""
    spark = model.userFactors.sparkSession
    for name, rows in (("user_factors", model.userFactors), ("product_factors", model.itemFactors)):
        write_table(rows, f"{folder}/{name}", "overwrite")
    return spark.read.parquet(f"{folder}/user_factors"), spark.read.parquet(f"{folder}/product_factors")


def recommend_exactly(users: DataFrame, products: DataFrame, indexed: Ratings, k: int = params.TOP_K) -> DataFrame:
    """Top k products of every user from stored factors, with original ids and settled ties."""
    found = factors.top_k(users, products, k)
    return (
        found.join(indexed.users, F.col("user") == F.col("user_idx"))
        .join(indexed.products, F.col("product") == F.col("product_idx"))
        .select("user_id", "product_id", "score", "rank")
    )


def recommend(model: ALSModel, indexed: Ratings, k: int = params.TOP_K) -> DataFrame:
    """Top k products of every user with original ids."""
    return recommendations.flatten(model.recommendForAllUsers(k), indexed.users, indexed.products)


def with_original_ids(rows: DataFrame, indexed: Ratings) -> DataFrame:
    """(user_id, product_id) of indexed ratings."""
    return (
        rows.join(indexed.users, F.col("userId") == F.col("user_idx"))
        .join(indexed.products, F.col("productId") == F.col("product_idx"))
        .select("user_id", "product_id")
    )


def train_recommender(events: DataFrame, folder: str, k: int = params.TOP_K, **model_options) -> DataFrame:
    """Fits, evaluates and saves the recommender, its lists and its metadata; returns the metrics."""
    spark = events.sparkSession
    indexed = ratings(events, folder)
    training, test = interactions.random_split(indexed.rows)
    model = fit_recommender(training, **model_options)
    save_model(model, f"{folder}/model")

    write_table(
        recommend(model, indexed, k), f"{folder}/recommendations", "overwrite", cluster_by=["user_id"]
    )
    recs = spark.read.parquet(f"{folder}/recommendations")
    truth = with_original_ids(test, indexed)
    metrics = ranking.ranking_metrics(recs, truth, k).first().asDict()
    metrics |= ranking.hit_rate(recs, truth).first().asDict()
    metrics |= ranking.item_coverage(recs, indexed.products).first().asDict()

    write_table(popularity.popular_items(events), f"{folder}/popular_items", "overwrite")
    write_table(
        popularity.popular_by_category(events), f"{folder}/popular_by_category", "overwrite",
        ["category_code"],
    )
    options = {
        "iterations": params.ALS_ITERATIONS,
        "regularization": params.ALS_REGULARIZATION, "alpha": params.ALS_ALPHA, **model_options,
        "rank": model.rank,
    }
    described = {
        "model_type": "ALS", "num_users": indexed.users.count(),
        "num_products": indexed.products.count(), **options, **metrics,
    }
    save_metadata(spark, described, f"{folder}/metadata")
    return spark.read.parquet(f"{folder}/metadata")


# --- classifier ------------------------------------------------------------

ENCODED = {"category_code": "category_idx", "brand": "brand_idx"}


def classifier_pipeline(
    category: str | None,
    brand: str | None,
    max_bins: int,
    trees: int = params.RF_TREES,
    depth: int = params.RF_DEPTH,
    min_instances: int = params.RF_MIN_INSTANCES,
    complete: Collection[str] = (),
) -> Pipeline:
    """Indexers, assembler and forest; None for a column whose index the frame already holds.

    Columns named ``complete`` get no number for missing values, see ``fit_classifier``.
    """
    inputs = ["category_idx", "brand_idx", "price", "hour", "week_day", "secs_since_last"]
    indexed = [(c, i) for c, i in ((category, "category_idx"), (brand, "brand_idx")) if c is not None]
    return Pipeline(stages=[
        *[StringIndexer(inputCol=c, outputCol=i, handleInvalid="error" if c in complete else "keep") for c, i in indexed],
        VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"),
        RandomForestClassifier(
            labelCol="label", featuresCol="features", weightCol="weight",
            predictionCol="prediction", rawPredictionCol="raw_prediction",
            probabilityCol="probability", numTrees=trees, maxDepth=depth,
            minInstancesPerNode=min_instances, maxBins=max_bins,
            subsamplingRate=params.RF_SUBSAMPLING,
            featureSubsetStrategy=params.RF_FEATURE_STRATEGY, seed=params.SEED,
        ),
    ])


def fit_classifier(
    training: DataFrame,
    top_n: int | None = params.TOP_N_CATEGORIES,
    max_bins: int | None = None,
    **forest_options,
) -> PipelineModel:
    """Weighted random forest over the ``top_n`` most frequent categories and brands.

    With ``top_n`` the frame needs the columns of ``features.bucket_categories``. None
    takes all values: with ``max_bins`` as they are, which gives each value a bin
    (``features.cardinality`` counts them); without, by the numbers of
    ``encoding.encode_all(frame, ENCODED, ...)``, which need no bin for each value.

    The forest tries every subset of a column of few values, so a number that no training
    row has doubles its work and adds no split of the rows: columns without nulls are
    fitted without the number that unseen values get when scoring.
    """
    if top_n is None and max_bins is None:
        return classifier_pipeline(None, None, params.RF_MAX_BINS, **forest_options).fit(training)
    if top_n is not None:
        columns = ("category_bucketed", "brand_bucketed")
        max_bins = max(params.RF_MAX_BINS, top_n + params.EXTRA_BINS)
    else:
        columns = ("category_code", "brand")
    missing = training.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    complete = [c for c in columns if not missing[c]]
    model = classifier_pipeline(*columns, max_bins, complete=complete, **forest_options).fit(training)
    for indexer in model.stages[:len(columns)]:
        indexer.setHandleInvalid("keep")
    return model


def score_purchases(predictions: DataFrame) -> DataFrame:
    """Adds the class probabilities as an array and the purchase probability."""
    spread = predictions.withColumn("probabilities", vector_to_array("probability"))
    return spread.withColumn(
        "prob_purchase", F.col("probabilities")[class_metrics.PURCHASE_CLASS]
    )


def train_classifier(
    events: DataFrame,
    folder: str,
    top_n: int | None = None,
    max_bins: int | None = None,
    **forest_options,
) -> DataFrame:
    """Fits, evaluates and saves the classifier and its metadata; returns the metadata.

    By default all categories and brands count, by their order among the training rows
    (tables in ``folder``/encoding, which scoring joins again); see ``fit_classifier``.
    """
    spark = events.sparkSession
    frame = features.training_frame(events)
    if top_n is not None:
        frame = features.bucket_categories(frame, top_n)
    write_table(frame, f"{folder}/frame", "overwrite")
    stored = spark.read.parquet(f"{folder}/frame")

    training, test = interactions.random_split(stored)
    started = time.monotonic()
    if top_n is None and max_bins is None:
        orders = encoding.fit_orders(training, ENCODED, f"{folder}/encoding")
        write_table(encoding.encode_all(training, ENCODED, orders), f"{folder}/training", "overwrite")
        training = spark.read.parquet(f"{folder}/training")
        test = encoding.encode_all(test, ENCODED, orders)
    model = fit_classifier(training, top_n, max_bins, **forest_options)
    seconds = time.monotonic() - started
    save_model(model, f"{folder}/model")

    write_table(
        score_purchases(model.transform(test)).select(
            *[c for c in ("event_id",) if c in stored.columns], "label", "prediction", "probabilities", "prob_purchase"
        ),
        f"{folder}/predictions", "overwrite",
    )
    predictions = spark.read.parquet(f"{folder}/predictions")
    metrics = class_metrics.multiclass_metrics(predictions).first().asDict()
    ties = tuple(c for c in ("event_id",) if c in predictions.columns)
    metrics |= class_metrics.precision_at_k(predictions, ties).first().asDict()
    metrics |= class_metrics.log_loss(predictions).first().asDict()
    forest = model.stages[-1]
    described = {
        "model_type": "RandomForestClassifier", "total_records": stored.count(),
        "training_time_secs": round(seconds, 2),
        "num_trees": forest.getNumTrees, "max_depth": forest.getMaxDepth(),
        "max_bins": forest.getMaxBins(), "subsampling_rate": forest.getSubsamplingRate(),
        "feature_subset_strategy": forest.getFeatureSubsetStrategy(), **metrics,
    }
    save_metadata(spark, described, f"{folder}/metadata")
    return spark.read.parquet(f"{folder}/metadata")
