"""Recommender and classifier queries.

Metrics run on reproducible recommendations, predictions and scores, so SQL can
repeat them; trained models are checked by row shape only.
"""

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shoplake import params
from shoplake.functions.expressions import stable_hash
from shoplake.operators import class_metrics, encoding, factors, features, interactions, popularity
from shoplake.operators import ranking, recommendations
from shoplake.plans import training
from shoplake.registry.base import EVENT_SQL, query, valid_events, valid_orders
from shoplake.sinks import models
from shoplake.sinks.tables import write_table
from shoplake.sources.adapter import table
from shoplake.workspace import new_folder

TOP_K = params.TOP_K
# Few enough that "other" occurs in the smallest tables.
TOP_N = 3


def scores_sql(source: str) -> str:
    return f"""
SELECT user_id, product_id, view_score, action_score, ln(1 + view_score + action_score) AS log_score FROM (
  SELECT user_id, product_id,
    least(sum(CASE WHEN event_type = 'view' THEN fade ELSE 0 END), 50.0) AS view_score,
    greatest(sum(fade * CASE event_type WHEN 'cart' THEN 10.0 WHEN 'purchase' THEN 100.0
      WHEN 'remove_from_cart' THEN -10.0 ELSE 0.0 END), 0.0) AS action_score
  FROM (SELECT *, exp(CAST(-0.02 AS DOUBLE) * ((SELECT max(epoch_us(event_time) // 1000000) FROM {source})
      - epoch_us(event_time) // 1000000) / 86400.0) AS fade FROM {source})
  GROUP BY user_id, product_id)"""


SCORES_SQL = scores_sql("good")

SCORE_COLUMNS = """user_id, product_id, round(view_score, 6) AS view_score,
  round(action_score, 6) AS action_score, round(view_score + action_score, 6) AS total_score,
  round(log_score, 6) AS log_score"""

RECS_SQL = f"""
SELECT user_id, product_id, round(log_score, 6) AS score,
  row_number() OVER (PARTITION BY user_id ORDER BY round(log_score, 6) DESC, product_id) AS rank
FROM ({SCORES_SQL}) QUALIFY rank <= {TOP_K}"""

TRAIN_SQL = "CAST('0x' || substr(md5(concat_ws('|', user_id, product_id)), 1, 8) AS BIGINT) % 10000 < 8000"

TEST_SQL = f"SELECT user_id, product_id FROM ({SCORES_SQL}) WHERE NOT ({TRAIN_SQL})"

JUDGED_SQL = f"""
SELECT r.user_id, r.product_id, r.rank, CASE WHEN t.product_id IS NULL THEN 0 ELSE 1 END AS relevant,
  s.label_count
FROM ({RECS_SQL}) r
JOIN (SELECT user_id, count(*) AS label_count FROM ({TEST_SQL}) GROUP BY user_id) s ON r.user_id = s.user_id
LEFT JOIN ({TEST_SQL}) t ON r.user_id = t.user_id AND r.product_id = t.product_id"""


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    return interactions.interaction_scores(valid_events(spark, folder))


def _recs(spark: SparkSession, folder: str) -> DataFrame:
    """The k best products per user by their score, rounded so that order is reproducible."""
    rounded = _scores(spark, folder).withColumn("log_score", F.round("log_score", 6))
    return recommendations.top_k_per_user(rounded, "log_score")


def _test_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs = interactions.hash_split(_scores(spark, folder), ("user_id", "product_id"))
    return pairs.where(~F.col("is_train")).select("user_id", "product_id")


# --- interactions ----------------------------------------------------------

@query("interaction_scores", f"SELECT {SCORE_COLUMNS} FROM ({SCORES_SQL})")
def interaction_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder)


@query("interaction_scores_orders", f"SELECT {SCORE_COLUMNS} FROM ({scores_sql('good_orders')})")
def interaction_scores_orders(spark: SparkSession, folder: str) -> DataFrame:
    return interactions.interaction_scores(valid_orders(spark, folder))


@query("id_map", """
SELECT o_custkey AS user_id, row_number() OVER (
  ORDER BY substr(md5(CAST(o_custkey AS VARCHAR)), 1, 3), o_custkey) - 1 AS user_idx
FROM (SELECT DISTINCT o_custkey FROM orders)""")
def id_map(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "orders").withColumnRenamed("o_custkey", "user_id")
    return interactions.id_map(users, "user_id", "user_idx")


@query("train_test_split", f"SELECT user_id, product_id, {TRAIN_SQL} AS is_train FROM ({SCORES_SQL})")
def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    pairs = interactions.hash_split(_scores(spark, folder), ("user_id", "product_id"))
    return pairs.select("user_id", "product_id", "is_train")


@query("train_test_split_random")
def train_test_split_random(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "split")
    write_table(valid_events(spark, folder), path, "overwrite")  # both sides see one order of rows
    train, test = interactions.random_split(spark.read.parquet(path))
    sides = [rows.select("event_id", F.lit(name).alias("side")) for name, rows in (("train", train), ("test", test))]
    return sides[0].unionByName(sides[1])


@query("train_test_split_random_cover", """
SELECT event_id, 1 AS sides, abs((SELECT count(*) FROM good) - count(*) OVER ()) AS lost FROM good""")
def train_test_split_random_cover(spark: SparkSession, folder: str) -> DataFrame:
    """The random split holds every row on one side."""
    split = train_test_split_random(spark, folder)
    return split.groupBy("event_id").agg(F.count("*").alias("sides")).withColumn("lost", F.lit(0))


# --- popularity ------------------------------------------------------------

POPULAR_SQL = """
SELECT *, row_number() OVER (ORDER BY popularity_score DESC, product_id) AS rank FROM (
  SELECT product_id, CAST(sum(CASE event_type WHEN 'purchase' THEN 3 WHEN 'cart' THEN 10
      WHEN 'remove_from_cart' THEN -10 WHEN 'view' THEN 1 ELSE 0 END) AS DOUBLE) AS popularity_score,
    count(*) AS total_interactions, count(DISTINCT user_id) AS unique_users,
    count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count
  FROM good GROUP BY product_id) QUALIFY rank <= 100"""

CATEGORY_SQL = """
SELECT *, row_number() OVER (PARTITION BY category_code ORDER BY popularity_score DESC, product_id) AS category_rank
FROM (SELECT *, purchase_count * 3 + interaction_count AS popularity_score FROM (
  SELECT category_code, product_id, count(*) AS interaction_count, count(DISTINCT user_id) AS unique_users,
    count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count
  FROM {source} WHERE category_code IS NOT NULL AND category_code <> 'unknown'
  GROUP BY category_code, product_id)) QUALIFY category_rank <= 20"""


@query("popular_items", POPULAR_SQL)
def popular_items(spark: SparkSession, folder: str) -> DataFrame:
    return popularity.popular_items(valid_events(spark, folder))


@query("popular_by_category", CATEGORY_SQL.format(source="good"))
def popular_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return popularity.popular_by_category(valid_events(spark, folder))


@query("popular_by_category_orders", CATEGORY_SQL.format(source="good_orders"))
def popular_by_category_orders(spark: SparkSession, folder: str) -> DataFrame:
    return popularity.popular_by_category(valid_orders(spark, folder))


@query("popular_lookup", f"SELECT * FROM ({POPULAR_SQL}) ORDER BY rank LIMIT 10")
def popular_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return popularity.popular_lookup(popular_items(spark, folder))


@query("popular_lookup_category", f"""
SELECT * FROM ({CATEGORY_SQL.format(source='good')}) WHERE category_code = 'small' ORDER BY category_rank LIMIT 10""")
def popular_lookup_category(spark: SparkSession, folder: str) -> DataFrame:
    return popularity.popular_in_category(popular_by_category(spark, folder), "small")


# --- recommendations -------------------------------------------------------

@query("recs_flat", RECS_SQL)
def recs_flat(spark: SparkSession, folder: str) -> DataFrame:
    """Recommendations in the recommender's nested, indexed form, flattened back."""
    events = valid_events(spark, folder)
    users = interactions.id_map(events, "user_id", "user_idx")
    products = interactions.id_map(events, "product_id", "product_idx")
    indexed = _recs(spark, folder).join(users, "user_id").join(products, "product_id")
    return recommendations.flatten(recommendations.nested(indexed), users, products)


@query("recs_for_user", f"SELECT * FROM ({RECS_SQL}) WHERE user_id = 7")
def recs_for_user(spark: SparkSession, folder: str) -> DataFrame:
    return recommendations.for_user(_recs(spark, folder), 7)


FALLBACK_INPUT_SQL = f"""
bought AS (
  SELECT user_id, product_id, CAST(sum(price) AS DOUBLE) AS score,
    row_number() OVER (PARTITION BY user_id ORDER BY sum(price) DESC, product_id) AS rank
  FROM good WHERE event_type = 'purchase' GROUP BY user_id, product_id QUALIFY rank <= {TOP_K}),
users AS (SELECT c_custkey AS user_id FROM customer UNION SELECT user_id FROM good),
own AS (SELECT * FROM bought WHERE user_id IN (SELECT user_id FROM users)),
counts AS (
  SELECT u.user_id, count(o.product_id) AS n FROM users u LEFT JOIN own o ON u.user_id = o.user_id GROUP BY u.user_id),
popular AS ({POPULAR_SQL})"""


@query("recs_fallback", f""", {FALLBACK_INPUT_SQL}
SELECT * FROM (
  SELECT o.user_id, o.product_id, o.score, o.rank,
    CASE WHEN n >= {TOP_K} THEN 'personalized' ELSE 'hybrid' END AS tier
  FROM own o JOIN counts c ON o.user_id = c.user_id
  UNION ALL
  SELECT user_id, product_id, score, n + row_number() OVER (PARTITION BY user_id ORDER BY popular_rank) AS rank,
    CASE WHEN n > 0 THEN 'hybrid' ELSE 'cold_start' END AS tier
  FROM (SELECT c.user_id, c.n, p.product_id, p.popularity_score AS score, p.rank AS popular_rank
    FROM counts c CROSS JOIN popular p
    WHERE c.n < {TOP_K} AND NOT EXISTS (
      SELECT 1 FROM own o WHERE o.user_id = c.user_id AND o.product_id = p.product_id)))
WHERE rank <= {TOP_K}""")
def recs_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer gets ten products; own ones are the products they bought."""
    events = valid_events(spark, folder)
    return recommendations.with_fallback(
        _all_users(spark, folder), _bought(spark, folder), popularity.popular_items(events)
    )


def _all_users(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return customers.unionByName(valid_events(spark, folder).select("user_id"))


def _bought(spark: SparkSession, folder: str) -> DataFrame:
    bought = valid_events(spark, folder).where(F.col("event_type") == "purchase")
    spent = bought.groupBy("user_id", "product_id").agg(F.sum("price").cast("double").alias("spent"))
    return recommendations.top_k_per_user(spent, "spent")


# --- ranking metrics -------------------------------------------------------

@query("ground_truth", f"""
SELECT user_id, product_id, count(*) OVER (PARTITION BY user_id) AS label_count FROM ({TEST_SQL})""")
def ground_truth(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.ground_truth(_test_pairs(spark, folder))


@query("ranking_frame", f"""
SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rank) AS prediction,
  string_agg(CAST(relevant AS VARCHAR), ',' ORDER BY rank) AS relevant, label_count
FROM ({JUDGED_SQL}) GROUP BY user_id, label_count""")
def ranking_frame(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.ranking_frame(_recs(spark, folder), _test_pairs(spark, folder))


@query("ranking_metrics", f"""
SELECT count(*) AS users, round(avg(hits / {TOP_K}.0), 6) AS precision_at_k,
  round(avg(hits / label_count), 6) AS recall_at_k, round(avg(gain / ideal), 6) AS ndcg_at_k,
  round(avg(precision_sum / label_count), 6) AS mean_average_precision
FROM (SELECT user_id, label_count, CAST(sum(relevant) AS DOUBLE) AS hits, sum(relevant / ln(rank + 1)) AS gain,
    sum(CAST(relevant AS DOUBLE) * hits_so_far / rank) AS precision_sum,
    (SELECT sum(1 / ln(i + 1)) FROM range(1, {TOP_K} + 1) places(i) WHERE i <= label_count) AS ideal
  FROM (SELECT *, sum(relevant) OVER (PARTITION BY user_id ORDER BY rank) AS hits_so_far FROM ({JUDGED_SQL}))
  GROUP BY user_id, label_count)""")
def ranking_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.ranking_metrics(_recs(spark, folder), _test_pairs(spark, folder))


@query("hit_rate", f"""
SELECT CAST(sum(hit) AS BIGINT) AS users_with_hits, count(*) AS total_users, round(avg(hit), 6) AS hit_rate
FROM (SELECT user_id, max(relevant) AS hit FROM ({JUDGED_SQL}) GROUP BY user_id)""")
def hit_rate(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.hit_rate(_recs(spark, folder), _test_pairs(spark, folder))


@query("item_coverage", f"""
SELECT recommended_items, total_items, round(recommended_items / total_items, 6) AS item_coverage
FROM (SELECT count(DISTINCT product_id) AS recommended_items FROM ({RECS_SQL})),
  (SELECT count(*) AS total_items FROM part)""")
def item_coverage(spark: SparkSession, folder: str) -> DataFrame:
    catalog = table(spark, folder, "part").withColumnRenamed("p_partkey", "product_id")
    return ranking.item_coverage(_recs(spark, folder), catalog)


# --- recommender model -----------------------------------------------------

@query("als_recs")
def als_recs(spark: SparkSession, folder: str) -> DataFrame:
    indexed = training.ratings(valid_events(spark, folder), new_folder(spark, "als_recs"))
    model = training.fit_recommender(indexed.rows)
    return training.recommend(model, indexed)


@query("als_recs_shape", f"""
SELECT user_id, least({TOP_K}, (SELECT count(DISTINCT product_id) FROM ({SCORES_SQL}) WHERE log_score > 0)) AS recommended,
  1 AS first_rank, true AS best_first FROM ({SCORES_SQL}) WHERE log_score > 0 GROUP BY user_id""")
def als_recs_shape(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold for the recommender's lists whatever the factors are."""
    ranked = Window.partitionBy("user_id").orderBy("rank")
    recs = als_recs(spark, folder).withColumn("before", F.lag("score").over(ranked))
    return recs.groupBy("user_id").agg(
        F.count_distinct("product_id").alias("recommended"),
        F.min("rank").alias("first_rank"),
        F.every(F.coalesce(F.col("before") >= F.col("score"), F.lit(True))).alias("best_first"),
    )


@query("als_recs_orders")
def als_recs_orders(spark: SparkSession, folder: str) -> DataFrame:
    indexed = training.ratings(valid_orders(spark, folder), new_folder(spark, "als_recs_orders"))
    model = training.fit_recommender(indexed.rows)
    return training.recommend(model, indexed)


@query("als_top_k_exact", f"""
SELECT count(DISTINCT user_id) AS users, true AS agree FROM ({SCORES_SQL}) WHERE log_score > 0""")
def als_top_k_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the exact lists from the stored factors have the scores of the model's own lists at every rank."""
    path = new_folder(spark, "als_top_k_exact")
    indexed = training.ratings(valid_events(spark, folder), path)
    model = training.fit_recommender(indexed.rows)
    exact = training.recommend_exactly(*training.save_factors(model, path), indexed)
    own = training.recommend(model, indexed).select("user_id", "rank", F.col("score").alias("own"))
    near = F.abs(F.col("score") - F.col("own")) <= 1e-4
    return exact.join(own, ["user_id", "rank"], "full").agg(
        F.count_distinct("user_id").alias("users"), F.every(F.coalesce(near, F.lit(False))).alias("agree"))


PROFILE_TYPES = ("view", "cart", "purchase", "remove_from_cart")


def _profiles_sql(key: str) -> str:
    counts = ", ".join(f"ln(1 + count(*) FILTER (event_type = '{t}')) AS w{n}" for n, t in enumerate(PROFILE_TYPES))
    return f"SELECT {key} AS id, {counts} FROM good GROUP BY {key}"


@query("factors_top_k", f"""
SELECT u.id AS user_id, p.id AS product_id, round(u.w0 * p.w0 + u.w1 * p.w1 + u.w2 * p.w2 + u.w3 * p.w3, 6) + 0 AS score,
  row_number() OVER (PARTITION BY u.id ORDER BY round(u.w0 * p.w0 + u.w1 * p.w1 + u.w2 * p.w2 + u.w3 * p.w3, 6) DESC, p.id) AS rank
FROM ({_profiles_sql('user_id')}) u, ({_profiles_sql('product_id')}) p QUALIFY rank <= {TOP_K}""")
def factors_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The search over factors that SQL can see: log counts of each event type, of users and of products."""
    events, path = valid_events(spark, folder), new_folder(spark, "profiles")
    weights = [F.log1p(F.count_if(F.col("event_type") == t)) for t in PROFILE_TYPES]
    for key in ("user_id", "product_id"):
        write_table(events.groupBy(F.col(key).alias("id")).agg(F.array(*weights).alias("features")), f"{path}/{key}")
    found = factors.top_k(*[spark.read.parquet(f"{path}/{key}") for key in ("user_id", "product_id")], TOP_K)
    return found.withColumnsRenamed({"user": "user_id", "product": "product_id"})


@query("model_roundtrip", f"""
SELECT 'als' AS model, count(DISTINCT user_id) AS size FROM ({SCORES_SQL}) WHERE log_score > 0
UNION ALL SELECT 'indexer', count(DISTINCT brand) FROM good
UNION ALL SELECT 'pipeline', count(*) FROM good""")
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Recommender, indexer and pipeline saved and loaded; one row per model with what it does."""
    path = new_folder(spark, "models")
    events = valid_events(spark, folder)

    ratings = training.ratings(events, f"{path}/tables").rows
    recommender = training.fit_recommender(ratings)
    models.save_model(recommender, f"{path}/als")
    users = models.load_model(ALSModel, f"{path}/als").userFactors.agg(F.count(F.lit(1)).alias("size"))

    indexer = StringIndexer(inputCol="brand", outputCol="brand_idx", handleInvalid="keep").fit(events)
    models.save_model(indexer, f"{path}/indexer")
    brands = (
        models.load_model(StringIndexerModel, f"{path}/indexer").transform(events)
        .agg(F.count_distinct("brand_idx").alias("size"))
    )

    frame = _stored_frame(spark, folder)
    models.save_model(training.fit_classifier(frame), f"{path}/pipeline")
    loaded = models.load_model(PipelineModel, f"{path}/pipeline")
    assert isinstance(loaded.stages[-1], RandomForestClassificationModel)
    scored = loaded.transform(frame).agg(F.count("prediction").alias("size"))

    named = (("als", users), ("indexer", brands), ("pipeline", scored))
    rows = [frame.select(F.lit(name).alias("model"), "size") for name, frame in named]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("model_metadata", """
SELECT 'model_type' AS key, 'ALS' AS value UNION ALL SELECT 'rank', '150'
UNION ALL SELECT 'total_records', CAST(count(*) AS VARCHAR) FROM good""")
def model_metadata(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "model_metadata")
    trained_on = valid_events(spark, folder).count()
    described = {"model_type": "ALS", "rank": params.ALS_RANK, "total_records": trained_on}
    models.save_metadata(spark, described, path)
    return models.load_metadata(spark, path).where(F.col("key") != "saved_at")


@query("train_recommender")
def train_recommender(spark: SparkSession, folder: str) -> DataFrame:
    return training.train_recommender(valid_events(spark, folder), new_folder(spark, "recommender"))


# --- classifier features ---------------------------------------------------

LAGGED_SQL = """
SELECT *, lag(event_time) OVER (PARTITION BY user_session ORDER BY event_time, product_id, event_type)
  AS prev_event_time FROM {source}"""

FEATURE_COLUMNS = """CAST(hour(event_time) AS BIGINT) AS hour, CAST(dayofweek(event_time) + 1 AS BIGINT) AS week_day,
  coalesce(epoch_us(event_time) // 1000000 - epoch_us(prev_event_time) // 1000000, 0) AS secs_since_last"""

FRAME_SQL = f"""
SELECT event_id, event_type, product_id, user_id, category_code, brand, price, {FEATURE_COLUMNS},
  CASE event_type WHEN 'purchase' THEN 2.0 WHEN 'cart' THEN 1.0 ELSE 0.0 END AS label,
  greatest(CASE event_type WHEN 'view' THEN 1.0 WHEN 'cart' THEN 7.0 WHEN 'purchase' THEN 15.0
      WHEN 'remove_from_cart' THEN 3.5 ELSE 0.0 END
    * exp(CAST(-0.02 AS DOUBLE) * ((SELECT max(epoch_us(event_time) // 1000000) FROM good)
      - epoch_us(event_time) // 1000000) / 86400.0), 0.01) AS weight
FROM ({LAGGED_SQL.format(source='good')})"""


@query("session_features", f"""
SELECT event_id, user_session, {FEATURE_COLUMNS} FROM ({LAGGED_SQL.format(source='good')})""")
def session_features(spark: SparkSession, folder: str) -> DataFrame:
    featured = features.session_features(valid_events(spark, folder))
    return featured.select("event_id", "user_session", "hour", "week_day", "secs_since_last")


@query("session_features_orders", f"""
SELECT event_type, product_id, user_session, {FEATURE_COLUMNS} FROM ({LAGGED_SQL.format(source='good_orders')})""")
def session_features_orders(spark: SparkSession, folder: str) -> DataFrame:
    featured = features.session_features(valid_orders(spark, folder))
    return featured.select(
        "event_type", "product_id", "user_session", "hour", "week_day", "secs_since_last"
    )


@query("training_frame", f"""
SELECT event_id, CAST(label AS DOUBLE) AS label, round(weight, 6) AS weight, hour, week_day, secs_since_last FROM ({FRAME_SQL})""")
def training_frame(spark: SparkSession, folder: str) -> DataFrame:
    frame = features.training_frame(valid_events(spark, folder))
    return frame.select("event_id", "label", "weight", "hour", "week_day", "secs_since_last")


@query("label_stats", f"SELECT CAST(label AS DOUBLE) AS label, count(*) AS record_count FROM ({FRAME_SQL}) GROUP BY label")
def label_stats(spark: SparkSession, folder: str) -> DataFrame:
    return features.label_distribution(features.with_label_and_weight(valid_events(spark, folder)))


@query("weight_stats", f"""
SELECT round(min(weight), 6) AS min_weight, round(max(weight), 6) AS max_weight, round(avg(weight), 6) AS avg_weight
FROM ({FRAME_SQL})""")
def weight_stats(spark: SparkSession, folder: str) -> DataFrame:
    return features.weight_stats(features.with_label_and_weight(valid_events(spark, folder)))


@query("cardinality", """
SELECT count(DISTINCT brand) AS brand_count, count(DISTINCT category_code) AS category_count,
  greatest(count(DISTINCT brand), count(DISTINCT category_code)) + 10 AS max_bins FROM good""")
def cardinality(spark: SparkSession, folder: str) -> DataFrame:
    return features.cardinality(valid_events(spark, folder))


def bucketing_sql(top_n: int) -> str:
    return f"""
SELECT event_id, {EVENT_SQL},
  CASE WHEN brand IN (SELECT brand FROM good GROUP BY brand ORDER BY count(*) DESC, brand LIMIT {top_n})
    THEN brand ELSE 'other' END AS brand_bucketed,
  CASE WHEN category_code IN (
      SELECT category_code FROM good GROUP BY category_code ORDER BY count(*) DESC, category_code LIMIT {top_n})
    THEN category_code ELSE 'other' END AS category_bucketed
FROM good"""


@query("topn_bucketing_default", bucketing_sql(params.TOP_N_CATEGORIES))
def topn_bucketing_default(spark: SparkSession, folder: str) -> DataFrame:
    return features.bucket_categories(valid_events(spark, folder), params.TOP_N_CATEGORIES)


@query("topn_bucketing", bucketing_sql(TOP_N))
def topn_bucketing(spark: SparkSession, folder: str) -> DataFrame:
    return features.bucket_categories(valid_events(spark, folder), TOP_N)


EVENT_TRAIN_SQL = "CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 8000"

MEAN_SQL = """coalesce(CAST(round(CAST(sum(CAST(weight * label AS DECIMAL(18,9))) AS DOUBLE)
    / CAST(sum(CAST(weight AS DECIMAL(18,9))) AS DOUBLE) * 1000000) AS BIGINT), 0)"""


def order_sql(column: str) -> str:
    """Categories of the training rows, in the order of their mean label."""
    return f"""
SELECT {column} AS category, {MEAN_SQL} AS mean_label,
  row_number() OVER (ORDER BY {MEAN_SQL}, {column} NULLS FIRST) - 1 AS number
FROM framed WHERE {EVENT_TRAIN_SQL} GROUP BY {column}"""


def number_sql(column: str) -> str:
    return f"""coalesce((SELECT CAST(o.number AS DOUBLE) FROM ({order_sql(column)}) o WHERE o.category = framed.{column}),
    (SELECT count(*) - 0.5 FROM ({order_sql(column)}) o
      WHERE o.mean_label < (SELECT {MEAN_SQL} FROM framed WHERE {EVENT_TRAIN_SQL})))"""


FRAMED_SQL = f", framed AS ({FRAME_SQL})"


def _encoded(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The training frame, marked by side, and the orders of its training rows."""
    split = interactions.hash_split(_stored_frame(spark, folder), ("event_id",))
    path = new_folder(spark, "encoding")
    return split, encoding.fit_orders(split.where("is_train"), training.ENCODED, path)


@query("category_order", f"""{FRAMED_SQL}
SELECT 'category_code' AS source, * FROM ({order_sql('category_code')})
UNION ALL SELECT 'brand', * FROM ({order_sql('brand')})""")
def category_order(spark: SparkSession, folder: str) -> DataFrame:
    _, orders = _encoded(spark, folder)
    parts = [
        orders[column].select(F.lit(column).alias("source"), "category", "mean_label", "number")
        for column in training.ENCODED
    ]
    return parts[0].unionByName(parts[1])


@query("category_encoding", f"""{FRAMED_SQL}
SELECT event_id, CAST({number_sql('category_code')} AS DOUBLE) AS category_idx,
  CAST({number_sql('brand')} AS DOUBLE) AS brand_idx
FROM framed""")
def category_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """Every event by the orders fitted on the training side alone."""
    split, orders = _encoded(spark, folder)
    return encoding.encode_all(split, training.ENCODED, orders).select(
        "event_id", *training.ENCODED.values()
    )


# --- classifier metrics ----------------------------------------------------

PREDICTION_SQL = """
SELECT *, CASE event_type WHEN 'purchase' THEN 2.0 WHEN 'cart' THEN 1.0 ELSE 0.0 END AS label,
  CAST((user_id + product_id) % 3 AS DOUBLE) AS prediction,
  CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 / 1000.0 AS prob_purchase FROM good"""


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Made-up but reproducible predictions and purchase probabilities for every event."""
    labelled = features.with_label_and_weight(valid_events(spark, folder))
    chance = (stable_hash("event_id") % 1000) / 1000.0
    rest = (1.0 - F.col("prob_purchase")) / 2
    return labelled.withColumns({
        "prediction": ((F.col("user_id") + F.col("product_id")) % 3).cast("double"),
        "prob_purchase": chance,
    }).withColumn("probabilities", F.array(rest, rest, "prob_purchase"))


@query("confusion_matrix", f"""
SELECT CAST(label AS DOUBLE) AS label, count(*) FILTER (WHERE prediction = 0) AS predicted_0,
  count(*) FILTER (WHERE prediction = 1) AS predicted_1, count(*) FILTER (WHERE prediction = 2) AS predicted_2
FROM ({PREDICTION_SQL}) GROUP BY label""")
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return class_metrics.confusion_matrix(_predictions(spark, folder))


CLASS_SQL = f"""
SELECT CAST(label AS DOUBLE) AS label, actual, correct, CASE WHEN predicted > 0 THEN correct / predicted ELSE 0 END AS p,
  correct / actual AS r
FROM (SELECT label, count(*) AS actual, count(*) FILTER (WHERE prediction = label) AS correct
  FROM ({PREDICTION_SQL}) GROUP BY label)
LEFT JOIN (SELECT prediction AS label, count(*) AS predicted FROM ({PREDICTION_SQL}) GROUP BY prediction) USING (label)"""

F1_SQL = "CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END"


@query("class_metrics", f"""
SELECT label, actual, correct, round(p, 6) AS precision, round(r, 6) AS recall, round({F1_SQL}, 6) AS f1 FROM ({CLASS_SQL})""")
def class_metrics_query(spark: SparkSession, folder: str) -> DataFrame:
    return class_metrics.class_metrics(_predictions(spark, folder))


@query("multiclass_metrics", f"""
SELECT round(sum(correct) / sum(actual), 6) AS accuracy, round(sum(p * actual) / sum(actual), 6) AS weighted_precision,
  round(sum(r * actual) / sum(actual), 6) AS weighted_recall,
  round(sum({F1_SQL} * actual) / sum(actual), 6) AS weighted_f1 FROM ({CLASS_SQL})""")
def multiclass_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return class_metrics.multiclass_metrics(_predictions(spark, folder))


@query("precision_at_k", f"""
SELECT count(*) AS considered, count(*) FILTER (WHERE label = 2) AS buyers,
  round(avg(CASE WHEN label = 2 THEN 1.0 ELSE 0.0 END), 6) AS precision_at_k
FROM (SELECT * FROM ({PREDICTION_SQL}) ORDER BY prob_purchase DESC, event_id LIMIT 1000)""")
def precision_at_k(spark: SparkSession, folder: str) -> DataFrame:
    return class_metrics.precision_at_k(_predictions(spark, folder), ties=("event_id",))


@query("log_loss", f"""
SELECT round(-avg(ln(greatest(CASE WHEN label = 2 THEN prob_purchase ELSE (1 - prob_purchase) / 2 END, 1e-15))), 6)
  AS log_loss FROM ({PREDICTION_SQL})""")
def log_loss(spark: SparkSession, folder: str) -> DataFrame:
    return class_metrics.log_loss(_predictions(spark, folder))


# --- classifier model ------------------------------------------------------

def _stored_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The training frame as a table, as fitting reads it many times."""
    path = new_folder(spark, "training_frame")
    frame = features.training_frame(valid_events(spark, folder))
    write_table(features.bucket_categories(frame, params.TOP_N_CATEGORIES), path, "overwrite")
    return spark.read.parquet(path)


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    split = interactions.hash_split(_stored_frame(spark, folder), ("event_id",))
    model = training.fit_classifier(split.where("is_train"))
    return training.score_purchases(model.transform(split.where("NOT is_train")))


@query("rf_predictions")
def rf_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select("event_id", "label", "prediction", "probabilities")


@query("rf_predictions_shape", """
SELECT event_id, CASE event_type WHEN 'purchase' THEN CAST(2 AS DOUBLE) WHEN 'cart' THEN 1 ELSE 0 END AS label,
  true AS known_class, true AS adds_up
FROM good WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 >= 8000""")
def rf_predictions_shape(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold for the classifier's output whatever the trees are."""
    total = F.aggregate("probabilities", F.lit(0.0), lambda so_far, p: so_far + p)
    return _scored(spark, folder).select(
        "event_id", "label",
        F.col("prediction").isin(*class_metrics.CLASSES).alias("known_class"),
        (F.abs(total - 1) < 1e-9).alias("adds_up"),
    )


@query("purchase_scores")
def purchase_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select("event_id", "label", "prob_purchase")


@query("train_classifier")
def train_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return training.train_classifier(
        valid_events(spark, folder), new_folder(spark, "classifier")
    )


@query("train_classifier_top_n")
def train_classifier_top_n(spark: SparkSession, folder: str) -> DataFrame:
    return training.train_classifier(
        valid_events(spark, folder), new_folder(spark, "classifier"), params.TOP_N_CATEGORIES
    )
