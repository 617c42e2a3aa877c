import math
import pathlib
import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import Window, functions as F

from shoplake import params
from shoplake.operators import factors, interactions, popularity, ranking, recommendations
from shoplake.plans import training
from shoplake.registry.base import valid_events
from shoplake.sinks.models import load_metadata, load_model


def test_interaction_scores(events):
    day = datetime(2024, 1, 1)
    rows = events(*[{"event_time": day}] * 60, {"event_type": "purchase", "event_time": day - timedelta(days=10)},
                  {"event_type": "remove_from_cart", "product_id": 2, "event_time": day})
    found = {r.product_id: r for r in interactions.interaction_scores(rows).collect()}
    assert found[1].view_score == 50.0
    assert found[1].action_score == pytest.approx(100 * math.exp(-0.2))
    assert found[1].log_score == pytest.approx(math.log1p(50 + 100 * math.exp(-0.2)))
    assert (found[2].action_score, found[2].log_score) == (0.0, 0.0)


def test_id_map_is_dense_and_one_to_one(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") * 977).alias("u"))
    ids = interactions.id_map(rows.unionByName(rows), "u", "idx")
    stats = ids.agg(F.count("*"), F.countDistinct("idx"), F.countDistinct("u"), F.min("idx"), F.max("idx")).first()
    n = rows.where("u IS NOT NULL").count()
    assert tuple(stats) == (n, n, n, 0, n - 1)


def test_hash_split_does_not_depend_on_partitioning(spark):
    rows = spark.range(10_000).withColumnRenamed("id", "k")
    first = interactions.hash_split(rows, ("k",))
    second = interactions.hash_split(rows.repartition(13), ("k",))
    assert first.exceptAll(second).count() == 0
    assert 7800 < first.where("is_train").count() < 8200


def test_popular_ties_rank_by_product(events):
    rows = events({"product_id": 3}, {"product_id": 2}, {"product_id": 1, "event_type": "remove_from_cart"})
    found = [(r.product_id, r.popularity_score, r.rank) for r in popularity.popular_items(rows).orderBy("rank").collect()]
    assert found == [(2, 1.0, 1), (3, 1.0, 2), (1, -10.0, 3)]
    assert popularity.popular_items(rows, top_k=2).count() == 2


def test_popular_by_category_leaves_out_unknown(events):
    rows = events({"category_code": "unknown"}, {"category_code": None}, {"product_id": 5, "event_type": "purchase"}, {})
    found = [(r.category_code, r.product_id, r.popularity_score, r.category_rank)
             for r in popularity.popular_by_category(rows, 1).collect()]
    assert found == [("toys", 5, 4, 1)]


@pytest.fixture
def tiers(spark):
    popular = spark.createDataFrame([(p, float(100 - p), n + 1) for n, p in enumerate(range(10, 22))],
                                    "product_id long, popularity_score double, rank int")
    recs = [(1, p, 1.0, n + 1) for n, p in enumerate(range(30, 34))]
    recs += [(2, 10, 9.0, 1), (2, 40, 8.0, 2), (2, 11, 7.0, 3)]
    recs += [(3, 50, 1.0, 1)]
    users = spark.createDataFrame([(1,), (2,), (3,), (4,), (4,)], "user_id long")
    return users, spark.createDataFrame(recs, "user_id long, product_id long, score double, rank int"), popular


def test_fallback_tiers(tiers):
    users, recs, popular = tiers
    found = {}
    for r in recommendations.with_fallback(users, recs, popular, 4).orderBy("user_id", "rank").collect():
        found.setdefault((r.user_id, r.tier), []).append((r.rank, r.product_id))
    assert found == {
        (1, "personalized"): [(1, 30), (2, 31), (3, 32), (4, 33)],
        (2, "hybrid"): [(1, 10), (2, 40), (3, 11), (4, 12)],
        (3, "hybrid"): [(1, 50), (2, 10), (3, 11), (4, 12)],
        (4, "cold_start"): [(1, 10), (2, 11), (3, 12), (4, 13)],
    }


def test_fallback_with_a_short_popular_list(tiers):
    users, recs, popular = tiers
    rows = recommendations.with_fallback(users, recs, popular.where("rank <= 2"), 6)
    assert rows.where("user_id = 4").count() == 2


def test_lookups(tiers):
    _, recs, popular = tiers
    assert [r.product_id for r in recommendations.for_user(recs, 2).collect()] == [10, 40, 11]
    assert [r.rank for r in popularity.popular_lookup(popular, 3).collect()] == [1, 2, 3]


def test_metrics_agree_with_the_evaluator(spark):
    noise = F.pmod(F.xxhash64("user_id", "product_id"), F.lit(1000))
    products = F.explode(F.sequence(F.lit(0), F.lit(29))).alias("product_id")
    pairs = spark.range(60).select(F.col("id").alias("user_id"), products).withColumn("n", noise)
    recs = recommendations.top_k_per_user(pairs.where("n % 4 <> user_id % 4"), "n", 12)
    truth = pairs.where("n % 7 = 1").select("user_id", "product_id")
    lists = recs.groupBy("user_id").agg(F.expr("transform(array_sort(collect_list(struct(rank, product_id))), x -> double(x.product_id))").alias("prediction")).join(
        truth.groupBy("user_id").agg(F.expr("transform(collect_list(product_id), x -> double(x))").alias("label")), "user_id")
    metrics = ranking.ranking_metrics(recs, truth, 5).first()
    for name, metric in (("precisionAtK", "precision_at_k"), ("recallAtK", "recall_at_k"), ("ndcgAtK", "ndcg_at_k"),
                         ("meanAveragePrecision", "mean_average_precision")):
        expected = RankingEvaluator(metricName=name, k=5).evaluate(lists)
        assert metrics[metric] == pytest.approx(expected), name
    assert metrics.users == lists.count()
    hits = lists.where("size(array_intersect(prediction, label)) > 0").count()
    assert ranking.hit_rate(recs, truth).first().users_with_hits == hits


def test_recommender_job(spark, sf_dir, tmp_path):
    events = valid_events(spark, sf_dir)
    metadata = training.train_recommender(events, str(tmp_path), k=5, rank=4, iterations=2, blocks=2)
    values = {r.key: r.value for r in metadata.collect()}
    assert {"saved_at", "ndcg_at_k", "hit_rate", "item_coverage", "rank"} <= set(values)
    recs = spark.read.parquet(str(tmp_path / "recommendations"))
    users = recs.groupBy("user_id").agg(F.count("*").alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi"))
    assert users.where("n <> 5 OR lo <> 1 OR hi <> 5").count() == 0
    assert recs.where("score IS NULL OR product_id IS NULL").count() == 0
    ordered = Window.partitionBy("user_id").orderBy("rank")
    assert recs.withColumn("before", F.lag("score").over(ordered)).where("before < score").count() == 0
    assert spark.read.parquet(str(tmp_path / "popular_items")).count() <= 100
    from pyspark.ml.recommendation import ALSModel
    assert load_model(ALSModel, str(tmp_path / "model")).rank == 4
    assert load_metadata(spark, str(tmp_path / "metadata")).count() == len(values)


def test_fits_keep_the_documented_rank(spark, tmp_path):
    """A product rated 0 throughout and fewer users than factors do not change the rank."""
    rows = [(u, p, float((u * p) % 3)) for u in range(6) for p in range(5)] + [(6, 5, 0.0)]
    model = training.fit_recommender(spark.createDataFrame(rows, "userId int, productId int, rating float"), iterations=2, blocks=1)
    assert (model.rank, model.userFactors.count(), model.itemFactors.count()) == (params.ALS_RANK, 4, 3)
    assert model.userFactors.where(f"size(features) <> {params.ALS_RANK}").count() == 0
    users, products = training.save_factors(model, str(tmp_path))
    found = {(r.user, r.rank): r.score for r in factors.top_k(users, products, 3).collect()}
    own = {(r.userId, n + 1): x.rating for r in model.recommendForAllUsers(3).collect() for n, x in enumerate(r.recommendations)}
    assert found.keys() == own.keys() and all(abs(found[key] - own[key]) < 1e-4 for key in own)


def test_fits_keep_no_shuffle_files_of_all_iterations(spark):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffles():
        return {f.name.split("_")[1] for folder in folders for f in pathlib.Path(folder).rglob("shuffle_*.data")}

    rows = [(u, p, 1.0 + (u * p) % 3) for u in range(30) for p in range(20)]
    ratings = spark.createDataFrame(rows, "userId int, productId int, rating float")
    before = shuffles()
    model = training.fit_recommender(ratings, rank=3, iterations=12, blocks=2)
    # Each iteration shuffles twice; those that carry users' factors to products have gone.
    assert len(shuffles() - before) < 20 and model.rank == 3


def test_small_bands_share_a_cell(spark, tmp_path, monkeypatch):
    """Each user's factors are sent once for all bands that fit one cell."""
    vectors = [(n, [1.2 ** (n % 40), 0.5]) for n in range(400)]
    frames = [spark.createDataFrame(rows, "id long, features array<double>") for rows in (vectors[:50], vectors)]
    monkeypatch.setattr(factors, "_picked", lambda k, digits, pick=factors._picked: counted(pick(k, digits), tmp_path))
    monkeypatch.setattr(factors, "HEAD", 2)  # too few to bound any score: every user needs every band

    def counted(pick, folder):
        def run(batches):
            def seen(batches):
                for batch in batches:
                    (folder / uuid.uuid4().hex).write_text(str(int(sum(batch["is_user"].to_pylist()))))
                    yield batch
            yield from pick(seen(batches))
        return run

    found = factors.top_k(*frames, 3).collect()
    sent = sum(int(f.read_text()) for f in tmp_path.iterdir())
    assert sent == 50 and len(found) == 150


def brute_top_k(users, products, k):
    lists = {}
    for user, u in users:
        scored = sorted((-round(sum(a * b for a, b in zip(u, p)), 6) + 0.0, product) for product, p in products)
        lists[user] = [(product, -score + 0.0) for score, product in scored[:k]]
    return lists


def test_exact_top_k_agrees_with_brute_force(spark, monkeypatch):
    """Ties, zero and negative vectors, missing rows, several cells a band, short lists, clashing extra columns."""
    draw = random.Random(5)
    vector = lambda spread: [draw.randint(-3, 3) * spread for _ in range(3)]
    products = [(n, vector(draw.choice((0.0, 0.25, 1.0, 8.0)))) for n in range(150)]
    users = [(n, vector(1.0)) for n in range(40)] + [(40, [0.0] * 3)]
    schema = "id long, features array<double>, place int"
    frames = [spark.createDataFrame([(i, v, 1) for i, v in rows] + [(None, [1.0] * 3, 1), (999, None, 1)], schema) for rows in (users, products)]
    monkeypatch.setattr(factors, "HEAD", 12)
    monkeypatch.setattr(factors, "PRODUCTS_PER_CELL", 9)
    monkeypatch.setattr(factors, "USERS_PER_CELL", 7)
    lists = {}
    for r in factors.top_k(*frames, 4).orderBy("user", "rank").collect():
        lists.setdefault(r.user, []).append((r.product, r.score))
    assert lists == brute_top_k(users, products, 4)
    few = frames[1].where("id < 2")
    assert factors.top_k(frames[0], few, 4).count() == 2 * len(users)
    assert factors.top_k(frames[0], few.limit(0), 4).count() == 0
    assert factors.top_k(frames[0].limit(0), few, 4).count() == 0
