import os
from datetime import date, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from shoplake.operators import rollups
from shoplake.operators.parsing import parse_events
from shoplake.plans import medallion
from shoplake.sinks import clustering, locations, packing, replace, tables
from shoplake.streaming import folding, views
from shoplake.streaming.dedup import deduplicated
from shoplake.streaming.jobs import start_parquet
from test_streaming import Topic, event, run
from test_tables import batch


def names(path):
    return sorted(os.path.join(d, f) for d, _, found in os.walk(path) for f in found if f.endswith(".parquet"))


def test_items_go_to_the_first_bin_with_room():
    assert packing.first_fit_decreasing([9, 6, 5, 4, 4, 1, 1], 10) == [0, 1, 2, 1, 2, 0, 2]
    assert packing.first_fit_decreasing([30, 2], 10) == [0, 1] and packing.first_fit_decreasing([], 5) == []


def test_only_small_files_are_read_and_rewritten(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(60_000).select("id", (F.col("id") % 3).alias("k"), F.xxhash64("id").alias("noise"))
    rows.where("id >= 3000").coalesce(1).write.partitionBy("k").parquet(path)
    large = set(names(path))
    rows.where("id < 3000").repartition(6).write.mode("append").partitionBy("k").parquet(path)
    target = min(map(os.path.getsize, large))
    stamps = {f: os.stat(f).st_mtime_ns for f in large}
    report = packing.rewritten_files(spark, path, target).collect()
    assert [(r.files_kept, r.files_rewritten, r.files_made) for r in report] == [(1, 6, 1)] * 3
    assert packing.compact_files(spark, path, target) == 18
    assert large < set(names(path)) and len(names(path)) == 6
    assert {f: os.stat(f).st_mtime_ns for f in large} == stamps
    found = spark.read.parquet(path)
    assert found.count() == 60_000 and found.exceptAll(rows.select(*found.columns)).isEmpty()
    assert packing.compact_files(spark, path, target) == 0


def test_new_files_respect_the_target_and_keep_every_column(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in range(5):
        part = spark.range(n * 1000, n * 1000 + 1000).select("id", F.xxhash64("id").alias("noise"))
        part = part.withColumn("later", F.lit(n)) if n > 2 else part
        part.coalesce(1).write.mode("append").parquet(f"{path}/a=x y/b=1")
    size = max(map(os.path.getsize, names(path)))
    packing.compact_files(spark, path, 2 * size + 5000)
    assert len(names(path)) == 3
    found = spark.read.option("mergeSchema", True).parquet(path)
    assert found.agg(F.sum("later"), F.count("*"), F.first("a")).first()[:] == (7000, 5000, "x y")


@pytest.mark.parametrize("steps", [0, 1, 2, 3])
def test_a_replacement_cut_short_is_finished_by_the_next_job(spark, tmp_path, monkeypatch, steps):
    path = str(tmp_path / "table")
    spark.range(100).repartition(4).write.parquet(path)
    done, files = [], replace._files

    def failing(*args):
        done.append(args)
        if len(done) > steps:
            raise OSError("lost")
        return files(*args)

    monkeypatch.setattr(replace, "_files", failing)
    monkeypatch.setattr(packing, "recover", lambda *args: None)
    with pytest.raises(OSError, match="lost"):
        packing.compact_files(spark, path)
    monkeypatch.undo()
    packing.compact_files(spark, path)
    assert spark.read.parquet(path).count() == 100 and len(names(path)) == 1
    assert not os.path.exists(f"{path}/_replacing") or not os.listdir(f"{path}/_replacing")


def test_staged_data_without_a_journal_is_removed(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(10).write.parquet(path)
    spark.range(99).write.parquet(f"{replace.staging(path)}/data")
    replace.recover(spark, path)
    assert spark.read.parquet(path).count() == 10 and os.listdir(f"{path}/_replacing") == []


@pytest.mark.parametrize("count", [1, 5, 12])
def test_states_are_the_same_after_any_number_of_batches(spark, events, tmp_path, count):
    path = str(tmp_path / "states")
    start = datetime(2024, 1, 1)
    changes = [{"event_time": start + timedelta(hours=7 * n), "user_id": n % 5, "price": f"{n}.50",
                "event_type": "purchase" if n % 3 else "view"} for n in range(2 * count)]
    for n in range(count):
        views.append_states(events(*changes[2 * n:2 * n + 2]), n, path, ("daily", "session"))
        if n % 3 == 2:
            folding.fold_states(spark, path, ("daily", "session"))
    folding.fold_states(spark, path, ("daily", "session"))
    whole = events(*changes)
    for name in ("daily", "session"):
        folders = {f"{r.stream}/{r.batch_id}" for r in spark.read.parquet(f"{path}/{name}").select("stream", "batch_id").distinct().collect()}
        assert len(folders) <= 2 and (count == 1 or any(f.startswith("folded/") for f in folders))
        found = rollups.estimate_sketches(views.current(spark, path, name))
        expected = rollups.estimate_sketches(rollups.merge_states(rollups.ROLLUPS[name](whole), name))
        assert sorted(found.collect()) == sorted(expected.select(*found.columns).collect())
    assert folding.fold_states(spark, path, ("daily", "session")) == {"daily": 0, "session": 0}


def test_a_batch_replayed_after_a_fold_counts_once(spark, events, tmp_path):
    path = str(tmp_path / "states")
    for n in range(3):
        views.append_states(events({"user_id": n + 1}), n, path, ("daily",))
    folding.fold_states(spark, path, ("daily",))
    views.append_states(events({"user_id": 3}), 2, path, ("daily",))  # the last batch, written again
    assert views.current(spark, path, "daily").first()["total_views"] == 3


def test_keys_without_time_leave_the_state(spark, messages, tmp_path):
    topic, out, checkpoint = Topic(spark, messages, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def deliver(*values):
        topic.send(*values)
        once = deduplicated(parse_events(topic.stream(), keep=("partition", "offset")), ("user_id",))
        return run(start_parquet(once, checkpoint, out, state_partitions=2))

    deliver(*[event(0, user_id=str(n)) for n in range(1, 21)], event(1, user_id="1"))
    deliver(event(2, user_id="1"), event(60, user_id="99"))
    last = deliver(event(61, user_id="99"), event(62, user_id="1"))
    rows = last.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert rows <= 2  # users 2 to 20 have left; without a watermark on the key there would be 21
    counts = {r.user_id: r["count"] for r in spark.read.parquet(out).groupBy("user_id").count().collect()}
    assert counts[99] == 1 and counts[2] == 1 and counts[1] == 2  # seen an hour later, 1 is new again


def test_visits_are_written_once_and_late_rows_are_left_out(spark, messages, tmp_path):
    topic, out, checkpoint = Topic(spark, messages, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def deliver(*values):
        topic.send(*values)
        run(views.closed_sessions(topic.stream(), checkpoint, out, state_partitions=2))

    deliver(event(0), event(20, event_type="purchase"), event(49))
    assert spark.read.parquet(out).isEmpty()
    deliver(event(79), event(110), event(200, user_session="t"))  # 30 minutes after is the same visit, 31 is another
    deliver(event(10), event(201, user_session="t"))  # too late
    deliver(event(300, user_session="u"))
    found = {(r.user_session, r.session_start_time.hour * 60 + r.session_start_time.minute): (r.total_events, r.has_purchase, r.session_duration_sec)
             for r in spark.read.parquet(out).collect()}
    assert found == {("s", 0): (4, 1, 79 * 60), ("s", 110): (1, 0, 0), ("t", 200): (2, 0, 60)}


def test_user_sets_of_batches_give_exact_numbers_while_small(spark, events):
    def day(n):
        return datetime(2024, 1, n)

    rows = [{"event_time": day(1), "user_id": 1}, {"event_time": day(1), "user_id": 2, "event_type": "purchase"},
            {"event_time": day(2), "user_id": 1, "event_type": "purchase"}, {"event_time": day(2), "user_id": 1},
            {"event_time": day(2), "user_id": 3}, {"event_time": day(4), "user_id": 3}]
    whole = events(*rows)
    states = rollups.user_set_states(events(*rows[:3])).unionByName(rollups.user_set_states(events(*rows[3:])))
    found = rollups.returning_users(rollups.merge_user_sets(states)).orderBy("event_date").collect()
    exact = rollups.returning_users_exact(whole).orderBy("event_date").collect()
    assert [tuple(r) for r in found] == [tuple(r) for r in exact] == [
        (date(2024, 1, 1), 2, 0, 1), (date(2024, 1, 2), 2, 1, 1), (date(2024, 1, 4), 1, 0, 1)]


def test_index_names_the_partitions_of_moving_keys(spark, events, tmp_path, monkeypatch):
    monkeypatch.setattr(locations, "KEYS_PER_BUCKET", 2)
    path, key = str(tmp_path / "working"), ("user_id", "product_id")

    def upsert(*changes, **options):
        return medallion.upsert_events(spark, path, batch(events, *changes, key=key), key, **options)

    upsert(*[{"user_id": n, "event_time": datetime(2024, 1, n)} for n in range(1, 9)])
    searched, add = [], locations.add
    monkeypatch.setattr(locations, "add", lambda *args: searched.append(add(*args)) or searched[-1])
    assert upsert({"user_id": 3, "event_time": datetime(2024, 2, 1)}) == [date(2024, 1, 3), date(2024, 2, 1)]
    assert searched == [[date(2024, 1, 3)]]  # one of eight partitions, and only it was rewritten
    assert upsert({"user_id": 3, "event_time": datetime(2024, 3, 1)}) == [date(2024, 2, 1), date(2024, 3, 1)]
    index = spark.read.parquet(locations.index_path(path))
    assert index.select("buckets").first()[0] == 5 and index.count() == 8
    place = {(r.key_hash): r.event_date for r in index.collect()}
    table = spark.read.parquet(path).select(F.xxhash64(*key).alias("h"), "event_date").collect()
    assert place == {r.h: r.event_date for r in table}


def test_index_is_built_again_after_another_writer(spark, events, tmp_path):
    path, key = str(tmp_path / "working"), ("user_id",)
    medallion.upsert_events(spark, path, batch(events, {}, key=key), key)
    medallion.upsert_events(spark, path, batch(events, {"event_time": datetime(2024, 2, 2)}, key=key), key)
    assert tables.table_exists(spark, locations.index_path(path))
    source = spark.read.parquet(path).withColumn("user_id", F.lit(50).cast("bigint"))
    tables.upsert_table(spark, path, source, ["user_id"], "event_date")
    assert not tables.table_exists(spark, locations.index_path(path))
    medallion.upsert_events(spark, path, batch(events, {"user_id": 50, "event_time": datetime(2024, 4, 4)}, key=key), key)
    assert sorted(str(r.event_date) for r in spark.read.parquet(path).collect()) == ["2024-02-02", "2024-04-04"]


def spread_rows(spark, low, high):
    """Two unlike orders over ``id``, a text with a hot value, nulls and a day."""
    mixed = F.pmod(F.xxhash64("id"), F.lit(100_000))
    return spark.range(low, high).select(
        "id", (F.col("id") % 2).alias("k"), mixed.alias("b"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("Text#"), mixed)).alias("t"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("day"))


@pytest.mark.parametrize("pieces", [8, 64])
def test_clustered_files_open_as_their_bounds_say(spark, tmp_path, pieces):
    path = str(tmp_path / "table")
    rows = spread_rows(spark, 0, 40_000)
    rows.coalesce(1).write.parquet(path)
    target = sum(map(os.path.getsize, names(path))) // pieces
    before = names(path)
    assert clustering.cluster_files(spark, path, ["id", "b"], target) == len(before)
    table = spark.read.parquet(path)
    assert table.exceptAll(rows).isEmpty() and table.count() == 40_000
    found = clustering.files_opened(table, {"id": (4000, 9000), "b": (20_000, 30_000)}).first()
    bounds = duckdb.sql(f"""
        SELECT count(*), count(*) FILTER (WHERE id_max >= 4000 AND id_min <= 9000 AND b_max >= 20000 AND b_min <= 30000)
        FROM (SELECT filename, min(id) AS id_min, max(id) AS id_max, min(b) AS b_min, max(b) AS b_max
          FROM read_parquet('{path}/*.parquet', filename = true) GROUP BY filename)""").fetchall()[0]
    assert (found.files, found.opened) == bounds
    # A range an eighth wide on one column and a tenth on the other: well below half of the files.
    assert found.opened <= (found.files * 0.5 if pieces == 8 else found.files * 0.2)


def test_only_files_not_clustered_yet_are_rewritten(spark, tmp_path):
    path, columns = str(tmp_path / "table"), ["t", "day", "id"]
    spread_rows(spark, 0, 40_000).coalesce(1).write.partitionBy("k").parquet(path)
    target = sum(map(os.path.getsize, names(path))) // 8
    clustering.cluster_files(spark, path, columns, target)
    first = {f: os.stat(f).st_mtime_ns for f in names(path)}
    assert clustering.cluster_files(spark, path, columns, target) == 0
    # A small part in one folder becomes a run of its own; the large runs stay as they are.
    spread_rows(spark, 40_000, 41_000).where("k = 1").repartition(3).write.mode("append").partitionBy("k").parquet(path)
    assert clustering.cluster_files(spark, path, columns, target) == 3
    assert first.items() <= {f: os.stat(f).st_mtime_ns for f in names(path)}.items()
    # One of like size takes that run along, but not the large one.
    spread_rows(spark, 41_000, 42_000).where("k = 1").coalesce(1).write.mode("append").partitionBy("k").parquet(path)
    assert clustering.cluster_files(spark, path, columns, target) == 2
    assert first.items() <= {f: os.stat(f).st_mtime_ns for f in names(path)}.items()
    expected = spread_rows(spark, 0, 40_000).unionByName(spread_rows(spark, 40_000, 42_000).where("k = 1"))
    found = spark.read.parquet(path)
    assert found.exceptAll(expected.select(*found.columns)).isEmpty() and found.count() == 41_000
    # Other columns call for another order.
    assert clustering.cluster_files(spark, path, ["day"], target) == len(first) + 1


def test_clustering_of_nulls_ties_and_nothing(spark, tmp_path):
    path = str(tmp_path / "a=x y")
    nothing = "id long, t string, x double"
    spark.createDataFrame([], nothing).write.parquet(path)
    clustering.cluster_files(spark, path, ["id", "t", "x"])
    assert spark.read.parquet(path).count() == 0
    rows = spark.createDataFrame([(1, None, float("nan"))] * 50 + [(None, "", None)] * 50, nothing)
    rows.write.mode("append").parquet(path)
    clustering.cluster_files(spark, path, ["id", "t", "x"], 100)
    assert spark.read.parquet(path).exceptAll(rows).isEmpty() and spark.read.parquet(path).count() == 100


def test_cuts_follow_the_rows(spark):
    rows = spread_rows(spark, 0, 30_000)
    cuts = clustering.cut_points(rows, ["id", "t", "day"], 3)
    assert all(len(c) == 7 and c == sorted(c) for c in cuts.values())
    assert all(abs(c - 30_000 * n / 8) < 600 for n, c in enumerate(cuts["id"], 1))
    # Half of the rows with a text are hot: no other cell of the texts holds more than a fourth.
    cells = clustering.with_z(rows.where("t IS NOT NULL"), ["t"], 3).groupBy("_z").agg(F.count_if(F.col("t") != "hot").alias("n"))
    assert cells.agg(F.max("n")).first()[0] < rows.where("t IS NOT NULL").count() / 4
    assert clustering.cluster_bits(1, 2) == 3 and clustering.cluster_bits(10 ** 9, 2) == 10
