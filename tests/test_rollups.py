from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shoplake.operators import gold, rollups, working
from shoplake.plans import dashboards, warehouse
from shoplake.registry.base import valid_events


def test_price_bucket_edges(events):
    rows = events(*[{"price": p} for p in ("10.00", "10.01", "50.00", "50.01", "200.00", "200.01")], {"event_type": "cart"})
    found = {r.price_bucket: r.total_events for r in rollups.price_bucket_performance(rows).collect()}
    assert found == {"0-10$": 1, "11-50$": 2, "51-200$": 2, ">200$": 1}


def test_session_over_midnight_and_single_event(events):
    rows = events(
        {"event_time": datetime(2024, 1, 1, 23, 59, 59, 900000)},
        {"event_time": datetime(2024, 1, 2, 0, 0, 0, 100000), "event_type": "purchase"},
        {"user_session": "s2"})
    found = {r.user_session: r for r in rollups.session_summary(rows).collect()}
    assert (found["s1"].event_date, found["s1"].session_duration_sec, found["s1"].has_purchase) == (date(2024, 1, 1), 1, 1)
    assert (found["s2"].session_duration_sec, found["s2"].has_purchase, found["s2"].total_events) == (0, 0, 1)


@pytest.mark.parametrize("name", sorted(rollups.ROLLUPS))
def test_merged_parts_equal_the_whole(spark, sf_dir, name):
    rows = valid_events(spark, sf_dir).persist()
    half = F.pmod(F.xxhash64("event_id"), F.lit(3))
    parts = [rollups.ROLLUPS[name](rows.where(half == n)).withColumn("batch_id", F.lit(n)) for n in range(3)]
    states = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = rollups.estimate_sketches(rollups.merge_states(states, name))
    whole = rollups.estimate_sketches(rollups.merge_states(rollups.ROLLUPS[name](rows), name))
    assert merged.exceptAll(whole.select(*merged.columns)).count() == 0
    assert merged.count() == whole.count()
    rows.unpersist()


def test_sketches_stay_close_to_exact_counts(spark):
    rows = spark.range(200_000).select(
        F.lit(datetime(2024, 1, 1)).alias("event_time"), (F.col("id") % 50_000).alias("user_id"),
        F.lit("purchase").alias("event_type"), F.lit(Decimal("1.00")).alias("price"))
    estimate = rollups.estimate_sketches(rollups.daily_kpi_states(rows)).first()
    assert abs(estimate.daily_unique_users - 50_000) < 50_000 * 0.05
    assert rollups.daily_kpi(rows).first().daily_unique_users == 50_000


def test_dashboard_slots_add_up_to_days(spark, sf_dir):
    rows = valid_events(spark, sf_dir)
    slots = rollups.realtime_dashboard(rows).groupBy(F.to_date("metric_time").alias("event_date")).agg(
        F.sum("purchases").alias("n"), F.sum("revenue_15min").alias("r"))
    days = rollups.daily_kpi(rows).select("event_date", F.col("total_purchases").alias("n"), F.col("total_revenue").alias("r"))
    assert slots.exceptAll(days).count() == 0 and days.exceptAll(slots).count() == 0


def test_missing_users_do_not_count(events):
    rows = events({"user_id": None, "event_type": "purchase"}, {"user_id": 1})
    kpi = rollups.daily_kpi(rows).first()
    assert (kpi.daily_unique_users, kpi.unique_users_buy, kpi.total_purchases) == (1, 0, 1)
    day = gold.agg_daily_events(working.prepare(rows)).first()
    assert (day.total_events, day.total_users, day.total_sessions) == (2, 1, 1)


def test_kpi_report_leaves_out_days_without_carts(events):
    rows = events({"event_type": "purchase"}, {"event_type": "cart", "event_time": datetime(2024, 1, 2)})
    report = dashboards.daily_kpi_report(rollups.daily_kpi(rows)).collect()
    assert [str(r.event_date) for r in report] == ["2024-01-02"]
    assert (report[0].User_Conversion_Rate_Percent, report[0].Daily_AOV) == (0, 0)


def test_realtime_window_and_missing_orders(events):
    rows = events(*[{"event_time": datetime(2024, 1, 1, h)} for h in (1, 5, 11)])
    now = F.lit(datetime(2024, 1, 1, 11))
    report = dashboards.realtime(rollups.realtime_dashboard(rows), now).collect()
    assert [r.metric_time.hour for r in report] == [11, 5]
    assert report[0].Realtime_AOV is None


def test_latest_attributes_win_and_ties_are_stable(events):
    at = datetime(2024, 1, 1, 10)
    rows = working.prepare(events(
        {"brand": "old", "event_time": at}, {"brand": "b", "event_time": at + timedelta(hours=1)},
        {"brand": "a", "event_time": at + timedelta(hours=1), "event_type": "purchase", "price": "3.10"}))
    row = gold.agg_product_daily(rows).collect()[0]
    assert (row.brand, row.views, row.purchases, row.revenue) == ("b", 2, 1, Decimal("3.10"))
    assert gold.product_last_attrs(rows).collect()[0].brand == "b"


def test_ratios_without_views_or_purchases(events):
    rows = working.prepare(events({"event_type": "cart"}, {"event_type": "cart"}))
    products = gold.agg_product_daily(rows)
    row = warehouse.conversion_ranking(products, date(2024, 1, 1), min_views=0).collect()[0]
    assert (row.total_views, row.conversion_rate_pct, row.cart_rate_pct) == (0, None, None)
    assert warehouse.category_brand(products, date(2024, 1, 1)).collect()[0].avg_order_value is None


def test_percentages_above_a_thousand(events):
    rows = working.prepare(events({}, *[{"event_type": "purchase"}] * 15))
    row = warehouse.conversion_ranking(gold.agg_product_daily(rows), date(2024, 1, 1), min_views=1).first()
    assert row.conversion_rate_pct == Decimal("1500.00")


def test_reconcile_reports_days_without_facts(spark, events):
    rows = working.prepare(events({}, {"product_id": 2, "event_time": datetime(2024, 1, 2)}))
    daily = gold.agg_daily_events(rows)
    report = warehouse.reconcile(daily, rows.where("event_date = '2024-01-01'"), date(2024, 1, 2)).collect()
    assert [(str(r.event_date), r.unique_products_in_fact) for r in report] == [("2024-01-02", 0), ("2024-01-01", 1)]
