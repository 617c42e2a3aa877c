"""Dashboard rollups and their mergeable states.

Every rollup comes in two forms. The exact form counts distinct users with
integers. The state form keeps sums and HLL sketches, so partial results of
several batches can be merged later; :func:`merge_states` does that.
"""

from pyspark.sql import Column, DataFrame, functions as F

from shoplake.functions.expressions import is_type, price_bucket, revenue

SKETCH_BITS = 12
DASHBOARD_WINDOW = "15 minutes"


def _count(event_type: str) -> Column:
    return F.count_if(is_type(event_type))


def _sketch(column: str, only: Column | None = None) -> Column:
    value = F.col(column) if only is None else F.when(only, F.col(column))
    return F.hll_sketch_agg(value, SKETCH_BITS)


# --- one row per day -------------------------------------------------------

def daily_kpi(events: DataFrame) -> DataFrame:
    """Daily KPIs with exact users and buyers: fold to user days, then count rows."""
    per_user = events.withColumn("event_date", F.to_date("event_time")).groupBy(
        "event_date", "user_id"
    ).agg(
        revenue().alias("revenue"),
        _count("purchase").alias("purchases"),
        _count("view").alias("views"),
        _count("cart").alias("carts"),
    )
    return per_user.groupBy("event_date").agg(
        F.sum("revenue").cast("decimal(20,2)").alias("total_revenue"),
        F.sum("purchases").alias("total_purchases"),
        F.sum("views").alias("total_views"),
        F.sum("carts").alias("total_carts"),
        F.count("user_id").alias("daily_unique_users"),
        F.count_if((F.col("purchases") > 0) & F.col("user_id").isNotNull()).alias("unique_users_buy"),
    )


def daily_kpi_states(events: DataFrame) -> DataFrame:
    return events.groupBy(F.to_date("event_time").alias("event_date")).agg(
        revenue().alias("total_revenue"),
        _count("purchase").alias("total_purchases"),
        _count("view").alias("total_views"),
        _count("cart").alias("total_carts"),
        _sketch("user_id").alias("daily_unique_users"),
        _sketch("user_id", is_type("purchase")).alias("unique_users_buy"),
    )


# --- one row per day and product -------------------------------------------

def product_performance(events: DataFrame) -> DataFrame:
    return events.groupBy(
        F.to_date("event_time").alias("event_date"), "category_code", "brand", "product_id"
    ).agg(
        _count("view").alias("total_views"),
        _count("cart").alias("total_carts"),
        _count("purchase").alias("total_purchases"),
        revenue().alias("total_revenue"),
    )


# --- one row per 15 minutes ------------------------------------------------

def _dashboard_sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_events"),
        _count("view").alias("views"),
        _count("cart").alias("add_to_carts"),
        _count("purchase").alias("purchases"),
        revenue().alias("revenue_15min"),
    ]


def realtime_dashboard(events: DataFrame, width: str = DASHBOARD_WINDOW) -> DataFrame:
    """15-minute counts with exact users and sessions.

    Visits are folded first, as in the daily gold aggregate. The average order
    value is kept as its sum (``revenue_15min``) and count (``purchases``).
    """
    slotted = events.withColumn("metric_time", F.window("event_time", width)["start"])
    per_visit = slotted.groupBy("metric_time", "user_session", "user_id").agg(*_dashboard_sums())
    return per_visit.groupBy("metric_time").agg(
        F.sum("total_events").alias("total_events"),
        F.sum("views").alias("views"),
        F.sum("add_to_carts").alias("add_to_carts"),
        F.sum("purchases").alias("purchases"),
        F.sum("revenue_15min").cast("decimal(20,2)").alias("revenue_15min"),
        F.count_distinct("user_id").alias("active_users"),
        F.count_distinct("user_session").alias("active_sessions"),
    )


def realtime_dashboard_states(events: DataFrame, width: str = DASHBOARD_WINDOW) -> DataFrame:
    return (
        events.groupBy(F.window("event_time", width).alias("slot"))
        .agg(
            *_dashboard_sums(),
            _sketch("user_id").alias("active_users"),
            _sketch("user_session").alias("active_sessions"),
        )
        .withColumn("metric_time", F.col("slot.start"))
        .drop("slot")
    )


# --- one row per day and price bucket --------------------------------------

def price_bucket_performance(events: DataFrame) -> DataFrame:
    """Views and purchases by price bucket; other event types are left out."""
    return (
        events.where(F.col("event_type").isin("view", "purchase"))
        .groupBy(
            F.to_date("event_time").alias("event_date"),
            price_bucket(F.col("price")).alias("price_bucket"),
        )
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            revenue().alias("total_revenue"),
            _count("purchase").alias("total_purchases"),
        )
    )


# --- one row per session ---------------------------------------------------

def _with_duration(sessions: DataFrame) -> DataFrame:
    """Adds the session's date and its length in whole clock seconds."""
    start, end = F.col("session_start_time"), F.col("session_end_time")
    return sessions.withColumns({
        "event_date": F.to_date(start),
        "session_duration_sec": F.unix_timestamp(end) - F.unix_timestamp(start),
    })


def session_summary(events: DataFrame) -> DataFrame:
    return _with_duration(
        events.groupBy("user_session", "user_id").agg(
            F.min("event_time").alias("session_start_time"),
            F.max("event_time").alias("session_end_time"),
            F.max(F.when(is_type("purchase"), 1).otherwise(0)).alias("has_purchase"),
            F.count(F.lit(1)).alias("total_events"),
        )
    )


def visits(events: DataFrame, gap: str) -> DataFrame:
    """Sessions cut where no event follows within ``gap``, its end included; batch or, with a watermark, stream."""
    window = F.session_window("event_time", gap).alias("visit")
    found = events.groupBy(window, "user_session", "user_id").agg(
        F.min("event_time").alias("session_start_time"),
        F.max("event_time").alias("session_end_time"),
        F.max(F.when(is_type("purchase"), 1).otherwise(0)).alias("has_purchase"),
        F.count(F.lit(1)).alias("total_events"),
    )
    return _with_duration(found.drop("visit"))


# --- sets of users ---------------------------------------------------------

def user_set_states(events: DataFrame) -> DataFrame:
    """One row per day with theta sketches of its users, viewers and buyers, which can be intersected."""
    def users(only: Column | None = None) -> Column:
        return F.theta_sketch_agg(F.col("user_id") if only is None else F.when(only, F.col("user_id")))

    return events.groupBy(F.to_date("event_time").alias("event_date")).agg(
        users().alias("users"), users(is_type("view")).alias("viewers"), users(is_type("purchase")).alias("buyers"))


def merge_user_sets(states: DataFrame) -> DataFrame:
    """Merges states of several batches to one row per day."""
    return states.groupBy("event_date").agg(*[F.theta_union_agg(c).alias(c) for c in ("users", "viewers", "buyers")])


def returning_users(states: DataFrame) -> DataFrame:
    """Per day: estimated users who also came the day before, and viewers who bought nothing that day.

    ``states`` has one row per day. The day before is joined, so days without events break no chain.
    """
    before = states.select(F.date_add("event_date", 1).alias("event_date"), F.col("users").alias("users_before"))
    return states.join(before, "event_date", "left").select(
        "event_date", F.theta_sketch_estimate("users").alias("users"),
        F.coalesce(F.theta_sketch_estimate(F.theta_intersection("users", "users_before")), F.lit(0)).alias("returning_users"),
        F.theta_sketch_estimate(F.theta_difference("viewers", "buyers")).alias("viewers_only"))


def returning_users_exact(events: DataFrame) -> DataFrame:
    """The same numbers from the events: folded to user days, each joined with its day before."""
    days = events.groupBy(F.to_date("event_time").alias("event_date"), "user_id").agg(
        F.max(is_type("view")).alias("viewed"), F.max(is_type("purchase")).alias("bought"))
    before = days.select(F.date_add("event_date", 1).alias("event_date"), "user_id", F.lit(1).alias("came"))
    return days.join(before, ["event_date", "user_id"], "left").groupBy("event_date").agg(
        F.count("user_id").alias("users"), F.count("came").alias("returning_users"),
        F.count_if(F.col("viewed") & ~F.col("bought")).alias("viewers_only"))


# --- merging partial states ------------------------------------------------

ROLLUPS = {
    "daily": daily_kpi_states,
    "product": product_performance,
    "dashboard": realtime_dashboard_states,
    "bucket": price_bucket_performance,
    "session": session_summary,
}

KEYS = {
    "daily": ("event_date",),
    "product": ("event_date", "category_code", "brand", "product_id"),
    "dashboard": ("metric_time",),
    "bucket": ("event_date", "price_bucket"),
    "session": ("user_session", "user_id"),
}

_SKETCHES = {"daily_unique_users", "unique_users_buy", "active_users", "active_sessions"}
_REVENUES = {"total_revenue", "revenue_15min"}


def _merged(column: str) -> Column:
    if column in _SKETCHES:
        return F.hll_union_agg(column).alias(column)
    if column in _REVENUES:
        return F.sum(column).cast("decimal(20,2)").alias(column)
    if column == "session_start_time":
        return F.min(column).alias(column)
    if column in ("session_end_time", "has_purchase"):
        return F.max(column).alias(column)
    return F.sum(column).alias(column)


def merge_states(states: DataFrame, rollup: str) -> DataFrame:
    """Merges partial states of the named rollup to one row per key.

    Columns other than the rollup's own (a batch id, say) are dropped.
    """
    keys = KEYS[rollup]
    own = {
        "daily": ("total_revenue", "total_purchases", "total_views", "total_carts",
                  "daily_unique_users", "unique_users_buy"),
        "product": ("total_views", "total_carts", "total_purchases", "total_revenue"),
        "dashboard": ("total_events", "views", "add_to_carts", "purchases", "revenue_15min",
                      "active_users", "active_sessions"),
        "bucket": ("total_events", "total_revenue", "total_purchases"),
        "session": ("session_start_time", "session_end_time", "has_purchase", "total_events"),
    }[rollup]
    merged = states.groupBy(*keys).agg(*[_merged(c) for c in own])
    return _with_duration(merged) if rollup == "session" else merged


def estimate_sketches(merged: DataFrame) -> DataFrame:
    """Replaces sketches by their distinct-count estimates."""
    present = [c for c in merged.columns if c in _SKETCHES]
    return merged.withColumns({c: F.hll_sketch_estimate(c) for c in present})
