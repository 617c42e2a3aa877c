"""Record rules, the valid/invalid split and data-quality counts."""

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shoplake import params

# Columns a valid record always has.
REQUIRED = {"price", "event_type", "product_id", "user_id", "event_time", "category_id"}


def rules(
    price_min: Decimal = params.PRICE_MIN,
    price_max: Decimal = params.PRICE_MAX,
    event_types: tuple[str, ...] = params.EVENT_TYPES,
) -> dict[str, Column]:
    """Rule name to its predicate, which is null or false where the rule fails."""
    return {
        "price": F.col("price").between(F.lit(price_min), F.lit(price_max)),
        "event_type": F.col("event_type").isin(*event_types),
        "product_id": F.col("product_id") > 0,
        "user_id": F.col("user_id") > 0,
        "event_time": F.col("event_time").isNotNull(),
        "category_id": F.col("category_id") > 0,
    }

def _holds(check: Column) -> Column:
    return F.coalesce(check, F.lit(False))


def _all_hold(checks: Iterable[Column]) -> Column:
    return reduce(lambda left, right: left & right, checks)


def flag(events: DataFrame, **limits) -> DataFrame:
    """Adds one flag per rule, the overall flag and the comma-separated failures."""
    checks = rules(**limits)
    flags = {f"is_valid_{name}": _holds(check) for name, check in checks.items()}
    failures = [F.when(~F.col(f"is_valid_{name}"), F.lit(f"invalid_{name}")) for name in checks]
    passed = _all_hold(F.col(f"is_valid_{name}") for name in checks)
    return events.withColumns(flags).withColumns(
        {"is_valid_record": passed, "invalid_reasons": F.concat_ws(", ", *failures)}
    )


def fill_unknown(events: DataFrame) -> DataFrame:
    """Missing or empty category code and brand become ``unknown``."""
    return events.withColumns({
        name: F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(params.UNKNOWN))
        for name in ("category_code", "brand")
    })


def valid(events: DataFrame, **limits) -> DataFrame:
    """Records that pass every rule, in the input's columns.

    The rules stay plain comparisons here, so that scans can use them.
    """
    return fill_unknown(events.where(_all_hold(rules(**limits).values())))


def invalid(events: DataFrame, processed_at=None, **limits) -> DataFrame:
    """Records that fail a rule, with flags, reasons and the processing time."""
    when = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    flagged = flag(events, **limits)
    return flagged.where(~F.col("is_valid_record")).withColumn("processing_timestamp", when)


def quality_counts(events: DataFrame, **limits) -> DataFrame:
    """Total, valid, invalid and per-rule failure counts in one pass and one row."""
    checks = {name: _holds(check) for name, check in rules(**limits).items()}
    passed = _all_hold(checks.values())
    return events.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(passed).alias("valid_records"),
        F.count_if(~passed).alias("invalid_records"),
        *[F.count_if(~check).alias(f"invalid_{name}") for name, check in checks.items()],
    )


def quality_totals(events: DataFrame, **limits) -> DataFrame:
    return quality_counts(events, **limits).select(
        "total_records", "valid_records", "invalid_records"
    )


def failure_histogram(events: DataFrame, **limits) -> DataFrame:
    """Failure reason and number of records; reasons that never occur are left out."""
    reasons = [f"invalid_{name}" for name in rules(**limits)]
    return (
        quality_counts(events, **limits)
        .unpivot([], reasons, "reason", "record_count")
        .where(F.col("record_count") > 0)
    )
