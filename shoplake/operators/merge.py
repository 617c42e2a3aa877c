"""Keyed merge of new rows into existing rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

GUARD_NEWER = "source.event_time >= target.event_time"


def _same_key(keys: tuple[str, ...]) -> Column:
    pairs = [F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys]
    return reduce(lambda left, right: left & right, pairs)


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: tuple[str, ...],
    update_condition: str | None = None,
    insert_condition: str | None = None,
    delete_condition: str | None = None,
) -> DataFrame:
    """Target after updating matched rows and inserting unmatched source rows.

    The conditions are SQL over ``source.`` and ``target.`` columns; a null
    condition does not hold and null keys match nothing. ``source`` must hold
    one row per key and is read three times.

    The target stands on the left of its joins, so a small source is broadcast
    and the target is not shuffled at all; otherwise AQE can split a hot key of
    the target. What to insert is found from the matched keys, which are no
    more than the source has.
    """
    columns = target.columns
    old, new = target.alias("target"), source.alias("source")

    def holds(condition: str | None) -> Column:
        return F.lit(True) if condition is None else F.coalesce(F.expr(condition), F.lit(False))

    joined = old.join(new, _same_key(keys), "left")
    matched = F.col(f"source.{keys[0]}").isNotNull()
    if delete_condition is not None:
        joined = joined.where(~(matched & holds(delete_condition)))
    replace = matched & holds(update_condition)
    kept = joined.select(*[
        F.col(f"target.{c}") if c in keys
        else F.when(replace, F.col(f"source.{c}")).otherwise(F.col(f"target.{c}")).alias(c)
        for c in columns
    ])

    matched_keys = old.join(new, _same_key(keys), "left_semi").select(*keys).distinct()
    fresh = new.join(matched_keys.alias("target"), _same_key(keys), "left_anti")
    if insert_condition is not None:
        fresh = fresh.where(holds(insert_condition))
    return kept.unionByName(fresh.select(*columns))
