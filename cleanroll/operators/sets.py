"""Set logic that keeps multiplicity and NULL rules, and survives hot keys."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cleanroll.functions.periods import since, with_time

# More partitions than any shuffle has, so `coalesce` keeps all of them.
ALL_PARTITIONS = 1 << 30


def own_shuffle(df: DataFrame) -> DataFrame:
    """`df` with its partitioning forgotten, at no cost.

    A grouped side whose grouping key is the join key would feed the join without a
    shuffle of its own. Adaptive execution splits a hot key of the other side only
    when both sides come straight from a shuffle, so the grouped side, one row per
    key by now, is made to take one.
    """
    return df.coalesce(ALL_PARTITIONS)


def unique_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Each non-NULL key of `df` once, for the right side of semi and anti joins.

    The distinct is combined map-side: a key that fills a third of `df` leaves each
    task once, and the join sees it once.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return own_shuffle(df.select(*keys).where(present).distinct())


def only_in(df: DataFrame, key: str, others: DataFrame) -> DataFrame:
    """Rows of `df` whose `key` is in `others`; repeats in `others` add no rows."""
    return df.join(unique_keys(others, key), key, "left_semi")


def not_in(df: DataFrame, key: str, others: DataFrame) -> DataFrame:
    """Rows of `df` whose non-NULL `key` is not in `others`; multiplicity is kept."""
    return df.where(F.col(key).isNotNull()).join(unique_keys(others, key), key, "left_anti")


def union_histories(*histories: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, histories)


def recent_keys(
    key: str, *histories: DataFrame, run_date, days: int, ts_col: str = "updated_date"
) -> DataFrame:
    """The keys of all histories since `run_date + days`, with repeats.

    Each history has `key` and `ts_col`. The date filter runs on each history before
    the union, so it reaches every scan, and the partitions of a history that has them.
    """
    return union_histories(*[since(with_time(h, ts_col, key), ts_col, run_date, days).select(key) for h in histories])


def not_recent(
    df: DataFrame, key: str, *histories: DataFrame, run_date, days: int, ts_col: str = "updated_date"
) -> DataFrame:
    """Rows whose key was not seen in any history since `run_date + days`."""
    return not_in(df, key, recent_keys(key, *histories, run_date=run_date, days=days, ts_col=ts_col))


def due_keys(
    batch: DataFrame, key: str, *histories: DataFrame, run_date, days: int, ts_col: str = "updated_date"
) -> DataFrame:
    """The distinct non-NULL keys of a batch that were not seen since `run_date + days`.

    Both sides are distinct on the join key, so they meet without another shuffle
    and the master rows then need one semi join instead of a semi and an anti join.
    """
    recent = recent_keys(key, *histories, run_date=run_date, days=days, ts_col=ts_col)
    asked = batch.select(key).where(F.col(key).isNotNull()).distinct()
    return asked.join(recent.where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def minus_distinct(df: DataFrame, other: DataFrame) -> DataFrame:
    """Distinct rows of `df` that are not in `other`, compared by position; NULL equals NULL.

    Both sides are made distinct before they meet, so no repeated row reaches the
    join (`subtract` joins first and makes distinct afterwards).
    """
    right = other.toDF(*[f"_{c}" for c in df.columns]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in df.columns])
    return df.distinct().join(right, same, "left_anti")


def union_by_position(*frames: DataFrame) -> DataFrame:
    """Bag union by column position; the first frame names the columns."""
    names = frames[0].columns
    return reduce(DataFrame.unionByName, [f.toDF(*names) for f in frames])


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def cap(df: DataFrame, *keys: str, n: int) -> DataFrame:
    """A trial's first `n` rows by `keys`, repeatable. No job uses it: it would drop requests."""
    return df.orderBy(*keys).limit(n)


def candidate_funnel(stages: Mapping[str, DataFrame]) -> DataFrame:
    """`(stage, rows)` for each named stage of a dataflow."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows") for name, df in stages.items()]
    return reduce(DataFrame.unionByName, counts)
