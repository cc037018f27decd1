"""Verdicts joined back to the rows that asked for them, and the standardisation log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cleanroll.operators.sets import own_shuffle

# Fixed value: the reason recorded for every standardised number.
VERIFICATION_REASON = "50000001"


def stamp(run_ts):
    """The run's timestamp column: a given value, else the clock."""
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def land(
    verdicts: DataFrame,
    owners: DataFrame,
    on: Sequence[str],
    keep: Sequence[str],
    date_column: str | None = None,
    run_ts=None,
    null_safe: Sequence[str] = (),
    drop: Sequence[str] | None = None,
) -> DataFrame:
    """Each verdict with the `keep` keys of every owner that shares `on`.

    `verdicts` has one row per `on`, as `answers` gives it, and owners are reduced to
    their distinct keys before the join, so the rows are distinct without another
    pass over the wide result. Columns named in `null_safe` match NULL to NULL; the
    others never match NULL.
    """
    verdicts = own_shuffle(verdicts)
    asked = owners.select(*on, *[k for k in keep if k not in on]).distinct()
    right = own_shuffle(asked.select(*[F.col(c).alias(f"_{c}") if c in on else F.col(c) for c in asked.columns]))
    terms = [verdicts[c].eqNullSafe(F.col(f"_{c}")) if c in null_safe else verdicts[c] == F.col(f"_{c}") for c in on]
    joined = verdicts.join(right, reduce(lambda a, b: a & b, terms)).drop(*[f"_{c}" for c in on])
    landed = joined.drop(*(on if drop is None else drop))
    return landed if date_column is None else landed.withColumn(date_column, stamp(run_ts))


def standardisation_log(df: DataFrame, user: str, run_ts=None, reason: str = VERIFICATION_REASON) -> DataFrame:
    return df.select(
        F.col("person_phone_key").cast("string").alias("person_phone_key"),
        "standardised_phone_number",
        "is_valid_flag",
        F.lit(reason).alias("verification_reason_key"),
        "telephone_number",
        stamp(run_ts).alias("created_date"),
        F.lit(user).alias("created_user_id"),
        stamp(run_ts).alias("updated_date"),
        F.lit(user).alias("updated_user_id"),
    )
