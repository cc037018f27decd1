"""Provider answers: landed responses joined to the keys a run asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cleanroll.operators.sets import only_in
from cleanroll.sources.current import CurrentAnswers

# Fixed value: the only status whose body counts as an answer.
STATUS_OK = 200


def good_answers(landed: DataFrame, provider: str, fetched_since=None) -> DataFrame:
    """The provider's rows with a body that counts.

    With `landed` partitioned by provider and fetch date, `provider` and
    `fetched_since` prune the scan to the run's own answers.
    """
    good = (F.col("provider") == provider) & (F.col("status") == STATUS_OK) & F.col("body").isNotNull()
    if fetched_since is not None:
        good = good & (F.col("fetched_at") >= F.lit(fetched_since).cast(landed.schema["fetched_at"].dataType))
    return landed.where(good)


def newest(good: DataFrame) -> DataFrame:
    """`(request_key, fetched_at, body)`: the newest body of each key, combined map-side; of equal times the greatest body."""
    answer = F.max(F.struct("fetched_at", "body"))
    return good.groupBy("request_key").agg(answer.alias("a")).select("request_key", "a.fetched_at", "a.body")


def latest_bodies(landed: DataFrame, provider: str, fetched_since=None) -> DataFrame:
    """`(request_key, body)` of every key that has a good answer."""
    return newest(good_answers(landed, provider, fetched_since)).drop("fetched_at")


def answers(keys: DataFrame, landed: DataFrame | CurrentAnswers, provider: str, fetched_since=None, after: str | None = None) -> DataFrame:
    """`keys` (with `request_key`) plus `body`; a key without a good answer yields no row.

    `landed` is the table of all landed responses, whose bodies the run's keys reduce before any is sorted or grouped, or
    the table of current answers, which holds one a key. `after` names a timestamp column of `keys`: only an answer
    fetched later than it counts, and the column is dropped.
    """
    if isinstance(landed, CurrentAnswers):
        found = landed.answers(keys, provider, fetched_since)
    else:
        asked = only_in(good_answers(landed, provider, fetched_since), "request_key", keys)
        found = keys.join(newest(asked), "request_key")
    if after is not None:
        found = found.where(F.col("fetched_at") > F.col(after)).drop(after)
    return found.drop("fetched_at")
