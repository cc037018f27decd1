"""The same results written the plain way, to time beside the registered queries.

Text prefix on the date, set difference of keys then a join back, outer join then
distinct: what a first version does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cleanroll.functions.emails import valid_email
from standins.registry import Tables


def _without_recent(df: DataFrame, key: str, history: DataFrame) -> DataFrame:
    recent = history.where("updated_date >= '2001-07-16'").select(key)
    return df.join(df.select(key).subtract(recent), key)


def anti_join_cooldown(t: Tables) -> DataFrame:
    return _without_recent(t.person_email, "person_email_key", t.email_history).select("person_email_key", "person_key")


def filter_changed_in_period(t: Tables) -> DataFrame:
    return t.person_email.where("cast(updated_date as string) like '2001-07%'").select("person_email_key", "updated_date")


def email_candidates(t: Tables) -> DataFrame:
    rows = t.email_batch.join(t.person_email, "person_email_key").where("cast(updated_date as string) like '2001-07%'")
    fresh = _without_recent(rows, "person_email_key", t.email_history).where(valid_email(F.col("email_address")))
    return fresh.select("email_address").distinct().subtract(t.junk)


def join_left_residual(t: Tables) -> DataFrame:
    pairs = t["lineitem"].join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_nationkey").alias("c"), F.lit(30000031).alias("t"), (F.col("l_orderkey") % 400).alias("a")
    )
    b = t.company_bridge
    on = (F.col("c") == b["enrichment_api_company_key"]) & (F.col("t") == b["address_type_key"]) & (F.col("a") != b["address_key"])
    flag = F.when(b["enrichment_api_company_key"].isNull(), 0).otherwise(1).alias("update_flag")
    return pairs.join(b, on, "left").select("c", "t", "a", flag).distinct()


PLAIN = {f.__name__: f for f in (anti_join_cooldown, filter_changed_in_period, email_candidates, join_left_residual)}
