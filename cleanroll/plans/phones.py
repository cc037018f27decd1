"""Phone hygiene: standardised candidates, verdicts, escalation, reverse look-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cleanroll.functions.periods import DAY, changed_in, with_time
from cleanroll.functions.phones import PLAN, standardise
from cleanroll.functions.text import owner_request, phone_request, reverse_request
from cleanroll.operators.joins import resolve_country
from cleanroll.operators.landing import land
from cleanroll.operators.providers import (
    flatten_phone_exchange,
    flatten_phone_owner,
    flatten_phone_reverse,
    flatten_phone_verdict,
)
from cleanroll.operators.sets import distinct_keys, not_recent, only_in
from cleanroll.sources.answers import answers

VERDICT, EXCHANGE, REVERSE, OWNER = "phone", "phone_exchange", "phone_reverse", "phone_owner"
# Result codes that send a number to the second provider.
ESCALATION_CODES = ("PS02", "PS16")
DATE = "phone_verification_date"
NUMBER = "standardised_phone_number"
COLUMNS = ["person_phone_key", "telephone_number", "country_code", NUMBER, "is_valid_flag"]


def escalates(results: Column) -> Column:
    """A substring test, not a token test."""
    first, second = ESCALATION_CODES
    return results.contains(first) | results.contains(second)


def _outside_cooldown(numbers: DataFrame, histories, run_date, days: int) -> DataFrame:
    renamed = [with_time(h, "updated_date", F.col("phone_number").alias(NUMBER)) for h in histories]
    return not_recent(numbers, NUMBER, *renamed, run_date=run_date, days=days)


def phone_candidates(
    batch: DataFrame, phones: DataFrame, bridge: DataFrame, address: DataFrame, synonyms: DataFrame,
    *histories: DataFrame, run_date, days: int, grain: str = DAY, plan=PLAN,
) -> DataFrame:
    """Phones of the batch changed in the period, read by the country of each address, outside the cool-down.

    A person with several addresses in one country gives one row per phone, not one per address.
    """
    known = phones.where(F.col("telephone_number").isNotNull())
    master = with_time(known, "updated_date", "person_key", "telephone_number", "person_phone_key")
    changed = changed_in(master, "updated_date", run_date, grain)
    owned = only_in(changed, "person_key", batch)
    located = resolve_country(owned, bridge, address, synonyms)
    asked = located.select("person_phone_key", "telephone_number", "country_code").distinct()
    return _outside_cooldown(standardise(asked, "telephone_number", "country_code", plan).select(*COLUMNS), histories, run_date, days)


def phone_candidates_enriched(
    phones: DataFrame, *histories: DataFrame, run_date, days: int, grain: str = DAY, plan=PLAN
) -> DataFrame:
    """Enrichment phones changed in the period; no country is known, so the default region reads them."""
    master = with_time(
        phones.where(F.col("phone_number").isNotNull()),
        "updated_date",
        F.col("enrichment_api_person_key").alias("person_key"),
        F.col("phone_number").alias("telephone_number"),
        F.col("enrichment_api_person_phone_key").alias("person_phone_key"),
    )
    changed = changed_in(master, "updated_date", run_date, grain)
    asked = changed.withColumn("country_code", F.lit(None).cast("string"))
    return _outside_cooldown(standardise(asked, "telephone_number", None, plan).select(*COLUMNS), histories, run_date, days)


def phone_verdicts(candidates: DataFrame, landed: DataFrame, fetched_since=None) -> DataFrame:
    """Verdict per distinct (number, country)."""
    numbers = distinct_keys(candidates, NUMBER, "country_code")
    request = phone_request(F.col(NUMBER), F.col("country_code"))
    keys = numbers.withColumn("request_key", request)
    return flatten_phone_verdict(answers(keys, landed, VERDICT, fetched_since), NUMBER, "country_code")


def phone_landing(verdicts: DataFrame, candidates: DataFrame, run_ts=None) -> DataFrame:
    """Verdicts by number and country, so equal digits in two countries do not mix."""
    return land(
        verdicts, candidates, [NUMBER, "country_code"], ["person_phone_key"], DATE, run_ts, null_safe=["country_code"]
    )


def escalation_owners(staged: DataFrame, history: DataFrame, run_date, days: int) -> DataFrame:
    """Staged rows with an escalation code whose phone key is outside the cool-down."""
    hit = staged.where(escalates(F.col("Results"))).select("person_phone_key", "PhoneNumber")
    return not_recent(hit, "person_phone_key", history, run_date=run_date, days=days)


def phone_escalation(
    staged: DataFrame, history: DataFrame, landed: DataFrame, run_date, days: int,
    run_ts=None, fetched_since=None,
) -> DataFrame:
    """Exchange data for the escalated numbers of this run. No hit, no rows: nothing has to be counted first."""
    owners = escalation_owners(staged, history, run_date, days).withColumnRenamed("PhoneNumber", "Phone_Number")
    numbers = distinct_keys(owners, "Phone_Number")
    keys = numbers.withColumn("request_key", phone_request(F.col("Phone_Number")))
    verdicts = flatten_phone_exchange(answers(keys, landed, EXCHANGE, fetched_since), "Phone_Number")
    return land(verdicts, owners, ["Phone_Number"], ["person_phone_key"], DATE, run_ts)


def reverse_candidates(batch: DataFrame, phones: DataFrame, history: DataFrame, run_date, days: int, plan=PLAN) -> DataFrame:
    """All phones of the batch outside the cool-down, read as numbers of the default region."""
    owned = only_in(phones.select("person_phone_key", "telephone_number", "person_key"), "person_key", batch)
    fresh = not_recent(owned, "person_phone_key", history, run_date=run_date, days=days)
    return standardise(fresh, "telephone_number", None, plan).select("person_phone_key", "telephone_number", NUMBER, "is_valid_flag")


def reverse_lookup(
    candidates: DataFrame, landed: DataFrame, run_ts=None, fetched_since=None
) -> DataFrame:
    numbers = distinct_keys(candidates, NUMBER)
    keys = numbers.withColumn("request_key", reverse_request(F.col(NUMBER)))
    verdicts = flatten_phone_reverse(answers(keys, landed, REVERSE, fetched_since), NUMBER)
    return land(verdicts, candidates, [NUMBER], ["person_phone_key"], DATE, run_ts)


def reverse_escalation_candidates(staged: DataFrame, history: DataFrame, run_date, days: int, plan=PLAN) -> DataFrame:
    """Staged reverse rows with an escalation code, outside the cool-down, standardised again."""
    owners = escalation_owners(staged, history, run_date, days).withColumnRenamed("PhoneNumber", "telephone_number")
    return standardise(owners, "telephone_number", None, plan).select("person_phone_key", "telephone_number", NUMBER, "is_valid_flag")


def reverse_escalation(
    candidates: DataFrame, landed: DataFrame, run_ts=None, fetched_since=None
) -> DataFrame:
    """Owner data per number; the number itself stays, as `phonenumber`."""
    owners = candidates.withColumnRenamed(NUMBER, "phonenumber")
    numbers = distinct_keys(owners, "phonenumber")
    keys = numbers.withColumn("request_key", owner_request(F.col("phonenumber")))
    verdicts = flatten_phone_owner(answers(keys, landed, OWNER, fetched_since), "phonenumber")
    return land(verdicts, owners, ["phonenumber"], ["person_phone_key"], DATE, run_ts, drop=[])
