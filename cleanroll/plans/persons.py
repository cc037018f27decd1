"""Person match and person detail."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cleanroll.functions.periods import DAY, changed_in, with_time
from cleanroll.functions.text import detail_request, match_request
from cleanroll.operators.fanout import staged_fan_out, tables_of
from cleanroll.operators.landing import land
from cleanroll.operators.providers import flatten_person_match, parse_person_detail, person_detail_fan_out, person_detail_targets
from cleanroll.operators.sets import distinct_keys, not_in, not_recent, own_shuffle
from cleanroll.session import stage
from cleanroll.sources.answers import answers

MATCH, DETAIL = "person_match", "person_detail"
NAME_AND_EMAIL = ("first_name", "last_name", "email_address")


def match_owners(batch: DataFrame, bridged: DataFrame, emails: DataFrame, run_date, grain: str = DAY) -> DataFrame:
    """Persons of the period that are not enriched yet, with each of their emails."""
    persons = with_time(batch, "person_updated_date", "person_key", "first_name", "last_name")
    changed = changed_in(persons, "person_updated_date", run_date, grain).drop("person_updated_date").distinct()
    fresh = own_shuffle(not_in(changed, "person_key", bridged))
    return fresh.join(emails.select("person_key", "email_address"), "person_key")


def person_matches(owners: DataFrame, landed: DataFrame, fetched_since=None) -> DataFrame:
    wanted = distinct_keys(owners, *NAME_AND_EMAIL)
    keys = wanted.withColumn("request_key", match_request(*[F.col(c) for c in NAME_AND_EMAIL]))
    return flatten_person_match(answers(keys, landed, MATCH, fetched_since), *NAME_AND_EMAIL)


def person_match(matches: DataFrame, owners: DataFrame) -> DataFrame:
    """Matches with the person keys that share all three request fields; a NULL name never matches."""
    return land(matches, owners, list(NAME_AND_EMAIL), ["person_key"], drop=[])


def detail_ids(matches: DataFrame, persons: DataFrame, run_date, days: int) -> DataFrame:
    """Matched person ids, distinct, that were not updated recently."""
    ids = distinct_keys(matches.select(F.col("personId").alias("person_id")), "person_id")
    return not_recent(ids, "person_id", persons, run_date=run_date, days=days)


def person_details(ids: DataFrame, landed: DataFrame, fetched_since=None) -> DataFrame:
    """Parsed bodies of the ids, one row per person with an id of its own."""
    wanted = distinct_keys(ids.where(F.col("person_id").isNotNull()), "person_id")
    keys = wanted.withColumn("request_key", detail_request(F.col("person_id")))
    return parse_person_detail(answers(keys, landed, DETAIL, fetched_since))


def person_detail(details: DataFrame, staged: bool = True, stage=stage) -> dict[str, DataFrame]:
    """Parent and children. Staged, the bodies are fetched, parsed and fanned out once for all eight tables, and each
    table reads its own rows alone."""
    fanned = person_detail_fan_out(details)
    return tables_of(staged_fan_out(fanned, "person_details", stage) if staged else fanned, person_detail_targets())
