"""Email verification: candidates, verdicts, landing, rerun."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cleanroll.functions.emails import valid_email
from cleanroll.functions.periods import DAY, changed_in, with_time
from cleanroll.functions.text import email_request
from cleanroll.operators.landing import land
from cleanroll.operators.providers import flatten_email_verdict
from cleanroll.operators.sets import distinct_keys, due_keys, minus_distinct, only_in
from cleanroll.sources.answers import answers

PROVIDER = "email"
# The status pair whose emails are asked for again.
RERUN_STATUS = "220"
RERUN_CODE = "222"
DATE = "email_verification_date"


def email_owners(batch: DataFrame, emails: DataFrame, history: DataFrame, run_date, days: int, grain: str = DAY) -> DataFrame:
    """Emails of the batch changed in the period, not verified recently, and well formed.

    These rows own the verdicts on landing. The validity test needs only the email
    itself, so it runs before the joins; the batch carries no columns, so it only filters.
    """
    master = with_time(emails, "updated_date", "person_key", "email_address", "person_email_key")
    changed = changed_in(master, "updated_date", run_date, grain).where(valid_email(F.col("email_address")))
    due = due_keys(batch, "person_email_key", history, run_date=run_date, days=days)
    return only_in(changed, "person_email_key", due)


def email_candidates(owners: DataFrame, junk: DataFrame) -> DataFrame:
    """The distinct emails to verify: those of `owners` that are not junk."""
    return minus_distinct(distinct_keys(owners, "email_address"), junk.select("email_address"))


def enrichment_as_master(emails: DataFrame) -> DataFrame:
    """The enrichment email table under the master's column names, without NULL emails."""
    return with_time(
        emails.where(F.col("email").isNotNull()),
        "updated_date",
        F.col("enrichment_api_person_key").alias("person_key"),
        F.col("email").alias("email_address"),
        F.col("enrichment_api_person_email_key").alias("person_email_key"),
    )


def enriched_email_owners(
    batch: DataFrame, emails: DataFrame, history: DataFrame, enriched_history: DataFrame, run_date, days: int, grain: str = DAY
) -> DataFrame:
    """As `email_owners` on the enrichment emails, outside both cool-downs.

    A key is dropped if either history knows it, so one pass over their union does for both.
    """
    key = F.col("enrichment_api_person_email_key").alias("person_email_key")
    changed = changed_in(enrichment_as_master(emails), "updated_date", run_date, grain)
    due = due_keys(
        batch.select(key), "person_email_key", history, with_time(enriched_history, "updated_date", key), run_date=run_date, days=days
    )
    return only_in(changed.where(valid_email(F.col("email_address"))), "person_email_key", due)


def email_verdicts(
    candidates: DataFrame, landed: DataFrame, timeout: int = 30, fetched_since=None, after: str | None = None
) -> DataFrame:
    """`email_address` and the verdict's columns for every email with a good answer, later than `after` if that is named."""
    request = email_request(F.col("email_address"), timeout).alias("request_key")
    keys = candidates.select("email_address", request, *([after] if after else []))
    return flatten_email_verdict(answers(keys, landed, PROVIDER, fetched_since, after), "email_address")


def email_landing(verdicts: DataFrame, owners: DataFrame, run_ts=None) -> DataFrame:
    return land(verdicts, owners, ["email_address"], ["person_key", "person_email_key"], DATE, run_ts)


def needs_rerun(staged: DataFrame) -> DataFrame:
    return staged.where((F.col("StatusNbr") == RERUN_STATUS) & (F.col("Code") == RERUN_CODE))


def email_rerun(staged: DataFrame, landed: DataFrame, timeout: int = 30, run_ts=None, fetched_since=None) -> DataFrame:
    """New verdicts for the emails staged with the rerun status pair: answers fetched after the staged ones were verified."""
    owners = needs_rerun(staged).select(F.col("Email").alias("email_address"), "person_key", "person_email_key", DATE)
    asked = owners.groupBy("email_address").agg(F.max(DATE).alias("verified_at"))
    verdicts = email_verdicts(asked, landed, timeout, fetched_since, after="verified_at")
    return email_landing(verdicts, owners, run_ts)
