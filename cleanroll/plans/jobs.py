"""The batch jobs: read the role tables, run a dataflow, append its tables, log the run.

A daily and a monthly run are one job under two grains. Intermediate results that
several tables are read off are staged once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, functions as F

from cleanroll.functions.periods import DAY, MONTH
from cleanroll.functions.phones import PLAN
from cleanroll.operators.landing import standardisation_log
from cleanroll.operators.sets import distinct_keys
from cleanroll.plans import addresses, audit, domains, emails, persons, phones
from cleanroll.session import Stages
from cleanroll.sinks import TableSink
from cleanroll.sources.current import CurrentAnswers
from cleanroll.sources.tables import TableSource

Outputs = Mapping[str, DataFrame]
Result = TypeVar("Result")
PHONE_HISTORIES = ("person_phone_history", "enrichment_phone_history", "phone_exchange_history")


class Progress:
    """How many rows each step of a run had, counted by the writes themselves, and the tables that it staged.

    The count sits right below a write, in the tasks that write: Spark adds a task's count when it commits its first
    success, so a retried task counts once.
    """

    def __init__(self):
        self.rows: dict[str, int] = {}
        self._stages: Stages | None = None

    def counted(self, df: DataFrame, name: str, write: Callable[[DataFrame], Result]) -> Result:
        """What `write` returns of `df`; the rows that it wrote are noted under `name`."""
        seen = Observation()
        result = write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
        self.rows[name] = seen.get["rows"]
        return result

    def stage(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        if self._stages is None:
            self._stages = Stages(df.sparkSession)
        return self.counted(df, name, lambda d: self._stages.write(d, name, partition_by))

    def close(self) -> None:
        if self._stages is not None:
            self._stages.drop_all()
            self._stages = None


@dataclass(frozen=True)
class Run:
    """One run of a job. `days` are signed: -15 looks back 15 days.

    Answers fetched before `fetched_since` do not count, so no old body is stamped with today's date. `of_run` names the
    run whose staged rows a rerun or an escalation works on. `current` gives, by provider, tables of current answers to
    read in place of all landed responses.
    """

    source: TableSource
    sink: TableSink
    run_date: dt.date | str
    days: Mapping[str, int]
    user: str
    instance: str
    fetched_since: dt.date | str
    grain: str = DAY
    run_ts: str | None = None
    of_run: str | None = None
    email_timeout: int = 30
    plan: tuple = field(default=PLAN)
    current: Mapping[str, CurrentAnswers] = field(default_factory=dict)
    progress: Progress = field(default_factory=lambda: Progress())

    def table(self, name: str) -> DataFrame:
        return self.source.table(name)

    def landed(self, provider: str) -> DataFrame | CurrentAnswers:
        return self.current.get(provider) or self.source.table("landed_responses")

    def staged_before(self, name: str) -> DataFrame:
        """What the run `of_run` staged."""
        if self.of_run is None:
            raise ValueError(f"name the run whose rows of {name} are meant")
        return self.source.table(name, run=self.of_run)

    def stage(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """`df` staged until the run ends, its rows counted by the write."""
        return self.progress.stage(df, name, partition_by)

    def batch(self, name: str) -> DataFrame:
        """The batch view of the run's grain."""
        return self.source.table(f"{name}_{'monthly' if self.grain == MONTH else 'daily'}")


def email_verification(run: Run) -> Outputs:
    owners = run.stage(
        emails.email_owners(
            run.batch("email_batch"), run.table("person_email"), run.table("person_email_history"),
            run.run_date, run.days["email"], run.grain,
        ),
        "owners",
    )
    return _land_emails(run, owners, "person_email_verification_staging")


def email_verification_enriched(run: Run) -> Outputs:
    # The enrichment batch has one view for both grains.
    owners = run.stage(
        emails.enriched_email_owners(
            run.table("enrichment_email_batch_daily"), run.table("enrichment_email"), run.table("person_email_history"),
            run.table("enrichment_email_history"), run.run_date, run.days["email"], run.grain,
        ),
        "owners",
    )
    return _land_emails(run, owners, "enrichment_email_verification_staging")


def _land_emails(run: Run, owners: DataFrame, target: str) -> Outputs:
    wanted = run.stage(emails.email_candidates(owners, run.table("junk_email")), "candidates")
    verdicts = emails.email_verdicts(wanted, run.landed(emails.PROVIDER), run.email_timeout, run.fetched_since)
    return {target: emails.email_landing(verdicts, owners, run.run_ts)}


def _rerun(staging: str) -> Callable[[Run], Outputs]:
    def job(run: Run) -> Outputs:
        staged = run.staged_before(staging)
        again = emails.email_rerun(staged, run.landed(emails.PROVIDER), run.email_timeout, run.run_ts, run.fetched_since)
        return {f"{staging}_rerun": again}

    return job


def phone_hygiene(run: Run) -> Outputs:
    """Candidates, log, verdicts, and the escalation of this run's own verdicts to the second provider."""
    candidates = run.stage(
        phones.phone_candidates(
            run.batch("batch"), run.table("person_phone"), run.table("person_address"), run.table("address"),
            run.table("country_synonym"), *[run.table(h) for h in PHONE_HISTORIES],
            run_date=run.run_date, days=run.days["phone"], grain=run.grain, plan=run.plan,
        ),
        "candidates",
    )
    staged = run.stage(_land_phones(run, candidates), "verdicts")
    escalated = phones.phone_escalation(
        staged, run.table("phone_exchange_history"), run.landed(phones.EXCHANGE), run.run_date, run.days["phone_exchange"],
        run.run_ts, run.fetched_since,
    )
    return {
        "phone_standardisation_history": standardisation_log(candidates, run.user, run.run_ts),
        "person_phone_verification_staging": staged,
        "phone_exchange_staging": escalated,
    }


def phone_hygiene_enriched(run: Run) -> Outputs:
    candidates = run.stage(
        phones.phone_candidates_enriched(
            run.table("enrichment_phone"), *[run.table(h) for h in PHONE_HISTORIES],
            run_date=run.run_date, days=run.days["phone"], grain=run.grain, plan=run.plan,
        ),
        "candidates",
    )
    return {
        "phone_standardisation_history": standardisation_log(candidates, run.user, run.run_ts),
        "enrichment_phone_verification_staging": _land_phones(run, candidates),
    }


def _land_phones(run: Run, candidates: DataFrame) -> DataFrame:
    requests = run.stage(distinct_keys(candidates, phones.NUMBER, "country_code"), "requests")
    verdicts = phones.phone_verdicts(requests, run.landed(phones.VERDICT), run.fetched_since)
    return phones.phone_landing(verdicts, candidates, run.run_ts)


def reverse_lookup(run: Run) -> Outputs:
    candidates = run.stage(
        phones.reverse_candidates(
            run.table("batch_daily"), run.table("person_phone"), run.table("phone_reverse_history"),
            run.run_date, run.days["phone_reverse"], run.plan,
        ),
        "candidates",
    )
    return {
        "phone_standardisation_history": standardisation_log(candidates, run.user, run.run_ts),
        "phone_reverse_staging": phones.reverse_lookup(
            candidates, run.landed(phones.REVERSE), run.run_ts, run.fetched_since
        ),
    }


def reverse_escalation(run: Run) -> Outputs:
    candidates = run.stage(
        phones.reverse_escalation_candidates(
            run.staged_before("phone_reverse_staging"), run.table("phone_exchange_history"), run.run_date, run.days["phone_owner"], run.plan
        ),
        "candidates",
    )
    return {
        "phone_standardisation_history": standardisation_log(candidates, run.user, run.run_ts),
        "phone_owner_staging": phones.reverse_escalation(
            candidates, run.landed(phones.OWNER), run.run_ts, run.fetched_since
        ),
    }


def person_enrichment(run: Run) -> Outputs:
    """Match the persons of the period, then detail the matched ids."""
    owners = run.stage(
        persons.match_owners(
            run.batch("batch"), run.table("bridged_person"), run.table("person_email"), run.run_date, run.grain
        ),
        "owners",
    )
    requests = run.stage(distinct_keys(owners, *persons.NAME_AND_EMAIL), "requests")
    matches = run.stage(persons.person_matches(requests, run.landed(persons.MATCH), run.fetched_since), "matches")
    ids = persons.detail_ids(matches, run.table("enrichment_person"), run.run_date, run.days["person_detail"])
    details = persons.person_details(ids, run.landed(persons.DETAIL), run.fetched_since)
    return {
        "person_match": persons.person_match(matches, owners),
        **persons.person_detail(details, stage=run.stage),
    }


def person_detail_bulk(run: Run) -> Outputs:
    """Detail for a ready list of ids."""
    details = persons.person_details(run.table("person_detail_request"), run.landed(persons.DETAIL), run.fetched_since)
    return persons.person_detail(details, stage=run.stage)


def domain_enrichment(run: Run) -> Outputs:
    wanted = domains.domain_candidates(
        run.table("website_batch_monthly"), run.table("enrichment_email_history"), run.table("person_email_history"),
        known=run.table("known_domain"),
    )
    return domains.domain_enrichment(domains.domain_details(wanted, run.landed(domains.PROVIDER), run.fetched_since), stage=run.stage)


def address_load(run: Run) -> Outputs:
    loaded = addresses.address_load(
        run.table("person_detail_current_employment"), run.table("address"), run.table("country_address_state")
    )
    return {"company_address_staging": loaded}


def address_bridge(run: Run) -> Outputs:
    bridged = addresses.address_bridge(
        run.table("company_address_staging"), run.table("enrichment_company"), run.table("address"), run.table("company_address_bridge")
    )
    return {"company_address_bridge_staging": bridged}


JOBS: dict[str, Callable[[Run], Outputs]] = {
    "email_verification": email_verification,
    "email_verification_enriched": email_verification_enriched,
    "email_rerun": _rerun("person_email_verification_staging"),
    "email_rerun_enriched": _rerun("enrichment_email_verification_staging"),
    "phone_hygiene": phone_hygiene,
    "phone_hygiene_enriched": phone_hygiene_enriched,
    "reverse_lookup": reverse_lookup,
    "reverse_escalation": reverse_escalation,
    "person_enrichment": person_enrichment,
    "person_detail_bulk": person_detail_bulk,
    "domain_enrichment": domain_enrichment,
    "address_load": address_load,
    "address_bridge": address_bridge,
}


def run_job(name: str, run: Run, entity: str) -> None:
    """Append the job's tables between a `started` and an `ended` row; a failure logs `failed` and is raised."""

    def log(status: str) -> None:
        rows = audit.audit_rows(
            run.table("run_master"), run.table("entity_detail"), entity, run.instance, status, run.user, run.run_ts
        )
        run.sink.log(rows, "run_log")

    log(audit.STARTED)
    try:
        run.sink.begin()
        for table, df in JOBS[name](run).items():
            run.progress.counted(df, table, lambda d, table=table: run.sink.append(d, table))
        run.sink.append(funnel_rows(run), "run_funnel")
        run.sink.commit()
    except Exception:
        log(audit.FAILED)
        raise
    finally:
        run.progress.close()
    log(audit.ENDED)


def funnel_rows(run: Run) -> DataFrame:
    """`instance_name, stage, rows`: what the run staged and appended, as its writes counted it."""
    spark = run.table("run_master").sparkSession
    rows = [(run.instance, stage, n) for stage, n in run.progress.rows.items()]
    return spark.createDataFrame(rows, "instance_name string, stage string, rows long")
