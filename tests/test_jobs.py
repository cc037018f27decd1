"""Jobs end to end over stored tables: log, staging tables, and a second run inside the cool-down."""

import json

import pytest
from rows import values
from pyspark.sql import functions as F

from cleanroll.plans import jobs
from cleanroll.sinks import ParquetSink
from cleanroll.sources.tables import CommittedTables

NOW = "2024-01-20 08:00:00"
DAYS = {n: -15 for n in ("email", "phone", "phone_exchange", "phone_reverse", "phone_owner", "person_detail")}
VERDICT = ("WebServiceResponse", "VerifyEmailResponse", "VerifyEmailResult")


def verdict(email, status="220", code="222"):
    body = {"ServiceStatus": {"StatusNbr": status}, "ServiceResult": {"Reason": {"Code": code}, "Email": email}}
    for name in reversed(VERDICT):
        body = {name: body}
    return json.dumps(body)


def email_key(email):
    return f"Timeout=30&emailAddress={email.replace('@', '%40')}&outputFormat=json"


def phone_key(number, country=None):
    return f"{f'Country={country}&' if country else ''}PhoneNumber={number}&outputFormat=json"


@pytest.fixture
def world(spark, tmp_path):
    """The tables of a small company, as parquet folders."""
    landed = [
        ("email", email_key("ann@x.co"), 200, verdict("ann@x.co")), ("email", email_key("bob@x.co"), 500, verdict("bob@x.co")),
        ("phone", phone_key("2125550100", "US"), 200, json.dumps({"Records": [{"Results": "PS02", "PhoneNumber": "2125550100"}]})),
        ("phone", phone_key("2079460001", "GB"), 200, json.dumps({"Records": [{"Results": "PS01", "PhoneNumber": "2079460001"}]})),
        ("phone_exchange", phone_key("2125550100"), 200, json.dumps({"ExchangeInfoResults": [{"Name": "Acme"}]})),
        ("phone_reverse", "Action=Check&" + phone_key("2125550100"), 200,
         json.dumps({"Records": [{"NameFull": "Ann", "Results": "PS16", "PhoneNumber": "2125550100"}]})),
        ("phone_owner", "PhoneNumber=2125550100&TestType=FULL&outputFormat=json", 200, json.dumps({"PhoneInfo": {"Provider": {"Name": "Telco"}}})),
        ("person_match", "emailAddress=ann%40x.co&firstname=Ann&lastName=Lee&outputFormat=json", 200,
         json.dumps({"personMatchResponse": {"matchResults": {"personMatchResults": {"personMatchResult": {"personMatches": {
             "personMatch": {"matchConfidence": 90, "personId": "P1"}}}}}}})),
        ("person_detail", "PersonID=P1&outputFieldOptions=jobFunction%2CmanagementLevel%2CcompanyTopLevelIndustry&outputFormat=json", 200,
         json.dumps({"PersonDetailRequest": {"PersonID": "P1", "CurrentEmployment": {"JobTitle": "CEO", "Company": {
             "CompanyID": "C1", "CompanyAddress": {"Street": "1 Main", "City": "NY", "State": "ny ", "CountryCode": "usa"}}}}})),
        ("domain", "domain=x.co&outputFormat=json", 200, json.dumps({"id": "d1", "tags": ["B2B", "SAAS"]})),
    ]
    day = "timestamp_ntz"
    tables = {
        "email_batch_daily": ([(1,), (2,), (3,), (1,)], "person_email_key long"),
        "batch_daily": ([(1, "Ann", "Lee", NOW), (2, "Bob", None, NOW)], "person_key long, first_name string, last_name string, person_updated_date string"),
        "person_email": (
            [(1, 1, "ann@x.co", NOW), (2, 2, "bob@x.co", NOW), (3, 2, "BOB@x.co", NOW), (4, 2, "bob2@x.co", "2024-01-19 00:00:00")],
            "person_email_key long, person_key long, email_address string, updated_date string"),
        "person_email_history": ([(9, "2024-01-18 00:00:00", "x.co")], "person_email_key long, updated_date string, domainpart string"),
        "enrichment_email_history": ([(9, "2024-01-18 00:00:00", "known.co")],
                                     "enrichment_api_person_email_key long, updated_date string, domainpart string"),
        "junk_email": ([("junk@x.co",)], "email_address string"),
        "person_phone": (
            [(11, 1, "(212) 555-0100", NOW), (12, 2, "020 7946 0001", NOW), (13, 2, None, NOW), (14, 2, "call", NOW)],
            "person_phone_key long, person_key long, telephone_number string, updated_date string"),
        "person_address": ([(1, 5), (2, 6)], "person_key long, address_key long"),
        "address": (
            [(5, "usa") + ("",) * 5 + (None,) * 3 + ("k5",), (6, "uk") + ("1 Main", "", "", "", "", "NY", "x", None, "k6")],
            "address_key long, country string, street1_name string, street2_name string, street3_name string, street4_name string, "
            "street5_name string, city string, state string, postal_code string, match_key string"),
        "country_synonym": ([("usa", "US"), ("uk", "GB")], "country_synonym string, country_code string"),
        **{h: ([("1", 99, "2024-01-18 00:00:00")], "phone_number string, person_phone_key long, updated_date string")
           for h in (*jobs.PHONE_HISTORIES, "phone_reverse_history")},
        "bridged_person": ([(2,)], "person_key long"),
        "enrichment_person": ([("P9", NOW)], "person_id string, updated_date string"),
        "website_batch_monthly": ([("x.co",), ("known.co",)], "website string"),
        "known_domain": ([("known.co",)], "domain string"),
        "country_address_state": ([("USA", "NY", 77)], "country_synonym string, state_name string, address_state_key long"),
        "enrichment_company": ([("C1", 500)], "enrichment_api_company_id string, enrichment_api_company_key long"),
        "company_address_bridge": ([(30000031, 500, 8)], "address_type_key int, enrichment_api_company_key long, address_key long"),
        "run_master": ([(41,), (42,)], "batch_id long"),
        "entity_detail": ([(7, "e")], "entity_detail_key long, entity_name string"),
    }
    for name, (rows, ddl) in tables.items():
        df = spark.createDataFrame(rows, ddl)
        stamps = [c for c in df.columns if c.endswith("updated_date")]
        df.withColumns({c: F.col(c).cast(day) for c in stamps}).write.parquet(f"{tmp_path}/{name}")
    spark.createDataFrame(landed, "provider string, request_key string, status int, body string").withColumn(
        "fetched_at", F.lit(NOW).cast(day)
    ).write.parquet(f"{tmp_path}/landed_responses")

    class World:
        def run(self, job, instance="i1", rerun=None, of_run=None, **more):
            source = CommittedTables(spark, str(tmp_path), suffix="")
            jobs.run_job(job, jobs.Run(
                source, ParquetSink(spark, str(tmp_path), run=rerun), "2024-01-20", DAYS, "me", instance, "2024-01-01", run_ts=NOW, of_run=of_run, **more
            ), "e")

        def visible(self, name, *columns):
            """Rows of committed runs."""
            return values(CommittedTables(spark, str(tmp_path), suffix="").table(name), *columns)

        def append(self, name, **row):
            """A row with these values and NULL elsewhere."""
            schema = spark.read.parquet(f"{tmp_path}/{name}").schema
            spark.createDataFrame([tuple(row.get(c) for c in schema.names)], schema).write.mode("append").parquet(f"{tmp_path}/{name}")

        def answer_again(self, provider, fetched_at):
            rows = spark.createDataFrame(landed, "provider string, request_key string, status int, body string").where(F.col("provider") == provider)
            rows.withColumn("fetched_at", F.lit(fetched_at).cast(day)).write.mode("append").parquet(f"{tmp_path}/landed_responses")

        def rows(self, name, *columns):
            return values(spark.read.parquet(f"{tmp_path}/{name}"), *columns)

    return World()


def test_email_verification_and_rerun(world):
    world.run("email_verification", rerun="r1")
    assert world.rows("person_email_verification_staging", "Email", "person_key", "person_email_key") == [("ann@x.co", 1, 1)]
    assert world.visible("run_funnel") == [("i1", "candidates", 2), ("i1", "owners", 2), ("i1", "person_email_verification_staging", 1)]
    world.run("email_rerun", of_run="r1")
    assert world.rows("person_email_verification_staging_rerun") == [], "the answer that asked for the rerun is not landed again"
    world.answer_again("email", "2024-01-21 00:00:00")
    world.run("email_rerun", of_run="another")
    assert world.rows("person_email_verification_staging_rerun") == [], "staged by a run that is not meant"
    world.run("email_rerun", of_run="r1")
    assert world.rows("person_email_verification_staging_rerun", "Email", "person_key") == [("ann@x.co", 1)]
    assert world.rows("run_log", "batch_id", "status", "entity_detail_key") == sorted([(42, "ended", "7"), (42, "started", "7")] * 4)
    with pytest.raises(ValueError, match="name the run"):
        world.run("email_rerun")


def test_phone_hygiene_escalates_its_own_verdicts(world):
    world.run("phone_hygiene")
    assert world.rows("phone_standardisation_history", "person_phone_key", "standardised_phone_number", "is_valid_flag") == [
        ("11", "2125550100", "true"), ("12", "2079460001", "true")]
    assert world.rows("person_phone_verification_staging", "person_phone_key", "Results") == [(11, "PS02"), (12, "PS01")]
    assert world.rows("phone_exchange_staging", "person_phone_key", "Name") == [(11, "Acme")]


def test_reverse_lookup_and_escalation(world):
    world.run("reverse_lookup", rerun="r1")
    assert world.rows("phone_reverse_staging", "person_phone_key", "NameFull") == [(11, "Ann")]
    world.run("reverse_escalation", of_run="r1")
    assert world.rows("phone_owner_staging", "phonenumber", "ProviderName", "person_phone_key") == [("2125550100", "Telco", 11)]


def test_person_enrichment_then_addresses(world):
    world.run("person_enrichment")
    assert world.rows("person_match", "person_key", "personId") == [(1, "P1")]
    assert world.rows("person_detail", "PersonID") == [("P1",)]
    assert world.rows("person_detail_current_employment", "CurrentPersonID", "CurrentJobTitle") == [("P1", "CEO")]
    assert world.rows("person_detail_education") == []
    world.run("address_load")
    assert world.rows("company_address_staging", "CurrentCompanyID", "street1_name", "state", "address_state_key", "update_flag") == [
        ("C1", "1 Main", "ny ", 77, 0)]
    key = world.rows("company_address_staging", "match_key")[0][0]
    world.append("address", address_key=9, match_key=key)
    world.run("address_bridge")
    assert world.rows("company_address_bridge_staging", "enrichment_api_company_key", "address_key", "update_flag") == [(500, 9, 1)]


def test_domain_enrichment(world):
    world.run("domain_enrichment")
    assert world.rows("domain", "id") == [("d1",)]
    assert world.rows("domain_tags") == [("d1", "B2B"), ("d1", "SAAS")]


def test_a_failed_job_is_logged_and_raised(world):
    with pytest.raises(Exception):
        world.run("person_detail_bulk")
    assert world.rows("run_log", "status") == [("failed",), ("started",)]


def test_nothing_is_asked_twice_within_the_cool_down(spark, world, tmp_path):
    world.run("email_verification")
    history = spark.read.parquet(f"{tmp_path}/person_email_verification_staging").select(
        "person_email_key", F.col("email_verification_date").cast("timestamp_ntz").alias("updated_date"), F.col("DomainPart").alias("domainpart")
    )
    history.write.mode("append").parquet(f"{tmp_path}/person_email_history")
    before = world.rows("person_email_verification_staging")
    world.run("email_verification", "i2")
    assert world.rows("person_email_verification_staging") == before


def test_a_rerun_under_the_same_name_replaces_its_rows_and_keeps_the_log(world):
    for _ in range(2):
        world.run("domain_enrichment", rerun="domains_2024-01-20")
    assert world.rows("domain", "id") == [("d1",)]
    assert len(world.rows("domain_tags")) == 2
    assert world.rows("run_log", "status") == sorted([("started",), ("ended",)] * 2)


def test_a_run_that_fails_between_two_tables_shows_none(world, monkeypatch):
    append = ParquetSink.append

    def broken(self, df, name):
        if name == "domain_tags":
            raise RuntimeError("lost")
        append(self, df, name)

    monkeypatch.setattr(ParquetSink, "append", broken)
    with pytest.raises(RuntimeError, match="lost"):
        world.run("domain_enrichment", rerun="d1")
    assert world.rows("domain", "id") == [("d1",)] and world.visible("domain", "id") == []
    monkeypatch.undo()
    world.run("domain_enrichment", rerun="d1")
    assert world.visible("domain", "id") == [("d1",)] and world.visible("domain_tags") == [("d1", "B2B"), ("d1", "SAAS")]
    monkeypatch.setattr(ParquetSink, "append", broken)
    with pytest.raises(RuntimeError, match="lost"):
        world.run("domain_enrichment", rerun="d1")
    assert world.visible("domain", "id") == [], "a run that started again is not visible until it commits"


def test_rows_of_other_runs_are_not_read(spark, tmp_path):
    for run, n in (("r1", 3), ("r2", 5), ("open", 7)):
        sink = ParquetSink(spark, str(tmp_path), run=run)
        sink.begin()
        sink.append(spark.range(n), "staging")
        if run != "open":
            sink.commit()
    tables = CommittedTables(spark, str(tmp_path), suffix="")
    assert tables.committed() == ["r1", "r2"]
    assert tables.table("staging").count() == 8 and tables.table("staging", run="open").count() == 0
    one = tables.table("staging", run="r2")
    assert one.count() == 5 and one.columns == ["id"]
    assert "PartitionFilters: [" in (text := one._jdf.queryExecution().executedPlan().toString()) and "r2" in text.split("PartitionFilters:")[1].split("]")[0]


def test_counts_come_from_the_writes(spark):
    progress = jobs.Progress()
    staged = progress.stage(spark.range(1000).repartition(7).where("id % 3 = 0"), "thirds")
    nothing = progress.stage(staged.where("id < 0"), "none")
    assert progress.rows == {"thirds": 334, "none": 0} and staged.count() == 334 and nothing.count() == 0
    progress.close()


def test_a_job_without_steps_counts_its_tables(world):
    world.run("domain_enrichment", "domains", rerun="d1")
    funnel = {stage: n for _, stage, n in world.visible("run_funnel")}
    assert funnel == {"companies": 3, "domain": 1, "domain_domainAliases": 0, "domain_tags": 2, "domain_sitephoneNumbers": 0, "domain_siteemailAddresses": 0}
