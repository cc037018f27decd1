"""The registered queries. Keys are the operator names of the survey."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cleanroll.functions import text as txt
from cleanroll.functions.addresses import ADDRESS_COLUMNS, FULL_COLUMNS, address_key, street_parts, truncated, upper_trim
from cleanroll.functions.emails import valid_email
from cleanroll.functions.periods import MONTH, changed_in, shifted_date, since, with_time
from cleanroll.functions.phones import e164, standardise
from cleanroll.operators import joins, providers, sets
from cleanroll.operators.bodies import at as at_path
from cleanroll.operators.fanout import cell_rows, fan_out
from cleanroll.operators.landing import land, standardisation_log
from cleanroll.plans import addresses, audit, domains, emails, persons, phones
from cleanroll.plans.jobs import Progress
from cleanroll.session import scratch_root, stage
from cleanroll.sinks import ParquetSink, append_all, by_name
from cleanroll.sources.answers import answers, latest_bodies
from cleanroll.sources.settings import settings_table
from cleanroll.sources.tables import CommittedTables, ParquetTables
from standins import bodies as sb
from standins import tables as st
from standins.body_sql import answered, at, cells, columns, items, readable
from standins.phone_sql import standardised
from standins.registry import QUERIES, Tables, query
from standins.tables import DAYS, EVENT_RUN_DATE, RUN_DATE, RUN_TS, oracle

MONTHLY = {"run_date": RUN_DATE, "grain": MONTH}
RECENT = {"run_date": RUN_DATE, "days": DAYS}
IN_MONTH = "{0} >= timestamp '2001-07-01' and {0} < timestamp '2001-08-01'"
SINCE = "{0} >= timestamp '2001-07-16'"
EVENT_MONTH = "{0} >= timestamp '2024-01-01' and {0} < timestamp '2024-02-01'"
EVENT_SINCE = "{0} >= timestamp '2024-01-16'"
CHARS = "[a-z0-9!#$%&''*+/=?^_`{|}~-]"
VALID = (
    "(length(email_address) between 6 and 254 and position('@' in email_address) between 2 and 65 and regexp_full_match(email_address, "
    f"'{CHARS}+(?:\\.{CHARS}+)*@(?:[a-z0-9](?:[a-z0-9-]{{0,61}}[a-z0-9])?\\.)+[a-z0-9''](?:[a-z0-9''-]{{0,61}}[a-z0-9''])?'))"
)
USER = "hygiene"


def fresh_sink(t: Tables, name: str) -> ParquetSink:
    import uuid

    return ParquetSink(t.spark, f"{scratch_root(t.spark)}/{name}-{uuid.uuid4().hex}")


def written_at(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as text, so that no session clock takes part in a comparison."""
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names})


# ---------------------------------------------------------------- sources
@query("scan_table", "select o_orderkey, o_custkey, o_orderdate from orders")
def _(t):
    return ParquetTables(t.spark, t.sf_dir).table("orders", ["o_orderkey", "o_custkey", "o_orderdate"])


@query("scan_filtered", oracle("select person_phone_key, telephone_number from person_phone where telephone_number is not null", "person_phone"))
def _(t):
    return t.person_phone.where("telephone_number is not null").select("person_phone_key", "telephone_number")


@query("config_csv", "select concat('setting', c_custkey % 97) as key, max_by(c_name, c_custkey) as value from customer group by 1")
def _(t):
    path = f"{fresh_sink(t, 'settings').root}/settings"
    lines = t["customer"].select(
        F.concat(F.lit("setting"), F.col("c_custkey") % 97).alias("key"), F.col("c_name").alias("value"), "c_custkey"
    )
    lines.repartition("key").sortWithinPartitions("c_custkey").select("key", "value").write.option("header", True).csv(path)
    return settings_table(t.spark, path)


@query("response_scan", oracle(
    f"select k.email_address, body from (select distinct email_address, {st.EMAIL_KEY} as request_key from person_email where email_address is not null) k "
    "join latest using (request_key)", "person_email", "email_landed", **answered("email_landed")))
def _(t):
    wanted = sets.distinct_keys(t.person_email, "email_address")
    keys = wanted.withColumn("request_key", txt.email_request(F.col("email_address")))
    return answers(keys, t.current("email_landed"), "email").select("email_address", "body")


def staged_by_run(t: Tables, rows: DataFrame, name: str, key: str) -> DataFrame:
    """`rows` as the run `this` staged them, beside those of an earlier run and of one that never committed, whose keys
    are not the same: only what is read by run gives the right result."""
    root = fresh_sink(t, name).root
    written = stage(rows, name)
    for run, moved in (("earlier", 1), ("this", 0), ("broken", 2)):
        sink = ParquetSink(t.spark, root, run=run)
        sink.begin()
        sink.append(written.withColumn(key, F.col(key) + moved), "staging")
        if run != "broken":
            sink.commit()
    return CommittedTables(t.spark, root, suffix="").table("staging", run="this")


# ---------------------------------------------------------------- sinks
@query("append_table", oracle(
    "select person_email_key, email_address from person_email union all select person_email_key, email_address from person_email "
    "where person_email_key % 2 = 0", "person_email"))
def _(t):
    sink = fresh_sink(t, "append")
    rows = t.person_email.select("person_email_key", "email_address")
    sink.append(rows, "person_email_staging")
    half = rows.where("person_email_key % 2 = 0").select("email_address", "person_email_key")
    sink.append(by_name(half, rows.columns), "person_email_staging")
    return t.spark.read.parquet(sink.path("person_email_staging"))


@query("append_if_any", oracle("select person_email_key, email_address from person_email where person_email_key % 3 = 0", "person_email"))
def _(t):
    sink = fresh_sink(t, "append_if_any")
    rows = t.person_email.select("person_email_key", "email_address")
    sink.append(rows.where("person_email_key < 0"), "staging")
    sink.append(rows.where("person_email_key % 3 = 0"), "staging")
    return t.spark.read.parquet(sink.path("staging"))


def renamed(steps: dict[str, str], suffix: str) -> dict[str, str]:
    """The same steps under other names, for a second provider in one query."""
    import re

    names = "|".join(steps)
    return {k + suffix: re.sub(rf"\b(from|join) ({names})\b", rf"\g<1> \g<2>{suffix}", v) for k, v in steps.items()}


DETAIL_ANSWERED = {**answered("detail_landed"), **readable(rejects=("ErrorMessage",))}
DETAIL_STEPS = {
    **DETAIL_ANSWERED,
    "people": f"select *, {at('PersonDetailRequest.PersonID')} as PersonID from bodies "
              f"where {at('PersonDetailRequest.PersonID')} <> ''",
}
JOB = {
    **{n: n for n in ("JobTitle", "JobFunction", "ManagementLevel", "FromDate", "ToDate")},
    **{n: f"Company.{n}" for n in ("CompanyID", "ZoomCompanyUrl", "CompanyDetailXmlUrl", "CompanyName", "Phone", "Fax", "Website")},
    **{f"Address{n}": f"Company.CompanyAddress.{n}" for n in ("Street", "City", "State", "Zip", "CountryCode")},
}
CURRENT_JOB_NAMES = {
    "JobFunction": "Currentjobfunctiondescription", "ManagementLevel": "Currentmanagementleveldescription", "Phone": "CurrentCompanyPhone", "Fax": "CurrentCompanyFax"}
CHILD_COLUMNS = {
    "CurrentEmployment": {CURRENT_JOB_NAMES.get(c, f"Current{c}"): p for c, p in JOB.items()},
    "PastEmployment": {("Zip" if c == "AddressZip" else c): p for c, p in JOB.items()},
    "WebReference": {n: n for n in ("Title", "Url", "Description", "Date")},
    "Education": {"School": "School", "GraduationDate": "GraduationDate", "Degree": "EducationDegree.Degree", "AreaOfStudy": "EducationDegree.AreaOfStudy"},
    "Certifications": {n: n for n in ("CertificationName", "OrganizationName", "YearReceived")},
}
DETAIL_CHILDREN = {
    "person_detail_current_employment": "CurrentEmployment", "person_detail_past_employment": "PastEmployment",
    "person_detail_web_reference": "WebReference", "person_detail_education": "Education",
    "person_detail_certifications": "Certifications",
}
DETAIL_LISTS = {"person_detail_industry": "Industry", "person_detail_top_level_industry": "TopLevelIndustry"}
DOMAIN_LISTS = {"domainAliases": "domainAliases", "tags": "tags", "sitephoneNumbers": "site.phoneNumbers", "siteemailAddresses": "site.emailAddresses"}


def _child_cells(target: str, name: str) -> str:
    values = {c: at(p, source="e") for c, p in CHILD_COLUMNS[name].items()}
    if name == "WebReference":
        text = values["Description"]
        values["Description"] = f"case when length({text}) >= 500 then substring({text}, 1, 498) else {text} end"
    return cells(target, "people", "PersonID", values, items(f"PersonDetailRequest.{name}"))


def _detail_list_cells(target: str, name: str) -> str:
    return cells(target, "people", "PersonID", {name: "e->>'$'"}, items(f"PersonDetailRequest.{name}", alone=False))


def _domain_list_cells(target: str, name: str) -> str:
    return cells(target, "companies", at("id"), {name: "e->>'$'"}, items(DOMAIN_LISTS[name], alone=False))


def _detail_cells() -> str:
    """All eight tables, cell by cell."""
    parts = [cells("person_detail", "people", at("PersonDetailRequest.PersonID"), {n: at(f"PersonDetailRequest.{n}") for n in sb.DETAIL_NAMES})]
    parts += [_child_cells(target, name) for target, name in DETAIL_CHILDREN.items()]
    return " union all ".join([*parts, *[_detail_list_cells(target, name) for target, name in DETAIL_LISTS.items()]])


def _all_details(t: Tables) -> DataFrame:
    return latest_bodies(t.detail_landed, "person_detail")


@query("fan_out_children", oracle(f'select target, key, "column", value, count(*) as n from ({_detail_cells()}) group by all', "detail_landed", **DETAIL_STEPS))
def _(t):
    sink = fresh_sink(t, "fan_out")
    outputs = persons.person_detail(providers.parse_person_detail(_all_details(t)))
    append_all(outputs, sink)
    written = []
    for name, df in outputs.items():
        table, key = t.spark.read.parquet(sink.path(name)), df.columns[0]
        own = [c for c in df.columns if c != key or name == "person_detail"]
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in own])).alias("c")
        written.append(table.select(F.lit(name).alias("target"), F.col(key).alias("key"), pairs).select("target", "key", "c.column", "c.value"))
    return reduce(DataFrame.unionByName, written).groupBy("target", "key", "column", "value").agg(F.count(F.lit(1)).alias("n"))


RUN_LOG = (
    "select (select max(batch_id) from run_master) as batch_id, 'email_load_1' as instance_name, status, '1' as file_key, "
    "(select cast(min(entity_detail_key) as varchar) from entity where entity_name = 'ASIA') as entity_detail_key, "
    f"'{RUN_TS}' as created_date, '{USER}' as created_user from (values {{0}}) s(status)"
)


def _audit(t: Tables, status: str) -> DataFrame:
    return audit.audit_rows(t.run_master, t.entity, "ASIA", "email_load_1", status, USER, RUN_TS)


@query("audit_rows", oracle(RUN_LOG.format("('started')"), "run_master", "entity"))
def _(t):
    return written_at(_audit(t, audit.STARTED), "created_date")


@query("run_log", oracle(RUN_LOG.format("('started'), ('ended')"), "run_master", "entity"))
def _(t):
    sink = fresh_sink(t, "run_log")
    for status in (audit.STARTED, audit.ENDED):
        sink.append(_audit(t, status), "run_log")
    return written_at(t.spark.read.parquet(sink.path("run_log")), "created_date")


@query("entity_lookup", oracle("select min(entity_detail_key) as entity_detail_key from entity where entity_name = 'EUROPE'", "entity"))
def _(t):
    return audit.entity_lookup(t.entity, "EUROPE")


# ---------------------------------------------------------------- projections and filters
@query("project", oracle("select person_email_key, updated_date from person_email", "person_email"))
def _(t):
    return t.person_email.select("person_email_key", "updated_date")


@query("rename", oracle(
    "select enrichment_api_person_key as person_key, email as email_address, enrichment_api_person_email_key as person_email_key, "
    "updated_date from enrichment_email where email is not null", "enrichment_email"))
def _(t):
    return emails.enrichment_as_master(t.enrichment_email)


@query("drop_column", oracle("select person_email_key, person_key, updated_date from person_email", "person_email"))
def _(t):
    return t.person_email.drop("email_address")


LOG_COLUMNS = (
    "cast(person_phone_key as varchar) as person_phone_key, standardised_phone_number, is_valid_flag, '50000001' as verification_reason_key, "
    f"telephone_number, '{RUN_TS}' as created_date, '{USER}' as created_user_id, '{RUN_TS}' as updated_date, '{USER}' as updated_user_id"
)


def _log(df: DataFrame) -> DataFrame:
    return written_at(standardisation_log(df, USER, RUN_TS), "created_date", "updated_date")


@query("literal_columns", oracle(f"select {LOG_COLUMNS} from std", "person_phone", **standardised("person_phone", "telephone_number", None)))
def _(t):
    return _log(standardise(t.person_phone, "telephone_number", None))


@query("now_stamp", oracle(f"select person_email_key, '{RUN_TS}' as email_verification_date from person_email where email_address is not null", "person_email"))
def _(t):
    keys = t.person_email.where("email_address is not null").select("email_address", "person_email_key")
    asked = keys.select("email_address").distinct()
    return written_at(
        land(asked, keys, ["email_address"], ["person_email_key"], emails.DATE, RUN_TS), emails.DATE
    )


@query("filter_not_null", oracle("select person_phone_key, telephone_number from person_phone where telephone_number is not null", "person_phone"))
def _(t):
    return t.person_phone.where(F.col("telephone_number").isNotNull()).select("person_phone_key", "telephone_number")


@query("filter_changed_in_period", oracle(f"select person_email_key, updated_date from person_email where {IN_MONTH.format('updated_date')}", "person_email"))
def _(t):
    return changed_in(t.person_email.select("person_email_key", "updated_date"), "updated_date", RUN_DATE, MONTH)


@query("filter_since", oracle(f"select person_email_key, updated_date from email_history where {SINCE.format('updated_date')}", "email_history"))
def _(t):
    return since(with_time(t.email_history, "updated_date", "person_email_key"), "updated_date", RUN_DATE, DAYS)


VERDICT_PATH = "WebServiceResponse.VerifyEmailResponse.VerifyEmailResult"
RESULT_PATH = f"{VERDICT_PATH}.ServiceResult"
EMAIL_COLUMNS = ", ".join([
    columns(f"{VERDICT_PATH}.ServiceStatus", ["StatusNbr", "StatusDescription"]),
    columns(f"{RESULT_PATH}.Reason", ["Code", "Description"]),
    columns(RESULT_PATH, ["HygieneResult", "NetProtected", "NetProtectedBy"]),
    columns(RESULT_PATH, ["SourceIdentifier", "DomainKnowledge"], "null_text"),
    columns(RESULT_PATH, ["Email", "LocalPart", "DomainPart"]),
    columns(RESULT_PATH, ["IronStandardCertifiedTimestamp"], "empty"),
    columns(f"{RESULT_PATH}.AddressKnowledge.StringKeyValuePair", {"StringKeyValuePairKey": "Key", "StringKeyValuePairValue": "Value"}),
])
EMAIL_FLAT = {
    **answered("email_landed"), **readable(),
    "flat": f"select request_key, {EMAIL_COLUMNS} from bodies where json_exists(j, '$.{VERDICT_PATH}')",
}


@query("filter_status_pair", oracle("select request_key, Email from flat where StatusNbr = '220' and Code = '222'", "email_landed", **EMAIL_FLAT))
def _(t):
    flat = providers.flatten_email_verdict(latest_bodies(t.email_landed, "email"), "request_key")
    return emails.needs_rerun(flat).select("request_key", "Email")


PHONE_FLAT = {
    **answered("phone_landed"), **readable(),
    "flat": f"select request_key, {columns('Records[0]', sb.PHONE_VERDICT_NAMES, 'null_text')} from bodies where json_exists(j, '$.Records[0]')",
}


@query("filter_result_codes", oracle(
    "select request_key, Results from flat where contains(Results, 'PS02') or contains(Results, 'PS16')", "phone_landed", **PHONE_FLAT))
def _(t):
    flat = providers.flatten_phone_verdict(latest_bodies(t.phone_landed, "phone"), "request_key")
    return flat.where(phones.escalates(F.col("Results"))).select("request_key", "Results")


TEXT_EMAILS = "regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[A-Za-z0-9]')"


@query("filter_valid_email", oracle(
    f"select email_address from found where {VALID}", "person_email",
    found=f"select email_address from person_email union all select unnest({TEXT_EMAILS}) from documents"))
def _(t):
    pattern = F.lit("[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[A-Za-z0-9]")
    # A plain search for "@" spares most texts the pattern.
    in_text = t["documents"].where(F.col("text").contains("@")).select(F.explode(F.regexp_extract_all("text", pattern, 0)).alias("email_address"))
    return t.person_email.select("email_address").unionByName(in_text).where(valid_email(F.col("email_address")))


# ---------------------------------------------------------------- joins
@query("join_inner_using", oracle("select person_email_key, person_key, email_address from email_batch join person_email using (person_email_key)", "email_batch", "person_email"))
def _(t):
    return t.email_batch.join(t.person_email, "person_email_key").select("person_email_key", "person_key", "email_address")


COUNTRY_CHAIN = (
    "select person_phone_key, telephone_number, a.address_key, a.country, s.country_code from person_phone p "
    "join person_address b on p.person_key = b.person_key join address_country a on b.address_key = a.address_key "
    "join synonyms s on a.country = s.country_synonym"
)


@query("join_chain_country", oracle(COUNTRY_CHAIN, "person_phone", "person_address", "address_country", "synonyms"))
def _(t):
    chained = joins.resolve_country(t.person_phone, t.person_address, t.address_country, t.synonyms)
    return chained.select("person_phone_key", "telephone_number", "address_key", "country", "country_code")


@query("join_comma_equi", oracle(
    "select CurrentCompanyID, city, enrichment_api_company_key from company_address a, company c where a.CurrentCompanyID = c.enrichment_api_company_id",
    "company_address", "company"))
def _(t):
    ids = t.company.withColumnRenamed("enrichment_api_company_id", "CurrentCompanyID")
    return t.company_address.join(ids, "CurrentCompanyID").select("CurrentCompanyID", "city", "enrichment_api_company_key")


THREE = ["first_name", "last_name", "email_address"]


@query("join_three_keys", oracle(
    "select a.first_name, a.last_name, a.email_address, b.person_key from (select distinct first_name, last_name, email_address from owners) a, "
    "(select distinct * from owners) b where a.first_name = b.first_name and a.last_name = b.last_name and a.email_address = b.email_address",
    "batch", "person_email",
    owners="select batch.person_key, first_name, last_name, email_address from batch join person_email on batch.person_key = person_email.person_key "
           "where person_updated_date = updated_date"))
def _(t):
    rows = t.batch.join(t.person_email, "person_key").where("person_updated_date = updated_date").select("person_key", *THREE)
    return land(sets.distinct_keys(rows, *THREE), rows, THREE, ["person_key"], drop=[])


@query("join_left_normalised", oracle(
    "select distinct e.CurrentCompanyID, e.country, e.state, s.address_state_key from (select CurrentCompanyID, CurrentAddressCountryCode as country, "
    "CurrentAddressState as state from employment) e left join states s on upper(trim(e.country)) = upper(trim(s.country_synonym)) "
    "and upper(trim(e.state)) = upper(trim(s.state_name))", "employment", "states"))
def _(t):
    rows = t.employment.select(
        "CurrentCompanyID", F.col("CurrentAddressCountryCode").alias("country"), F.col("CurrentAddressState").alias("state")
    )
    return joins.left_normalised(rows.distinct(), t.states, {"country": "country_synonym", "state": "state_name"})


STAGED_PAIRS = "select distinct s_nationkey as enrichment_api_company_key, 30000031 as address_type_key, l_orderkey % 400 as address_key from @lineitem join @supplier on l_suppkey = s_suppkey"


@query("join_left_residual", oracle(
    "select distinct a.*, case when b.enrichment_api_company_key is null then 0 else 1 end as update_flag from pairs a left join company_bridge b "
    "on a.enrichment_api_company_key = b.enrichment_api_company_key and a.address_type_key = b.address_type_key and a.address_key <> b.address_key",
    "company_bridge", pairs=STAGED_PAIRS))
def _(t):
    pairs = t["lineitem"].join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_nationkey").alias("enrichment_api_company_key"), F.lit(30000031).alias("address_type_key"), (F.col("l_orderkey") % 400).alias("address_key")
    )
    return joins.left_residual(pairs.distinct(), t.company_bridge, ["enrichment_api_company_key", "address_type_key"], "address_key", "update_flag")


@query("anti_join_cooldown", oracle(
    f"select person_email_key, person_key from person_email where person_email_key not in (select person_email_key from email_history where {SINCE.format('updated_date')})",
    "person_email", "email_history"))
def _(t):
    return sets.not_recent(t.person_email, "person_email_key", t.email_history, **RECENT).select("person_email_key", "person_key")


# ---------------------------------------------------------------- aggregation, limits, sets
@query("max_batch", oracle("select max(batch_id) as batch_id from run_master", "run_master"))
def _(t):
    return audit.max_batch(t.run_master)


@query("distinct_keys", oracle("select distinct first_name, last_name from batch", "batch"))
def _(t):
    return sets.distinct_keys(t.batch, "first_name", "last_name")


@query("distinct_rows", oracle("select distinct * from email_batch join person_email using (person_email_key)", "email_batch", "person_email"))
def _(t):
    # The keys are made distinct before they meet the wide rows; only those are then made distinct.
    return sets.only_in(t.person_email, "person_email_key", t.email_batch).distinct()


@query("count_rows", oracle("select 'batch' as stage, count(*) as rows from batch union all select 'email', count(*) from person_email", "batch", "person_email"))
def _(t):
    return sets.candidate_funnel({"batch": t.batch, "email": t.person_email})


@query("cap_requests", oracle("select distinct email_address from person_email where email_address is not null order by 1 limit 10", "person_email"))
def _(t):
    wanted = sets.distinct_keys(t.person_email.where("email_address is not null"), "email_address")
    return sets.cap(wanted, "email_address", n=10)


@query("union_histories", oracle(
    "select phone_number, updated_date from phone_history union all select phone_number, updated_date from enrichment_phone_history union all "
    "select phone_number, updated_date from exchange_history", "phone_history", "enrichment_phone_history", "exchange_history"))
def _(t):
    names = ["phone_number", "updated_date"]
    return sets.union_histories(*[h.select(*names) for h in (t.phone_history, t.enrichment_phone_history, t.exchange_history)])


@query("union_domains", oracle(
    "select website from websites union all select domainpart from enrichment_email_history union all select domainpart from email_history",
    "websites", "enrichment_email_history", "email_history"))
def _(t):
    return sets.union_by_position(t.websites, t.enrichment_email_history.select("domainpart"), t.email_history.select("domainpart"))


@query("except_distinct", oracle("select website from websites except select domain from known_domains", "websites", "known_domains"))
def _(t):
    return sets.minus_distinct(t.websites, t.known_domains)


# ---------------------------------------------------------------- scalars
@query("substr_split_address", oracle(
    "select CurrentCompanyID, " + ", ".join(f"substring(CurrentAddressStreet, {1 + 100 * i}, 100) as street{i + 1}_name" for i in range(5)) + " from employment",
    "employment"))
def _(t):
    parts = street_parts(F.col("CurrentAddressStreet"))
    return t.employment.select("CurrentCompanyID", *[column.alias(name) for name, column in parts.items()])


@query("truncate_columns", oracle(
    "select doc_id, substring(text, 1, 100) as city, substring(text, 1, 255) as country, substring(text, 1, 255) as state, "
    "substring(text, 1, 50) as postal_code from documents"))
def _(t):
    wide = t["documents"].select("doc_id", *[F.col("text").alias(c) for c in ("city", "country", "state", "postal_code")])
    return wide.select("doc_id", *[truncated(c) for c in ("city", "country", "state", "postal_code")])


def key_sql(prefix: str = "", names=ADDRESS_COLUMNS) -> str:
    parts = [f"case when {prefix}{c} is null then '-' else concat(length({prefix}{c}), ':', {prefix}{c}) end" for c in names]
    return f"sha256(concat_ws('|', {', '.join(parts)}))"


@query("address_hash", oracle(f"select address_key, {key_sql()} as match_key from address_parts", "address_parts"))
def _(t):
    return t.address_parts.select("address_key", address_key(ADDRESS_COLUMNS).alias("match_key"))


@query("upper_trim", oracle("select CurrentCompanyID, upper(trim(CurrentAddressState)) as state from employment", "employment"))
def _(t):
    return t.employment.select("CurrentCompanyID", upper_trim(F.col("CurrentAddressState")).alias("state"))


@query("if_null_flag", oracle(
    "select c_custkey, case when p.person_key is null then 0 else 1 end as flag from customer left join (select distinct person_key from person_address) p "
    "on c_custkey = p.person_key", "person_address"))
def _(t):
    known = t.person_address.select("person_key").distinct()
    joined = t["customer"].join(known, F.col("c_custkey") == F.col("person_key"), "left")
    return joined.select("c_custkey", F.when(F.col("person_key").isNull(), 0).otherwise(1).alias("flag"))


@query("date_shift_format", "select o_orderkey, strftime(o_orderdate - interval 15 day, '%Y-%m-%d') as back_date from orders")
def _(t):
    return t["orders"].select("o_orderkey", shifted_date(F.col("o_orderdate"), DAYS).alias("back_date"))


WORD = "case when person_key % 4 = 0 then 'NULL' when person_key % 4 = 1 then 'null' when person_key % 4 = 2 then '' else email_address end"


@query("null_text", oracle(
    f"select person_email_key, case when lower(w) <> 'null' then w end as kept, case when lower(w) not in ('null', '') then w end as filled "
    f"from (select *, {WORD} as w from person_email) s", "person_email"))
def _(t):
    rows = t.person_email.withColumn("w", F.expr(WORD))
    return rows.select("person_email_key", txt.null_text(F.col("w")).alias("kept"), txt.null_or_empty(F.col("w")).alias("filled"))


@query("truncate_description", "select doc_id, case when length(text) >= 500 then substring(text, 1, 498) else text end as description from documents")
def _(t):
    return t["documents"].select("doc_id", txt.truncate_description(F.col("text")).alias("description"))


FORM = "replace(replace(url_encode({0}), '%20', '+'), '~', '%7E')"
STRANGE = "concat(c_name, ' +*~&=é@x.y_z-', c_mktsegment)"


@query("build_request_key", (
    f"select c_custkey, concat('Timeout=30&emailAddress=', replace({FORM.format('s')}, '%2A', '*'), '&outputFormat=json') as email, "
    "concat('emailAddress=', url_encode(s), '&firstname=', url_encode(s), '&lastName=', url_encode(c_name), '&outputFormat=json') as match, "
    "concat('PersonID=', c_custkey, '&outputFieldOptions=jobFunction%2CmanagementLevel%2CcompanyTopLevelIndustry&outputFormat=json') as detail, "
    "case when c_custkey % 2 = 0 then concat('PhoneNumber=', c_custkey, '&outputFormat=json') else concat('Country=GB&PhoneNumber=', c_custkey, '&outputFormat=json') end as phone, "
    "concat('Action=Check&PhoneNumber=', c_custkey, '&outputFormat=json') as reverse, "
    "concat('PhoneNumber=', c_custkey, '&TestType=FULL&outputFormat=json') as owner, concat('domain=', c_custkey, '&outputFormat=json') as domain "
    f"from (select *, {STRANGE} as s from customer) q"))
def _(t):
    rows = t["customer"].withColumn("s", F.expr(STRANGE)).withColumn("k", F.col("c_custkey").cast("string"))
    s, k = F.col("s"), F.col("k")
    country = F.when(F.col("c_custkey") % 2 == 1, "GB")
    return rows.select(
        "c_custkey", txt.email_request(s).alias("email"), txt.match_request(s, F.col("c_name"), s).alias("match"),
        txt.detail_request(k).alias("detail"), txt.phone_request(k, country).alias("phone"), txt.reverse_request(k).alias("reverse"),
        txt.owner_request(k).alias("owner"), txt.domain_request(k).alias("domain"),
    )


@query("base64_text", "select doc_id, text from documents")
def _(t):
    encoded = t["documents"].select("doc_id", F.base64(F.col("text").cast("binary")).alias("b"))
    return encoded.select("doc_id", txt.base64_text(F.col("b")).alias("text"))


NUMBERS_FOUND = (
    "select person_phone_key, telephone_number, case when person_phone_key % 9 = 8 then null when person_phone_key % 3 = 0 then 'GB' "
    "when person_phone_key % 3 = 1 then 'US' else 'XX' end as country_code from person_phone union all "
    "select doc_id, unnest(regexp_extract_all(text, '[+(]?[0-9][0-9() .-]{4,24}[0-9]')), null from documents"
)
STANDARD = ["person_phone_key", "telephone_number", "country_code", "standardised_phone_number", "is_valid_flag"]


def _found_numbers(t: Tables) -> DataFrame:
    country = F.expr("case when person_phone_key % 9 = 8 then null when person_phone_key % 3 = 0 then 'GB' when person_phone_key % 3 = 1 then 'US' else 'XX' end")
    known = t.person_phone.select("person_phone_key", "telephone_number", country.alias("country_code"))
    pattern = F.lit("[+(]?[0-9][0-9() .-]{4,24}[0-9]")
    found = t["documents"].select(
        F.col("doc_id").alias("person_phone_key"), F.explode(F.regexp_extract_all("text", pattern, 0)).alias("telephone_number"),
        F.lit(None).cast("string").alias("country_code"),
    )
    return known.unionByName(found)


@query("standardise_phone", oracle(
    f"select {', '.join(STANDARD)} from std", "person_phone", found=NUMBERS_FOUND, **standardised("found", "telephone_number", "country_code")))
def _(t):
    return standardise(_found_numbers(t), "telephone_number", "country_code").select(*STANDARD)


@query("e164", oracle(
    "select person_phone_key, concat('+', calling_code, standardised_phone_number) as e164 from std where calling_code is not null", "person_phone",
    found=NUMBERS_FOUND, **standardised("found", "telephone_number", "country_code")))
def _(t):
    numbers = standardise(_found_numbers(t), "telephone_number", "country_code").where("calling_code is not null")
    return numbers.select("person_phone_key", e164(F.col("calling_code"), F.col("standardised_phone_number")).alias("e164"))


# ---------------------------------------------------------------- bodies
@query("flatten_email_verdict", oracle("select * from flat", "email_landed", **EMAIL_FLAT))
def _(t):
    return providers.flatten_email_verdict(latest_bodies(t.email_landed, "email"), "request_key")


@query("flatten_phone_verdict", oracle("select * from flat", "phone_landed", **PHONE_FLAT))
def _(t):
    return providers.flatten_phone_verdict(latest_bodies(t.phone_landed, "phone"), "request_key")


def _note(name: str) -> str:
    inside, beside = f"json_exists(j, '$.ExchangeInfoResults[0].PortedInfo.{name}')", at(f"ExchangeInfoResults[0].{name}", "null_text")
    return f"case when {inside} then {beside} end as {name}"


def _note_rule(name: str) -> str:
    return f"(not json_exists(j, '$.ExchangeInfoResults[0].PortedInfo.{name}') or json_exists(j, '$.ExchangeInfoResults[0].{name}'))"


EXCHANGE_FLAT = {
    **answered("exchange_landed"), **readable(),
    "flat": f"select request_key, {columns('ExchangeInfoResults[0]', sb.EXCHANGE_NAMES, 'null_text')}, "
            f"{columns('ExchangeInfoResults[0].PortedInfo', sb.PORTED_NAMES, 'null_text')}, {_note('NoteCodes')}, {_note('NoteDescriptions')} "
            f"from bodies where json_exists(j, '$.ExchangeInfoResults[0]') and {_note_rule('NoteCodes')} and {_note_rule('NoteDescriptions')}",
}


@query("flatten_phone_exchange", oracle("select * from flat", "exchange_landed", **EXCHANGE_FLAT))
def _(t):
    return providers.flatten_phone_exchange(latest_bodies(t.exchange_landed, "phone_exchange"), "request_key")


STRICT = ["City", "EmailAddress", "MelissaAddressKey", "NameFull", "PhoneNumber", "PostalCode", "RecordExtras", "RecordID", "Reserved", "Results", "State"]
REVERSE_FLAT = {
    **answered("reverse_landed"), **readable(),
    "flat": f"select request_key, {columns('Records[0]', sb.REVERSE_NAMES, 'null_text')} from bodies where "
            + " and ".join(f"coalesce(json_type(j, '$.Records[0].{n}'), 'VARCHAR') = 'VARCHAR'" for n in STRICT),
}


@query("flatten_phone_reverse", oracle("select * from flat", "reverse_landed", **REVERSE_FLAT))
def _(t):
    return providers.flatten_phone_reverse(latest_bodies(t.reverse_landed, "phone_reverse"), "request_key")


OWNER_FLAT = {
    **answered("owner_landed"), **readable(),
    "flat": "select request_key, " + ", ".join([
        columns("PhoneInfo.Provider", {f"Provider{n}": n for n in sb.PROVIDER_NAMES}, "null_or_empty"),
        columns("PhoneInfo.Contacts[0]", {f"Contacts{n}": n for n in sb.CONTACT_NAMES}, "null_or_empty"),
        columns("PhoneInfo", sb.OWNER_NAMES, "null_or_empty"),
    ]) + " from bodies where json_exists(j, '$.PhoneInfo')",
}


@query("flatten_phone_owner", oracle("select * from flat", "owner_landed", **OWNER_FLAT))
def _(t):
    return providers.flatten_phone_owner(latest_bodies(t.owner_landed, "phone_owner"), "request_key")


MATCH_ROOT = ".".join(sb.MATCH_PATH)
MATCH_FLAT = {
    **answered("match_landed"), **readable(rejects=("ErrorMessage",)),
    "flat": f"select request_key, {columns(MATCH_ROOT, {n.lower() + '_': n for n in sb.MATCH_NAMES})} from bodies where json_exists(j, '$.{MATCH_ROOT}.matchConfidence')",
}


@query("flatten_person_match", oracle(
    "select request_key, " + ", ".join(f"{n.lower()}_ as {n}" for n in sb.MATCH_NAMES) + " from flat", "match_landed", **MATCH_FLAT))
def _(t):
    return providers.flatten_person_match(latest_bodies(t.match_landed, "person_match"), "request_key")


@query("flatten_person_detail", oracle(
    "select " + columns("PersonDetailRequest", sb.DETAIL_NAMES) + " from people", "detail_landed", **DETAIL_STEPS))
def _(t):
    return providers.flatten_person_detail(_all_details(t))


def _domain_values() -> dict[str, str]:
    out = {}
    for group, names in sb.DOMAIN_GROUPS.items():
        for n in names:
            clean = "as_is" if n == "indexedAt" else "null_text"
            out[f"{group}{'type1' if n == 'type' else n}"] = at(f"{group}.{n}" if group else n, clean)
    return out


def _domain_columns() -> str:
    return ", ".join(f"{value} as {column}" for column, value in _domain_values().items())


def _domain_cells() -> str:
    """All five tables, cell by cell."""
    parts = [cells("domain", "companies", at("id"), _domain_values())]
    return " union all ".join([*parts, *[_domain_list_cells(f"domain_{name}", name) for name in DOMAIN_LISTS]])


DOMAIN_STEPS = {
    **answered("domain_landed"), **readable(rejects=("ErrorMessage",)),
    "companies": f"select * from bodies where {at('id', 'null_text')} <> ''",
}


DOMAIN_BESIDE = {
    **renamed(answered("domain_landed"), "_d"), **renamed(readable("latest_d", ("ErrorMessage",)), "_d"),
    "companies": f"select * from bodies_d where {at('id', 'null_text')} <> ''",
}


def _all_domains(t: Tables) -> DataFrame:
    return latest_bodies(t.domain_landed, "domain")


@query("flatten_domain", oracle(f"select {_domain_columns()} from companies", "domain_landed", **DOMAIN_STEPS))
def _(t):
    return providers.flatten_domain(_all_domains(t))


@query("explode_object_or_array", oracle(
    " union all ".join(_child_cells(target, name) for target, name in DETAIL_CHILDREN.items()), "detail_landed", **DETAIL_STEPS))
def _(t):
    wanted = [x for x in providers.person_detail_targets() if x.name in DETAIL_CHILDREN]
    parsed = providers.parse_person_detail(_all_details(t))
    return cell_rows(fan_out(parsed, at_path(F.col("parsed"), "PersonDetailRequest.PersonID"), wanted), wanted)


@query("explode_scalar_array", oracle(
    " union all ".join([*[_detail_list_cells(x, n) for x, n in DETAIL_LISTS.items()], *[_domain_list_cells(f"domain_{n}", n) for n in DOMAIN_LISTS]]),
    "detail_landed", "domain_landed", **DETAIL_STEPS, **DOMAIN_BESIDE))
def _(t):
    industries = [x for x in providers.person_detail_targets() if x.name in DETAIL_LISTS]
    people = providers.parse_person_detail(_all_details(t))
    of_people = cell_rows(fan_out(people, at_path(F.col("parsed"), "PersonDetailRequest.PersonID"), industries), industries)
    lists = [x for x in providers.domain_targets() if x.name != "domain"]
    companies = providers.parse_domain(_all_domains(t))
    return of_people.unionByName(cell_rows(fan_out(companies, F.col("parsed")["id"], lists), lists))


# ---------------------------------------------------------------- email dataflows
EMAIL_OWNERS = {
    "owners": f"select person_key, email_address, person_email_key from person_email where {IN_MONTH.format('updated_date')} and {VALID} "
              "and person_email_key in (select person_email_key from email_batch) and person_email_key not in "
              f"(select person_email_key from email_history where {SINCE.format('updated_date')})",
    "candidates": "select email_address from owners except select email_address from junk",
}
EMAIL_TABLES = ("person_email", "email_batch", "email_history", "junk")


def email_owners(t: Tables) -> DataFrame:
    return emails.email_owners(t.email_batch, t.person_email, t.email_history, RUN_DATE, DAYS, MONTH)


@query("email_candidates", oracle("select * from candidates", *EMAIL_TABLES, **EMAIL_OWNERS))
def email_candidates(t):
    return emails.email_candidates(email_owners(t), t.junk)


ENRICHED_OWNERS = {
    "owners": "select enrichment_api_person_key as person_key, email_address, person_email_key from (select *, email as email_address, "
              "enrichment_api_person_email_key as person_email_key from enrichment_email) e "
              f"where {EVENT_MONTH.format('updated_date')} and {VALID} and person_email_key in (select enrichment_api_person_email_key from enrichment_batch) "
              f"and person_email_key not in (select person_email_key from event_email_history where {EVENT_SINCE.format('updated_date')}) "
              f"and person_email_key not in (select enrichment_api_person_email_key from enrichment_email_history where {EVENT_SINCE.format('updated_date')})",
    "candidates": "select email_address from owners except select email_address from junk",
}
ENRICHED_TABLES = ("enrichment_email", "enrichment_batch", "event_email_history", "enrichment_email_history", "junk")


@query("email_candidates_enriched", oracle("select * from candidates", *ENRICHED_TABLES, **ENRICHED_OWNERS))
def _(t):
    owners = emails.enriched_email_owners(
        t.enrichment_batch, t.enrichment_email, t.event_email_history, t.enrichment_email_history, EVENT_RUN_DATE, DAYS, MONTH
    )
    return emails.email_candidates(owners, t.junk)


EMAIL_NAMES = (
    "StatusNbr, StatusDescription, Code, Description, HygieneResult, NetProtected, NetProtectedBy, SourceIdentifier, Email, LocalPart, DomainPart, "
    "IronStandardCertifiedTimestamp, DomainKnowledge, StringKeyValuePairKey, StringKeyValuePairValue"
)
EMAIL_LANDED = {
    "staged": f"select distinct {EMAIL_NAMES}, o.person_key, o.person_email_key, '{RUN_TS}' as email_verification_date from flat f "
              f"join (select email_address, {st.EMAIL_KEY} as request_key from candidates) c on f.request_key = c.request_key "
              "join owners o on o.email_address = c.email_address",
}


def email_staged(t: Tables) -> DataFrame:
    owners = stage(email_owners(t), "email_owners")
    verdicts = emails.email_verdicts(emails.email_candidates(owners, t.junk), t.current("email_landed"))
    return emails.email_landing(verdicts, owners, RUN_TS)


@query("email_landing", oracle("select * from staged", *EMAIL_TABLES, "email_landed", **EMAIL_OWNERS, **EMAIL_FLAT, **EMAIL_LANDED))
def _(t):
    return written_at(email_staged(t), emails.DATE)


EMAIL_AGAIN = {
    "both_landed": "select * from email_landed union all select * from rerun_landed",
    **renamed({**EMAIL_FLAT, **answered("both_landed"), "latest": f"select request_key, body from ranked where rn = 1 and fetched_at > timestamp '{RUN_TS}'"}, "2"),
}


@query("email_rerun", oracle(
    f"select distinct {', '.join('n.' + c.strip() for c in EMAIL_NAMES.split(','))}, s.person_key, s.person_email_key, '{RUN_TS}' as email_verification_date "
    f"from (select distinct Email as email_address, person_key, person_email_key from staged where StatusNbr = '220' and Code = '222') s "
    f"join flat2 n on n.request_key = {st.EMAIL_KEY}", *EMAIL_TABLES, "email_landed", "rerun_landed", **EMAIL_OWNERS, **EMAIL_FLAT, **EMAIL_LANDED, **EMAIL_AGAIN))
def _(t):
    landed = t.email_landed.unionByName(t.rerun_landed)
    staged = staged_by_run(t, email_staged(t), "email_verdicts", "person_key")
    return written_at(emails.email_rerun(staged, landed, run_ts=RUN_TS), emails.DATE)


@query("candidate_funnel", oracle(
    f"select 'changed' as stage, count(*) as rows from person_email where {IN_MONTH.format('updated_date')} union all "
    "select 'owners', count(*) from owners union all select 'distinct', count(distinct email_address) from owners union all "
    "select 'candidates', count(*) from candidates", *EMAIL_TABLES, **EMAIL_OWNERS))
def _(t):
    progress = Progress()
    progress.stage(changed_in(t.person_email, "updated_date", RUN_DATE, MONTH), "changed")
    owners = progress.stage(email_owners(t), "owners")
    distinct = progress.stage(sets.distinct_keys(owners, "email_address"), "distinct")
    progress.stage(emails.email_candidates(distinct, t.junk), "candidates")
    progress.close()
    return t.spark.createDataFrame(list(progress.rows.items()), "stage string, rows long")


# ---------------------------------------------------------------- phone dataflows
PHONE_TABLES = ("batch", "person_phone", "person_address", "address_country", "synonyms", "phone_history", "enrichment_phone_history", "exchange_history")
RECENT_PHONES = " union all ".join(
    f"select phone_number from {h} where {{0}}" for h in ("phone_history", "enrichment_phone_history", "exchange_history")
)
PHONE_STEPS = {
    "asked": "select distinct person_phone_key, telephone_number, country_code from person_phone p "
             "join person_address b on p.person_key = b.person_key join address_country a on b.address_key = a.address_key "
             f"join synonyms s on a.country = s.country_synonym where telephone_number is not null and {IN_MONTH.format('updated_date')} "
             "and p.person_key in (select person_key from batch)",
    **standardised("asked", "telephone_number", "country_code"),
    "candidates": f"select {', '.join(STANDARD)} from std where standardised_phone_number not in ({RECENT_PHONES.format(SINCE.format('updated_date'))})",
}


def phone_candidates(t: Tables) -> DataFrame:
    return phones.phone_candidates(
        t.batch, t.person_phone, t.person_address, t.address_country, t.synonyms,
        t.phone_history, t.enrichment_phone_history, t.exchange_history, **RECENT, grain=MONTH,
    )


@query("phone_candidates", oracle("select * from candidates", *PHONE_TABLES, **PHONE_STEPS))
def _(t):
    return phone_candidates(t)


ENRICHED_PHONE_STEPS = {
    "asked": "select enrichment_api_person_phone_key as person_phone_key, phone_number as telephone_number, cast(null as varchar) as country_code from enrichment_phone "
             f"where phone_number is not null and {EVENT_MONTH.format('updated_date')}",
    **standardised("asked", "telephone_number", None),
    "candidates": f"select {', '.join(STANDARD)} from std where standardised_phone_number not in ({RECENT_PHONES.format(EVENT_SINCE.format('updated_date'))})",
}


@query("phone_candidates_enriched", oracle(
    "select * from candidates", "enrichment_phone", "phone_history", "enrichment_phone_history", "exchange_history", **ENRICHED_PHONE_STEPS))
def _(t):
    return phones.phone_candidates_enriched(
        t.enrichment_phone, t.phone_history, t.enrichment_phone_history, t.exchange_history,
        run_date=EVENT_RUN_DATE, days=DAYS, grain=MONTH,
    )


@query("phone_standardisation_log", oracle(f"select {LOG_COLUMNS} from candidates", *PHONE_TABLES, **PHONE_STEPS))
def _(t):
    return _log(phone_candidates(t))


PHONE_NAMES = ", ".join(sb.PHONE_VERDICT_NAMES)
PHONE_LANDED = {
    "keyed": f"select *, {st.COUNTRY_PHONE_KEY.replace('number', 'standardised_phone_number')} as request_key from candidates",
    "staged": f"select distinct standardised_phone_number, country_code, {PHONE_NAMES}, person_phone_key, '{RUN_TS}' as phone_verification_date "
              "from flat join keyed using (request_key)",
}


def phone_staged(t: Tables) -> DataFrame:
    candidates = stage(phone_candidates(t), "phone_candidates")
    return phones.phone_landing(phones.phone_verdicts(candidates, t.current("phone_landed")), candidates, RUN_TS)


@query("phone_landing", oracle(
    f"select {PHONE_NAMES}, person_phone_key, phone_verification_date from staged", *PHONE_TABLES, "phone_landed", **PHONE_STEPS, **PHONE_FLAT, **PHONE_LANDED))
def _(t):
    return written_at(phone_staged(t), phones.DATE)


PHONE_MORE = {k: v for k, v in EXCHANGE_FLAT.items() if k != "flat"}


ESCALATION = {
    "hits": "select distinct person_phone_key, PhoneNumber from staged where (contains(Results, 'PS02') or contains(Results, 'PS16')) and person_phone_key not in "
            f"(select person_phone_key from exchange_history where {SINCE.format('updated_date')})",
    **renamed(EXCHANGE_FLAT, "2"),
}
EXCHANGE_COLUMNS = [*sb.EXCHANGE_NAMES, *sb.PORTED_NAMES, "NoteCodes", "NoteDescriptions"]


@query("phone_escalation", oracle(
    f"select distinct {', '.join('f.' + c for c in EXCHANGE_COLUMNS)}, h.person_phone_key, '{RUN_TS}' as phone_verification_date from hits h "
    "join flat2 f on f.request_key = concat('PhoneNumber=', h.PhoneNumber, '&outputFormat=json')",
    *PHONE_TABLES, "phone_landed", "exchange_landed", **PHONE_STEPS, **PHONE_FLAT, **PHONE_LANDED, **ESCALATION))
def _(t):
    return written_at(
        phones.phone_escalation(stage(phone_staged(t), "phone_verdicts"), t.exchange_history, t.exchange_landed, RUN_DATE, DAYS, run_ts=RUN_TS), phones.DATE
    )


BRANCH_STAGED = "select cast(length(request_key) as bigint) as person_phone_key, PhoneNumber, Results from flat"


@query("branch_if_any", oracle(
    f"select distinct {', '.join('f.' + c for c in EXCHANGE_COLUMNS)}, h.person_phone_key, '{RUN_TS}' as phone_verification_date from hits h "
    "join flat2 f on f.request_key = concat('PhoneNumber=', h.PhoneNumber, '&outputFormat=json')",
    "phone_landed", "exchange_landed", "exchange_history", **PHONE_FLAT, staged=BRANCH_STAGED, **ESCALATION))
def _(t):
    flat = providers.flatten_phone_verdict(latest_bodies(t.phone_landed, "phone"), "request_key")
    staged = flat.withColumn("person_phone_key", F.length("request_key").cast("bigint"))
    # The first set has no escalation code at all: its branch adds no rows, and nothing is counted to find out.
    branches = [
        phones.phone_escalation(rows, t.exchange_history, t.exchange_landed, RUN_DATE, DAYS, run_ts=RUN_TS)
        for rows in (staged.where(~phones.escalates(F.col("Results"))), staged)
    ]
    return written_at(branches[0].unionByName(branches[1]), phones.DATE)


REVERSE_TABLES = ("batch", "person_phone", "reverse_history")
REVERSE_STEPS = {
    "asked": "select p.person_phone_key, telephone_number from person_phone p join batch using (person_key) where p.person_phone_key not in "
             f"(select person_phone_key from reverse_history where {SINCE.format('updated_date')})",
    **standardised("asked", "telephone_number", None),
}
REVERSE_LANDED = {
    "staged": f"select distinct standardised_phone_number, {', '.join(sb.REVERSE_NAMES)}, person_phone_key, '{RUN_TS}' as phone_verification_date from flat "
              "join std on request_key = concat('Action=Check&PhoneNumber=', standardised_phone_number, '&outputFormat=json')",
}


def reverse_staged(t: Tables) -> DataFrame:
    candidates = stage(phones.reverse_candidates(t.batch, t.person_phone, t.reverse_history, RUN_DATE, DAYS), "reverse_candidates")
    return phones.reverse_lookup(candidates, t.reverse_landed, run_ts=RUN_TS)


@query("reverse_lookup", oracle(
    f"select {', '.join(sb.REVERSE_NAMES)}, person_phone_key, phone_verification_date from staged", *REVERSE_TABLES, "reverse_landed",
    **REVERSE_STEPS, **REVERSE_FLAT, **REVERSE_LANDED))
def _(t):
    return written_at(reverse_staged(t), phones.DATE)


OWNER_COLUMNS = [f"Provider{n}" for n in sb.PROVIDER_NAMES] + [f"Contacts{n}" for n in sb.CONTACT_NAMES] + sb.OWNER_NAMES
REVERSE_ESCALATION = {
    "hits": "select person_phone_key, PhoneNumber as telephone_number from staged where (contains(Results, 'PS02') or contains(Results, 'PS16')) "
            f"and person_phone_key not in (select person_phone_key from exchange_history where {SINCE.format('updated_date')})",
    **renamed(standardised("hits", "telephone_number", None), "2"),
    **renamed(OWNER_FLAT, "3"),
}


@query("reverse_escalation", oracle(
    f"select distinct standardised_phone_number as phonenumber, {', '.join(OWNER_COLUMNS)}, person_phone_key, '{RUN_TS}' as phone_verification_date from std2 "
    "join flat3 on request_key = concat('PhoneNumber=', standardised_phone_number, '&TestType=FULL&outputFormat=json')",
    *REVERSE_TABLES, "reverse_landed", "owner_landed", "exchange_history", **REVERSE_STEPS, **REVERSE_FLAT, **REVERSE_LANDED, **REVERSE_ESCALATION))
def _(t):
    staged = staged_by_run(t, reverse_staged(t), "reverse_verdicts", "person_phone_key")
    candidates = stage(phones.reverse_escalation_candidates(staged, t.exchange_history, RUN_DATE, DAYS), "reverse_escalation")
    return written_at(phones.reverse_escalation(candidates, t.owner_landed, run_ts=RUN_TS), phones.DATE)


# ---------------------------------------------------------------- person dataflows
MATCH_STEPS = {
    "owners": "select distinct b.person_key, first_name, last_name, email_address from batch b join person_email e on b.person_key = e.person_key "
              f"where {IN_MONTH.format('person_updated_date')} and b.person_key not in (select person_key from bridged_person)",
    **MATCH_FLAT,
    "matched": "select first_name, last_name, email_address, person_key, " + ", ".join(f"{n.lower()}_ as {n}" for n in sb.MATCH_NAMES if n not in ("firstName", "lastName"))
               + ", firstname_, lastname_ from owners join flat on request_key = "
               "concat('emailAddress=', url_encode(email_address), '&firstname=', first_name, '&lastName=', last_name, '&outputFormat=json')",
}
MATCH_TABLES = ("batch", "person_email", "bridged_person", "match_landed")


def match_owners(t: Tables) -> DataFrame:
    return persons.match_owners(t.batch, t.bridged_person, t.person_email, RUN_DATE, MONTH)


@query("person_match", oracle(
    "select * exclude (firstname_, lastname_), firstname_ as firstName, lastname_ as lastName from matched", *MATCH_TABLES, **MATCH_STEPS))
def _(t):
    owners = stage(match_owners(t), "match_owners")
    return persons.person_match(persons.person_matches(owners, t.current("match_landed")), owners)


DETAIL_OF_MATCH = {
    **MATCH_STEPS,
    "wanted": "select distinct personId as person_id from matched where personId is not null and personId not in "
              f"(select person_id from enriched_person where {SINCE.format('updated_date')})",
    **renamed(answered("detail_landed"), "2"),
    "mine": f"select body from latest2 join wanted on request_key = {st.DETAIL_KEY}",
    **renamed(readable("mine", ("ErrorMessage",)), "3"),
    "people": f"select *, {at('PersonDetailRequest.PersonID')} as PersonID from bodies3 where {at('PersonDetailRequest.PersonID')} <> ''",
}


@query("person_detail", oracle(_detail_cells(), *MATCH_TABLES, "enriched_person", "detail_landed", **DETAIL_OF_MATCH))
def _(t):
    matches = persons.person_matches(match_owners(t), t.current("match_landed"))
    ids = persons.detail_ids(matches, t.enriched_person, RUN_DATE, DAYS)
    return _detail_rows(persons.person_details(ids, t.detail_landed))


def _detail_rows(details: DataFrame) -> DataFrame:
    return cell_rows(providers.person_detail_fan_out(details), providers.person_detail_targets())


@query("person_detail_bulk", oracle(_detail_cells(), "detail_landed", **DETAIL_STEPS))
def _(t):
    return _detail_rows(persons.person_details(t.person_ids, t.detail_landed))


# ---------------------------------------------------------------- domains, addresses
@query("domain_enrichment", oracle(
    _domain_cells(), "websites", "enrichment_email_history", "email_history", "known_domains", "domain_landed",
    candidates="select website from websites union select domainpart from enrichment_email_history union select domainpart from email_history "
               "except select domain from known_domains",
    **answered("domain_landed"),
    mine=f"select body from latest join candidates on request_key = {st.DOMAIN_KEY}",
    **renamed(readable("mine", ("ErrorMessage",)), "2"),
    companies=f"select * from bodies2 where {at('id', 'null_text')} <> ''"))
def _(t):
    wanted = domains.domain_candidates(t.websites, t.enrichment_email_history, t.email_history, known=t.known_domains)
    return cell_rows(providers.domain_fan_out(domains.domain_details(wanted, t.domain_landed)), providers.domain_targets())


ADDRESS_LIST = "CurrentCompanyID, street1_name, street2_name, street3_name, street4_name, street5_name, city, country, state, postal_code"


def keyed(df: DataFrame) -> DataFrame:
    """An address table with the key that is stored with it."""
    return df.withColumn("match_key", address_key())


@query("address_load", oracle(
    f"select distinct {ADDRESS_LIST}, address_state_key, k as match_key, 0 as update_flag from cut left join states s on upper(trim(country)) = upper(trim(country_synonym)) "
    f"and upper(trim(state)) = upper(trim(state_name)) where k not in (select {key_sql(names=FULL_COLUMNS)} from known_address)",
    "employment", "known_address", "states",
    cut=f"select CurrentCompanyID, {st._STREETS}, {st._CUT}, {key_sql(names=FULL_COLUMNS)} as k from employment"))
def _(t):
    # The Murmur3 value is not compared: the other engine has a different hash.
    return addresses.address_load(t.employment, keyed(t.known_address), t.states).drop("hash_key_val")


@query("address_bridge", oracle(
    "select distinct p.enrichment_api_company_key, p.address_type_key, p.address_key, case when b.enrichment_api_company_key is null then 0 else 1 end as update_flag from "
    "(select c.enrichment_api_company_key, 30000031 as address_type_key, k.address_key from company_address a, company c, address_parts k "
    f"where a.CurrentCompanyID = c.enrichment_api_company_id and {key_sql('a.', FULL_COLUMNS)} = {key_sql('k.', FULL_COLUMNS)}) p left join company_bridge b "
    "on p.enrichment_api_company_key = b.enrichment_api_company_key and p.address_type_key = b.address_type_key and p.address_key <> b.address_key",
    "company_address", "company", "address_parts", "company_bridge"))
def _(t):
    return addresses.address_bridge(keyed(t.company_address), t.company, keyed(t.address_parts), t.company_bridge)


__all__ = ["QUERIES", "email_candidates"]
