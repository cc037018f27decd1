"""The role tables as SQL that reads the same in Spark and DuckDB.

Each table is a common table expression over the given tables (written `@name`), so
its size grows with them. Shares of the rows are made invalid, shared, repeated or
missing by key arithmetic, so that every filter and join has something to do.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from cleanroll.functions.periods import MONTH
from cleanroll.session import scratch_root
from cleanroll.sinks import ParquetSink
from cleanroll.sources.current import CurrentAnswers
from standins.bodies import EXTRA, OWNER, TEMPLATES

# The run the queries play: the July 2001 batch for order-based tables, January 2024 for events.
RUN_DATE = "2001-07-31"
EVENT_RUN_DATE = "2024-01-31"
DAYS = -15
RUN_TS = "2001-07-31 12:00:00"


def pick(n: str, *choices: str) -> str:
    """`choices[n]`, the last one for every other value."""
    whens = " ".join(f"when {n} = {i} then {c}" for i, c in enumerate(choices[:-1]))
    return f"case {whens} else {choices[-1]} end"


def landed(provider: str, source: str, owner: str, key: str, when: str, extra: str = "", seed: str = "") -> str:
    """Landed responses of one provider for each `owner` of `source`.

    A body is one of the provider's templates with the owner written into it; the
    owner's MD5, on which both engines agree, says which one; a `seed` makes it another one.
    """
    bodies = [f"'{t}'" for t in TEMPLATES[provider]]
    picked = f"select {key} as request_key, {when} as fetched_at, {owner} as owner, {extra or owner} as detail, md5(concat({owner}, '{seed}')) as h from {source}"
    numbered = (
        f"select *, (ascii(substring(h, 1, 1)) * 31 + ascii(substring(h, 2, 1)) * 7 + ascii(substring(h, 3, 1))) % {len(bodies)} as b, "
        f"(ascii(substring(h, 4, 1)) * 31 + ascii(substring(h, 5, 1))) % 23 as s from ({picked}) p"
    )
    return (
        f"select '{provider}' as provider, request_key, {pick('s', '500', '404', '200')} as status, "
        f"replace(replace({pick('b', *bodies)}, '{OWNER}', owner), '{EXTRA}', detail) as body, fetched_at from ({numbered}) n"
    )


def email_of(person: str, row: str) -> str:
    return f"""case
        when {row} % 23 = 0 then null
        when {row} % 19 = 0 then concat('Customer.', {person}, '@MAIL.example.com')
        when {row} % 17 = 0 then concat('customer..', {person}, '@mail.example.com')
        when {row} % 13 = 0 then 'noreply@mail.example.com'
        when {row} % 3 = 0 then concat('office', {person} % 50, '@site.example.com')
        else concat('customer.', {person}, '@mail', {person} % 10, '.example.com') end"""


def national(person: str) -> str:
    return f"concat(200 + {person} % 700, '555', lpad(cast({person} % 10000 as string), 4, '0'))"


def phone_of(person: str, row: str) -> str:
    area, line = f"200 + {person} % 700", f"lpad(cast({person} % 10000 as string), 4, '0')"
    return pick(
        f"{row} % 13",
        "cast(null as string)",
        f"concat('+1 (', {area}, ') 555-', {line})",
        f"concat('1-', {area}, '-555-', {line})",
        f"concat({area}, '.555.', {line})",
        f"concat('555-', {line})",
        "'call me'",
        f"concat('+44 20 7946 ', {line})",
        f"concat('020 7946 ', {line})",
        f"concat('+33 1 7018 ', {line})",
        f"concat('+999 1234', {line})",
        "'(212) 555-0100'",
        f"concat('+44 (0)20 7946 ', {line})",
        f"concat('(', {area}, ') 555 ', {line})",
    )


ENC = "replace(replace({0}, '@', '%40'), '+', '%2B')"
EMAIL_KEY = f"concat('Timeout=30&emailAddress=', {ENC.format('email_address')}, '&outputFormat=json')"
PHONE_KEY = "concat('PhoneNumber=', number, '&outputFormat=json')"
COUNTRY_PHONE_KEY = f"case when country_code is null then {PHONE_KEY} else concat('Country=', country_code, '&', {PHONE_KEY}) end"
REVERSE_KEY = f"concat('Action=Check&', {PHONE_KEY})"
OWNER_KEY = "concat('PhoneNumber=', number, '&TestType=FULL&outputFormat=json')"
MATCH_KEY = (
    f"concat('emailAddress=', {ENC.format('email_address')}, '&firstname=', first_name, '&lastName=', last_name, '&outputFormat=json')"
)
DETAIL_KEY = (
    "concat('PersonID=', person_id, '&outputFieldOptions=jobFunction%2CmanagementLevel%2CcompanyTopLevelIndustry&outputFormat=json')"
)
DOMAIN_KEY = "concat('domain=', website, '&outputFormat=json')"

PERSON_ID = "concat('P', length(email_address), '-', substring(md5(email_address), 1, 16))"

_LINE = "lpad(cast(o_custkey % 10000 as string), 4, '0')"
NUMBER_FORMS = [national("o_custkey"), "'2125550100'", f"concat('207946', {_LINE})", f"concat('17018', {_LINE})"]
COUNTRY_OF_ROW = pick("o_orderkey % 8", "'US'", "'GB'", "'FR'", "'DE'", "'IN'", "'ZZ'", "'CA'", "null")
FETCHED = "timestamp '2001-07-31 00:00:00'"
ADDRESS_NAMES = ["street1_name", "street2_name", "street3_name", "street4_name", "street5_name", "city", "country", "state", "postal_code"]
HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
SITE = f"concat('site', page_id, '.', {HOST})"  # one a page, so that the domains grow with the pages
_STREETS = ", ".join(f"substring(CurrentAddressStreet, {1 + 100 * i}, 100) as street{i + 1}_name" for i in range(5))
_CUT = (
    "substring(CurrentAddressCity, 1, 100) as city, substring(CurrentAddressCountryCode, 1, 255) as country, "
    "substring(CurrentAddressState, 1, 255) as state, substring(CurrentAddressZip, 1, 50) as postal_code"
)
_FULL = "CurrentAddressStreet, CurrentAddressCity, CurrentAddressCountryCode, CurrentAddressState, CurrentAddressZip"
RERUN_FETCHED = "timestamp '2025-01-01 00:00:00'"

TABLES: dict[str, str] = {
    # persons and emails
    "person": "select c_custkey as person_key, split_part(c_name, '#', 1) as first_name, "
              "case when c_custkey % 29 = 0 then null else split_part(c_name, '#', 2) end as last_name, "
              "max(o_orderdate) as person_updated_date from @orders join @customer on o_custkey = c_custkey group by c_custkey, c_name",
    "batch": "select * from person union all select * from person where person_key % 10 = 0",
    "person_email": f"select o_orderkey as person_email_key, o_custkey as person_key, {email_of('o_custkey', 'o_orderkey')} as email_address, "
                    "o_orderdate as updated_date from @orders",
    "email_batch": "select l_orderkey as person_email_key from @lineitem where l_returnflag <> 'A'",
    "email_history": "select l_orderkey as person_email_key, l_shipdate as updated_date, "
                     "concat('mail', l_suppkey, '.example.com') as domainpart from @lineitem "
                     "where l_returnflag = 'R' and l_linestatus = 'F'",
    "junk": "select 'noreply@mail.example.com' as email_address from @region union all "
            "select concat('office', n_nationkey, '@site.example.com') from @nation where n_nationkey % 2 = 0",
    "enrichment_email": f"select event_id as enrichment_api_person_email_key, user_id as enrichment_api_person_key, "
                        f"{email_of('user_id', 'event_id')} as email, ts as updated_date from @events",
    "enrichment_batch": "select event_id as enrichment_api_person_email_key from @events where event_type <> 'view' union all "
                        "select event_id from @events where event_type = 'signup'",
    "enrichment_email_history": "select event_id as enrichment_api_person_email_key, ts as updated_date, "
                                "concat('mail', user_id, '.example.com') as domainpart from @events where event_type = 'signup' and value > 20",
    "event_email_history": "select event_id + 1 as person_email_key, ts as updated_date from @events where event_type = 'error'",
    # phones and places
    "person_phone": f"select o_orderkey as person_phone_key, o_custkey as person_key, {phone_of('o_custkey', 'o_orderkey')} as telephone_number, "
                    "o_orderdate as updated_date from @orders",
    "enrichment_phone": f"select event_id as enrichment_api_person_phone_key, user_id as enrichment_api_person_key, "
                        f"{phone_of('user_id', 'event_id')} as phone_number, ts as updated_date from @events",
    "phone_history": f"select {national('o_custkey')} as phone_number, o_orderdate as updated_date from @orders where o_orderstatus = 'F' and o_orderkey % 4 = 0",
    "enrichment_phone_history": f"select {national('user_id')} as phone_number, ts as updated_date from @events where user_id % 5 = 0",
    "exchange_history": f"select l_orderkey as person_phone_key, {national('l_orderkey')} as phone_number, l_shipdate as updated_date "
                        "from @lineitem where l_returnflag = 'N' and l_linenumber = 1",
    "reverse_history": "select l_orderkey as person_phone_key, l_shipdate as updated_date from @lineitem where l_returnflag = 'R' and l_linenumber < 4",
    "person_address": "select c_custkey as person_key, c_custkey as address_key from @customer where c_custkey % 5 <> 0 union all "
                      "select c_custkey, c_custkey % 97 from @customer where c_custkey % 3 = 0",
    "address_country": "select p_partkey as address_key, case when p_partkey % 9 = 0 then null else concat('COUNTRY_', p_size % 25) end as country from @part",
    "synonyms": "select concat('COUNTRY_', n_nationkey) as country_synonym, "
                + pick("n_nationkey % 7", "'US'", "'GB'", "'FR'", "'DE'", "'IN'", "'ZZ'", "'CA'")
                + " as country_code from @nation where n_nationkey <> 7",
    # landed responses
    "email_keys": "select email_address, updated_date from person_email where email_address is not null union all "
                  "select email, updated_date from enrichment_email where email is not null",
    "email_landed": landed("email", "email_keys", "email_address", EMAIL_KEY, "updated_date", "split_part(email_address, '@', 2)"),
    # What the email provider answers when it is asked again later.
    "rerun_keys": "select distinct email_address from email_keys",
    "rerun_landed": landed("email", "rerun_keys", "email_address", EMAIL_KEY, RERUN_FETCHED, "split_part(email_address, '@', 2)", "again"),
    "numbers": " union ".join(f"select {n} as number from @orders" for n in NUMBER_FORMS),
    "country_numbers": " union ".join(f"select {n} as number, {COUNTRY_OF_ROW} as country_code from @orders" for n in NUMBER_FORMS),
    "phone_landed": landed("phone", "country_numbers", "number", COUNTRY_PHONE_KEY, FETCHED),
    "exchange_landed": landed("phone_exchange", "numbers", "number", PHONE_KEY, FETCHED),
    "reverse_landed": landed("phone_reverse", "numbers", "number", REVERSE_KEY, FETCHED),
    "owner_landed": landed("phone_owner", "numbers", "number", OWNER_KEY, FETCHED),
    "match_keys": "select first_name, last_name, email_address, updated_date from person join person_email "
                  "on person.person_key = person_email.person_key where email_address is not null and last_name is not null",
    "match_landed": landed("person_match", "match_keys", "email_address", MATCH_KEY, "updated_date", PERSON_ID),
    "person_ids": f"select distinct {PERSON_ID} as person_id from person_email where email_address is not null",
    "detail_landed": landed("person_detail", "person_ids", "person_id", DETAIL_KEY, FETCHED),
    "enriched_person": f"select {PERSON_ID} as person_id, updated_date from person_email where person_email_key % 7 = 0 and email_address is not null",
    "bridged_person": "select c_custkey as person_key from @customer where c_custkey % 4 = 0 union all select c_custkey from @customer where c_custkey % 8 = 0",
    "websites": f"select {SITE} as website from @pages union all select case when r_regionkey < 0 then r_name end from @region",
    "known_domains": f"select {SITE} as domain from @pages where page_id % 3 = 0 union all select case when n_nationkey < 0 then n_name end from @nation",
    "all_websites": "select website from websites where website is not null union select domainpart from email_history union "
                    "select domainpart from enrichment_email_history",
    "domain_landed": landed("domain", "all_websites", "website", DOMAIN_KEY, FETCHED),
    # company addresses
    "employment": "select concat('C', doc_id % 200) as CurrentCompanyID, text as CurrentAddressStreet, source as CurrentAddressCity, "
                  "case when doc_id % 6 = 0 then null else concat(' ', lang, ' ') end as CurrentAddressState, "
                  "case when doc_id % 7 = 0 then null else cast(n_chars as string) end as CurrentAddressZip, "
                  "lower(concat('country_', doc_id % 25)) as CurrentAddressCountryCode from @documents",
    "address_parts": f"select doc_id as address_key, {_STREETS}, {_CUT}, {_FULL} from (select doc_id, text as CurrentAddressStreet, source as CurrentAddressCity, "
                     "case when doc_id % 6 = 0 then null else concat(' ', lang, ' ') end as CurrentAddressState, "
                     "case when doc_id % 7 = 0 then null else cast(n_chars as string) end as CurrentAddressZip, "
                     "lower(concat('country_', doc_id % 25)) as CurrentAddressCountryCode from @documents) d",
    "known_address": "select * from address_parts where address_key % 3 = 0",
    "states": "select distinct concat('COUNTRY_', doc_id % 25) as country_synonym, upper(lang) as state_name, "
              "(doc_id % 25) * 10 + length(lang) as address_state_key from @documents where doc_id % 4 <> 1",
    "company": "select concat('C', s_suppkey) as enrichment_api_company_id, s_suppkey as enrichment_api_company_key from @supplier",
    "company_address": f"select concat('C', address_key % 200) as CurrentCompanyID, {', '.join(ADDRESS_NAMES)}, {_FULL} from address_parts",
    "company_bridge": "select 30000031 as address_type_key, p_partkey % 200 as enrichment_api_company_key, p_partkey % 400 as address_key from @part where p_partkey % 3 <> 0",
    # run log
    "run_master": "select o_orderkey as batch_id from @orders",
    "entity": "select r_regionkey + 100 as entity_detail_key, r_name as entity_name from @region",
}

_NAME = re.compile(r"\b(?:" + "|".join(TABLES) + r")\b")


_BASE = re.compile(r"\b(from|join) @(\w+)")


def _literal_free(sql: str) -> str:
    return re.sub(r"'[^']*'", "''", sql)


def ctes(*names: str) -> list[tuple[str, str]]:
    """The tables and what they read, in dependency order."""
    done: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in done:
            return
        for needed in dict.fromkeys(_NAME.findall(_literal_free(TABLES[name]))):
            if needed != name and re.search(rf"(?:from|join)\s+{needed}\b", TABLES[name]):
                visit(needed)
        done[name] = TABLES[name]

    for name in names:
        visit(name)
    return list(done.items())


def _spark_sql(sf_dir: str, name: str, deal: int = 0) -> str:
    """The table as Spark SQL; its given tables, cut to the columns it reads, are dealt to `deal` tasks if that is given."""
    with_ = ", ".join(f"{n} as ({sql})" for n, sql in ctes(name))
    files = rf"\1 (select /*+ REPARTITION({deal}) */ * from parquet.`{sf_dir}/\2.parquet`)" if deal else rf"\1 parquet.`{sf_dir}/\2.parquet`"
    return _BASE.sub(files, f"with {with_} select * from {name}")


# Contacts and responses are stored tables in real life: Spark writes them to the shared folder on
# first use in a session, and the queries scan them there.
STORED = {"person_email", "enrichment_email", "person_phone", "enrichment_phone"}
# Histories are stored by month: the given tables have few rows a day.
HISTORIES = {"email_history", "enrichment_email_history", "event_email_history", "phone_history", "enrichment_phone_history", "exchange_history", "reverse_history"}
_WRITTEN: dict[tuple[str, str, str], str] = {}


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One role table as a DataFrame over the parquet files of `sf_dir`."""
    sf_dir = sf_dir.rstrip("/")
    if name not in STORED | HISTORIES and not name.endswith("_landed"):
        return spark.sql(_spark_sql(sf_dir, name))
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        # Several files, as a stored table has: the given ones are single files and would be read by one task. Their rows are
        # dealt before texts are made of them; the keys of most answers come from a join or a distinct, which deals them anyway.
        deal = spark.sparkContext.defaultParallelism if name in STORED | {"email_landed"} else 0
        rows, folder = spark.sql(_spark_sql(sf_dir, name, deal)), f"{name}-{uuid.uuid4().hex}"
        if name in HISTORIES:
            ParquetSink(spark, scratch_root(spark), periods={folder: ("updated_date", MONTH)}).append(rows, folder)
        else:
            rows.write.option("compression", "zstd").parquet(f"{scratch_root(spark)}/{folder}")
        _WRITTEN[key] = f"{scratch_root(spark)}/{folder}"
    return spark.read.parquet(_WRITTEN[key])


CURRENT_BUCKETS = 16


def current_answers(spark: SparkSession, sf_dir: str, name: str) -> CurrentAnswers:
    """The current answers of a landed table, folded in on first use: one half of its keys, then the other."""
    landed, sf_dir = standin(spark, sf_dir, name), sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir, f"current {name}")
    if key not in _WRITTEN:
        _WRITTEN[key] = f"current_{uuid.uuid4().hex[:12]}"
        current = CurrentAnswers(spark, _WRITTEN[key], scratch_root(spark), CURRENT_BUCKETS)
        provider = landed.select("provider").first().provider
        for half in ("hash(request_key) % 2 = 0", "hash(request_key) % 2 <> 0"):  # rows without a key are in neither, no fold takes them
            current.fold(landed.where(half), provider)
    return CurrentAnswers(spark, _WRITTEN[key], scratch_root(spark), CURRENT_BUCKETS)


def oracle(body: str, *names: str, **extra: str) -> str:
    """DuckDB SQL: the role tables, further named steps, then `body`."""
    steps = [*ctes(*names), *extra.items()]
    with_ = ", ".join(f"{n} as ({sql})" for n, sql in steps)
    return _BASE.sub(r"\1 \2", f"with {with_} {body}" if steps else body)
