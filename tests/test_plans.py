"""The physical plans: what reaches the scan, what is split, what is never used."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cleanroll.functions.periods import changed_in, since
from cleanroll.operators import joins, sets
from cleanroll.operators.landing import land
from cleanroll.operators.providers import flatten_phone_verdict
from cleanroll.plans import emails
from cleanroll.sources.answers import answers

ROOT = Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_both_period_bounds_and_the_back_date_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan(changed_in(orders, "o_orderdate", "2001-07-31", "month"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "GreaterThanOrEqual(o_orderdate" in plan(since(orders, "o_orderdate", "2001-07-31", -15))


def test_email_candidates_scan_each_table_once_and_only_their_columns(spark, tmp_path):
    for name, cols in {
        "batch": "id as person_email_key, 'x' as other",
        "emails": "id as person_email_key, id as person_key, concat('a', id, '@b.co') as email_address, timestamp_ntz'2001-07-05' as updated_date, 'x' as other",
        "history": "id as person_email_key, timestamp_ntz'2001-07-20' as updated_date, 'x' as domainpart",
        "junk": "'a1@b.co' as email_address",
    }.items():
        spark.range(10).selectExpr(*[c.strip() for c in re.split(r",(?![^(]*\))", cols)]).write.parquet(f"{tmp_path}/{name}")
    t = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("batch", "emails", "history", "junk")}
    owners = emails.email_owners(t["batch"], t["emails"], t["history"], "2001-07-31", -15, "month")
    text = plan(emails.email_candidates(owners, t["junk"]))
    assert text.count("FileScan parquet") == 4
    assert "other" not in text and "domainpart" not in text
    assert "GreaterThanOrEqual(updated_date" in text


@pytest.fixture
def no_broadcast(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


HOT = "case when id % 3 = 0 then 7 else id end"


def hot_rows(spark, n=300_000):
    """A third of the rows share one key."""
    return spark.range(0, n, 1, 16).select(F.expr(HOT).alias("k"), F.col("id").alias("v"))


def split(df):
    rows = df.collect()
    return "skew=true" in plan(df), len(rows)


def test_a_hot_key_is_split_in_semi_and_anti_joins(spark, no_broadcast):
    left = hot_rows(spark)
    others = spark.range(0, 200_000, 1, 16).select(F.when(F.col("id") % 3 == 0, F.lit(9)).otherwise(F.col("id") * 3 + 7).alias("k"))
    was_split, kept = split(sets.not_in(left, "k", others))
    assert was_split
    was_split, dropped = split(sets.only_in(left, "k", others))
    assert was_split and kept + dropped == 300_000


def test_keys_are_combined_before_the_shuffle(spark, no_broadcast):
    copies = spark.range(0, 100_000, 1, 8).select(F.lit(1).alias("k"))
    df = sets.unique_keys(copies, "k")
    assert len(df.collect()) == 1
    text = plan(df)
    before = text[text.index("Exchange hashpartitioning"):]
    assert "HashAggregate(keys=[" in before


def test_master_rows_shuffle_once_for_batch_and_cool_down(spark, no_broadcast):
    master = hot_rows(spark).select(F.col("k").alias("person_email_key"), F.col("v").alias("person_key")).withColumns(
        {"email_address": F.lit("a@b.co"), "updated_date": F.lit("2001-07-05").cast("timestamp_ntz")}
    )
    batch = spark.range(0, 90_000, 1, 8).select(F.expr(HOT).alias("person_email_key"))
    history = batch.where("person_email_key % 5 = 0").withColumn("updated_date", F.lit("2001-07-20").cast("timestamp_ntz"))
    owners = emails.email_owners(batch, master, history, "2001-07-31", -15, "month")
    assert plan(owners).count("Exchange") == 4
    assert split(owners)[0]


def test_a_hot_company_is_split_in_the_residual_join(spark, no_broadcast):
    ref = hot_rows(spark, 90_000)
    was_split, rows = split(joins.left_residual(hot_rows(spark), ref, ["k"], "v", "flag"))
    assert was_split and rows == 300_000


def test_a_hot_country_and_address_are_split_in_the_chain(spark, no_broadcast):
    phones = spark.range(0, 200_000, 1, 16).select(F.col("id").alias("person_key"), F.lit("1").alias("telephone_number"))
    bridge = spark.range(0, 200_000, 1, 16).select(F.col("id").alias("person_key"), F.expr(HOT).alias("address_key"))
    address = spark.range(0, 200_000, 1, 16).select(F.col("id").alias("address_key"), F.lit("usa").alias("country"))
    synonyms = spark.createDataFrame([("usa", "US")], "country_synonym string, country_code string")
    was_split, rows = split(joins.resolve_country(phones, bridge, address, synonyms))
    assert was_split and rows == 200_000


def test_a_shared_mailbox_is_split_on_landing(spark, no_broadcast):
    owners = spark.range(0, 300_000, 1, 16).select(
        F.concat(F.lit("m"), F.expr(HOT)).alias("email_address"), F.col("id").alias("person_email_key")
    )
    verdicts = owners.select("email_address").distinct().withColumn("Code", F.lit("222"))
    was_split, rows = split(land(verdicts, owners, ["email_address"], ["person_email_key"]))
    assert was_split and rows == 300_000


def test_a_body_is_parsed_once_and_only_after_the_join_that_wants_it(spark, table):
    keys = table([("a",)], "request_key string")
    landed = table([("p", "a", 200, "{}", "2024")], "provider string, request_key string, status int, body string, fetched_at string")
    text = plan(flatten_phone_verdict(answers(keys, landed, "p"), "request_key"))
    assert text.count("from_json") == 1
    assert text.index("from_json") < text.index("Join")
    # Read downwards: the newest is taken of what the run's keys have left, below it.
    assert text.index("max(struct(fetched_at") < text.rindex("LeftSemi")


def test_the_library_never_collects_or_forces_a_broadcast():
    for path in (ROOT / "cleanroll").rglob("*.py"):
        source = path.read_text()
        for word in ("toPandas", "crossJoin", "localCheckpoint"):
            assert word not in source, (path.name, word)
        # The training-data operators may use Python and small tables of a proven size; the dataflows may not.
        for word in (".collect()", "broadcast(", "udf") if path.parent.name != "llm" else ():
            assert word not in source, (path.name, word)
