import re

import pytest
from rows import values

from cleanroll.sources.answers import answers
from cleanroll.sources.current import CurrentAnswers

LANDED = "provider string, request_key string, status int, body string, fetched_at timestamp_ntz"


def landed(spark, *rows):
    df = spark.createDataFrame([(*r[:4], str(r[4])) for r in rows], "provider string, request_key string, status int, body string, t string")
    return df.selectExpr("provider", "request_key", "status", "body", "cast(t as timestamp_ntz) as fetched_at")


@pytest.fixture
def current(spark, tmp_path):
    made = CurrentAnswers(spark, "answers_of_" + re.sub(r"\W", "_", tmp_path.name).lower(), str(tmp_path), 3)
    made.fold(landed(
        spark, ("email", "a", 200, "old a", "2024-01-01"), ("email", "a", 200, "newer a", "2024-01-02"), ("email", "b", 200, "b", "2024-01-01"),
        ("email", "c", 500, "failed", "2024-01-03"), ("email", "d", 200, None, "2024-01-03"), ("phone", "a", 200, "phone a", "2024-01-09"),
        ("email", None, 200, "no key", "2024-01-01"),
    ), "email")
    return made


def held(current):
    return values(current.table("email"), "request_key", "body")


def test_folds_keep_the_newest(spark, current):
    assert held(current) == [("a", "newer a"), ("b", "b")]
    again = landed(spark, ("email", "a", 200, "older", "2023-12-31"), ("email", "b", 200, "c wins a tie", "2024-01-01"), ("email", "e", 200, "e", "2024-02-01"))
    for _ in range(3):
        current.fold(again, "email")
        assert held(current) == [("a", "newer a"), ("b", "c wins a tie"), ("e", "e")]
    current.fold(landed(spark, ("email", "a", 200, "late", "2024-03-01"), ("email", "e", 200, "not since", "2024-02-15")), "email", "2024-03-01")
    assert held(current) == [("a", "late"), ("b", "c wins a tie"), ("e", "e")]
    assert len(current._generations("email")) == 2


def test_lookups(spark, current):
    keys = spark.createDataFrame([("a", "x", "2024-01-01 00:00:00"), ("b", "y", "2024-01-01 00:00:00"), ("z", "z", None)], "request_key string, mail string, seen string")
    keys = keys.selectExpr("request_key", "mail", "cast(seen as timestamp_ntz) as seen")
    assert values(answers(keys, current, "email"), "mail", "body") == [("x", "newer a"), ("y", "b")]
    assert values(answers(keys, current, "email", fetched_since="2024-01-02"), "mail", "body") == [("x", "newer a")]
    assert values(answers(keys, current, "email", after="seen"), "mail", "body") == [("x", "newer a")]
    with pytest.raises(ValueError, match="no answers of phone"):
        current.table("phone")


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_bodies_are_neither_shuffled_nor_sorted(spark, current, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = answers(spark.range(50).selectExpr("chr(97 + id) as request_key", "id"), current, "email")
        assert values(found, "id", "body") == [(0, "newer a"), (1, "b")]
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "Sort" not in plan.replace("SortBy", "")
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1
    assert re.search(r"Exchange hashpartitioning\(request_key#\d+, 3\).*\n.*Project \[chr", plan)  # the keys' own


def test_a_fold_leaves_the_table_in_its_buckets(spark, current):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")  # more than the table has buckets
    try:
        again = landed(spark, ("email", "a", 200, "late", "2024-03-01"), ("email", "e", 200, "e", "2024-02-01"))
        merged = current.merged(again, "email")
        assert values(merged, "request_key", "body") == [("a", "late"), ("b", "b"), ("e", "e")]
        plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    above = plan[: next(k for k, line in enumerate(plan) if "Bucketed: true" in line)]
    assert not any("Exchange" in line for line in above)
    assert sum("Exchange" in line for line in plan) == 2  # of the new answers: to be made one a key, and to the buckets


def test_stored_rows_are_dealt_before_their_texts_are_made(spark, tmp_path):
    from standins.tables import _spark_sql

    spark.range(9).selectExpr("id as o_orderkey", "id as o_custkey", "date'2001-07-01' as o_orderdate", "'x' as other").write.parquet(f"{tmp_path}/orders.parquet")
    plan = spark.sql(_spark_sql(str(tmp_path), "person_email", 3))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("case when" if "case when" in plan else "CASE WHEN") < plan.index("Repartition") and "other" not in plan.split("Relation")[0]
