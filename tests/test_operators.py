import pytest
from rows import values
from pyspark.sql import functions as F

from cleanroll.operators import joins, sets
from cleanroll.operators.landing import land, standardisation_log
from cleanroll.plans import audit
from cleanroll.sinks import JdbcSink, ParquetSink, by_name
from cleanroll.sources.answers import answers
from cleanroll.sources.settings import read_settings
from cleanroll.sources.tables import EvenSplit, JdbcTables, Split, even_split

HISTORY = "k int, updated_date timestamp_ntz"


def history(spark, rows):
    return spark.createDataFrame(rows, "k int, t string").select("k", F.col("t").cast("timestamp_ntz").alias("updated_date"))


def test_not_recent_keeps_multiplicity_and_drops_null_keys(spark, table):
    df = table([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (4, "d"), (None, "n")], "k int, v string")
    old = history(spark, [(1, "2024-01-14 23:59:59"), (2, "2024-01-15 00:00:00"), (2, "2024-01-20 00:00:00"), (None, "2024-01-20 00:00:00")])
    other = history(spark, [(3, "2024-01-30 10:00:00")])
    left = sets.not_recent(df, "k", old, other, run_date="2024-01-30", days=-15)
    assert values(left) == [(1, "a"), (1, "a"), (4, "d")]


def test_due_keys_are_the_distinct_keys_outside_the_cool_down(spark, table):
    batch = table([(1,), (1,), (2,), (3,), (None,)], "k int")
    old = history(spark, [(2, "2024-01-15 00:00:00"), (3, "2024-01-14 00:00:00"), (None, "2024-01-20 00:00:00")])
    assert values(sets.due_keys(batch, "k", old, run_date="2024-01-30", days=-15)) == [(1,), (3,)]


def test_kept_and_dropped_rows_make_up_the_input(spark):
    df = spark.range(0, 500).select((F.col("id") % 90).cast("int").alias("k"), "id")
    others = spark.range(0, 300, 7).select(F.col("id").cast("int").alias("k"))
    kept, dropped = sets.not_in(df, "k", others), sets.only_in(df, "k", others)
    assert values(kept.unionByName(dropped)) == values(df)
    assert kept.count() and dropped.count()


def test_minus_distinct_is_except(table):
    a = table([(1, None), (1, None), (2, "x"), (None, None), (3, "y")], "k int, v string")
    b = table([(1, None), (3, "z"), (None, None)], "p int, q string")
    assert values(sets.minus_distinct(a, b)) == values(a.subtract(b)) == [(2, "x"), (3, "y")]


def test_union_by_position_takes_the_first_names(table):
    out = sets.union_by_position(table([("a",)], "website string"), table([("b",), ("a",)], "domainpart string"))
    assert out.columns == ["website"] and values(out) == [("a",), ("a",), ("b",)]


def test_cap_is_repeatable_and_off_by_default(spark):
    df = spark.range(100).repartition(7)
    assert values(sets.cap(df, "id", n=3)) == [(0,), (1,), (2,)]


def test_funnel(spark):
    assert values(sets.candidate_funnel({"all": spark.range(5), "none": spark.range(0)})) == [("all", 5), ("none", 0)]


def test_resolve_country_gives_a_row_per_address(table):
    phones = table([(1, "p1"), (2, "p2"), (3, "p3"), (4, "p4")], "person_key int, telephone_number string")
    bridge = table([(1, 10), (2, 10), (2, 11), (4, 12)], "person_key int, address_key int")
    address = table([(10, "usa"), (11, "uk"), (12, None)], "address_key int, country string")
    synonyms = table([("usa", "US"), ("uk", "GB"), ("uk", "UK")], "country_synonym string, country_code string")
    out = joins.resolve_country(phones, bridge, address, synonyms)
    assert values(out, "telephone_number", "country_code") == [("p1", "US"), ("p2", "GB"), ("p2", "UK"), ("p2", "US")]


def test_left_normalised_keeps_unmatched_and_does_not_repeat(table):
    df = table([(1, " usa", "ca "), (2, "usa", None), (3, "fr", "x")], "id int, country string, state string")
    ref = table([("USA", "CA", 5), ("usa ", "ca", 5), ("USA", None, 6)], "cs string, sn string, key int")
    out = joins.left_normalised(df, ref, {"country": "cs", "state": "sn"})
    assert out.columns == ["id", "country", "state", "key"]
    assert values(out, "id", "key") == [(1, 5), (2, None), (3, None)]


def test_left_residual_agrees_with_the_outer_join(spark):
    df = spark.range(0, 60).select((F.col("id") % 7).alias("c"), F.when(F.col("id") % 11 > 0, F.col("id") % 5).alias("a"))
    ref = spark.range(0, 12).select((F.col("id") % 4).alias("c"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("a"))
    got = joins.left_residual(df, ref, ["c"], "a", "flag")
    df.createOrReplaceTempView("l_res")
    ref.createOrReplaceTempView("r_res")
    want = spark.sql(
        "select distinct l.c, l.a, if(r.c is null, 0, 1) flag from l_res l left join r_res r on l.c = r.c and l.a <> r.a"
    )
    assert values(got.distinct()) == values(want)
    assert got.count() == df.count()


def test_land_joins_every_owner_and_invents_no_key(table):
    verdicts = table([("n1", "US", "v1"), ("n1", None, "v2"), ("n9", "US", "v9")], "n string, c string, v string")
    owners = table([(1, "n1", "US"), (1, "n1", "US"), (2, "n1", None), (3, "n1", "GB"), (4, None, "US")], "k int, n string, c string")
    out = land(verdicts, owners, ["n", "c"], ["k"], "at", "2024-01-01 00:00:00", null_safe=["c"])
    assert out.columns == ["v", "k", "at"]
    assert values(out, "v", "k") == [("v1", 1), ("v2", 2)]


def test_land_never_matches_null_names(table):
    rows = table([(1, None, "l"), (2, "f", "l")], "k int, f string, l string")
    assert values(land(rows.select("f", "l").distinct(), rows, ["f", "l"], ["k"], drop=[]), "k") == [(2,)]


def test_standardisation_log(table):
    df = table([(7, "1", "true", "+1")], "person_phone_key int, standardised_phone_number string, is_valid_flag string, telephone_number string")
    row = standardisation_log(df, "me", "2024-01-01 00:00:00").first()
    assert (row["person_phone_key"], row["verification_reason_key"], row["created_user_id"]) == ("7", "50000001", "me")


LANDED = "provider string, request_key string, status int, body string, fetched_at timestamp_ntz"


def test_answers_take_the_newest_good_body(spark, table):
    rows = [
        ("p", "a", 200, "old", "2024-01-01"), ("p", "a", 200, "new", "2024-01-02"), ("p", "a", 500, "bad", "2024-01-03"),
        ("p", "b", 404, "x", "2024-01-01"), ("p", "c", 200, None, "2024-01-01"), ("q", "d", 200, "other", "2024-01-01"),
    ]
    landed = spark.createDataFrame(rows, "provider string, request_key string, status int, body string, t string")
    landed = landed.select("*", F.col("t").cast("timestamp_ntz").alias("fetched_at"))
    keys = table([(k,) for k in "abcd"], "request_key string")
    assert values(answers(keys, landed, "p"), "request_key", "body") == [("a", "new")]
    assert answers(keys, landed, "p", fetched_since="2024-01-03").count() == 0


def test_audit_rows(table):
    master = table([(3,), (9,), (None,)], "batch_id int")
    entities = table([(5, "x"), (4, "x"), (1, "y")], "entity_detail_key int, entity_name string")
    row = audit.audit_rows(master, entities, "x", "i", audit.STARTED, "me", "2024-01-01 00:00:00").first()
    assert (row["batch_id"], row["entity_detail_key"], row["status"], row["file_key"]) == (9, "4", "started", "1")
    assert audit.audit_rows(master.where("batch_id > 99"), entities, "x", "i", "ended", "me").count() == 0


def test_settings_last_line_wins_and_missing_ones_fail(spark, tmp_path):
    path = tmp_path / "settings.csv"
    path.write_text("key,value\nuserName,first\ndays,-15\nuserName,last\nempty,\n")
    assert read_settings(spark, str(path), ["userName", "days"]) == {"userName": "last", "days": "-15", "empty": None}
    with pytest.raises(KeyError, match="nothere"):
        read_settings(spark, str(path), ["nothere"])


def test_append_goes_by_name_and_an_empty_one_adds_nothing(spark, table, tmp_path):
    sink = ParquetSink(spark, str(tmp_path))
    rows = table([(1, "a")], "k int, v string")
    sink.append(rows, "t")
    sink.append(by_name(rows.select("v", "k"), ["k", "v"]), "t")
    sink.append(rows.limit(0), "t")
    assert values(spark.read.parquet(sink.path("t"))) == [(1, "a"), (1, "a")]
    with pytest.raises(ValueError):
        by_name(rows, ["k"])


def test_a_rerun_replaces_its_own_rows_only(spark, table, tmp_path):
    for run, value in (("r1", "a"), ("r2", "b"), ("r2", "c")):
        ParquetSink(spark, str(tmp_path), run=run).append(table([(value,)], "v string"), "t")
    assert values(spark.read.parquet(f"{tmp_path}/t"), "run_id", "v") == [("r1", "a"), ("r2", "c")]


def test_jdbc_options():
    source = JdbcTables(None, "jdbc:x", "mdm", splits={"person": Split("person_key", "0", "1000", 8)}, names={"person": "PERSON_V"})
    assert source.options("person") == {
        "url": "jdbc:x", "dbtable": "mdm.PERSON_V", "fetchsize": "10000", "partitionColumn": "person_key",
        "lowerBound": "0", "upperBound": "1000", "numPartitions": "8",
    }
    with pytest.raises(ValueError):
        source.options("other")
    assert "partitionColumn" not in JdbcTables(None, "jdbc:x", "mdm", small=frozenset({"other"})).options("other")
    assert JdbcSink("jdbc:x", "mdm", properties={"user": "u"}).options("t")["user"] == "u"


def test_the_last_setting_wins_by_path_not_by_size(spark, tmp_path):
    (tmp_path / "a.csv").write_text("key,value\nk,first\n")
    (tmp_path / "b.csv").write_text("key,value\n" + "other,x\n" * 500 + "k,last\n")
    assert read_settings(spark, str(tmp_path))["k"] == "last"
    (tmp_path / "a.csv").write_text("key,value\n" + "other,x\n" * 500 + "k,first\n" + "other,x\n" * 5000)
    assert read_settings(spark, str(tmp_path))["k"] == "last"


def read_sizes(df, split):
    """Rows of each read; every row must be in exactly one."""
    sizes = [df.where(p).count() for p in split.predicates]
    once = sum((F.when(F.expr(p), 1).otherwise(0) for p in split.predicates), F.lit(0))
    assert df.where(once != 1).isEmpty()
    return sizes


def test_even_split_of_skewed_keys(spark):
    """A third of the rows have one key, a fifth have none, and the rest lie unevenly."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(-7)).when(n % 5 == 1, F.lit(None)).otherwise(F.pow(n / 100, F.lit(3)).cast("int")).cast("bigint")
    df = spark.range(30_000).select(key.alias("k"), F.when(n % 1000 != 0, n - 15_000).alias("row_no")).cache()
    sizes = read_sizes(df, even_split(df, "k", 30, within="row_no"))
    assert sum(sizes) == 30_000 and max(sizes) <= 2 * 1000 and len(sizes) <= 35
    whole = read_sizes(df, even_split(df, "k", 30))  # the hot key and the rows without one stay one read each
    assert sorted(whole)[-2:] == [df.where("k is null").count(), 10_000] and sorted(whole)[-3] <= 2 * 1000
    later = spark.createDataFrame([(-(10**12), 1), (10**12, -1), (None, None), (-7, None), (-7, -3)], "k bigint, row_no bigint")
    assert sum(read_sizes(later, even_split(df, "k", 30, within="row_no"))) == 5  # rows that came later are read too


def test_even_split_of_times_and_small_tables(spark, table):
    days = spark.range(1000).select(F.expr("date_add(date'2024-01-01', cast(sqrt(id) as int))").alias("d"))
    for kind in ("date", "timestamp", "timestamp_ntz"):
        sizes = read_sizes(days.select(F.col("d").cast(kind)), even_split(days.select(F.col("d").cast(kind)), "d", 8))
        assert sum(sizes) == 1000 and len(sizes) >= 8
    prices = table([(i,) for i in range(40)], "i int").select((F.col("i") / 7).cast("decimal(20,6)").alias("p"))
    assert sum(read_sizes(prices, even_split(prices, "p", 4))) == 40
    none = table([], "k int")
    assert even_split(none, "k", 8).predicates == ("k IS NULL", "k IS NOT NULL")
    assert sum(read_sizes(table([(None,), (None,)], "k int"), even_split(table([(None,)], "k int"), "k", 8))) == 2
    assert sum(read_sizes(table([(1,), (1,), (2,)], "k int"), even_split(table([(1,)], "k int"), "k", 8))) == 3
    with pytest.raises(ValueError, match="whole or decimal"):
        even_split(table([("a",)], "k string"), "k", 8)


def test_even_split_takes_the_place_of_ranges():
    source = JdbcTables(None, "jdbc:x", "mdm", splits={"person": EvenSplit(("person_key < 5", "person_key >= 5"))})
    assert "partitionColumn" not in source.options("person")
