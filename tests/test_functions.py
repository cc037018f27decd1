import datetime as dt

import pytest
from rows import values
from pyspark.sql import functions as F

from cleanroll.functions import addresses, periods, text
from cleanroll.functions.emails import valid_email
from cleanroll.functions.phones import Region, e164, standardise


def test_bounds():
    assert periods.bounds("2024-02-10", "day") == (dt.date(2024, 2, 10), dt.date(2024, 2, 11))
    assert periods.bounds("2024-12-31", "month") == (dt.date(2024, 12, 1), dt.date(2025, 1, 1))
    with pytest.raises(ValueError):
        periods.bounds("2024-01-01", "week")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string"])
def test_changed_in_takes_the_first_instant_and_leaves_the_next_period(spark, kind):
    stamps = ["2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-02-29 23:59:59.999999", "2024-03-01 00:00:00", None]
    df = spark.createDataFrame([(s,) for s in stamps], "t string").select("t", F.col("t").cast(kind).alias("ts"))
    assert values(periods.changed_in(df, "ts", "2024-02-15", "month"), "t") == [(stamps[1],), (stamps[2],)]
    assert values(periods.changed_in(df, "ts", "2024-02-01"), "t") == [(stamps[1],)]


def test_daily_deltas_add_up_to_the_monthly_one(spark):
    df = spark.range(0, 2000).select(F.expr("timestamp'2024-01-20' + make_interval(0,0,0,0,id,0,0)").alias("ts"))
    days = sum(periods.changed_in(df, "ts", f"2024-02-{d:02}").count() for d in range(1, 30))
    assert days == periods.changed_in(df, "ts", "2024-02-05", "month").count() == 29 * 24


def test_since_includes_the_back_date(table):
    df = table([("2024-01-15 00:00:00",), ("2024-01-14 23:59:59",)], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    assert periods.since(df, "ts", "2024-01-30", -15).count() == 1
    assert periods.since(df, "ts", "2024-01-01", 15).count() == 0


def test_shifted_date(table):
    df = table([(dt.date(2024, 3, 1),)], "d date")
    assert values(df.select(periods.shifted_date(F.col("d"), -1))) == [("2024-02-29",)]


GOOD = [
    "a@b.co", "x.y.z@mail.example.com", "a+b_c@d-e.org", "o'neil@x.ie", "a@b.c'o", "{}|~@q9.net", "a" * 64 + "@b.co",
    "a@" + "b" * 63 + ".co", "a@b." + "c" * 63, "a@" + ".".join(["d" * 60] * 4) + ".coms",
]
BAD = [
    None, "", "a@b.c", "A@b.co", "a..b@c.co", ".a@b.co", "a.@b.co", "a@b", "a@-b.co", "a@b-.co", "a@b..co", "a b@c.co",
    " a@b.co", "a@b.co ", "a@b.co\n", "a@b@c.co", "é@b.co", "a@b'c.co", "a" * 65 + "@b.co", "a@" + "b" * 64 + ".co",
    "a@" + ".".join(["d" * 61] * 4) + ".comsx", "@b.com",
]


def test_valid_email(table):
    df = table([(e,) for e in GOOD + BAD], "email string")
    assert values(df.where(valid_email(F.col("email")))) == sorted([(e,) for e in GOOD], key=repr)


PHONES = [
    # number, country, national digits, valid
    ("+1 (212) 555-0100", None, "2125550100", "true"),
    ("1-212-555-0100", "US", "2125550100", "true"),
    ("212.555.0100", None, "2125550100", "true"),
    ("555-0100", "US", "5550100", "false"),
    ("017-555-7713", "US", "175557713", "false"),
    ("+44 20 7946 0001", "US", "2079460001", "true"),
    ("+44 (0)20 7946 0001", None, "2079460001", "true"),
    ("020 7946 0001", "GB", "2079460001", "true"),
    ("442079460001", "GB", "2079460001", "true"),
    ("2079460001", "US", "2079460001", "true"),
    ("+33 1 7018 0001", "GB", "170180001", "true"),
    ("01 70 18 00 01", "FR", "170180001", "true"),
    ("+999 1234567", None, "9991234567", "false"),
    ("0123456", "ZZ", "123456", "false"),
    ("000", "US", "0", "false"),
    ("34 600 000 000", "ES", "600000000", "true"),
    ("+1 212 555 0100 x12", None, "2125550100", "true"),
    ("212-555-0100 ext. 7", "US", "2125550100", "true"),
    ("(0)20 7946 0001;ext=9", "GB", "2079460001", "true"),
    ("tel: 1-800-FLOWERS", None, "8003569377", "true"),
    ("011 44 20 7946 0001", "US", "2079460001", "true"),
    ("00 44 20 7946 0001", "GB", "2079460001", "true"),
    ("0011 1 212 555 0100", "AU", "2125550100", "true"),
    ("+44 12345678901234567", None, "12345678901234567", "false"),
    ("1" * 18, "US", "1" * 18, "false"),
]


def test_standardise(table):
    rows = [(i, n, c) for i, (n, c, _, _) in enumerate(PHONES)]
    rows += [(90, None, "US"), (91, "call me", None), (92, "7", "US"), (93, "", "US"), (95, "+", None)]
    out = standardise(table(rows, "k int, n string, c string"), "n", "c")
    got = {r["k"]: (r["standardised_phone_number"], r["is_valid_flag"]) for r in out.collect()}
    assert got == {i: (d, v) for i, (_, _, d, v) in enumerate(PHONES)}
    assert values(out.where("k = 15"), "c", "calling_code") == [("ES", "34")]


def test_standardise_keeps_the_country_as_given_and_takes_any_plan(table):
    plan = (Region("QQ", "7", "8", 3, 4, "[1-9][0-9]{2,3}"),)
    out = standardise(table([("8123", None), ("+7 8123", None), ("+78", None)], "n string, c string"), "n", "c", plan, default="QQ")
    assert values(out, "n", "c", "standardised_phone_number", "is_valid_flag") == [
        ("+7 8123", None, "123", "true"), ("+78", None, "8", "false"), ("8123", None, "123", "true"),
    ]
    with pytest.raises(ValueError):
        standardise(out, "n", None, (Region("Q:", "7", "", 1, 2, "1"),))


def test_e164(table):
    df = standardise(table([("020 7946 0001", "GB"), ("12", "XX")], "n string, c string"), "n", "c")
    assert values(df.select(e164(F.col("calling_code"), F.col("standardised_phone_number")))) == [("+442079460001",), (None,)]


def test_null_text(table):
    df = table([("x",), ("NuLL",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(text.null_text(F.col("t"))).collect()] == ["x", None, "", None]
    assert [r[0] for r in df.select(text.null_or_empty(F.col("t"))).collect()] == ["x", None, None, None]


def test_truncate_description(table):
    df = table([("a" * n,) for n in (498, 499, 500, 700)], "t string")
    assert [len(r[0]) for r in df.select(text.truncate_description(F.col("t"))).collect()] == [498, 499, 498, 498]


def test_request_strings(table):
    df = table([("a b", "c~*'", "x+y@z.co", None)], "f string, l string, e string, c string")
    row = df.select(
        text.match_request(F.col("f"), F.col("l"), F.col("e")), text.email_request(F.col("e"), 5),
        text.phone_request(F.lit("1"), F.col("c")), text.phone_request(F.lit("1"), F.lit("GB")), text.base64_text(F.lit("aMOp")),
    ).first()
    assert row[0] == "emailAddress=x%2By%40z.co&firstname=a%20b&lastName=c~%2A%27&outputFormat=json"
    assert row[1] == "Timeout=5&emailAddress=x%2By%40z.co&outputFormat=json"
    assert row[2] == "PhoneNumber=1&outputFormat=json"
    assert row[3] == "Country=GB&PhoneNumber=1&outputFormat=json"
    assert row[4] == "hé"


@pytest.mark.parametrize("length", [0, 1, 99, 100, 101, 250, 499, 500, 520])
def test_street_parts_are_the_first_500_characters(table, length):
    street = "".join(chr(97 + i % 26) for i in range(length))
    df = table([(street,)], "s string")
    parts = df.select(*addresses.street_parts(F.col("s")).values()).first()
    assert len(parts) == 5 and "".join(parts) == street[:500]
    assert [len(p) for p in parts] == [max(0, min(100, length - 100 * i)) for i in range(5)]


def test_address_key_tells_null_places_and_separators_apart(table):
    ddl = "a string, b string, c string"
    df = table([("x", None, "y"), ("x", "y", None), (None, "x", "y"), ("x", "", "y"), ("x|1:y", None, None), ("x", "y", "-")], ddl)
    assert df.select(addresses.address_key(["a", "b", "c"]).alias("k")).distinct().count() == 6
    assert df.limit(2).select(addresses.hash_key_val(["a", "b", "c"]).alias("k")).distinct().count() == 1
