"""Histories partitioned by day or month: the bounds of a period leave the other folders unread."""

import datetime as dt

import pytest
from rows import values
from pyspark.sql import functions as F

from cleanroll.functions.periods import DAY, MONTH, changed_in, period_column, since, with_period, with_time
from cleanroll.operators.sets import not_recent, recent_keys
from cleanroll.plans.emails import email_owners, enriched_email_owners
from cleanroll.sinks import ParquetSink
from cleanroll.sources.tables import CommittedTables, ParquetTables

DAYS = 90
FIRST = dt.date(2024, 1, 1)


@pytest.fixture
def history(spark):
    """Four rows a day over DAYS days from FIRST, of a key each, and two rows without a time."""
    rows = spark.range(4 * DAYS).select(F.col("id").alias("k"), F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 6 * cast(id as int))").alias("updated_date"))
    return rows.unionByName(spark.range(2).select((-F.col("id") - 1).alias("k"), F.lit(None).cast("timestamp_ntz").alias("updated_date")))


def read(df):
    """The rows of a plain scan, and how many files it read."""
    n = len(df.collect())
    return n, df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numFiles").value()


def partition_filters(df):
    return df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def stored(spark, folder, rows, grain):
    ParquetSink(spark, str(folder), periods={"h": ("updated_date", grain)}).append(rows, "h")
    return ParquetTables(spark, str(folder), suffix="").table("h")


@pytest.mark.parametrize(("grain", "folders"), [(DAY, DAYS + 1), (MONTH, 4)])
def test_only_the_folders_of_the_period_are_read(spark, history, tmp_path, grain, folders):
    table = stored(spark, tmp_path, history, grain)
    column = period_column("updated_date", grain)
    assert table.select(column).distinct().count() == folders and values(table.drop(column)) == values(history)
    assert read(table)[1] == folders, "a file a period"
    recent = since(table, "updated_date", "2024-03-20", -5)
    assert column in partition_filters(recent) and recent.columns == ["k", "updated_date"]
    assert read(recent) == (16 * 4, 16 if grain == DAY else 1)
    one = changed_in(table, "updated_date", "2024-02-10", grain)
    assert read(one) == ((4, 1) if grain == DAY else (29 * 4, 1)), "a period of the table's own grain is one folder"
    assert values(recent) == values(since(history, "updated_date", "2024-03-20", -5))
    assert values(one) == values(changed_in(history, "updated_date", "2024-02-10", grain))


def test_a_month_of_a_history_by_day_and_a_day_of_one_by_month(spark, history, tmp_path):
    by_day, by_month = stored(spark, tmp_path / "d", history, DAY), stored(spark, tmp_path / "m", history, MONTH)
    assert read(changed_in(by_day, "updated_date", "2024-02-10", MONTH)) == (29 * 4, 29)
    assert read(changed_in(by_month, "updated_date", "2024-02-10", DAY)) == (4, 1)


@pytest.mark.parametrize("zone", ["UTC", "Pacific/Kiritimati", "Etc/GMT+12", "America/New_York"])
@pytest.mark.parametrize("grain", [DAY, MONTH])
def test_instants_are_found_in_every_zone(spark, tmp_path, zone, grain):
    hours = spark.range(24 * 70).select(F.col("id").alias("k"), F.timestamp_seconds(F.lit(1_704_067_200 + 1_800) + F.col("id") * 3600).alias("updated_date"))
    table = stored(spark, tmp_path, hours, grain)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for run_date in ("2024-02-01", "2024-01-31", "2024-02-29"):
            for narrowed in (lambda df: since(df, "updated_date", run_date, -3), lambda df: changed_in(df, "updated_date", run_date, DAY),
                             lambda df: changed_in(df, "updated_date", run_date, MONTH)):
                assert values(narrowed(table), "k") == values(narrowed(hours), "k")
        assert read(changed_in(table, "updated_date", "2024-02-10", DAY))[1] <= (3 if grain == DAY else 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dates_and_what_cannot_be_a_period(table):
    dates = table([(1, dt.date(2024, 2, 29)), (2, None)], "k int, d date")
    assert values(with_period(dates, "d", MONTH)) == [(1, dt.date(2024, 2, 29), dt.date(2024, 2, 1)), (2, None, None)]
    assert values(changed_in(with_period(dates, "d"), "d", "2024-02-29")) == [(1, dt.date(2024, 2, 29))]
    assert with_time(with_period(dates, "d"), "d", "k").columns == ["k", "d", "d_day"] and with_time(dates, "d").columns == ["d"]
    with pytest.raises(ValueError, match="grain"):
        with_period(dates, "d", "week")
    with pytest.raises(ValueError, match="dates or times"):
        with_period(dates, "k")


def test_cool_downs_read_the_folders_they_need(spark, history, tmp_path):
    stored_ = stored(spark, tmp_path, history, DAY)
    window = dict(run_date="2024-03-30", days=-2)
    keys = recent_keys("k", stored_, **window)
    assert read(keys) == (3 * 4, 3) and "updated_date_day" in partition_filters(keys)
    asked = spark.range(4 * DAYS).withColumnRenamed("id", "k")
    assert values(not_recent(asked, "k", stored_, **window)) == values(not_recent(asked, "k", history, **window))


def test_jobs_hand_the_bounds_to_all_their_tables(spark, history, tmp_path):
    kept = stored(spark, tmp_path, history, DAY)
    emails = kept.withColumnRenamed("k", "person_email_key").withColumn("person_key", F.lit(1)).withColumn("email_address", F.lit("a@b.co"))
    known = kept.withColumnRenamed("k", "person_email_key")
    enriched = kept.withColumnRenamed("k", "enrichment_api_person_email_key")
    batch = spark.range(4 * DAYS)
    plans = [
        email_owners(batch.withColumnRenamed("id", "person_email_key"), emails, known, "2024-03-10", -5),
        enriched_email_owners(
            batch.withColumnRenamed("id", "enrichment_api_person_email_key"),
            emails.withColumnsRenamed({"person_email_key": "enrichment_api_person_email_key", "person_key": "enrichment_api_person_key", "email_address": "email"}),
            known, enriched, "2024-03-10", -5,
        ),
    ]
    for df, scans in zip(plans, (2, 3), strict=True):
        filters = [part.split("]")[0] for part in df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1:]]
        assert sum("updated_date_day" in f for f in filters) == scans and "updated_date_day" not in df.columns


def test_runs_and_periods_together(spark, history, tmp_path):
    def run(name, rows):
        sink = ParquetSink(spark, str(tmp_path), run=name, periods={"h": ("updated_date", DAY)})
        sink.begin()
        sink.append(rows, "h")
        sink.commit()

    days = lambda low, high: history.where(f"k >= {4 * low} and k < {4 * high}")
    run("r1", days(0, 10))
    run("r2", days(10, 20))
    tables = CommittedTables(spark, str(tmp_path), suffix="")
    late = since(tables.table("h"), "updated_date", "2024-01-10", -1)
    assert read(late) == (12 * 4, 12)
    assert read(since(tables.table("h", run="r1"), "updated_date", "2024-01-10", -1)) == (2 * 4, 2)
    run("r2", days(15, 17))
    assert values(tables.table("h"), "k") == values(days(0, 10).unionByName(days(15, 17)), "k"), "folders of the first attempt go"


def test_a_rerun_without_rows_leaves_none_of_the_first_attempt(spark, table, tmp_path):
    for run, rows in (("r1", [("a",)]), ("r2", [("b",)]), ("r2", [])):
        sink = ParquetSink(spark, str(tmp_path), run=run)
        sink.begin()
        sink.append(table(rows, "v string"), "t")
        sink.commit()
    assert values(CommittedTables(spark, str(tmp_path), suffix="").table("t")) == [("a",)]
