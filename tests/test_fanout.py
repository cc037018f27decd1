import json

from rows import values

from cleanroll.operators import providers as p
from cleanroll.operators.fanout import cell_rows, staged_fan_out, tables_of
from cleanroll.plans import domains, persons


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bodies(spark, *bodies):
    return spark.createDataFrame([(json.dumps(b),) for b in bodies], "body string")


def people(spark):
    full = {"PersonDetailRequest": {
        "PersonID": "P1", "FirstName": "Ann", "Industry": ["a", None], "TopLevelIndustry": "alone",
        "CurrentEmployment": [{"JobTitle": "one"}, {"JobTitle": "two"}], "Education": {"School": "s"}, "Certifications": [7, {"YearReceived": "1999"}],
        "WebReference": {"Description": "x" * 600}}}
    bare = {"PersonDetailRequest": {"PersonID": "P2"}}
    return p.parse_person_detail(bodies(spark, full, bare, {"PersonDetailRequest": {"FirstName": "no id"}}))


def test_all_tables_come_from_one_pass(spark):
    fanned = p.person_detail_fan_out(people(spark))
    assert plan(fanned).count("from_json") > 1 and plan(fanned).count("Scan ExistingRDD") == 1
    rows = fanned.groupBy("target", "key").count().collect()
    assert sorted((r.target, r.key, r["count"]) for r in rows) == [
        ("person_detail", "P1", 1), ("person_detail", "P2", 1), ("person_detail_certifications", "P1", 2), ("person_detail_current_employment", "P1", 2),
        ("person_detail_education", "P1", 1), ("person_detail_industry", "P1", 2), ("person_detail_web_reference", "P1", 1),
    ]


def test_cells_keep_order_and_names(spark):
    cells = cell_rows(p.person_detail_fan_out(people(spark)), p.person_detail_targets())
    jobs = cells.where("target = 'person_detail_current_employment' and column = 'CurrentJobTitle'")
    assert values(jobs, "key", "ordinal", "value") == [("P1", 0, "one"), ("P1", 1, "two")]
    years = cells.where("target = 'person_detail_certifications' and column = 'YearReceived'")
    assert values(years, "ordinal", "value") == [(0, None), (1, "1999")]
    assert cells.where("column = 'Description'").first().value == "x" * 498
    assert cells.where("target = 'person_detail'").count() == 2 * 11


def test_a_staged_table_reads_its_own_folder(spark):
    fanned = staged_fan_out(p.person_detail_fan_out(people(spark)), "fan_test")
    tables = tables_of(fanned, p.person_detail_targets())
    assert [t for t, df in tables.items() if df.count()] == [t for t in tables if t not in ("person_detail_past_employment", "person_detail_top_level_industry")]
    text = plan(tables["person_detail_education"])
    assert "PartitionFilters: [isnotnull(target" in text and "= person_detail_education" in text
    assert values(tables["person_detail_education"], "PersonID", "School", "Degree") == [("P1", "s", None)]


def test_plans_return_the_same_staged_or_not(spark):
    details = people(spark)
    company = p.parse_domain(bodies(spark, {"id": "d", "tags": ["x", "y"], "site": {"phoneNumbers": ["1"]}}, {"name": "no id"}))
    for make, source in ((persons.person_detail, details), (domains.domain_enrichment, company)):
        once, staged = make(source, staged=False), make(source)
        assert list(once) == list(staged)
        for name in once:
            assert once[name].columns == staged[name].columns and values(once[name]) == values(staged[name])


def test_no_bodies(spark):
    empty = p.parse_person_detail(spark.createDataFrame([], "body string"))
    assert all(df.count() == 0 for df in persons.person_detail(empty).values())
