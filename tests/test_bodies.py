import json

import pytest
from rows import values

from cleanroll.operators import providers as p

MATCH = ["personMatchResponse", "matchResults", "personMatchResults", "personMatchResult", "personMatches", "personMatch"]


def inside(value, *path):
    for name in reversed(path):
        value = {name: value}
    return value


@pytest.fixture
def bodies(table):
    def make(*items):
        return table([(i, b if isinstance(b, str) or b is None else json.dumps(b)) for i, b in enumerate(items)], "id int, body string")

    return make


UNREADABLE = ["", None, "{", '{"a":', "nothing", '{"a":1']
VERDICT = ("WebServiceResponse", "VerifyEmailResponse", "VerifyEmailResult")


def test_email_verdict(bodies):
    result = {
        "ServiceStatus": {"StatusNbr": 220, "StatusDescription": None},
        "ServiceResult": {
            "Reason": {"Code": "222", "Description": "null"}, "SourceIdentifier": "NULL", "Email": "a@b.co",
            "IronStandardCertifiedTimestamp": "", "DomainKnowledge": "null", "AddressKnowledge": {"StringKeyValuePair": {"Key": "k"}},
        },
    }
    out = p.flatten_email_verdict(bodies(inside(result, *VERDICT), *UNREADABLE), "id")
    row = out.collect()
    assert len(row) == 1
    got = row[0].asDict()
    assert (got["StatusNbr"], got["Code"], got["Description"], got["Email"], got["StringKeyValuePairKey"]) == ("220", "222", "null", "a@b.co", "k")
    assert all(got[n] is None for n in ("StatusDescription", "SourceIdentifier", "IronStandardCertifiedTimestamp", "DomainKnowledge", "LocalPart"))


def test_a_root_that_is_null_or_a_scalar_is_there_but_a_missing_one_is_not(bodies):
    df = bodies(inside(None, *VERDICT), inside("x", *VERDICT), inside({}, *VERDICT[:2]), {"other": 1}, [], inside([], *VERDICT))
    assert values(p.flatten_email_verdict(df, "id"), "id", "StatusNbr") == [(0, None), (1, None), (5, None)]


def test_phone_verdict_takes_the_first_record(bodies):
    df = bodies({"Records": [{"Results": "PS02", "DST": "Null"}, {"Results": "x"}]}, {"Records": []}, {"Records": {"Results": "x"}}, {}, {"Records": [None]})
    assert values(p.flatten_phone_verdict(df, "id"), "id", "Results", "DST") == [(0, "PS02", None), (4, None, None)]


def test_exchange_notes_follow_ported_info(bodies):
    def body(ported, **beside):
        return {"ExchangeInfoResults": [{"Name": "n", "PortedInfo": ported, **beside}]}

    both = {"NoteCodes": "7", "NoteDescriptions": "null"}
    df = bodies(
        body({"LATA": "1"}, **both), body({"NoteCodes": "x", "NoteDescriptions": None}, **both), body({"NoteCodes": "x"}), body(None, **both),
        body({"NoteCodes": None}, NoteCodes=None),
    )
    assert values(p.flatten_phone_exchange(df, "id"), "id", "LATA", "NoteCodes", "NoteDescriptions") == [
        (0, "1", None, None), (1, None, "7", None), (3, None, None, None), (4, None, None, None),
    ]


def test_reverse_gives_a_row_for_any_readable_body_but_refuses_non_texts(bodies):
    df = bodies(
        {"Records": [{"City": "c", "AddressKey": 5, "State": "NULL"}]}, {}, {"Records": []}, [], {"Records": [{"City": None}]},
        {"Records": [{"State": 7}]}, {"Records": [{"CompanyName": None}]}, *UNREADABLE,
    )
    assert values(p.flatten_phone_reverse(df, "id"), "id", "City", "AddressKey", "State") == [
        (0, "c", "5", None), (1, None, None, None), (2, None, None, None), (3, None, None, None), (6, None, None, None),
    ]


def test_owner_maps_each_contact_field_to_its_own_column(bodies):
    contact = {n: n for n in ["Name", "Address", "City", "State", "PostalCode", "PhoneType", "Latitude", "Longitude"]}
    df = bodies({"PhoneInfo": {"Provider": {"Name": ""}, "Contacts": [contact, {}], "TokensUsed": 3}}, {"PhoneInfo": {}}, {})
    rows = {r["id"]: r for r in p.flatten_phone_owner(df, "id").collect()}
    assert set(rows) == {0, 1}
    assert all(rows[0][f"Contacts{n}"] == n for n in contact)
    assert rows[0]["ProviderName"] is None and rows[0]["TokensUsed"] == "3"


def test_match_needs_a_confidence_and_no_error(bodies):
    df = bodies(
        inside({"matchConfidence": 9, "personId": "p"}, *MATCH), inside({"personId": "p"}, *MATCH),
        inside({"matchConfidence": None}, *MATCH), inside({"matchConfidence": 9, "fax": "ErrorMessage"}, *MATCH),
    )
    assert values(p.flatten_person_match(df, "id"), "id", "matchConfidence", "personId") == [(0, "9", "p"), (2, None, None)]


def detail(**members):
    return {"PersonDetailRequest": {"PersonID": "P1", **members}}


def children(bodies, body, table):
    return p.person_detail_tables(p.parse_person_detail(bodies(body)))[table]


def test_object_array_empty_null_and_scalar_children(bodies):
    job = {"JobTitle": "t", "Company": {"CompanyName": "c", "CompanyAddress": {"Zip": 12345}}}
    for value, want in (
        (job, [("P1", "t", "c", "12345")]), ([job, {}], [("P1", "t", "c", "12345"), ("P1", None, None, None)]),
        ([], []), (None, []), ("x", []), ([job, 7], [("P1", "t", "c", "12345"), ("P1", None, None, None)]),
        ([None, job], [("P1", "t", "c", "12345"), ("P1", None, None, None)]),
    ):
        out = children(bodies, detail(CurrentEmployment=value), "person_detail_current_employment")
        assert values(out, "CurrentPersonID", "CurrentJobTitle", "CurrentCompanyName", "CurrentAddressZip") == sorted(want, key=repr)


def test_children_of_each_kind(bodies):
    body = detail(
        PastEmployment={"JobFunction": "f", "Company": {"Fax": "x", "CompanyAddress": {"Zip": "z"}}},
        WebReference=[{"Title": "t", "Description": "d" * 600}],
        Education={"School": "s", "EducationDegree": {"Degree": "BSc"}},
        Certifications={"YearReceived": 1999}, Industry=["a", None], TopLevelIndustry="alone",
    )
    assert values(children(bodies, body, "person_detail_past_employment"), "PersonID", "JobFunction", "Fax", "Zip") == [("P1", "f", "x", "z")]
    assert len(children(bodies, body, "person_detail_web_reference").first()["Description"]) == 498
    assert values(children(bodies, body, "person_detail_education")) == [("P1", "s", None, "BSc", None)]
    assert values(children(bodies, body, "person_detail_certifications")) == [("P1", None, None, "1999")]
    assert values(children(bodies, body, "person_detail_industry")) == [("P1", "a"), ("P1", None)]
    assert children(bodies, body, "person_detail_top_level_industry").count() == 0


def test_parent_and_children_need_a_person_id(bodies):
    for identity in (None, ""):
        parsed = p.parse_person_detail(bodies(detail(PersonID=identity, Education={"School": "s"})))
        assert all(df.count() == 0 for df in p.person_detail_tables(parsed).values())


def test_domain(bodies):
    body = {
        "id": "d1", "type": "private", "indexedAt": "null", "site": {"url": "u", "phoneNumbers": ["1", 2]}, "geo": {"lat": 1.5},
        "tags": [], "domainAliases": "alone",
    }
    df = bodies(body, {**body, "id": None}, {**body, "id": ""}, {**body, "id": "NULL"}, {"name": "x"}, {**body, "name": "Unexpected 'l'"}, {**body, "name": "ErrorMessage"})
    out = p.domain_tables(p.parse_domain(df))
    assert len(out["domain"].columns) == 55
    assert values(out["domain"], "id", "type1", "siteurl", "geolat", "indexedAt") == [("d1", "private", "u", "1.5", "null")]
    assert values(out["domain_sitephoneNumbers"]) == [("d1", "1"), ("d1", "2")]
    assert out["domain_tags"].count() == out["domain_domainAliases"].count() == 0
