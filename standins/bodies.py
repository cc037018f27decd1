"""Body templates of each provider.

Every provider gets a dozen bodies whose members are by turns a text, JSON null, the
word null, or empty, and whose optional parts come and go, plus some that are cut
short, an error, without their root, or empty. OWNER stands for the request's key
and EXTRA for a text derived from it.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable

OWNER, EXTRA = "<<", ">>"
GOOD = 12

PHONE_VERDICT_NAMES = [
    "RecordID", "Results", "PhoneNumber", "AdministrativeArea", "CountryAbbreviation", "CountryName", "Carrier",
    "CallerID", "DST", "InternationalPhoneNumber", "Language", "Latitude", "Locality", "Longitude",
    "PhoneInternationalPrefix", "PhoneCountryDialingCode", "PhoneNationPrefix", "PhoneNationalDestinationCode",
    "PhoneSubscriberNumber", "UTC", "PostalCode",
]
EXCHANGE_NAMES = [
    "PhoneNumber", "Name", "City", "State", "Country", "LineType", "TimeZone", "Latitude", "Longitude", "SMSAddress", "MMSAddress",
]
PORTED_NAMES = ["OriginalName", "OriginalLineType", "PortedDate", "LATA"]
REVERSE_NAMES = [
    "AddressExtras", "AddressKey", "AddressLine1", "AddressLine2", "City", "CompanyName", "EmailAddress",
    "MelissaAddressKey", "NameFull", "PhoneNumber", "PostalCode", "RecordExtras", "RecordID", "Reserved", "Results", "State",
]
PROVIDER_NAMES = ["Name", "City", "State", "Latitude", "Longitude", "LineType"]
CONTACT_NAMES = [
    "Name", "Address", "City", "State", "PostalCode", "PhoneType", "Latitude", "Longitude", "SICCode", "SICDesc", "QualityScore",
]
OWNER_NAMES = ["SMSAddress", "MMSAddress", "DateFirstSeen", "DateOfPorting", "NoteCodes", "NoteDescriptions", "TokensUsed"]
MATCH_NAMES = [
    "matchConfidence", "personId", "zoomPersonUrl", "personDetailXmlUrl", "lastMentioned", "isUserPosted", "isPast",
    "referencesCount", "firstName", "lastName", "phone", "fax",
]
MATCH_PATH = ["personMatchResponse", "matchResults", "personMatchResults", "personMatchResult", "personMatches", "personMatch"]
DETAIL_NAMES = [
    "PersonID", "ZoomPersonUrl", "LastUpdatedDate", "IsUserPosted", "ImageUrl", "FirstName", "LastName", "Email",
    "DirectPhone", "CompanyPhone", "Biography",
]
DOMAIN_GROUPS = {
    "": ["id", "name", "legalName", "domain", "url", "description", "foundedYear", "location", "timeZone", "utcOffset",
         "logo", "emailProvider", "type", "ticker", "phone", "indexedAt"],
    "site": ["url", "title", "h1", "metaDescription", "metaAuthor"],
    "category": ["sector", "industryGroup", "industry", "subIndustry"],
    "geo": ["streetNumber", "streetName", "subPremise", "city", "postalCode", "state", "stateCode", "country", "countryCode", "lat", "lng"],
    "facebook": ["handle"],
    "linkedin": ["handle"],
    "twitter": ["handle", "id", "bio", "followers", "following", "location", "site", "avatar"],
    "crunchbase": ["handle"],
    "metrics": ["alexaUsRank", "alexaGlobalRank", "googleRank", "employees", "employeesRange", "marketCap", "raised", "annualRevenue"],
}




class Maker:
    """Choices of one template."""

    def __init__(self, provider: str, number: int):
        self.number = number
        self.random = random.Random(f"{provider}{number}")

    def mixed(self, text: str):
        return self.random.choice([None, "Null", "", *[text] * 6])

    def members(self, names, **given) -> dict:
        return {n: given[n] if n in given else self.mixed(f"{n} {OWNER}") for n in names}

    def one_or_many(self, item: Callable[[int], dict]):
        """Missing, null, empty, one object, or an array of one to three."""
        some = [item(i) for i in range(1, 4)]
        return self.random.choice([None, [], some[0], some[0], some[:1], some[:2], some])

    def some(self, *choices):
        return self.random.choice(choices)


def email(m: Maker) -> dict:
    result = {
        "ServiceStatus": {"StatusNbr": m.some("220", "200"), "StatusDescription": m.mixed(f"status {OWNER}")},
        "ServiceResult": {
            "Reason": {"Code": m.some("222", "222", "210"), "Description": m.mixed("reason")},
            "HygieneResult": m.mixed("clean"),
            "NetProtected": m.mixed("false"),
            "SourceIdentifier": m.mixed("source"),
            "Email": OWNER,
            "LocalPart": m.mixed("local"),
            "DomainPart": EXTRA,
            "IronStandardCertifiedTimestamp": m.mixed("2001-07-01"),
            "DomainKnowledge": m.mixed("known"),
            "AddressKnowledge": m.some(None, {"StringKeyValuePair": {"Key": "k", "Value": m.mixed("v")}}),
        },
    }
    if m.number == 0:
        result = {"ServiceStatus": {"StatusNbr": "220"}, "ServiceResult": {"Reason": {"Code": "222"}, "Email": OWNER}}
    if m.number == 1:
        result = None
    return {"WebServiceResponse": {"VerifyEmailResponse": {"VerifyEmailResult": result}}}


def codes(m: Maker) -> str:
    return m.some("PS01,PS02", "PS16", "PS0200", "PS07")


def phone(m: Maker) -> dict:
    record = m.members(PHONE_VERDICT_NAMES, Results=codes(m), PhoneNumber=OWNER)
    return {"Records": [[], record, [None], [record, record]][m.number] if m.number < 4 else [record]}


def phone_exchange(m: Maker) -> dict:
    ported = m.members(PORTED_NAMES)
    notes = {"NoteCodes": m.mixed("7"), "NoteDescriptions": "seven"}
    record = m.members(EXCHANGE_NAMES)
    inside = m.some(None, ported, {**ported, "NoteCodes": "x"}, {**ported, "NoteCodes": "x", "NoteDescriptions": None})
    return {"ExchangeInfoResults": [{**record, "PortedInfo": inside, **m.some({}, notes, notes)}]}


def phone_reverse(m: Maker) -> dict:
    """Most members must be texts: JSON null or a number there is one of the cases."""
    record = {n: m.some("Null", "", *[f"{n} {OWNER}"] * 4) for n in REVERSE_NAMES}
    record |= {"Results": codes(m), "PhoneNumber": OWNER, "AddressKey": m.mixed("key")}
    if m.number < 3:
        record["City"] = [None, 17, {"name": "Town"}][m.number]
    return {"Records": [] if m.number == 3 else [record]}


def phone_owner(m: Maker) -> dict:
    contacts = m.some([], [m.members(CONTACT_NAMES)], [m.members(CONTACT_NAMES), m.members(CONTACT_NAMES)])
    return {"PhoneInfo": {"Provider": m.members(PROVIDER_NAMES), "Contacts": contacts, **m.members(OWNER_NAMES)}}


def person_match(m: Maker) -> dict:
    match = m.members(MATCH_NAMES, personId=EXTRA, matchConfidence=None if m.number == 0 else 97)
    if m.number == 1:
        del match["matchConfidence"]
    body: dict = match
    for name in reversed(MATCH_PATH):
        body = {name: body}
    return body


def person_detail(m: Maker) -> dict:
    def job(i: int) -> dict:
        address = {n: m.mixed(f"{n} {OWNER}-{i}") for n in ["Street", "City", "State", "Zip", "CountryCode"]}
        company = {"CompanyID": f"C{OWNER}-{i}", "CompanyName": m.mixed("Company"), "Phone": "555", "CompanyAddress": address}
        return {"JobTitle": m.mixed(f"Title {i} {OWNER}"), "JobFunction": "f", "FromDate": "2000", "Company": company}

    def web(i: int) -> dict:
        return {"Title": f"t{i} {OWNER}", "Url": "u", "Description": "word " * m.some(3, 98, 99, 100, 150) + OWNER, "Date": m.mixed("d")}

    def school(i: int) -> dict:
        return {"School": f"s{i} {OWNER}", "EducationDegree": {"Degree": m.mixed("BSc"), "AreaOfStudy": "a"}}

    def certificate(i: int) -> dict:
        return {"CertificationName": f"c{i} {OWNER}", "YearReceived": m.mixed("1999")}

    identity = [None, ""][m.number] if m.number < 2 else OWNER
    return {
        "PersonDetailRequest": {
            **m.members(DETAIL_NAMES, PersonID=identity),
            "CurrentEmployment": m.one_or_many(job),
            "PastEmployment": m.one_or_many(lambda i: job(i + 3)),
            "WebReference": m.one_or_many(web),
            "Education": m.one_or_many(school),
            "Certifications": m.one_or_many(certificate),
            "Industry": m.some([], "alone", ["i1", None, f"i {OWNER}"]),
            "TopLevelIndustry": ["top", f"t {OWNER}"],
        }
    }


def domain(m: Maker) -> dict:
    identity = [None, "", "NULL"][m.number] if m.number < 3 else f"id {OWNER}"
    body = m.members(DOMAIN_GROUPS[""], id=identity, domain=OWNER)
    for group, names in DOMAIN_GROUPS.items():
        if group:
            body[group] = {n: m.mixed(f"{group} {n} {OWNER}") for n in names}
    body["site"] |= {"phoneNumbers": m.some(None, [], ["555-1", OWNER]), "emailAddresses": [f"info@{OWNER}", None]}
    return {**body, "domainAliases": m.some("alone", [f"www.{OWNER}"], ["a", "b"]), "tags": ["B2B", f"tag {OWNER}"]}


def templates(make: Callable[[Maker], dict]) -> list[str]:
    good = [json.dumps(make(Maker(make.__name__, i))) for i in range(GOOD)]
    return [*good, good[-1][:-2], json.dumps({"ErrorMessage": "not found"}), json.dumps({"other": 1}), ""]


TEMPLATES = {
    make.__name__: templates(make)
    for make in (email, phone, phone_exchange, phone_reverse, phone_owner, person_match, person_detail, domain)
}
