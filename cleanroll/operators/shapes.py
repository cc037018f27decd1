"""The bodies each provider answers with. All paths and column names are fixed values."""

from __future__ import annotations

from cleanroll.operators.bodies import ANY, Field, Shape, fields_under, nested, texts

ERROR = "ErrorMessage"

# --- email verdict ---------------------------------------------------------------------------
_VERDICT = "WebServiceResponse.VerifyEmailResponse.VerifyEmailResult"
_RESULT = f"{_VERDICT}.ServiceResult"
EMAIL_VERDICT = Shape(
    required=_VERDICT,
    fields=[
        *fields_under(f"{_VERDICT}.ServiceStatus", ["StatusNbr", "StatusDescription"]),
        *fields_under(f"{_RESULT}.Reason", ["Code", "Description"]),
        *fields_under(_RESULT, ["HygieneResult", "NetProtected", "NetProtectedBy"]),
        Field("SourceIdentifier", f"{_RESULT}.SourceIdentifier", "null_text"),
        *fields_under(_RESULT, ["Email", "LocalPart", "DomainPart"]),
        Field("IronStandardCertifiedTimestamp", f"{_RESULT}.IronStandardCertifiedTimestamp", "empty"),
        Field("DomainKnowledge", f"{_RESULT}.DomainKnowledge", "null_text"),
        *fields_under(
            f"{_RESULT}.AddressKnowledge.StringKeyValuePair",
            {"StringKeyValuePairKey": "Key", "StringKeyValuePairValue": "Value"},
        ),
    ],
)

# --- phone verdict ---------------------------------------------------------------------------
PHONE_VERDICT = Shape(
    required="Records[0]",
    fields=fields_under(
        "Records[0]",
        [
            "RecordID", "Results", "PhoneNumber", "AdministrativeArea", "CountryAbbreviation", "CountryName",
            "Carrier", "CallerID", "DST", "InternationalPhoneNumber", "Language", "Latitude", "Locality",
            "Longitude", "PhoneInternationalPrefix", "PhoneCountryDialingCode", "PhoneNationPrefix",
            "PhoneNationalDestinationCode", "PhoneSubscriberNumber", "UTC", "PostalCode",
        ],
        "null_text",
    ),
)

# --- phone exchange --------------------------------------------------------------------------
_EXCHANGE = "ExchangeInfoResults[0]"
NOTES = ["NoteCodes", "NoteDescriptions"]
PHONE_EXCHANGE = Shape(
    required=_EXCHANGE,
    fields=[
        *fields_under(
            _EXCHANGE,
            [
                "PhoneNumber", "Name", "City", "State", "Country", "LineType", "TimeZone",
                "Latitude", "Longitude", "SMSAddress", "MMSAddress",
            ],
            "null_text",
        ),
        *fields_under(
            f"{_EXCHANGE}.PortedInfo", ["OriginalName", "OriginalLineType", "PortedDate", "LATA"], "null_text"
        ),
        *fields_under(_EXCHANGE, NOTES, "null_text", ANY),
    ],
    # The notes are read only when their names also appear in PortedInfo.
    extra=fields_under(f"{_EXCHANGE}.PortedInfo", NOTES, kind=ANY),
)

# --- reverse phone ---------------------------------------------------------------------------
REVERSE_TEXTS_ONLY = [
    "City", "EmailAddress", "MelissaAddressKey", "NameFull", "PhoneNumber", "PostalCode",
    "RecordExtras", "RecordID", "Reserved", "Results", "State",
]
PHONE_REVERSE = Shape(
    fields=[
        Field(name, f"Records[0].{name}", "null_text", ANY) if name in REVERSE_TEXTS_ONLY
        else Field(name, f"Records[0].{name}", "null_text")
        for name in [
            "AddressExtras", "AddressKey", "AddressLine1", "AddressLine2", "City", "CompanyName",
            "EmailAddress", "MelissaAddressKey", "NameFull", "PhoneNumber", "PostalCode", "RecordExtras",
            "RecordID", "Reserved", "Results", "State",
        ]
    ],
)

# --- phone owner -----------------------------------------------------------------------------
PHONE_OWNER = Shape(
    required="PhoneInfo",
    fields=[
        *fields_under(
            "PhoneInfo.Provider",
            {f"Provider{n}": n for n in ["Name", "City", "State", "Latitude", "Longitude", "LineType"]},
            "null_or_empty",
        ),
        *fields_under(
            "PhoneInfo.Contacts[0]",
            {
                f"Contacts{n}": n
                for n in [
                    "Name", "Address", "City", "State", "PostalCode", "PhoneType", "Latitude", "Longitude",
                    "SICCode", "SICDesc", "QualityScore",
                ]
            },
            "null_or_empty",
        ),
        *fields_under(
            "PhoneInfo",
            ["SMSAddress", "MMSAddress", "DateFirstSeen", "DateOfPorting", "NoteCodes", "NoteDescriptions", "TokensUsed"],
            "null_or_empty",
        ),
    ],
)

# --- person match ----------------------------------------------------------------------------
_MATCH = "personMatchResponse.matchResults.personMatchResults.personMatchResult.personMatches.personMatch"
PERSON_MATCH = Shape(
    required=f"{_MATCH}.matchConfidence",
    rejects=[ERROR],
    fields=fields_under(
        _MATCH,
        [
            "matchConfidence", "personId", "zoomPersonUrl", "personDetailXmlUrl", "lastMentioned", "isUserPosted",
            "isPast", "referencesCount", "firstName", "lastName", "phone", "fax",
        ],
    ),
)

# --- person detail ---------------------------------------------------------------------------
DETAIL_ROOT = "PersonDetailRequest"
_DETAIL_CHILDREN = ["CurrentEmployment", "PastEmployment", "WebReference", "Education", "Certifications"]
_DETAIL_LISTS = ["Industry", "TopLevelIndustry"]
PERSON_DETAIL = Shape(
    required=DETAIL_ROOT,
    rejects=[ERROR],
    fields=fields_under(
        DETAIL_ROOT,
        [
            "PersonID", "ZoomPersonUrl", "LastUpdatedDate", "IsUserPosted", "ImageUrl", "FirstName", "LastName",
            "Email", "DirectPhone", "CompanyPhone", "Biography",
        ],
    ),
    extra=[nested(f"{DETAIL_ROOT}.{n}") for n in _DETAIL_CHILDREN]
    + [texts(n, f"{DETAIL_ROOT}.{n}") for n in _DETAIL_LISTS],
)


def _employment(prefix: str, names: dict[str, str]) -> list[Field]:
    paths = {
        "JobTitle": "JobTitle", "JobFunction": "JobFunction", "ManagementLevel": "ManagementLevel",
        "FromDate": "FromDate", "ToDate": "ToDate", "CompanyID": "Company.CompanyID",
        "ZoomCompanyUrl": "Company.ZoomCompanyUrl", "CompanyDetailXmlUrl": "Company.CompanyDetailXmlUrl",
        "CompanyName": "Company.CompanyName", "Phone": "Company.Phone", "Fax": "Company.Fax",
        "Website": "Company.Website", "AddressStreet": "Company.CompanyAddress.Street",
        "AddressCity": "Company.CompanyAddress.City", "AddressState": "Company.CompanyAddress.State",
        "AddressZip": "Company.CompanyAddress.Zip", "AddressCountryCode": "Company.CompanyAddress.CountryCode",
    }
    return [Field(names.get(name, prefix + name), path) for name, path in paths.items()]


CURRENT_EMPLOYMENT = _employment(
    "Current",
    {
        "JobFunction": "Currentjobfunctiondescription", "ManagementLevel": "Currentmanagementleveldescription",
        "Phone": "CurrentCompanyPhone", "Fax": "CurrentCompanyFax",
    },
)
PAST_EMPLOYMENT = _employment("", {"AddressZip": "Zip"})
WEB_REFERENCE = [Field(n, n) for n in ["Title", "Url", "Description", "Date"]]
EDUCATION = [
    Field("School", "School"), Field("GraduationDate", "GraduationDate"),
    Field("Degree", "EducationDegree.Degree"), Field("AreaOfStudy", "EducationDegree.AreaOfStudy"),
]
CERTIFICATIONS = [Field(n, n) for n in ["CertificationName", "OrganizationName", "YearReceived"]]

# --- domain ----------------------------------------------------------------------------------
# Column names are the path with its dots removed, but for these.
_DOMAIN_RENAMED = {"type": "type1"}
_DOMAIN_PATHS = [
    "id", "name", "legalName", "domain", "url",
    "site.url", "site.title", "site.h1", "site.metaDescription", "site.metaAuthor",
    "category.sector", "category.industryGroup", "category.industry", "category.subIndustry",
    "description", "foundedYear", "location", "timeZone", "utcOffset",
    "geo.streetNumber", "geo.streetName", "geo.subPremise", "geo.city", "geo.postalCode", "geo.state",
    "geo.stateCode", "geo.country", "geo.countryCode", "geo.lat", "geo.lng",
    "logo", "facebook.handle", "linkedin.handle",
    "twitter.handle", "twitter.id", "twitter.bio", "twitter.followers", "twitter.following",
    "twitter.location", "twitter.site", "twitter.avatar",
    "crunchbase.handle", "emailProvider", "type", "ticker", "phone",
    "metrics.alexaUsRank", "metrics.alexaGlobalRank", "metrics.googleRank", "metrics.employees",
    "metrics.employeesRange", "metrics.marketCap", "metrics.raised", "metrics.annualRevenue",
    "indexedAt",
]
DOMAIN_LISTS = {
    "domainAliases": "domainAliases", "tags": "tags",
    "sitephoneNumbers": "site.phoneNumbers", "siteemailAddresses": "site.emailAddresses",
}
DOMAIN = Shape(
    rejects=[ERROR, "Unexpected 'l'"],
    fields=[
        Field(_DOMAIN_RENAMED.get(p, p.replace(".", "")), p, "as_is" if p == "indexedAt" else "null_text")
        for p in _DOMAIN_PATHS
    ],
    extra=[texts(column, path) for column, path in DOMAIN_LISTS.items()],
)
