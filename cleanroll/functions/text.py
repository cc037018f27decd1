"""Text clean-up and request strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A description of 500 characters or more is cut to 498.
DESCRIPTION_LIMIT = 500
DESCRIPTION_KEPT = 498


def null_text(column: Column) -> Column:
    """NULL where the text is the word "null" in any case."""
    return F.when(F.lower(column) != "null", column)


def null_or_empty(column: Column) -> Column:
    return F.nullif(null_text(column), F.lit(""))


def truncate_description(column: Column) -> Column:
    return F.when(F.length(column) >= DESCRIPTION_LIMIT, F.substring(column, 1, DESCRIPTION_KEPT)).otherwise(column)


def base64_text(column: Column) -> Column:
    return F.unbase64(column).cast("string")


def form_encoded(column: Column) -> Column:
    """application/x-www-form-urlencoded: a blank becomes `+`."""
    return F.url_encode(column)


def percent_encoded(column: Column) -> Column:
    """RFC 3986: everything but letters, digits and `-._~` becomes %XX."""
    text = F.url_encode(column)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        text = F.replace(text, F.lit(found), F.lit(wanted))
    return text


# The request strings each provider's answers are keyed by.
def email_request(email: Column, timeout: int = 30) -> Column:
    return F.concat(F.lit(f"Timeout={timeout}&emailAddress="), form_encoded(email), F.lit("&outputFormat=json"))


def match_request(first: Column, last: Column, email: Column) -> Column:
    return F.concat(
        F.lit("emailAddress="), percent_encoded(email),
        F.lit("&firstname="), percent_encoded(first),
        F.lit("&lastName="), percent_encoded(last),
        F.lit("&outputFormat=json"),
    )


def detail_request(person_id: Column) -> Column:
    options = "&outputFieldOptions=jobFunction%2CmanagementLevel%2CcompanyTopLevelIndustry&outputFormat=json"
    return F.concat(F.lit("PersonID="), person_id, F.lit(options))


def phone_request(number: Column, country: Column | None = None) -> Column:
    plain = F.concat(F.lit("PhoneNumber="), number, F.lit("&outputFormat=json"))
    if country is None:
        return plain
    return F.when(country.isNull(), plain).otherwise(F.concat(F.lit("Country="), country, F.lit("&"), plain))


def reverse_request(number: Column) -> Column:
    return F.concat(F.lit("Action=Check&PhoneNumber="), number, F.lit("&outputFormat=json"))


def owner_request(number: Column) -> Column:
    return F.concat(F.lit("PhoneNumber="), number, F.lit("&TestType=FULL&outputFormat=json"))


def domain_request(domain: Column) -> Column:
    return F.concat(F.lit("domain="), domain, F.lit("&outputFormat=json"))
