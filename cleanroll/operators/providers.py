"""One flattener per provider answer: `(keys, body)` in, flat rows out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cleanroll.functions.text import truncate_description
from cleanroll.operators import shapes
from cleanroll.operators.bodies import at, columns_of, flatten, parse
from cleanroll.operators.fanout import Target, children, fan_out, parent, tables_of, texts_of


def flatten_email_verdict(df: DataFrame, *keys: str) -> DataFrame:
    return flatten(df, shapes.EMAIL_VERDICT, keys)


def flatten_phone_verdict(df: DataFrame, *keys: str) -> DataFrame:
    return flatten(df, shapes.PHONE_VERDICT, keys)


def flatten_phone_exchange(df: DataFrame, *keys: str) -> DataFrame:
    """Notes stand beside PortedInfo but count only where PortedInfo names them too.

    A body whose PortedInfo names a note that does not stand beside it is rejected.
    """
    parsed = parse(df, shapes.PHONE_EXCHANGE)
    top = at(F.col("parsed"), "ExchangeInfoResults[0]")
    ported = top["PortedInfo"]
    for note in shapes.NOTES:
        parsed = parsed.where(ported[note].isNull() | top[note].isNotNull())
    flat = [
        F.when(ported[f.column].isNotNull(), column).alias(f.column) if f.column in shapes.NOTES else column
        for f, column in zip(shapes.PHONE_EXCHANGE.fields, columns_of(shapes.PHONE_EXCHANGE))
    ]
    return parsed.select(*keys, *flat)


def flatten_phone_reverse(df: DataFrame, *keys: str) -> DataFrame:
    """A row for any readable body, without a record too.

    Some fields must hold text: a body where one of them holds anything else is rejected.
    """
    parsed = parse(df, shapes.PHONE_REVERSE)
    records = F.col("parsed")["Records"]
    record = F.get(records, F.lit(0))
    readable = records.isNotNull() | F.try_parse_json("body").isNotNull()
    texts = [record[n].isNull() | (F.schema_of_variant(record[n]) == "STRING") for n in shapes.REVERSE_TEXTS_ONLY]
    accepted = reduce(lambda a, b: a & b, texts, readable)
    return parsed.where(accepted).select(*keys, *columns_of(shapes.PHONE_REVERSE))


def flatten_phone_owner(df: DataFrame, *keys: str) -> DataFrame:
    return flatten(df, shapes.PHONE_OWNER, keys)


def flatten_person_match(df: DataFrame, *keys: str) -> DataFrame:
    return flatten(df, shapes.PERSON_MATCH, keys)


def _has_text(column: Column) -> Column:
    return column.isNotNull() & (column != "")


def parse_person_detail(df: DataFrame) -> DataFrame:
    """Bodies with a person id, read once for the parent and all children."""
    parsed = parse(df, shapes.PERSON_DETAIL)
    return parsed.where(_has_text(at(F.col("parsed"), f"{shapes.DETAIL_ROOT}.PersonID"))).select("parsed")


def flatten_person_detail(df: DataFrame) -> DataFrame:
    return parse_person_detail(df).select(*columns_of(shapes.PERSON_DETAIL))


def person_detail_targets() -> list[Target]:
    """The parent and its seven children."""
    root, key = shapes.DETAIL_ROOT, "PersonID"
    return [
        parent("person_detail", shapes.PERSON_DETAIL),
        children("person_detail_current_employment", f"{root}.CurrentEmployment", shapes.CURRENT_EMPLOYMENT, "CurrentPersonID"),
        children("person_detail_past_employment", f"{root}.PastEmployment", shapes.PAST_EMPLOYMENT, key),
        children("person_detail_web_reference", f"{root}.WebReference", shapes.WEB_REFERENCE, key, {"Description": truncate_description}),
        children("person_detail_education", f"{root}.Education", shapes.EDUCATION, key),
        children("person_detail_certifications", f"{root}.Certifications", shapes.CERTIFICATIONS, key),
        texts_of("person_detail_industry", f"{root}.Industry", "Industry", key),
        texts_of("person_detail_top_level_industry", f"{root}.TopLevelIndustry", "TopLevelIndustry", key),
    ]


def person_detail_fan_out(parsed: DataFrame) -> DataFrame:
    """All rows of the parent and its children in one pass over a `parse_person_detail` result."""
    return fan_out(parsed, at(F.col("parsed"), f"{shapes.DETAIL_ROOT}.PersonID"), person_detail_targets())


def person_detail_tables(parsed: DataFrame) -> dict[str, DataFrame]:
    """The parent and its seven children off one `parse_person_detail` result."""
    return tables_of(person_detail_fan_out(parsed), person_detail_targets())


def parse_domain(df: DataFrame) -> DataFrame:
    """Bodies with a company id, read once for the parent and all children."""
    parsed = parse(df, shapes.DOMAIN)
    identity = F.col("parsed")["id"]
    return parsed.where(_has_text(identity) & (F.lower(identity) != "null")).select("parsed")


def flatten_domain(df: DataFrame) -> DataFrame:
    return parse_domain(df).select(*columns_of(shapes.DOMAIN))


def domain_targets() -> list[Target]:
    """The parent and its four children."""
    lists = [texts_of(f"domain_{column}", path, column, "id") for column, path in shapes.DOMAIN_LISTS.items()]
    return [parent("domain", shapes.DOMAIN), *lists]


def domain_fan_out(parsed: DataFrame) -> DataFrame:
    """All rows of the parent and its children in one pass over a `parse_domain` result."""
    return fan_out(parsed, F.col("parsed")["id"], domain_targets())


def domain_tables(parsed: DataFrame) -> dict[str, DataFrame]:
    """The parent and its four children off one `parse_domain` result."""
    return tables_of(domain_fan_out(parsed), domain_targets())
