"""Company addresses: load of new ones, and the company-address bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cleanroll.functions.addresses import STREETS, address_key, hash_key_val, street_parts, truncated
from cleanroll.operators.joins import left_normalised, left_residual
from cleanroll.operators.sets import not_in

# Fixed value: the type of a company address.
COMPANY_ADDRESS_TYPE = 30000031


def split_addresses(employment: DataFrame) -> DataFrame:
    """Company id, address columns at their final lengths, and `match_key` of the uncut text."""
    parts = street_parts(F.col("CurrentAddressStreet"))
    named = employment.select(
        "CurrentCompanyID",
        address_key().alias("match_key"),
        *[column.alias(name) for name, column in parts.items()],
        F.col("CurrentAddressCity").alias("city"),
        F.col("CurrentAddressState").alias("state"),
        F.col("CurrentAddressZip").alias("postal_code"),
        F.col("CurrentAddressCountryCode").alias("country"),
    )
    cut = [truncated(c) for c in ("city", "country", "state", "postal_code")]
    return named.select("CurrentCompanyID", *STREETS, *cut, "match_key")


def address_load(employment: DataFrame, known: DataFrame, states: DataFrame) -> DataFrame:
    """New distinct addresses with their state key.

    `known` has the `match_key` stored with each address. The key is that of the uncut
    text, so addresses alike up to a column limit stay apart. Addresses are made
    distinct first, so the joins see each once.
    """
    fresh = not_in(split_addresses(employment).distinct(), "match_key", known)
    keyed = left_normalised(
        fresh,
        states.select("country_synonym", "state_name", "address_state_key"),
        {"country": "country_synonym", "state": "state_name"},
    )
    return keyed.select(
        "CurrentCompanyID", *STREETS, "city", "country", "state", "postal_code", "address_state_key",
        "match_key", hash_key_val().alias("hash_key_val"), F.lit(0).alias("update_flag"),
    )


def address_bridge(
    staged: DataFrame, companies: DataFrame, addresses: DataFrame, bridge: DataFrame, type_key: int = COMPANY_ADDRESS_TYPE
) -> DataFrame:
    """Distinct (company, type, address); `update_flag` is 1 where the company is bridged to another address.

    Both `staged` and `addresses` have the stored `match_key`: nothing is hashed again.
    """
    ids = companies.select(F.col("enrichment_api_company_id").alias("CurrentCompanyID"), "enrichment_api_company_key")
    stored = addresses.select("match_key", "address_key")
    pairs = (
        staged.select("CurrentCompanyID", "match_key")
        .distinct()
        .join(ids, "CurrentCompanyID")
        .join(stored, "match_key")
        .select("enrichment_api_company_key", F.lit(type_key).alias("address_type_key"), "address_key")
        .distinct()
    )
    return left_residual(pairs, bridge, ["enrichment_api_company_key", "address_type_key"], "address_key", "update_flag")
