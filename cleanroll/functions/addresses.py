"""Street split, column limits and address keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Column limits of the address tables.
STREET_PART = 100
STREET_PARTS = 5
LIMITS = {"city": 100, "country": 255, "state": 255, "postal_code": 50}
STREETS = tuple(f"street{i}_name" for i in range(1, STREET_PARTS + 1))
ADDRESS_COLUMNS = (*STREETS, "city", "country", "state", "postal_code")
# The address as delivered, before any limit: what tells two addresses apart.
FULL_COLUMNS = ("CurrentAddressStreet", "CurrentAddressCity", "CurrentAddressCountryCode", "CurrentAddressState", "CurrentAddressZip")

def street_parts(street: Column) -> dict[str, Column]:
    """Consecutive parts of 100 characters; a part beyond the end is empty."""
    return {
        name: F.substring(street, 1 + i * STREET_PART, STREET_PART) for i, name in enumerate(STREETS)
    }


def truncated(name: str) -> Column:
    return F.substring(F.col(name), 1, LIMITS[name]).alias(name)


def address_key(columns=FULL_COLUMNS) -> Column:
    """The match key: 256-bit, and different where only the place of a NULL differs.

    Each value is written with its length, so no value can imitate a separator.
    """
    parts = [
        F.when(F.col(c).isNull(), F.lit("-")).otherwise(
            F.concat(F.length(F.col(c)).cast("string"), F.lit(":"), F.col(c))
        )
        for c in columns
    ]
    return F.sha2(F.concat_ws("|", *parts), 256)


def hash_key_val(columns=ADDRESS_COLUMNS) -> Column:
    """The 32-bit Murmur3 value kept for the existing column; not used for matching."""
    return F.hash(*[F.col(c) for c in columns])


def upper_trim(column: Column) -> Column:
    return F.upper(F.trim(column))
