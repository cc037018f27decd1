"""Email address validity."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Limits and character sets of an acceptable address (lower case only).
MIN_LENGTH = 6
MAX_LENGTH = 254
MAX_LOCAL = 64
LOCAL_CHARS = r"[a-z0-9!#$%&'*+/=?^_`{|}~-]"


def _label(edge: str, inner: str) -> str:
    """A DNS label of 1 to 63 characters that neither starts nor ends with a hyphen."""
    return f"{edge}(?:{inner}{{0,61}}{edge})?"


# The last label may hold a quote, the others may not.
INNER_LABEL = _label("[a-z0-9]", "[a-z0-9-]")
LAST_LABEL = _label("['a-z0-9]", "['a-z0-9-]")
ADDRESS = (
    rf"\A{LOCAL_CHARS}+(?:\.{LOCAL_CHARS}+)*@"
    rf"(?:{INNER_LABEL}\.)+"
    rf"{LAST_LABEL}\z"
)


def valid_email(email: Column) -> Column:
    """Lengths are tested before the pattern, so the pattern never walks a long text."""
    return (
        F.length(email).between(MIN_LENGTH, MAX_LENGTH)
        & F.locate("@", email).between(2, MAX_LOCAL + 1)
        & email.rlike(ADDRESS)
    )
