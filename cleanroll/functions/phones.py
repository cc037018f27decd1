"""Phone numbers brought to national digits by a numbering plan.

A plan is a short list of regions held in code. It becomes literal patterns over the
text `region:digits`, each compiled once: no join, no broadcast, no Python per row,
and an expression small enough for the JVM to compile.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_REGION = "US"
# A text with fewer digits than these cannot be read as a number at all.
MIN_DIGITS = 2
# How an extension is written behind a number, and the letters of the keypad.
EXTENSION = r"(?i)(?<=[0-9])[\s,;.)]*(?:;ext=|extension|extn|ext|xtn|x|#)[\s.:]*[0-9]{1,7}#?\s*\z"
LETTERS, KEYS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "22233344455566677778889999"
# A number spelt in letters has at least three of them.
SPELT = r"(?i)\A(?:[^a-z]*[a-z]){3}"
MAX_REGIONS = 300


@dataclass(frozen=True)
class Region:
    """One numbering region. `pattern` must match the whole national number; `dial_out` leads abroad."""

    region: str
    calling_code: str
    trunk: str
    min_len: int
    max_len: int
    pattern: str
    dial_out: str = ""


# Fixed values from public numbering plans. Regions and calling codes outside this list are not
# covered: their digits are kept as they are and never flagged valid.
# The last value is the prefix for calls abroad.
PLAN = (
    Region("US", "1", "1", 10, 10, "[2-9][0-9]{2}[2-9][0-9]{6}", "011"),
    Region("CA", "1", "1", 10, 10, "[2-9][0-9]{2}[2-9][0-9]{6}", "011"),
    Region("GB", "44", "0", 9, 10, "[1-9][0-9]{8,9}", "00"),
    Region("FR", "33", "0", 9, 9, "[1-9][0-9]{8}", "00"),
    Region("DE", "49", "0", 6, 11, "[1-9][0-9]{5,10}", "00"),
    Region("ES", "34", "", 9, 9, "[5-9][0-9]{8}", "00"),
    Region("IN", "91", "0", 10, 10, "[1-9][0-9]{9}", "00"),
    Region("AU", "61", "0", 9, 9, "[2-478][0-9]{8}", "0011"),
    Region("JP", "81", "0", 9, 10, "[1-9][0-9]{8,9}", "010"),
    Region("BR", "55", "0", 10, 11, "[1-9][0-9]{9,10}", "00"),
    Region("MX", "52", "", 10, 10, "[1-9][0-9]{9}", "00"),
)


def _rest(least: int, most: int) -> str:
    """Looks ahead: the remaining digits are `least` to `most`."""
    return f"(?=[0-9]{{{least},{most}}}$)"


def _prefix_at_home(r: Region) -> str:
    """What is stripped from a number written inside its region.

    The trunk prefix, when a national length remains; else the region's own calling
    code, when the digits are too many for a national number and fit without it.
    """
    code = f"{r.calling_code}{_rest(max(r.min_len, r.max_len - len(r.calling_code) + 1), r.max_len)}"
    return f"(?:{r.trunk}{_rest(r.min_len, r.max_len)}|{code})?" if r.trunk else f"(?:{code})?"


def _prefix_abroad(r: Region) -> str:
    """The calling code, and a trunk digit that is written all the same: "+44 (0)20 ..."."""
    doubled = f"(?:{r.trunk}{_rest(r.min_len, r.max_len)})?" if r.trunk not in ("", r.calling_code) else ""
    return f"{r.calling_code}{doubled}"


def _branches(plan: Sequence[Region]) -> list[tuple[str, Region]]:
    """`tag:prefix` of each way to write a number, with its region. `+` tags a number written for abroad.

    Regions sharing a calling code share the first one's rules; longer codes come first.
    """
    by_code: dict[str, Region] = {}
    for r in plan:
        by_code.setdefault(r.calling_code, r)
    abroad = sorted(by_code.values(), key=lambda r: -len(r.calling_code))
    return [(rf"\+:{_prefix_abroad(r)}", r) for r in abroad] + [(f"{r.region}:{_prefix_at_home(r)}", r) for r in plan]


def _written(number: str) -> Column:
    """The number from its first digit or `+`, without an extension, letters turned into their keys."""
    start = F.regexp_replace(number, r"\A[^0-9+]+", "")
    bare = F.upper(F.regexp_replace(start, EXTENSION, ""))
    return F.when(bare.rlike(SPELT), F.translate(bare, LETTERS, KEYS)).otherwise(bare)


def _dial_out(plan: Sequence[Region]) -> str:
    """`region:prefix` of a call abroad, with a digit other than 0 behind it."""
    regions: dict[str, list[str]] = {}
    for r in plan:
        if r.dial_out:
            regions.setdefault(r.dial_out, []).append(r.region)
    ways = [f"(?:{'|'.join(names)}):{prefix}" for prefix, names in regions.items()]
    return rf"\A(?:{'|'.join(ways)})(?=[1-9])" if ways else ""


def standardise(
    df: DataFrame,
    number: str,
    country: str | None,
    plan: Sequence[Region] = PLAN,
    default: str = DEFAULT_REGION,
) -> DataFrame:
    """`df` plus `standardised_phone_number`, `is_valid_flag` and `calling_code`.

    A number that starts with `+` is read by its longest known calling code. Any
    other number belongs to `country` (`default` where NULL): its own calling code
    or trunk prefix is stripped when what remains has a length of that region.
    Leading zeros carry no meaning in a national number and go too. A number behind
    the region's dial-out prefix is read as if it began with `+`; an extension is no
    part of a number; one spelt in letters is dialled by its keys. Texts without two
    digits drop out; every other number stays, flagged `false` where it is not valid.
    """
    if len(plan) > MAX_REGIONS or not all(r.region.isalnum() for r in plan):
        raise ValueError(f"a plan holds at most {MAX_REGIONS} regions with plain names")
    branches = _branches(plan)
    strip = rf"\A(?:{'|'.join(prefix for prefix, _ in branches)}|[^:]*:)0*(?=[0-9])"
    # Atomic groups: the prefix is settled before the pattern is tried, as in `strip`.
    valid = rf"\A(?:{'|'.join(f'(?>{prefix}0*)(?:{r.pattern})' for prefix, r in branches)})\z"

    home = F.coalesce(F.col(country), F.lit(default)) if country else F.lit(default)
    tag = F.when(F.col("_written").startswith("+"), F.lit("+")).otherwise(home)
    placed = F.concat_ws(":", tag, F.col("_digits"))
    dialled = _dial_out(plan)
    tagged = (
        df.withColumn("_written", _written(number))
        .withColumn("_digits", F.regexp_replace("_written", "[^0-9]", ""))
        .where(F.length("_digits") >= MIN_DIGITS)
        .withColumn("_tagged", F.regexp_replace(placed, dialled, "+:") if dialled else placed)
    )
    codes = sorted({r.calling_code for r in plan}, key=lambda c: -len(c))
    # The calling code is the one written after "+:", or that of the region before the colon.
    origin = F.regexp_extract("_tagged", rf"\A(?:\+:({'|'.join(codes)})|([^:]*))", 0)
    called = [(F.lit(f"+:{code}"), F.lit(code)) for code in codes] + [(F.lit(r.region), F.lit(r.calling_code)) for r in plan]
    calling = F.try_element_at(F.create_map(*[part for pair in called for part in pair]), origin)
    return (
        # `concat_ws` and so the number are never NULL, and Spark knows it: a later
        # NULL test adds no second evaluation in a filter.
        tagged.withColumn("standardised_phone_number", F.coalesce(F.regexp_replace("_tagged", strip, ""), F.lit("")))
        .withColumn("is_valid_flag", F.col("_tagged").rlike(valid).cast("string"))
        .withColumn("calling_code", calling)
        .drop("_written", "_digits", "_tagged")
    )


def e164(calling_code: Column, national: Column) -> Column:
    return F.concat(F.lit("+"), calling_code, national)
