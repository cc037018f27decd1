"""Joins with rules of their own.

No side is forced into a broadcast: Spark broadcasts a side whose size is below
`spark.sql.autoBroadcastJoinThreshold`, from file sizes when planning and from
shuffle sizes at run time, and sorts and merges otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cleanroll.functions.addresses import upper_trim
from cleanroll.operators.sets import own_shuffle


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def resolve_country(phones: DataFrame, bridge: DataFrame, address: DataFrame, synonyms: DataFrame) -> DataFrame:
    """`phones` plus `address_key`, `country` and `country_code`, one row per address of the person.

    The chain starts at the phones of the batch, usually the smallest side, and drops
    everyone without an address or with an unknown country. Each join has both sides
    straight from a shuffle, so a hot person, address or country is split.
    """
    names = synonyms.select(F.col("country_synonym").alias("country"), "country_code")
    return (
        own_shuffle(phones).join(bridge.select("address_key", "person_key"), "person_key")
        .join(address.select("address_key", "country"), "address_key")
        .join(names, "country")
    )


def left_normalised(df: DataFrame, ref: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Left outer join on `upper(trim())` of each `{df column: ref column}` pair; df columns plus the others of ref."""
    keyed = ref.select(
        *[upper_trim(F.col(r)).alias(f"_ref_{l}") for l, r in pairs.items()],
        *[c for c in ref.columns if c not in pairs.values()],
    ).distinct()
    matched = df.join(own_shuffle(keyed), _all([upper_trim(df[l]) == F.col(f"_ref_{l}") for l in pairs]), "left")
    return matched.drop(*[f"_ref_{l}" for l in pairs])


def left_residual(df: DataFrame, ref: DataFrame, eq: Sequence[str], ne: str, flag: str) -> DataFrame:
    """`df` plus `flag`: 1 where `ref` has a row equal on `eq` with another value of `ne`, else 0.

    The least and the greatest `ne` of each `eq` group decide that: one of them
    differs from a value exactly when some row does. So no pair of rows within a
    group is ever formed, and `df` keeps its rows as they are.
    """
    span = ref.groupBy(*[F.col(c).alias(f"_ref_{c}") for c in eq]).agg(
        F.min(ne).alias("_least"), F.max(ne).alias("_most")
    )
    joined = df.join(own_shuffle(span), _all([df[c] == F.col(f"_ref_{c}") for c in eq]), "left")
    differs = (F.col("_least") != F.col(ne)) | (F.col("_most") != F.col(ne))
    return joined.withColumn(flag, F.when(differs, 1).otherwise(0)).select(*df.columns, flag)
