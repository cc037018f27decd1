"""Company domain enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cleanroll.functions.text import domain_request
from cleanroll.operators.fanout import staged_fan_out, tables_of
from cleanroll.operators.providers import domain_fan_out, domain_targets, parse_domain
from cleanroll.operators.sets import minus_distinct, union_by_position
from cleanroll.session import stage
from cleanroll.sources.answers import answers

PROVIDER = "domain"


def domain_candidates(websites: DataFrame, *histories: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct websites and email domains that are not known yet."""
    everything = union_by_position(websites.select("website"), *[h.select("domainpart") for h in histories])
    return minus_distinct(everything, known.select("domain"))


def domain_details(candidates: DataFrame, landed: DataFrame, fetched_since=None) -> DataFrame:
    keys = candidates.withColumn("request_key", domain_request(F.col("website")))
    return parse_domain(answers(keys, landed, PROVIDER, fetched_since))


def domain_enrichment(details: DataFrame, staged: bool = True, stage=stage) -> dict[str, DataFrame]:
    """Parent and four children; staged, the bodies are fetched, parsed and fanned out once."""
    fanned = domain_fan_out(details)
    return tables_of(staged_fan_out(fanned, "companies", stage) if staged else fanned, domain_targets())
