"""Key/value settings from a header CSV."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

MAX_SETTINGS = 10_000


def settings_table(spark: SparkSession, path: str) -> DataFrame:
    """`(key, value)`, one row per key: the last line of the file wins.

    Of several files the last by path wins. A scan may take files in any order, so a
    line's place is its file, the start of its block, and its id, which grows within a block.
    """
    raw = spark.read.option("header", True).csv(path)
    first, second = raw.columns[:2]
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    lines = raw.select(
        F.col(first).alias("key"), F.col(second).alias("value"), place.alias("line")
    )
    return (
        lines.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max_by("value", "line").alias("value"))
    )


def read_settings(spark: SparkSession, path: str, required: Iterable[str] = ()) -> dict[str, str | None]:
    """The settings as a dict. A settings file is small; more than MAX_SETTINGS keys is an error."""
    rows = settings_table(spark, path).take(MAX_SETTINGS + 1)
    if len(rows) > MAX_SETTINGS:
        raise ValueError(f"{path}: more than {MAX_SETTINGS} settings")
    found = {row["key"]: row["value"] for row in rows}
    missing = sorted(set(required) - found.keys())
    if missing:
        raise KeyError(f"{path}: missing settings {missing}")
    return found
