"""Run log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cleanroll.operators.landing import stamp

STARTED, ENDED, FAILED = "started", "ended", "failed"
FILE_KEY = "1"


def max_batch(master: DataFrame) -> DataFrame:
    return master.agg(F.max("batch_id").alias("batch_id"))


def entity_lookup(entities: DataFrame, entity: str) -> DataFrame:
    """The key of a named entity, the least one if there are several."""
    return entities.where(F.col("entity_name") == entity).agg(F.min("entity_detail_key").alias("entity_detail_key"))


def audit_rows(
    master: DataFrame, entities: DataFrame, entity: str, instance: str, status: str, user: str, run_ts=None
) -> DataFrame:
    """One run-log row under the latest batch; none while the master is empty."""
    key = entity_lookup(entities, entity).select(F.col("entity_detail_key").cast("string")).scalar()
    return (
        max_batch(master)
        .where(F.col("batch_id").isNotNull())
        .select(
            "batch_id",
            F.lit(instance).alias("instance_name"),
            F.lit(status).alias("status"),
            F.lit(FILE_KEY).alias("file_key"),
            key.alias("entity_detail_key"),
            stamp(run_ts).alias("created_date"),
            F.lit(user).alias("created_user"),
        )
    )
