"""The corpus pipeline: quality rules, near-duplicates, repeated lines, source mix, packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cleanroll.llm import lines, mixing, near, packing, quality
from cleanroll.llm.queries import BYTE_BPE
from cleanroll.session import stage


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose base counts and log ratio hold."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return _columns(quality.assess(docs, labels, keep=tuple(docs.columns)).where("kept"), docs)


def keep_one_of_a_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return _columns(near.classes(docs).where("keeper"), docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines and sentences that an earlier document has; what is left without any text goes."""
    cut = lines.dedup_lines(docs)
    return _columns(cut.where("removed is null or text rlike '[^\\\\s]'").withColumn("n_chars", F.length("text").cast("long")), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the mix and their places."""
    return packing.pack_documents(docs, BYTE_BPE)


STAGES = [
    ("quality", keep_good),
    ("near", keep_one_of_a_class),
    ("lines", cut_repeats),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
