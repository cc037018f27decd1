"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cleanroll.llm import ans, codebooks, html, licenses, lines, mixing, near, negatives, packing, quality, rabitq, simhash, warc

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archived(_table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op4_ans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ans.stored(_table(spark, sf_dir, "documents"), WORD_BPE)


def op5_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.nearest(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "detections")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), BYTE_BPE)


def op9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.classes(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "keeper")


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.removed_spans(_table(spark, sf_dir, "documents"))


def op11_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.quantise(_table(spark, sf_dir, "embeddings")).drop("label")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(_table(spark, sf_dir, "embeddings"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_warc": op2_warc,
    "op3_html": op3_html,
    "op4_ans": op4_ans,
    "op5_rabitq": op5_rabitq,
    "op6_licenses": op6_licenses,
    "op7_mixing": op7_mixing,
    "op8_packing": op8_packing,
    "op9_near": op9_near,
    "op10_lines": op10_lines,
    "op11_codebooks": op11_codebooks,
    "op12_negatives": op12_negatives,
    "op13_simhash": op13_simhash,
}
ORACLES: dict[str, str] = {
    "op2_warc": warc.ORACLE, "op5_rabitq": rabitq.ORACLE, "op7_mixing": mixing.ORACLE, "op11_codebooks": codebooks.ORACLE,
    "op12_negatives": negatives.ORACLE, "op13_simhash": simhash.ORACLE,
}
