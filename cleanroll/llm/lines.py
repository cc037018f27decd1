"""Substring dedup: repeated lines and sentences, found by digest, go everywhere but at their earliest place."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cleanroll.session import Stages, stage

# A unit is a line, or a sentence of it: a passage pasted into a line repeats its sentences, not the line.
SENTENCE_END = re.compile(r"(?<=[.!?])[ \t]+|\n")
WORD = re.compile(r"\w+")
LEAST_RUN = 10
KEY = ["doc_id", "text_hash"]


def units_of(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of each line or sentence with anything in it, in code points, without the white space around it."""
    begin = 0
    for cut in SENTENCE_END.finditer(text):
        if text[begin : cut.start()].strip():
            yield begin, cut.start()
        begin = cut.end()
    if text[begin:].strip():
        yield begin, len(text)


def digest_of(unit: str) -> tuple[int, bytes]:
    """Words of a unit, and 16 bytes that are equal where its words are, whatever their case, spacing or punctuation."""
    words = WORD.findall(unit.lower())
    return len(words), hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def line_units(docs: DataFrame) -> DataFrame:
    """`doc_id, text_hash, unit, start, end, words, digest, again` of each unit with a word; `again`: not the first in its text."""
    schema = docs.select("doc_id", F.xxhash64("text").alias("text_hash")).schema
    names = [*schema.names, "unit", "start", "end", "words", "digest", "again"]
    ddl = f"doc_id {schema['doc_id'].dataType.simpleString()}, text_hash long, unit int, start int, end int, words int, digest binary, again boolean"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for row, cell in enumerate(batch.column("text")):
                text, seen, unit = cell.as_py() or "", set(), 0
                for start, end in units_of(text):
                    words, digest = digest_of(text[start:end])
                    if words:  # a separator without words has no number, so it splits no run
                        for column, value in zip(columns, (row, unit, start, end, words, digest, digest in seen), strict=True):
                            column.append(value)
                        seen.add(digest)
                        unit += 1
            rows = pa.array(columns[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("text_hash").take(rows)]
                + [pa.array(c, pa.int32()) for c in columns[1:5]] + [pa.array(columns[5], pa.binary()), pa.array(columns[6], pa.bool_())],
                names=names,
            )

    keyed = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return keyed.mapInArrow(cut, ddl)


def repeated_spans(stages: Stages, docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """`doc_id, text_hash, removed` of texts that lose something; removed: array of (start, end, words), in order.

    A unit stays where its digest has the smallest doc_id, at its first place there. Everywhere else it is a repeat, and
    neighbouring repeats form a run, which is removed if it has `least_run` words or more. Digests are counted and their
    first document found by partial aggregates; only digests found twice come back to the units, through a join
    whose hot digests Spark can split.
    """
    units = stages.write(line_units(docs), "units")
    found = units.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")
    twice = stages.write(found.select("digest", "first_id"), "digests")
    repeats = units.join(twice, "digest").where((F.col("doc_id") != F.col("first_id")) | F.col("again"))
    repeats = repeats.select(*KEY, "unit", "start", "end", "words").dropDuplicates([*KEY, "unit"])
    run = F.col("unit") - F.row_number().over(Window.partitionBy(*KEY).orderBy("unit"))
    runs = repeats.withColumn("run", run).groupBy(*KEY, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("words"))
    spans = runs.where(F.col("words") >= least_run).groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end", "words"))).alias("removed"))
    return spans


def staged_spans(docs: DataFrame, least_run: int) -> DataFrame:
    """`repeated_spans`, staged; the units they come from are deleted."""
    with Stages(docs.sparkSession) as stages:
        return stage(repeated_spans(stages, docs, least_run), "spans")


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """`text` without the spans; a line that is left without anything goes with its line end."""
    kept, begin = [], 0
    for start, end in spans:
        kept.append(text[begin:start])
        begin = end
        if (start == 0 or text[start - 1] == "\n") and text[end : end + 1] == "\n":
            begin = end + 1
        elif text[end : end + 1] == " ":
            begin = end + 1
    kept.append(text[begin:])
    return "".join(kept)


def removed_spans(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """`doc_id, removed` for every row of `docs`; removed is an empty array where nothing goes.

    Rows with a null doc_id have no rank: they keep all, and nothing is taken for a repeat of them. So do null and empty
    texts, which have no units. Rows that repeat both doc_id and text are one text and get the same spans: where they are
    the earliest, all of them stay. Rows that repeat a doc_id with other texts tie in rank and keep their units.
    """
    spans = staged_spans(docs, least_run)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    empty = F.expr("cast(array() as array<struct<start:int,end:int,words:bigint>>)")
    return keyed.join(spans, KEY, "left").select("doc_id", F.coalesce("removed", empty).alias("removed"))


def dedup_lines(docs: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """`docs` with repeats cut from `text` and their places in the old text in `removed`. See `removed_spans`."""
    spans = staged_spans(docs, least_run).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash", "removed": "_removed"})
    columns = [c for c in docs.columns if c not in ("text", "removed")]
    keyed = docs.select(*[F.col(f"`{c}`") for c in [*columns, "text"]])
    joined = keyed.join(spans, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left").drop("_id", "_hash")
    touched = [f.name for f in joined.schema.fields]

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i in np.flatnonzero(batch.column("_removed").is_valid().to_numpy(zero_copy_only=False)):
                texts[i] = without(texts[i], [(s["start"], s["end"]) for s in batch.column("_removed")[i].as_py()])
            yield batch.set_column(touched.index("text"), "text", pa.array(texts, batch.column("text").type))

    return joined.mapInArrow(strip, joined.schema).withColumnRenamed("_removed", "removed")
