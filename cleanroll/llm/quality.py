"""Quality rules: a hashed n-gram log-likelihood ratio of every document, and base counts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BUCKETS = 1 << 14
SAMPLE = 20_000
SMOOTHING = 5.0  # added to a bucket's count in the target and to the count it would have at the corpus' share
THRESHOLD = -0.1
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of words in repeated windows
# White space between words, and the symbols that are counted.
SPACE = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"


def words_of(text: str) -> list[bytes]:
    """Runs of anything but ASCII white space; bytes split at just that."""
    return text.encode("utf-8", "surrogatepass").split()


def hashed_ngrams(words: list[bytes], buckets: int) -> np.ndarray:
    """Buckets of all words and all pairs of neighbours."""
    h = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] + np.uint64(1)
    grams = np.concatenate([h, pairs]) * np.uint64(0xBF58476D1CE4E5B9)
    return ((grams >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def repeated_words(words: list[bytes]) -> int:
    """Places that lie in a window of three words found twice or more."""
    if len(words) < 4:
        return 0
    h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    windows = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1]) * np.uint64(0xBF58476D1CE4E5B9) + h[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    again = np.zeros(len(windows), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


def trusted_ids(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Ids of at most `sample` documents labelled good and not toxic, chosen by hash: the trusted target."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def bucket_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, sample: int = SAMPLE) -> np.ndarray:
    """log p_target - log p_raw per bucket, near 0 where counts say little. Raw counts cover all documents, target counts the trusted ones.

    A task sends one row a bucket at most; `buckets` rows reach the driver.
    """
    trusted = F.broadcast(trusted_ids(labels, sample).withColumn("trusted", F.lit(True)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            for text, good in zip(batch.column("text"), batch.column("trusted"), strict=True):
                words = words_of(text.as_py() or "")
                if words:
                    found = np.bincount(hashed_ngrams(words, buckets), minlength=buckets)
                    counts[0] += found
                    if good.as_py():
                        counts[1] += found
        seen = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[0][seen]), pa.array(counts[1][seen])], names=["bucket", "raw", "target"])

    flagged = docs.select("doc_id", "text").join(trusted, "doc_id", "left").select("text", "trusted")
    summed = flagged.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for row in summed.collect():
        raw[row.bucket], target[row.bucket] = row.raw, row.target
    if not target.sum():  # nothing to trust: no document is told apart
        return np.zeros(buckets)
    expected = raw * (target.sum() / raw.sum())
    return np.log((target + SMOOTHING) / (expected + SMOOTHING))


SCORES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, llr double"
)


def assess(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, sample: int = SAMPLE, keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns `keep` of every row of `docs`, with its counts, `llr` and `kept`.

    llr is the mean log ratio over a document's words and pairs; it is kept if the base holds and llr >= threshold. A
    null or empty text has no words: llr 0, base failed. Repeated rows are judged alike. Columns of `keep` that clash
    with a result's name are left out. Without a trusted document all llr are 0.
    """
    ratios = bucket_ratios(docs, labels, buckets, sample)
    names = [c.split()[0] for c in SCORES.split(", ")]
    keep = tuple(c for c in keep if c not in names)
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + [SCORES])
    read = list(dict.fromkeys([*keep, "text"]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cell in batch.column("text"):
                text = cell.as_py() or ""
                words = words_of(text)
                n, repeated = len(words), repeated_words(words)
                failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
                llr = float(ratios[hashed_ngrams(words, buckets)].mean()) if n else 0.0
                rows.append((
                    n, len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeated,
                    failed, not failed and llr >= threshold, llr,
                ))
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[*keep, *names]
            )

    return docs.select(*[F.col(f"`{c}`") for c in read]).mapInArrow(judge, schema)
