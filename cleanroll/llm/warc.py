"""WARC archives: records with segments and chunked payloads, written and read back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from cleanroll.session import scratch_root, stage

SEGMENT = 16 * 1024  # most bytes of a record's block; longer ones continue in further records
CHUNK = 4096
RECORDS_A_FILE = 1024  # so a file has 17 MB at most
BATCH = 16 << 20  # bytes of blocks that a reading task hands on at once
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"
LEAST_EQUAL = 0


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The payload of chunked transfer framing; ValueError where it is cut short or damaged."""
    out, at = [], 0
    while True:
        line = framed.find(b"\r\n", at)
        if line < 0:
            raise ValueError("a chunk has no size line")
        size = int(framed[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        if framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(framed[at : at + size])
        at += size + 2


def record(fields: dict[str, str], block: bytes) -> bytes:
    """A record without the two line ends that follow it."""
    head = "".join(f"{k}: {v}\r\n" for k, v in {**fields, "Content-Length": str(len(block))}.items())
    return b"WARC/1.1\r\n" + head.encode("utf-8") + b"\r\n" + block


def records_of(page_id, url: str | None, payload: bytes, digest: str, first, unique: str) -> Iterator[bytes]:
    """The records of one page: a revisit without a payload, or a response and its continuations.

    `first` is the page_id of the response that a revisit refers to, None for a response.
    """
    origin = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, unique)}>"
    fields = {
        "WARC-Type": "response" if first is None else "revisit", "WARC-Record-ID": origin, "WARC-Date": DATE,
        "WARC-Target-URI": "".join((url or "").split()), "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response",
        **({} if page_id is None else {"X-Page-ID": str(page_id)}),
    }
    if first is not None:
        fields |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To-Date": DATE, "X-Refers-To-Page-ID": str(first),
        }
        yield record(fields, b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload))
        return
    whole = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [whole[i : i + SEGMENT] for i in range(0, len(whole), SEGMENT)]
    if len(parts) == 1:
        yield record(fields, whole)
        return
    yield record(fields | {"WARC-Segment-Number": "1"}, parts[0])
    for n, part in enumerate(parts[1:], 2):
        last = {"WARC-Segment-Total-Length": str(len(whole))} if n == len(parts) else {}
        yield record({
            "WARC-Type": "continuation", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{unique}/{n}')}>", "WARC-Date": DATE,
            "WARC-Target-URI": fields["WARC-Target-URI"], "WARC-Segment-Number": str(n), "WARC-Segment-Origin-ID": origin, **last,
        }, part)


def with_first(pages: DataFrame, least: int = LEAST_EQUAL) -> DataFrame:
    """`page_id, url, payload, first`: the greatest page_id of the pages with an equal payload, null for that page itself.

    Payloads under `least` bytes, and pages of an equal payload that tie in page_id, have no `first`.
    """
    payload = F.coalesce(F.encode(F.col("html"), "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    firsts = stage(rows.groupBy("sha").agg(F.max("page_id").alias("top")), "firsts")  # written: Spark may then split a hot digest
    other = (F.octet_length("payload") >= least) & F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return rows.join(firsts, "sha").select("page_id", "url", "payload", F.when(other, F.col("top")).alias("first"))


def write_archive(pages: DataFrame, path: str, least: int = LEAST_EQUAL) -> None:
    """Gzipped WARC files of `pages` (page_id, url, html) at `path`, a record per page and its continuations.

    Spark's text writer puts each record's bytes with the two line ends of the format behind it. Nulls: a null html is an
    empty payload, a null url an empty target, a null page_id has no X-Page-ID. Repeated rows get records of their own.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out: list[bytes] = []
            for page_id, url, payload, first in zip(*[batch.column(c) for c in ("page_id", "url", "payload", "first")], strict=True):
                raw, n = payload.as_py(), n + 1
                out += records_of(page_id.as_py(), url.as_py(), raw, digest_of(raw), first.as_py(), f"{task}/{n}/{page_id.as_py()}")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    records = with_first(pages, least).mapInArrow(write, StructType([StructField("record", BinaryType())]))
    lines = records.select(F.col("record").cast("string").alias("value"))
    lines.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_A_FILE).text(path)


def parsed(archive: bytes | BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive, read one at a time; blocks are taken by their length."""
    file = io.BytesIO(archive) if isinstance(archive, bytes) else archive
    while line := file.readline():
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no record starts with {line[:40]!r}")
        fields = {}
        while (line := file.readline()) != b"\r\n":
            if not line.endswith(b"\r\n"):
                raise ValueError("a record is cut short")
            name, _, value = line.decode("utf-8")[:-2].partition(":")
            fields[name] = value.strip(" ")
        size = int(fields["Content-Length"])
        block = file.read(size)
        if len(block) < size or file.read(len(END)) != END:
            raise ValueError("a record is cut short")
        yield fields, block


RECORD = "origin string, segment int, total long, type string, page_id long, refers_to long, digest string, uri string, block binary"


def read_records(spark, path: str) -> DataFrame:
    """One row per record of the archive, whether a file is one gzip member or has one for each record.

    A file is held compressed and read record by record, in batches of `BATCH` bytes. A damaged record, or a file that
    is cut short, is an error in the task.
    """
    number = lambda fields, name: int(fields[name]) if name in fields else None
    schema = pa.schema([
        ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("type", pa.string()), ("page_id", pa.int64()),
        ("refers_to", pa.int64()), ("digest", pa.string()), ("uri", pa.string()), ("block", pa.binary()),
    ])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for content in batch.column("content"):
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_py())) as file:
                    for f, block in parsed(file):
                        rows.append({
                            "origin": f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"]), "segment": number(f, "WARC-Segment-Number"),
                            "total": number(f, "WARC-Segment-Total-Length"), "type": f["WARC-Type"], "page_id": number(f, "X-Page-ID"),
                            "refers_to": number(f, "X-Refers-To-Page-ID"), "digest": f.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
                            "uri": f.get("WARC-Target-URI"), "block": block,
                        })
                        held += len(block)
                        if held >= BATCH:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(split, RECORD)


def reassembled(records: DataFrame) -> DataFrame:
    """A row per page with its whole `block`: continuations are grouped by their origin and put in order of their number.

    Only segmented records are shuffled; a group is one page. ValueError (in the task) where the segments are not 1 to n
    or their bytes are not the stated total.
    """
    whole = records.where("segment is null")
    parts = records.where("segment is not null").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"),
        *[F.max_by(c, -F.col("segment")).alias(c) for c in ("type", "page_id", "refers_to", "digest", "uri")],
    )
    block = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["block"]))
    numbers = F.transform("parts", lambda x: x["segment"])
    joined = parts.withColumn("block", block)
    right = (numbers == F.sequence(F.lit(1), F.size("parts"))) & F.col("total").eqNullSafe(F.octet_length("block").cast("long"))
    checked = F.when(right, F.col("block")).otherwise(F.raise_error(F.concat(F.lit("segments are missing or too short: "), "origin")).cast("binary"))
    names = ["type", "page_id", "refers_to", "digest", "uri", "block"]
    return whole.select(*names).unionByName(joined.withColumn("block", checked).select(*names))


def read_archive(spark, path: str, payloads: bool = True) -> DataFrame:
    """`page_id, uri, payload_bytes, payload_digest, record_type, refers_to` (and `payload`; null for a revisit).

    A response's chunks are decoded, and its digest is made of what they hold and compared with the record's. A revisit has
    its digest and length in its headers.
    """
    ddl = "page_id long, uri string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, found = [], [], []
            for block, kind, digest in zip(batch.column("block"), batch.column("type"), batch.column("digest"), strict=True):
                head, _, body = block.as_py().partition(END)
                http = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
                if kind.as_py() == "revisit":
                    sizes.append(int(http[b"Content-Length"]))
                    digests.append(digest.as_py())
                    found.append(None)
                    continue
                payload = unchunked(body) if http.get(b"Transfer-Encoding") == b"chunked" else body
                if digest_of(payload) != digest.as_py():
                    raise ValueError("a payload does not match its digest")
                sizes.append(len(payload))
                digests.append(digest_of(payload))
                found.append(payload)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("uri"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), batch.column("type"), batch.column("refers_to")]
                + [pa.array(found, pa.binary())] * payloads,
                names=["page_id", "uri", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads,
            )

    return reassembled(read_records(spark, path)).mapInArrow(decode, ddl)


def archived(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """`pages` written to an archive in the shared folder and read back. An empty table gives no row."""
    spark = pages.sparkSession
    path = f"{scratch_root(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, path)
    return read_archive(spark, path, payloads)


# Fixed value: SHA-1 in base32 has no function in SQL, so the digest is made of its hex digits, 4 bits each, 5 at a time.
ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
s AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS h FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM s),
b AS (SELECT *, list_aggregate(list_transform(range(0, 40), lambda i: (((strpos('0123456789abcdef', h[i + 1]) - 1)::BIGINT)::BIT::VARCHAR)[-4:]), 'string_agg', '') AS bits FROM r)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
    1 + 16 * bits[5 * k + 1]::INT + 8 * bits[5 * k + 2]::INT + 4 * bits[5 * k + 3]::INT + 2 * bits[5 * k + 4]::INT + bits[5 * k + 5]::INT]), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to FROM b
"""
