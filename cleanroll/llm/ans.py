"""Token ids in files: a static range asymmetric numeral system over interleaved lanes, in independent blocks."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from cleanroll.llm.tokens import encoder, release
from cleanroll.session import scratch_root, stage

SCALE = 20  # a table's frequencies add up to 2 ** SCALE
LANES = 512
BLOCK_TOKENS = 1 << 17
CHECKPOINT_STEPS = 128
FILES_GB = 0.25  # GB of ids a file stands for, about
ROW_GROUP = 8 << 20  # bytes of blocks that a reader may take apart from the rest of a file
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
MAGIC = b"ANS1"
HEADER = struct.Struct("<4sIIII")  # magic, tokens, lanes, checkpoints, crc32 of the ids as 32-bit numbers


class Table:
    """Frequencies of ids, shared by all blocks; ids that do not occur have none."""

    def __init__(self, counts: np.ndarray):
        seen = np.flatnonzero(counts)
        freq = np.zeros(len(counts), dtype=np.int64)
        if len(seen):
            freq[seen] = np.maximum(1, counts[seen] * float(1 << SCALE) / counts.sum()).astype(np.int64)
            order = seen[np.argsort(-freq[seen], kind="stable")]
            excess = int(freq.sum()) - (1 << SCALE)
            k = 0
            while excess:  # the frequent ids give or take what rounding left over
                step = max(-(-abs(excess) // len(order)), 1) * (1 if excess > 0 else -1)
                here = min(step, excess, int(freq[order[k]]) - 1) if excess > 0 else max(step, excess)
                freq[order[k]] -= here
                excess -= here
                k = (k + 1) % len(order)
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.uint16 if len(counts) <= 1 << 16 else np.uint32), freq)


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES) -> bytes:
    """One block: header, states of all lanes at each checkpoint with the words read by then, the words.

    Token k belongs to lane k mod `lanes`. Lanes are encoded from the last step to the first, so that decoding runs
    forward; a lane whose state would overflow first gives off its low 32 bits.
    """
    n = len(ids)
    steps = -(-n // lanes)
    x = np.full(lanes, LOW, dtype=np.uint64)
    freq, start = table.freq[ids], table.start[ids]
    limit = freq << np.uint64(63 - SCALE)
    whole = np.uint64(1 << SCALE)
    words: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    written = 0
    for step in range(steps - 1, -1, -1):
        lo, hi = step * lanes, min(n, (step + 1) * lanes)
        part = x[: hi - lo]
        full = (part >= limit[lo:hi]).nonzero()[0]
        if len(full):
            over = part[full]
            words.append(over.astype("<u4"))
            written += len(full)
            part[full] = over >> WORD
        f = freq[lo:hi]
        q = part // f
        # (q << SCALE) + part - q * f + start
        part += start[lo:hi]
        f = whole - f
        f *= q
        part += f
        if step % CHECKPOINT_STEPS == 0:
            marks.append((written, x.copy()))
    marks = marks[::-1] or [(0, x)]
    head = HEADER.pack(MAGIC, n, lanes, len(marks), zlib.crc32(ids.astype("<u4").tobytes()))
    states = b"".join(struct.pack("<I", written - at) + s.astype("<u8").tobytes() for at, s in marks)
    return head + states + b"".join(w.tobytes() for w in reversed(words))


def decode_block(raw: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids from checkpoint `first` up to checkpoint `last` of a block, the whole block by default.

    A whole block ends in the states that encoding began with, and is held against its checksum: ValueError where not.
    """
    magic, n, lanes, marks, crc = HEADER.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a block")
    size = 4 + 8 * lanes
    words = np.frombuffer(raw, dtype="<u4", offset=HEADER.size + marks * size)
    begin = HEADER.size + first * size
    at = struct.unpack_from("<I", raw, begin)[0]
    x = np.frombuffer(raw, dtype="<u8", count=lanes, offset=begin + 4).astype(np.uint64)
    low, high = first * CHECKPOINT_STEPS, min(-(-n // lanes), (marks if last is None else last) * CHECKPOINT_STEPS)
    out = np.empty(max(0, min(n, high * lanes) - low * lanes), dtype=np.uint32)
    mask, scale = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    for step in range(low, high):
        width = min(n - step * lanes, lanes)
        part = x[:width]
        slot = part & mask
        ids = table.symbol.take(slot.view(np.int64)).astype(np.intp)
        part >>= scale
        part *= table.freq.take(ids)
        slot -= table.start.take(ids)
        part += slot
        below = (part < LOW).nonzero()[0]
        k = len(below)
        if k:
            part[below] = (part[below] << WORD) | words[at : at + k]
            at += k
        out[(step - low) * lanes : (step - low) * lanes + width] = ids
    if first == 0 and last is None and ((x != LOW).any() or zlib.crc32(out.astype("<u4").tobytes()) != crc):
        raise ValueError("a block does not match its checksum")
    return out


def document_ids(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """`doc_id, n_tokens, ids` (little-endian, 16 or 32 bits) of every whole text and its end id."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = encoder(tokenizer)
        end = np.array([end_id], dtype=source.type).tobytes()
        for batch in batches:
            found = [ids.tobytes() + end for ids in source.encode(x.as_py() for x in batch.column("text"))]
            sizes = [len(x) // source.type.itemsize for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "n_tokens", "ids"]
            )

    return docs.select("doc_id", "text").mapInArrow(tokenize, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary")


def _ids(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * n else "<u4")


def id_counts(tokenized: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents; a task sends a row per id, the driver gets one per id of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        total = np.zeros(0, dtype=np.int64)

        def add(held: list[np.ndarray]) -> np.ndarray:
            found = np.bincount(np.concatenate(held), minlength=len(total))
            found[: len(total)] += total
            return found

        held: list[np.ndarray] = []  # of some documents: a count is as long as the vocabulary
        tokens = 0
        for batch in batches:
            for raw, n in zip(batch.column("ids"), batch.column("n_tokens"), strict=True):
                held.append(_ids(raw.as_py(), n.as_py()))
                tokens += len(held[-1])
                if tokens >= BLOCK_TOKENS:
                    total, held, tokens = add(held), [], 0
        if held:
            total = add(held)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    rows = tokenized.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(max((r.id for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """The ids of `docs` at `path`: `table` has the counts of all ids, `blocks` a row per block.

    Blocks hold whole documents, in ascending doc_id (null first, ties by their ids) within a shard and from shard to
    shard; one of `BLOCK_TOKENS` or more ends with the document that fills it. A block has its shard and number, its documents' ids and
    lengths, the tokens before it in its shard, and its bytes. A null or empty text is its end id alone. Repeated rows are written
    each; an empty table has no block.
    """
    spark = docs.sparkSession
    tokenized = stage(document_ids(docs, tokenizer, end_id), "ids")
    counts = id_counts(tokenized)
    spark.createDataFrame([(i, int(counts[i])) for i in np.flatnonzero(counts).tolist()], "id int, n long").coalesce(1).write.parquet(f"{path}/table")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"shard int, block int, doc_ids array<{kind}>, lengths array<bigint>, start long, n_tokens long, payload binary"
    files = max(1, round(2 * float(counts.sum()) / (FILES_GB * 1e9)), spark.sparkContext.defaultParallelism)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        table = Table(counts)
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        names: list = []
        held: list[np.ndarray] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held)
            columns = [[shard], [block], [names], [[len(x) for x in held]], [start], [len(ids)], [encode_block(ids, table)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=fields)

        types = None
        fields = ["shard", "block", "doc_ids", "lengths", "start", "n_tokens", "payload"]
        for batch in batches:
            types = [pa.int32(), pa.int32(), pa.list_(batch.schema.field("doc_id").type), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary()]
            for doc_id, n, raw in zip(*[batch.column(c) for c in ("doc_id", "n_tokens", "ids")], strict=True):
                names.append(doc_id.as_py())
                held.append(_ids(raw.as_py(), n.as_py()))
                tokens += n.as_py()
                if tokens >= BLOCK_TOKENS:
                    yield flush()
                    block, start, names, held, tokens = block + 1, start + tokens, [], [], 0
        if held:
            yield flush()

    ordered = tokenized.repartitionByRange(files, "doc_id", F.xxhash64("ids")).sortWithinPartitions("doc_id", F.xxhash64("ids"))
    # Small row groups: a writer holds one in memory, and a file is read by several tasks, each with a few blocks at a time.
    ordered.mapInArrow(write, schema).write.option("parquet.block.size", ROW_GROUP).parquet(f"{path}/blocks")


def read_ids(spark, path: str, ids: bool = False) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` (and `ids`, little-endian 32-bit) per document, decoded block by block.

    start is the number of ids before the document in all shards; one row a shard is summed for it.
    """
    rows = spark.read.parquet(f"{path}/table").collect()  # one row an id of the vocabulary at most
    counts = np.zeros(max((r.id for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        counts[r.id] = r.n
    blocks = spark.read.parquet(f"{path}/blocks")
    sums = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        table = Table(counts)
        for batch in batches:
            for row in range(batch.num_rows):
                found = decode_block(batch.column("payload")[row].as_py(), table).astype("<u4")
                lengths = np.array(batch.column("lengths")[row].as_py(), dtype=np.int64)
                ends = np.cumsum(lengths)
                raws = [found[e - n : e].tobytes() for e, n in zip(ends, lengths, strict=True)]
                starts = batch.column("first")[row].as_py() + batch.column("start")[row].as_py() + ends - lengths
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[row].values, pa.array(starts), pa.array(lengths), pa.array([zlib.crc32(r) for r in raws], pa.int64())]
                    + [pa.array(raws, pa.binary())] * ids,
                    names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * ids,
                )

    return blocks.join(F.broadcast(shards), "shard").select("first", "doc_ids", "lengths", "start", "payload").mapInArrow(read, schema)


def stored(docs: DataFrame, tokenizer: str, end_id: int = 1, ids: bool = False) -> DataFrame:
    """`docs` written in the shared folder and read back."""
    spark = docs.sparkSession
    path = f"{scratch_root(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(docs, path, tokenizer, end_id)
    return read_ids(spark, path, ids)
