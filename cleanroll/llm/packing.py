"""Best-fit packing with a fixed number of open sequences."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from cleanroll.llm.tokens import encoder
from cleanroll.session import stage

SIZE = 2048
OPEN_BINS = 4096
PIECES_A_TASK = 100_000
TASK_BITS = 40


class OpenBins:
    """Bounded-space online best fit.

    A bit per free space says whether an open sequence has exactly that much left; the lowest bit at or above a piece's
    length is the best fit. With all `limit` sequences open and none fitting, the fullest one closes for a new one.
    """

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.bits = self.open = self.made = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        found = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.open -= 1
        return found

    def _put(self, which: int, free: int) -> None:
        self.by_free[free].append(which)
        self.bits |= 1 << free
        self.open += 1

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece of 1 to `size` tokens."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            which = self._take(free)
        else:
            free = self.size
            which = self.made
            self.made += 1
            if length < self.size and self.open == self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
        if free > length:
            self._put(which, free - length)
        return which, self.size - free


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = SIZE, ids: bool = False) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32` (and `ids`, little-endian 32-bit, if asked for) of every whole text.

    A document is its ids and `end_id`. Only one over `size` is cut: its first piece takes the remainder, so all its
    other pieces fill a sequence. A null or empty text is its end id alone. Repeated rows give repeated pieces; a null
    doc_id stays null; further columns are ignored.
    """
    fields = [
        docs.schema["doc_id"], StructField("piece", IntegerType()), StructField("start", LongType()),
        StructField("length", LongType()), StructField("ids_crc32", LongType()),
    ] + [StructField("ids", BinaryType())] * ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            rows: list[tuple] = []
            for row, found in enumerate(encode(x.as_py() for x in batch.column("text"))):
                whole = np.append(found.astype("<u4"), np.uint32(end_id)).astype("<u4")
                begin = 0
                for piece in range(math.ceil(len(whole) / size)):
                    end = begin + (len(whole) - 1) % size + 1 if piece == 0 else begin + size
                    raw = whole[begin:end].tobytes()
                    rows.append((row, piece, begin, end - begin, zlib.crc32(raw), *([raw] if ids else [])))
                    begin = end
            columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32())]
                + [pa.array(c, pa.int64()) for c in columns[2:5]] + [pa.array(c, pa.binary()) for c in columns[5:]],
                names=[f.name for f in fields],
            )

    return docs.select("doc_id", "text").mapInArrow(cut, StructType(fields))


def pack(pieces: DataFrame, size: int = SIZE, open_bins: int = OPEN_BINS, pieces_a_task: int = PIECES_A_TASK) -> DataFrame:
    """`pieces` (with `doc_id, piece, length, ids_crc32`, and whatever else) plus `sequence_id` and `offset`.

    Pieces are dealt evenly by hash and packed in hash order, a fixed order that mixes long and short ones, so a task
    packs the same way when it is run again. Each task keeps at most `open_bins` sequences open; at its end they are
    closed as they are. An empty table packs into no sequence. Rows that are equal in all columns are packed each.
    """
    tasks = max(1, math.ceil(pieces.count() / pieces_a_task))
    key = ["doc_id", "piece", "length", "ids_crc32"]
    dealt = pieces.repartition(tasks, *key).sortWithinPartitions(F.xxhash64(*key), *key)
    schema = StructType(pieces.schema.fields + [StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(size, open_bins)
        first = TaskContext.get().partitionId() << TASK_BITS
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([first + s for s, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                names=schema.names,
            )

    return dealt.mapInArrow(fill, schema)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = SIZE, ids: bool = False) -> DataFrame:
    """Every document's pieces with their places. The pieces are staged, so texts are read and encoded once."""
    return pack(stage(token_pieces(docs, tokenizer, end_id, size, ids), "pieces"), size)


def sequences(packed: DataFrame) -> DataFrame:
    """`sequence_id, n_tokens, ids` (little-endian 32-bit) of pieces packed with their ids; a group is one sequence."""
    part = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(part, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
