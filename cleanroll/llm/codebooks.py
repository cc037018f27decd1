"""Vector codes by k-means codebooks with Drake-Hamerly adaptive bounds: exact integer assignments, few distances."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cleanroll.session import Stages, stage

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BOUNDS = 32  # entries whose lower bounds a part keeps at first
LEAST_BOUNDS = 4
REACHED = 0.98  # share of the looked-up parts that the next round's bounds should be enough for
SLACK = 1e-9
FIXED = "vec_id long, label {label}, x binary"
STATE = f"{FIXED}, code binary, upper binary, near binary, lower binary, outer binary, used binary, error long"


def sound(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: F.coalesce((x.cast("double") * 0.0) == 0.0, F.lit(False))), F.lit(False))


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all `x` to all `entries`: sums of integers below 2^53, so exact in doubles."""
    return (x**2).sum(axis=1)[:, None] + (entries**2).sum(axis=1)[None, :] - 2.0 * (x @ entries.T)


def largest(width: int) -> int:
    """The largest component, in absolute value, whose squared distances in `width` dimensions stay below 2^53."""
    return int((2.0**51 / max(1, width)) ** 0.5)


class Bounds:
    """One part of a batch of vectors: its entry, an upper bound of the distance to it, the closest other entries with
    ordered lower bounds, and one bound below the distance to all the rest."""

    def __init__(self, code: np.ndarray, upper: np.ndarray, near: np.ndarray, lower: np.ndarray, outer: np.ndarray):
        self.code, self.upper, self.near, self.lower, self.outer = code, upper, near, lower, outer

    @classmethod
    def searched(cls, x: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
        """Bounds from the distances to all entries; of equally close entries the lower index is taken."""
        exact = distances(x, entries)
        rows, b = np.arange(len(x)), min(b, len(entries) - 1)
        code = exact.argmin(axis=1)
        upper = np.sqrt(exact[rows, code])
        exact[rows, code] = np.inf
        near = np.argpartition(exact, b, axis=1)[:, : b + 1] if b + 1 < len(entries) else np.tile(np.arange(len(entries)), (len(x), 1))
        ranked = np.take_along_axis(exact, near, axis=1)
        order = np.argsort(ranked, axis=1)
        near, ranked = np.take_along_axis(near, order, axis=1), np.sqrt(np.take_along_axis(ranked, order, axis=1))
        return cls(code.astype(np.uint8), upper, near[:, :b].astype(np.uint8), ranked[:, :b].copy(), ranked[:, b])

    def moved(self, drift: np.ndarray) -> None:
        """Widen the bounds by how far the entries moved."""
        self.upper = self.upper + drift[self.code]
        self.lower = self.lower - drift[self.near]
        self.outer = self.outer - drift.max()

    def narrowed(self, b: int) -> None:
        """Keep `b` entries; the bounds of the others join the outer one."""
        if b < self.near.shape[1]:
            self.outer = np.minimum(self.outer, self.lower[:, b:].min(axis=1))
            self.near, self.lower = self.near[:, :b], self.lower[:, :b]

    def _needed(self, rows: np.ndarray) -> np.ndarray:
        """How many of the near entries may be as close as the upper bound: 0 is none; one more than all is the rest too."""
        all_bounds = np.concatenate([self.lower[rows], self.outer[rows, None]], axis=1)
        below = np.minimum.accumulate(all_bounds[:, ::-1], axis=1)[:, ::-1]  # of this entry and all after it
        reach = self.upper[rows] * (1 + SLACK) + SLACK
        return (below <= reach[:, None]).sum(axis=1)

    def assign(self, x: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Assign again and return how many near entries each part looked at.

        Parts that the bounds leave uncertain get the exact distance to their own entry; if that is not enough, to the
        entries up to the first bound that exceeds it; and to all entries if no bound does.
        """
        used = np.zeros(len(x), dtype=np.int64)
        rows = np.flatnonzero(self._needed(np.arange(len(x))))
        if not len(rows):
            return used
        own = ((x[rows] - entries[self.code[rows]]) ** 2).sum(axis=1)
        self.upper[rows] = np.sqrt(own)
        need = self._needed(rows)
        used[rows] = need
        b = self.near.shape[1]
        start = 0
        for top in [*(1 << i for i in range(b.bit_length()) if 1 << i < b), b]:
            here = (need > start) & (need <= top)
            start = top
            if here.any():
                self._verify(x, entries, rows[here], own[here], top)
        rest = rows[need > b]
        if len(rest):
            fresh = Bounds.searched(x[rest], entries, b)
            for name in ("code", "upper", "near", "lower", "outer"):
                getattr(self, name)[rest] = getattr(fresh, name)
        return used

    def _verify(self, x: np.ndarray, entries: np.ndarray, rows: np.ndarray, own: np.ndarray, top: int) -> None:
        """Exact distances to the first `top` near entries decide; those and the old entry are ordered anew."""
        asked = np.concatenate([self.code[rows, None], self.near[rows, :top]], axis=1)
        exact = np.concatenate([own[:, None], ((x[rows, None, :] - entries[asked[:, 1:]]) ** 2).sum(axis=2)], axis=1)
        order = np.lexsort((asked, exact), axis=1)
        asked, ranked = np.take_along_axis(asked, order, axis=1), np.sqrt(np.take_along_axis(exact, order, axis=1))
        self.code[rows], self.upper[rows] = asked[:, 0], ranked[:, 0]
        self.near[rows, :top], self.lower[rows, :top] = asked[:, 1:], ranked[:, 1:]


def integers(vectors: DataFrame) -> DataFrame:
    """`vec_id, label, x` of the rows that take part; `x` holds floor(1024 * component) as longs."""
    whole = F.transform("embedding", lambda v: F.floor(v.cast("double") * F.lit(float(SCALE))).cast("long"))
    kept = vectors.where(sound(F.col("embedding")))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), whole.alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of `d` numbers; shorter vectors end in zeros."""
    out = np.zeros((len(column), d))
    lengths = np.diff(column.offsets.to_numpy())
    out[np.arange(d)[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _blobs(values: np.ndarray) -> pa.Array:
    """One binary value a row of a two- or three-dimensional array."""
    return pa.array([row.tobytes() for row in np.ascontiguousarray(values)], pa.binary())


def _unblob(column: pa.Array, kind, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), *shape)


def _rounded(values: np.ndarray, towards: float) -> np.ndarray:
    """Bounds as 4-byte floats that stay on the safe side."""
    return np.nextafter(values.astype(np.float32), np.float32(towards))


def _state(batch: pa.RecordBatch, bounds: list[Bounds], used: np.ndarray, error: np.ndarray) -> pa.RecordBatch:
    stack = lambda name: np.stack([getattr(b, name) for b in bounds], axis=1)
    columns = [
        batch.column("vec_id"), batch.column("label"), batch.column("x"), _blobs(stack("code")),
        _blobs(_rounded(stack("upper"), np.inf)), _blobs(stack("near")), _blobs(_rounded(stack("lower"), -np.inf)),
        _blobs(_rounded(stack("outer"), -np.inf)), _blobs(used.astype(np.uint16)), pa.array(error, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "x", "code", "upper", "near", "lower", "outer", "used", "error"])


def first_assignment(packed: DataFrame, books: np.ndarray, b: int, schema: str) -> DataFrame:
    """The state of rows `vec_id, label, x` after a search among all entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _unblob(batch.column("x"), np.int32, PARTS, books.shape[2]).astype(np.float64)
                bounds = [_padded(Bounds.searched(x[:, p], books[p], b), b) for p in range(PARTS)]
                error = sum(np.rint(bound.upper**2) for bound in bounds)
                yield _state(batch, bounds, np.zeros((len(x), PARTS)), error)

    return packed.mapInArrow(run, schema)


def next_assignment(state: DataFrame, old: np.ndarray, new: np.ndarray, had: list[int], keep: list[int], schema: str) -> DataFrame:
    """The state after the entries moved from `old` to `new`; each part position keeps `keep` of `had` bounds."""
    drift = np.sqrt(((new - old) ** 2).sum(axis=2)) * (1 + SLACK)
    most = max(had)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unblob(batch.column("x"), np.int32, PARTS, new.shape[2]).astype(np.float64)
            code, upper = _unblob(batch.column("code"), np.uint8, PARTS), _unblob(batch.column("upper"), np.float32, PARTS)
            near, lower = _unblob(batch.column("near"), np.uint8, PARTS, most), _unblob(batch.column("lower"), np.float32, PARTS, most)
            outer = _unblob(batch.column("outer"), np.float32, PARTS)
            bounds, used, error = [], [], np.zeros(len(x))
            for p in range(PARTS):
                bound = Bounds(code[:, p].copy(), upper[:, p].astype(np.float64), near[:, p, : had[p]].copy(), lower[:, p, : had[p]].astype(np.float64), outer[:, p].astype(np.float64))
                bound.narrowed(keep[p])
                bound.moved(drift[p])
                used.append(bound.assign(x[:, p], new[p]))
                error += ((x[:, p] - new[p][bound.code]) ** 2).sum(axis=1)
                bounds.append(_padded(bound, max(keep)))
            yield _state(batch, bounds, np.stack(used, axis=1), error)

    return state.mapInArrow(run, schema)


def _padded(bound: Bounds, b: int) -> Bounds:
    """`bound` with room for `b` entries; what is added is out of reach."""
    more = ((0, 0), (0, b - bound.near.shape[1]))
    return Bounds(bound.code, bound.upper, np.pad(bound.near, more), np.pad(bound.lower, more, constant_values=np.inf), bound.outer)


def statistics(state: DataFrame, width: int) -> DataFrame:
    """`part, entry, place, total`: per entry the sums of its parts' components and, at place -1, their count; per number of
    near entries that parts looked at, their count (place -2, `entry` is the number). Summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, ENTRIES, width + 1), dtype=np.int64)
        looked = np.zeros((PARTS, ENTRIES + 1), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unblob(batch.column("x"), np.int32, PARTS, width)
            code, used = _unblob(batch.column("code"), np.uint8, PARTS), _unblob(batch.column("used"), np.uint16, PARTS)
            for p in range(PARTS):
                np.add.at(sums[p, :, 1:], code[:, p], x[:, p])
                sums[p, :, 0] += np.bincount(code[:, p], minlength=ENTRIES)
                looked[p] += np.bincount(used[:, p], minlength=ENTRIES + 1)
        part, entry = np.nonzero(sums[:, :, 0])
        filled = sums[part, entry]
        seen_part, seen = np.nonzero(looked)
        places = np.tile(np.arange(-1, width), len(part))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.repeat(part, width + 1), seen_part]), pa.int32()),
                pa.array(np.concatenate([np.repeat(entry, width + 1), seen]), pa.int32()),
                pa.array(np.concatenate([places, np.full(len(seen), -2)]), pa.int32()),
                pa.array(np.concatenate([filled.reshape(-1), looked[seen_part, seen]]), pa.int64()),
            ],
            names=["part", "entry", "place", "total"],
        )

    partial = state.select("x", "code", "used").mapInArrow(run, "part int, entry int, place int, total long")
    return partial.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))


def updated(books: np.ndarray, sums: list, had: list[int]) -> tuple[np.ndarray, list[int]]:
    """The next entries (means, rounded down; unused ones stay) and how many bounds each part position keeps."""
    width = books.shape[2]
    total = np.zeros((PARTS, ENTRIES, width + 1), dtype=np.int64)
    looked = np.zeros((PARTS, ENTRIES + 1), dtype=np.int64)
    for r in sums:
        if r.place == -2:
            looked[r.part, r.entry] = r.total
        else:
            total[r.part, r.entry, r.place + 1] = r.total
    new = books.copy()
    part, entry = np.nonzero(total[:, : books.shape[1], 0])
    new[part, entry] = total[part, entry, 1:] // total[part, entry, :1]
    keep = []
    for p in range(PARTS):
        share = np.cumsum(looked[p, 1:])
        enough = had[p] if not share[-1] else int(np.searchsorted(share, REACHED * share[-1])) + 1
        keep.append(max(1, min(had[p], max(LEAST_BOUNDS, enough))))
    return new, keep


def quantise(vectors: DataFrame, bounds: int = BOUNDS, rounds: int = ROUNDS) -> DataFrame:
    """`vec_id, label, code, error, label_error, codebooks_sha256` of the rows of `vectors` (`vec_id, embedding, label`).

    Rows whose vector is null or holds a null or non-finite component drop. Vectors shorter than the longest one, or
    than the next multiple of four, end in zeros. Codebooks start as the parts of the smallest 256 vec_ids (equal ids
    by their components, null ids last; all rows, if fewer) and see `rounds` rounds of assignment and update; ties go to
    the lower index. Repeated rows are rows. Null labels share one sum. Other columns are left out. An empty table gives
    an empty result; a component too large for distances below 2^53 (8,388,608 / 1024 in 16 dimensions) is an error.

    The state of each part (its entry, its closest entries with lower bounds, one outer bound) is a staged table, written
    anew in each round and deleted when the next one is there. How many bounds a part position keeps follows from how many
    the round before needed. The driver holds the codebooks and their sums alone.
    """
    spark = vectors.sparkSession
    whole = integers(vectors.select("vec_id", "embedding", "label"))
    label = whole.schema["label"].dataType.simpleString()
    result = f"vec_id long, label {label}, code string, error long, label_error long, codebooks_sha256 string"
    top = F.greatest(F.max(F.abs(F.array_max("x"))), F.max(F.abs(F.array_min("x"))))
    known = whole.agg(F.max(F.size("x")).alias("d"), top.alias("top")).first()
    if known.d is None:
        return spark.createDataFrame([], result)
    width = max(1, -(-known.d // PARTS))
    if (known.top or 0) > largest(width):
        raise ValueError(f"components up to {known.top} are too large for exact distances in {width} dimensions")
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).select("x").collect()
    start = np.zeros((len(first), PARTS * width))
    for row, entry in zip(start, first, strict=True):
        row[: len(entry.x)] = entry.x
    books = start.reshape(len(first), PARTS, width).transpose(1, 0, 2).copy()
    had = [max(1, min(bounds, len(first) - 1))] * PARTS
    schema = STATE.format(label=label)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"), PARTS * width).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _blobs(x)], names=["vec_id", "label", "x"])

    with Stages(spark) as stages:
        packed = whole.mapInArrow(pack, FIXED.format(label=label))
        state = stages.write(first_assignment(packed, books, had[0], schema), "parts")
        for _ in range(rounds):
            old = books
            books, keep = updated(old, statistics(state, width).collect(), had)
            moved = stages.write(next_assignment(state, old, books, had, keep, schema), "parts")
            stages.drop(state)
            state, had = moved, keep
        coded = stage(state.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error"), "codes")
    sums = stage(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label_errors")
    digest = hashlib.sha256(",".join(str(int(v)) for v in books.reshape(-1)).encode()).hexdigest()
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
    return joined.withColumn("codebooks_sha256", F.lit(digest)).select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")


def _oracle(rounds: int = ROUNDS) -> str:
    """The rounds as plain SQL. Sums of integers below 2^53 are exact in doubles."""
    assign = """a{r} AS (SELECT p.n, p.part, min_by(c.entry, (p.xx + c.xx - 2 * list_inner_product(p.x, c.x)) * 256 + c.entry) AS entry,
  min(p.xx + c.xx - 2 * list_inner_product(p.x, c.x)) AS dist FROM p JOIN c{r} c USING (part) GROUP BY ALL)"""
    update = """m{r} AS (SELECT part, entry, i, floor(sum(v) / count(*)) AS v FROM (
    SELECT a.part, a.entry, unnest(p.x) AS v, generate_subscripts(p.x, 1) AS i FROM a{q} a JOIN p USING (n, part)) GROUP BY ALL),
c{r} AS (SELECT part, entry, x, list_inner_product(x, x) AS xx FROM (
  SELECT c.part, c.entry, coalesce(u.x, c.x) AS x FROM c{q} c
  LEFT JOIN (SELECT part, entry, list(v ORDER BY i) AS x FROM m{r} GROUP BY ALL) u USING (part, entry)))"""
    steps = [assign.format(r=0)]
    for r in range(1, rounds + 1):
        steps += [update.format(r=r, q=r - 1), assign.format(r=r)]
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE}.0::DOUBLE * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
k AS (SELECT *, row_number() OVER (ORDER BY vec_id) AS n FROM v),
p AS (SELECT *, list_inner_product(x, x) AS xx FROM (
  SELECT n, part, x[part * len(x) // {PARTS} + 1 : (part + 1) * len(x) // {PARTS}] AS x FROM k, range({PARTS}) t(part))),
c0 AS (SELECT part, n - 1 AS entry, x, xx FROM p WHERE n <= {ENTRIES}),
{", ".join(steps)},
coded AS (SELECT n, string_agg(lower(printf('%02x', entry::INT)), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM a{rounds} GROUP BY n),
books AS (SELECT sha256(string_agg(v, ',' ORDER BY part, entry)) AS codebooks_sha256 FROM (
  SELECT part, entry, array_to_string(list_transform(x, lambda v: v::BIGINT::VARCHAR), ',') AS v FROM c{rounds}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM k JOIN coded USING (n), books
"""


ORACLE = _oracle()
