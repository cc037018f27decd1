"""Nearest vectors by inner product: randomly rotated one-bit codes, error bounds, exact scores of what they leave."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cleanroll.session import stage

K = 20
EPSILON = 3.0  # standard errors between an estimate and its bound
SEED = 7
CODE_ROWS = 8192  # vectors of a block
QUERY_ROWS = 1024  # queries of a block
QUERY_BITS = 4
QUERIES_AT_ONCE = 128  # whose sums over a block's codes are held together


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for all tasks."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def padded(d: int) -> int:
    return -(-d // 64) * 64


def coded(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated vectors, their norms, and the inner product of each unit vector with its code."""
    d = len(turn)
    wide = np.zeros((len(vectors), d))
    wide[:, : vectors.shape[1]] = vectors
    norm = np.sqrt((wide**2).sum(axis=1))
    turned = wide @ turn / norm[:, None]
    bits = np.packbits(turned > 0, axis=1, bitorder="little")
    return bits, norm, np.abs(turned).sum(axis=1) / math.sqrt(d)


def planes(query: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """The rotated query in `QUERY_BITS` bits a component: bit planes, least value, step, and sum of the components."""
    wide = np.zeros(len(turn))
    wide[: len(query)] = query
    turned = wide @ turn
    low, high = turned.min(), turned.max()
    step = (high - low) / ((1 << QUERY_BITS) - 1) or 1.0
    whole = np.rint((turned - low) / step).astype(np.uint8)
    bits = np.stack([np.packbits((whole >> b) & 1, bitorder="little") for b in range(QUERY_BITS)]).view(np.uint64)
    return bits, low, step, low * len(turn) + step * float(whole.sum())


def unpacked(codes: np.ndarray) -> np.ndarray:
    """The bits of packed codes as 0.0 or 1.0."""
    return np.unpackbits(codes.view(np.uint8), axis=1, bitorder="little").astype(np.float32)


def sums_inside(bits: np.ndarray, queries: list[tuple]) -> np.ndarray:
    """Per query (its `planes`) and code, the sum of the quantised components where the code's bit is set.

    A product of matrices instead of a count of bits for each pair and plane; sums are whole numbers far below 2 ** 24, so
    they are the same.
    """
    whole = sum((1 << b) * unpacked(np.stack([q[0][b] for q in queries])) for b in range(QUERY_BITS))
    return whole @ bits.T


def estimates(codes: np.ndarray, ones: np.ndarray, norm: np.ndarray, factor: np.ndarray, query: np.ndarray, turn: np.ndarray, epsilon: float = EPSILON, plane: tuple | None = None, inside: np.ndarray | None = None):
    """Estimated inner products of all codes with a query, and how far the true ones may be off.

    The code's corners are +-1/sqrt(d), so its product with the quantised query is twice the sum over set bits less the
    sum over all. Dividing by the code's product with its own vector makes the estimate unbiased; what is left is the part
    of the vector across its code, of random direction. `plane` and `inside`, if the caller has them for many queries, are
    the query's `planes` and its row of `sums_inside`.
    """
    d = len(turn)
    _, low, step, total = plane = plane or planes(query, turn)
    inside = (sums_inside(unpacked(codes), [plane])[0] if inside is None else inside).astype(np.float64)
    dot = (2.0 * (low * ones + step * inside) - total) / math.sqrt(d)
    size = float(np.sqrt((query**2).sum()))
    across = np.sqrt(np.maximum(0.0, 1.0 - factor**2)) / factor * epsilon / math.sqrt(max(1, d - 1))
    rounding = step / 2 * epsilon / math.sqrt(3.0) / factor
    return norm * dot / factor, norm * (size * across + rounding)


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed from the first component to the last."""
    return np.cumsum(vectors * query, axis=1)[:, -1]


def best_of_block(query_id: int, query: np.ndarray, ids: np.ndarray, vectors: np.ndarray, codes, ones, norm, factor, turn, k: int, plane: tuple | None = None, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of a block's `k` best. The k best estimates are scored first; then all whose bound reaches the k-th score.

    Of those, a plain product in doubles leaves the ones that reach the k-th of its values but for rounding: they are summed in order.
    """
    other = ids != query_id
    guess, off = estimates(codes, ones, norm, factor, query, turn, plane=plane, inside=inside)
    guess = np.where(other, guess, -np.inf)
    if len(ids) > k:
        first = np.argpartition(-guess, k - 1)[:k]
        first = first[other[first]]
        floor = exact(vectors[first], query).min() if len(first) == k else -np.inf
        reaches = (guess + off >= floor) & other
        reaches[first] = True
        chosen = np.flatnonzero(reaches)
    else:
        chosen = np.flatnonzero(other)
    if len(chosen) > k:
        with np.errstate(over="ignore", invalid="ignore"):
            # Rows are picked out where that is less work than the product.
            rough = vectors[chosen] @ query if 8 * len(chosen) < len(ids) else (vectors @ query)[chosen]
            slack = 4 * len(query) * np.finfo(np.float64).eps * norm[chosen].max() * float(np.sqrt((query**2).sum()))
            if np.isfinite(rough).all() and np.isfinite(slack):
                chosen = chosen[rough >= np.partition(rough, -k)[-k] - slack]
    score = exact(vectors[chosen], query)
    order = np.lexsort((ids[chosen], -score))[:k]
    return ids[chosen][order], score[order]


def index(vectors: DataFrame, seed: int = SEED) -> DataFrame:
    """`vec_id, vector, code, norm, factor` of every row that takes part: id not null, and the vector neither null, empty,
    zero, nor with a null or non-finite component, nor of another length than most. `vector` holds doubles."""
    value = F.transform("embedding", lambda x: x.cast("double"))
    sound = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("v"))
    sound = sound.where((F.size("v") > 0) & F.forall("v", lambda x: F.coalesce((x * 0.0) == 0.0, F.lit(False))) & F.exists("v", lambda x: x != 0.0))
    common = sound.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = common.d if common else 1

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(padded(d), seed)
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)
            bits, norm, factor = coded(flat, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([x.tobytes() for x in flat], pa.binary()), pa.array([x.tobytes() for x in bits], pa.binary()), pa.array(norm), pa.array(factor)],
                names=["vec_id", "vector", "code", "norm", "factor"],
            )

    return sound.where(F.size("v") == d).mapInArrow(code, "vec_id long, vector binary, code binary, norm double, factor double")


def search(indexed: DataFrame, queries: DataFrame, k: int = K, seed: int = SEED, code_rows: int = CODE_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """`query_id, rank, vec_id, score`: each query's `k` nearest rows of `indexed`, its own id left out.

    `queries` are rows of an index too. Both are dealt by hash into blocks of bounded size, and each query block meets each code block in
    one cell: a cell's memory does not grow with the tables. A cell scores only what the bounds leave and hands on `k` rows a
    query. Ties go to the smaller vec_id; candidates that repeat an id are returned each; a query's id counts once.
    """
    queries = queries.dropDuplicates(["vec_id"])
    code_blocks = max(1, math.ceil(indexed.count() / code_rows))
    query_blocks = max(1, math.ceil(queries.count() / query_rows))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("j"), each(code_blocks).alias("i"))
    right = indexed.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(code_blocks)).cast("int").alias("i"), each(query_blocks).alias("j"))

    def cell(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if len(asked) and len(block):
            vectors = np.frombuffer(b"".join(block["vector"]), dtype=np.float64).reshape(len(block), -1)
            turn = rotation(padded(vectors.shape[1]), seed)
            codes = np.frombuffer(b"".join(block["code"]), dtype=np.uint64).reshape(len(block), -1)
            ones = np.bitwise_count(codes).sum(axis=1).astype(np.float64)
            ids, norm, factor = (block[c].to_numpy() for c in ("vec_id", "norm", "factor"))
            bits, names = unpacked(codes), asked["vec_id"].to_numpy()
            for first in range(0, len(asked), QUERIES_AT_ONCE):
                some = [np.frombuffer(raw, dtype=np.float64) for raw in asked["vector"].iloc[first : first + QUERIES_AT_ONCE]]
                cut = [planes(query, turn) for query in some]
                for query_id, query, plane, inside in zip(names[first : first + len(some)], some, cut, sums_inside(bits, cut), strict=True):
                    found, score = best_of_block(query_id, query, ids, vectors, codes, ones, norm, factor, turn, k, plane, inside)
                    out.append((np.full(len(found), query_id), found, score))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    met = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(cell, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """Each `every`-th id's nearest rows. The index covers every row and is staged."""
    indexed = stage(index(vectors), "codes")
    return search(indexed, indexed.where(F.col("vec_id") % every == 0).select("vec_id", "vector"), k)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM s) WHERE rank <= 20
"""
