"""Hard negatives: anchors in clusters share candidate lists sorted by an angular upper bound; walks end by certificate."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cleanroll.llm.codebooks import sound
from cleanroll.session import Stages, stage

SCALE = 256
EVERY = 100  # anchors are rows whose vec_id it divides
RELABEL, LABELS = 7, 10
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
BLOCK_ROWS = 8192  # candidates of a list's block
TILE_ROWS = 8192  # anchors of a tile
CLUSTERS = 256
CLUSTER_ROWS = 64  # anchors of a cluster, on average, while there are fewer than CLUSTERS
SAMPLE = 4096  # anchors on which the clusters' centres are fitted
STEP = 512  # candidates of one step of a walk
LARGEST = 1 << 48  # scores stay below it
NONE = -(1 << 62)
CODED = "serial long, vec_id long, label long, x binary, norm double"


def rows_of(vectors: DataFrame) -> DataFrame:
    """`serial, vec_id, label, x, norm` of the rows that take part: vec_id and label not null, and a sound vector.

    `x` holds floor(256 * component) as 4-byte integers, `norm` its length; `serial` tells rows apart that repeat a vec_id.
    """
    whole = F.transform("embedding", lambda v: F.floor(v.cast("double") * F.lit(float(SCALE))).cast("double"))
    label = F.when(F.col("vec_id") % RELABEL == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    kept = vectors.where(sound(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    kept = kept.select(F.monotonically_increasing_id().alias("serial"), F.col("vec_id").cast("long"), label.cast("long").alias("label"), whole.alias("x"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("x")
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), (column.offsets.to_numpy() - column.offsets[0].as_py())
            size = np.add.reduceat(np.append(flat, 0.0) ** 2, ends[:-1]) * (np.diff(ends) > 0)
            if len(flat) and size.max() >= LARGEST:
                raise ValueError(f"vectors of length {math.sqrt(size.max()) / SCALE:.0f} are too long for exact scores")
            whole = flat.astype("<i4")
            packed = pa.array([whole[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("serial"), batch.column("vec_id"), batch.column("label"), packed, pa.array(np.sqrt(size))], names=["serial", "vec_id", "label", "x", "norm"])

    return kept.mapInArrow(pack, CODED)


def _matrix(blobs, d: int | None = None) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones end in zeros."""
    lists = [np.frombuffer(b, dtype="<i4") for b in blobs]
    out = np.zeros((len(lists), max([d or 0, *map(len, lists)])))
    for row, values in zip(out, lists, strict=True):
        row[: len(values)] = values
    return out


def centres_of(anchors: DataFrame) -> np.ndarray:
    """Unit centres of the anchors' clusters, fitted on the driver on at most `SAMPLE` anchors. They shape the lists only."""
    sample = anchors.where("norm > 0").orderBy(F.xxhash64("serial"), "serial").limit(SAMPLE).select("x").collect()
    if not sample:
        return np.zeros((1, 1))
    x = _matrix([r.x for r in sample])
    x /= np.sqrt((x**2).sum(axis=1))[:, None]
    centres = x[: max(1, min(CLUSTERS, anchors.count() // CLUSTER_ROWS, len(x)))].copy()
    for _ in range(5):
        nearest = (x @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            total = x[nearest == c].sum(axis=0)
            length = math.sqrt((total**2).sum())
            if length > 0:
                centres[c] = total / length
    return centres


def angles(x: np.ndarray, norm: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angles between vectors and centres; a zero vector has a right angle to all."""
    d = min(x.shape[1], centres.shape[1])
    cosine = x[:, :d] @ centres[:, :d].T / np.where(norm > 0, norm, 1.0)[:, None]
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def upper_bounds(norm: np.ndarray, angle: np.ndarray, spread) -> np.ndarray:
    """What the inner product of a vector with any unit vector at most `spread` from the centre cannot exceed."""
    return norm * np.minimum(1.0, np.cos(np.maximum(0.0, angle - spread)) + 1e-6)


def clustered(anchors: DataFrame, centres: np.ndarray) -> DataFrame:
    """`anchors` plus `cluster` and `angle`, that to their centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                all_angles = angles(_matrix(batch.column("x").to_pylist()), batch.column("norm").to_numpy(), centres)
                cluster = all_angles.argmin(axis=1)
                more = [pa.array(cluster, pa.int32()), pa.array(all_angles[np.arange(len(cluster)), cluster])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "cluster", "angle"])

    return anchors.mapInArrow(run, f"{CODED}, cluster int, angle double")


def tiled(anchors: DataFrame, n_clusters: int) -> tuple[DataFrame, dict[int, list[int]]]:
    """`anchors` plus `tile`, of about `TILE_ROWS` rows, and the tiles of each cluster. A large cluster is dealt to several."""
    sizes = {r.cluster: r["count"] for r in anchors.groupBy("cluster").count().collect()}  # at most CLUSTERS rows
    tiles, first, parts, tile, filled = {}, [0] * n_clusters, [1] * n_clusters, 0, 0
    for cluster, size in sorted(sizes.items()):
        if filled and filled + size > TILE_ROWS:
            tile, filled = tile + 1, 0
        first[cluster], parts[cluster] = tile, max(1, math.ceil(size / TILE_ROWS))
        tiles[cluster] = list(range(tile, tile + parts[cluster]))
        if parts[cluster] > 1:
            tile, filled = tile + parts[cluster], 0
        else:
            filled += size
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)
    return anchors.withColumn("tile", pick(first) + F.pmod(F.xxhash64("serial"), pick(parts)).cast("int")), tiles


class Wanted:
    """What each anchor of a cell looks for: slots with a label rule, a range of scores, and the keys of the best so far.

    A key is a score and a candidate's place by vec_id in one integer, so that greater keys come first.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int, same_label: bool):
        self.low, self.high, self.k, self.same_label = low, high, k, same_label
        self.best = np.full((*low.shape, k), NONE, dtype=np.int64)

    def floors(self, base: int) -> np.ndarray:
        """The least score that an anchor can still use: below it nothing enters any slot."""
        kth = np.where(self.best.min(axis=2) == NONE, NONE, self.best.min(axis=2) // base)
        floor = np.maximum(self.low, kth)
        return np.where(self.low <= self.high, floor, -NONE).min(axis=1)

    def take(self, live: np.ndarray, scores: np.ndarray, allowed: np.ndarray, behind: np.ndarray, base: int) -> None:
        """Let `scores` of allowed candidates (anchors x candidates) into the slots of the `live` anchors."""
        keys = scores * base + behind
        for slot in range(self.low.shape[1]):
            inside = allowed & (scores >= self.low[live, slot, None]) & (scores <= self.high[live, slot, None])
            both = np.concatenate([self.best[live, slot], np.where(inside, keys, NONE)], axis=1)
            self.best[live, slot] = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k :]


def walk(anchors: pd.DataFrame, block: pd.DataFrame, centres: np.ndarray, k: int, same_label: bool) -> Iterator[tuple]:
    """(anchor places, slots, candidate places, scores) of what a block holds for the anchors of a tile.

    For each cluster among them the block is sorted once by its upper bound. All members walk that list in steps; one
    leaves when its length times the next bound is below the least score that it can use.
    """
    x, u = _matrix(block["x"]), _matrix(anchors["x"])
    d = max(x.shape[1], u.shape[1])
    x, u = np.pad(x, ((0, 0), (0, d - x.shape[1]))), np.pad(u, ((0, 0), (0, d - u.shape[1])))
    norm, label, serial = (block[c].to_numpy() for c in ("norm", "label", "serial"))
    by_id = np.lexsort((serial, block["vec_id"].to_numpy()))
    base = 1 << max(1, int(len(x)).bit_length())
    behind = np.empty(len(x), dtype=np.int64)
    behind[by_id] = base - 1 - np.arange(len(x))
    all_angles = angles(x, norm, centres)
    low, high = np.stack(anchors["low"].to_list()), np.stack(anchors["high"].to_list())
    u_norm, u_label, u_serial, u_angle = (anchors[c].to_numpy() for c in ("norm", "label", "serial", "angle"))
    cluster = anchors["cluster"].to_numpy()
    for c in np.unique(cluster):
        members = np.flatnonzero(cluster == c)
        bound = upper_bounds(norm, all_angles[:, c], u_angle[members].max())
        order = np.argsort(-bound)
        wanted = Wanted(low[members], high[members], k, same_label)
        for start in range(0, len(order), STEP):
            floor = wanted.floors(base)
            live = np.flatnonzero(u_norm[members] * max(0.0, bound[order[start]]) + 0.5 >= floor)
            if not len(live):
                break
            here, who = order[start : start + STEP], members[live]
            scores = np.rint(u[who] @ x[here].T).astype(np.int64)
            alike = u_label[who][:, None] == label[here][None, :]
            allowed = (alike & (u_serial[who][:, None] != serial[here][None, :])) if same_label else ~alike
            wanted.take(live, scores, allowed, behind[here], base)
        member, slot, place = np.nonzero(wanted.best != NONE)
        keys = wanted.best[member, slot, place]
        yield members[member], slot, by_id[base - 1 - keys % base], keys // base


def walked(asked: DataFrame, candidates: DataFrame, centres: np.ndarray, k: int, same_label: bool) -> DataFrame:
    """`serial, slot, vec_id, other, score`: the `k` best a slot of each cell. `asked` and `candidates` share `tile, block`."""

    def cell(anchors: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = {"serial": [], "slot": [], "vec_id": [], "other": [], "score": []}
        if len(anchors) and len(block):
            ids, serial, asking = (f.to_numpy() for f in (block["vec_id"], block["serial"], anchors["serial"]))
            for who, slot, place, score in walk(anchors, block, centres, k, same_label):
                for name, values in zip(out, (asking[who], slot, ids[place], serial[place], score), strict=True):
                    out[name].append(values)
        return pd.DataFrame({name: np.concatenate(values) if values else np.empty(0, np.int64) for name, values in out.items()})

    met = asked.groupBy("tile", "block").cogroup(candidates.groupBy("tile", "block"))
    return met.applyInPandas(cell, "serial long, slot int, vec_id long, other long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    """The `k` first rows of each anchor and slot, with `rank`."""
    order = Window.partitionBy("serial", "slot").orderBy(F.desc("score"), "vec_id", "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def listed(stages: Stages, anchors: DataFrame, rows: DataFrame, centres: np.ndarray, tiles: dict[int, list[int]], blocks: int, k: int, same_label: bool) -> DataFrame:
    """The `k` best candidates of each anchor and slot, staged. `anchors` have `low, high`, one score range a slot.

    All anchors first walk one block, a random part of the rows. What they find there bounds what they can still use, so
    that the other candidates are only sent to tiles with a cluster in whose list they rank high enough.
    """
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("serial"), F.lit(blocks)).cast("int"))
    every = sorted({t for of in tiles.values() for t in of})
    to_all = F.explode(F.array(*[F.lit(t) for t in every]))
    first = dealt.where("block = 0").withColumn("tile", to_all)
    seeds = stages.write(best(walked(anchors.withColumn("block", F.lit(0)), first, centres, k, same_label), k), "seeds")
    if blocks == 1:
        return seeds
    floors = seeds.where(F.col("rank") == k).select("serial", F.col("slot").alias("i"), F.col("score").alias("floor"))
    floors = floors.groupBy("serial").agg(F.map_from_entries(F.collect_list(F.struct("i", "floor"))).alias("floors"))  # a slot each
    known = anchors.join(floors, "serial", "left")
    raised = F.transform("low", lambda v, i: F.greatest(v, F.coalesce(F.element_at("floors", i), v)))
    open_slots = F.filter(F.zip_with(raised, "high", lambda a, b: F.when(a <= b, a)), lambda v: v.isNotNull())
    known = stages.write(known.withColumn("low", raised).withColumn("least", F.array_min(open_slots)).drop("floors").where("least is not null"), "asked")
    # At most CLUSTERS rows: the least bound that a member can still use, and the members' widest angle.
    need = F.min(F.when(F.col("norm") > 0, F.col("least") / F.col("norm")).otherwise(F.lit(float("-inf"))))
    limits = {r.cluster: (r.need, r.spread) for r in known.groupBy("cluster").agg(need.alias("need"), F.max("angle").alias("spread")).collect()}

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = sorted(limits)
        for batch in batches:
            if not batch.num_rows or not chosen:
                continue
            norm = batch.column("norm").to_numpy()
            angle = angles(_matrix(batch.column("x").to_pylist()), norm, centres)[:, chosen]
            bound = np.maximum(0.0, upper_bounds(norm[:, None], angle, np.array([limits[c][1] for c in chosen])[None, :]))
            reaches = bound * (1 + 1e-9) + 1e-6 >= np.array([limits[c][0] for c in chosen])[None, :]
            where = np.zeros((batch.num_rows, max(every) + 1), dtype=bool)
            for i, c in enumerate(chosen):
                where[:, tiles[c]] |= reaches[:, i, None]
            lists = pa.array([np.flatnonzero(row).astype(np.int32) for row in where], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "tiles"])

    others = dealt.where("block > 0").mapInArrow(sent, f"{CODED}, block int, tiles array<int>")
    others = others.withColumn("tile", F.explode("tiles")).drop("tiles")
    asked = known.drop("least").withColumn("block", F.explode(F.sequence(F.lit(1), F.lit(blocks - 1))))
    more = walked(asked, others, centres, k, same_label)
    return stages.write(best(seeds.drop("rank").unionByName(more), k), "listed")


def mine(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score` of `vectors` (`vec_id, embedding, label`).

    Anchors are rows whose vec_id is divisible by `every`; each has up to `positives` positives, and a positive up to
    `negatives` negatives with scores from 30 to 90 percent of its own. Rows with a null vec_id, label or vector, or a null
    or non-finite component, take no part. Shorter vectors end in zeros; a vector without components is a zero vector.
    Rows that repeat a vec_id are rows of their own: each can be an anchor, a positive of the other, and a negative.
    Ties go to the smaller vec_id. Other columns are left out. Without anchors, positives or negatives there are no rows.
    Vectors longer than 65,536 are an error, as scores would not be exact.

    A cell is a tile of anchors and a block of candidates, both of bounded size and dealt by hash, so that no vec_id,
    label or vector makes a task larger. Nothing is dropped but what the bounds exclude.
    """
    spark = vectors.sparkSession
    with Stages(spark) as stages:
        rows = stages.write(rows_of(vectors.select("vec_id", "embedding", "label")), "rows")
        blocks = max(1, math.ceil(rows.count() / BLOCK_ROWS))
        anchors = rows.where(F.col("vec_id") % every == 0)
        centres = centres_of(anchors)
        grouped = stages.write(clustered(anchors, centres), "anchors")
        tiled_anchors, tiles = tiled(grouped, len(centres))
        whole = lambda v: F.array(F.lit(v).cast("long"))
        first = tiled_anchors.withColumn("low", whole(NONE + 1)).withColumn("high", whole(-NONE))
        found = listed(stages, first, rows, centres, tiles, blocks, positives, True) if tiles else None
        if found is None:
            return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
        mates = F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score")))  # at most `positives` an anchor
        per_anchor = found.groupBy("serial").agg(mates.alias("mates"))
        ask = tiled_anchors.join(per_anchor, "serial")
        bound = lambda percent, up: F.transform("mates", lambda m: (F.ceil if up else F.floor)(m.score * F.lit(percent) / F.lit(100).cast("decimal(3,0)")).cast("long"))
        ask = ask.withColumn("low", bound(LOW, True)).withColumn("high", bound(HIGH, False))
        second = stages.write(_wide(ask, positives), "mates")
        result = listed(stages, second.drop("mates"), rows, centres, tiles, blocks, negatives, False)
        named = second.select("serial", F.col("vec_id").alias("anchor_id"), F.posexplode("mates").alias("slot", "mate"))
        joined = result.withColumnRenamed("vec_id", "negative_id").join(named, ["serial", "slot"])
        return stage(joined.select(
            "anchor_id", F.col("mate.vec_id").alias("positive_id"), "rank", "negative_id",
            F.col("mate.score").alias("positive_score"), F.col("score").alias("negative_score"),
        ), "negatives")


def _wide(asked: DataFrame, slots: int) -> DataFrame:
    """All anchors with `slots` score ranges; those without a positive are empty."""
    fill = lambda name, v: F.transform(F.sequence(F.lit(1), F.lit(slots)), lambda i: F.coalesce(F.get(name, i - 1), F.lit(v).cast("long")))
    return asked.withColumn("low", fill("low", -NONE)).withColumn("high", fill("high", NONE))


ORACLE = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % {RELABEL} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE}.0::DOUBLE * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN s USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
