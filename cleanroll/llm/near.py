"""Near-duplicate texts: BagMinHash signatures, bands, and a check of the multisets themselves."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from cleanroll.session import Stages, stage

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
SIGNATURE = BANDS * ROWS
# Signatures only rule pairs out: of 125 places, those of bags 0.8 similar agree in fewer than 0.58 with a probability of
# about 1e-8; of 1,000 places, in fewer than 0.73 with about 4e-8.
ESTIMATE = 0.58
LONG, LONG_ESTIMATE = 1000, 0.73
TILE = 256
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")  # ASCII letters and digits, and all that is not ASCII
SHINGLES_AT_ONCE = 300_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").lower().encode("utf-8", "surrogatepass"))


def shingles_of(words: list[bytes], n: int = WORDS) -> np.ndarray:
    """A hash of each run of `n` words; a shorter text with words is one run."""
    h = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
    if not len(h):
        return h
    size = min(n, len(h))
    out = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        out = mixed(out * GOLDEN + h[k : len(h) - size + 1 + k])
    return out


def signatures(bags: list[np.ndarray], size: int = SIGNATURE) -> np.ndarray:
    """One row of `size` 32-bit values per bag of shingle hashes; two rows agree in a place with probability of the
    weighted Jaccard similarity of the bags, a shingle's weight being how often it occurs.

    Each shingle has a Poisson process over weight and time, drawn from its hash. Its weight axis is split into the cells
    [0,1), [1,2), [2,4), [4,8) ..., each with a process of its own whose rate is the cell's length, so a heavier bag only
    adds processes. A point gets a place of the signature and a unit within its cell, by halving; it counts if the unit lies
    below the shingle's weight. A place keeps the earliest point that falls on it, and a process ends when its time has
    passed all places of its bag.
    """
    times = np.full((len(bags), size), np.inf)
    seeds, owner, weight, low, length = [], [], [], [], []
    for i, bag in enumerate(bags):
        values, counts = np.unique(bag, return_counts=True)
        floor, level = 0, 1
        while len(values):
            cell = max(1, floor)
            seeds.append(mixed(values + np.uint64(level * int(GOLDEN) % 2**64)))
            owner.append(np.full(len(values), i))
            weight.append(counts)
            low.append(np.full(len(values), floor))
            length.append(np.full(len(values), cell))
            floor, level = floor + cell, level + 1
            more = counts > floor
            values, counts = values[more], counts[more]
    if not seeds:
        return np.zeros((len(bags), size), dtype=np.uint32)
    state, doc, w = np.concatenate(seeds), np.concatenate(owner), np.concatenate(weight)
    lo, cell = np.concatenate(low), np.concatenate(length)
    at = np.zeros(len(state))
    flat = times.reshape(-1)
    last = np.full(len(bags), np.inf)
    while len(state):
        state = state + GOLDEN
        bits = mixed(state)
        at = at - np.log1p(-((bits >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / cell
        alive = at < last[doc]
        if not alive.all():
            state, doc, w, lo, cell, at = (x[alive] for x in (state, doc, w, lo, cell, at))
            if not len(state):
                break
        more = mixed(state ^ np.uint64(0xD1B54A32D192ED03))
        place = ((more >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        unit = lo + ((more & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * cell).astype(np.int64)
        hit = unit < w
        np.minimum.at(flat, doc[hit] * size + place[hit], at[hit])
        live = np.unique(doc)
        last[live] = times[live].max(axis=1)
    out = (mixed(times.view(np.uint64)) >> np.uint64(32)).astype(np.uint32)
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two bags: the sum of lesser counts over the sum of greater ones."""
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    common = int(np.minimum(ca[ia], cb[ib]).sum())
    return common / max(1, len(a) + len(b) - common)


def profiles(docs: DataFrame) -> DataFrame:
    """Every row of `docs` with `_row` (its number), `_content` (16 bytes of its words; null without any) and `_bands`, a
    hash of each band of its signature, which is all that later steps need of it."""
    fields = [f for f in docs.schema.fields if f.name not in ("_row", "_content", "_sig", "_bands")]
    own = [StructField("_row", LongType()), StructField("_content", BinaryType()), StructField("_sig", BinaryType())]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            contents: list[bytes | None] = []
            sigs: list[bytes] = []
            held: list[np.ndarray] = []
            weight = 0
            for cell in batch.column("text"):
                words = words_of(cell.as_py())
                contents.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
                held.append(shingles_of(words))
                weight += len(words)
                if weight >= SHINGLES_AT_ONCE:
                    sigs += [s.tobytes() for s in signatures(held)]
                    held, weight = [], 0
            sigs += [s.tobytes() for s in signatures(held)]
            rows = pa.array(np.arange(number, number + len(contents)), pa.int64())
            number += len(contents)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in fields], rows, pa.array(contents, pa.binary()), pa.array(sigs, pa.binary())],
                names=[f.name for f in fields + own],
            )

    signed = docs.select(*[F.col(f"`{f.name}`") for f in fields]).mapInArrow(sign, StructType(fields + own))
    bands = F.array(*[F.xxhash64(F.lit(b), F.substring("_sig", b * ROWS * 4 + 1, ROWS * 4)) for b in range(BANDS)])
    return signed.withColumn("_bands", bands).drop("_sig")


def band_members(nodes: DataFrame) -> DataFrame:
    """`b, band, node, n` for the bands that two nodes or more share, n of them; b is the band's number.

    Bands are moved once: most nodes share none, and a count of its own would move nearly as many rows again.
    """
    bands = nodes.select("node", F.posexplode("_bands").alias("b", "band"))
    return bands.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("band"))).where("n > 1")


@F.pandas_udf(DoubleType())
def text_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Exact similarity of two texts; rows come with equal `b` together."""
    out, held, bag = [], None, np.empty(0, np.uint64)
    for x, y in zip(a, b, strict=True):
        if y is not held and y != held:
            held, bag = y, shingles_of(words_of(y))
        out.append(similarity(shingles_of(words_of(x)), bag))
    return pd.Series(out, dtype="float64")


def verified(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs `a, b` of nodes whose bags are `least` similar or more. `texts` has `node, text`."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(text_similarity("_a", "_b") >= least).select("a", "b")


def components(stages: Stages, edges: DataFrame) -> DataFrame:
    """`node, label`: the least node of each node's connected component, for nodes with an edge.

    A round takes the least label of a node's neighbours and then the label of that label; rounds are written, so a lost
    executor repeats one at most; the round before goes when the next is there.
    """
    both = stages.write(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stages.write(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("heard"))
        nearer = labels.join(heard.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("was"), F.least("label", "heard").alias("label"))
        jumped = nearer.join(labels.select(F.col("node").alias("label"), F.col("label").alias("next")), "label")
        before, labels = labels, stages.write(jumped.select("node", F.least("label", "next").alias("label"), "was"), "labels")
        stages.drop(before)
        if labels.where("label <> was").isEmpty():
            return labels.select("node", "label")


def long_signatures(texts: DataFrame) -> DataFrame:
    """`node, _long` of `node, text`; a byte of each place is enough to tell agreement here."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                rows = signatures([shingles_of(words_of(x.as_py())) for x in part.column("text")], LONG)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([r.astype(np.uint8).tobytes() for r in rows], pa.binary())], names=["node", "_long"])

    return texts.select("node", "text").mapInArrow(sign, "node long, _long binary")


def close_pairs(split: DataFrame) -> DataFrame:
    """`a, b` of different labels that share a band and whose signatures do not rule them out, each pair once.

    `split` has `node, label, _long` and `of`, an array of `(b, band, n)`: the node's bands with more than one label, n being the band's
    members and b its number. A band is dealt into
    tiles of about `TILE` members and each two tiles meet in one cell, so no group is ever whole in a task. As many places
    as a signature has are looked at first, then all. A pair is left to the first of the bands it shares; a member takes
    the hashes of its bands before this one along. Those with one label alone are not needed for it: no pair of two labels shares one.
    """
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    rows = split.select("node", "label", "_long", "of", F.explode("of").alias("at")).select("*", "at.b", "at.band", "at.n")
    earlier = F.filter("of", lambda x: x["b"] < F.col("b"))
    tiled = rows.withColumn("places", earlier["b"]).withColumn("earlier", earlier["band"]).drop("of", "at").withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    other = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    cells = other.select("band", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "node", "label", "_long", "places", "earlier")

    def meet(cell: pd.DataFrame) -> pd.DataFrame:
        long = np.frombuffer(b"".join(cell["_long"]), dtype=np.uint8).reshape(len(cell), -1)
        some = np.ascontiguousarray(long[:, :SIGNATURE])
        earlier = np.repeat(-1 - np.arange(len(cell))[:, None], BANDS, axis=1)  # where a row has no band, a value of its own
        for k, (places, hashes) in enumerate(zip(cell["places"], cell["earlier"], strict=True)):
            earlier[k, places] = hashes
        node, label, tile = (cell[c].to_numpy() for c in ("node", "label", "tile"))
        across = cell["i"].iloc[0] != cell["j"].iloc[0]
        out = []
        for k in range(1, len(cell)):
            near = label[:k] != label[k]
            if across:
                near &= tile[:k] != tile[k]
            at = np.flatnonzero(near)
            at = at[(some[at] == some[k]).sum(axis=1) >= ESTIMATE * SIGNATURE]
            at = at[~(earlier[at] == earlier[k]).any(axis=1)]
            at = at[(long[at] == long[k]).sum(axis=1) >= LONG_ESTIMATE * LONG]
            out += [(max(node[k], x), min(node[k], x)) for x in node[at]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return cells.groupBy("band", "i", "j").applyInPandas(meet, "a long, b long")


def links(stages: Stages, nodes: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """`node, label` of all nodes that are similar to another one, directly or through others.

    Members of a band are first held against one of them, the one with the most company over all its bands: copies of one
    text have that text in common. In bands that are then not of one component, members with different labels are compared
    by signature, tile by tile, and the close ones by their texts. A pair is skipped only where both ends are linked
    already or their signatures are far apart (at similarity 0.8 below 1e-7), and copies in one component never meet each other.
    Texts of nodes that share no band are left behind at once: later joins move the others only.
    """
    members = stages.write(band_members(nodes), "members")
    company = stages.write(members.groupBy("node").agg(F.sum("n").alias("company")), "company")
    texts = stages.write(texts.join(company.select("node"), "node", "left_semi"), "held")
    known = members.join(company, "node")
    chosen = known.groupBy("band").agg(F.max(F.struct("company", "node")).alias("c")).select("band", F.col("c.node").alias("centre"))
    centres = stages.write(chosen, "centres")
    star = members.join(centres, "band").where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    pairs = stages.write(star, "pairs")
    edges = stages.write(verified(pairs, texts, least), "linked")
    of_node = members.join(components(stages, edges), "node", "left").select("b", "band", "n", "node", F.coalesce("label", "node").alias("label"))
    labelled = stages.write(of_node, "labelled")
    stages.drop(members, company, centres, pairs)
    bands = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("band")
    uneven = stages.write(bands, "uneven")
    of = labelled.join(uneven, "band").groupBy("node", "label").agg(F.collect_list(F.struct("b", "band", "n")).alias("of"))
    split = stages.write(of, "split")
    stages.drop(labelled, uneven)
    unlike = stages.write(texts.join(split.select("node"), "node", "left_semi"), "unlike")
    stages.drop(texts)
    texts = unlike
    long = stages.write(long_signatures(texts), "long")
    fresh = stages.write(close_pairs(split.join(long, "node")), "pairs")
    stages.drop(split, long)
    return components(stages, edges.union(stages.write(verified(fresh, texts, least), "linked")))


def decisions(stages: Stages, staged: DataFrame, least: float) -> DataFrame:
    """`_row, class_id` of the rows of `staged` that are not the keepers of their classes. What it stages goes with `stages`."""
    with_words = staged.where(F.col("_content").isNotNull())
    nodes = stages.write(with_words.groupBy("_content").agg(F.min("_row").alias("node"), F.max("_bands").alias("_bands")), "nodes")
    texts = staged.select(F.col("_row").alias("node"), "text")
    labels = links(stages, nodes.select("node", "_bands"), texts, least)
    home = stages.write(nodes.select("_content", "node").join(labels, "node", "left").select("_content", F.coalesce("label", "node").alias("label")), "home")
    rows = stages.write(with_words.select("_row", "doc_id", "_content").join(home, "_content").select("_row", "doc_id", "label"), "rows")
    ids = rows.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    firsts = rows.join(stages.write(ids, "ids"), "label")
    kept = firsts.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("label").agg(F.min("_row").alias("_row"))
    return firsts.select("_row", "class_id").join(kept.select("_row"), "_row", "left_anti")


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Every row of `docs` with `class_id`, the least doc_id of its class, and `keeper`, true for one row of a class.

    A class holds texts of equal words and texts linked by a similarity of `least` or more over runs of five words. A null
    or empty text, or one without words, is a class by itself, as its keeper. A null doc_id takes part; it is the
    class_id only where a class has no other. The keeper has the least doc_id; of repeated rows, the first stays.
    Columns of `docs` named `_row`, `_content`, `_sig` or `_bands` are left out, class_id and keeper replaced.
    """
    docs = docs.drop(*({"class_id", "keeper"} & set(docs.columns)))
    staged = stage(profiles(docs), "profiles")
    with Stages(docs.sparkSession) as stages:
        decided = stage(decisions(stages, staged, least), "decided")
    # Keepers have the least doc_id of their class as their own, and are most rows: only the others are looked up.
    left = decided.select("_row", F.col("class_id").alias("_class"), F.lit(True).alias("_left"))
    joined = staged.drop("_bands").join(left, "_row", "left")
    return joined.withColumn("class_id", F.when(F.col("_left"), F.col("_class")).otherwise(F.col("doc_id"))).withColumn(
        "keeper", F.col("_left").isNull()
    ).drop("_row", "_content", "_class", "_left")
