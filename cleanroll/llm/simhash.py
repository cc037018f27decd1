"""SimHash fingerprints with DataFrame functions only: weighted term votes, permuted block tables, likeness to edited texts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from cleanroll.session import Stages, stage

GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEX, HALF = 12, 45  # a fingerprint is two numbers of 45 bits, each written as 12 hex digits; more bits would pass 100 columns
BITS = 2 * HALF
HEAVIEST = 8  # a term weighs as many votes as it has letters, up to this
LANE = 32  # bits of a vote counter: the text's and the edited text's share a long
RADIUS = 4
BLOCKS, BLOCK_BITS = 6, 15  # RADIUS differing bits leave at least BLOCKS - RADIUS blocks alike
EVERY = 100  # documents whose id it divides ask for their neighbours
CHUNK_ROWS = 256
KNOTS = 1024
STRIDE = 32
ACCURACY = 100_000
SUPER = 1024  # chunks whose order is settled together
LAST = (1 << 63) - 1  # null ids come last


def terms(text: Column) -> Column:
    """The distinct words of a text, A-Z in lower case; a null text has none."""
    return F.array_distinct(F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), ""))


def weight(term: Column) -> Column:
    """Its letters, up to HEAVIEST; null for no term."""
    return F.when(F.length(term) > HEAVIEST, F.lit(HEAVIEST)).otherwise(F.length(term)).cast("long")


def tallied(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """`keys` and the fingerprints `f0, f1` of `text` and `e0, e1` of `edited`, one row for each row of `pairs`.

    Each term of either text is hashed once and votes with its weight for the texts that hold it; a bit is set where more
    than half of the weight has it set. No text has the half a billion distinct words that would overflow a counter. A
    text without words has no bit set. `keys` tell rows apart.
    """
    both = pairs.withColumn("_t", terms(F.col("text"))).withColumn("_e", terms(F.col("edited")))
    kinds = [(1 + (1 << LANE), F.array_intersect("_t", "_e")), (1, F.array_except("_t", "_e")), (1 << LANE, F.array_except("_e", "_t"))]
    held = both.select(*keys, F.explode(F.array(*[F.struct(F.lit(flags).cast("long").alias("flags"), words.alias("words")) for flags, words in kinds])).alias("s"))
    votes = held.select(*keys, "s.flags", F.explode_outer("s.words").alias("_word"))
    votes = votes.select(*keys, F.md5("_word").alias("_d"), (weight(F.col("_word")) * F.col("flags")).alias("_w"))
    half = lambda n: F.conv(F.substring("_d", 1 + HEX * n, HEX), 16, 10).cast("long")
    votes = votes.select(*keys, "_w", half(0).alias("_h0"), half(1).alias("_h1"))
    counts = [F.expr(f"sum((shiftright(_h{h}, {b}) & 1L) * _w) as _{h}_{b}") for h in (0, 1) for b in range(HALF)]
    counted = votes.groupBy(*keys).agg(F.sum("_w").alias("_total"), *counts)
    low, high = lambda c: c.bitwiseAND(F.lit((1 << LANE) - 1)), lambda c: F.shiftright(c, LANE)
    sums = counted.select(*keys, "_total", *[F.array(*[f"_{h}_{b}" for b in range(HALF)]).alias(f"_s{h}") for h in (0, 1)])

    def bits(lane, h):
        places = F.transform(f"_s{h}", lambda c, b: F.when(2 * lane(c) > lane(F.col("_total")), F.call_function("shiftleft", F.lit(1).cast("long"), b)))
        return F.aggregate(places, F.lit(0).cast("long"), lambda a, v: a.bitwiseOR(F.coalesce(v, F.lit(0).cast("long"))))

    return sums.select(*keys, bits(low, 0).alias("f0"), bits(low, 1).alias("f1"), bits(high, 0).alias("e0"), bits(high, 1).alias("e1"))


def apart(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """How many bits of two fingerprints differ."""
    return sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b, strict=True)), F.lit(0))


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    return F.lit(1.0) - apart(a, b) / F.lit(float(BITS))


def written(a: str, b: str) -> Column:
    """A fingerprint as 24 hex digits."""
    return F.lower(F.concat(*[F.lpad(F.hex(c), HEX, "0") for c in (a, b)]))


# --- the order of documents -------------------------------------------------------------------------------------------


def _numbers(values: list[int]) -> Column:
    """A literal array, as one text that is read when the plan is made."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _below(knots: list[int], value: Column, or_equal: bool) -> Column:
    """How many knots are less than `value` (or not greater): first among every STRIDE-th, then among those between."""
    less = (lambda k: k <= value) if or_equal else (lambda k: k < value)
    coarse = F.greatest(F.size(F.filter(_numbers(knots[::STRIDE]), less)) - 1, F.lit(0)) * STRIDE
    return coarse + F.size(F.filter(F.slice(_numbers(knots), coarse + 1, F.lit(STRIDE)), less))


def chunked(docs: DataFrame) -> DataFrame:
    """`docs` plus `chunk`, which grows with doc_id, null last, and holds about CHUNK_ROWS rows.

    Ids are spread evenly between KNOTS quantiles of theirs, so that gaps between ids do no harm. An id that spans
    several quantiles is spread by the hash of its texts instead; equal texts of one such id share a chunk.
    """
    value = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    shares = [i / KNOTS for i in range(KNOTS + 1)]
    known = docs.agg(F.percentile_approx(value, shares, ACCURACY).alias("knots"), F.count(F.lit(1)).alias("rows")).first()
    if not known.rows:
        return docs.withColumn("chunk", F.lit(0).cast("long"))
    knots = sorted(known.knots)
    number = F.col("_v")
    lo, hi = F.col("_lo"), F.col("_hi")
    at = lambda i: F.element_at(_numbers(knots), i).cast("double")
    left, right = at(F.greatest(lo, F.lit(1))), at(F.least(lo + 1, F.lit(len(knots))))
    inside = F.when(lo == 0, F.lit(0.0)).when(right > left, (lo - 1) + (number.cast("double") - left) / (right - left)).otherwise((lo - 1).cast("double"))
    placed = docs.withColumn("_v", value).withColumn("_lo", _below(knots, number, False))
    if len(set(knots)) < len(knots):
        share = F.shiftrightunsigned(F.xxhash64("text"), 11) / F.lit(float(1 << 53))
        placed = placed.withColumn("_hi", _below(knots, number, True))
        inside = F.when((hi - lo >= 2) & ((number == LAST) | (F.abs(number) < (1 << 53))), lo + share * (hi - lo - 1)).otherwise(inside)
    chunk = F.floor(F.least(F.greatest(inside, F.lit(0.0)), F.lit(float(KNOTS))) * F.lit(known.rows / (KNOTS * CHUNK_ROWS))).cast("long")
    return placed.withColumn("chunk", chunk).drop("_v", "_lo", "_hi")


def chunk_order(chunks: DataFrame) -> DataFrame:
    """`chunk, next_chunk` of all chunks that hold rows; the first one follows the last. Only one row in SUPER chunks is
    ordered in one task."""
    some = chunks.select("chunk").distinct().withColumn("super", F.floor(F.col("chunk") / SUPER))
    supers = some.groupBy("super").agg(F.min("chunk").alias("first"))
    order = Window.orderBy("super")
    start = F.first("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    supers = supers.select("super", F.coalesce(F.lead("first").over(order), start).alias("after"))
    inner = F.lead("chunk").over(Window.partitionBy("super").orderBy("chunk"))
    return some.withColumn("_next", inner).join(supers, "super").select("chunk", F.coalesce("_next", "after").alias("next_chunk"))


def followed(rows: DataFrame, order: list, nexts: DataFrame, value: str) -> DataFrame:
    """`rows` plus `place` in their chunk and `following`, the value of the row after them; the first row follows the last.

    `value` names a column without nulls. The rows pass the shuffle by chunk once for all three readers below. To that end
    each reader needs the same columns below the shuffle: the filter, which the joins would add to some of them, stands
    before it, `value` is a column and no expression, and the head of a chunk is the row with none before it, as a limit by
    `place` would be moved below the shuffle.
    """
    rows = rows.where(F.col("chunk").isNotNull())
    within = Window.partitionBy("chunk").orderBy(*order)
    lined = rows.withColumn("place", F.row_number().over(within)).withColumn("following", F.lead(value).over(within))
    lined = lined.withColumn("_before", F.lag(F.lit(1)).over(within))
    heads = lined.where("_before is null").select(F.col("chunk").alias("next_chunk"), F.col(value).alias("following"))
    lined = lined.drop("_before")
    last = lined.where("following is null").drop("following").join(nexts, "chunk").join(heads, "next_chunk").drop("next_chunk")
    return lined.where("following is not null").unionByName(last)


def whole_texts(docs: DataFrame) -> DataFrame:
    """`doc_id` as a long and `text` without nulls. A long id is not cast: the alias of a cast that does nothing goes in some
    readers of `followed` only, and then they would not share their shuffle."""
    is_long = isinstance(docs.schema["doc_id"].dataType, LongType)
    return docs.select("doc_id" if is_long else F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row a document: `doc_id, n_chars, edited_sha256`, the fingerprints `f0, f1` and `e0, e1` of its text and its
    edited text, `n0, n1` of the next document's text, staged."""
    spark = docs.sparkSession
    whole = whole_texts(docs)
    with Stages(spark) as stages:
        dealt = chunked(whole)
        nexts = stages.write(chunk_order(dealt), "chunks")
        by_id = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.length("text")]
        lined = followed(dealt, by_id, nexts, "text")
        n = F.length("text")
        cut = F.floor(n / 4).cast("int")
        edited = F.concat(F.substr("text", F.lit(1), n - cut), F.substr("following", F.lit(1), cut))
        pairs = lined.withColumn("edited", F.when(cut > 0, edited).otherwise(F.col("text")))
        pairs = pairs.withColumn("n_chars", n.cast("long")).withColumn("edited_sha256", F.sha2("edited", 256))
        prints = stages.write(tallied(pairs, ["chunk", "place", "doc_id", "n_chars", "edited_sha256"]), "prints")
        own = prints.withColumnRenamed("place", "_place").withColumn("_print", F.struct("f0", "f1"))
        own = followed(own, ["_place"], nexts, "_print")
        return stage(
            own.select("doc_id", "n_chars", "edited_sha256", "f0", "f1", "e0", "e1", F.col("following.f0").alias("n0"), F.col("following.f1").alias("n1")),
            "fingerprints",
        )


# --- block tables -----------------------------------------------------------------------------------------------------


def _block(a: str, b: str, i: int) -> str:
    per_half = HALF // BLOCK_BITS
    return f"(shiftright({a if i < per_half else b}, {BLOCK_BITS * (i % per_half)}) & {(1 << BLOCK_BITS) - 1}L)"


def tables(prints: DataFrame, a: str, b: str, radius: int = RADIUS) -> DataFrame:
    """`prints` once for each block table: `key` holds the table's number and the blocks that it is ordered by, and
    `earlier` the blocks that must differ for this to be the first table in which a pair meets."""
    rows = []
    for number, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - radius)):
        key = f"{number}L"
        for i in chosen:
            key = f"(shiftleft({key}, {BLOCK_BITS}) | {_block(a, b, i)})"
        earlier = sum(1 << i for i in range(max(chosen)) if i not in chosen)
        rows.append(f"struct({key} as key, {earlier} as earlier)")
    return prints.withColumn("_t", F.explode(F.expr(f"array({', '.join(rows)})"))).select("*", "_t.key", "_t.earlier").drop("_t")


def within(prints: DataFrame, asked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`q0, q1, n`: for each distinct fingerprint `f0, f1` of `asked` the number of rows of `prints` whose fingerprints
    differ from it in at most `radius` bits, itself included.

    Equal fingerprints are counted first, so that copies are one row. `radius` differing bits can touch as many blocks;
    two of the others make the key of one of the tables, so no neighbour is missed. Each pair counts in the first table
    in which it meets.
    """
    if not 0 <= radius <= BLOCKS - 2:
        raise ValueError(f"the radius goes from 0 to {BLOCKS - 2}")
    known = prints.groupBy("f0", "f1").agg(F.count(F.lit(1)).alias("n"))
    queries = asked.select(F.col("f0").alias("q0"), F.col("f1").alias("q1")).distinct()
    left, right = tables(queries, "q0", "q1", radius), tables(known, "f0", "f1", radius).drop("earlier")
    alike = F.expr(" | ".join(f"if({_block('(q0 ^ f0)', '(q1 ^ f1)', i)} = 0, {1 << i}, 0)" for i in range(BLOCKS)))
    near = (apart(("q0", "q1"), ("f0", "f1")) <= radius) & (alike.bitwiseAND(F.col("earlier")) == 0)
    met = left.join(right, "key").where(near)
    return met.groupBy("q0", "q1").agg(F.sum("n").alias("n"))


def scan(docs: DataFrame, every: int = EVERY, radius: int = RADIUS) -> DataFrame:
    """`doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_within` of all `docs`.

    A null text is empty. Documents follow one another by doc_id, null last, rows that repeat an id by the hash of their
    texts; the first one follows the last, and the only document follows itself. A text of fewer than four code points is
    its own edited text. Texts of any length are whole; repeated rows are rows; an empty table stays empty; other columns
    are left out. `n_within` is the number of other documents whose fingerprints differ in at most `radius` bits, for
    documents whose id is divisible by `every`, else null.
    """
    prints = fingerprints(docs)
    own, edited, following = ("f0", "f1"), ("e0", "e1"), ("n0", "n1")
    is_query = F.col("doc_id") % every == 0
    counts = stage(within(prints, prints.where(is_query), radius), "within")
    asked = prints.where(is_query).join(counts, (F.col("f0") == F.col("q0")) & (F.col("f1") == F.col("q1")), "left")
    asked = asked.withColumn("n_within", F.col("n") - 1).drop("q0", "q1", "n")
    rest = prints.where(F.coalesce(~is_query, F.lit(True))).withColumn("n_within", F.lit(None).cast("long"))
    return asked.unionByName(rest).select(
        "doc_id", "n_chars", "edited_sha256", written(*own).alias("fingerprint"), written(*edited).alias("edited_fingerprint"),
        likeness(own, edited).alias("near_edited"), likeness(own, following).alias("near_next"), "n_within",
    )


def _oracle() -> str:
    """The same by a global order, all terms counted with a sum a bit, and all pairs for the neighbours."""
    sums = ", ".join(f"2 * sum(((h{h} >> {b}) & 1) * w) > sum(w) AS b{h}_{b}" for h in (0, 1) for b in range(HALF))
    number = lambda h: " | ".join(f"(CASE WHEN b{h}_{b} THEN {1 << b}::BIGINT ELSE 0::BIGINT END)" for b in range(HALF))
    part = lambda f, h: f"('0x' || substr({f}, {1 + HEX * h}, {HEX}))::BIGINT"
    apart_ = lambda a, b: " + ".join(f"bit_count(xor({part(a, h)}, {part(b, h)}))" for h in (0, 1))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (SELECT *, length(text)::BIGINT AS n_chars, coalesce(lead(doc_id) OVER (ORDER BY doc_id), min(doc_id) OVER ()) AS next_id,
  coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS following FROM d),
x AS (SELECT *, left(text, n_chars - n_chars // 4) || left(following, n_chars // 4) AS edited FROM o),
t AS (SELECT doc_id, 0 AS kind, text AS t FROM x UNION ALL SELECT doc_id, 1, edited FROM x),
terms AS (SELECT DISTINCT doc_id, kind, unnest(regexp_split_to_array(translate(t, '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+')) AS term FROM t),
votes AS (SELECT doc_id, kind, ('0x' || substr(md5(term), 1, {HEX}))::BIGINT AS h0, ('0x' || substr(md5(term), {HEX + 1}, {HEX}))::BIGINT AS h1,
  least(length(term), {HEAVIEST}) AS w FROM terms WHERE term <> ''),
bits AS (SELECT doc_id, kind, {sums} FROM votes GROUP BY doc_id, kind),
prints AS (SELECT doc_id, kind, printf('%0{HEX}x', {number(0)}) || printf('%0{HEX}x', {number(1)}) AS f FROM bits),
p AS (SELECT t.doc_id, t.kind, coalesce(f, repeat('0', {2 * HEX})) AS f FROM t LEFT JOIN prints USING (doc_id, kind)),
near AS (SELECT q.doc_id, count(*) - 1 AS n_within FROM p q JOIN p c ON q.kind = 0 AND c.kind = 0 AND q.doc_id % {EVERY} = 0 AND {apart_('q.f', 'c.f')} <= {RADIUS} GROUP BY q.doc_id)
SELECT x.doc_id, x.n_chars, sha256(x.edited) AS edited_sha256, a.f AS fingerprint, b.f AS edited_fingerprint,
  1.0::DOUBLE - ({apart_('a.f', 'b.f')})::DOUBLE / {BITS}.0::DOUBLE AS near_edited, 1.0::DOUBLE - ({apart_('a.f', 'c.f')})::DOUBLE / {BITS}.0::DOUBLE AS near_next,
  near.n_within
FROM x JOIN p a ON a.doc_id = x.doc_id AND a.kind = 0 JOIN p b ON b.doc_id = x.doc_id AND b.kind = 1
JOIN p c ON c.doc_id = x.next_id AND c.kind = 0 LEFT JOIN near ON near.doc_id = x.doc_id
"""


ORACLE = _oracle()
