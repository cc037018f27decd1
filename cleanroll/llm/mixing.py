"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cleanroll.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """`source, source_size, target` of rows `source, size`.

    A target is the weight times one level, or `most` times its source if that is less; the level is such that the
    targets add up to `share` of all sizes. Resharing an excess by weight until none is above ends at the same level.
    With sources in order of `most * size / weight`, those before the first one that the level of the rest does not
    exceed are full. One row a source is ordered here, after sizes were summed by source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = by_source.withColumn("weight", weight).withColumn("most", most * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = share * F.sum("source_size").over(whole)
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level)
    holds = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    shared = F.max(holds).over(whole)  # levels fall from there on
    target = F.coalesce(F.least(F.col("most"), F.col("weight") * F.col("shared")), F.col("most"))
    return levels.withColumn("shared", shared).select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """`docs` plus `size, source_size, target, copies`: a document is emitted `copies` times.

    copies is floor(rate), rate = target / source size, plus one if a number in [0, 1) made of the MD5 of the seed and
    doc_id (the text, where doc_id is null) is below the fraction: the same in every run. A null text has size 0; a null
    source is a source of its own, last in order; a source without words has target 0. Rows that repeat a doc_id draw
    the same number. An empty table stays empty. The staged targets are broadcast by Spark where their size on disk is
    below its threshold, and joined through a shuffle, a hot source split, where it is not.
    """
    taken = {"size", "source_size", "target", "copies", "_mixed_source"} & set(docs.columns)
    docs = docs.drop(*taken)
    sized = docs.withColumn("size", n_words(F.col("text")))
    targets = stage(source_targets(sized.select("source", "size"), weights, share, most), "targets").withColumnRenamed(
        "source", "_mixed_source"
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    copies = F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("_mixed_source")), "left").drop("_mixed_source")
    return joined.withColumn("copies", copies.cast("int"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of `docs` as often as it is taken, with the columns of `docs`."""
    columns = docs.columns
    rows = mix(docs, **options).where(F.col("copies") > 0)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*[F.col(f"`{c}`") for c in columns])


ORACLE = r"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
  2.0::DOUBLE * source_size AS most FROM by_source),
levels AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
    - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
targets AS (SELECT source, source_size,
  coalesce(least(most, weight * max(CASE WHEN level * weight <= most THEN level END) OVER ()), most) AS target FROM levels),
drawn AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
  ('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM drawn
"""
