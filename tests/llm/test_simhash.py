import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from cleanroll.llm import simhash
from cleanroll.session import stage


def print_of(text):
    """The fingerprint of a text by the plain rule, as a number of 90 bits."""
    words = set(re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)))
    digests = [(hashlib.md5(w.encode()).hexdigest(), min(8, len(w))) for w in words]
    halves = [[(int(d[:12], 16), w) for d, w in digests], [(int(d[12:24], 16), w) for d, w in digests]]
    won = lambda half, b: 2 * sum(w for h, w in half if h >> b & 1) > sum(w for _, w in half)
    return sum(1 << (45 * i + b) for i, half in enumerate(halves) for b in range(45) if won(half, b))


def expected(rows):
    """Results of (doc_id, text) with ids that differ."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0))
    mask, prints, out = (1 << 45) - 1, [print_of(t) for _, t in rows], []
    for n, (i, text) in enumerate(rows):
        cut, following = len(text) // 4, rows[(n + 1) % len(rows)][1]
        edited = text[: len(text) - cut] + following[:cut]
        mine, other = prints[n], print_of(edited)
        like = lambda a, b: round(1 - (a ^ b).bit_count() / 90, 9)
        close = sum((mine ^ p).bit_count() <= 4 for p in prints) - 1 if i is not None and i % 100 == 0 else None
        digits = [f"{p & mask:012x}{p >> 45:012x}" for p in (mine, other)]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *digits, like(mine, other), like(mine, prints[(n + 1) % len(rows)]), close))
    return sorted(out, key=repr)


def scanned(df):
    rows = df.withColumn("near_edited", F.round("near_edited", 9)).withColumn("near_next", F.round("near_next", 9)).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(4)
    words = [f"w{i:x}" * draw.randrange(1, 5) for i in range(400)] + ["É", "été", "日本", "𝒳y"]
    text = lambda n: " ".join(draw.choice(words) for _ in range(n))
    rows = [(i * 50, text(draw.randrange(1, 120))) for i in range(330)]
    copy = text(200)
    rows += [(100_000 + i * 100, copy) for i in range(40)]  # a group of copies
    rows += [(200_000 + i * 10, copy + f" tail{i}") for i in range(60)]  # and of near copies
    rows += [(300_000, None), (300_100, ""), (300_200, " \n\t"), (300_300, "abc"), (300_400, "ab cd"), (300_500, text(30_000)), (None, "the last one"), (-700, "first of all")]
    return rows


def test_scan_by_brute_force(spark, texts, documents, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK_ROWS", 16)
    monkeypatch.setattr(simhash, "SUPER", 4)
    assert scanned(simhash.scan(documents(texts).repartition(3))) == expected(texts)


def test_one_shuffle_of_the_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    dealt = simhash.chunked(simhash.whole_texts(docs))
    by_id = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.length("text")]
    lined = simhash.followed(dealt, by_id, stage(simhash.chunk_order(dealt), "chunks"), "text")
    pairs = lined.select("chunk", "place", F.concat("text", "following").alias("edited"))  # without doc_id, as the terms read it
    pairs.collect()
    final = pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    shuffles = [line for line in final.splitlines() if re.match(r"[\s:+*|-]*Exchange hashpartitioning\(chunk", line)]
    assert len(shuffles) == 1 and final.count("ReusedExchange") == 2


def test_repeated_ids_and_small_tables(spark, documents):
    assert simhash.scan(documents([])).count() == 0
    assert scanned(simhash.scan(documents([(100, "a lone document")]))) == expected([(100, "a lone document")])
    hot = [(7, f"text number {i} of an id that many rows share") for i in range(900)] + [(100 + i, f"another {i}") for i in range(600)]
    df = simhash.chunked(documents(hot))
    sizes = [r["count"] for r in df.groupBy("chunk").count().collect()]
    assert sum(sizes) == 1500 and max(sizes) < 500  # the id alone has 900
    span = df.groupBy("doc_id").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b")).orderBy("doc_id").collect()
    assert all(x.b <= y.a for x, y in zip(span, span[1:], strict=False))
    rows = simhash.scan(documents([(5, "x y z w")] * 3 + [(6, "other words")])).collect()
    assert len(rows) == 4 and len({r.fingerprint for r in rows if r.doc_id == 5}) == 1


def test_neighbours_at_every_radius(spark):
    draw = random.Random(1)
    base = [draw.getrandbits(90) for _ in range(5)]
    prints = [b ^ sum(1 << i for i in draw.sample(range(90), draw.randrange(0, 8))) for b in base for _ in range(60)] + base * 3
    mask = (1 << 45) - 1
    df = spark.createDataFrame([(p & mask, p >> 45) for p in prints], "f0 long, f1 long")
    for radius in (0, 2, 4):
        found = {(r.q0, r.q1): r.n for r in simhash.within(df, df, radius).collect()}
        assert found == {(p & mask, p >> 45): sum((p ^ q).bit_count() <= radius for q in prints) for p in prints}
    with pytest.raises(ValueError, match="radius"):
        simhash.within(df, df, 5)


def test_no_python_in_the_plan(spark, documents):
    plan = simhash.tallied(documents([(1, "a b")]).withColumn("edited", F.col("text")), ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow") if w in plan]
