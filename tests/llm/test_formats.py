"""Archives, pages, token files and vectors: exact round trips and brute force."""

import gzip
import io
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from cleanroll.llm import ans, html, rabitq, warc
from cleanroll.llm.queries import ORACLES, QUERIES, WORD_BPE
from standins.compare import connect, oracle_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_an_oracle(spark, name):
    names, rows = spark_rows(QUERIES[name](spark, SF))
    want_names, want = oracle_rows(connect(SF), ORACLES[name])
    assert names == want_names and rows == want and rows


def test_archive(spark):
    long = "é<p>\r\n\r\nWARC/1.1\r\n" * 5000
    rows = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, long), (4, "http://c d/", long), (5, "u", None), (6, "u", ""), (None, "n", "same"), (7, "x", "own"), (7, "x", "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as payload", "1 as sha")
    got = sorted(((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to, r.payload and bytes(r.payload)) for r in warc.archived(pages, payloads=True).collect()), key=repr)
    n = len(long.encode())
    want = [
        (0, 4, "revisit", 2, None), (1, 4, "revisit", 2, None), (2, 4, "response", None, b"same"), (3, n, "revisit", 4, None), (4, n, "response", None, long.encode()),
        (5, 0, "revisit", 6, None), (6, 0, "response", None, b""), (7, 3, "response", None, b"own"), (7, 3, "response", None, b"own"),
    ]
    assert got == sorted(want, key=repr)
    assert warc.archived(pages.limit(0)).count() == 0


def test_framing():
    for size in (0, 1, 4095, 4096, 4097, 20000):
        payload = bytes(range(256)) * 80
        assert warc.unchunked(warc.chunked(payload[:size])) == payload[:size]
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc")
    records = list(warc.records_of(1, "u", b"x" * 50000, warc.digest_of(b"x" * 50000), None, "k"))
    assert len(records) > 3
    parsed = list(warc.parsed(b"".join(r + warc.END for r in records)))
    assert [int(f["WARC-Segment-Number"]) for f, _ in parsed] == list(range(1, len(records) + 1))
    assert int(parsed[-1][0]["WARC-Segment-Total-Length"]) == sum(len(b) for _, b in parsed)


def test_archives_of_several_members(spark, tmp_path, monkeypatch):
    """Files with a gzip member for each record, as crawlers write them, lose no record; cut ones are an error."""
    pages = [(n, b"page %d " % n * (n * 700)) for n in range(1, 12)]
    records = [[r + warc.END for r in warc.records_of(n, f"http://x/{n}", p, warc.digest_of(p), None, str(n))] for n, p in pages]
    for name, some in (("a", records[:6]), ("b", records[6:])):
        (tmp_path / f"{name}.warc.gz").write_bytes(b"".join(gzip.compress(r) for page in some for r in page))
    monkeypatch.setattr(warc, "BATCH", 20_000)
    got = warc.read_archive(spark, str(tmp_path)).collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in got) == pages
    assert warc.read_records(spark, str(tmp_path)).count() == sum(map(len, records)) > len(pages)
    many = b"".join(gzip.compress(records[0][0]) for _ in range(20_000))  # work in proportion to the file
    assert sum(1 for _ in warc.parsed(gzip.GzipFile(fileobj=io.BytesIO(many)))) == 20_000
    for cut in (many[:-3], many[: len(many) // 2 + 5]):
        with pytest.raises((EOFError, ValueError)):
            list(warc.parsed(gzip.GzipFile(fileobj=io.BytesIO(cut))))


def test_missing_segment_is_found(spark):
    rows = [("o", 1, None, "response", 1, None, "d", "u", bytearray(b"ab")), ("o", 3, 6, "continuation", None, None, "", "u", bytearray(b"ef"))]
    with pytest.raises(Exception, match="segments are missing"):
        warc.reassembled(spark.createDataFrame(rows, warc.RECORD)).collect()


def test_pages(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><header>Top</header><nav><ul><li><a href=x>Menu</a></ul></nav><div class='ad'>Buy &amp; go</div>"
        "<article><h1>A  title&nbsp;&amp; more</h1><p>First   <b>bold</b> text<p>Second<br>line &lt;tag&gt;<script>var x='</p>';</script><aside>Side</aside><ul><li>Item</ul>"
        "<form><input><p>Send</p></form><p>Short.</article><div id='comments'><p>I disagree</p></div><footer>&copy; end</footer></body>"
    )
    flat = "<div>menu</div>" + "".join(f"<p>{'long sentence of the text ' * 8}{i}</p>" for i in range(6)) + "<div>x</div>" * 12
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "plain words only"), (5, "u", flat), (None, "u", "<p>unclosed <b>x"), (1, "u", page), (6, "u", "<nav>only menu</nav>")]
    got = {r.page_id: r for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text")).collect()}
    assert got[1].text == "A title & more\n\nFirst bold text\n\nSecond line <tag>\n\nItem\n\nShort."
    assert got[2].text == got[3].text == got[6].text == "" and got[2].url is None and got[1].n_chars == len(got[1].text)
    assert got[4].text == "plain words only" and got[None].text == "unclosed x"
    assert got[5].text.count("long sentence") == 48
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


BODY = "".join(f"<p>{'a sentence of the post ' * 8}{i}</p>" for i in range(5))
POST = "\n\n".join(f"{'a sentence of the post ' * 8}{i}" for i in range(5))
AROUND = "<nav><a>Menu</a></nav>{}<div id='comments'><p>I disagree</p></div><footer>end</footer>"


@pytest.mark.parametrize("page", [
    f"<article class='post comments-open'>{BODY}</article>", f"<div id='content' class='with-sidebar'><article>{BODY}</article></div>",
    f"<div id='content' class='with-sidebar'>{BODY}</div>", f"<main class='has-banner'>{BODY}</main>", f"<form id='aspnet'><div class='ad'>Buy</div><article>{BODY}</article></form>",
    f"<form><div>{BODY}</div><form class='search'><input></form>", f"<div class='page has-menu'><main><div class='share'>Tell</div>{BODY}</main></div>",
    f"<article>{BODY}</article><div class='comments'><article class='comment'><p>{'I disagree with it ' * 9}</p></article></div>",
])
def test_marked_elements_that_hold_the_content_stay(page):
    assert html.main_text(f"<html><body>{AROUND.format(page)}</body></html>") == POST


def test_marked_elements_without_it_go():
    assert html.main_text("<form><p>Send</p></form><nav>x</nav><div hidden><main>" + BODY + "</main></div><p>" + "left over " * 9) == ("left over " * 9).strip()
    assert html.main_text("<article class='post comments-open'><p>Short.</article><form>x</form>") == "Short."


def test_ratio_finds_the_text_of_pages_without_article():
    """By words, against the same pages with their article tags."""
    right = kept = whole = 0
    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column(0).to_pylist():
        want, got = (Counter(html.main_text(x).split()) for x in (page, re.sub(r"</?article\b[^>]*>", "", page)))
        right, kept, whole = right + (got & want).total(), kept + got.total(), whole + want.total()
    assert right > 0.98 * kept and right > 0.95 * whole


@pytest.mark.parametrize("n", [1, 511, 513, 70_000, 140_000])
def test_blocks_round_trip(n):
    g = np.random.default_rng(n)
    ids = np.minimum(g.zipf(1.2, n) - 1, 40_000).astype(np.uint16)
    table = ans.Table(np.bincount(ids, minlength=49408))
    raw = ans.encode_block(ids, table)
    assert (ans.decode_block(raw, table) == ids).all()
    marks = ans.HEADER.unpack_from(raw)[3]
    assert (np.concatenate([ans.decode_block(raw, table, k, k + 1) for k in range(marks)]) == ids).all()
    damaged = bytearray(raw)
    damaged[-1] ^= 1
    if n > 1000:
        with pytest.raises((ValueError, IndexError)):
            ans.decode_block(bytes(damaged), table)


def test_token_files(spark):
    rows = [(3, "some words here"), (1, None), (2, ""), (7, "many words " * 4000), (5, "Ünï — 'quoted'"), (5, "Ünï — 'quoted'")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "'x' as start")
    plain, start = Tokenizer.from_file(WORD_BPE), 0
    got = sorted(tuple(r) for r in ans.stored(docs, WORD_BPE).collect())
    want = []
    for d, t in sorted(rows, key=lambda r: r[0]):
        ids = np.array(plain.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == sorted(want)
    assert ans.stored(docs.limit(0), WORD_BPE).count() == 0


def test_nearest(spark):
    g = np.random.default_rng(0)
    vectors = g.normal(size=(1500, 40)).astype(np.float32)
    vectors[100:160] = vectors[20]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(2000, None), (2020, [0.0] * 40), (2040, [math.nan] * 40), (2060, [1.0, None] + [0.0] * 38), (2080, [1.0] * 3), (None, vectors[3].tolist()), (40, vectors[40].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as code", "2 as score")
    indexed = rabitq.index(table)
    found = rabitq.search(indexed, indexed.where("vec_id % 20 = 0"), code_rows=300, query_rows=30).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(by_query) == set(range(0, 1500, 20))
    wide, hit = np.vstack([vectors, vectors[40:41]]).astype(np.float64), 0
    ids = np.append(np.arange(1500), 40)
    for q, ranks in by_query.items():
        score = np.cumsum(wide * wide[q], axis=1)[:, -1]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        assert sorted(ranks) == list(range(1, 21))
        hit += sum(ranks[k + 1] == (ids[i], score[i]) for k, i in enumerate(order))
    assert hit >= 0.99 * 20 * len(by_query)
    assert rabitq.nearest(table.limit(0)).count() == 0
    assert rabitq.nearest(table.where("vec_id < 5")).count() == 4


def test_search_of_a_block_takes_sums_by_the_block_and_scores_few_in_order(monkeypatch):
    rng = np.random.default_rng(3)
    vectors = np.round(rng.normal(size=(3000, 20)), 1)  # many equal scores
    vectors[1::3] = vectors[::3]
    turn = rabitq.rotation(rabitq.padded(20))
    bits, norm, factor = rabitq.coded(vectors, turn)
    codes = np.ascontiguousarray(bits).view(np.uint64)
    cut = [rabitq.planes(q, turn) for q in vectors[:40]]
    sums = rabitq.sums_inside(rabitq.unpacked(codes), cut)
    counted = [sum(float(1 << b) * np.bitwise_count(codes & p[0][b]).sum(axis=1) for b in range(rabitq.QUERY_BITS)) for p in cut]
    assert (sums == np.array(counted)).all()
    scored, exact = [], rabitq.exact
    monkeypatch.setattr(rabitq, "exact", lambda v, q: scored.append(len(v)) or exact(v, q))
    ones, ids = np.bitwise_count(codes).sum(axis=1).astype(float), rng.permutation(3000)
    for k, query in enumerate(vectors[:40]):
        found, score = rabitq.best_of_block(ids[k], query, ids, vectors, codes, ones, norm, factor, turn, 20, cut[k], sums[k])
        all_of = exact(vectors, query)
        order = [i for i in np.lexsort((ids, -all_of)) if i != k][:20]
        assert found.tolist() == ids[order].tolist() and score.tolist() == all_of[order].tolist()
    assert max(scored) < 100
