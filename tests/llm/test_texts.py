"""Quality rules, licenses, mixing, lines, near-duplicates and packing against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from cleanroll.llm import licenses, lines, mixing, near, packing, quality, tokens
from cleanroll.llm.queries import BYTE_BPE, WORD_BPE
from cleanroll.llm.tokens import Encoder

ODD = [(1, None), (2, ""), (2, ""), (None, "alone"), (3, " \n\t ")]
rng = random.Random(5)
VOCAB = ["w" + "".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) + r.choice(["", "", "", ".", ","]) for _ in range(n))


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_encoder_gives_the_tokenizers_ids(path):
    r = random.Random(3)
    alphabet = "aBé É,.!  \n\t1 2'sx—ж\xa0́Σ<|>_-ﬁ"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(3000)] + ["", "Don't", "<|endoftext|> a", "  a \n\n b ", "x" * 5000, prose(300, 1)]
    plain = Tokenizer.from_file(path)
    for text, found in zip(texts, Encoder(path).encode(texts), strict=True):
        assert found.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


class Unused:
    def __getattr__(self, name):
        raise AssertionError("plain texts are split by their bytes")


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_plain_texts_are_split_together_and_distinct_units_looked_up(path, monkeypatch):
    r = random.Random(4)
    alphabet = "aaabBéÉßȍɏ,.!|_  \n\t12"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(2000)] + ["", " ", "a ", "", prose(300, 2)]
    odd = ["it's", "a×b", "a÷", "ɐɐ", "<|endoftext|>", "a\x1cb", "ж 1", "½", ""]
    mixed = [t for pair in zip(texts, odd * 250, strict=False) for t in pair]
    shape = tokens.SPACELESS if path == WORD_BPE else tokens.SPACED
    encoder = Encoder(path)
    given = [t.lower() for t in mixed] if encoder.folds else mixed
    units, at, plain = encoder._split(given)
    assert plain.tolist() == [not (tokens.PLAIN.search(t) or tokens.ODD.search(t)) for t in given]
    found = units.to_pylist()
    assert [found[a:b] for a, b in zip(at[:-1], at[1:], strict=True)] == [shape.findall(t) if p else [] for t, p in zip(given, plain, strict=True)]
    for name in ("UNIT", "ODD", "SPACED", "SPACELESS"):
        monkeypatch.setattr(tokens, name, Unused())
    asked = []
    one = encoder._unit_ids
    encoder._unit_ids = lambda units, **how: asked.extend(units) or one(units, **how)
    whole = Tokenizer.from_file(path)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(asked) == len(set(asked)) > 100
    assert encoder.model is not None


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_a_full_cache_changes_no_ids(path, monkeypatch):
    """Texts a few at a time, plain or not, with room for a few units: each new unit is worked out again."""
    monkeypatch.setattr(tokens, "CACHED_UNITS", 20)
    monkeypatch.setattr(tokens, "CHARS_AT_ONCE", 200)
    texts = [prose(k % 30, k) + ("", "", " it's", "\n")[k % 4] for k in range(300)] + [None, "", "a" * 100 + " b", "\n\n"]
    whole, encoder = Tokenizer.from_file(path), Encoder(path)
    found = list(encoder.encode(texts))
    assert [x.tolist() for x in found] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(encoder.cache) == 20


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_small_units_have_the_tokenizers_ids(path):
    """By the bare model, a line of units at a time: each letter, digit and mark, in runs, with and without a space before."""
    r, encoder = random.Random(5), Encoder(path)
    letters = [chr(c) for c in range(0x250) if chr(c).isalpha() and not tokens.PLAIN.search(chr(c))]
    marks = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27]
    units = letters + marks + list("0123456789") + ["".join(r.choice(kind) for _ in range(r.randint(2, 12))) for kind in (letters, marks, letters[:52]) for _ in range(1500)]
    units += [] if encoder.folds else [f" {u}" for u in units] + ["2024", " 007"]
    units = [u for u in units if encoder._small(u)]
    assert len(units) > 4000 and encoder._plain_ids(units) == encoder._ids(units)


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_encoder_keeps_capitals_whose_lower_case_is_not_plain(path):
    odd = [chr(c) for c in range(0x250) if chr(c).isupper() and any(ord(x) > 0x24F for x in chr(c).lower())]
    assert {"\u0130", "\u018f", "\u0181"} <= set(odd) and len(odd) == 24
    texts = ["\u0130stanbul \u0130zmir", "\u018fli \u0181ala", *odd, *[f"Plain {c}word, x{c}y 12 {c}{c}" for c in odd]]
    # Any other character whose lower case is plain, or is not what it was, among plain ones.
    texts += [f"ab {chr(c)}c d{chr(c)}" for c in range(0x10000) if chr(c).lower() != chr(c) or 0xC0 <= c < 0x250]
    plain = Tokenizer.from_file(path)
    for given in (texts, texts[::-1]):  # with and without units known from other texts
        for text, found in zip(given, Encoder(path).encode(given), strict=True):
            assert found.tolist() == plain.encode(text, add_special_tokens=False).ids, ascii(text)


def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(seen) - len(set(seen)), len(covered), failed


def test_quality(spark, documents):
    good = [(10 + i, prose(80, i)) for i in range(20)]
    bad = [(50 + i, " ".join(w.upper() + "%%%" for w in prose(80, 99 + i).split())) for i in range(6)]
    repeats = [(70, "one two three four " * 30), (71, "é é\n#a\n\n#a\n" + prose(60, 7)), (72, "a\x1cb\x85c " * 60)]
    rows = ODD + good + bad + repeats + [good[0]]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(50, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.assess(documents(rows), labels, keep=("doc_id", "text", "lang")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(r.text)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id for r in got if r.kept}
    assert {i for i, _ in good} <= kept and not kept & {i for i, _ in bad}
    # The ratio itself, from the same buckets counted plainly.
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for i, t in rows:
        for b in quality.hashed_ngrams(quality.words_of(t or ""), quality.BUCKETS) if (t or "").split() else []:
            raw[b] += 1
            target[b] += i in {x for x, _ in good}
    ratio = np.log((target + 5) / (raw * target.sum() / raw.sum() + 5))
    for r in got:
        if r.n_words:
            assert r.llr == pytest.approx(ratio[quality.hashed_ngrams(quality.words_of(r.text), quality.BUCKETS)].mean())


def test_quality_of_nothing(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.assess(documents([]), labels).count() == 0
    assert all(r.llr == 0 for r in quality.assess(documents([(1, prose(60, 1))]), labels).collect())


def test_licenses(documents):
    texts = [
        "Licensed under CC BY-NC 4.0. CC BY cc by", "GNU General Public License v3.0, or later; All Rights Reserved", "the Apache License, Version 2.0", None, "", "ÀCC BY é cc-by",
        "released under the MIT license. See LICENSE", "mit der ist", "Copyright (c) 2020 someone. " * 40, "general public license general public license", "x " * 5000 + "cc0 1.0",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[2])]
    table = str.maketrans(licenses.UPPER, licenses.LOWER)
    for r in licenses.scan(documents(rows).withColumnRenamed("size", "score")).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").translate(table))
        places, names = [], set()
        for phrase, label in licenses.BASE.items():
            want = phrase.split()
            hits = [i for i in range(len(words)) if words[i : i + len(want)] == want]
            places += hits
            names |= {label} if hits else set()
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(names)))
        norm = f" {' '.join(words)} "
        found = []
        if any(g in norm for g in licenses.GATE):
            for k, (keyword, pattern, label, n) in enumerate(licenses.RULES):
                if keyword in norm:
                    found += [(norm[: m.start()].count(" "), norm[: m.end()].count(" "), label, n, k) for m in re.finditer(f" {pattern}(?= )", norm)]
        beats = lambda e, d: e[0] <= d[0] and e[1] >= d[1] and (e[3] < d[3] or e[3] == d[3] and (e[1] - e[0] > d[1] - d[0] or e[4] < d[4]))
        left = [d for d in found if not any(beats(e, d) for e in found)]
        assert sorted(tuple(d) for d in r.detections) == sorted(left)
        assert r.labels == ",".join(sorted(names | {d[2] for d in left})) and 0 <= r.score <= 1
    assert len(licenses.RULES) > 200


def example(tree, r):
    """A text that a parsed pattern matches."""
    out = ""
    for op, of in tree:
        if str(op) == "LITERAL":
            out += chr(of)
        elif str(op) == "NOT_LITERAL":
            out += "z"
        elif str(op) == "SUBPATTERN":
            out += example(of[3], r)
        elif str(op) == "BRANCH":
            out += example(r.choice(of[1]), r)
        elif str(op) == "IN":
            kind, x = r.choice(of)
            out += chr(x) if str(kind) == "LITERAL" else chr(r.randint(*x))
        else:
            least, most, of = of
            out += "".join(example(of, r) for _ in range(r.randint(least, min(most, least + 2))))
    return out


def test_every_license_rule_is_reached(documents):
    r = random.Random(4)
    given = [(k, f"so {example(re._parser.parse(rule[1]), r)} end") for k, rule in enumerate(licenses.RULES) for _ in range(3)]
    given += [(None, t) for t in ("Attribution-ShareAlike 4.0 International", "GNU GFDL 1.3 or later", "you may not redistribute", "Permission to use, copy, modify, and distribute this software for any purpose", "Released under the terms of it", "available under the tree")]
    got = licenses.scan(documents(given)).collect()
    assert len(got) == len(given)
    beats = lambda e, d: e[0] <= d[0] and e[1] >= d[1] and (e[3] < d[3] or e[3] == d[3] and (e[1] - e[0] > d[1] - d[0] or e[4] < d[4]))
    for row in got:  # all patterns, without gate or keywords
        norm = f" {' '.join(re.findall('[0-9a-z]+', row.text.lower()))} "
        found = [
            (norm[: m.start()].count(" "), norm[: m.end()].count(" "), label, n, k)
            for k, (_, pattern, label, n) in enumerate(licenses.RULES) for m in re.finditer(f" {pattern}(?= )", norm)
        ]
        assert row.doc_id is None or row.doc_id in {d[4] for d in found}, row.text
        assert sorted(tuple(d) for d in row.detections) == sorted(d for d in found if not any(beats(e, d) for e in found)), row.text
        assert bool(row.labels) == bool(found) == (row.score > 0)
    assert [bool(x.labels) for x in sorted((x for x in got if x.doc_id is None), key=lambda x: [t for _, t in given].index(x.text))] == [True] * 5 + [False]


def test_mixing(documents):
    rows = [(i, prose(20 + i % 30, i), f"s{i % 4}") for i in range(400)] + [(900, None, None), (901, "a b c", None), (902, "", "zz"), (900, None, None)]
    got = mixing.mix(documents(rows)).collect()
    assert len(got) == len(rows) and all(r["size"] == len((r.text or "").split()) for r in got)
    sizes = Counter()
    for r in got:
        sizes[r.source] += r["size"]
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full: set = set()
    while True:  # reshare what is above by weight
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        level = left / sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    taken = Counter()
    for r in got:
        want = 2 * sizes[r.source] if r.source in full else level * weight[r.source]
        assert r.target == pytest.approx(want) and 0 <= r.copies <= 2
        taken[r.source] += r["size"] * r.copies
    for s in names:
        if sizes[s] > 1000:
            assert taken[s] == pytest.approx(level * weight[s] if s not in full else 2 * sizes[s], rel=0.2)
    again = {r.doc_id: r.copies for r in mixing.mix(documents(rows[::-1])).collect()}
    assert again == {r.doc_id: r.copies for r in got}
    mixed = mixing.mixed_documents(documents(rows))
    assert mixed.columns == documents([]).columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.mix(documents([])).count() == 0


def test_lines(documents):
    passage = "This sentence here has quite a few words in it. And one more sentence follows with words too."
    texts = {
        5: f"Own start of five.\n{passage}\nOwn end of five.", 3: f"First of all.\n{passage}\nLast of all.", 9: f"begin of nine. {passage} end of nine", 7: passage.upper().replace(".", " ."),
        4: "Short. Short. Short.", 6: f"{passage}\n{passage}", 8: None, 10: "", 11: "no repeat in this one at all",
    }
    rows = list(texts.items()) + [(None, passage), (3, texts[3])]
    got = defaultdict(list)
    for r in lines.dedup_lines(documents(rows)).collect():
        got[r.doc_id].append(r)
        cut = [texts.get(r.doc_id, passage)[s.start : s.end] for s in r.removed or []]
        assert all(c for c in cut)
    assert [r.text for r in got[3]] == [texts[3]] * 2  # the earliest keeps it, and so does its repeated row
    assert got[5][0].text == "Own start of five.\nOwn end of five." and got[9][0].text == "begin of nine. end of nine"
    assert got[6][0].text.strip() == "" and got[7][0].text.strip(" .") == ""
    assert got[4][0].text == texts[4] and got[11][0].text == texts[11] and got[None][0].text == passage
    assert got[8][0].text is None and got[10][0].text == ""
    assert lines.dedup_lines(documents([])).count() == 0
    assert lines.removed_spans(documents(rows)).count() == len(rows)


def test_a_separator_splits_no_run(documents):
    rows = [(1, "Six words stand in this line\n---\nand six more in that one"), (2, "Own.\nSix words stand in this line\n* * *\nand six more in that one\nEnd.")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(documents(rows)).collect()}
    assert got == {1: rows[0][1], 2: "Own.\nEnd."}


def bag(text):
    words = near.words_of(text)
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def test_near(documents):
    r = random.Random(1)
    rows, number = [], 0
    for c in range(12):
        base = prose(120, 500 + c).split()
        for k in range(8 if c else 40):
            words = list(base)
            for _ in range(k % 5):
                words[r.randrange(len(words))] = "changed" + str(r.randrange(999))
            rows.append((number, " ".join(words)))
            number += 1
    rows += [(number + i, prose(60, 900 + i)) for i in range(30)] + [(700, "tiny text"), (701, "Tiny, text!"), (702, "la la la la la la la la la"), (703, "la " * 9)]
    rows += [(None, rows[0][1]), (1, rows[1][1]), (800, None), (801, ""), (802, " . ")]
    docs = documents(rows).withColumnRenamed("size", "keeper")
    got = near.classes(docs).collect()
    assert len(got) == len(rows)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [bag(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    want = defaultdict(set)
    for i, (d, _) in enumerate(rows):
        want[root(i)].add(d)
    least = {d: min((x for x in group if x is not None), default=None) for group in want.values() for d in group}
    for row in got:
        assert row.class_id == least[row.doc_id] if row.doc_id is not None else row.class_id == least[0]
    kept = [x for x in got if x.keeper]
    assert len(kept) == len(want)
    assert near.classes(documents([])).count() == 0


def test_signatures_are_unbiased():
    g = np.random.default_rng(2)
    base = g.integers(0, 2**63, 150).astype(np.uint64)
    a, b = np.concatenate([base, base[:60], base[:30], base[:10]]), np.concatenate([base[40:], base[40:60], g.integers(0, 2**63, 20).astype(np.uint64)])
    s = near.signatures([a, b, a[::-1]], 6000)
    assert (s[0] == s[1]).mean() == pytest.approx(near.similarity(a, b), abs=0.02)
    assert (s[0] == s[2]).all()


def test_signatures_rule_out_no_similar_pair():
    for places, share in ((near.BANDS * near.ROWS, near.ESTIMATE), (near.LONG, near.LONG_ESTIMATE)):
        under = (k for k in range(places + 1) if k < share * places)
        assert sum(math.comb(places, k) * 4**k for k in under) / 5**places < 1e-7  # at similarity 0.8 = 4 / 5


def test_packing(documents):
    rows = ODD + [(10 + i, prose(5 + 40 * (i % 60), i)) for i in range(150)] + [(500, "word " * 9000), (10, prose(5, 0))]
    plain = Tokenizer.from_file(BYTE_BPE)
    packed = packing.pack_documents(documents(rows), BYTE_BPE, ids=True)
    got = packed.collect()
    want = defaultdict(list)
    for d, t in rows:
        want[d].append(plain.encode(t or "", add_special_tokens=False).ids + [0])
    total, places = 0, defaultdict(list)
    for r in got:
        total += r.length
        places[r.sequence_id].append((r.offset, r.length))
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(ids) == r.length <= 2048
        assert any(w[r.start : r.start + r.length] == ids for w in want[r.doc_id])
    assert total == sum(len(w) for ws in want.values() for w in ws)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.03 * math.ceil(total / 2048) + 1
    assert packing.sequences(packed).selectExpr("sum(n_tokens) as n", "max(octet_length(ids)) as m").first().n == total
    assert packing.pack_documents(documents([]), BYTE_BPE).count() == 0


def test_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 9, 4, 10, 1)] == [(0, 0), (1, 0), (2, 0), (0, 6), (3, 0), (2, 9)]


def test_bands_are_moved_once_and_rows_that_stay_are_not_looked_up(spark):
    from cleanroll.session import Stages

    nodes = spark.createDataFrame([(1, [1, 2]), (2, [1, 3]), (3, [9, 3]), (4, [8, 7])], "node long, _bands array<long>")
    members = near.band_members(nodes)
    assert sorted(map(tuple, members.select("b", "band", "node", "n").collect())) == [(0, 1, 1, 2), (0, 1, 2, 2), (1, 3, 2, 2), (1, 3, 3, 2)]
    assert members._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange") == 1
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(5, text), (3, text.upper()), (7, text[:-4]), (9, "of its own"), (None, "")], "doc_id long, text string").coalesce(1)
    staged = near.profiles(docs)
    with Stages(spark) as stages:
        assert sorted(map(tuple, near.decisions(stages, staged, 0.8).collect())) == [(0, 3), (2, 3)]
