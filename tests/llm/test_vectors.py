import hashlib
import math
import random

import pytest

from cleanroll.llm import codebooks, negatives

VECTORS = "vec_id long, embedding array<float>, label int, code string"


def by_rounds(rows, rounds=codebooks.ROUNDS):
    """Codes, errors and entries of (vec_id, vector, label) by the plain rule."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max(1, -(-max(len(r[1]) for r in kept) // 4))
    parts = []
    for _, vector, _ in kept:
        whole = [math.floor(1024 * x) for x in vector] + [0] * (4 * width - len(vector))
        parts.append([tuple(whole[p * width : (p + 1) * width]) for p in range(4)])
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, [math.floor(1024 * x) for x in kept[i][1]]))
    books = [[parts[i][p] for i in order[:256]] for p in range(4)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assigned():
        return [[min(range(len(books[p])), key=lambda e: (far(x[p], books[p][e]), e)) for p in range(4)] for x in parts]

    for _ in range(rounds):
        codes = assigned()
        for p in range(4):
            for e in range(len(books[p])):
                mine = [x[p] for x, c in zip(parts, codes, strict=True) if c[p] == e]
                if mine:
                    books[p][e] = tuple(sum(v) // len(mine) for v in zip(*mine, strict=True))
    codes = assigned()
    errors = [sum(far(x[p], books[p][c[p]]) for p in range(4)) for x, c in zip(parts, codes, strict=True)]
    digest = hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()
    totals = {}
    for (_, _, label), error in zip(kept, errors, strict=True):
        totals[label] = totals.get(label, 0) + error
    return [(r[0], r[2], "".join(f"{e:02x}" for e in c), error, totals[r[2]], digest) for r, c, error in zip(kept, codes, errors, strict=True)]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "mine") for r in rows], VECTORS)


def coded(df):
    return sorted(tuple(r) for r in df.select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256").collect())


def test_codes_by_brute_force(spark):
    draw = random.Random(5)
    centres = [[draw.gauss(0, 0.3) for _ in range(12)] for _ in range(9)]
    rows = [(i * 3 % 1000, [c + draw.gauss(0, 0.1) for c in centres[draw.randrange(9)]], draw.choice([0, 1, 1])) for i in range(700)]
    rows += [(2000, [0.5] * 12, None)] * 30  # repeated rows
    rows += [(3000 + i, [float(j % 2) for j in range(12)], None) for i in range(20)]  # equal vectors
    rows += [(4000, None, 1), (4001, [math.nan] * 12, 1), (4002, [None] + [0.1] * 11, 1), (4003, [math.inf] * 12, 1)]
    df = codebooks.quantise(vectors(spark, rows).repartition(5))
    assert coded(df.na.fill(-1, ["label"])) == sorted((i, -1 if label is None else label, *rest) for i, label, *rest in by_rounds(rows))


@pytest.mark.parametrize("bounds", [1, 200])
def test_the_number_of_bounds_changes_nothing(spark, bounds):
    draw = random.Random(6)
    rows = [(i, [draw.choice([0.0, 0.25, 0.5]) for _ in range(8)], 0) for i in range(300)]
    assert coded(codebooks.quantise(vectors(spark, rows), bounds)) == sorted(by_rounds(rows))


def test_few_rows_and_uneven_vectors(spark):
    one = [(7, [0.1, -0.2, 0.3], None)]
    assert [tuple(r) for r in codebooks.quantise(vectors(spark, one)).collect()] == by_rounds(one)
    some = [(1, [0.5, 1.0, -1.0, 2.0, 0.25], 3), (2, [0.5], 3), (3, [], 4)]
    assert coded(codebooks.quantise(vectors(spark, some))) == sorted(by_rounds(some))
    assert codebooks.quantise(vectors(spark, [])).count() == 0
    assert codebooks.quantise(vectors(spark, [(1, None, 1)])).count() == 0


def test_components_beyond_exact_distances(spark):
    with pytest.raises(ValueError, match="too large"):
        codebooks.quantise(vectors(spark, [(1, [1e9] * 8, 0)]))


def test_bounds_hold_while_entries_move():
    import numpy as np

    draw = np.random.default_rng(3)
    x = np.floor(1024 * draw.normal(0, 0.2, (400, 6)))
    entries = x[:64].copy()
    bound = codebooks.Bounds.searched(x, entries, 8)
    for step in range(6):
        moved = np.floor(entries + draw.normal(0, 60 / (step + 1), entries.shape))
        bound.moved(np.sqrt(((moved - entries) ** 2).sum(axis=1)))
        entries = moved
        used = bound.assign(x, entries)
        exact = codebooks.distances(x, entries)
        assert (bound.code == exact.argmin(axis=1)).all()
        at = lambda c: np.sqrt(np.take_along_axis(exact, c.astype(int), axis=1))
        assert (bound.upper + 1e-6 >= at(bound.code[:, None])[:, 0]).all() and (bound.lower <= at(bound.near) + 1e-6).all()
        rest = exact.copy()
        np.put_along_axis(rest, np.concatenate([bound.code[:, None], bound.near], axis=1).astype(int), np.inf, axis=1)
        assert (bound.outer <= np.sqrt(rest.min(axis=1)) + 1e-6).all()
    assert (used == 0).any() and (used > 0).any()


def by_pairs(rows):
    """Hard negatives of (vec_id, vector, label) from all inner products."""
    kept = []
    for i, vector, label in rows:
        if i is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((i, [math.floor(256 * x) for x in vector], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for place, (anchor, x, label) in enumerate(kept):
        if anchor % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i, other) for n, (i, y, other) in enumerate(kept) if n != place)  # noqa: B905
        for minus, positive, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and 30 * -minus <= 100 * -s[0] <= 90 * -minus][:10]
            out += [(anchor, positive, rank, i, -minus, -score) for rank, (score, i, _) in enumerate(inside, 1)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.fixture(scope="module")
def mixed():
    draw = random.Random(8)
    centres = [[draw.gauss(0, 0.5) for _ in range(6)] for _ in range(8)]
    rows = [(i, [c + draw.gauss(0, 0.15) for c in draw.choice(centres)], draw.choice([0, 1, 1, 2])) for i in range(0, 2400, 3)]
    rows += [(5000 + i, [0.25] * 6, 9) for i in range(120)]  # one vector in many rows: ties
    rows += [(5200, [0.0] * 6, 1), (5300, [0.5], 1), (5301, [], 2), (5400, [-0.3] * 8, 2)]
    rows += [(300, rows[5][1], 1), (300, rows[5][1], 1), (4, rows[5][1], 2)]  # repeated ids and rows
    rows += [(None, [0.1] * 6, 1), (6000, None, 1), (6100, [0.1] * 6, None), (6200, [math.nan] * 6, 1), (6300, [None] * 6, 1), (6400, [math.inf] * 6, 1)]
    return rows


def test_negatives_by_brute_force(spark, mixed):
    assert mined(negatives.mine(vectors(spark, mixed).repartition(3))) == by_pairs(mixed)


def test_negatives_over_blocks_tiles_and_clusters(spark, mixed, monkeypatch):
    for name, value in {"BLOCK_ROWS": 150, "TILE_ROWS": 7, "CLUSTER_ROWS": 3, "STEP": 16}.items():
        monkeypatch.setattr(negatives, name, value)
    assert mined(negatives.mine(vectors(spark, mixed).repartition(3))) == by_pairs(mixed)


def test_walks_end_before_the_list_does(monkeypatch):
    import numpy as np
    import pandas as pd

    draw = np.random.default_rng(2)
    near, far = draw.normal(0, 5, (40, 8)) + 100, draw.normal(0, 5, (4000, 8)) * [1, -1, 1, -1, 1, -1, 1, -1] + np.tile([100, -100], 4)
    x = np.rint(np.concatenate([near, far])).astype("<i4")
    norm = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    block = pd.DataFrame({"serial": np.arange(len(x)), "vec_id": np.arange(len(x)), "label": 1, "x": [r.tobytes() for r in x], "norm": norm})
    asked = block[:4].assign(cluster=0, angle=0.05, low=[np.array([negatives.NONE + 1])] * 4, high=[np.array([-negatives.NONE])] * 4)
    steps = []
    monkeypatch.setattr(negatives.Wanted, "take", lambda self, live, scores, *rest, take=negatives.Wanted.take: (steps.append(scores.size), take(self, live, scores, *rest)))
    found = list(negatives.walk(asked, block, np.full((1, 8), 8**-0.5), 5, True))
    assert sum(len(f[0]) for f in found) == 20 and all((f[2] < 40).all() for f in found)
    assert sum(steps) == 4 * negatives.STEP  # of 4 x 4,040


def test_negatives_of_little(spark):
    assert negatives.mine(vectors(spark, [])).count() == 0
    assert negatives.mine(vectors(spark, [(1, [0.1], 1), (2, [0.2], 1)])).count() == 0
    assert negatives.mine(vectors(spark, [(100, [0.1], 1), (2, [0.2], 2)])).count() == 0
    with pytest.raises(Exception, match="too long"):
        negatives.mine(vectors(spark, [(100, [1e6] * 9, 1)]))
