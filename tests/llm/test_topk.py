import random

import pytest
from pyspark.sql import functions as F

from docpulse.llm.topk import sent_share, top_k, whole


def vectors(spark, rows):
    return spark.createDataFrame([(i, x, "clash", "clash") for i, x in rows], "vec_id long, embedding array<double>, score string, cell string").repartition(3)


def plain(rows, is_query, k):
    good = [(i, x) for i, x in rows if i is not None and x and all(c is not None and c == c and abs(c) < float("inf") for c in x)]
    out = []
    for q, a in good:
        if is_query(q):
            scores = sorted((-int(sum(s * t for s, t in zip(a, b))), i) for i, b in good if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("seed,dim,pivots,group", [(1, 2, 16, 4), (2, 8, 5, 1000), (3, 3, 1, 2)])
def test_random(spark, seed, dim, pivots, group):
    r = random.Random(seed)
    rows = [(i, [float(r.randint(-300, 300) + 2000 * (i % 3)) for _ in range(dim)]) for i in range(400)]
    rows += [(1000 + i, x) for i, x in rows[:40]]  # ties
    got = top_k(vectors(spark, rows), lambda c: c % 10 == 0, 5, pivots=pivots, group=group)
    assert found(got) == plain(rows, lambda i: i % 10 == 0, 5)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (10, None), (20, []), (30, [1.0, None]), (40, [nan, 1.0]), (50, [1.0, inf]), (60, [0.0, 0.0]),
            (7, [3.0, -1.0]), (8, [1.0]), (70, [2.0]), (None, [5.0, 5.0]), (90, [1e9, 3e9]), (9, [2e9, 1e9])]
    assert found(top_k(vectors(spark, rows), lambda c: c % 10 == 0, 5)) == plain(rows, lambda i: i % 10 == 0, 5)


def test_nothing_to_find(spark):
    for rows in ([], [(1, [1.0])], [(10, [1.0])]):
        assert found(top_k(vectors(spark, rows), lambda c: c % 10 == 0)) == []


def test_all_the_same(spark):
    rows = [(i, [4.0, 4.0, 4.0]) for i in range(60)]
    assert found(top_k(vectors(spark, rows), lambda c: c % 10 == 0, 3)) == plain(rows, lambda i: i % 10 == 0, 3)


def test_whole_components(spark):
    rows = [([0.5, -0.001, 1e30, float("nan"), float("inf"), None],), (None,)]
    got = spark.createDataFrame(rows, "x array<float>").select(whole(F.col("x")).alias("x")).collect()
    assert repr(got[0].x[:2]) == "[128.0, -1.0]" and got[0].x[2] > 1e32 and got[0].x[3] != got[0].x[3] and got[0].x[4] == float("inf")
    assert got[0].x[5] is None and got[1].x is None


@pytest.mark.parametrize("pivots", [2, 32])
def test_repeated_ids(spark, pivots):
    r = random.Random(4)
    rows = [(i % 80, [float(r.randint(-300, 300)) for _ in range(3)]) for i in range(160)]  # two vectors an id
    rows += [(10, [900.0, 900.0, 900.0 + i % 2]) for i in range(8)]  # of all the best for themselves
    rows += [(20, [1.0]), (21, [5.0]), (21, [5.0])]  # of another length
    scores = {}
    for q, a in rows:
        if q % 10 == 0:
            scores.setdefault(q, []).extend((-int(sum(s * t for s, t in zip(a, b))), i) for i, b in rows if i != q and len(a) == len(b))
    want = sorted((q, n + 1, i, -s) for q, found_ in scores.items() for n, (s, i) in enumerate(sorted(found_)[:5]))
    assert found(top_k(vectors(spark, rows), lambda c: c % 10 == 0, 5, pivots=pivots)) == want


def clustered(seed, centres, dim, rows):
    r = random.Random(seed)
    at = [[r.gauss(0, 1000) for _ in range(dim)] for _ in range(centres)]
    return [(i, [float(round(c + r.gauss(0, 20))) for c in at[i % centres]]) for i in range(rows)]


def test_cells_are_ruled_out(spark):
    rows = clustered(5, 40, 16, 2000)
    df = vectors(spark, rows)
    assert sent_share(df, lambda c: c % 10 == 0) < 0.5  # fewer pivots than clusters
    assert sent_share(df, lambda c: c % 10 == 0, pivots=200) < 0.2
    assert found(top_k(df, lambda c: c % 10 == 0, 5)) == plain(rows, lambda i: i % 10 == 0, 5)


def test_one_crowded_cell(spark, monkeypatch):
    from docpulse.llm import topk
    monkeypatch.setattr(topk, "PIECE", 64)  # cells of many pieces, blocks of few queries
    rows = clustered(6, 3, 4, 600) + [(1000 + i, [40000.0, 1.0, 1.0, float(i)]) for i in range(100)]  # two widths
    assert found(top_k(vectors(spark, rows), lambda c: c % 10 == 0, 5, pivots=2, group=7)) == plain(rows, lambda i: i % 10 == 0, 5)
