import pandas as pd
import pytest

from docpulse.llm.mixing import mix, sainte_lague
from pyspark.sql import functions as F


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string, size string, target string").repartition(3)


def goals(sizes):
    """Targets by sharing the excess again until no source is above three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        rest, weights = total - sum(fixed.values()), sum(weight[s] for s in open_)
        share = {s: weight[s] * rest / weights for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in above}


@pytest.mark.parametrize("counts", [{"a": 900, "b": 20, "c": 3, None: 40, "é": 1, "Z": 300}, {"x": 50}, {"a": 4000, "b": 1, "c": 1}])
def test_targets_and_takes(spark, counts):
    rows, n = [], 0
    for source, count in counts.items():
        for _ in range(count):
            rows.append((n, source, " w" * (1 + n * 37 % 400), "clash", "clash"))
            n += 1
    got = mix(table(spark, rows), shard_rows=100).toPandas()
    again = mix(table(spark, rows), shard_rows=100).toPandas()
    order = lambda d: d.sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(again))
    assert (got.taken <= 3 * got["size"]).all() and (got.taken >= 0).all() and len(got) == n
    by = got.assign(source=got.source.where(got.source.notna(), None)).groupby("source", dropna=False)
    sizes = {None if pd.isna(s) else s: int(v) for s, v in by["size"].sum().items()}
    wanted = goals(sizes)
    for s, rows_ in by:
        s = None if pd.isna(s) else s
        assert rows_.target.iloc[0] == pytest.approx(wanted[s]) and rows_.source_size.iloc[0] == sizes[s]
        assert rows_.taken.sum() == pytest.approx(wanted[s], abs=64 + 0.01 * wanted[s])


def test_nulls_empty_and_repeated(spark):
    rows = [(1, None, None, "", ""), (2, None, "", "", ""), (3, "a", "x y", "", ""), (3, "a", "x y", "", ""), (None, "b", "z " * 5000, "", "")]
    got = mix(table(spark, rows)).toPandas()
    assert len(got) == 5 and got[got["size"] == 0].taken.sum() == 0
    assert got[got.source.isna()].target.eq(0).all()


def test_no_words_and_no_rows(spark):
    assert mix(table(spark, [(1, "a", " ", "", "")])).collect()[0].taken == 0
    assert mix(table(spark, [])).count() == 0


def test_sainte_lague_by_hand(spark):
    rows = spark.createDataFrame([("a", 53_000), ("b", 24_000), ("c", 23_000), ("d", 10)], "p string, v long").withColumn("g", F.lit(1))
    for seats in (0, 1, 2, 3, 7, 10, 100):
        got = {r.p: r.quota for r in sainte_lague(rows, ["g"], "v", F.lit(seats), ["p"]).collect()}
        want = dict.fromkeys("abcd", 0)
        votes = {"a": 53_000, "b": 24_000, "c": 23_000, "d": 10}
        for _ in range(seats):
            want[max(votes, key=lambda p: votes[p] / (2 * want[p] + 1))] += 1
        assert got == want
