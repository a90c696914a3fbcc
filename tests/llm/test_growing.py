"""Where documents go when a layout of shards grows."""

import random
from collections import Counter, defaultdict

import pytest

from docpulse.llm.resharding import OWN, capacities, op11_reshard, reshard
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def check_grown(rows, weights, grown):
    """Shares of the grown layout, and no more bytes moved than shards gain, but for half the documents at the cuts."""
    sizes = sorted(r.size for r in rows)
    slack = sum(sizes[-len(weights) - len(grown):]) / 2
    held, now, slots = Counter(), Counter(), defaultdict(list)
    for r in rows:
        held[r.shard] += r.size
        now[r.grown_shard] += r.size
        slots[r.shard].append(r.slot)
    want = capacities(sum(sizes), grown)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(abs(now[j] - c) <= slack for j, c in enumerate(want))
    moved = sum(r.size for r in rows if r.grown_shard != r.shard)
    assert abs(moved - sum(max(0, c - held[j]) for j, c in enumerate(want))) <= slack


@pytest.mark.parametrize("grown", [[1] * 5, [1, 2, 3], [1] * 2])
def test_grown_layout(spark, docs, grown):
    rnd = random.Random(len(grown))
    rows = [(i, "x" * int(rnd.paretovariate(1.3) * 5) + str(i)) for i in range(600)] + [(7, "copy")] * 9 + [(None, None), (1, None)]
    df, old = docs(rows), F.pmod("doc_id", F.lit(4))
    got = reshard(df, old, 3, [1] * 4, block_rows=20, grown=grown, keep=["grown_shard", "lang"])
    assert got.columns == ["doc_id", "lang", *OWN, "grown_shard"]
    found = got.collect()
    check_grown(found, [1] * 4, grown)
    plain = reshard(df, old, 3, [1] * 4, block_rows=20).collect()
    assert Counter((r.doc_id, r.size, r.old_shard, r.shard, r.slot) for r in plain) == Counter((r.doc_id, r.size, r.old_shard, r.shard, r.slot) for r in found)
    assert reshard(df.limit(0), old, 3, [1] * 4, grown=grown).count() == 0
    with pytest.raises(ValueError):
        reshard(df, old, 3, [1] * 4, grown=[1, 0])


def test_query_has_the_grown_shard(spark):
    rows = op11_reshard(spark, SF).collect()
    assert all(r.grown_shard is not None for r in rows)
    check_grown(rows, [1] * 8, [1] * 9)
