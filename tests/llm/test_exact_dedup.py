import hashlib
import random
from collections import defaultdict

from brute import tuples
from pyspark.sql import functions as F

from docpulse.llm.exact_dedup import OWN, exact_dedup


def plain(rows):
    same = defaultdict(list)
    for i, t in rows:
        same[t or ""].append(i)
    out = []
    for text, ids in same.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = False
        for i in ids:
            first = i == keep and not kept
            kept = kept or first
            out.append((i, keep, len(ids), first, sha))
    return sorted(map(repr, out))


def found(df):
    return tuples(df, "doc_id", *OWN)


def test_long_shared_beginnings(docs):
    r = random.Random(1)
    stem = "".join(r.choice("ab") for _ in range(30_000))
    texts = [stem[:n] + tail for n in (0, 5, 127, 128, 129, 384, 385, 2432, 20_000, 30_000) for tail in ("", "x", "y", "")]
    rows = list(enumerate(texts + ["é" * 500, "é" * 500, "é" * 501]))
    assert found(exact_dedup(docs(rows))) == plain(rows)


def test_small_steps(docs):
    r = random.Random(2)
    rows = [(i, "".join(r.choice("ab") for _ in range(r.randint(0, 9)))) for i in range(300)]
    assert found(exact_dedup(docs(rows), head=1, step=1, growth=2)) == plain(rows)


def test_nulls_ties_repeats_and_clashes(docs):
    rows = [(1, None), (2, ""), (None, "a"), (3, "a"), (4, "b"), (4, "b"), (5, "c"), (5, "d"), (None, "e"), (None, "e")]
    df = docs(rows, kept="clash", KEEP_ID="clash", group_size="clash")
    got = exact_dedup(df)
    assert found(got) == plain(rows)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", *OWN]
    assert got.filter("kept").groupBy(F.coalesce("text", F.lit(""))).count().filter("count > 1").count() == 0


def test_empty_table(docs):
    got = exact_dedup(docs([]))
    assert got.count() == 0 and set(OWN) < set(got.columns)
