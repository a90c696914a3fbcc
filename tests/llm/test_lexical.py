"""Lexical search against the scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from docpulse.llm import lexical
from docpulse.llm.lexical import Queries, _Best, search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    counts = [(i, Counter(words(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    documents, size = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item in dict.fromkeys(i for i, _ in items):
        scored = []
        for text in [t for i, t in items if i == item]:
            for i, c, n in counts:
                m = 25 + 75 * n * documents // size
                s = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in words(text) if t in c)
                if s > 0:
                    scored.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(repr, out))


def found(df):
    return sorted(repr(tuple(r)) for r in df.collect())


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def random_texts(seed, n, kinds=80):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(kinds)] + ["Éa", "éa", "ÄB", "日本"]
    return [(i, " ".join(rnd.choice(vocabulary[:rnd.randint(3, len(vocabulary))]) for _ in range(rnd.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("width", [1, 8, 4096])
def test_every_width_gives_the_same(spark, docs, items, width):
    rows, asked = random_texts(1, 400), random_texts(2, 12)
    assert found(search(docs(rows), items(asked), width=width)) == brute(rows, asked)


def test_blocks_batches_and_parts(spark, docs, items, monkeypatch):
    for name, value in (("ITEMS", 3), ("BATCH", 5), ("PIECE", 7), ("PASS", 40)):
        monkeypatch.setattr(lexical, name, value)
    rows, asked = random_texts(3, 150), random_texts(4, 10)
    assert found(search(docs(rows), items(asked), k=4)) == brute(rows, asked, 4)


def test_odd_rows(spark, docs, items):
    copies = [(50 - i, "same words here") for i in range(30)]
    rows = [*copies, (None, "same words here"), (1, None), (2, ""), (3, " \t.,;"), (4, "rare " + "many " * 300_000), (5, "x" * 500_000),
            (6, "many MANY mañana\x00mañana"), (6, "many other words"), (6, "many other words")]
    asked = [(1, "same"), (2, "many mañana many"), (3, None), (4, ""), (5, "absent"), (None, "rare words"), (7, "x" * 500_000), (1, "same here"), (8, "MAÑANA maÑana")]
    df = docs(rows, rank="1", score="2", item_id="3")
    assert found(search(df, items(asked))) == brute(rows, asked)
    assert search(df.limit(0), items(asked)).count() == 0 and search(df, items([])).count() == 0
    common = [(i, "the") for i in range(9)]  # a term of all documents weighs next to nothing
    assert found(search(docs(common), items([(1, "the")]))) == brute(common, [(1, "the")])


def test_bounds_hold_and_spare_most_documents():
    rnd = random.Random(5)
    texts = [" ".join(f"t{int(rnd.paretovariate(0.6))}" for _ in range(80)).encode() for _ in range(1_280)]
    block = Queries([(0, b" ".join(b"t%d" % int(rnd.paretovariate(0.4)) for _ in range(30)))])
    df = Counter(block.terms[t] for text in texts for t in set(text.split()) if t in block.terms)
    block.weigh(df, len(texts), 1024)
    best, m = _Best(block, 10), 100
    for start in range(0, len(texts), 128):
        sketches, impacts = np.zeros((128, 1024)), []
        for row, text in enumerate(texts[start:start + 128]):
            counts = Counter(text.split())
            for t, tf in counts.items():
                at = lexical.crc32(t) % 1024
                sketches[row, at] = max(sketches[row, at], 10**9 * tf // (1000 * tf + 8 * m))
            impacts.append({block.terms[t]: 10**9 * tf // (1000 * tf + 8 * m) for t, tf in counts.items() if t in block.terms})
        at, weights = block.own[0]
        exact = [sum(w * own.get(t, 0) for t, w in zip(at.tolist(), weights.tolist())) for own in impacts]
        assert all(b >= e for b, e in zip((sketches[:, block.looked_up] @ block.matrix)[:, 0], exact))
        best.take(list(range(start, start + 128)), sketches, impacts)
    assert best.scored < len(texts) / 3
