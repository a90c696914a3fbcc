import random

import pytest
from brute import tuples, without_repeats as plain
from pyspark.sql import functions as F

from docpulse.llm import suffix_dedup
from docpulse.llm.suffix_dedup import anchors, interval_tree, maximal_repeats, repeat_spans, without_repeats

import numpy as np


def digest(df):
    return tuples(df.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("removed"),
                            F.size("spans").alias("n"), F.sha2("kept", 256).alias("sha")), "doc_id", "n_bytes", "removed", "n", "sha")


def wanted(rows, least):
    return sorted(map(repr, plain(rows, least)))


def edited(seed, n, alphabet="abcdé \n"):
    """Texts of copied, cut and edited passages, so that repeats overlap in many ways."""
    r = random.Random(seed)
    base = ["".join(r.choice(alphabet) for _ in range(r.randint(1, 160))) for _ in range(5)]
    out = []
    for _ in range(n):
        text = ""
        for _ in range(r.randint(0, 3)):
            part = r.choice(base)
            a, b = sorted((r.randint(0, len(part)), r.randint(0, len(part))))
            part = list(part[a:b] if r.random() < 0.6 else part)
            for _ in range(r.choice((0, 0, 1, 2))):
                if part:
                    part[r.randrange(len(part))] = r.choice(alphabet)
            text += "".join(part)
        out.append(text)
    return out


@pytest.mark.parametrize("seed,n", [(1, 40), (2, 150)])
def test_random_texts(docs, seed, n):
    rows = list(enumerate(edited(seed, n)))
    assert digest(without_repeats(docs(rows), least=24, k=6)) == wanted(rows, 24)


def test_crowded_buckets(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET", 3)
    rows = list(enumerate(edited(3, 80)))
    assert digest(without_repeats(docs(rows), least=24, k=6)) == wanted(rows, 24)


def test_edge_cases(docs):
    rows = [(1, None), (2, ""), (3, "x" * 399), (4, "ab" * 3000), (5, "y" * 400), (6, "y" * 401), (None, "q" * 500),
            (7, "same " * 90), (7, "same " * 90), (8, "é" * 300)]
    assert digest(without_repeats(docs(rows, first="clash", spans="clash"))) == wanted(rows, 400)


def test_empty_table(docs):
    assert without_repeats(docs([])).count() == 0


def test_groups_hold_all_occurrences(docs):
    shared = "".join(random.Random(5).choice("abcdefgh") for _ in range(450))
    rows = [(i, f"{i}" * 30 + shared + f"{i * 7}" * 40) for i in range(6)]
    spans = repeat_spans(docs(rows)).toPandas()
    assert (spans.end - spans["first"]).min() >= 400
    assert spans.groupby("group").id.nunique().max() == 6


def test_interval_tree():
    words = sorted(["aab", "aac", "ab", "b", "ba", "ba"])
    lcp = [0] + [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(words, words[1:])]
    assert sorted(interval_tree(lcp)) == [(1, 0, 3), (1, 3, 6), (2, 0, 2), (2, 4, 6)]


def test_left_extension_parts_the_occurrences():
    entries = maximal_repeats([(b"xx1", b"abcd1"), (b"xx2", b"abcd2"), (b"yy", b"abcd3")], least=4)
    assert [[e[:2] for e in own] for own in entries] == [[(2, 4)], [(2, 4)], [(0, 4)]]
    assert entries[0][0][2] == entries[1][0][2] != entries[2][0][2]


def test_equal_windows_have_equal_anchors():
    text = np.frombuffer(bytes(random.Random(2).choices(b"ab", k=3000)), np.uint8)
    copy = np.concatenate([text[:50][::-1], text[700:1500]])
    found = {}
    for name, data, shift in (("a", text, 0), ("b", copy, 650)):
        place, first, last, _ = anchors(data, 100, 20)
        found[name] = {int(p) + shift: int(q) + shift for q, a, b in zip(place, first, last) for p in range(a, b + 1)}
    assert all(found["a"][p] == found["b"][p] for p in range(700, 1400))
