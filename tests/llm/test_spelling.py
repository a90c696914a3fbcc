"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docpulse.llm.spelling import near_in_list, near_words, op13_spelling, variants, vocabulary
from docpulse.llm.common import table

SF = "/root/testdata/sf0.001"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_vocabulary(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def neighbours(counts):
    """By single deletions: words at one edit share a word with a letter less, or one is it."""
    lists, near = {}, {w: set() for w in counts}
    for w in counts:
        for p in {w[:k] + w[k + 1:] for k in range(len(w))} | {w}:
            lists.setdefault(p, []).append(w)
    for own in lists.values():
        for i, a in enumerate(own):
            for b in own[:i]:
                if b not in near[a] and abs(len(a) - len(b)) < 2 and edits(a, b) == 1:
                    near[a].add(b)
                    near[b].add(a)
    return near


def brute_variants(counts, near=None):
    near = near or neighbours(counts)
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", min_size=0, max_size=7), max_size=60))
def test_scan_of_a_list(words):
    words = sorted(words)
    expected = {(i, j) for j in range(len(words)) for i in range(j) if edits(words[i], words[j]) == 1}
    found = list(near_in_list(words))
    assert len(found) == len(set(found)) and set(found) == expected


@pytest.mark.parametrize("longest", [2, 7, 10_000])
def test_pairs_once_whatever_the_length_of_lists(spark, longest):
    rnd = random.Random(longest)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(7, 9))) for _ in range(600)} | {"z" * 7, "z" * 8, "aaaaaaa"}
    expected = sorted((min(a, b), max(a, b)) for a in words for b in words if a < b and edits(a, b) == 1)
    rows = near_words(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), longest).collect()
    assert sorted((min(r.a, r.b), max(r.a, r.b)) for r in rows) == expected


def test_short_and_very_long_words(spark):
    words = ["a", "b", "ab", "abc", "x" * 50_000, "x" * 50_001, "x" * 49_999 + "y", "x" * 20_000 + "y" + "x" * 29_999]
    rows = near_words(spark.createDataFrame([(w, 2) for w in words], "word string, n long")).collect()
    expected = {("a", "b"), ("a", "ab"), ("b", "ab"), ("ab", "abc"), (words[4], words[5]), (words[4], words[6]), (words[4], words[7])}
    assert {tuple(sorted((r.a, r.b), key=words.index)) for r in rows} == expected and len(rows) == 7


def test_forms_follow_to_the_root(spark):
    counts = {"colours": 2, "colourss": 20, "colournss": 200, "colournsst": 2000, "colournssta": 20_000, "apartly": 3, "apartlo": 30, "apartla": 30}
    df = variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert result(df) == brute_variants(counts)
    assert {r.word: r.root for r in df.collect()}["colours"] == "colournssta"
    with pytest.raises(ValueError):
        variants(df, factor=1)


def test_odd_rows(spark, docs):
    rows = [(1, "Straße GROSSES Größere größere Ängstlich ängstlich"), (1, "Straße GROSSES Größere größere Ängstlich ängstlich"),
            (None, "grosses grossen grossen"), (2, None), (3, ""), (4, "× ÷ ×××××××× ÷÷÷÷÷÷÷ 1234567 short"),
            (5, "longest " * 100_000 + "l" * 300_000), (6, "longezt longezt longest, longes't")]
    df = docs(rows, word="x", n="y", form="z")
    assert {r.word: r.n for r in vocabulary(df, drop_every=31).collect()} == brute_vocabulary(rows)
    assert result(variants(vocabulary(df, drop_every=31))) == brute_variants(brute_vocabulary(rows))
    assert variants(vocabulary(df.limit(0))).count() == 0


def test_pieces_do_not_cut_runs(spark, docs, monkeypatch):
    rnd = random.Random(3)
    rows = [(i, "".join(rnd.choice("abcdefé  ") for _ in range(3_000)) * 2) for i in range(5)]
    monkeypatch.setattr("docpulse.llm.spelling.PIECE", 10)
    assert {r.word: r.n for r in vocabulary(docs(rows), drop_every=31).collect()} == brute_vocabulary(rows)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert result(op13_spelling(spark, SF)) == brute_variants(brute_vocabulary(rows))
