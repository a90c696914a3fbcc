import random

import numpy as np
import pytest
from brute import near_components as plain, tuples

from docpulse.llm import ngram_join
from docpulse.llm.ngram_join import Threshold, common_shingles, link, near_components
from docpulse.llm.shingles import shingle_sets


def found(df):
    return tuples(df, "doc_id", "n_shingles", "component_id")


def families(seed, n, low, high, change):
    """Families of texts that differ in a few words, some with a passage that all families share."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(r.randint(1, 4)))
    passage, out = [word() for _ in range(40)], []
    while len(out) < n:
        base = [word() for _ in range(r.randint(low, high))]
        if r.random() < 0.4:
            base[3:3] = passage
        for _ in range(r.randint(1, 12)):
            text = list(base)
            for _ in range(r.randint(0, change)):
                text[r.randrange(len(text))] = word()
            out.append(r.choice((" ", "\n", "\t ")).join(w.upper() if r.random() < 0.3 else w for w in text))
    return list(enumerate(out[:n]))


@pytest.mark.parametrize("seed,low,high,change,width,p", [(1, 1, 12, 1, 3, 90), (2, 30, 120, 3, 3, 90), (3, 60, 200, 8, 5, 80), (4, 5, 40, 2, 5, 80)])
def test_random_families(docs, seed, low, high, change, width, p):
    rows = families(seed, 250, low, high, change)
    assert found(near_components(docs(rows), width, p, 100)) == sorted(map(repr, plain(rows, width, p, 100)))


def test_blocks_and_buckets(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 500)
    monkeypatch.setattr(ngram_join, "BUCKET", 2000)
    rows = families(5, 200, 20, 80, 2)
    assert found(near_components(docs(rows), 3, 90, 100)) == sorted(map(repr, plain(rows, 3, 90, 100)))


def test_edge_cases(docs):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "A"), (6, "a b"), (7, "a  B"), (8, "b a"), (9, long), (10, long + " x"),
            (11, "a b c"), (12, "a b c"), (12, "a b c"), (13, "É b c"), (14, "é b c")]
    df = docs(rows, n_shingles="clash", component_id="clash", key="clash")
    assert found(near_components(df, 3, 90, 100)) == sorted(map(repr, plain(rows, 3, 90, 100)))


def test_an_id_with_two_texts(docs):
    got = near_components(docs([(1, "a b c d"), (1, "x y z"), (2, "x y z"), (None, "a b c d")]), 3, 90, 100).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == [(0, 1), (1, 1), (1, 1), (2, 1)]


def test_empty_table(docs):
    assert near_components(docs([]), 3, 90, 100).count() == 0


def test_some_part_is_always_shared():
    r = random.Random(7)
    for p in (80, 90):
        t = Threshold(p, 100)
        for _ in range(300):
            n = r.choice((1, 4, 9, 10, 11, 40, 300))
            a = np.unique(np.array([r.getrandbits(64) for _ in range(n)], np.uint64))
            b = a.copy()
            for _ in range(r.randint(0, n // 8)):
                b = np.delete(b, r.randrange(len(b))) if r.random() < 0.5 and len(b) > 1 else np.append(b, np.uint64(r.getrandbits(64)))
            b = np.unique(b)
            if t.linked(len(np.intersect1d(a, b)), len(a), len(b)):
                for common in (a[:0], a[: len(a) // 2], a, np.sort(np.union1d(a[::3], b[::2]))):
                    x, y = (set(np.concatenate(t.signatures(s, common)).tolist()) for s in (a, b))
                    assert x & y


@pytest.mark.parametrize("seed,n,change", [(8, 120, 3), (9, 30, 1), (10, 2, 1), (11, 3, 5)])
def test_search_in_a_class(seed, n, change):
    rows = families(seed, n, 30, 60, change)
    sets = shingle_sets([t.encode() for _, t in rows], 3)
    forest = link(sets, Threshold(90, 100))
    assert [forest.root(i) for i in range(len(sets))] == [c for _, _, c in plain(rows, 3, 90, 100)]


def test_common_shingles(docs):
    passage = " ".join(f"p{i}" for i in range(30))
    df = docs([(i, f"a{i} b{i} c{i} {passage} d{i} e{i} f{i}") for i in range(120)])
    rows = ngram_join.shingled(df.coalesce(1), "doc_id", "text", 5, Threshold(80, 100))
    assert len(common_shingles(rows)) == 26


def test_near_copies_that_are_mostly_a_common_line(docs):
    line = " ".join(f"p{i}" for i in range(11))
    rows = [(i, " ".join([f"a{i}x{j}" for j in range(20)] + [line] + [f"b{i}x{j}" for j in range(20)])) for i in range(60)]
    rows += [(100, f"{line} o"), (101, f"{line} o q")]  # alone at their size: no third text sends the parts of the line
    assert found(near_components(docs(rows).coalesce(1), 3, 90, 100)) == sorted(map(repr, plain(rows, 3, 90, 100)))


def test_no_more_parts_are_required_than_a_partner_sends():
    r, sides = random.Random(12), set()
    word = lambda: np.uint64(r.getrandbits(64))
    for p in (80, 90):
        t = Threshold(p, 100)
        for _ in range(600):
            common = np.unique(np.array([word() for _ in range(r.choice((9, 30, 100)))], np.uint64))
            own = [word() for _ in range(r.randint(1, max(2, len(common) // 4)))]
            a = np.unique(np.append(common[r.randint(0, 2):], own))
            b = np.unique(np.append(a, [word() for _ in range(r.randint(1, max(1, len(a) // 9)))]))
            if not t.linked(len(a), len(a), len(b)):
                continue
            x, y = ({t.level(len(s)) + i: (set(sigs.tolist()), need) for i, (sigs, need) in enumerate(t.signed(s, common))} for s in (a, b))
            for at in x.keys() & y.keys():
                m, most = t.parts(at)
                sides.add(tuple(len(set((np.setdiff1d(s, common) % np.uint64(m)).tolist())) > most for s in (a, b)))
                assert len(x[at][0] & y[at][0]) >= max(x[at][1], y[at][1]) > 0
    assert (False, True) in sides and (True, True) in sides and (False, False) in sides
