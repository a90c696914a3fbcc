"""Chat collapse, licence scan and URL filter: edge cases and plans; their main cases are compared with SQL."""

import datetime as dt
import re

from docpulse.llm.chat import maximal_turns
from docpulse.llm.licences import TEMPLATES, TEXTS, scan
from docpulse.llm.url_filter import filter_urls, host_of, intervals
from pyspark.sql import functions as F

TURNS = "conv_id long, turn long, role string, text string, pos string, n_turns string"


def plan(df):
    return df._jdf.queryExecution().toString()


def conversations(spark, talks):
    rows = [(c, i, role, text, "clash", "clash") for c, turns in talks.items() for i, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, TURNS).repartition(4)


def kept(df):
    return sorted({r.conv_id for r in df.collect()}, key=lambda c: (c is not None, c))


def test_snapshots_collapse(spark):
    a, b, c, d = ("user", "hi"), ("assistant", "hello"), ("user", "more"), ("user", "else")
    talks = {1: [a], 2: [a, b], 3: [a, b, c], 4: [a, b, d], 5: [b], 6: [a, b, c], 7: [a, ("user", "hello")]}
    got = maximal_turns(conversations(spark, talks))
    assert kept(got) == [3, 4, 5, 7]
    three = got.filter("conv_id = 3").orderBy("pos").collect()
    assert [r.pos for r in three] == [1, 2, 3] and {r.n_turns for r in three} == {3}
    assert three[0].rendered == "<|im_start|>user\nhi<|im_end|>\n"


def test_prefixes_across_stretches(spark):
    talk = [("user", f"t{i % 7}") for i in range(40)]
    talks = {n: talk[:n] for n in (1, 5, 8, 9, 16, 39, 40)} | {100: talk[:20] + [("user", "other")]}
    whole, cut = (maximal_turns(conversations(spark, talks), stretch=s) for s in (1024, 8))
    assert kept(whole) == kept(cut) == [40, 100]
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))


def test_odd_turns(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (2, 5, "user", ""), (2, 9, "user", "x"),
            (None, 0, "user", "alone"), (3, 0, "user", "y" * 100_000), (4, 0, "user", "same"), (5, 0, "user", "same"), (None, 1, "user", "z")]
    df = spark.createDataFrame([(*r, "", "") for r in rows], TURNS)
    got = maximal_turns(df)
    assert kept(got) == [None, 1, 3, 4]  # 1 and 2 are equal once NULLs read as user and empty
    assert got.filter("conv_id = 1").count() == 2
    assert maximal_turns(df.limit(0)).count() == 0


def test_licence_notices(docs):
    rows = [(1, "Some prose of a few words.\nReleased  under the mit LICENSE!\nMore."), (2, "Licensed under the Apache License, Version 2.0"), (3, None), (4, ""),
            (5, "word " * 50_000), (6, "Released under the MIT License.\nReleased under the MIT License."), (6, "Released under the MIT License."),
            (7, "This work is licensed under the GNU General Public License, version 3."), (8, "MIT"), (None, "All rights reserved.")]
    got = scan(docs(rows, licence="clash", dice="clash")).collect()
    best = {(r.doc_id, r.licence): (r.dice, r.n_units) for r in got}
    assert best[1, "MIT"] == (1.0, 1) and best[2, "Apache-2.0"] == (1.0, 1) and best[None, "Proprietary"] == (1.0, 1)
    assert best[6, "MIT"] == (1.0, 4)  # three lines, and a text of one notice repeated: its set of bigrams has one more
    assert best[7, "GPL-3.0"][0] == 1.0 and (7, "GPL-2.0") in best
    assert {i for i, _ in best} == {1, 2, 6, 7, None}
    assert scan(docs([])).count() == 0 and scan(docs(rows), templates={}).count() == 0


def test_licence_ties_and_bounds(docs):
    same = {"one": "a b c d e", "two": "a b c d e", "far": " ".join("abcdefghijklmnopqrst")}
    got = {r.licence: r.dice for r in scan(docs([(1, "A, b c-d e"), (2, "a b c d x")]), templates=same, least=0.75).collect()}
    assert got == {"one": 1.0, "two": 1.0}


def test_licence_windows(docs):
    prose = "the quick brown fox of the software jumps over the lazy dog and so on " * 30
    text = " ".join(TEXTS["MIT"].split())
    wrapped = "\n * ".join(text[i:i + 60] for i in range(0, len(text), 60))  # lines break within words, too: 16 pairs of 160
    by_words = text.replace(" the ", "\n# the\n")
    rows = [(1, prose + text + prose), (2, f"Copyright 2020 Somebody\n{by_words}\n{prose}"), (3, prose + "Released under\nthe MIT License. " + prose),
            (4, prose + " ".join(text.split()[:80]) + prose), (5, prose), (6, wrapped), (None, text.replace("Software", "Work")), (7, "released under the mit"), (7, None)]
    got = {(r.doc_id, r.licence): r for r in scan(docs(rows, licence="clash", n_windows="clash")).collect()}
    assert [got[i, "MIT"].dice for i in (1, 2, 3)] == [1.0] * 3 and got[1, "MIT"].n_units == 0 and got[1, "MIT"].n_windows > 1
    assert (4, "MIT") not in got and not any(i == 5 for i, _ in got)
    assert got[7, "MIT"].n_units == 1 and got[7, "MIT"].dice == 2 * 3 / 7
    for (i, licence), r in got.items():
        assert (r.dice, r.n_windows) == windows_by_hand([t for j, t in rows if j == i], licence), (i, licence)


def windows_by_hand(texts, licence):
    """Best Dice and number of windows, from windows at every word."""
    best, n = 0.0, 0
    for text in texts:
        w = re.findall(r"[^\W_]+", (text or "").lower())
        pairs = list(zip(w, w[1:]))
        for table in (TEMPLATES, TEXTS):
            k = re.findall(r"[^\W_]+", table.get(licence, "").lower())
            known = set(zip(k, k[1:]))
            for i, pair in enumerate(pairs):
                if pair in known:
                    window = set(pairs[i:i + len(k) - 1])
                    dice = 2 * len(window & known) / (len(window) + len(known))
                    best, n = max(best, dice), n + (dice >= 0.8)
    return best, n


def test_intervals(spark):
    day = lambda n: dt.date(2024, 1, n)
    rows = [("A.com", "add", day(3)), ("a.com", "remove", day(9)), ("a.com", "add", day(9)), ("a.com", "drop", day(20)),
            (None, "add", day(1)), ("b.com", "remove", day(2)), ("c.com", None, day(4)), ("d.com", "add", None), ("e.com", "add", day(5))]
    got = intervals(spark.createDataFrame(rows, "listed_host string, action string, dated date"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("a.com", day(3), day(9)), ("a.com", day(9), day(20)), ("e.com", day(5), None)], key=repr)


def test_captures(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    entries = spark.createDataFrame([("bad.com", "add", day(10)), ("bad.com", "remove", day(100)), ("x.bad.com", "add", day(50)), ("tld", "add", day(0))],
                                    "listed_host string, action string, dated date")
    rows = [(1, "http://bad.com/a", day(9)), (2, "http://user@BAD.com:80", day(10)), (3, "https://x.bad.com./", day(60)), (4, "http://y.x.bad.com", day(99)),
            (5, "http://bad.com", day(100)), (6, "http://notbad.com", day(50)), (7, None, day(50)), (8, "no url", day(50)), (9, "http://bad.com", None),
            (10, "http://a.tld", day(5000)), (11, "http://bad.com", day(50)), (11, "http://bad.com", day(50)), (None, "http://", day(50))]
    captures = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, fetched date, blocked string, host string")
    got = filter_urls(captures, entries).collect()
    said = sorted(((r.page_id or 0), r.blocked, r.listed_host, r.n_listed) for r in got)
    assert said == [(0, False, None, 0), (1, False, None, 0), (2, True, "bad.com", 1), (3, True, "x.bad.com", 2), (4, True, "x.bad.com", 2), (5, False, None, 0),
                    (6, False, None, 0), (7, False, None, 0), (8, False, None, 0), (9, False, None, 0), (10, True, "tld", 1),
                    (11, True, "bad.com", 1), (11, True, "bad.com", 1)]
    assert filter_urls(captures, entries.limit(0)).filter("blocked").count() == 0
    assert filter_urls(captures.limit(0), entries).count() == 0


def test_hosts(spark):
    urls = ["HTTP://A.b:80/x@y", "https://u:p@h.c?q", "ftp://h#f", "//h", "mailto:x", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(host_of(F.col("u"))).collect()] == ["a.b", "h.c", "h", None, None, None, None]
