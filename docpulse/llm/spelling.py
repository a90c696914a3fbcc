"""Spelling variants: words at one edit, found by scanning sorted vocabularies.

A word is compared with those behind it in a sorted list. The rows of the edit matrix, three cells wide for one edit,
belong to prefixes: the next word in the list goes on from the row of the prefix it shares with the one before (their
LCP), and once every cell of a row exceeds one edit, the range of words with that prefix is jumped over by a binary search.

Lists are made by Spark. One edit lies in one half of a word, so that two words share the other half: the vocabulary is
grouped by first and by last halves, and each group is one sorted list. A group of too many words is passed on and halved
again in the part that still differs, until every list is short; at the end the differing part has one letter.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpulse.llm.common import query, stored, table

RUN = "[A-Za-zÀ-ÿ]"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
PIECE = 1 << 20  # characters of a text looked at together
KEPT = 400_000  # words a task counts before it hands them on
LIST = 2_000  # words of a list; longer ones are halved again
END = "\U0010ffff"
NEVER = 1 << 30


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7,
               least_count: int = 2, drop_every: int | None = None) -> DataFrame:
    """``word`` and ``n``, its occurrences over all texts, for words of some length and number.

    Words are maximal runs of Latin letters, A-Z lower-cased. With ``drop_every`` a run loses a letter where the CRC-32
    of "<id>:<run>" is a multiple of it, which plants misspellings; a NULL id is written as nothing there. NULL and empty
    texts have no words. A repeated row counts again. Other columns are not read. An empty table gives an empty result.
    """
    find = re.compile(RUN + "{%d,}" % least_length).findall
    other = re.compile("[^" + RUN[1:]).search

    def parts(text: str) -> Iterator[str]:
        start = 0
        while start < len(text):
            stop = other(text, start + PIECE)
            stop = stop.start() if stop else len(text)
            yield text[start:stop]
            start = stop

    def count(batches):
        found = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                key, text = key.as_py(), text.as_py()
                seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                for part in parts(text or ""):
                    for run, n in Counter(find(part)).items():
                        word = run.lower() if run.isascii() else run.translate(LOWER)
                        if drop_every:
                            h = zlib.crc32(word.encode(), seed)
                            if h % drop_every == 0:
                                h %= len(word)
                                word = word[:h] + word[h + 1:]
                        if len(word) >= least_length:
                            found[word] += n
                    if len(found) > KEPT:
                        yield rows(found)
                        found = Counter()
        yield rows(found)

    def rows(found):
        return pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    return (docs.select(id_col, text_col).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count))


def near_in_list(words: list[str]) -> Iterator[tuple[int, int]]:
    """Positions (i, j), i < j, of the words at exactly one edit, for sorted, different words."""
    n = len(words)
    lcp = [0] * n
    for j in range(1, n):
        a, b, p = words[j - 1], words[j], 0
        for x, y in zip(a, b):
            if x != y:
                break
            p += 1
        lcp[j] = p
    longest = max(map(len, words), default=0)
    ones, zeros = [1] * (longest + 1), [0] * (longest + 1)
    left, here, right = ones[:], zeros[:], ones[:]  # cells of a row beside and on the diagonal, by length of prefix
    for i in range(n - 1):
        q = words[i]
        m = len(q)
        q += "\0\0\0"  # read beyond its end, and before its start
        j = i + 1
        d = lcp[j]
        left[:d + 1], here[:d + 1], right[:d + 1] = ones[:d + 1], zeros[:d + 1], ones[:d + 1]  # rows of q against itself
        left[0] = 2
        while j < n:
            v = words[j]
            size = len(v)
            x, y, z = left[d], here[d], right[d]
            while d < size:
                c = v[d]
                a = x if q[d - 1] == c else x + 1
                if y < a:
                    a = y + 1
                b = y if q[d] == c else y + 1
                if a < b:
                    b = a + 1
                if z < b:
                    b = z + 1
                e = z if q[d + 1] == c else z + 1
                if b < e:
                    e = b + 1
                if a > 1 and b > 1 and e > 1:
                    break
                d += 1
                left[d], here[d], right[d] = x, y, z = a, b, e
            else:
                if (y if m == size else x if m == size - 1 else z if m == size + 1 else 2) == 1:
                    yield i, j
                j += 1
                if j < n:
                    d = lcp[j]
                continue
            # one edit is used up: only letters on the way of a cell with 1 go on from this prefix
            onward = min([k for cell, k in ((x, q[d - 1]), (y, q[d]), (z, q[d + 1])) if cell == 1 and k > c], default=END)
            j = bisect_left(words, v[:d] + onward, j + 1)
            if j < n and lcp[j] < d:
                d = lcp[j]


def _halves(rows: DataFrame) -> DataFrame:
    """Each list (size, head, tail) cut at the middle of what differs, once by first and once by last half."""
    a, b = F.length("head"), F.length("tail")
    half = F.floor((F.col("size") - a - b) / 2).cast("int")
    first = F.struct(F.substring("word", F.lit(1), a + half).alias("head"), F.col("tail").alias("tail"), F.col("upto").alias("upto"))
    last = F.struct(F.col("head").alias("head"), F.substring(F.col("word"), F.length("word") - b - half + 1, b + half).alias("tail"),
                    F.least("upto", a + half).alias("upto"))  # pairs that share the first half are found there
    return rows.select("word", "n", "size", F.inline(F.array(first, last)))


def near_words(vocabulary: DataFrame, longest_list: int = LIST) -> DataFrame:
    """``a``, ``n_a``, ``b``, ``n_b``: every pair of words at exactly one edit, once; ``vocabulary`` has ``word``, ``n``.

    An edit inserts, deletes or replaces one code point. Words must differ and not be NULL; the empty word has no list.
    """
    def scan(batches):
        key, own = None, []
        over = False
        for batch in batches:
            passed = []
            for word, n, size, head, tail, upto in zip(*[c.to_pylist() for c in batch.columns]):
                if (size, head, tail, upto) != key:
                    if own:
                        yield result(pairs(key, own), [])
                    key, own, over = (size, head, tail, upto), [], False
                if over:
                    passed.append((word, n, *key))
                    continue
                own.append((word, n))
                if len(own) > longest_list and size - len(head) - len(tail) > 1:
                    passed += [(*w, *key) for w in own]
                    own, over = [], True
            if passed:
                yield result([], passed)
        if own:
            yield result(pairs(key, own), [])

    def pairs(key, own):
        size, head, tail, upto = key
        if len(own) < 2 or upto <= len(head):
            return []
        a, b = len(head), len(tail)
        found = []
        for i, j in near_in_list([w[a:len(w) - b] for w, _ in own]):
            (u, n), (v, m) = own[i], own[j]
            if (len(u) == size or len(v) == size) and u[:upto] != v[:upto]:
                found.append((u, n, v, m))
        return found

    def result(found, passed):
        a, n, b, m = zip(*found) if found else ((), (), (), ())
        w, k, size, head, tail, upto = zip(*passed) if passed else ((),) * 6
        x, y = [None] * len(found), [None] * len(passed)
        columns = [([*a, *w], pa.string()), ([*n, *k], pa.int64()), ([*b, *y], pa.string()), ([*m, *y], pa.int64()),
                   ([*x, *size], pa.int32()), ([*x, *head], pa.string()), ([*x, *tail], pa.string()), ([*x, *upto], pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)

    names = ["a", "n_a", "b", "n_b", "size", "head", "tail", "upto"]
    schema = "a string, n_a long, b string, n_b long, size int, head string, tail string, upto int"
    sizes = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size")
    rows = vocabulary.select("word", "n", sizes).filter("size > 0").withColumns(
        {"head": F.lit(""), "tail": F.lit(""), "upto": F.lit(NEVER)})
    differing = F.substring("word", F.length("head") + 1, F.length("word") - F.length("head") - F.length("tail"))
    found = []
    while True:
        lists = (_halves(rows).repartition("size", "head", "tail", "upto")
                 .sortWithinPartitions("size", "head", "tail", "upto", differing))
        out = stored(lists.mapInArrow(scan, schema), "near-words")
        found.append(out.filter("size IS NULL").select("a", "n_a", "b", "n_b"))
        rows = out.filter("size IS NOT NULL").select(F.col("a").alias("word"), F.col("n_a").alias("n"), "size", "head", "tail", "upto")
        if rows.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs


def variants(vocabulary: DataFrame, factor: int = 10, longest_list: int = LIST) -> DataFrame:
    """Each word of ``vocabulary`` (``word``, ``n``) with its ``form``, ``root``, ``n_near`` and ``form_n``.

    ``form`` is the near word with the largest n, of equal ones the first by code point, if its n is at least ``factor``
    (2 or more) times the word's own, else NULL; ``root`` follows forms to the last. A form has at least ``factor`` times
    the occurrences, so that chains have a logarithmic length and no circle. An empty vocabulary gives an empty result.
    """
    if factor < 2:
        raise ValueError("a form must be more frequent")
    words = stored(vocabulary.select("word", "n"), "vocabulary")
    pairs = near_words(words, longest_list)
    sides = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))))
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    taken = -F.col("best.less") >= factor * F.col("n")
    known = stored(words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n")), "forms")
    # each step is twice as long as the one before: from every word with a form to the form of what it reached
    step = known.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stored(step.join(on.hint("merge"), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        step = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            break
    return known.join(step.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query()
def op13_spelling(spark, sf_dir):
    """Variants among all words of at least seven letters, with a letter dropped from one run in 31."""
    return variants(vocabulary(table(spark, sf_dir, "documents"), drop_every=31))
