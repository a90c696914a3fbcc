"""Repeated substrings by a sparse enhanced suffix array, as groups of maximal repeats with all their occurrences.

Only suffixes at anchors are sorted. A window of ``least`` bytes has as its anchor the k-mer of least hash in it, so equal
windows have equal anchors at equal places: every repeat long enough is seen at an anchor. An anchor's context is the
union of its windows. Anchors are counted first: those met once can repeat nothing and go no further, and contexts that
are equal as a whole are one context with many occurrences.

The contexts of one anchor are a bucket of the suffix array. Sorted by what follows the anchor, with the lengths of common
prefixes between neighbours, a stack scan yields the tree of common-prefix intervals. In every interval the contexts,
in order of what precedes the anchor, show how far they extend to the left together: where they differ there, the
interval's string with that extension is a maximal repeat, and those that share it are its occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpulse.llm.common import query, stored, table
from docpulse.llm.shingles import _powers, mix

LEAST = 400
KMER = 100
PLACE = np.uint64((1 << 34) - 1)  # bits of a position within a text; the others are the hash's
VALUES = np.random.default_rng(21).integers(1, 1 << 63, 256, dtype=np.uint64)
BUCKET = 4096  # contexts of an anchor that one task sorts


def anchors(data: np.ndarray, least: int = LEAST, k: int = KMER) -> tuple[np.ndarray, ...]:
    """Places of the anchors of all windows of ``least`` bytes, first and last window of each, and the k-mers' hashes."""
    n, w = len(data), least - k + 1
    if n < least:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    up, down = _powers(n + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(VALUES[data] * up[:n])])
    h = mix((sums[k:] - sums[:-k]) * down[:n - k + 1])
    keys = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
    # least of every w neighbours: from the blocks' running minima on either side
    blocks = np.concatenate([keys, np.full(-len(keys) % w, ~np.uint64(0))]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(h) - w + 1
    place = (np.minimum(behind[:windows], ahead[w - 1:w - 1 + windows]) & PLACE).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], windows) - 1
    return place[first], first, last, h[place[first]].view(np.int64)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) >> 1
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def interval_tree(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(length, first, end) of the common-prefix intervals of a sorted list, inner ones first, by a stack scan.

    ``lcp``[i] is the common prefix of entries i - 1 and i; ``lcp``[0] is not looked at.
    """
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        length, start = (lcp[i] if i < len(lcp) else 0), i - 1
        while stack[-1][0] > length:
            top, start = stack.pop()
            yield top, start, i
        if stack[-1][0] < length:
            stack.append((length, start))


def maximal_repeats(contexts: list[tuple[bytes, bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """For each context (bytes before the anchor reversed, bytes from it on): its (left, right, group).

    An entry says that the string from ``left`` bytes before the anchor to ``right`` bytes after is a maximal repeat of
    ``least`` bytes or more; contexts with it have the same group, which is the entry's string by number. Of repeats of a context
    that lie within each other the longer one is given.
    """
    n = len(contexts)
    order = sorted(range(n), key=lambda c: contexts[c][1])
    lcp = [0] + [_common(contexts[a][1], contexts[b][1]) for a, b in zip(order, order[1:])]
    by_left = sorted(range(n), key=lambda c: contexts[c][0])
    left_lcp = [0] + [_common(contexts[a][0], contexts[b][0]) for a, b in zip(by_left, by_left[1:])]
    rank = [0] * n
    for r, c in enumerate(by_left):
        rank[c] = r
    ranks, near = np.array(rank), np.array(left_lcp)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    best = [-1] * n
    for right, first, end in interval_tree(lcp):
        members = order[first:end]
        if len(members) > 48:
            here = np.sort(ranks[members])
            gaps = np.minimum.reduceat(near, np.append(here[:-1] + 1, here[-1]))[:-1].tolist()
            here = here.tolist()
        else:
            here = sorted(rank[c] for c in members)
            gaps = [min(left_lcp[a + 1:b + 1]) for a, b in zip(here, here[1:])]
        if max(gaps) + right < least:
            continue
        for i, r in enumerate(here):
            left, c = max(gaps[i - 1] if i else -1, gaps[i] if i < len(gaps) else -1), by_left[r]
            if left > best[c]:  # further to the left than any longer right side: not within what was found before
                best[c] = left
                if left + right >= least:
                    found[c].append((left, right, -1))
    return [[(a, b, _name(contexts[c], a, b)) for a, b, _ in entries] for c, entries in enumerate(found)]


def _name(context: tuple[bytes, bytes], left: int, right: int) -> int:
    return xxhash.xxh3_64_intdigest(context[0][left - 1::-1] + context[1][:right] if left else context[1][:right]) - (1 << 63)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("own"), text.cast("binary").alias("text"))


def repeat_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, k: int = KMER) -> DataFrame:
    """id, own (hash of the text), first, end, group: bytes covered by a maximal repeat of ``least`` bytes or more.

    A repeat is a string that starts at two places of any texts. Rows of one group are its occurrences. Within an
    anchor's context, of less than twice ``least`` bytes, repeats are maximal; a longer repeat is a chain of overlapping
    spans, one for each of its anchors. NULL and short texts have none. Rows that repeat, with or without their id, are texts of their own.
    """
    texts = _texts(docs, id_col, text_col)
    kind = dict(texts.dtypes)["id"]

    def find(batches):
        for batch in batches:
            ids, own = batch.column(0), batch.column(1)
            rows, out = [], [[], [], [], [], []]
            for i, value in enumerate(batch.column(2)):
                text = value.as_py()
                place, first, last, kmer = anchors(np.frombuffer(text, np.uint8), least, k)
                rows.append(np.full(len(place), i))
                seeds = (first * 512 + last - place * 513) & 0xFFFFFFFF
                whole = [xxhash.xxh3_64_intdigest(text[a:b + least], s) - (1 << 63) for a, b, s in zip(first.tolist(), last.tolist(), seeds.tolist())]
                for column, values in zip(out, (place, place - first, place - last, kmer, np.array(whole, np.int64))):
                    column.append(values)
            row = pa.array(np.concatenate(rows)) if rows else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(row), own.take(row), *[pa.array(np.concatenate(c), pa.int64()) for c in out]],
                ["id", "own", "place", "before", "after", "kmer", "context"])

    # before, after: offsets of the first and the last of the anchor's windows
    seen = stored(texts.mapInArrow(find, f"id {kind}, own long, place long, before long, after long, kmer long, context long"), "anchors")
    repeated = stored(seen.groupBy("kmer").agg(F.count("*").alias("n")).filter("n > 1").select("kmer"), "kmers")
    seen = stored(seen.join(repeated.hint("merge"), "kmer"), "anchors")
    contexts = stored(seen.groupBy("kmer", "context").agg(
        F.count("*").alias("n"), F.first("before").alias("before"), F.first("after").alias("after"),
        F.min(F.struct("id", "own", "place")).alias("at")), "contexts")
    # a context met twice is a repeat as a whole; one met once needs the others of its anchor
    whole = contexts.filter("n > 1").select("kmer", "context", F.col("before").alias("left"), (least - F.col("after")).alias("right"),
                                            F.col("context").alias("group"))
    mixed = contexts.groupBy("kmer").agg(F.count("*").alias("m"), F.min("n").alias("fewest")).filter("m > 1 AND fewest = 1")
    mixed = stored(mixed.select("kmer", "m"), "mixed")
    wanted = contexts.join(mixed.hint("merge"), "kmer").groupBy("at.id", "at.own").agg(F.collect_list(F.struct(
        "kmer", "context", "n", "m", "before", "after", "at.place")).alias("wanted"))  # at most a few per 100 bytes of the text
    wanted = stored(wanted.withColumnsRenamed({"id": "__id", "own": "__own"}), "wanted")
    found = texts.join(wanted.hint("merge"), F.col("id").eqNullSafe(F.col("__id")) & (F.col("own") == F.col("__own"))).select("text", "wanted")

    def sides(batches):
        for batch in batches:
            out = []
            for text, rows in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                for r in rows.as_py():
                    a = r["place"]
                    out.append((r["kmer"], r["context"], r["n"], r["m"], text[a - r["before"]:a][::-1], text[a:a - r["after"] + least]))
                    if len(out) >= 4000:
                        yield _batch(out)
                        out = []
            if out:
                yield _batch(out)

    def _batch(out):
        kinds = [pa.int64()] * 4 + [pa.binary()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["kmer", "context", "n", "m", "lefts", "rights"])

    # written once: crowded buckets and the others both read it
    rows = stored(found.mapInArrow(sides, "kmer long, context long, n long, m long, lefts binary, rights binary"), "sides")
    buckets = rows.filter(F.col("m") <= BUCKET).repartition("kmer").sortWithinPartitions("kmer")

    def scan(batches):
        kmer, members = None, {}
        for batch in batches:
            out = []
            for k_, c, n, a, b in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5)]):
                if k_ != kmer:
                    out += repeats(kmer, members)
                    kmer, members = k_, {}
                members[c] = (n, a, b)
            yield _spans(out)
        yield _spans(repeats(kmer, members))

    def repeats(kmer, members):
        names = list(members)
        entries = maximal_repeats([members[c][1:] for c in names], least) if len(names) > 1 else []
        return [(kmer, c, *e) for c, own in zip(names, entries) if members[c][0] == 1 for e in own]

    def _spans(out):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], ["kmer", "context", "left", "right", "group"])

    partly = buckets.mapInArrow(scan, "kmer long, context long, left long, right long, group long")
    if not mixed.filter(F.col("m") > BUCKET).isEmpty():
        partly = partly.union(_crowded(rows.filter(F.col("m") > BUCKET), least))
    spans = stored(whole.union(partly), "spans")
    return (seen.join(spans.hint("merge"), ["kmer", "context"])
            .select("id", "own", (F.col("place") - F.col("left")).alias("first"), (F.col("place") + F.col("right")).alias("end"), "group"))


def _crowded(rows: DataFrame, least: int) -> DataFrame:
    """Repeats at anchors with more contexts than a task should sort: the buckets are split down to single windows,
    whose occurrences Spark counts, and windows next to each other join again."""

    def windows(batches):
        for batch in batches:
            for kmer, context, lefts, rights in zip(*[batch.column(i).to_pylist() for i in (0, 1, 4, 5)]):
                text, before = lefts[::-1] + rights, len(lefts)
                starts = range(len(text) - least + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v] * len(starts), pa.int64()) for v in (kmer, context)]
                    + [pa.array([before - s for s in starts], pa.int64()),
                       pa.array([xxhash.xxh3_64_intdigest(text[s:s + least]) - (1 << 63) for s in starts], pa.int64())],
                    ["kmer", "context", "left", "group"])

    w = stored(rows.dropDuplicates(["kmer", "context"]).mapInArrow(windows, "kmer long, context long, left long, group long"), "windows")
    twice = stored(w.groupBy("kmer", "left", "group").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "windows")
    return w.join(twice.hint("merge"), ["kmer", "left", "group"]).select(
        "kmer", "context", "left", (least - F.col("left")).alias("right"), "group")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, k: int = KMER) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``spans`` (first, end of each maximal run of repeated bytes) and ``kept``, the rest.

    NULL text counts as empty. Repeated rows are repeats of each other. Other columns are not read. An empty table gives
    an empty result.
    """
    texts = _texts(docs, id_col, text_col)
    spans = repeat_spans(docs, id_col, text_col, least, k).groupBy("id", "own").agg(
        F.collect_set(F.struct("first", "end")).alias("spans"))  # a few per 100 bytes of the text
    spans = spans.withColumnsRenamed({"id": "__id", "own": "__own"})
    joined = texts.join(spans.hint("merge"), F.col("id").eqNullSafe(F.col("__id")) & (F.col("own") == F.col("__own")), "left").select("id", "text", "spans")
    kind = dict(joined.dtypes)["id"]

    def cut(batches):
        for batch in batches:
            sizes, runs, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                text, merged = text.as_py(), []
                for a, b in sorted((s["first"], s["end"]) for s in spans.as_py() or []):
                    if merged and a <= merged[-1]["end"]:
                        merged[-1]["end"] = max(b, merged[-1]["end"])
                    else:
                        merged.append({"first": a, "end": b})
                sizes.append(len(text))
                runs.append(merged)
                edges = [0, *[x for r in merged for x in (r["first"], r["end"])], len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array(runs, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                [id_col, "n_bytes", "spans", "kept"])

    return joined.mapInArrow(cut, f"`{id_col}` {kind}, n_bytes long, spans array<struct<first: long, end: long>>, kept binary")


@query()
def op1_suffix_dedup(spark, sf_dir):
    """All documents less every byte of a 400-byte string that occurs twice."""
    cut = without_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
