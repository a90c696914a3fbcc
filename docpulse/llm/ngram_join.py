"""N-gram Jaccard self-join by T-occurrence search, reduced to its connected components.

Two sets of sizes a and b whose Jaccard similarity is p/q or more differ in at most D = (a + b)(q - p)/(q + p) members. Cut
both by a hash into m > D parts: some part is the same in both. Signatures of parts thus bring every linking pair
together, whatever passages others share, as a part is equal only if nothing in it differs. The same holds of the members
that are not common ones (shingles of very many documents), so that signatures leave those out where others do.

Sets brought together form candidate classes. In a class, sets are seen by how they differ from its core, the shingles
that most of them have: the overlap that links two sets becomes an overlap of their differences, whose inverted lists are
short even among near copies. T-occurrence search (DivideSkip: Li, Lu, Lu, ICDE 2008) counts it: the shorter lists are merged,
the longest probed by binary search for the sets that can still reach the overlap.

Equal sets are one set throughout: copies cost one row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpulse.llm.common import dropped, query, stored, table
from docpulse.llm.components import components
from docpulse.llm.shingles import digest, mix, pieces, shingle_sets

BUCKET = 3_000_000  # signatures of a bucket
BLOCK = 1_000_000  # shingles of a block of a large class
COMMON = 2000  # a common shingle is in one of so many sets at least, which bounds how many there are


class Threshold:
    """Jaccard similarity of ``p`` / ``q`` or more."""

    def __init__(self, p: int, q: int):
        self.p, self.q, self.bounds = p, q, [1]

    def linked(self, both, a, b):
        return self.q * both >= self.p * (a + b - both)

    def level(self, n: int) -> int:
        """Class of sizes: a linking partner of size n or more lies in the same or the next class."""
        while self.bounds[-1] <= n:
            self.bounds.append(self.bounds[-1] * self.q // self.p + 1)
        return int(np.searchsorted(self.bounds, n, side="right")) - 1

    def parts(self, level: int) -> tuple[int, int]:
        """(m, D) for pairs within the sizes of ``level`` and the one below: linking ones have m - D parts the same."""
        while len(self.bounds) < level + 2:
            self.bounds.append(self.bounds[-1] * self.q // self.p + 1)
        most = 2 * (self.bounds[level + 1] - 1) * (self.q - self.p) // (self.q + self.p)
        return (most + 1 + max(3, most // 2) if most else 1), most

    def signatures(self, tokens: np.ndarray, common: np.ndarray) -> list[np.ndarray]:
        """Signatures of the parts at both levels a set can have partners at."""
        return [sigs for sigs, _ in self.signed(tokens, common)]

    def signed(self, tokens: np.ndarray, common: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """Signatures as ``signatures``, with how many of them every linking partner is sure to have too.

        At least m - D parts are the same in a partner. A part counts by its uncommon members. Parts without any are left
        out unless they are m - D or more, and then those without members at all, unless they are that many. A partner may
        leave out what this set does not, but it then sends more than D parts of those it keeps, so one of them is the same.
        """
        out, level = [], self.level(len(tokens))
        spread = mix(tokens + np.uint64(7))
        often = common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] == tokens if len(common) else np.zeros(len(tokens), bool)
        for at in (level, level + 1):
            m, most = self.parts(at)
            part = (tokens % np.uint64(m)).astype(np.int64)
            sums, members, rare = np.zeros(m, np.uint64), np.zeros(m, bool), np.zeros(m, bool)
            members[part], rare[part[~often]] = True, True
            use = ~often | ~rare[part]
            np.add.at(sums, part[use], spread[use])
            used = rare
            if m - rare.sum() >= m - most:
                used = members if m - members.sum() < m - most else np.ones(m, bool)
            which = np.flatnonzero(used)
            sigs = mix(mix(sums[which] ^ rare[which]) + which.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(at << 40))
            out.append((sigs, max(1, int(rare.sum()) - most)))
        return out

    def n_signatures(self, n: int) -> int:
        return sum(self.parts(self.level(n) + i)[0] for i in (0, 1))


def _sid(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _sets(batches, width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of batches with the shingle sets of their last column."""
    for batch in batches:
        for start, texts in pieces(batch.column(batch.num_columns - 1)):
            yield batch.slice(start, len(texts)), shingle_sets(texts, width)


def shingled(docs: DataFrame, id_col: str, text_col: str, width: int, threshold: Threshold) -> DataFrame:
    """id, n, key (128 bits that equal sets share), parts (number of signatures); and with a piece's last row ``often``,
    its shingles that three of its sets or more have, with how many have them."""

    def run(batches):
        for batch, sets in _sets(batches, width):
            keys = [digest(s) for s in sets]
            each = np.concatenate(list(dict(zip(keys, sets)).values()))
            names, counts = np.unique(each, return_counts=True)
            often = np.stack([names[counts > 2].view(np.int64), counts[counts > 2]], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                 pa.array([threshold.n_signatures(len(s)) if len(s) else 0 for s in sets], pa.int64()),
                 pa.array([None] * (len(sets) - 1) + [often.tobytes()], pa.binary())], ["id", "n", "key", "parts", "often"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n long, key binary, parts long, often binary")


def common_shingles(rows: DataFrame) -> np.ndarray:
    """Shingles of one in ``COMMON`` documents or more, counted over all; those too rare for any piece are not among them.

    Which shingles these are changes no result. They are at most ``COMMON`` times the mean size of a set, in practice
    those of common passages.
    """

    def unpack(batches):
        for batch in batches:
            for value in batch.column(0):
                each = np.frombuffer(value.as_py(), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(each[:, 0]), pa.array(each[:, 1])], ["token", "n"])

    counts = rows.filter("often IS NOT NULL").select("often").mapInArrow(unpack, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    least = max(50, rows.filter("n > 0").count() // COMMON)
    return np.sort(np.array([r.token for r in counts.filter(F.col("n") >= least).select("token").collect()], np.int64).view(np.uint64))


def candidate_edges(docs: DataFrame, text_col: str, width: int, threshold: Threshold, buckets: int, common: np.ndarray) -> DataFrame:
    """Edges a, b between 63-bit ids of different sets that may link: every one with the first that has an equal part.

    A set goes on at a level only if as many of its parts are met elsewhere as any linking partner is sure to send.
    Signatures travel packed by bucket: 48 bits beside those the bucket stands for, and each set's id once. Of equal
    signatures of one piece of input one travels, so that a part which very many sets share is a few rows in its bucket.
    """
    sent = docs.sparkSession.sparkContext.broadcast(common)
    short = [np.uint64(buckets), np.uint64((1 << 48) - 1)]

    def sign(batches):
        seen: set[int] = set()
        common = sent.value
        for _, sets in _sets(batches, width):
            nodes, sigs, needs = [], [], []
            for tokens in sets:
                sid = _sid(digest(tokens)) if len(tokens) else None
                if sid is None or sid in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(sid)
                for which, (sig, need) in enumerate(threshold.signed(tokens, common)):
                    node = sid & ~1 | which
                    needs.append((node, need))
                    nodes.append(np.full(len(sig), node, np.int64))
                    sigs.append(sig)
            if not nodes:
                continue
            node, sig = np.concatenate(nodes), np.concatenate(sigs)
            bucket, sig = (sig % short[0]).astype(np.int64), sig // short[0] & short[1]
            order = np.lexsort((node, sig, bucket))
            node, sig, bucket = node[order], sig[order], bucket[order]
            new = (np.diff(sig, prepend=~sig[:1]) != 0) | (np.diff(bucket, prepend=-1) != 0)
            group = np.cumsum(new) - 1
            met = np.bincount(group)[group] > 1  # with another of this piece: known without the bucket
            pairs = np.stack([node[met], (sig[met] * short[0] + bucket[met].astype(np.uint64)).view(np.int64)], 1)
            node, sig, bucket = node[new], sig[new], bucket[new]
            order = np.lexsort((node, bucket))
            node, sig, bucket = node[order], sig[order], bucket[order]
            cut = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets + 1))
            rows = [(int(bucket[0]), None, None, None, pairs.tobytes(), np.array(needs, np.int64).tobytes())]
            for a, b in zip(cut, cut[1:]):
                change = np.flatnonzero(np.diff(node[a:b], prepend=node[a] ^ 1, append=node[b - 1] ^ 1))
                low = np.ascontiguousarray(sig[a:b]).view(np.uint8).reshape(-1, 8)[:, :6]
                rows.append((int(bucket[a]), low.tobytes(), node[a:b][change[:-1]].tobytes(), np.diff(change).astype(np.uint32).tobytes(), None, None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), *[pa.binary()] * 5])], ["bucket", "sigs", "nodes", "runs", "pairs", "needs"])

    def meet(batch: pa.Table) -> pa.Table:
        bucket = np.uint64(batch.column("bucket")[0].as_py())
        sigs, nodes, met, needs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [], []
        for s, i, r, e, w in zip(*[batch.column(c).to_pylist() for c in ("sigs", "nodes", "runs", "pairs", "needs")]):
            if e is not None:
                met.append(np.frombuffer(e, np.int64).reshape(-1, 2))
                needs.append(np.frombuffer(w, np.int64).reshape(-1, 2))
                continue
            low = np.zeros((len(s) // 6, 8), np.uint8)
            low[:, :6] = np.frombuffer(s, np.uint8).reshape(-1, 6)
            sigs.append(low.view(np.uint64).ravel())
            nodes.append(np.repeat(np.frombuffer(i, np.int64), np.frombuffer(r, np.uint32)))
        sig, node = np.concatenate(sigs), np.concatenate(nodes)
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        new = np.diff(sig, prepend=~sig[:1]) != 0
        fresh = new | (np.diff(node, prepend=0) != 0)  # copies of a set are one
        sig, node, new = sig[fresh], node[fresh], new[fresh]
        group = np.cumsum(new) - 1
        more = np.bincount(group)[group] > 1 if len(group) else new
        met.append(np.stack([node[more], (sig[more] * short[0] + bucket).view(np.int64)], 1))
        met, needs = np.concatenate(met), np.concatenate(needs) if needs else np.zeros((0, 2), np.int64)
        n = len(needs)
        return pa.table([pa.array(np.concatenate([met[:, 0], needs[:, 0]])),
                         pa.array(np.concatenate([met[:, 1], np.zeros(n, np.int64)])),
                         pa.array(np.concatenate([np.full(len(met), np.iinfo(np.int32).min, np.int32), needs[:, 1].astype(np.int32)]))], ["node", "sig", "need"])

    packed = docs.select(text_col).mapInArrow(sign, "bucket int, sigs binary, nodes binary, runs binary, pairs binary, needs binary")
    found = stored(packed.groupBy("bucket").applyInArrow(meet, "node long, sig long, need int"), "signatures")
    none = F.lit(int(np.iinfo(np.int32).min))
    met = found.filter(F.col("need") == none).select("node", "sig").distinct()
    needs = found.filter(F.col("need") != none).groupBy("node").agg(F.max("need").alias("need"))
    able = met.groupBy("node").agg(F.count("*").alias("n")).join(needs.hint("merge"), "node").filter("n >= need").select("node")
    pairs = stored(met.join(able.hint("merge"), "node").select(F.shiftright("node", 1).alias("a"), "sig"), "pairs")
    dropped(found)
    heads = stored(pairs.groupBy("sig").agg(F.min("a").alias("b"), F.max("a").alias("last")).filter("b < last").drop("last"), "heads")
    return pairs.join(heads.hint("merge"), "sig").select("a", "b").filter("a <> b").distinct()


class Forest:
    """Union-find."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def _merge(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Members of sorted lists and how many have them: by a heap, or by sorting where a heap would take long."""
    if sum(map(len, lists)) > 4096:
        return np.unique(np.concatenate(lists), return_counts=True)
    ids, counts = [], []
    for i in heapq.merge(*[x.tolist() for x in lists]):
        if ids and ids[-1] == i:
            counts[-1] += 1
        else:
            ids.append(i)
            counts.append(1)
    return np.array(ids, np.int64), np.array(counts, np.int64)


def link(sets: list[np.ndarray], threshold: Threshold) -> Forest:
    """Components of ``sets`` under links, by T-occurrence search on their differences from the core.

    With dx = x Δ core, x Δ y = dx Δ dy, so that x and y link when 2 (q + p) |dx ∩ dy| >= ux + uy for
    u = (q + p) |d| - (q - p) |set|. The set of least u thus links with whatever can be linked without a common difference,
    and the others are searched for.
    """
    n, forest, p, q = len(sets), Forest(len(sets)), threshold.p, threshold.q
    size = np.array([len(s) for s in sets])
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(n), size)
    names, token = np.unique(tokens, return_inverse=True)
    core = np.bincount(token) * 2 > n
    place = np.cumsum(core) - 1
    absent = np.ones((n, int(core.sum())), bool)
    of_core = core[token]
    absent[owner[of_core], place[token[of_core]]] = False
    who, what = np.nonzero(absent)
    token = np.concatenate([token[~of_core], np.flatnonzero(core)[what]])  # the differences: what is extra, what is absent
    owner = np.concatenate([owner[~of_core], who])
    u = (q + p) * np.bincount(owner, minlength=n) - (q - p) * size
    hub = int(u.argmin())
    for x in np.flatnonzero(u + u[hub] <= 0).tolist():
        if x != hub:
            forest.join(hub, x)
    order = np.lexsort((owner, token))
    token, owner = token[order], owner[order]
    key = token * n + owner  # (token, owner) in order, for binary search
    first = np.searchsorted(token, np.arange(len(names) + 1))
    length = np.diff(first)
    shared = length[token] > 1
    order = np.argsort(owner[shared], kind="stable")
    own = token[shared][order]  # of each set, its differences that others have too
    start = np.searchsorted(owner[shared][order], np.arange(n + 1))
    main = forest.root(hub)
    for x in range(n):
        if forest.root(x) == main:  # its links to others are found from their side
            continue
        lists = own[start[x]:start[x + 1]]
        need = max(1, -(-int(u[x] + u[hub]) // (2 * (q + p))))
        if len(lists) < need:
            continue
        lists = lists[np.argsort(-length[lists], kind="stable")]
        n_long = min(need - 1, int(need / (0.0085 * np.log2(length[lists[0]]) + 1)))
        ids, counts = _merge([owner[first[t]:first[t + 1]] for t in lists[n_long:].tolist()])
        able = (counts >= need - n_long) & (ids != x)
        ids, counts = ids[able], counts[able]
        if n_long and len(ids):
            wanted = lists[:n_long, None] * n + ids
            at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
            counts = counts + (key[at] == wanted).sum(0)
        for y in ids[2 * (q + p) * counts >= u[x] + u[ids]].tolist():
            forest.join(x, y)
    return forest


def near_components(docs: DataFrame, width: int, p: int, q: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, the smallest id reachable over links.

    Words are runs of bytes other than space, tab, line and page breaks, with A-Z in lower case; a set holds the distinct shingles of
    ``width`` words, or the whole sequence where there are fewer. Sets link at a Jaccard similarity of ``p`` / ``q`` or more.
    NULL and wordless texts have no shingles and link with nothing. Rows that repeat an id count each and share a component
    only if they link; NULL ids come back with the smallest other id of their component, or NULL. Other
    columns are not read. An empty table gives an empty result.
    """
    threshold = Threshold(p, q)
    rows = stored(shingled(docs, id_col, text_col, width, threshold), "sets")
    total = rows.agg(F.sum("parts")).first()[0] or 0
    edges = candidate_edges(docs, text_col, width, threshold, max(1, -(-total // BUCKET)), common_shingles(rows))
    classes = components(edges)
    label = _search(docs, rows, classes, width, threshold, id_col, text_col)
    full = rows.filter("n > 0").join(label.hint("merge"), "key", "left").select("id", "n", F.coalesce("label", "key").alias("label"))
    least = stored(full.groupBy("label").agg(F.min("id").alias("component_id")), "least")
    named = full.join(least.hint("merge"), "label").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
    none = rows.filter("n = 0").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return named.union(none)


def _search(docs, rows, classes, width, threshold, id_col, text_col) -> DataFrame:
    """key, label of the sets in components of several."""
    sets = rows.filter("n > 0").groupBy("key").agg(F.first("n").alias("n"), F.min("id").alias("rep"))
    sets = sets.withColumn("node", _sid_of(F.col("key")))
    sets = stored(sets.join(classes.hint("merge"), "node").select("key", "n", "rep", F.col("label").alias("class")), "candidates")
    blocks = sets.groupBy("class").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    placed = sets.join(blocks.hint("merge"), "class")
    # a class of one block is one group; otherwise every pair of blocks is one, and a set goes to those of its block
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    placed = (placed.withColumn("own", own)
              .withColumn("other", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
                  F.filter(other, lambda b: b != F.col("own")))))
              .select("key", "rep", F.xxhash64("class", F.least("own", "other"), F.greatest("own", "other")).alias("group")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = placed.join(texts.hint("merge"), F.col("rep").eqNullSafe(F.col("id")))
    grouped = found.select("group", "key", "text").repartition("group").sortWithinPartitions("group")

    def run(batches):
        group, members = None, {}
        for batch, sets in _sets(batches, width):
            for g, key, tokens in zip(batch.column("group").to_pylist(), batch.column("key").to_pylist(), sets):
                if g != group:
                    yield from search(members)
                    group, members = g, {}
                if digest(tokens) == key:  # another text may have the same id
                    members[key] = tokens
        yield from search(members)

    def search(members):
        if len(members) < 2:
            return
        keys = sorted(members)
        forest = link([members[k] for k in keys], threshold)
        pairs = [(keys[i], keys[r]) for i in range(len(keys)) if (r := forest.root(i)) != i]
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*pairs)], ["a", "b"])

    links = components(grouped.mapInArrow(run, "a binary, b binary"))
    return links.withColumnRenamed("node", "key")


def _sid_of(key) -> "F.Column":
    """The 63-bit id of a set: its key's first eight bytes, lowest first, as ``_sid``, without the lowest bit."""
    value = None
    for i in range(8):
        byte = F.conv(F.hex(F.substring(key, i + 1, 1)), 16, 10).cast("long")
        byte = F.shiftleft(byte, 8 * i)
        value = byte if value is None else value.bitwiseOR(byte)
    return F.shiftright(value, 1)


@query()
def op3_ngram_join(spark, sf_dir):
    """Documents linked at 90 % of their three-word shingles."""
    return near_components(table(spark, sf_dir, "documents"), 3, 90, 100)
