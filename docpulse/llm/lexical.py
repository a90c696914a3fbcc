"""Ranked lexical search with hashed max-sketches.

A term's impact in a document is what it adds to the score per unit of its weight. The impacts of all terms of a document fold
into a sketch: each coordinate keeps the largest impact of the terms hashed to it. Hence the sum over a query's terms of
weight times coordinate is never below the score. For a batch of documents the bounds of all queries are one matrix
product over the coordinates looked up; documents are then scored exactly in the order of falling bounds, until a
bound falls below the k-th best score found so far.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from types import SimpleNamespace
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docpulse.llm.common import query, stored, table

# Terms are runs of letters and digits of ASCII and of all other characters; only A-Z is lower-cased.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
PIECE = 1 << 20  # bytes of a text cut into terms together
PASS = 1 << 23  # bytes of a text whose terms are counted together
ITEMS, ITEM_BYTES = 512, 1 << 20  # queries of a block: so many, or so many bytes of text
BATCH = 128  # documents bounded together


def terms(body: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a piece at a time."""
    body, start = body.translate(FOLD), 0
    while start < len(body):
        stop = body.find(b" ", start + PIECE)
        stop = len(body) if stop < 0 else stop
        yield body[start:stop].split()
        start = stop


def counted(body: bytes) -> Iterator[Counter]:
    """Occurrences of the terms: of a very long text in several parts, each of which has the terms of some hashes."""
    turns = 1 + len(body) // PASS
    for turn in range(turns):
        counts = Counter()
        for part in terms(body):
            counts.update(part if turns == 1 else [t for t in part if crc32(t, 1) % turns == turn])
        yield counts


class Queries:
    """A block of queries: their ids and how often each of their terms occurs in them."""

    def __init__(self, rows: list[tuple]):
        self.ids = [i for i, _ in rows]
        counts = [Counter(t for part in terms(text) for t in part) for _, text in rows]
        self.terms = {t: k for k, t in enumerate(sorted(set().union(*counts)))}
        self.own = [(np.array([self.terms[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for c in counts]

    def weigh(self, df: dict[int, int], documents: int, width: int) -> None:
        """Weights of the terms, and the matrix of weights by coordinate and query."""
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(k, 0) + 1))) for k in range(len(self.terms))], np.int64)
        self.own = [(at, n * weight[at]) for at, n in self.own]
        coordinate = np.fromiter(map(crc32, self.terms), np.int64, len(self.terms)) % width
        self.looked_up, place = np.unique(coordinate, return_inverse=True)
        self.matrix = np.zeros((len(self.looked_up), len(self.own)))
        for item, (at, weights) in enumerate(self.own):
            np.add.at(self.matrix[:, item], place[at], weights)


def _blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[Queries]:
    rows, size = [], 0
    for key, body in queries.select(id_col, F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))).toLocalIterator():
        rows.append((key, bytes(body)))
        size += len(body)
        if len(rows) >= ITEMS or size >= ITEM_BYTES:
            yield Queries(rows)
            rows, size = [], 0
    if rows:
        yield Queries(rows)


def _bodies(batch: pa.RecordBatch) -> Iterator[tuple[object, bytes]]:
    for key, body in zip(batch.column(0), batch.column(1)):
        yield key.as_py(), body.as_py() or b""


def _statistics(rows: DataFrame, block) -> tuple[int, int, dict[int, int]]:
    """Documents with terms, all their terms, documents by query term. Tasks add up before the shuffle."""
    def add(batches):
        wanted, found = block.value["terms"], Counter()
        known = frozenset(wanted)
        for batch in batches:
            for _, body in _bodies(batch):
                n, own = 0, set()
                for part in terms(body):
                    n += len(part)
                    own |= known.intersection(part)
                found.update(wanted[t] for t in own)
                found[-1] += n > 0
                found[-2] += n
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(found.values(), pa.int64())], ["term", "n"])

    df = {r.term: r.n for r in rows.mapInArrow(add, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return df.pop(-1, 0), df.pop(-2, 0), df


class _Best:
    """The k best documents of every query so far, and bounds to reach."""

    def __init__(self, block: Queries | SimpleNamespace, k: int):
        self.block, self.k, self.found = block, k, [[] for _ in block.own]
        self.least = np.ones(len(block.own))  # of the k-th best score; a score has to be above 0
        self.scored = 0

    def take(self, keys: list, sketches: np.ndarray, impacts: list[dict[int, int]]) -> None:
        """Documents of a batch, by falling bounds until these fall below the k-th best score."""
        block = self.block
        bounds = sketches[:, block.looked_up] @ block.matrix
        bounds *= 1 + 1e-9  # sums beyond 2 ** 53 are rounded
        for item in np.flatnonzero((bounds >= self.least).any(0)).tolist():
            at, weights = block.own[item]
            best, column = self.found[item], bounds[:, item]
            for row in np.argsort(-column, kind="stable").tolist():
                if column[row] < self.least[item]:
                    break
                own = impacts[row]
                score = sum(w * own[t] for t, w in zip(at.tolist(), weights.tolist()) if t in own)
                self.scored += 1
                if score > 0:
                    insort(best, (-score, keys[row] is None, keys[row]))
                    del best[self.k:]
                    if len(best) == self.k:
                        self.least[item] = max(1, -best[-1][0])


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           query_id: str = "item_id", query_text: str = "text", width: int = 4096) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``id_col``, ``score``: the ``k`` best documents of each query with a score above 0.

    Equal scores go by ascending id, NULL ids last. A NULL or empty text has no terms: as a query it finds nothing, as a document it is
    not counted. Each row is a document or a query of its own, also where ids repeat; rows of one query id share its k places.
    Other columns are not read. Empty tables give an empty result.

    Queries are taken in blocks of 512 or of 1 MB of text; each block reads the documents twice, once for the
    statistics and once for the search, and is what is sent to the tasks. A task keeps k documents per query of the block.
    """
    spark = docs.sparkSession
    rows = docs.select(id_col, F.col(text_col).cast("binary").alias("__body"))
    kind, key = (df.schema[c].dataType.simpleString() for df, c in ((docs, id_col), (queries, query_id)))
    schema = f"`{query_id}` {key}, `{id_col}` {kind}, score long"
    found = None
    for block in _blocks(queries, query_id, query_text):
        documents, size, df = _statistics(rows, spark.sparkContext.broadcast(vars(block)))  # plain values: classes are not sent
        block.weigh(df, documents, width)
        sent = spark.sparkContext.broadcast(vars(block))
        part = stored(rows.mapInArrow(_searcher(sent, k, documents, size, width, schema), schema), "lexical")
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    order = Window.partitionBy(query_id).orderBy(F.desc("score"), F.col(id_col).asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(query_id, "rank", id_col, "score"))


def _searcher(sent, k: int, documents: int, size: int, width: int, schema: str):
    def run(batches):
        block = SimpleNamespace(**sent.value)
        best, wanted = _Best(block, k), block.terms
        keys, sketches, impacts = [], np.zeros((BATCH, width)), []
        for batch in batches:
            for key, body in _bodies(batch):
                sketch, own = sketches[len(keys)], {}
                parts = list(counted(body)) if len(body) < PASS else counted(body)
                n = sum(map(len, terms(body))) if len(body) >= PASS else sum(parts[0].values())
                if not n:
                    continue
                m = 25 + 75 * n * documents // size
                for counts in parts:
                    tf = np.fromiter(counts.values(), np.int64, len(counts))
                    impact = 1_000_000_000 * tf // (1000 * tf + 8 * m)
                    np.maximum.at(sketch, np.fromiter(map(crc32, counts), np.int64, len(counts)) % width, impact)
                    own.update((wanted[t], 1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m)) for t in wanted.keys() & counts.keys())
                keys.append(key)
                impacts.append(own)
                if len(keys) == BATCH:
                    best.take(keys, sketches, impacts)
                    keys, impacts = [], []
                    sketches[:] = 0
        if keys:
            best.take(keys, sketches[:len(keys)], impacts)
        for item, own in enumerate(best.found):
            if own:
                yield pa.RecordBatch.from_pylist([dict(zip(names, (block.ids[item], key, -less))) for less, _, key in own], arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    names = arrow.names
    return run


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@query(rf"""
    WITH words AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM documents),
    counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
    sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
    totals AS (SELECT count(*) AS documents, sum(n)::BIGINT AS size FROM sizes),
    weights AS (
        SELECT term, floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, totals GROUP BY term),
    items AS (
        SELECT item_id, term, count(*) AS times
        FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
              FROM benchmark)
        GROUP BY ALL),
    scores AS (
        SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // size))))::BIGINT AS score
        FROM items JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id), totals
        GROUP BY item_id, doc_id),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""")
def op12_lexical(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
