"""Exact top-k search by inner product as a Voronoi kNN join.

Pivots cut the vectors into cells, stored in pieces of bounded size. A cell's summary is its pivot, its radius, its
largest norm and the ranges of its vectors along and across the pivot's direction. Each query is first solved in its own
cell, which gives a floor under its k-th best score; with the summaries it then knows a ceiling over its scores in any
other cell, and is sent to the cells whose ceiling reaches its floor, to no others. As queries go to cells, stored vectors are
grouped once and never copied; where no cell can be ruled out, a query is one short row for each piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docpulse.llm.common import query, stored, table

PIECE = 4096  # vectors of a piece, and fewer if they are long
NARROW = 2.0**15  # components below it are stored in two bytes


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list<double> column of equal length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unpacked(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a binary column of vectors of one width."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.int16 if len(raw) == 2 * dim * len(column) else np.float64).reshape(-1, dim).astype(np.float64)


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def _units(p: np.ndarray) -> np.ndarray:
    length = _lengths(p)
    return p / np.where(length > 0, length, 1)[:, None]


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: doubles while they are exact, 64-bit integers beyond."""
    top = np.sqrt((q * q).sum(1).max() * (x * x).sum(1).max())
    return (q @ x.T).astype(np.int64) if top < 2.0**52 else q.astype(np.int64) @ x.astype(np.int64).T


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          pivots: int | None = None, group: int = 512) -> DataFrame:
    """query_id, rank (from 1), id, score: the ``k`` best inner products of each query with every other row.

    ``vectors`` has whole-numbered components as doubles and BIGINT ids. Rows whose vector is NULL, empty or holds a NULL or non-finite
    component, and rows without an id, take no part; of several lengths only vectors as long as a query's are its
    candidates. Ties go to the smaller id. Rows repeating an id are candidates each, but none of its own id, and
    rows repeating a query's id share its ``k`` results. Fewer than
    ``k`` candidates give fewer rows. Other columns are not read. ``pivots`` bounds the summaries, which alone are sent to
    the tasks (by default a quarter of the square root of the rows, 32 to 4,096); ``group`` the queries of a block.
    """
    v = _usable(vectors, id_col, vector_col)
    dims = [r.dim for r in v.filter(is_query(F.col("id"))).select("dim").distinct().collect()]
    parts = [_one_length(v.filter(F.col("dim") == d).select("id", "x"), d, is_query, k, pivots, group) for d in sorted(dims)]
    out = parts[0] if parts else v.select(F.col("id").alias("query_id"), "id", F.col("id").alias("score")).limit(0)
    for part in parts[1:]:
        out = out.unionByName(part)
    return _best(out, k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    x = F.col(vector_col)
    return (vectors.filter(F.col(id_col).isNotNull() & (F.size(x) > 0)
                           & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
            .select(F.col(id_col).alias("id"), x.cast("array<double>").alias("x"), F.size(x).alias("dim")))


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query id, whatever cell or length they come from."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _pivots(v: DataFrame, rows: int, n: int) -> np.ndarray:
    """Distinct vectors of lowest hash; any choice gives the same result."""
    code = F.xxhash64("x")
    part = min(1.0, 64 * n / max(1, rows))  # equal vectors are sought among a share of all, if that is enough
    few = v.filter(code < int(-2**63 + part * 2**64)) if part < 1 else v
    chosen = few.select("x").distinct().orderBy(code).limit(n).collect()
    if part < 1 and len(chosen) < n:
        chosen = v.select("x").distinct().orderBy(code).limit(n).collect()
    return np.array([r.x for r in chosen])


def _cells(v: DataFrame, is_query, k: int, n_pivots: int | None):
    """Every vector with its cell and what the summaries need; vectors of two widths never share a cell (2 * pivot + wide)."""
    rows = v.count()
    # rows of a query's own id may be among the best anywhere, so that floors have to leave room for as many
    own = v.filter(is_query(F.col("id"))).groupBy("id").count().agg(F.max("count")).first()[0] or 1
    n = n_pivots or min(4096, max(32, int(rows**0.5) // 4))
    pivot = v.sparkSession.sparkContext.broadcast(_pivots(v, rows, n))

    def assign(batches):
        p = pivot.value
        unit, square = _units(p), (p * p).sum(1)
        step, salt = max(1, 2**21 // len(p)), 0
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                x = _matrix(part.column("x"))
                dot, length = x @ p.T, (x * x).sum(1)
                d = length[:, None] + square - 2 * dot
                near = d.argmin(1)
                along = (x * unit[near]).sum(1)
                wide = np.abs(x).max(1) >= NARROW
                narrow = np.where(wide[:, None], 0, x).astype(np.int16)
                seen = np.full(len(x), -np.inf)
                if len(p) >= k + own:
                    seen = np.partition(dot, len(p) - k - own, 1)[:, len(p) - k - own]
                    seen = seen - 1e-9 * (1 + np.abs(seen))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([(x if w else narrow)[i].tobytes() for i, w in enumerate(wide)], pa.binary()),
                     pa.array(2 * near + wide, pa.int32()), pa.array(np.arange(salt, salt + len(x)), pa.int64()),
                     pa.array(np.sqrt(np.maximum(0, d[np.arange(len(x)), near]))), pa.array(along),
                     pa.array(np.sqrt(np.maximum(0, length - along * along))), pa.array(np.sqrt(length)), pa.array(seen)],
                    ["id", "x", "cell", "salt", "far", "along", "across", "norm", "floor"])
                salt += len(x)

    schema = "id long, x binary, cell int, salt long, far double, along double, across double, norm double, floor double"
    return stored(v.mapInArrow(assign, schema), "cells"), pivot


def _summaries(cells: DataFrame, size: int) -> DataFrame:
    """One row a cell, twice the number of pivots at most."""
    return stored(cells.groupBy("cell").agg(
        F.count("*").alias("n"), F.ceil(F.count("*") / size).cast("int").alias("pieces"), F.max("far").alias("far"),
        F.min("along").alias("low"), F.max("along").alias("high"), F.max("across").alias("across"), F.max("norm").alias("norm")), "summaries")


def _targets(queries: DataFrame, summaries: DataFrame, pivot, dim: int) -> DataFrame:
    """Queries with the cells, other than their own, whose ceiling reaches their floor."""
    known = np.array([(r.cell, r.far, r.low, r.high, r.across, r.norm) for r in summaries.collect()])
    known = queries.sparkSession.sparkContext.broadcast(known)

    def reach(batches):
        cell, far, low, high, across, norm = known.value.T
        p = pivot.value[cell.astype(int) // 2]
        unit, size = _units(p), _lengths(p)
        step = max(1, 2**20 // len(p))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                # queries of two widths are unpacked one by one
                x = np.concatenate([_unpacked(part.column("x").slice(i, 1), dim) for i in range(len(part))])
                length = _lengths(x)[:, None]
                along = x @ unit.T
                across_q = np.sqrt(np.maximum(0, length * length - along * along))
                ceiling = np.minimum(x @ p.T + length * far, np.maximum(along * low, along * high) + across_q * across)
                ceiling = np.minimum(ceiling, length * norm) + 1e-6 * (1 + length * (1 + size + far + norm))
                floor = np.asarray(part.column("floor"))
                need = (ceiling >= floor[:, None]) & (cell != np.asarray(part.column("cell"))[:, None])
                ends = np.concatenate([[0], need.sum(1).cumsum()])
                cells = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cell[np.nonzero(need)[1]], pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("x"), part.column("salt"), part.column("floor"), cells], ["id", "x", "salt", "floor", "cells"])

    asked = queries.select("id", "x", "salt", "floor", "cell")
    return stored(asked.mapInArrow(reach, "id long, x binary, salt long, floor double, cells array<int>"), "targets")


def _solve(asked: DataFrame, pieces: DataFrame, summaries: DataFrame, dim: int, k: int, group: int) -> DataFrame:
    """query_id, id, score: of each piece of the cells a query asks for, its ``k`` best at or above its floor."""
    each = asked.withColumn("cell", F.explode("cells"))
    groups = each.groupBy("cell").agg(F.ceil(F.count("*") / group).alias("groups"))  # a row a cell, as the summaries
    each = each.join(F.broadcast(groups.join(summaries.select("cell", "pieces"), "cell")), "cell")
    blocks = (each.withColumn("piece", F.explode(F.expr("sequence(0, pieces - 1)")))
              .withColumn("wide", F.length("x") == 8 * dim).withColumn("g", F.pmod(F.xxhash64("id", "salt"), "groups"))
              .groupBy("cell", "piece", "wide", "g").agg(F.collect_list(F.struct("id", "x", "floor")).alias("q")))

    def solve(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                q, held = batch.column("q")[row].values, batch.column("held")[row].values
                q_id, ids = np.asarray(q.field("id")), np.asarray(held.field("id"))
                score = _products(_unpacked(q.field("x"), dim), _unpacked(held.field("x"), dim))
                score[q_id[:, None] == ids] = np.iinfo(np.int64).min
                good = (score >= np.asarray(q.field("floor"))[:, None]) & (q_id[:, None] != ids)
                if len(ids) > k:  # all that reach the k-th score
                    good &= score >= np.partition(score, len(ids) - k, 1)[:, len(ids) - k, None]
                a, b = np.nonzero(good)
                order = np.lexsort((ids[b], -score[a, b], a))
                a, b = a[order], b[order]
                first = np.searchsorted(a, a)
                kept = np.arange(len(a)) - first < k
                a, b = a[kept], b[kept]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (q_id[a], ids[b], score[a, b])], ["query_id", "id", "score"])

    pairs = blocks.join(pieces.hint("merge"), ["cell", "piece"]).select("q", "held")
    return pairs.mapInArrow(solve, "query_id long, id long, score long")


def _prepared(v: DataFrame, dim: int, is_query, k: int, pivots: int | None, group: int):
    """Pieces, summaries, results in the queries' own cells, and queries with the other cells they need."""
    size = max(64, min(PIECE, 2**23 // (8 * dim)))
    cells, pivot = _cells(v, is_query, k, pivots)
    summaries = _summaries(cells, size)
    salted = cells.join(F.broadcast(summaries.select("cell", "pieces")), "cell").withColumn("piece", F.pmod(F.xxhash64("id", "salt"), "pieces"))
    pieces = stored(salted.groupBy("cell", F.col("piece").cast("int").alias("piece")).agg(F.collect_list(F.struct("id", "x")).alias("held")), "pieces")
    queries = cells.filter(is_query(F.col("id"))).select("id", "x", "salt", "floor", "cell")
    first = stored(_best(_solve(queries.withColumn("cells", F.array("cell")).drop("cell"), pieces, summaries, dim, k, group), k).drop("rank"), "first")
    low = F.min("score").cast("double")
    floors = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") >= k, low - 1e-9 * F.abs(low)).alias("least"))
    raised = queries.join(floors.hint("merge"), "id", "left").withColumn("floor", F.greatest("floor", "least"))
    return pieces, summaries, first, _targets(raised, summaries, pivot, dim)


def _one_length(v: DataFrame, dim: int, is_query, k: int, pivots: int | None, group: int) -> DataFrame:
    pieces, summaries, first, targets = _prepared(v, dim, is_query, k, pivots, group)
    return first.unionByName(_solve(targets, pieces, summaries, dim, k, group))


def sent_share(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int | None = None) -> float:
    """Share of all (query, vector) pairs whose cell is not ruled out, the queries' own cells left aside; vectors of one length."""
    v = _usable(vectors, id_col, vector_col)
    _, summaries, _, targets = _prepared(v.select("id", "x"), v.first()["dim"], is_query, k, pivots, 512)
    sent = targets.select(F.explode("cells").alias("cell")).join(summaries, "cell").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return sent / (targets.count() * summaries.agg(F.sum("n")).first()[0])


def whole(vector, times: int = 256):
    """Components times ``times``, rounded down; what has no fraction (large, NaN, infinite) stays as it is."""
    scaled = F.transform(vector, lambda c: c.cast("double") * times)
    return F.transform(scaled, lambda c: F.when(F.abs(c) < 2.0**53, F.floor(c).cast("double")).otherwise(c))


@query("""
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.x) = len(c.x)),
    r AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op10_topk(spark, sf_dir):
    """The five best of all vectors for every query vector."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", whole(F.col("embedding")).alias("embedding"))
    return top_k(v, lambda vec_id: vec_id % 50 == 0)
