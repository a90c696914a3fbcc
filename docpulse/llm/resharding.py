"""Resharding by minimum-cost flow.

Old shards supply the bytes they hold, new shards demand their capacities; bytes that stay cost nothing, bytes that move one
each, or what a matrix says. The flow of least cost tells how many bytes go from each old shard to each new one. Documents of
an old shard lie on a line, in blocks, equal texts side by side: the flows cut the line, whole blocks fall between two cuts, and only
where a cut falls into a block are its documents dealt one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docpulse.llm.common import query, stored, table, without

OWN = ["size", "text_crc32", "old_shard", "shard", "slot"]
BLOCK = ["old_shard", "__long", "__bucket", "__sub"]
LONG = 1024  # a document of more than one in so many bytes of a shard is a long one
BEYOND = 1 << 61


def transfers(supply: Sequence[int], demand: Sequence[int], cost: Sequence[Sequence[float]] | None = None) -> list[list[int]]:
    """Amounts from each supply to each demand at least total cost; both must have one sum.

    Successive shortest paths: what is left at the supplies goes along the cheapest way to an open demand, which may
    take back earlier amounts. By default an amount costs 0 where both have the same place and 1 elsewhere.
    """
    if sum(supply) != sum(demand):
        raise ValueError("supply and demand differ")
    m, n = len(supply), len(demand)
    price = np.array(cost if cost is not None else 1 - np.eye(m, n), float).reshape(m, n)
    left, wanted = list(supply), list(demand)
    flow = np.zeros((m, n), dtype=object)
    flow[:] = 0
    while any(left):
        to = np.full(n, np.inf)
        at = np.where(np.array(left, dtype=object) > 0, 0.0, np.inf)
        before_new, before_old = np.zeros(n, int), np.full(m, -1)
        used = flow > 0
        while True:
            way = at[:, None] + price
            better = way.min(0) < to - 1e-12
            to, before_new = np.where(better, way.min(0), to), np.where(better, way.argmin(0), before_new)
            back = np.where(used, to[None, :] - price, np.inf)
            closer = back.min(1) < at - 1e-12
            if not closer.any():
                break
            at, before_old = np.where(closer, back.min(1), at), np.where(closer, back.argmin(1), before_old)
        end = min((j for j in range(n) if wanted[j]), key=lambda j: to[j])
        path, j = [], end
        while True:
            i = int(before_new[j])
            path.append((i, j, 1))
            if before_old[i] < 0:
                break
            j = int(before_old[i])
            path.append((i, j, -1))
        amount = min([left[path[-1][0]], wanted[end], *[flow[i, j] for i, j, sign in path if sign < 0]])
        for i, j, sign in path:
            flow[i, j] += sign * amount
        left[path[-1][0]] -= amount
        wanted[end] -= amount
    return flow.tolist()


def capacities(total: int, weights: Sequence[float]) -> list[int]:
    """``total`` in parts as large as the weights, to the nearest whole number."""
    ends = [round(total * float(sum(weights[:j])) / sum(weights)) for j in range(1, len(weights))]
    ends = [0, *ends, total]
    return [b - a for a, b in zip(ends, ends[1:])]


def reshard(docs: DataFrame, old_shard: Column, old_shards: int, weights: Sequence[float], cost: Sequence[Sequence[float]] | None = None,
            id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = (), block_rows: int = 4096,
            grown: Sequence[float] | None = None) -> DataFrame:
    """One row per document: id, ``keep`` columns, ``size``, ``text_crc32``, ``old_shard``, ``shard``, ``slot``, and ``grown_shard`` with ``grown``.

    ``size`` is the text's bytes plus 1. ``old_shard`` is a number below ``old_shards``; a document with NULL or another number is in
    none yet. ``weights`` has a positive number per new shard, which gets that share of all bytes; the i-th old shard is the
    i-th new one where both exist. ``slot`` counts a shard's documents from 0 without gaps. Shards differ from their shares by
    at most half the documents at the cuts, of which there are fewer than old and new shards together.

    ``grown`` has the weights of a further layout, of more shards or other shares. ``grown_shard`` is where it puts a document, the new
    layout being the old one then: again at least cost, so that nothing moves but what shards gain or lose.

    Equal texts of one old shard stay together unless they are so many that they fill blocks of their own, or a cut falls among them.
    A NULL text counts as an empty one; NULL and repeated ids are rows of their own, and rows alike in everything are told
    apart by their place in the input only. Columns of ``keep`` named like the new ones give way to them. An empty
    table gives an empty result. Only a row per old shard goes through the driver: their number is a setting.
    """
    if any(not w or min(w) <= 0 for w in (weights, *([] if grown is None else [grown]))):
        raise ValueError("every new shard needs a positive weight")
    body = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    own = OWN if grown is None else [*OWN, "grown_shard"]
    names = [c for c in keep if c != id_col and c.lower() not in own]
    number = old_shard.cast("int")
    rows = stored(docs.select(
        id_col, *[f"`{c}`" for c in names], (F.length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.when(number.between(0, old_shards - 1), number).otherwise(F.lit(old_shards)).alias("old_shard"),
        F.xxhash64(body).alias("__hash"), F.monotonically_increasing_id().alias("__row")), "reshard")
    dealt = _deal(rows, old_shards, weights, cost, id_col, block_rows)
    earlier = Window.partitionBy("shard").orderBy(*BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("shard", *BLOCK).agg(F.count("*").alias("__n")).select(
        "shard", *BLOCK, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__first"))
    known = [id_col, *[f"`{c}`" for c in names], "size", "text_crc32"]
    old = F.when(F.col("old_shard") < old_shards, F.col("old_shard"))
    placed = dealt.join(parts.hint("merge"), ["shard", *BLOCK]).withColumn("slot", F.col("__first") + F.col("__place"))
    if grown is None:
        return placed.select(*known, old.alias("old_shard"), "shard", "slot")
    placed = stored(placed.select(*known, old.alias("__old"), F.col("shard").alias("old_shard"), "slot", "__hash", "__row"), "placed")
    return _deal(placed, len(weights), grown, None, id_col, block_rows).select(
        *known, F.col("__old").alias("old_shard"), F.col("old_shard").alias("shard"), "slot", F.col("shard").alias("grown_shard"))


def _deal(rows: DataFrame, old_shards: int, weights: Sequence[float], cost: Sequence[Sequence[float]] | None, id_col: str, block_rows: int) -> DataFrame:
    """Rows (id, ``size``, ``old_shard``, ``__hash``, ``__row``) with their block, their new ``shard`` and their place in the block's share of it."""
    held = {r.old_shard: r for r in rows.groupBy("old_shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
    supply = [held[i].bytes if i in held else 0 for i in range(old_shards + 1)]
    n = [held[i].n if i in held else 0 for i in range(old_shards + 1)]
    total = sum(supply)
    if cost is None:
        cost = 1 - np.eye(old_shards + 1, len(weights))
        cost[old_shards] = 1
    flow = transfers(supply, capacities(total, weights), cost)

    per_shard = F.array(*[F.lit(max(1, -(-k // block_rows))) for k in n])
    rows = rows.withColumns({"__long": F.col("size") > F.lit(total // (LONG * len(weights))),
                             "__bucket": F.pmod("__hash", per_shard[F.col("old_shard")])})
    crowded = stored(rows.groupBy(*BLOCK[:3]).agg(F.count("*").alias("__n")).filter(F.col("__n") > 4 * block_rows), "crowded")
    rows = rows.join(crowded, BLOCK[:3], "left").withColumn(
        "__sub", F.coalesce(F.pmod("__row", F.ceil(F.col("__n") / block_rows)), F.lit(0))).drop("__n")
    # long documents come first, the largest flow too, so that few cuts fall on long documents
    before = Window.partitionBy("old_shard").orderBy(F.desc("__long"), "__bucket", "__sub").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored(rows.groupBy(*BLOCK).agg(F.sum("size").alias("__bytes")).select(
        *BLOCK, F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__start")), "blocks")
    cuts = rows.sparkSession.createDataFrame([(i, _cuts(own)) for i, own in enumerate(flow)],
                                             "old_shard int, __cuts array<struct<upto: long, shard: int>>")
    line = Window.partitionBy(*BLOCK).orderBy(F.desc("size"), "__hash", F.asc_nulls_last(id_col), "__row")
    middle = 2 * (F.col("__start") + F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))) - F.col("size")
    dealt = (rows.join(blocks.hint("merge"), BLOCK).withColumn("__middle", middle)
             .join(F.broadcast(cuts), "old_shard")  # a row per old shard
             .withColumn("shard", F.expr("filter(__cuts, c -> 2 * c.upto > __middle)[0].shard")))
    place = Window.partitionBy(*BLOCK, "shard").orderBy(F.desc("size"), "__hash", F.asc_nulls_last(id_col), "__row")
    return stored(dealt.withColumn("__place", F.row_number().over(place) - 1).drop("__cuts", "__middle", "__start"), "dealt")


def _cuts(flow: Sequence[int]) -> list[tuple[int, int]]:
    """(end on the line, new shard) of what leaves one old shard, the largest amount first."""
    ends, done = [], 0
    for amount, shard in sorted(((a, j) for j, a in enumerate(flow) if a), key=lambda x: (-x[0], x[1])):
        done += amount
        ends.append((done, shard))
    return [*ends[:-1], (BEYOND, ends[-1][1])] if ends else [(BEYOND, 0)]


def rewrite(assigned: DataFrame, folder: str, generation: int) -> list[int]:
    """Bring the files below ``folder`` to the new layout and return the old shards whose files were replaced or dropped.

    ``folder`` has the old layout, ``shard=<n>/generation=<g>/`` with smaller generations; ``assigned`` is the result of
    ``reshard`` over it with the columns to ``keep``. Documents that arrive in a shard are written to it as further files; a shard
    that some leave is written anew, and files of one that none leaves stay as they are. A run that was cut
    short is repeated with the same ``generation`` and ``assigned``, which does not depend on the folder any more.
    """
    spark = assigned.sparkSession
    rows = stored(without(assigned, ["slot", "generation"]), "rewrite")
    gone = F.col("old_shard").isNotNull() & (F.col("old_shard") != F.col("shard"))
    leaving = [r.old_shard for r in rows.filter(gone).select("old_shard").distinct().collect()]  # bounded by the number of shards
    written = rows.filter(F.col("old_shard").isNull() | (F.col("old_shard") != F.col("shard")) | F.col("old_shard").isin(leaving))
    (written.drop("old_shard", "size", "text_crc32").withColumn("generation", F.lit(generation))
     .repartition("shard", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in written.columns]), F.lit(16)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard", "generation").parquet(folder))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for shard in leaving:
        path = hadoop.Path(f"{folder}/shard={shard}")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in files.listStatus(path) if files.exists(path) else ():
            if status.getPath().getName() != f"generation={generation}":
                files.delete(status.getPath(), True)
    return sorted(leaving)


@query()
def op11_reshard(spark, sf_dir):
    """All documents from twelve shards by hash to eight of equal bytes, and from these to nine."""
    docs = table(spark, sf_dir, "documents")
    old = F.pmod(F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))), F.lit(12))
    return reshard(docs, old, 12, [1] * 8, grown=[1] * 9).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        "grown_shard", "old_shard")
