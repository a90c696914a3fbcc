"""Exact duplicates by distributed MSD radix partitioning of the texts' bytes.

Documents are split by their leading bytes; a document that is alone in its part is done. The rest is split by the
next bytes, and the next, until each part holds one document or texts that have ended. Texts are equal when they end
in the same part, so equality rests on the bytes themselves and on no digest. Each split is a count per (part, next
bytes), which combines map-side, and a join back, which adaptive execution splits when one part holds many documents. Joins are
merges at every size: what they look up grows with the data, so it is never broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpulse.llm.common import dropped, query, stored, table, without

OWN = ["keep_id", "group_size", "kept", "text_sha256"]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = 128,
                step: int = 256, growth: int = 8) -> DataFrame:
    """Every input row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Of equal texts the row with the largest id stays. ``head`` bytes make the first split, ``step`` the second, each
    further one takes ``growth`` times as many. NULL text counts as empty; a NULL id is smaller than any other. Rows
    that repeat an id with the same text count each, and one of them stays. Input columns named like the four new ones
    give way to them. An empty table gives an empty result.
    """
    rows = without(docs, OWN)
    columns = rows.columns
    body = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = rows.withColumns({"__head": F.substring(body, 1, head), "text_sha256": F.sha2(body, 256)})
    shared = stored(rows.groupBy("__head").agg(F.count("*").alias("__n")).filter("__n > 1").select("__head"), "heads")
    alone = [rows.join(shared.hint("merge"), "__head", "left_anti").select(*columns, "text_sha256").transform(_single, id_col)]
    parts = stored(
        rows.withColumns({"__row": F.monotonically_increasing_id(), "__part": F.lit(0).cast("long")})
        .join(shared.hint("merge"), "__head").drop("__head"), "parts")
    active, read = parts, ""
    ended, done = [], 0
    while not active.isEmpty():
        cut = active.withColumn("__next", F.substring(body, done + 1, step))
        splits = stored(cut.groupBy("__part", "__next").agg(F.count("*").alias("__n"), F.max("__row").alias("__to"))
                        .filter("__n > 1").drop("__n"), "splits")  # stored, or the join could not split a large part
        state = F.when(F.col("__to").isNull(), "alone").when(F.length("__next") < step, "ended").otherwise("active")
        dealt = stored(
            cut.join(splits.hint("merge"), ["__part", "__next"], "left")
            .select(*columns, "text_sha256", "__row", "__to", state.alias("__state")), "parts", ["__state"])
        # each text lies on disk once, and twice only while its part is split: what has been split goes
        dropped(splits)
        dropped(parts, read)
        parts, read = dealt, "__state=active"
        alone.append(dealt.filter("__state = 'alone'").select(*columns, "text_sha256").transform(_single, id_col))
        ended.append(dealt.filter("__state = 'ended'").drop("__state"))
        active = dealt.filter("__state = 'active'").select(*columns, "text_sha256", "__row", F.col("__to").alias("__part"))
        done, step = done + step, step * growth
    single = reduce(DataFrame.unionByName, alone)
    if not ended:
        return single
    same = reduce(DataFrame.unionByName, ended)
    groups = same.groupBy("__to").agg(F.max(id_col).alias("keep_id"), F.count("*").alias("group_size"))
    # a repeated id within a group: the row written first stays
    first = same.groupBy("__to", id_col).agg(F.min("__row").alias("__first")).withColumnRenamed(id_col, "__id")
    stays = stored(groups.join(first.hint("merge"), "__to").filter(F.col("__id").eqNullSafe(F.col("keep_id")))
                   .select("__to", "keep_id", "group_size", "__first"), "stays")
    multiple = (same.join(stays.hint("merge"), "__to").withColumn("kept", F.col("__row") == F.col("__first"))
                .select(*columns, *OWN))
    return single.select(*columns, *OWN).unionByName(multiple)


def _single(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.withColumns({"keep_id": F.col(id_col), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})


@query("""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op9_exact_dedup(spark, sf_dir):
    """Copies among all documents, dropped rows included."""
    return exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *OWN)
