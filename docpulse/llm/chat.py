"""Chat formatting: logged snapshots of one conversation collapse to the longest, which is then rendered.

A turn's prefix hash covers all turns up to it and rolls: hashes of (place, role, text) are summed, so that prefixes
grow by addition. A conversation is dropped when its whole hash is the prefix hash of a longer one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docpulse.llm.common import query, table

SUMS = ["__a", "__b", "__c", "__d"]


def _rolled(rows: DataFrame, stretch: list[str], order: list, columns: list[str]) -> DataFrame:
    """Running sums of ``columns`` per conversation, over stretches first, so that a long one has many tasks."""
    whole = Window.partitionBy(stretch[0]).orderBy(stretch[1]).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*stretch).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    none = F.lit(0).cast("long")
    sums = rows.groupBy(*stretch).agg(*[F.sum(c).alias(c) for c in columns])
    before = sums.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(stretch)],
                         *[F.coalesce(F.sum(c).over(whole), none).alias(f"__before{c}") for c in columns])
    match = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(stretch)]
    return (rows.withColumns({c: F.sum(c).over(inside) for c in columns}).join(before, match)
            .withColumns({c: F.col(c) + F.col(f"__before{c}") for c in columns})
            .drop("__k0", "__k1", *[f"__before{c}" for c in columns]))


def maximal_turns(turns: DataFrame, stretch: int = 1024) -> DataFrame:
    """Turns of the maximal conversations, rendered: conv_id, pos (from 1), n_turns, role, rendered.

    ``turns`` has conv_id, turn, role, text; other columns are not read. Turns go by turn, role and text, NULLs first;
    repeated rows count once. NULL role reads as "user", NULL text as empty; a NULL conv_id is a conversation too. Of equal
    conversations the smallest id stays, NULL before any other. A rendered turn is one row, whose concatenation by
    pos is the conversation, so that no task gathers a conversation of any length. ``stretch`` turn numbers are one
    stretch of the rolling sums. Hashes have 128 bits.
    """
    t = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).distinct().withColumn("__s", F.floor(F.col("turn") / stretch))
    order, where = ["turn", "role", "text"], ["conv_id", "__s"]
    t = _rolled(t.withColumn("pos", F.lit(1).cast("long")), where, order, ["pos"])
    hashes = {"__x": F.xxhash64(F.lit(1), "pos", "role", "text"), "__y": F.xxhash64(F.lit(2), "text", "role", "pos")}
    low = F.lit(0xFFFFFFFF)
    t = t.withColumns(hashes).withColumns({
        "__a": F.col("__x").bitwiseAND(low), "__b": F.shiftrightunsigned("__x", 32),
        "__c": F.col("__y").bitwiseAND(low), "__d": F.shiftrightunsigned("__y", 32)}).drop("__x", "__y")
    t = _rolled(t, where, order, SUMS)
    lengths = t.groupBy(F.col("conv_id").alias("__conv")).agg(F.max("pos").alias("n_turns"))
    t = t.join(lengths, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
    prefix = t.filter("pos < n_turns").select("pos", *SUMS).distinct()
    whole = t.filter("pos = n_turns").select("conv_id", "pos", *SUMS).join(prefix, ["pos", *SUMS], "left_anti")
    # NULL comes first in min over a struct's fields; a plain min would skip it
    stays = whole.groupBy("pos", *SUMS).agg(F.min(F.struct("conv_id")).alias("__m")).select(F.col("__m.conv_id").alias("__conv"))
    return (t.join(stays, F.col("conv_id").eqNullSafe(F.col("__conv")), "left_semi")
            .select("conv_id", "pos", "n_turns", "role", F.concat(
                F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n")).alias("rendered")))


@query("""
    WITH t AS (
        SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations),
    p AS (
        SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n_turns,
               list({'r': role, 't': text}) OVER (w ROWS UNBOUNDED PRECEDING) AS prefix
        FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
    whole AS (
        SELECT conv_id, prefix FROM p WHERE pos = n_turns
            AND prefix NOT IN (SELECT prefix FROM p WHERE pos < n_turns)),
    stays AS (SELECT min(conv_id) AS conv_id FROM whole GROUP BY prefix)
    SELECT conv_id, pos, n_turns, role, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered
    FROM p JOIN stays USING (conv_id)
""")
def op2_chat_format(spark, sf_dir):
    """Rendered turns of all maximal conversations."""
    return maximal_turns(table(spark, sf_dir, "conversations"))
