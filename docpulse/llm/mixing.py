"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source gets a target of words. Blocks of equal size go to the sources by highest quotients target / (2k + 1),
then, within a source, to its shards in the same way by the shard's words. A shard lays its documents on a line in
seeded order and takes its blocks from a seeded start, going round as often as its quota asks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docpulse.llm.common import query, stored, table, words

WEIGHTS = (1, 2, 3)


def targets(sources: DataFrame, most: int = 3) -> DataFrame:
    """``source_size`` per ``key`` (ordered) to ``target``, weights 1, 2, 3 repeating by key order.

    Sharing out by weight with targets capped at ``most`` times the source, and the excess shared again, ends at
    min(cap, weight * level). With sources by cap / weight, the level is the largest of (rest of words) / (rest of
    weights) over the prefixes taken as capped.
    """
    everything, in_order = Window.partitionBy(), Window.orderBy("key")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(in_order) - 1) % len(WEIGHTS) + 1)
    s = sources.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "key").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    s = s.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), none))
                     / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), none)))
    level = F.max("level").over(everything)
    return s.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * level)).drop("level", "cap")


def sainte_lague(rows: DataFrame, within: list[str], share: str, seats: Column, order: list[str]) -> DataFrame:
    """``seats`` of each group ``within`` dealt to its rows in proportion to ``share`` by highest quotients: ``quota``.

    With n rows, rounding share / d for a divisor d leaves seats over for d = total / (seats - n/2) and overdraws them
    for d = total / (seats + n/2). The quotients of seats below the first are thus all granted, those above the second
    never, and only the few between are ranked. Ties go by ``order``.
    """
    group = Window.partitionBy(*within)
    s = rows.withColumns({"__seats": seats, "__total": F.sum(share).over(group).cast("double"),
                          "__half": F.count("*").over(group) / 2.0})
    rounds = lambda c: F.floor(F.col(share) * c / F.col("__total") + 0.5).cast("long")
    none = F.lit(0).cast("long")
    some = (F.col("__total") > 0) & (F.col("__seats") > 0)
    s = s.withColumns({
        "__sure": F.when(some, F.greatest(none, rounds(F.col("__seats") - F.col("__half")) - 1)).otherwise(none),
        "__last": F.when(some & (F.col(share) > 0), rounds(F.col("__seats") + F.col("__half")) + 1).otherwise(none)})
    open_seats = (
        s.withColumn("__left", F.col("__seats") - F.sum("__sure").over(group))
        .filter(F.col("__last") > F.col("__sure"))
        .withColumn("__k", F.explode(F.sequence(F.col("__sure"), F.col("__last") - 1)))
        .withColumn("__rank", F.row_number().over(
            group.orderBy((F.col(share) / (2 * F.col("__k") + 1)).desc(), *order)))
        .filter(F.col("__rank") <= F.col("__left")))
    keys = [*within, *[c for c in order if c not in within]]
    more = open_seats.groupBy(*keys).agg(F.count("*").alias("__more"))
    return (s.join(more, keys, "left")
            .withColumn("quota", F.col("__sure") + F.coalesce("__more", none))
            .drop("__seats", "__total", "__half", "__sure", "__last", "__more"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        block: int = 64, shard_rows: int = 2_000, most: int = 3, seed: int = 17) -> DataFrame:
    """One row per document: its id, ``source``, ``size``, ``source_size``, ``target``, ``taken`` in words.

    ``block`` words are one seat; a shard holds about ``shard_rows`` documents, so a large source is spread over many.
    ``taken`` counts repeats and never exceeds ``most`` times the size. NULL sources form one source, ordered last;
    NULL and empty texts have size 0 and nothing is taken from them. Repeated rows count each. Other columns are not
    read, so their names cannot clash. An empty table gives an empty result.
    """
    d = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"))
               .withColumn("key", F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source"))), "sizes")
    per_source = d.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("__rows"))
    everything = Window.partitionBy()
    goal = targets(per_source, most)
    goal = goal.withColumn("__one", F.lit(1))
    seats = F.ceil(F.sum("source_size").over(everything) / block)
    goal = stored(sainte_lague(goal, ["__one"], "target", seats, ["key"])
                  .withColumn("__shards", F.ceil(F.col("__rows") / shard_rows)).drop("__one", "__rows", "weight"), "quotas")

    dealt = d.join(goal.select("key", "__shards"), "key").withColumn("__h", F.xxhash64(F.lit(seed), "id"))
    dealt = dealt.withColumn("__shard", F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.col("__shards"))).drop("__shards")
    shards = dealt.groupBy("key", "__shard").agg(F.sum("size").alias("__length")).join(goal, "key")
    shards = sainte_lague(shards.withColumnRenamed("quota", "__quota"), ["key"], "__length", F.col("__quota"), ["key", "__shard"])
    words_of = F.least(F.col("quota") * block, most * F.col("__length"))
    blocks = F.greatest(F.ceil(F.col("__length") / block), F.lit(1))
    shards = shards.select(
        "key", "__shard", "source_size", "target", "__length", words_of.alias("__take"),
        F.least(F.pmod(F.xxhash64(F.lit(seed + 2), "key", "__shard"), blocks) * block, F.col("__length")).alias("__from"))
    line = Window.partitionBy("key", "__shard").orderBy("__h", "id", "size")
    d = (dealt.withColumn("__end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
         .join(shards, ["key", "__shard"]))
    passes = F.when(F.col("__length") > 0, F.expr("__take div __length")).otherwise(0)
    rest = F.when(F.col("__length") > 0, F.expr("__take % __length")).otherwise(0)
    start, none = F.col("__end") - F.col("size"), F.lit(0).cast("long")

    def overlap(low, high):
        return F.greatest(none, F.least(F.col("__end"), high) - F.greatest(start, low))

    stop = F.col("__from") + rest
    part = overlap(F.col("__from"), F.least(stop, F.col("__length"))) + overlap(none, stop - F.col("__length"))
    return d.select(F.col("id").alias(id_col), "source", "size", "source_size", "target",
                    (passes * F.col("size") + part).cast("long").alias("taken"))


@query()
def op6_mix_sources(spark, sf_dir):
    """The mix of all documents: what each source aims at and how many words of each document it takes."""
    return mix(table(spark, sf_dir, "documents")).drop("source")
