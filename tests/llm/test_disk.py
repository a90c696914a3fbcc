"""What operators leave on disk while they run: shuffle files end with the write that made them, edges with their round."""

import os

from pyspark.sql import functions as F

from docpulse.llm.common import stored
from docpulse.llm.components import components
from docpulse.llm.exact_dedup import exact_dedup
from docpulse.session import shared_dir


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def folders(spark, name):
    top = f"{shared_dir(spark).removeprefix('file://')}/docpulse-llm"
    return {f for f in os.listdir(top) if f.startswith(name)} if os.path.isdir(top) else set()


def test_stored_leaves_no_shuffle_files(spark):
    counts = spark.range(10_000).groupBy((F.col("id") % 1_000).alias("k")).count()
    joined = counts.join(counts.withColumnRenamed("count", "c").hint("merge"), "k")
    before = shuffle_files(spark)
    table = stored(joined, "disk")
    assert not shuffle_files(spark) - before
    assert table.count() == 1_000 and joined.count() == 1_000  # what was written from can be read once more
    again = stored(joined, "disk")
    assert again.exceptAll(table).isEmpty()


def test_components_keep_the_last_edges_only(spark):
    before = folders(spark, "edges-")
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i % 10 != 9], "a long, b long")
    found = components(edges)
    assert len(folders(spark, "edges-") - before) == 1
    assert {(r.node, r.label) for r in found.collect()} == {(i, i // 10 * 10) for i in range(40)}


def test_exact_dedup_keeps_each_text_once(spark, docs):
    before = folders(spark, "parts-") | folders(spark, "splits-")
    rows = [(i, f"{i % 50:03d} " + "word " * 900) for i in range(200)] + [(900 + i, "short") for i in range(3)] + [(999, "alone")]
    got = exact_dedup(docs([(i, "same head " * 20 + t) for i, t in rows]), head=16, step=32, growth=4)
    made = (folders(spark, "parts-") | folders(spark, "splits-")) - before
    top = f"{shared_dir(spark).removeprefix('file://')}/docpulse-llm"
    held = sum(spark.read.parquet(f"{top}/{f}").count() for f in made if any(n.endswith(".parquet") for _, _, ns in os.walk(f"{top}/{f}") for n in ns))
    assert held == len(rows)
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()} == {
        *((i, 150 + i % 50, 4, i >= 150) for i in range(200)), *((900 + i, 902, 3, i == 2) for i in range(3)), (999, 999, 1, True)}
