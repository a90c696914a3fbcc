"""Ingest of one batch of result files.

The files are read, flattened and decoded once, into a staging table in the shared folder, one
partition per kind of row. Everything else - refused documents, statistics, the published
tables - reads the flat staging rows, column-pruned. Losing an executor repeats tasks, not the
batch. A report that goes over the rows once takes them from ``flat_rows``, which stages deep files only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docpulse import constants as C
from docpulse.functions.paths import is_result_path, parse_result_paths
from docpulse.functions.text import ci_key
from docpulse.operators.depth import by_depth, levels_needed
from docpulse.operators.documents import backlink, constraint_violations, finalize_stats
from docpulse.operators.flatten import CONTAINER, FEW, LEVELS, flatten_nodes, judge_odd, open_level
from docpulse.operators.gate import batch_summary, quarantine_rows, routing_manifest
from docpulse.operators.leaf import decode_leaves
from docpulse.operators.parse import FILE, HEADER, NODE, parse_results
from docpulse.session import clear_staging, configure, staging_dir
from docpulse.sources.sidecars import publish_sidecars
from docpulse.sources.tables import publish, read_run

VERSION = ["document_id", "version_id"]


def stage(files: DataFrame, folder: str, run_id: str, levels: int = LEVELS, first_levels: int | None = None) -> DataFrame:
    """Flat rows of a batch, written once and read back.

    Trees deeper than ``first_levels`` (``levels`` if not given) go through further rounds of ``levels`` over their
    left-over containers only, until none is left: no depth is cut off.
    """
    spark = files.sparkSession
    write = lambda rows, n: rows.withColumn("round", F.lit(n)).write.mode("overwrite").partitionBy(
        "kind").option("partitionOverwriteMode", "static").parquet(f"{folder}/{n}")
    first = decode_leaves(flatten_nodes(parse_results(files, run_id), first_levels or levels))
    write(first, 0)
    schema = rows_schema(first)
    rows = spark.read.schema(schema).parquet(f"{folder}/0")
    rest, n = rows.filter(CONTAINER), 0
    while not rest.isEmpty():
        n += 1
        nodes = rest.withColumn("node_type", F.lit(None).cast("string")).select(
            *VERSION, *FILE, "pos", *HEADER, "kind", *NODE, "error_kind", "error_message")
        for _ in range(levels):
            nodes = open_level(nodes)
        write(decode_leaves(judge_odd(nodes)), n)
        more = spark.read.schema(schema).parquet(f"{folder}/{n}")
        rows, rest = rows.unionByName(more), more.filter(CONTAINER)
    return rows


def flat_rows(files: DataFrame, folder: str, run_id: str, levels: int = LEVELS) -> DataFrame:
    """Flat rows of result files, for a reader that goes over them once.

    Files whose brackets show that ``levels`` levels are all go through one narrow stage, of which only the
    columns asked for are computed, and nothing is written. The others, if there are any, are staged below ``folder``.
    A look at the brackets of all files tells how many of these levels the stage needs.
    """
    needed, any_deep = levels_needed(files, levels, min(FEW, levels))
    shallow = by_depth(files, levels)[0] if any_deep else files
    rows = decode_leaves(flatten_nodes(parse_results(shallow, run_id), needed))
    if not any_deep:
        return rows
    _, deep = by_depth(files, levels)
    return rows.unionByName(stage(deep, folder, run_id, levels).drop("round"))


def rows_schema(decoded: DataFrame) -> T.StructType:
    """Columns of the staged rows as they are read back, the partition's last; a batch may have no rows."""
    fields = [f for f in decoded.schema if f.name != "kind"]
    return T.StructType([*fields, T.StructField("round", T.IntegerType()), decoded.schema["kind"]])


def _settle(df: DataFrame, folder: str) -> DataFrame:
    """Write a small intermediate and read it back: its size is then known to the planner, which
    broadcasts it when it is small and shuffles when it is not."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def failures(staged: DataFrame) -> DataFrame:
    """One row per unusable file with its first problem; many broken nodes meet map-side."""
    return staged.filter("kind = 'error'").groupBy(*FILE).agg(
        F.min(F.struct("error_kind", "error_message")).alias("e")
    ).select(*FILE, "e.*")


def ingest_batch(
    files: DataFrame, out: str, run_id: str, links: DataFrame | None = None,
    ingested_at: Column | None = None, deferred: int = 0, sidecars: str | None = None, runs: DataFrame | None = None,
) -> dict[str, int]:
    """Ingest ``files`` (``path, value``) as run ``run_id`` into the tables below ``out``.

    Returns the files processed, failed, skipped (of another layout) and deferred, stored as a row of ``batches``.
    A bad file never stops the batch: it is left out as a whole and logged; a document the fixed
    types cannot hold is left out alone. Fields are published before documents, and are only ever
    read through them, so a half-written run is invisible. ``deferred`` counts files the source left for later; error texts
    of failed files go to files below ``sidecars``, where given. With ``runs`` (``path, run_id, deferred``; a path once, all paths there) the
    files are those of several runs, stored as such in one go; ``run_id`` is the first of them, and the numbers are their sums.
    """
    spark = configure(files.sparkSession)
    now = ingested_at if ingested_at is not None else F.date_trunc("millisecond", F.current_timestamp())
    folder = staging_dir(spark, out, run_id)
    paths = files.select("path") if runs is None else runs.select("path")  # without a look into the files, where a listing has them

    def store(rows: DataFrame, table: str, path: str = "blob_path") -> None:
        if runs is None:
            return publish(rows, out, table, run_id)
        return publish(rows.join(runs.select(F.concat_ws("/", F.lit(C.SOURCE), "path").alias(path), "run_id"), path), out, table, None)

    staged = stage(files, folder, run_id, first_levels=FEW)
    headers, leaves = staged.filter("kind = 'document'"), staged.filter("kind = 'leaf'")
    bad_files = _settle(failures(staged), f"{folder}/bad_files")
    usable = headers.join(bad_files, "blob_path", "left_anti")
    violations = _settle(constraint_violations(usable, leaves), f"{folder}/violations")  # few or none, which spares the headers a shuffle
    refused = _settle(violations.join(usable.select(*VERSION, *FILE), VERSION, "inner"), f"{folder}/refused")
    bad_versions = _settle(
        headers.join(bad_files, "blob_path", "left_semi").select(*VERSION)
        .unionByName(refused.select(*VERSION)), f"{folder}/bad_versions")
    good = usable.join(bad_versions, VERSION, "left_anti")
    fields = leaves.join(bad_versions, VERSION, "left_anti")

    # A key "a.b" and a key "b" below "a" have one path, but not one name and parent.
    place = F.xxhash64("version_id", "field_path", "field_name", F.coalesce("parent_path", F.lit("")), "array_index")
    store(fields.withColumn("field_id", place), "fields")
    errors = bad_files.unionByName(refused.select(
        *FILE, F.lit("SqlError").alias("error_kind"),
        F.concat(F.lit("SqlError: values out of the range of their columns: "), "violation").alias("error_message")))
    logged, quarantined = quarantine_rows(errors, C.SOURCE)
    store(logged.withColumns({
        "error_id": F.xxhash64(F.lit(run_id), "blob_path", "error_kind", "error_message"),
        "occurred_at": now,
    }), "errors")
    failed = errors.select("blob_path").distinct()
    moved = parse_result_paths(paths).join(failed, "blob_path", "left_anti").select(
        F.col("path").alias("relative"))
    one_sidecar = quarantined.groupBy("src_path", "dest_path", "disposition", "sidecar_path").agg(
        F.min("sidecar_text").alias("sidecar_text"))
    manifest = routing_manifest(moved, C.SOURCE, F.lit(C.PROCESSED)).unionByName(one_sidecar)
    if runs is not None:
        manifest = _settle(manifest, f"{folder}/manifest")
    store(manifest, "manifest", "src_path")
    done = finalize_stats(good, fields.select(*VERSION, "confidence")).withColumns({
        # A file with a refused document stays unprocessed, its good documents are kept.
        "processed_blob_url": F.regexp_replace("blob_path", f"^{C.SOURCE}/", f"{C.PROCESSED}/"),
        "ingested_at": now,
        "path_key": ci_key("blob_path"),
        "preprocess_check_id": F.lit(None).cast("bigint"),
    }).join(failed.withColumn("__failed", F.lit(True)), "blob_path", "left").withColumn(
        "processed_blob_url", F.when(F.col("__failed").isNull(), F.col("processed_blob_url")))
    if links is not None:
        done = backlink(done, links).withColumn(
            "preprocess_check_id",
            F.when(F.col("processed_blob_url").isNotNull(), F.col("preprocess_check_id")))
    store(done, "documents")
    if sidecars is not None:
        if runs is None:
            manifest = read_run(spark, out, "manifest", run_id)
        publish_sidecars(manifest.filter("sidecar_path IS NOT NULL").select(
            F.col("sidecar_path").alias("path"), F.col("sidecar_text").alias("text")), sidecars)
    # One look at the paths tells the processed from those of another layout, which have no stored path.
    blob_path = F.when(is_result_path(), F.concat_ws("/", F.lit(C.SOURCE), "path"))
    kept = paths.withColumn("blob_path", blob_path).join(failed, "blob_path", "left_anti").select(
        "path", F.when(F.col("blob_path").isNull(), "skipped").otherwise("processed").alias("outcome"))
    relative = F.substring(F.col("blob_path"), F.lit(len(C.SOURCE) + 2), F.length("blob_path")).alias("path")
    outcomes = kept.unionByName(failed.select(relative, F.lit("failed").alias("outcome")))
    if runs is None:
        publish(batch_summary(outcomes, deferred), out, "batches", run_id)
        clear_staging(spark, out, run_id)
        return summary(spark, out, run_id)
    rows = _settle(batch_summary(outcomes.join(runs, "path"), F.max("deferred"), "run_id"), f"{folder}/batches")
    publish(rows, out, "batches", None)
    totals = rows.groupBy().sum("processed", "failed", "skipped", "deferred").toDF("processed", "failed", "skipped", "deferred").first().asDict()
    clear_staging(spark, out, run_id)
    return totals


def summary(spark, out: str, run_id: str) -> dict[str, int]:
    """Files of a run by what became of them."""
    row = read_run(spark, out, "batches", run_id).drop("run_id").first()
    return row.asDict()
