"""The quality loop on stored tables: check a batch of raw files, later settle its outcomes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpulse import constants as C
from docpulse.constants import LIMITS, Limits
from docpulse.functions.paths import checked_extension, detect_kind, parse_raw_paths
from docpulse.operators.checks import check_rows, issue_rows, stored_issues
from docpulse.operators.gate import (
    batch_summary, outcome_patches, raw_manifest, rejection_errors, result_links, route_outcomes,
)
from docpulse.operators.pixels import image_features, image_size
from docpulse.plans.quality import check_files, content_features, file_rows
from docpulse.operators.rules import largest
from docpulse.session import clear_staging, configure, staging_dir
from docpulse.sources.files import read_contents, read_heads, read_images
from docpulse.sources.sidecars import publish_sidecars
from docpulse.sources.tables import OPEN_PARTS, close_checks, publish, publish_open, read_open, read_run, read_table


def check_batch(
    content: DataFrame, out: str, run_id: str, mode: str = "standard", limits: Limits = LIMITS,
    manifest: DataFrame | None = None, file_metrics: DataFrame | None = None,
    page_metrics: DataFrame | None = None, images: DataFrame | None = None, deferred: int = 0, heads: DataFrame | None = None,
    runs: DataFrame | None = None,
) -> None:
    """Judge raw files (``path, modificationTime, length, content``) and store checks and issues.

    ``heads`` has the first bytes (``path, head``) of files of the manifest whose content is not read. With ``runs`` (``path, run_id,
    deferred``; a path once) the files are those of several runs and stored as such; ``run_id`` is the first of them.
    """
    spark = configure(content.sparkSession)
    features = content_features(content)
    if heads is not None:
        features = features.unionByName(heads, allowMissingColumns=True)
    rows = file_rows(features, manifest)
    checked = check_files(rows, file_metrics, page_metrics, images, mode, limits, run_id)
    # Judged once, then written to two tables.
    folder = f"{staging_dir(spark, out, run_id)}/checked"
    run, own = (run_id, []) if runs is None else (None, ["run_id"])
    if runs is not None:
        checked = checked.join(runs.select("path", "run_id"), "path")
    checked.drop("metrics", "pages", "image", "head").write.mode("overwrite").parquet(folder)
    checked = spark.read.parquet(folder)
    now = F.date_trunc("millisecond", F.current_timestamp())
    publish(issue_rows(checked, *own), out, "issues", run)
    publish(check_rows(checked, now, *own), out, "checks", run)
    publish_open(check_rows(checked, now, stored_issues().alias("issues"), *own), out, run)
    paths = (content if manifest is None else manifest).select("path")
    misplaced = paths.join(parse_raw_paths(paths).select("path"), "path", "left_anti")
    outcomes = checked.select("path", F.lit("processed").alias("outcome")).unionByName(misplaced.select("path", F.lit("skipped").alias("outcome")))
    publish(summaries(outcomes, deferred, runs), out, "batches", run)
    clear_staging(spark, out, run_id)


def summaries(outcomes: DataFrame, deferred: int, runs: DataFrame | None) -> DataFrame:
    """The row of ``batches`` of a run's outcomes (``path, outcome``), or one for each of several ``runs``."""
    if runs is None:
        return batch_summary(outcomes, deferred)
    return batch_summary(outcomes.join(runs, "path"), F.max("deferred"), "run_id")


def settle_outcomes(spark, out: str, outcomes: DataFrame, run_id: str, strict: bool = False,
                    sidecars: str | None = None) -> DataFrame:
    """Route checked files by their outcomes and store patches, links, errors and the manifest.

    Only the checks that wait are read, and of these the parts with an outcome and what the gate refused. Returns the routed rows; files without an outcome stay pending. Reports of rejected files go to files below
    ``sidecars``, where given.
    """
    configure(spark)
    # The parts the outcomes fall into, a handful of numbers: with them the scan leaves the other folders out.
    parts = [r.part for r in outcomes.select(F.pmod(F.xxhash64("check_id"), F.lit(OPEN_PARTS)).cast("int").alias("part")).distinct().collect()]
    by_gate = ["refused", "warned"] if strict else ["refused"]
    waiting = read_open(spark, out).filter(F.col("state").isin(by_gate) | F.col("part").isin(parts))
    taken = [f"state={r.state}/part={r.part}/run_id={r.run_id}" for r in waiting.select("state", "part", "run_id").distinct().collect()]
    open_checks = waiting.drop("state", "part", "run_id").dropDuplicates(["check_id"])
    routed = route_outcomes(open_checks, outcomes, strict).withColumn("issues", F.coalesce("issues", F.array()))
    folder = f"{staging_dir(spark, out, run_id)}/routed"
    routed.write.mode("overwrite").parquet(folder)
    routed = spark.read.parquet(folder)
    now = F.date_trunc("millisecond", F.current_timestamp())
    publish(result_links(routed), out, "links", run_id)
    publish(raw_manifest(routed), out, "manifest", run_id)
    if sidecars is not None:
        publish_sidecars(read_run(spark, out, "manifest", run_id).filter("sidecar_path IS NOT NULL").select(
            F.col("sidecar_path").alias("path"), F.col("sidecar_text").alias("text")), sidecars)
    publish(rejection_errors(routed).withColumns({
        "error_id": F.xxhash64(F.lit(run_id), "blob_path", "error_kind"), "occurred_at": now,
    }), out, "errors", run_id)
    publish(outcome_patches(routed).withColumn("completed_at", now), out, "patches", run_id)
    still = routed.filter("disposition = 'pending'").withColumn("submitted_to_cu", F.lit(False))
    close_checks(still, taken, out, run_id)
    return routed  # reads the staging folder, which a later settlement of the run replaces


def check_listed(
    spark, src: str, listed: DataFrame, out: str, run_id: str, mode: str = "standard",
    limits: Limits = LIMITS, file_metrics: DataFrame | None = None, page_metrics: DataFrame | None = None, deferred: int = 0,
    runs: DataFrame | None = None,
) -> None:
    """Judge listed files below ``src`` (``path, modificationTime, length``): one check for each; ``runs`` as in :func:`check_batch`.

    Bytes are read of files within the largest limit; larger ones are judged by their size and first bytes. The
    paths of the batch are gathered here: the trigger bounds how many they are.
    """
    manifest = listed.select("path", F.lit(True).alias("is_file"), "length", F.col("modificationTime").alias("modified"))
    longest = largest(limits)
    paths = [r.path for r in listed.filter(F.col("length").between(1, longest)).select("path").collect()]
    content = read_contents(spark, src, paths, longest)
    name = F.substring_index(F.col("path"), "/", -1)
    pictures = [r.path for r in listed.filter(F.col("length").between(1, longest)).filter(
        detect_kind(checked_extension(name)) == "image").select("path").collect()]
    images = batch_images(spark, src, read_contents(spark, src, pictures, longest)) if pictures else None
    check_batch(content, out, run_id, mode, limits, manifest, file_metrics, page_metrics, images, deferred,
                read_heads(spark, src, listed.filter(F.col("length") > longest), C.HEAD_BYTES), runs)


def batch_images(spark, src: str, content: DataFrame) -> DataFrame | None:
    """Features of the images among ``content``.

    Their headers tell the dimensions: an image of more pixels than ``MOST_PIXELS`` counts as one that cannot be opened, without
    being decoded; all others go to the decoder, whatever their sides.
    """
    name = F.substring_index(F.col("path"), "/", -1)
    is_image = detect_kind(checked_extension(name)) == "image"
    sizes = content.filter(is_image).select("path", image_size("content").alias("s")).select("path", "s.*").collect()
    huge = [r for r in sizes if r.width is not None and r.width * r.height > C.MOST_PIXELS]
    skip = {r.path for r in huge}
    paths = [r.path for r in sizes if r.path not in skip]
    parts = [image_features(read_images(spark, src, paths))] if paths else []
    if huge:
        parts.append(spark.createDataFrame(
            [(r.path, False, None, None, None, None, None, None) for r in huge],
            "path STRING, decoded BOOLEAN, width INT, height INT, image_mode STRING, mean DOUBLE, stdev DOUBLE, blur DOUBLE"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def links_of(spark, out: str) -> DataFrame:
    """All stored stamps of result files."""
    return read_table(spark, out, "links")

