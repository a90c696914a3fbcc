"""The quality gate as one plan: features of raw files, rules, check and issue rows.

File bytes never meet a shuffle: each file is reduced to a few features where it is read, and
only these are joined with the metrics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpulse import constants as C
from docpulse.constants import LIMITS, Limits
from docpulse.functions.paths import checked_extension, detect_kind, parse_raw_paths
from docpulse.operators.decode import decode_text
from docpulse.operators.pages import page_text_stats, sampled_pages, scan_page_stats
from docpulse.operators.rules import judge, with_kind
from docpulse.schemas import FILE_METRICS


def content_features(content: DataFrame) -> DataFrame:
    """``path, length, modified, head, encoding, chars`` of files with their bytes."""
    name = F.substring_index(F.col("path"), "/", -1)
    is_text = detect_kind(checked_extension(name)) == "text"
    files = content.select(
        "path", "length", F.col("modificationTime").alias("modified"), "content",
        F.substring(F.col("content"), 1, C.HEAD_BYTES).alias("head"),
    )
    return decode_text(files, is_text)


def file_rows(features: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Files to judge. The manifest (``path, is_file, length``) also names the files a content
    source leaves out: empty ones, folders and missing ones (``is_file`` NULL)."""
    if manifest is None:
        return features.withColumns({"found": F.lit(True), "is_file": F.lit(True)})
    known = ["modified"] if "modified" in manifest.columns else []
    listed = manifest.select("path", F.col("is_file").isNotNull().alias("found"),
                             F.coalesce("is_file", F.lit(False)).alias("is_file"), "length", *known)
    return listed.join(features.drop("length", *known), "path", "left")


def _attach(rows: DataFrame, more: DataFrame | None, name: str, ddl: str) -> DataFrame:
    """Add the columns of ``more`` as struct ``name``, NULL where the path is not in it."""
    if more is None:
        return rows.withColumn(name, F.lit(None).cast(ddl))
    packed = more.select("path", F.struct(*[c for c in more.columns if c != "path"]).alias(name))
    return rows.join(packed, "path", "left")


_PAGE = "struct<page:int, stdev:double, mean:double, blur_var:double, skew:int, skew_conf:double, dpi:double>"
PAGES = (
    "struct<sampled_pages:bigint, total_chars:bigint, avg_chars:double, low_text_pages:bigint, empty_pages:bigint, "
    "low_ratio:double, scan_pages:int, scan_blur:double, scan_stdev:double, scan_mean:double, scan_dpi:double, "
    f"blurry:array<{_PAGE}>, low_contrast:array<{_PAGE}>, skewed:array<{_PAGE}>, low_dpi:array<{_PAGE}>>"
)
IMAGE = ("struct<decoded:boolean, width:int, height:int, image_mode:string, mean:double, stdev:double, blur:double>")
METRICS = "struct<" + FILE_METRICS.replace("path STRING,", "").strip() + ", scan_skipped BOOLEAN>"


def check_files(
    files: DataFrame, file_metrics: DataFrame | None = None, page_metrics: DataFrame | None = None,
    images: DataFrame | None = None, mode: str = "standard", limits: Limits = LIMITS, run_id: str = "",
) -> DataFrame:
    """Judge files (see :func:`file_rows`); adds the columns of a check and its ``issues``.

    Files without metrics get the notice that the check of their content was skipped.
    """
    pages = None
    if file_metrics is not None:
        if "scan_skipped" not in file_metrics.columns:
            file_metrics = file_metrics.withColumn("scan_skipped", F.lit(page_metrics is None))
        if page_metrics is not None:
            openable = file_metrics.filter("open_error IS NULL AND NOT coalesce(encrypted, false)")
            sampled = sampled_pages(page_metrics, openable.select("path", "page_count"), limits)
            pages = scan_page_stats(page_text_stats(sampled, limits), limits)
    rows = parse_raw_paths(with_name(files))
    rows = _attach(rows, file_metrics, "metrics", METRICS)
    rows = _attach(rows, pages, "pages", PAGES)
    rows = _attach(rows, images, "image", IMAGE)
    for column, kind in (("head", "binary"), ("encoding", "string"), ("chars", "bigint"), ("modified", "timestamp")):
        if column not in rows.columns:
            rows = rows.withColumn(column, F.lit(None).cast(kind))
    rows = rows.withColumns({
        "check_id": check_id(F.col("blob_path"), F.col("modified"), run_id),
        "file_size_bytes": F.coalesce("length", F.lit(0)).cast("bigint"),
    })
    return judge(with_kind(rows), mode, limits)


def with_name(files: DataFrame) -> DataFrame:
    return files.withColumn("file_name", F.substring_index(F.col("path"), "/", -1))


def check_id(blob_path: Column, modified: Column, run_id: str = "") -> Column:
    """Id of a check: one per file, time of change and run, so the same when the run is retried."""
    return F.xxhash64(blob_path, modified, F.lit(run_id))
