"""Documents: keyed replace, statistics, back-links, child rows and column limits.

A stored row belongs to a run (``run_id``) and a version (``version_id``: run, exact file path and
position in the file). Replacing means choosing the newest version per key when reading, by an
aggregate that combines map-side, so a key with very many versions is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpulse import constants as C
from docpulse.functions.text import ci_key, too_wide
from docpulse.plans.views import version_keys


def current_documents(documents: DataFrame) -> DataFrame:
    """Newest version per path and content path, both without regard to case.

    The choice is made on the few columns that order the versions; whole rows are then picked by them.
    """
    order = [c for c in ("ingested_at", "run_id", "pos", "blob_path", "content_path") if c in documents.columns]
    newest = documents.groupBy(
        ci_key("blob_path").alias("__path"), ci_key("content_path").alias("__content")
    ).agg(F.max(F.struct(*order)).alias("v")).select(*[F.col(f"v.{c}").alias(f"__{c}") for c in order])
    return documents.join(newest, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in order], "left_semi")


def surviving_children(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Child rows whose parent is still there."""
    return children.join(parents.select(*keys), keys, "left_semi")


def current_fields(fields: DataFrame, current: DataFrame) -> DataFrame:
    """Fields of the current documents; those of replaced versions are gone."""
    return surviving_children(fields, current, version_keys(fields, current))


def field_stats(fields: DataFrame, keys: list[str]) -> DataFrame:
    """Count of all fields; mean, least and greatest of the known confidences."""
    confidence = F.col("confidence")
    mean = F.try_divide(F.sum(confidence), F.count(confidence)).cast("decimal(5,4)")
    return fields.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("field_count"),
        mean.alias("avg_confidence"),
        F.min(confidence).alias("min_confidence"),
        F.max(confidence).alias("max_confidence"),
    )


def finalize_stats(documents: DataFrame, fields: DataFrame) -> DataFrame:
    """Documents with the statistics of their fields; 0 and NULLs where there are none."""
    keys = version_keys(documents, fields)
    bare = documents.drop("field_count", "avg_confidence", "min_confidence", "max_confidence")
    return bare.join(field_stats(fields, keys), keys, "left").withColumn(
        "field_count", F.coalesce("field_count", F.lit(0))
    )


def patch_processed_url(documents: DataFrame, moved: DataFrame) -> DataFrame:
    """Set the processed URL of moved files (``blob_path``, ``url``); others keep theirs. Of several
    URLs for a path the greatest holds."""
    new = moved.groupBy("blob_path").agg(F.max("url").alias("__url"))
    return documents.join(new, "blob_path", "left").select(
        *[
            F.coalesce("__url", c).alias(c) if c == "processed_blob_url" else F.col(c)
            for c in documents.columns
        ]
    )


def backlink(documents: DataFrame, links: DataFrame) -> DataFrame:
    """Set the check a document's result file was stamped with (``result_path``, ``check_id``).

    Several raw files may yield the same result path; the last stamp, the greatest raw path of
    the newest run, is the one on the file.
    """
    order = [c for c in ("run_id", "raw_path", "check_id") if c in links.columns]
    stamp = (
        links.select(F.concat_ws("/", F.lit(C.SOURCE), "result_path").alias("blob_path"), *{*order, "check_id"})
        .join(documents.select("blob_path").distinct(), "blob_path", "left_semi")  # of all links, those asked for
        .groupBy("blob_path")
        .agg(F.max_by("check_id", F.struct(*order)).alias("__check"))
    )
    kept = [c for c in documents.columns if c != "preprocess_check_id"]
    old = F.col("preprocess_check_id") if "preprocess_check_id" in documents.columns else F.lit(None)
    return documents.join(stamp, "blob_path", "left").select(
        *kept, F.coalesce("__check", old).cast("bigint").alias("preprocess_check_id")
    )


def late_links(documents: DataFrame, links: DataFrame) -> DataFrame:
    """Processed documents without a check take that of a stamp that came after they were ingested; others keep theirs."""
    missing = F.col("preprocess_check_id").isNull() & F.col("processed_blob_url").isNotNull()
    late = backlink(documents.filter(missing).select("blob_path").distinct(), links).filter("preprocess_check_id IS NOT NULL").select(
        "blob_path", F.col("preprocess_check_id").alias("__late"))
    check = F.coalesce("preprocess_check_id", F.when(missing, F.col("__late"))).alias("preprocess_check_id")
    return documents.join(late, "blob_path", "left").select(
        *[check if c == "preprocess_check_id" else F.col(c) for c in documents.columns])


def width_violations(widths: dict[str, int]) -> Column:
    """Names of the columns of a row that do not fit their stored width; '' when all do."""
    return F.concat_ws(", ", *[F.when(too_wide(F.col(c), n), c) for c, n in widths.items()])


def constraint_violations(documents: DataFrame, leaves: DataFrame) -> DataFrame:
    """One row per refused document with the columns at fault.

    ``leaves`` carries ``violation`` from the decoding. The documents at fault are few; their
    field violations are reduced to one text per document before they meet.
    """
    keys = version_keys(documents, leaves)
    header = width_violations(C.DOCUMENT_WIDTHS)
    by_header = documents.filter(header != "").select(*keys, header.alias("violation"))
    by_leaf = leaves.filter(F.col("violation").isNotNull()).select(*keys, "violation")
    return (
        by_header.unionByName(by_leaf)
        .groupBy(*keys)
        .agg(F.min("violation").alias("violation"), F.count(F.lit(1)).alias("violations"))
    )
