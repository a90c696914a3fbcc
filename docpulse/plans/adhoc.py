"""Ad-hoc lookups. Each top-k orders by a unique tie-breaker, so its rows are determined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpulse.functions.text import ci_key
from docpulse.plans.views import version_keys


def _key(documents: DataFrame) -> Column:
    """Path without regard to case: the stored key, on which a filter reaches the scan, where there is one."""
    return F.col("path_key") if "path_key" in documents.columns else ci_key("blob_path")


def _under(documents: DataFrame, prefix: str) -> DataFrame:
    """Documents below a prefix."""
    return documents.filter(_key(documents).startswith(prefix.lower()))


def _at(documents: DataFrame, blob_path: str) -> DataFrame:
    """Documents of one path."""
    return documents.filter(_key(documents) == blob_path.rstrip(" ").lower())


def documents_by_path(documents: DataFrame, prefix: str) -> DataFrame:
    """Documents below a path, newest first."""
    return (
        _under(documents, prefix)
        .select(
            "document_id", "usecase", "analyzer_name", "document_name", "status", "field_count",
            "avg_confidence", "processed_blob_url", "ingested_at",
        )
        .orderBy(F.desc("ingested_at"), "document_id")
    )


def top_fields(
    fields: DataFrame, documents: DataFrame, prefix: str, n: int = 20
) -> DataFrame:
    """First fields below a path, by document and field path."""
    keys = version_keys(fields, documents)
    d = _under(documents, prefix).select(*keys, "document_name")
    f = fields.select(
        *keys, "field_path", "field_type", "value_string", "value_number", "confidence"
    )
    return (
        f.join(d, keys, "inner")
        .orderBy("document_id", "field_path", "value_string", "confidence")
        .limit(n)
        .select(
            "document_id", "document_name", "field_path", "field_type", "value_string",
            "value_number", "confidence",
        )
    )


def latest_document(documents: DataFrame, blob_path: str) -> DataFrame:
    """Newest document of one path."""
    return (
        _at(documents, blob_path)
        .orderBy(F.desc("ingested_at"), F.desc("document_id"))
        .limit(1)
        .select(
            "document_id", "usecase", "analyzer_name", "content_path", "field_count",
            "ingested_at",
        )
    )


def field_rows(fields: DataFrame, documents: DataFrame, blob_path: str) -> DataFrame:
    """Number of field rows of one path."""
    keys = version_keys(fields, documents)
    d = _at(documents, blob_path).select(*keys)
    return fields.select(*keys).join(d, keys, "inner").agg(F.count(F.lit(1)).alias("field_rows"))


def recent_errors(errors: DataFrame, n: int = 20) -> DataFrame:
    """Newest errors, message shortened."""
    return (
        errors.orderBy(F.desc("occurred_at"), "blob_path", "error_kind")
        .limit(n)
        .select(
            "occurred_at", "error_kind", "blob_path", "usecase", "analyzer_name",
            F.left(F.col("error_message"), F.lit(200)).alias("error_message"),
        )
    )
