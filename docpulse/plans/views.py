"""The nine reporting views. DataFrames in, DataFrame out; also registered by name.

Joins carry no broadcast hint: the optimizer broadcasts a side only after checking its size, and
otherwise sort-merges, where adaptive execution splits a document or check that holds a large
share of the rows. Aggregates over names first run on the exact spelling (hash aggregate with
map-side combine), then merge spellings that differ in case over the few remaining rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docpulse import constants as C
from docpulse.functions.scoring import as_confidence, confidence_bucket
from docpulse.functions.text import ci_key


def version_keys(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns tying a field to its document: the id, and the version where both sides have it."""
    keys = ["document_id"]
    if "version_id" in left.columns and "version_id" in right.columns:
        keys.append("version_id")
    return keys


def merge_spellings(
    df: DataFrame, names: list[str], exact: list[str], measures: dict[str, tuple[Column, str]]
) -> DataFrame:
    """Group by ``exact`` columns and by ``names`` without regard to case.

    ``measures`` maps an output name to (aggregate, function that merges partial results). The
    least spelling of a name is shown.
    """
    return merge_partials(exact_partials(df, names, exact, measures), names, exact, measures)


def exact_partials(df: DataFrame, names: list[str], exact: list[str], measures: dict[str, tuple[Column, str]]) -> DataFrame:
    """The measures by exact spelling."""
    return df.groupBy(*exact, *names).agg(*[c.alias(n) for n, (c, _) in measures.items()])


def merge_partials(
    partial: DataFrame, names: list[str], exact: list[str], measures: dict[str, tuple[Column, str]]
) -> DataFrame:
    """Partial measures of any number of spellings, and of any number of parts of the data, as one row a group."""
    keys = [ci_key(name).alias(f"__{name}") for name in names]
    return (
        partial.groupBy(*exact, *keys)
        .agg(
            *[F.min(name).alias(name) for name in names],
            *[getattr(F, how)(n).alias(n) for n, (_, how) in measures.items()],
        )
        .drop(*[f"__{name}" for name in names])
    )


def document_fields(fields: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per field with its document's columns, confidence bucket and ingest date."""
    keys = version_keys(fields, documents)
    d = documents.select(
        *keys, "usecase", "analyzer_name", "analyzer_id", "document_name", "blob_path",
        "processed_blob_url", "content_path", "mime_type", "source_created_at", "ingested_at",
    )
    f = fields.select(
        *keys, "field_id", "field_path", "field_name", "parent_path", "array_index", "field_type",
        "value_string", "value_number", "value_integer", "value_date", "value_boolean",
        "currency_code", "confidence",
    )
    return f.join(d, keys, "inner").select(
        "field_id", "document_id", "usecase", "analyzer_name", "analyzer_id", "document_name",
        "blob_path", "processed_blob_url", "content_path", "mime_type", "source_created_at",
        "ingested_at", "field_path", "field_name", "parent_path", "array_index", "field_type",
        "value_string", "value_number", "value_integer", "value_date", "value_boolean",
        "currency_code", "confidence",
        confidence_bucket(F.col("confidence")).alias("confidence_bucket"),
        F.to_date("ingested_at").alias("ingested_date"),
    )


def document_summary(
    fields: DataFrame, documents: DataFrame, low: float = C.LOW_CONFIDENCE
) -> DataFrame:
    """One row per document with its statistics and counts of weak and unrated fields."""
    keys = version_keys(fields, documents)
    weak, unrated = F.col("confidence") < as_confidence(low), F.col("confidence").isNull()
    counts = (
        fields.filter(weak | unrated)
        .groupBy(*keys)
        .agg(F.count_if(weak).alias("weak"), F.count_if(unrated).alias("unrated"))
    )
    return documents.join(counts, keys, "left").select(
        "document_id", "usecase", "analyzer_name", "analyzer_id", "document_name", "blob_path",
        "processed_blob_url", "mime_type", "source_created_at", "ingested_at",
        F.to_date("ingested_at").alias("ingested_date"),
        "field_count", "avg_confidence", "min_confidence", "max_confidence",
        F.coalesce("weak", F.lit(0)).alias("low_confidence_field_count"),
        F.coalesce("unrated", F.lit(0)).alias("no_confidence_field_count"),
    )


def low_confidence_fields(
    fields: DataFrame, documents: DataFrame, low: float = C.LOW_CONFIDENCE
) -> DataFrame:
    """Review queue: every field below the threshold."""
    keys = version_keys(fields, documents)
    weak = fields.filter(F.col("confidence") < as_confidence(low)).select(
        *keys, "field_path", "field_name", "field_type", "value_string", "confidence"
    )
    d = documents.select(
        *keys, "usecase", "analyzer_name", "document_name", "blob_path", "ingested_at"
    )
    return weak.join(d, keys, "inner").select(
        "usecase", "analyzer_name", "document_name", "blob_path", "field_path", "field_name",
        "field_type", "value_string", "confidence", "ingested_at",
    )


FIELD_NAMES = ["usecase", "analyzer_name", "field_name", "field_type"]
GROUP_NAMES = ["usecase", "analyzer_name"]


def field_measures(low: float = C.LOW_CONFIDENCE, high: float = C.HIGH_CONFIDENCE) -> dict[str, tuple[Column, str]]:
    """What is counted of the rated fields of a group."""
    confidence = F.col("confidence")
    return {
        "observations": (F.count(F.lit(1)), "sum"),
        "confidence_sum": (F.sum(confidence), "sum"),
        "min_confidence": (F.min(confidence), "min"),
        "max_confidence": (F.max(confidence), "max"),
        "low_count": (F.count_if(confidence < as_confidence(low)), "sum"),
        "high_count": (F.count_if(confidence >= as_confidence(high)), "sum"),
        "first_seen": (F.min("ingested_at"), "min"),
        "last_seen": (F.max("ingested_at"), "max"),
    }


def rated_fields(fields: DataFrame, documents: DataFrame, *more: str) -> DataFrame:
    """Fields with a confidence and their document's names, and ``more`` columns of the document."""
    keys = version_keys(fields, documents)
    rated = fields.filter(F.col("confidence").isNotNull()).select(
        *keys, "field_name", "field_type", "confidence"
    )
    d = documents.select(*keys, "usecase", "analyzer_name", "ingested_at", *more)
    return rated.join(d, keys, "inner")


def field_report(merged: DataFrame) -> DataFrame:
    """The report's columns from merged measures."""
    return merged.select(
        *FIELD_NAMES, "observations",
        (F.col("confidence_sum").cast("double") / F.col("observations")).alias("avg_confidence"),
        "min_confidence", "max_confidence", "low_count", "high_count", "first_seen", "last_seen",
    )


def field_stats_by_analyzer(
    fields: DataFrame, documents: DataFrame, low: float = C.LOW_CONFIDENCE,
    high: float = C.HIGH_CONFIDENCE,
) -> DataFrame:
    """Confidence statistics per use case, analyzer, field and type."""
    return field_report(merge_spellings(rated_fields(fields, documents), FIELD_NAMES, [], field_measures(low, high)))


def document_measures() -> dict[str, tuple[Column, str]]:
    """What is counted of the documents of a group."""
    return {
        "document_count": (F.count(F.lit(1)), "sum"),
        "total_fields": (F.sum("field_count"), "sum"),
        "average_sum": (F.sum("avg_confidence"), "sum"),
        "rated": (F.count("avg_confidence"), "sum"),
        "worst_field_confidence": (F.min("min_confidence"), "min"),
    }


def document_report(merged: DataFrame) -> DataFrame:
    """The report's columns from merged measures."""
    return merged.select(
        "ingested_date", "usecase", "analyzer_name", "document_count", "total_fields",
        F.try_divide(F.col("average_sum").cast("double"), "rated").alias("avg_confidence"),
        "worst_field_confidence",
    )


def daily_ingestion(documents: DataFrame) -> DataFrame:
    """Volume and quality per day, use case and analyzer; documents weigh the same."""
    return document_report(merge_spellings(
        documents.withColumn("ingested_date", F.to_date("ingested_at")), GROUP_NAMES, ["ingested_date"], document_measures()))


_CHECK_COLUMNS = [
    "check_id", "blob_path", "usecase", "analyzer_name", "file_name", "extension",
    "detected_kind", "file_size_bytes", "mode", "passed", "score", "band", "error_count",
    "warning_count", "info_count", "submitted_to_cu", "cu_status", "cu_operation_location",
    "cu_error_message", "routed_to_blob_path", "cu_result_blob_path", "checked_at",
    "completed_at",
]


def preprocess_checks(checks: DataFrame, documents: DataFrame) -> DataFrame:
    """Checks with the documents extracted from them; one row per document, at least one.

    Written as matches plus checks without a match: a left join could not split a check that
    very many documents point to, an inner join can.
    """
    c = checks.select(*_CHECK_COLUMNS, F.to_date("checked_at").alias("checked_date"))
    d = documents.filter(F.col("preprocess_check_id").isNotNull()).select(
        F.col("preprocess_check_id").alias("check_id"), "document_id",
        F.col("field_count").alias("extracted_field_count"),
        F.col("avg_confidence").alias("extracted_avg_confidence"),
        F.col("min_confidence").alias("extracted_min_confidence"),
    )
    matched = c.join(d, "check_id", "inner")
    linked = d.select("check_id").distinct()
    alone = c.join(linked, "check_id", "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def preprocess_issues(issues: DataFrame, checks: DataFrame) -> DataFrame:
    """Every issue with the columns of its check."""
    c = checks.select(
        "check_id", "blob_path", "usecase", "analyzer_name", "file_name", "detected_kind", "mode",
        F.col("passed").alias("check_passed"), F.col("score").alias("check_score"),
        F.col("band").alias("check_band"), "checked_at",
    )
    i = issues.select("issue_id", "check_id", "code", "severity", "message", "details_json")
    return i.join(c, "check_id", "inner").select(
        "issue_id", "check_id", "blob_path", "usecase", "analyzer_name", "file_name",
        "detected_kind", "mode", "check_passed", "check_score", "check_band", "code", "severity",
        "message", "details_json", "checked_at", F.to_date("checked_at").alias("checked_date"),
    )


def rejected_documents(checks: DataFrame) -> DataFrame:
    """Raw documents the quality rules rejected."""
    return checks.filter(~F.col("passed")).select(
        "check_id", "blob_path", "routed_to_blob_path", "usecase", "analyzer_name", "file_name",
        "extension", "detected_kind", "file_size_bytes", "score", "band", "error_count",
        "warning_count", "metadata_json", "checked_at",
    )


def check_measures() -> dict[str, tuple[Column, str]]:
    """What is counted of the checks of a group."""
    status = F.lower("cu_status")
    return {
        "total_inspected": (F.count(F.lit(1)), "sum"),
        "passed_count": (F.count_if("passed"), "sum"),
        "rejected_count": (F.count_if(~F.col("passed")), "sum"),
        "cu_succeeded_count": (F.count_if(status == "succeeded"), "sum"),
        "cu_failed_count": (F.count_if(status.isin("failed", "timeout")), "sum"),
        "score_sum": (F.sum("score"), "sum"),
        "total_errors": (F.sum("error_count"), "sum"),
        "total_warnings": (F.sum("warning_count"), "sum"),
    }


def check_report(merged: DataFrame) -> DataFrame:
    """The report's columns from merged measures."""
    return merged.select(
        "checked_date", "usecase", "analyzer_name", "total_inspected", "passed_count",
        "rejected_count", "cu_succeeded_count", "cu_failed_count",
        (F.col("score_sum").cast("double") / F.col("total_inspected")).alias("avg_quality_score"),
        "total_errors", "total_warnings",
    )


def preprocess_daily_summary(checks: DataFrame) -> DataFrame:
    """Inspection volume, results and mean score per day, use case and analyzer."""
    return check_report(merge_spellings(
        checks.withColumn("checked_date", F.to_date("checked_at")), GROUP_NAMES, ["checked_date"], check_measures()))


def register_views(
    spark: SparkSession, documents: DataFrame, fields: DataFrame, checks: DataFrame,
    issues: DataFrame,
) -> dict[str, DataFrame]:
    """Register the nine views under their names and return them."""
    views = {
        "vw_DocumentFields": document_fields(fields, documents),
        "vw_DocumentSummary": document_summary(fields, documents),
        "vw_LowConfidenceFields": low_confidence_fields(fields, documents),
        "vw_FieldStatsByAnalyzer": field_stats_by_analyzer(fields, documents),
        "vw_DailyIngestion": daily_ingestion(documents),
        "vw_PreProcessChecks": preprocess_checks(checks, documents),
        "vw_PreProcessIssues": preprocess_issues(issues, checks),
        "vw_RejectedDocuments": rejected_documents(checks),
        "vw_PreProcessDailySummary": preprocess_daily_summary(checks),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views
