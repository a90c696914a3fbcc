"""Column lists and Spark types of the five tables and of the rule inputs."""

from __future__ import annotations

DOCUMENT_HEADER = """
    document_id BIGINT, version_id BIGINT, usecase STRING, analyzer_name STRING, analyzer_id STRING,
    document_name STRING, blob_path STRING, content_path STRING, mime_type STRING,
    source_created_at TIMESTAMP, api_version STRING, operation_id STRING, status STRING, pos INT"""

DOCUMENTS = """
    document_id BIGINT, version_id BIGINT, usecase STRING, analyzer_name STRING, analyzer_id STRING,
    document_name STRING, blob_path STRING, processed_blob_url STRING, content_path STRING,
    mime_type STRING, source_created_at TIMESTAMP, api_version STRING, operation_id STRING,
    status STRING, field_count INT, avg_confidence DECIMAL(5,4), min_confidence DECIMAL(5,4),
    max_confidence DECIMAL(5,4), ingested_at TIMESTAMP, preprocess_check_id BIGINT, pos INT,
    path_key STRING, run_id STRING"""

FIELDS = """
    field_id BIGINT, document_id BIGINT, version_id BIGINT, field_path STRING, field_name STRING,
    parent_path STRING, array_index INT, field_type STRING, value_string STRING,
    value_number DOUBLE, value_integer BIGINT, value_date DATE, value_boolean BOOLEAN,
    currency_code STRING, confidence DECIMAL(5,4), span_offset INT, span_length INT, run_id STRING"""

ERRORS = """
    error_id BIGINT, blob_path STRING, usecase STRING, analyzer_name STRING, error_kind STRING,
    error_message STRING, occurred_at TIMESTAMP, run_id STRING"""

CHECKS = """
    check_id BIGINT, blob_path STRING, usecase STRING, analyzer_name STRING, file_name STRING,
    extension STRING, detected_kind STRING, file_size_bytes BIGINT, mode STRING, passed BOOLEAN,
    score INT, band STRING, error_count INT, warning_count INT, info_count INT,
    metadata_json STRING, submitted_to_cu BOOLEAN, cu_operation_location STRING, cu_status STRING,
    cu_error_message STRING, routed_to_blob_path STRING, cu_result_blob_path STRING,
    checked_at TIMESTAMP, completed_at TIMESTAMP, run_id STRING"""

ISSUES = """
    issue_id BIGINT, check_id BIGINT, code STRING, severity STRING, message STRING,
    details_json STRING, run_id STRING"""

LINKS = "result_path STRING, check_id BIGINT, raw_path STRING, run_id STRING"

PAGE_METRICS = """
    path STRING, page INT, chars INT, stdev DOUBLE, mean DOUBLE, blur_var DOUBLE, skew INT,
    skew_conf DOUBLE, dpi DOUBLE"""

FILE_METRICS = """
    path STRING, open_error STRING, encrypted BOOLEAN, page_count INT, character_count BIGINT,
    sheet_count INT, slide_count INT"""

OUTCOMES = """
    check_id BIGINT, status STRING, operation_location STRING, error_message STRING,
    write_ok BOOLEAN, failed_call BOOLEAN"""


def names(ddl: str) -> list[str]:
    """Column names of one of the lists above, in order."""
    return [part.split()[0] for part in ddl.replace("(5,4)", "").split(",")]
