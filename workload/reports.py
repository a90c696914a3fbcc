"""Reporting views and ad-hoc lookups over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docpulse.operators.documents import finalize_stats
from docpulse.plans import adhoc, views
from workload import standins as S
from workload.registry import query

STATS_SQL = """st AS (
  SELECT d.*, CAST(COALESCE(n, 0) AS INTEGER) AS field_count,
    CAST(((2 * s + r) // (2 * r)) / 10000.0 AS DECIMAL(5,4)) AS avg_confidence, lo AS min_confidence, hi AS max_confidence
  FROM doc d LEFT JOIN (SELECT document_id, COUNT(*) AS n, COUNT(confidence) AS r,
      CAST(SUM(CAST(confidence * 10000 AS BIGINT)) AS BIGINT) AS s, MIN(confidence) AS lo, MAX(confidence) AS hi
    FROM fld GROUP BY document_id) a USING (document_id))"""


def finished_documents(spark, sf_dir):
    return finalize_stats(S.documents(spark, sf_dir), S.fields(spark, sf_dir))


@query(f"""WITH {S.DOC_SQL}, {S.FLD_SQL}
SELECT field_id, d.document_id, usecase, analyzer_name, analyzer_id, document_name, blob_path, processed_blob_url,
  content_path, mime_type, source_created_at, ingested_at, field_path, field_name, parent_path, array_index, field_type,
  value_string, value_number, value_integer, value_date, value_boolean, currency_code, confidence,
  CASE WHEN confidence IS NULL THEN 'unknown' WHEN confidence >= 0.90 THEN 'high' WHEN confidence >= 0.70 THEN 'medium'
    ELSE 'low' END AS confidence_bucket, CAST(ingested_at AS DATE) AS ingested_date
FROM fld f JOIN doc d ON d.document_id = f.document_id""")
def vw_document_fields(spark, sf_dir):
    return views.document_fields(S.fields(spark, sf_dir), S.documents(spark, sf_dir))


@query(f"""WITH {S.DOC_SQL}, {S.FLD_SQL}, {STATS_SQL}
SELECT document_id, usecase, analyzer_name, analyzer_id, document_name, blob_path, processed_blob_url, mime_type,
  source_created_at, ingested_at, CAST(ingested_at AS DATE) AS ingested_date, field_count, avg_confidence,
  min_confidence, max_confidence,
  (SELECT COUNT(*) FROM fld f WHERE f.document_id = st.document_id AND f.confidence < 0.70) AS low_confidence_field_count,
  (SELECT COUNT(*) FROM fld f WHERE f.document_id = st.document_id AND f.confidence IS NULL) AS no_confidence_field_count
FROM st""")
def vw_document_summary(spark, sf_dir):
    return views.document_summary(S.fields(spark, sf_dir), finished_documents(spark, sf_dir))


@query(f"""WITH {S.DOC_SQL}, {S.FLD_SQL}
SELECT usecase, analyzer_name, document_name, blob_path, field_path, field_name, field_type, value_string, confidence, ingested_at
FROM fld f JOIN doc d ON d.document_id = f.document_id WHERE confidence < 0.70""")
def vw_low_confidence_fields(spark, sf_dir):
    return views.low_confidence_fields(S.fields(spark, sf_dir), S.documents(spark, sf_dir))


@query(f"""WITH {S.DOC_SQL}, {S.FLD_SQL}
SELECT usecase, analyzer_name, field_name, field_type, COUNT(*) AS observations,
  CAST(SUM(CAST(confidence * 10000 AS BIGINT)) AS DOUBLE) / 10000 / COUNT(*) AS avg_confidence,
  MIN(confidence) AS min_confidence, MAX(confidence) AS max_confidence,
  CAST(SUM(CASE WHEN confidence < 0.70 THEN 1 ELSE 0 END) AS BIGINT) AS low_count,
  CAST(SUM(CASE WHEN confidence >= 0.90 THEN 1 ELSE 0 END) AS BIGINT) AS high_count,
  MIN(ingested_at) AS first_seen, MAX(ingested_at) AS last_seen
FROM fld f JOIN doc d ON d.document_id = f.document_id WHERE confidence IS NOT NULL
GROUP BY usecase, analyzer_name, field_name, field_type""")
def vw_field_stats_by_analyzer(spark, sf_dir):
    return views.field_stats_by_analyzer(S.fields(spark, sf_dir), S.documents(spark, sf_dir))


@query(f"""WITH {S.DOC_SQL}, {S.FLD_SQL}, {STATS_SQL}
SELECT CAST(ingested_at AS DATE) AS ingested_date, usecase, analyzer_name, COUNT(*) AS document_count,
  CAST(SUM(field_count) AS BIGINT) AS total_fields,
  CAST(SUM(CAST(avg_confidence * 10000 AS BIGINT)) AS DOUBLE) / 10000 / COUNT(avg_confidence) AS avg_confidence,
  MIN(min_confidence) AS worst_field_confidence
FROM st GROUP BY 1, 2, 3""")
def vw_daily_ingestion(spark, sf_dir):
    return views.daily_ingestion(finished_documents(spark, sf_dir))


def full_checks(spark, sf_dir):
    text = F.lit(None).cast("string")
    return S.checks(spark, sf_dir).select(
        "*", (F.col("cu_status") != "Skipped").alias("submitted_to_cu"),
        text.alias("cu_operation_location"), text.alias("cu_error_message"),
        F.concat(F.lit("processed-raw/"), "file_name").alias("routed_to_blob_path"),
        text.alias("cu_result_blob_path"), F.col("checked_at").alias("completed_at"),
    )


@query(f"""WITH {S.CHK_SQL}, {S.DOC_SQL}, {S.FLD_SQL}, {STATS_SQL}
SELECT check_id, c.blob_path, c.usecase, c.analyzer_name, file_name, extension, detected_kind, file_size_bytes, mode,
  passed, score, band, error_count, warning_count, info_count, cu_status <> 'Skipped' AS submitted_to_cu, cu_status,
  CAST(NULL AS VARCHAR) AS cu_operation_location, CAST(NULL AS VARCHAR) AS cu_error_message,
  'processed-raw/' || file_name AS routed_to_blob_path, CAST(NULL AS VARCHAR) AS cu_result_blob_path, checked_at,
  checked_at AS completed_at, CAST(checked_at AS DATE) AS checked_date, d.document_id,
  d.field_count AS extracted_field_count, d.avg_confidence AS extracted_avg_confidence, d.min_confidence AS extracted_min_confidence
FROM chk c LEFT JOIN st d ON d.preprocess_check_id = c.check_id""")
def vw_preprocess_checks(spark, sf_dir):
    return views.preprocess_checks(full_checks(spark, sf_dir), finished_documents(spark, sf_dir))


ISSUES_SQL = """iss AS (
  SELECT check_id * 10 + k AS issue_id, check_id, code, severity, code || ' found' AS message,
    '{"limit": ' || CAST(k AS VARCHAR) || '}' AS details_json
  FROM chk, (VALUES (0, 'TOO_SHORT', 'ERROR'), (1, 'TOO_LONG', 'ERROR'), (2, 'LOW_TEXT', 'WARNING')) v(k, code, severity)
  WHERE (k = 0 AND file_size_bytes < 50) OR (k = 1 AND file_size_bytes > 10000) OR (k = 2 AND file_size_bytes < 200))"""


def issue_rows(spark, sf_dir):
    size = F.col("file_size_bytes")
    found = F.array_compact(F.array(
        F.when(size < 50, F.struct(F.lit(0).alias("k"), F.lit("TOO_SHORT").alias("code"), F.lit("ERROR").alias("severity"))),
        F.when(size > 10000, F.struct(F.lit(1).alias("k"), F.lit("TOO_LONG").alias("code"), F.lit("ERROR").alias("severity"))),
        F.when(size < 200, F.struct(F.lit(2).alias("k"), F.lit("LOW_TEXT").alias("code"), F.lit("WARNING").alias("severity"))),
    ))
    return S.checks(spark, sf_dir).select("check_id", F.explode(found).alias("i")).select(
        (F.col("check_id") * 10 + F.col("i.k")).alias("issue_id"), "check_id", "i.code", "i.severity",
        F.concat("i.code", F.lit(" found")).alias("message"),
        F.format_string('{"limit": %d}', "i.k").alias("details_json"),
    )


@query(f"""WITH {S.CHK_SQL}, {ISSUES_SQL}
SELECT issue_id, i.check_id, blob_path, usecase, analyzer_name, file_name, detected_kind, mode, passed AS check_passed,
  score AS check_score, band AS check_band, code, severity, message, details_json, checked_at, CAST(checked_at AS DATE) AS checked_date
FROM iss i JOIN chk c ON c.check_id = i.check_id""")
def vw_preprocess_issues(spark, sf_dir):
    return views.preprocess_issues(issue_rows(spark, sf_dir), S.checks(spark, sf_dir))


@query(f"""WITH {S.CHK_SQL}
SELECT check_id, blob_path, 'processed-raw/' || file_name AS routed_to_blob_path, usecase, analyzer_name, file_name, extension,
  detected_kind, file_size_bytes, score, band, error_count, warning_count, metadata_json, checked_at
FROM chk WHERE NOT passed""")
def vw_rejected_documents(spark, sf_dir):
    return views.rejected_documents(full_checks(spark, sf_dir))


@query(f"""WITH {S.CHK_SQL}
SELECT CAST(checked_at AS DATE) AS checked_date, usecase, analyzer_name, COUNT(*) AS total_inspected,
  CAST(SUM(CASE WHEN passed THEN 1 ELSE 0 END) AS BIGINT) AS passed_count,
  CAST(SUM(CASE WHEN passed THEN 0 ELSE 1 END) AS BIGINT) AS rejected_count,
  CAST(SUM(CASE WHEN cu_status = 'Succeeded' THEN 1 ELSE 0 END) AS BIGINT) AS cu_succeeded_count,
  CAST(SUM(CASE WHEN cu_status IN ('Failed', 'Timeout') THEN 1 ELSE 0 END) AS BIGINT) AS cu_failed_count,
  CAST(SUM(score) AS DOUBLE) / COUNT(*) AS avg_quality_score,
  CAST(SUM(error_count) AS BIGINT) AS total_errors, CAST(SUM(warning_count) AS BIGINT) AS total_warnings
FROM chk GROUP BY 1, 2, 3""")
def vw_preprocess_daily_summary(spark, sf_dir):
    return views.preprocess_daily_summary(S.checks(spark, sf_dir))


PREFIX = "source/1-URGENT/an-F/"


@query(f"""WITH {S.DOC_SQL}, {S.FLD_SQL}, {STATS_SQL}
SELECT document_id, usecase, analyzer_name, document_name, status, field_count, avg_confidence, processed_blob_url, ingested_at
FROM st WHERE blob_path LIKE '{PREFIX}%' ORDER BY ingested_at DESC, document_id""")
def adhoc_documents_by_path(spark, sf_dir):
    return adhoc.documents_by_path(finished_documents(spark, sf_dir), PREFIX)


@query(f"""WITH {S.DOC_SQL}, {S.FLD_SQL}
SELECT d.document_id, document_name, field_path, field_type, value_string, value_number, confidence
FROM doc d JOIN fld f ON f.document_id = d.document_id WHERE blob_path LIKE '{PREFIX}%'
ORDER BY d.document_id, field_path, value_string, confidence NULLS FIRST LIMIT 20""")
def adhoc_top20_fields(spark, sf_dir):
    return adhoc.top_fields(S.fields(spark, sf_dir), S.documents(spark, sf_dir), PREFIX)


ONE_PATH = "source/5-LOW/an-P/0.json"


@query(f"""WITH {S.DOC_SQL}, {S.FLD_SQL}, {STATS_SQL}
SELECT document_id, usecase, analyzer_name, content_path, field_count, ingested_at
FROM st WHERE blob_path = '{ONE_PATH}' ORDER BY ingested_at DESC, document_id DESC LIMIT 1""")
def adhoc_latest_document(spark, sf_dir):
    return adhoc.latest_document(finished_documents(spark, sf_dir), ONE_PATH)


@query(f"""WITH {S.DOC_SQL}, {S.FLD_SQL}
SELECT COUNT(*) AS field_rows FROM fld f JOIN doc d ON d.document_id = f.document_id WHERE blob_path = '{ONE_PATH}'""")
def adhoc_field_rows(spark, sf_dir):
    return adhoc.field_rows(S.fields(spark, sf_dir), S.documents(spark, sf_dir), ONE_PATH)


@query("""SELECT ts AS occurred_at, event_type || 'Error' AS error_kind, 'source/u/' || CAST(event_id AS VARCHAR) AS blob_path,
  'u' AS usecase, CAST(user_id AS VARCHAR) AS analyzer_name, LEFT(REPEAT(event_type || ' ' || props || ' ', 20), 200) AS error_message
FROM events ORDER BY ts DESC, blob_path, error_kind LIMIT 20""")
def adhoc_recent_errors(spark, sf_dir):
    errors = S.table(spark, sf_dir, "events").select(
        F.col("ts").alias("occurred_at"), F.concat("event_type", F.lit("Error")).alias("error_kind"),
        F.concat(F.lit("source/u/"), F.col("event_id").cast("string")).alias("blob_path"),
        F.lit("u").alias("usecase"), F.col("user_id").cast("string").alias("analyzer_name"),
        F.repeat(F.concat("event_type", F.lit(" "), "props", F.lit(" ")), 20).alias("error_message"),
    )
    return adhoc.recent_errors(errors)
