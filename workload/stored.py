"""Keyed replace, statistics, patches and limits of the stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docpulse.operators import checks as K
from docpulse.operators import documents as D
from workload import standins as S
from workload.registry import query

# Versions of a document: run r re-ingests it a day later; odd runs spell the path in capitals.
VERSIONS_SQL = f"""{S.DOC_SQL}, ver AS (SELECT document_id, usecase, content_path, v AS pos, 'run-' || CAST(v AS VARCHAR) AS run_id,
  CASE WHEN v % 2 = 1 THEN upper(blob_path) ELSE blob_path END AS blob_path,
  ingested_at + INTERVAL 1 DAY * v AS ingested_at FROM doc, (VALUES (0), (1), (2)) t(v) WHERE v <= document_id % 3)"""


def versions(spark, sf_dir):
    d = S.documents(spark, sf_dir)
    v = F.col("pos")
    return d.select("document_id", "usecase", "content_path", "blob_path", "ingested_at",
                    F.explode(F.sequence(F.lit(0), (F.col("document_id") % 3).cast("int"))).alias("pos")).select(
        "document_id", "usecase", "content_path", "pos", F.concat(F.lit("run-"), v.cast("string")).alias("run_id"),
        F.when(v % 2 == 1, F.upper("blob_path")).otherwise(F.col("blob_path")).alias("blob_path"),
        (F.col("ingested_at") + F.make_dt_interval(v)).alias("ingested_at"),
    )


@query(f"""WITH {VERSIONS_SQL} SELECT document_id, usecase, content_path, pos, run_id, blob_path, ingested_at FROM ver
QUALIFY ROW_NUMBER() OVER (PARTITION BY lower(blob_path), lower(content_path) ORDER BY ingested_at DESC, run_id DESC, pos DESC) = 1""")
def upsert_documents(spark, sf_dir):
    return D.current_documents(versions(spark, sf_dir))


@query(f"""WITH {S.DOC_SQL}, {S.FLD_SQL}
SELECT document_id, CAST(COALESCE(n, 0) AS INTEGER) AS field_count,
  CAST(((2 * s + r) // (2 * r)) / 10000.0 AS DECIMAL(5,4)) AS avg_confidence, lo AS min_confidence, hi AS max_confidence
FROM doc LEFT JOIN (SELECT document_id, COUNT(*) AS n, COUNT(confidence) AS r, CAST(SUM(CAST(confidence * 10000 AS BIGINT)) AS BIGINT) AS s,
  MIN(confidence) AS lo, MAX(confidence) AS hi FROM fld GROUP BY document_id) a USING (document_id)""")
def finalize_document_stats(spark, sf_dir):
    return D.finalize_stats(S.documents(spark, sf_dir), S.fields(spark, sf_dir)).select(
        "document_id", "field_count", "avg_confidence", "min_confidence", "max_confidence")


@query(f"""WITH {S.DOC_SQL} SELECT document_id, blob_path, CASE WHEN document_id % 2 = 0 THEN 'moved/' || document_name
  WHEN document_id % 3 = 0 THEN NULL ELSE processed_blob_url END AS processed_blob_url FROM doc""")
def patch_processed_url(spark, sf_dir):
    d = S.documents(spark, sf_dir).select("document_id", "blob_path", "document_name", F.when(
        F.col("document_id") % 3 != 0, F.col("processed_blob_url")).alias("processed_blob_url"))
    moved = d.filter("document_id % 2 = 0").select("blob_path", F.concat(F.lit("moved/"), "document_name").alias("url"))
    return D.patch_processed_url(d, moved).drop("document_name")


@query(f"""WITH {S.DOC_SQL} SELECT document_id, CASE WHEN document_id % 5 = 0 THEN document_id * 10 + 2
  WHEN document_id % 5 = 1 THEN document_id * 10 + 1 ELSE preprocess_check_id END AS preprocess_check_id FROM doc""")
def backlink_checks(spark, sf_dir):
    d = S.documents(spark, sf_dir)
    raw = d.filter("document_id % 5 < 2").select(
        F.substring_index("blob_path", "/", -3).alias("result_path"), "document_id",
        F.explode(F.when(F.col("document_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("k"),
    )
    links = raw.select("result_path", (F.col("document_id") * 10 + F.col("k")).alias("check_id"),
                       F.concat("result_path", F.col("k").cast("string")).alias("raw_path"))
    return D.backlink(d, links).select("document_id", "preprocess_check_id")


@query(f"""WITH {S.CHK_SQL} SELECT check_id, blob_path, passed, score, band, FALSE AS submitted_to_cu, CAST(NULL AS VARCHAR) AS cu_status, metadata_json, checked_at
FROM chk UNION ALL SELECT check_id, blob_path, passed, score, band, FALSE, CAST(NULL AS VARCHAR), metadata_json, checked_at + INTERVAL 1 DAY FROM chk WHERE check_id % 5 = 0""")
def insert_checks(spark, sf_dir):
    """A file checked again adds a row, it does not replace one."""
    c = S.checks(spark, sf_dir)
    again = c.filter("check_id % 5 = 0").withColumn("checked_at", F.col("checked_at") + F.make_dt_interval(F.lit(1)))
    return K.check_rows(c.unionByName(again), F.col("checked_at")).select(
        "check_id", "blob_path", "passed", "score", "band", "submitted_to_cu", "cu_status", "metadata_json", "checked_at")


@query(f"""WITH {S.CHK_SQL} SELECT check_id, CASE WHEN check_id % 3 = 0 THEN check_id % 2 = 0 ELSE cu_status <> 'Skipped' END AS submitted_to_cu,
  CASE WHEN check_id % 6 = 0 THEN 'Patched' ELSE cu_status END AS cu_status,
  CASE WHEN check_id % 3 = 0 THEN repeat('m', 4000) END AS cu_error_message,
  'processed-raw/' || file_name AS routed_to_blob_path, CASE WHEN check_id % 3 = 0 THEN TIMESTAMP '2030-01-01 00:00:00' ELSE checked_at END AS completed_at FROM chk""")
def apply_outcomes(spark, sf_dir):
    from workload.reports import full_checks

    c = full_checks(spark, sf_dir)
    none = F.lit(None).cast("string")
    patches = c.filter("check_id % 3 = 0").select(
        "check_id", (F.col("check_id") % 2 == 0).alias("submitted_to_cu"), none.alias("cu_operation_location"),
        F.when(F.col("check_id") % 6 == 0, "Patched").alias("cu_status"), F.repeat(F.lit("m"), 5000).alias("cu_error_message"),
        none.alias("routed_to_blob_path"), none.alias("cu_result_blob_path"))
    done = F.expr("TIMESTAMP_NTZ '2030-01-01 00:00:00'")
    return K.apply_outcomes(c, patches, done).select(
        "check_id", "submitted_to_cu", "cu_status", "cu_error_message", "routed_to_blob_path", "completed_at")


@query(f"""WITH {S.DOC_SQL}, {S.FLD_SQL} SELECT document_id, field_path, value_string, confidence FROM fld
WHERE document_id IN (SELECT document_id FROM doc WHERE analyzer_name <> 'an-F')""")
def cascade_semi(spark, sf_dir):
    left = S.documents(spark, sf_dir).filter("analyzer_name <> 'an-F'")
    return D.surviving_children(S.fields(spark, sf_dir), left, ["document_id"]).select(
        "document_id", "field_path", "value_string", "confidence")


@query("""WITH h AS (SELECT doc_id AS document_id, length(text) + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) AS units FROM documents)
SELECT document_id, CASE WHEN toxic = 1 THEN 'confidence' ELSE 'document_name' END AS violation,
  CAST(CASE WHEN units > 512 THEN 1 ELSE 0 END + CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS BIGINT) AS violations
FROM h LEFT JOIN labels ON doc_id = document_id WHERE units > 512 OR toxic = 1""")
def constraint_violations(spark, sf_dir):
    d = S.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("document_id"), F.col("text").alias("document_name"), F.col("lang").alias("usecase"),
        *[F.lit("x").alias(c) for c in ("analyzer_name", "analyzer_id", "blob_path", "content_path", "mime_type",
                                        "api_version", "operation_id", "status")])
    leaves = S.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("document_id"), F.when(F.col("toxic") == 1, "confidence").alias("violation"))
    return D.constraint_violations(d, leaves)
