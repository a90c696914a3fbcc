"""The incremental loops over the driver's tables, read as streams."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from docpulse.plans.gate import settle_outcomes
from docpulse.plans.ingest import ingest_batch
from docpulse.session import shared_dir
from docpulse.sources import tables as T
from docpulse.sources.snapshots import compact, vacuum
from docpulse.streaming.loops import ingest_stream, quality_stream, run_id, spread
from workload import standins as S
from workload.quality import SMALL
from workload.registry import query


def fresh(spark) -> str:
    """A folder of its own for the tables of one query, in the cluster's shared folder."""
    return f"{shared_dir(spark)}/docpulse-{uuid.uuid4().hex[:12]}"


def table_stream(spark, sf_dir, name):
    """A driver table as a file stream."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(S.table(spark, sf_dir, name).schema)
    if fs.getFileStatus(path).isDirectory():
        return reader.parquet(path.toString())
    # A stream reads folders: a table of one file is picked out of its folder by name.
    return reader.option("pathGlobFilter", path.getName()).parquet(sf_dir)


# Every order as a stored document: fields Total and Date have a confidence, Customer.Key has none.
ORDERS_SQL = """od AS (SELECT o_orderkey AS k, o_orderpriority AS usecase, 'an-' || o_orderstatus AS analyzer_name,
  'source/' || o_orderpriority || '/an-' || o_orderstatus || '/' || CAST(o_orderkey AS VARCHAR) || '.json' AS blob_path,
  CAST((o_orderkey % 11 * 5 + 50) / 100.0 AS DECIMAL(5,4)) AS c, o_totalprice, o_orderdate, o_custkey FROM orders)"""

STORED_SQL = f"""WITH {ORDERS_SQL} SELECT blob_path, usecase, analyzer_name, 'input1' AS content_path, 3 AS field_count, c AS avg_confidence, c AS min_confidence, c AS max_confidence,
  replace(blob_path, 'source/', 'processed/') AS processed_blob_url, {{run}} AS run_id FROM od"""
STORED = ["blob_path", "usecase", "analyzer_name", "content_path", "field_count", "avg_confidence", "min_confidence", "max_confidence", "processed_blob_url", "run_id"]


@query(STORED_SQL.format(run="'ingest-000000000000'"))
def stream_ingest(spark, sf_dir):
    """Orders stream in as result files and end up as current documents with their statistics."""
    out = fresh(spark)
    stream = S.order_files_of(table_stream(spark, sf_dir, "orders"))
    ingest_stream(stream, out, f"{out}/checkpoint").awaitTermination()
    return T.documents(spark, out).select(*STORED)


@query(STORED_SQL.format(run="'run-b'"))
def replay_idempotent(spark, sf_dir):
    """Ingested, ingested again, and the second run retried: one current version per document."""
    out = fresh(spark)
    for run in ("run-a", "run-b", "run-b"):
        ingest_batch(S.order_files(spark, sf_dir), out, run)
    current = T.documents(spark, out)
    counted = T.fields(spark, out, current).groupBy("document_id", "version_id").agg(F.count(F.lit(1)).cast("int").alias("field_count"))
    return current.drop("field_count").join(counted, ["document_id", "version_id"]).select(*STORED)


@query(STORED_SQL.format(run="CASE WHEN k % 2 = 0 THEN 'run-b' ELSE 'run-a' END"))
def compacted_replay(spark, sf_dir):
    """Ingested, compacted, half of it ingested again, compacted and cleared, and the second run retried."""
    out, files = fresh(spark), S.order_files(spark, sf_dir)
    half = files.filter(F.regexp_extract("path", r"(\d+)\.json$", 1).cast("bigint") % 2 == 0)
    ingest_batch(files, out, "run-a")
    compact(spark, out)
    ingest_batch(half, out, "run-b")
    compact(spark, out)
    vacuum(spark, out)
    ingest_batch(half, out, "run-b")
    current = T.documents(spark, out)
    counted = T.fields(spark, out, current).groupBy("document_id", "version_id").agg(F.count(F.lit(1)).cast("int").alias("field_count"))
    return current.drop("field_count").join(counted, ["document_id", "version_id"]).select(*STORED)


@query(STORED_SQL.format(run="'ingest-000000000000'"))
def restarted_ingest(spark, sf_dir):
    """A batch that dies once its fields are published, before its documents are, and the start after it: each document once."""
    out, stamps = fresh(spark), S.order_files(spark, sf_dir).select(F.col("path").alias("result_path"), F.col("path").alias("raw_path"))
    T.publish(stamps.withColumn("check_id", F.xxhash64("raw_path")), out, "links", "l1")
    broken = stamps.withColumn("check_id", F.raise_error(F.concat(F.lit("lost at "), "raw_path")).cast("bigint"))
    for links in (broken, T.read_table(spark, out, "links")):
        def each(batch, number, links=links):
            ingest_batch(spread(batch), out, run_id("ingest", number), links)

        started = S.order_files_of(table_stream(spark, sf_dir, "orders")).writeStream.foreachBatch(each).option(
            "checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
        try:
            started.awaitTermination()
        except StreamingQueryException as lost:
            if "lost at " not in str(lost):
                raise
            if not T.read_table(spark, out, "documents").isEmpty() or T.read_table(spark, out, "fields").isEmpty():
                raise AssertionError("the batch was to die between its fields and its documents") from lost
    current = T.documents(spark, out)
    counted = T.fields(spark, out, current).groupBy("document_id", "version_id").agg(F.count(F.lit(1)).cast("int").alias("field_count"))
    return current.drop("field_count").join(counted, ["document_id", "version_id"]).select(*STORED)


@query(f"""WITH {ORDERS_SQL} SELECT blob_path, v.path AS field_path, CASE v.path WHEN 'Customer.Key' THEN CAST(o_custkey AS VARCHAR) WHEN 'Date' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
    ELSE CAST(o_totalprice AS VARCHAR) END AS value_string,
  CASE WHEN v.path = 'Customer.Key' OR (v.path = 'Total' AND k % 5 = 0) THEN NULL ELSE c END AS confidence FROM od, (VALUES ('Total'), ('Date'), ('Customer.Key')) v(path)""")
def stored_fields(spark, sf_dir):
    """Fields read back through the current documents."""
    out = fresh(spark)
    ingest_batch(S.order_files(spark, sf_dir), out, "run-a")
    current = T.documents(spark, out)
    fields = T.fields(spark, out, current).join(current.select("document_id", "version_id", "blob_path"), ["document_id", "version_id"])
    return fields.select("blob_path", "field_path", "value_string", "confidence")


@query("""WITH f AS (SELECT doc_id, lang, source, n_chars, quality, strlen(text) AS bytes, n_chars > 10000 AS long FROM documents LEFT JOIN labels USING (doc_id)),
g AS (SELECT *, bytes > 10000 AS big, lang || '/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS rel FROM f)
SELECT 'incoming/' || rel AS blob_path, CAST(bytes AS BIGINT) AS file_size_bytes, concat_ws(',', CASE WHEN big THEN 'FILE_TOO_LARGE' END, CASE WHEN long THEN 'TEXT_TOO_MANY_CHARS' END) AS codes,
  CAST(100 - CASE WHEN big THEN 30 ELSE 0 END - CASE WHEN long THEN 30 ELSE 0 END AS INTEGER) AS score,
  '{"mime_type": "text/plain", "encoding": "utf-8", "character_count": ' || CAST(n_chars AS VARCHAR) || ', "page_equivalent": ' || CAST(GREATEST(1, CAST(CEIL(n_chars / 3000.0) AS BIGINT)) AS VARCHAR) || '}' AS metadata_json,
  CASE WHEN big OR long THEN 'Skipped' WHEN quality = 0 THEN 'Failed' WHEN quality = 1 THEN 'Succeeded' END AS cu_status,
  CASE WHEN big OR long OR quality = 0 THEN 'rejected/' || rel WHEN quality = 1 THEN 'processed-raw/' || rel END AS routed_to_blob_path FROM g""")
def stream_quality(spark, sf_dir):
    """Texts stream in as raw files, are checked, and the labelled ones get their outcome."""
    out = fresh(spark)
    raw = table_stream(spark, sf_dir, "documents").select(
        F.concat_ws("/", "lang", "source", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"),
        F.lit("2024-01-01").cast("timestamp").alias("modificationTime"), F.octet_length("text").cast("bigint").alias("length"), F.encode("text", "UTF-8").alias("content"))
    quality_stream(raw, out, f"{out}/checkpoint", limits=SMALL).awaitTermination()
    labels = S.table(spark, sf_dir, "labels")
    stored = T.checks(spark, out)
    outcomes = stored.select("check_id", F.regexp_extract("file_name", r"^(\d+)", 1).cast("bigint").alias("doc_id")).join(labels, "doc_id").select(
        "check_id", F.when(F.col("quality") == 0, "Failed").otherwise("Succeeded").alias("status"), F.lit("op").alias("operation_location"),
        F.lit(None).cast("string").alias("error_message"), F.lit(True).alias("write_ok"), F.lit(False).alias("failed_call"))
    settle_outcomes(spark, out, outcomes, "settle-1")
    current = T.checks(spark, out)
    codes = T.issues(spark, out).groupBy("check_id").agg(F.array_join(F.sort_array(F.collect_set("code")), ",").alias("codes"))
    return current.join(codes, "check_id", "left").select(
        "blob_path", "file_size_bytes", F.coalesce("codes", F.lit("")).alias("codes"), "score", "metadata_json", "cu_status", "routed_to_blob_path")
