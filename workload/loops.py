"""Sidecar files, the listing stream, timeouts and open checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docpulse.plans import partials as P
from docpulse.plans.gate import check_batch, settle_outcomes
from docpulse.plans.ingest import ingest_batch
from docpulse.sources import tables as T
from docpulse.sources.files import list_files
from docpulse.sources.sidecars import publish_sidecars, read_sidecars
from docpulse.streaming.loops import start_ingest, start_quality
from docpulse.streaming.timeouts import settle_stream
from workload import standins as S
from workload.registry import query
from workload.streams import fresh, table_stream


@query("""SELECT 'failed/u/a/' || CAST(c_custkey AS VARCHAR) || '.json.error.txt' AS path,
  '[ParseError] ParseError: the file is not one JSON value in UTF-8' || chr(10) || chr(10) AS text FROM customer WHERE c_custkey % 10 = 1""")
def error_sidecars(spark, sf_dir):
    """A result file for every customer, one in ten broken: the texts next to the failed ones, read back as files."""
    out, key = fresh(spark), F.col("c_custkey")
    value = F.when(key % 10 == 1, "{").otherwise('{"fieldLabels":{"k":{"valueString":"v"}}}')
    files = S.spread(S.table(spark, sf_dir, "customer")).select(F.concat(F.lit("u/a/"), key.cast("string"), F.lit(".json")).alias("path"), value.alias("value"))
    for _ in range(2):  # a run that is repeated leaves one file each
        ingest_batch(files, f"{out}/t", "r1", sidecars=f"{out}/routed")
    return read_sidecars(spark, f"{out}/routed")


def raw_customers(spark, sf_dir):
    """A raw file for every customer: one in three of an unknown kind, one in three with an unfit head."""
    key = F.col("c_custkey")
    name = F.concat(F.lit("u/a/"), key.cast("string"), F.when(key % 3 == 0, ".xyz").when(key % 3 == 1, ".pdf").otherwise(".txt"))
    return S.spread(S.table(spark, sf_dir, "customer")).select(
        name.alias("path"), F.lit("2024-01-01").cast("timestamp").alias("modificationTime"), F.lit(5).cast("bigint").alias("length"),
        F.lit(b"hello").alias("content"))


@query("""SELECT 'rejected/u/a/' || CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 3 = 0 THEN '.xyz.report.json' ELSE '.txt.report.json' END AS path,
  CASE WHEN c_custkey % 3 = 0 THEN 'QualityCheckFailed' ELSE 'CuNonSuccess' END AS reason,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Failed' END AS cu_status,
  CASE WHEN c_custkey % 3 = 0 THEN 'UNSUPPORTED_EXTENSION' END AS code FROM customer WHERE c_custkey % 3 = 0 OR (c_custkey % 3 = 2 AND c_custkey % 2 = 0)""")
def report_sidecars(spark, sf_dir):
    """The reports next to rejected files: those the gate refused, and texts whose extraction failed."""
    out = fresh(spark)
    check_batch(raw_customers(spark, sf_dir), out, "r1")
    key = F.regexp_extract("file_name", r"^(\d+)", 1).cast("bigint")
    text = F.lit(None).cast("string")
    outcomes = T.checks(spark, out).filter((key % 3 == 2) & (key % 2 == 0)).select(
        "check_id", F.lit("Failed").alias("status"), text.alias("operation_location"), F.lit("unreadable").alias("error_message"),
        F.lit(True).alias("write_ok"), F.lit(False).alias("failed_call"))
    settle_outcomes(spark, out, outcomes, "s1", sidecars=f"{out}/routed")
    report = F.expr("parse_json(text)")
    return read_sidecars(spark, f"{out}/routed").withColumn("r", report).select(
        "path", F.expr("variant_get(r, '$.reason', 'string')").alias("reason"), F.expr("variant_get(r, '$.cu_status', 'string')").alias("cu_status"),
        F.expr("variant_get(r, '$.report.issues[0].code', 'string')").alias("code"))


@query("""WITH n AS (SELECT COUNT(*) AS n, CAST(ceil(COUNT(*) / 4.0) AS BIGINT) AS most FROM supplier),
t AS (SELECT i, n, most, GREATEST(0, LEAST(most, n - i * most)) AS processed FROM n, (VALUES (0), (1), (2), (3)) v(i))
SELECT 'ingest-' || lpad(CAST(i AS VARCHAR), 12, '0') AS run_id, CAST(processed AS BIGINT) AS processed,
  CAST(n - i * most - processed AS BIGINT) AS deferred FROM t WHERE processed > 0""")
def deferred_files(spark, sf_dir):
    """Four starts over the files of all suppliers, a quarter each: what every one takes and leaves for later."""
    out, key = fresh(spark), F.col("s_suppkey").cast("string")
    suppliers = S.table(spark, sf_dir, "supplier")
    publish_sidecars(suppliers.select(F.concat(F.lit("u/a/"), key, F.lit(".json")).alias("path"), F.lit('{"fieldLabels":{}}').alias("text")), f"{out}/source")
    most = -(-suppliers.count() // 4)
    for _ in range(5):  # the fifth finds nothing
        start_ingest(spark, f"{out}/source", f"{out}/t", f"{out}/c", max_files=most, drain=False).awaitTermination()
    return T.read_table(spark, f"{out}/t", "batches").select("run_id", "processed", "deferred")


@query("""SELECT o_orderkey AS check_id, CASE WHEN o_orderkey % 6 IN (0, 4) THEN 'Succeeded' WHEN o_orderkey % 6 = 1 THEN 'Failed' ELSE 'Timeout' END AS status,
  CASE WHEN o_orderkey % 6 IN (2, 3, 5) THEN 'no final state within 540s' END AS error_message FROM orders""")
def outcome_timeouts(spark, sf_dir):
    """Submissions and outcomes as one stream: in time, just in time, late, missing, before the submission, missing with two submissions."""
    key = F.col("o_orderkey")
    start = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=key % 3600)
    after = F.element_at(F.array(*[F.lit(s) for s in (100, 540, 541, None, -30, None)]), (key % 6 + 1).cast("int"))
    status = F.when(key % 6 == 1, "Failed").otherwise("Succeeded")
    text = F.lit(None).cast("string")
    event = lambda check, at, said: F.struct(check.alias("check_id"), at.alias("event_time"), F.when(said.isNull(), "submitted").otherwise("outcome").alias("kind"),
                                             said.alias("status"))
    later = lambda seconds: start + F.make_dt_interval(secs=seconds)
    rows = F.array(
        event(key, start, text), event(key, F.when(after.isNotNull(), later(after)), status),
        event(key, F.when(key % 6 == 5, later(F.lit(7))), text),
        event(-key - 1, F.lit("2030-01-01").cast("timestamp"), F.lit("Succeeded")))  # of no check: the clock goes on
    events = table_stream(spark, sf_dir, "orders").select(F.inline(rows)).withColumns({
        "operation_location": text, "error_message": text, "write_ok": F.lit(True), "failed_call": F.lit(False)})
    out = fresh(spark)
    settle_stream(events, delay="2 hours").writeStream.format("parquet").option("path", f"{out}/settled").option(
        "checkpointLocation", f"{out}/c").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/settled").select("check_id", "status", "error_message")


@query("""SELECT 'incoming/u/a/' || CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 3 = 1 THEN '.pdf' ELSE '.txt' END AS blob_path,
  CASE WHEN c_custkey % 3 = 1 THEN 'warned' ELSE 'clean' END AS state FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 5 <> 2""")
def open_checks(spark, sf_dir):
    """Checks that still wait after two settlements, one of them run twice; the gate's refusals wait for nothing."""
    out = fresh(spark)
    check_batch(raw_customers(spark, sf_dir), out, "r1")
    key = F.regexp_extract("file_name", r"^(\d+)", 1).cast("bigint")
    text = F.lit(None).cast("string")
    for run, part in (("s1", 0), ("s1", 0), ("s2", 1)):
        outcomes = T.checks(spark, out).filter("passed").filter((key % 5 == 2) & (key % 2 == part)).select(
            "check_id", F.lit("Succeeded").alias("status"), text.alias("operation_location"), text.alias("error_message"),
            F.lit(True).alias("write_ok"), F.lit(False).alias("failed_call"))
        settle_outcomes(spark, out, outcomes, run)
    return T.read_open(spark, out).select("blob_path", "state")


@query("""SELECT 'source/' || o_orderpriority || '/an-' || o_orderstatus || '/' || CAST(o_orderkey AS VARCHAR) || '.json' AS blob_path,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey * 10 WHEN o_orderkey % 2 = 0 THEN o_orderkey * 10 + 1 END AS preprocess_check_id FROM orders""")
def late_links(spark, sf_dir):
    """Documents whose stamp was stored before they were ingested, after it, both, or never."""
    out, files = fresh(spark), S.order_files(spark, sf_dir)
    key = F.regexp_extract("path", r"(\d+)\.json$", 1).cast("bigint")
    for run, each, add in (("l1", 3, 0), ("l2", 2, 1)):
        links = files.filter(key % each == 0).select(F.col("path").alias("result_path"), (key * 10 + add).alias("check_id"), F.col("path").alias("raw_path"))
        T.publish(links, out, "links", run)
        if run == "l1":
            ingest_batch(files, out, "r1", T.read_table(spark, out, "links"))
    return T.documents(spark, out).select("blob_path", "preprocess_check_id")


@query("""SELECT 'u' || CAST(s_nationkey AS VARCHAR) || '/a/' || CAST(s_suppkey AS VARCHAR) || '.json' AS path,
  CAST(CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE length(CAST(s_suppkey AS VARCHAR)) END AS BIGINT) AS length FROM supplier WHERE CAST(s_nationkey AS VARCHAR) LIKE '1%'""")
def listed_objects(spark, sf_dir):
    """Files of one prefix, empty ones too, listed in tasks."""
    out, text = fresh(spark), F.col("s_suppkey").cast("string")
    suppliers = S.table(spark, sf_dir, "supplier")
    publish_sidecars(suppliers.select(
        F.concat(F.lit("u"), F.col("s_nationkey").cast("string"), F.lit("/a/"), text, F.lit(".json")).alias("path"),
        F.when(F.col("s_suppkey") % 4 == 0, "").otherwise(text).alias("text")), f"{out}/source")
    return list_files(spark, f"{out}/source", prefix="u1").filter("is_file").select("path", "length")


@query("""WITH s AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS t FROM supplier)
SELECT k AS supplier, CASE WHEN k % 5 = 0 THEN t || '-new' ELSE t END AS value_string, CAST(CASE WHEN k % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS checks,
  CAST(CASE WHEN k % 5 = 0 AND k % 10 <> 0 THEN 2 ELSE 1 END AS BIGINT) AS passed, CAST(CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS errors FROM s""")
def real_files(spark, sf_dir):
    """A raw file and a result file for each supplier, some empty, some rewritten later, checked and ingested by the loops: each version once."""
    out, key = fresh(spark), F.col("s_suppkey")
    text = key.cast("string")
    suppliers = S.table(spark, sf_dir, "supplier")
    name = F.concat(F.lit("u/n"), F.col("s_nationkey").cast("string"), F.lit("/"), text)
    json = lambda value: F.concat(F.lit('{"fieldLabels":{"k":{"valueString":"'), value, F.lit('"}}}'))

    def write(rows, value):
        empty = (key % 10 == 0) & F.lit(value is text)
        publish_sidecars(rows.select(F.concat(name, F.lit(".json")).alias("path"), F.when(empty, "").otherwise(json(value)).alias("text")), f"{out}/source")
        publish_sidecars(rows.select(F.concat(name, F.lit(".txt")).alias("path"), F.when(empty, "").otherwise(value).alias("text")), f"{out}/incoming")

    def run():
        start_quality(spark, f"{out}/incoming", f"{out}/t", f"{out}/q", max_files=500, max_bytes=1 << 20).awaitTermination()
        start_ingest(spark, f"{out}/source", f"{out}/t", f"{out}/i", max_files=500, max_bytes=1 << 20).awaitTermination()

    write(suppliers, text)
    run()
    write(suppliers.filter(key % 5 == 0), F.concat(text, F.lit("-new")))
    run()
    supplier = F.regexp_extract("blob_path", r"/(\d+)\.[a-z]+$", 1).cast("bigint").alias("supplier")
    checks = T.checks(spark, f"{out}/t").groupBy(supplier).agg(F.count("*").alias("checks"), F.count_if("passed").alias("passed"))
    errors = T.read_table(spark, f"{out}/t", "errors").groupBy(supplier).agg(F.count("*").alias("errors"))
    documents = T.documents(spark, f"{out}/t")
    fields = T.fields(spark, f"{out}/t", documents).select("document_id", "version_id", "value_string")
    documents = documents.join(fields, ["document_id", "version_id"]).select(supplier, "value_string")
    return documents.join(checks, "supplier").join(errors, "supplier", "left").select(
        "supplier", "value_string", "checks", "passed", F.coalesce("errors", F.lit(0)).alias("errors"))


# Every order in run-a; every second once more in run-b, with another confidence, spelled in capitals; run-b written again with every fourth only.
REPLAYED_SQL = """WITH d AS (SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'U' ELSE 'u' END AS usecase, 'a' || CAST(o_orderkey % 7 AS VARCHAR) AS analyzer_name,
  CASE WHEN o_orderkey % 4 = 0 THEN DATE '2024-01-02' ELSE DATE '2024-01-01' END AS day,
  CAST(CASE WHEN o_orderkey % 4 = 0 THEN 10 - o_orderkey % 9 ELSE 1 + o_orderkey % 9 END AS BIGINT) AS tenths FROM orders)"""


def replayed_shares(spark, sf_dir):
    """Two runs of the orders, the second replayed with less in it; shares refreshed after each."""
    out, key = fresh(spark), F.col("o_orderkey")
    orders = S.spread(S.table(spark, sf_dir, "orders"))
    for run, each, user, day, tenths in (("run-a", 1, "u", 1, 1 + key % 9), ("run-b", 2, "U", 2, 1 + key % 9), ("run-b", 4, "U", 2, 10 - key % 9)):
        value = F.concat(F.lit('{"fieldLabels":{"k":{"type":"string","valueString":"v","confidence":'), (tenths / F.lit(10.0)).cast("string"), F.lit("}}}"))
        path = F.concat(F.lit(f"{user}/a"), (key % 7).cast("string"), F.lit("/"), key.cast("string"), F.lit(".json"))
        ingest_batch(orders.filter(key % each == 0).select(path.alias("path"), value.alias("value")), out, run,
                     ingested_at=F.lit(f"2024-01-{day:02d}").cast("timestamp"))
        P.refresh(spark, out)
    return out


@query(f"""{REPLAYED_SQL} SELECT MIN(usecase) AS usecase, analyzer_name, 'k' AS field_name, COUNT(*) AS observations,
  CAST(SUM(tenths) AS DOUBLE) / 10 / COUNT(*) AS avg_confidence, CAST(MIN(tenths) / 10.0 AS DECIMAL(5,4)) AS min_confidence,
  CAST(MAX(tenths) / 10.0 AS DECIMAL(5,4)) AS max_confidence, COUNT(*) FILTER (tenths < 7) AS low_count, COUNT(*) FILTER (tenths >= 9) AS high_count,
  CAST(MIN(day) AS TIMESTAMP) AS first_seen, CAST(MAX(day) AS TIMESTAMP) AS last_seen FROM d GROUP BY lower(usecase), analyzer_name""")
def shares_of_fields(spark, sf_dir):
    """The report on fields from shares of runs, after a replay that brings replaced versions back."""
    return P.report(spark, replayed_shares(spark, sf_dir), "fields").drop("field_type")


@query(f"""{REPLAYED_SQL} SELECT day AS ingested_date, usecase, analyzer_name, COUNT(*) AS document_count, COUNT(*) AS total_fields,
  CAST(SUM(tenths) AS DOUBLE) / 10 / COUNT(*) AS avg_confidence, CAST(MIN(tenths) / 10.0 AS DECIMAL(5,4)) AS worst_field_confidence
FROM d GROUP BY day, usecase, analyzer_name""")
def shares_of_documents(spark, sf_dir):
    """The report on days from shares of runs, after a replay that brings replaced versions back."""
    return P.report(spark, replayed_shares(spark, sf_dir), "documents")


@query("""SELECT DATE '2024-01-01' AS checked_date, 'u' AS usecase, 'a' AS analyzer_name, COUNT(*) AS total_inspected, COUNT(*) FILTER (c_custkey % 3 <> 0) AS passed_count,
  COUNT(*) FILTER (c_custkey % 3 = 0) AS rejected_count, COUNT(*) FILTER (c_custkey % 3 <> 0 AND c_custkey % 5 = 1) AS cu_succeeded_count,
  COUNT(*) FILTER (c_custkey % 3 <> 0 AND c_custkey % 5 = 2) AS cu_failed_count FROM customer""")
def shares_of_checks(spark, sf_dir):
    """The report on checks from shares of runs, after two settlements."""
    out = fresh(spark)
    check_batch(raw_customers(spark, sf_dir), out, "r1")
    key, text = F.regexp_extract("file_name", r"^(\d+)", 1).cast("bigint"), F.lit(None).cast("string")
    for part, status in ((1, "Succeeded"), (2, "Failed")):
        P.refresh(spark, out)
        settle_outcomes(spark, out, T.checks(spark, out).filter("passed").filter(key % 5 == part).select(
            "check_id", F.lit(status).alias("status"), text.alias("operation_location"), text.alias("error_message"),
            F.lit(True).alias("write_ok"), F.lit(False).alias("failed_call")), f"s{part}")
    P.refresh(spark, out)
    return P.report(spark, out, "checks").withColumn("checked_date", F.lit("2024-01-01").cast("date")).drop(
        "avg_quality_score", "total_errors", "total_warnings")
