import datetime
import json
import os
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from docpulse.operators import documents as D
from docpulse.operators import gate as G
from docpulse.operators.checks import apply_outcomes, issue_rows
from docpulse.operators.pixels import image_size
from docpulse.plans import adhoc, views
from docpulse.plans.gate import check_batch, settle_outcomes
from docpulse.plans.ingest import ingest_batch
from docpulse.session import staging_dir
from docpulse.sources import tables as T
from docpulse.sources.files import list_files, read_raw, read_results
from docpulse.streaming.loops import ingest_paths, start_ingest, start_quality

DAY = datetime.datetime(2024, 1, 1)


def probe(value="A-100", confidence=0.99):
    return json.dumps({"result": {"contents": [{"fields": {"Id": {"type": "string", "valueString": value, "confidence": confidence}}}]}})


def documents(spark, rows):
    return spark.createDataFrame(rows, "document_id BIGINT, usecase STRING, analyzer_name STRING, ingested_at TIMESTAMP, field_count INT, avg_confidence DECIMAL(5,4), "
                                 "min_confidence DECIMAL(5,4)")


def test_replace_is_case_insensitive_and_last_wins(spark):
    rows = [("s/A.json", "input1", DAY, "r1", 0, 1), ("s/a.json", "Input1", DAY, "r2", 0, 2), ("s/a.json", "input1", DAY, "r2", 1, 3), ("s/b.json", "input1", DAY, "r1", 0, 4)]
    df = spark.createDataFrame(rows, "blob_path STRING, content_path STRING, ingested_at TIMESTAMP, run_id STRING, pos INT, n INT")
    assert sorted(r.n for r in D.current_documents(df).collect()) == [3, 4]


def test_statistics(spark):
    from decimal import Decimal as X

    docs = spark.createDataFrame([(1,), (2,), (3,)], "document_id BIGINT")
    fields = spark.createDataFrame([(1, X("0.5")), (1, X("0.5001")), (1, None), (2, None)], "document_id BIGINT, confidence DECIMAL(5,4)")
    got = {r.document_id: tuple(str(x) for x in r[1:]) for r in D.finalize_stats(docs, fields).collect()}
    # The mean 0.50005 is rounded half up.
    assert got == {1: ("3", "0.5001", "0.5000", "0.5001"), 2: ("1", "None", "None", "None"), 3: ("0", "None", "None", "None")}


def test_outcome_patch_coalesces(spark):
    columns = "check_id BIGINT, submitted_to_cu BOOLEAN, cu_operation_location STRING, cu_status STRING, cu_error_message STRING, routed_to_blob_path STRING, cu_result_blob_path STRING"
    checks = spark.createDataFrame([(1, True, "op", "Succeeded", "m", "r", "s", None), (2, True, None, None, None, None, None, None)], columns + ", completed_at TIMESTAMP")
    patch = spark.createDataFrame([(1, False, None, "Failed", None, None, None)], columns)
    got = {r.check_id: r for r in apply_outcomes(checks, patch, F.lit(DAY)).collect()}
    assert tuple(got[1])[1:7] == (False, "op", "Failed", "m", "r", "s") and got[1].completed_at == DAY
    assert got[2].submitted_to_cu and got[2].completed_at is None


def test_views_merge_spellings_and_fan_out(spark):
    from decimal import Decimal as X

    docs = documents(spark, [(1, "Inv", "An", DAY, 2, X("0.8"), X("0.7")), (2, "inv", "AN", DAY, 1, X("0.4"), X("0.4")), (3, "inv", "an", DAY, 0, None, None)])
    (row,) = views.daily_ingestion(docs).collect()
    assert (row.usecase, row.analyzer_name, row.document_count, row.total_fields, round(row.avg_confidence, 9), str(row.worst_field_confidence)) == ("Inv", "AN", 3, 3, 0.6, "0.4000")
    linked = docs.withColumn("preprocess_check_id", F.when(F.col("document_id") < 3, F.lit(7)))
    check = dict.fromkeys(views._CHECK_COLUMNS)
    checks = spark.createDataFrame([(7,), (8,)], "check_id BIGINT").select("check_id", *[F.lit(None).cast("timestamp" if c.endswith("_at") else "string").alias(c) for c in check if c != "check_id"])
    got = sorted((r.check_id, r.document_id or 0) for r in views.preprocess_checks(checks, linked).collect())
    assert got == [(7, 1), (7, 2), (8, 0)]


def test_low_confidence_boundary(spark):
    from decimal import Decimal as X

    docs = documents(spark, [(1, "u", "a", DAY, 4, None, None)]).withColumns({"document_name": F.lit("d"), "blob_path": F.lit("b")})
    fields = spark.createDataFrame([(1, str(i), X(c) if c else None) for i, c in enumerate(["0.7000", "0.6999", None, "0.9000"])],
                                   "document_id BIGINT, field_path STRING, confidence DECIMAL(5,4)").withColumns(
        {c: F.lit("x") for c in ("field_name", "field_type", "value_string")})
    assert [r.field_path for r in views.low_confidence_fields(fields, docs).collect()] == ["1"]
    (stats,) = views.field_stats_by_analyzer(fields, docs).collect()
    assert (stats.observations, stats.low_count, stats.high_count) == (3, 1, 1)
    assert adhoc.field_rows(fields, docs, "B").first().field_rows == 4


def test_gate_states(spark):
    rows = [(1, False, 1, 0), (2, True, 0, 1), (3, True, 0, 0), (4, True, 0, 0), (5, True, 0, 0), (6, True, 0, 0), (7, True, 0, 0)]
    checks = spark.createDataFrame(rows, "check_id BIGINT, passed BOOLEAN, error_count INT, warning_count INT").withColumns({
        "usecase": F.lit("u"), "analyzer_name": F.lit("a"), "file_name": F.concat(F.col("check_id").cast("string"), F.lit(".b.pdf")), "score": F.lit(70), "band": F.lit("fair")})
    outcomes = spark.createDataFrame(
        [(2, "Succeeded", "op", None, True, False), (3, "Timeout", "op", "slow", True, False), (4, None, None, "boom", True, True), (5, "Succeeded", "op", "disk", False, False),
         (6, "Succeeded", "op", None, True, False), (1, "Succeeded", "op", None, True, False)],
        "check_id BIGINT, status STRING, operation_location STRING, error_message STRING, write_ok BOOLEAN, failed_call BOOLEAN")
    got = {r.check_id: (r.reason, r.disposition, r.submitted_to_cu, r.cu_status, r.cu_error_message) for r in G.route_outcomes(checks, outcomes, strict=True).collect()}
    assert got == {
        1: ("QualityCheckFailed", "rejected", False, "Skipped", "QualityCheckFailed: quality score=70 band=fair"),
        2: ("QualityCheckFailed", "rejected", False, "Skipped", "QualityCheckFailed: quality score=70 band=fair"),
        3: ("CuNonSuccess", "rejected", True, "Timeout", "slow"),
        4: ("CuError", "rejected", True, "Failed", "boom"),
        5: ("StorageError", "rejected", True, "Succeeded", "the extraction succeeded but its result was not written: disk"),
        6: (None, "processed", True, "Succeeded", None),
        7: (None, "pending", None, None, None),
    }
    routed = G.route_outcomes(checks, outcomes)
    assert {r.check_id: r.result_path for r in G.result_links(routed).collect()} == {2: "u/a/2.b.json", 6: "u/a/6.b.json"}
    pair = spark.createDataFrame([("u/a/x.json", 1, "u/a/x.pdf"), ("u/a/x.json", 2, "u/a/x.docx"), ("u/a/y.json", 3, "u/a/y.pdf")], "result_path STRING, check_id BIGINT, raw_path STRING")
    assert [(r.result_path, r.files) for r in G.stem_collisions(pair).collect()] == [("u/a/x.json", 2)]


def write(folder, name, body):
    path = f"{folder}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(body if isinstance(body, bytes) else body.encode())


def test_ingest_stream_replay_and_isolation(spark, folder):
    src, out = f"{folder}/source", f"{folder}/out"
    write(src, "u+ v/a/x.json", probe())
    write(src, "u+ v/a/bad.json", "{")
    write(src, "u+ v/a/b.JSON", probe("B"))
    write(src, "too/many/levels/x.json", probe())
    write(src, "u+ v/a/viol.json", json.dumps({"result": {"contents": [
        {"fields": {"d": {"type": "date", "valueDate": "soon"}}}, {"fields": {"s": {"valueString": "x"}}}]}}))
    start_ingest(spark, src, out, f"{folder}/checkpoint", max_files=3).awaitTermination()
    state = lambda: sorted((r.blob_path, r.field_path, r.value_string) for r in
                           T.fields(spark, out).join(T.documents(spark, out).select("document_id", "version_id", "blob_path"), ["document_id", "version_id"]).collect())
    first = [("source/u+ v/a/b.JSON", "Id", "B"), ("source/u+ v/a/viol.json", "s", "x"), ("source/u+ v/a/x.json", "Id", "A-100")]
    assert state() == first
    errors = {r.blob_path: r.error_kind for r in T.read_table(spark, out, "errors").collect()}
    assert errors == {"source/u+ v/a/bad.json": "ParseError", "source/u+ v/a/viol.json": "SqlError"}
    moved = {r.src_path: (r.disposition, r.sidecar_path) for r in T.read_table(spark, out, "manifest").collect()}
    assert moved["source/u+ v/a/bad.json"] == ("failed", "failed/u+ v/a/bad.json.error.txt") and moved["source/u+ v/a/x.json"] == ("processed", None)
    # A second start finds nothing new; an explicit run replaces the version, and a retry of it changes nothing.
    start_ingest(spark, src, out, f"{folder}/checkpoint", max_files=3).awaitTermination()
    assert state() == first
    write(src, "u+ v/a/x.json", probe("A-200"))
    for _ in range(2):
        assert ingest_paths(spark, src, ["u+ v/a/x.json"], out, "redo") == {"processed": 1, "failed": 0, "skipped": 0, "deferred": 0}
    assert state() == first[:2] + [("source/u+ v/a/x.json", "Id", "A-200")]
    assert T.read_table(spark, out, "fields").filter("run_id = 'redo'").count() == 1


def test_deep_files_are_ingested_whole(spark, folder):
    node = {"valueString": "end", "confidence": 0.5}
    for _ in range(14):
        node = {"type": "object", "valueObject": {"k": node}}
    write(f"{folder}/source", "u/a/deep.json", json.dumps({"fieldLabels": {"r": node}}))
    ingest_batch(read_results(spark, f"{folder}/source"), f"{folder}/out", "r1")
    assert [r.field_path for r in T.fields(spark, f"{folder}/out").collect()] == [".".join(["r"] + ["k"] * 14)]


def test_quality_stream_to_back_link(spark, folder):
    src, out = f"{folder}/incoming", f"{folder}/out"
    write(src, "u/a/good.txt", "hello")
    write(src, "u/a/pic.png", b"\x89PNG\r\n\x1a\nbroken")
    write(src, "u/a/odd.pdf", "not a pdf")
    start_quality(spark, src, out, f"{folder}/q").awaitTermination()
    codes = {}
    for r in views.preprocess_issues(T.issues(spark, out), T.checks(spark, out)).collect():
        codes.setdefault(r.file_name, []).append(r.code)
    assert {k: sorted(v) for k, v in codes.items()} == {"pic.png": ["IMAGE_OPEN_FAILED"], "odd.pdf": ["MAGIC_MISMATCH", "PDF_DEEP_CHECK_SKIPPED"]}
    ids = {r.file_name: r.check_id for r in T.checks(spark, out).collect()}
    outcomes = spark.createDataFrame([(ids["good.txt"], "Succeeded", "op", None, True, False), (ids["odd.pdf"], "Failed", "op", "unreadable", True, False)],
                                     "check_id BIGINT, status STRING, operation_location STRING, error_message STRING, write_ok BOOLEAN, failed_call BOOLEAN")
    settle_outcomes(spark, out, outcomes, "settle")
    state = {r.file_name: (r.cu_status, r.routed_to_blob_path, r.cu_result_blob_path) for r in T.checks(spark, out).collect()}
    assert state == {"good.txt": ("Succeeded", "processed-raw/u/a/good.txt", "source/u/a/good.json"), "pic.png": ("Skipped", "rejected/u/a/pic.png", None),
                     "odd.pdf": ("Failed", "rejected/u/a/odd.pdf", None)}
    report = T.read_table(spark, out, "manifest").filter("sidecar_path LIKE '%pic.png.report.json'").first()
    body = json.loads(report.sidecar_text)
    assert body["reason"] == "QualityCheckFailed" and body["cu_status"] is None and body["report"]["issues"][0]["code"] == "IMAGE_OPEN_FAILED"
    assert {r.error_kind for r in T.read_table(spark, out, "errors").collect()} == {"QualityCheckFailed", "CuNonSuccess"}
    # The result file of the accepted one is linked back to its check.
    write(f"{folder}/source", "u/a/good.json", probe())
    start_ingest(spark, f"{folder}/source", out, f"{folder}/i").awaitTermination()
    all_views = T.register(spark, out)
    row = all_views["vw_PreProcessChecks"].filter("file_name = 'good.txt'").first()
    assert (row.extracted_field_count, str(row.extracted_avg_confidence)) == (1, "0.9900")
    assert spark.sql("SELECT * FROM vw_RejectedDocuments").count() == 1


def test_listing_finds_empty_files(spark, folder):
    write(folder, "u/a/empty.txt", "")
    write(folder, "u/a/x.txt", "1")
    os.makedirs(f"{folder}/u/a/sub")
    listing = list_files(spark, folder)
    assert sorted(tuple(r) for r in listing.collect()) == [("u/a/empty.txt", True, 0), ("u/a/sub", False, 0), ("u/a/x.txt", True, 1)]
    out = f"{folder}-out"
    check_batch(read_raw(spark, folder, prefix="u/a/"), out, "r1", manifest=listing.filter("path <> 'u/a/sub'"))
    got = {r.file_name: (r.passed, r.extension) for r in T.checks(spark, out).collect()}
    assert got == {"empty.txt": (False, ""), "x.txt": (True, ".txt")}
    assert [r.code for r in T.issues(spark, out).collect()] == ["FILE_EMPTY"]


def test_issue_message_width(spark):
    df = spark.createDataFrame([(1, [("C", "INFO", "m" * 3000, None)])], "check_id BIGINT, issues ARRAY<STRUCT<code:STRING, severity:STRING, message:STRING, details_json:STRING>>")
    assert len(issue_rows(df).first().message) == 2000


def test_bucketed_snapshot_joins_without_shuffle(spark, folder):
    pytest.importorskip("pyspark")
    docs = spark.range(100).select(F.col("id").alias("document_id"), F.lit("u").alias("usecase"))
    fields = spark.range(1000).select((F.col("id") % 100).alias("document_id"), F.col("id").alias("field_id"))
    T.save_bucketed(docs, "snap_documents", buckets=4)
    T.save_bucketed(fields, "snap_fields", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.table("snap_fields").join(spark.table("snap_documents"), "document_id")
        assert plan.count() == 1000
        assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE snap_documents")
        spark.sql("DROP TABLE snap_fields")


def test_ingest_accounts_for_every_file(spark, folder):
    src, out = f"{folder}/source", f"{folder}/out"
    write(src, "u/a/good.json", probe())
    write(src, "u/a/empty.json", "")
    write(src, "u/a/x[1]{2}*.json", probe("G"))
    write(src, "u/a/seven.json", '{"result":{"contents":[7]}}')
    write(src, "lost.json", probe())
    for _ in range(2):
        start_ingest(spark, src, out, f"{folder}/c", max_files=1).awaitTermination()
        errors = {r.blob_path: r.error_kind for r in T.read_table(spark, out, "errors").collect()}
        assert errors == {"source/u/a/empty.json": "ParseError"}
        moved = sorted((r.src_path, r.disposition) for r in T.read_table(spark, out, "manifest").collect())
        assert moved == [("source/u/a/empty.json", "failed"), ("source/u/a/good.json", "processed"),
                         ("source/u/a/seven.json", "processed"), ("source/u/a/x[1]{2}*.json", "processed")]
        assert sorted(r.blob_path for r in T.documents(spark, out).collect()) == ["source/u/a/good.json", "source/u/a/x[1]{2}*.json"]
    total = T.read_table(spark, out, "batches").groupBy().sum("processed", "failed", "skipped").first()
    assert tuple(total) == (3, 1, 1)  # every file of the folder, each once


def test_unreadable_results_are_errors(spark, folder):
    files = spark.createDataFrame([("u/a/x.json", None), ("u/a/y.json", probe())], "path STRING, value STRING")
    assert ingest_batch(files, folder, "r1") == {"processed": 1, "failed": 1, "skipped": 0, "deferred": 0}
    assert [(r.blob_path, r.error_kind) for r in T.read_table(spark, folder, "errors").collect()] == [("source/u/a/x.json", "ReadError")]


def one_bit_png(side, height=None):
    height = height or side
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    rows = zlib.compress(bytes((side + 7) // 8 + 1) * height, 9)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", side, height, 1, 0, 0, 0, 0))
            + chunk(b"IDAT", rows) + chunk(b"IEND", b""))


def test_quality_accounts_for_every_file(spark, folder):
    src, out = f"{folder}/incoming", f"{folder}/out"
    write(src, "u/a/good.txt", "hello")
    write(src, "u/a/empty.txt", "")
    write(src, "lost.txt", "no place")
    write(src, "u/a/scan[1].png", b"\x89PNG\r\n\x1a\nbroken")
    write(src, "u/a/huge.png", one_bit_png(20_000))
    write(src, "u/a/wide.png", one_bit_png(10_001, 200))
    for name, head in (("large", "%PDF-"), ("other", "PK")):
        write(src, f"u/a/{name}.pdf", head)
        os.truncate(f"{src}/u/a/{name}.pdf", 2_200_000_000)  # sparse: takes no room
    for _ in range(2):
        start_quality(spark, src, out, f"{folder}/q", max_files=2).awaitTermination()
        codes = {}
        for r in views.preprocess_issues(T.issues(spark, out), T.checks(spark, out)).collect():
            codes.setdefault(r.file_name, set()).add(r.code)
        assert codes == {"empty.txt": {"FILE_EMPTY"}, "scan[1].png": {"IMAGE_OPEN_FAILED"}, "huge.png": {"IMAGE_OPEN_FAILED"},
                         "wide.png": {"IMAGE_TOO_LARGE", "IMAGE_BLURRY", "IMAGE_LOW_CONTRAST"},
                         "large.pdf": {"FILE_TOO_LARGE", "PDF_DEEP_CHECK_SKIPPED"},
                         "other.pdf": {"FILE_TOO_LARGE", "MAGIC_MISMATCH", "PDF_DEEP_CHECK_SKIPPED"}}
        assert sorted(r.file_name for r in T.checks(spark, out).collect()) == ["empty.txt", "good.txt", "huge.png", "large.pdf", "other.pdf", "scan[1].png", "wide.png"]
    total = T.read_table(spark, out, "batches").groupBy().sum("processed", "skipped").first()
    assert tuple(total) == (7, 1)


def test_checking_again_adds_checks(spark, folder):
    rows = [("u/a/x.docx", datetime.datetime(2024, 1, 1), 4, b"PK\x03\x04")]
    content = spark.createDataFrame(rows, "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
    check_batch(content, folder, "r1")
    for _ in range(2):  # a retry of a run replaces it
        check_batch(content, folder, "r2", mode="pro")
    assert sorted((r.mode, r.passed) for r in T.checks(spark, folder).collect()) == [("pro", False), ("standard", True)]
    assert len({r.issue_id for r in T.issues(spark, folder).collect()}) == T.issues(spark, folder).count()


def test_image_headers(spark):
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc2\x00\x0b\x08" + struct.pack(">HH", 300, 500) + b"\x01" * 8
    tiff = b"MM\x00*" + struct.pack(">IH", 8, 2) + struct.pack(">HHIHH", 256, 3, 1, 70, 0) + struct.pack(">HHII", 257, 4, 1, 80_000)
    bmp = b"BM" + bytes(16) + struct.pack("<ii", 9, -8)
    rows = [("a", jpeg), ("b", tiff), ("c", bmp), ("d", one_bit_png(16)), ("e", b"II*\x00"), ("f", b""), ("g", b"ftypheic")]
    got = spark.createDataFrame(rows, "n STRING, content BINARY").select("n", image_size("content").alias("s")).select("n", "s.*")
    assert sorted(map(tuple, got.collect())) == [("a", 500, 300), ("b", 70, 80_000), ("c", 9, 8), ("d", 16, 16), ("e", None, None), ("f", None, None), ("g", None, None)]


def test_staging_is_cleared(spark, folder):
    ingest_batch(spark.createDataFrame([("u/a/y.json", probe())], "path STRING, value STRING"), folder, "r1")
    assert not os.path.exists(staging_dir(spark, folder, "r1"))


def test_a_key_with_a_dot_is_its_own_field(spark, folder):
    body = {"fieldLabels": {"a.b": {"valueString": "1"}, "a": {"type": "object", "valueObject": {"b": {"valueString": "2"}}}}}
    ingest_batch(spark.createDataFrame([("u/a/y.json", json.dumps(body))], "path STRING, value STRING"), folder, "r1")
    rows = T.fields(spark, folder).collect()
    assert {r.field_path for r in rows} == {"a.b"} and len({r.field_id for r in rows}) == 2


def test_moves_of_one_path(spark):
    docs = spark.createDataFrame([(1, "p", None)], "document_id BIGINT, blob_path STRING, processed_blob_url STRING")
    moved = spark.createDataFrame([("p", "m/1"), ("p", "m/2")], "blob_path STRING, url STRING")
    assert [tuple(r) for r in D.patch_processed_url(docs, moved).collect()] == [(1, "p", "m/2")]
