"""What a row costs: no expression is held several times over, no path is looked for where it cannot be, no input is one split."""

import json

import pytest
from pyspark.sql import functions as F

from docpulse.operators.gate import report_json
from docpulse.operators.parse import dispatch_shape, iso_datetime, parse_json
from workload import loops


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_report_holds_each_value_once(spark):
    issue = "struct<code:string, severity:string, message:string, details_json:string>"
    row = spark.sql(f"""SELECT 'a"]' AS file_name, 5L AS file_size_bytes, '.txt' AS extension, CAST(NULL AS STRING) AS detected_kind, 'standard' AS mode,
      false AS passed, CAST(NULL AS STRING) AS metadata_json, 70 AS score, 'fair' AS band, 1 AS error_count, 0 AS warning_count, 0 AS info_count,
      'CuNonSuccess' AS reason, 'Failed' AS cu_status, '[x]' AS given_message,
      from_json('[{{"code":"C","severity":"ERROR","message":"m"}}]', 'array<{issue}>') AS issues FROM range(1)""".replace("{{", "{").replace("}}", "}"))
    report = row.select(report_json(F.col("issues")).alias("r"))
    found = json.loads(report.first().r)
    assert found["cu_error_message"] == "[x]" and found["report"]["file_path"] == 'a"]' and found["report"]["detected_kind"] is None
    assert found["report"]["issues"] == [{"code": "C", "severity": "ERROR", "message": "m", "details": {}}]
    assert report._jdf.queryExecution().analyzed().toString().count("to_json") <= 11  # eleven texts


def test_shapes_are_told_in_one_walk(spark):
    texts = {
        "": "unparsed", "{": "unparsed", "1 2": "unparsed", "{} {}": "unparsed", '{"result":{}},{"a":1}': "unparsed", '{"fieldLabels":{}},7': "unparsed",
        "7": "unknown", "null": "unknown", "[]": "unknown", "{}": "unknown", '{"result":7}': "unknown", '{"result":null,"fieldLabels":null}': "labels",
        '{"fieldLabels":{},"metadata":[]}': "labels", '{"result":{},"fieldLabels":{}}': "analyze", '{"id":{"a":1},"result":{"analyzerId":3}}': "analyze"}
    files = spark.createDataFrame([(t,) for t in texts] + [(None,)], "value string").withColumn("path", F.col("value"))
    rows = dispatch_shape(parse_json(files))
    assert {r.path: r.shape for r in rows.select("path", "shape").collect()} == {**texts, None: "unparsed"}
    assert "$[1]" not in plan(rows) and plan(rows).count("variant_get") <= 2


@pytest.mark.parametrize("text", ["1996-10-22T00:00:00Z", "1996-10-22T01:02:03.25Z", "1996-13-22T00:00:00Z", "19961022T000000Z", "1996-10-22T00:00:00Z\n"])
def test_usual_times_are_those_of_the_patterns(spark, text):
    spaced = F.lit(" " + text)  # a blank before it takes the way through all patterns
    row = spark.range(1).select(iso_datetime(F.lit(text)).alias("a"), iso_datetime(spaced).alias("b")).first()
    assert row.a == row.b


def test_replayed_orders_are_spread(spark, tmp_path, monkeypatch):
    spark.range(100).selectExpr("id AS o_orderkey").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    seen = []
    monkeypatch.setattr(loops, "ingest_batch", lambda files, *a, **k: seen.append(files.rdd.getNumPartitions()))
    monkeypatch.setattr(loops.P, "refresh", lambda *a: None)
    loops.replayed_shares(spark, str(tmp_path))
    assert len(seen) == 3 and min(seen) >= spark.sparkContext.defaultParallelism
