"""Reports from shares of runs: equal to the reports over all rows, whatever was written since."""

import os
import shutil

from pyspark.sql import functions as F

from docpulse.plans import partials as P
from docpulse.sources import tables as T
from docpulse.sources.snapshots import compact, vacuum


def put(spark, out, run, keys, confidence, day, user="u"):
    """A run of one document a key, each with a rated and an unrated field."""
    rows = spark.createDataFrame([(k,) for k in keys], "k long").withColumns({
        "blob_path": F.concat(F.lit(f"{user}/a/"), F.col("k").cast("string")), "usecase": F.lit(user), "analyzer_name": F.lit("a"),
        "content_path": F.lit("input1"), "document_id": F.xxhash64(F.lower("blob_path")), "version_id": F.xxhash64("blob_path", F.lit(run)),
        "ingested_at": F.lit(f"2024-01-{day:02d}").cast("timestamp"), "pos": F.lit(0), "field_count": F.lit(2), "run_id": F.lit(run),
        **{c: F.lit(confidence) for c in ("avg_confidence", "min_confidence", "max_confidence")}})
    fields = rows.select("document_id", "version_id", F.lit("k").alias("field_name"), F.lit("string").alias("field_type"), F.explode(
        F.array(F.lit(confidence), F.lit(None).cast("double"))).alias("confidence"))
    for table, found in (("fields", fields), ("documents", rows)):
        schema = spark.createDataFrame([], T.TABLES[table]).schema
        T.publish(found.select(*[(F.col(f.name) if f.name in found.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]), out, table, run)


def same(spark, out):
    generation = P.refresh(spark, out)
    assert P.refresh(spark, out) == generation  # nothing changed since
    views, found = T.register(spark, out), P.register(spark, out)
    full = {view: sorted(map(str, views[view].collect())) for view in found}
    for view, rows in found.items():
        assert sorted(map(str, rows.collect())) == full[view], view
        assert all("/_reports/" in f for f in rows.inputFiles())
    return full


def test_equal_to_the_full_reports_after_replays(spark, folder):
    assert P.refresh(spark, folder) == 0
    assert P.report(spark, folder, "fields").count() == 0
    put(spark, folder, "run a=1", range(6), 0.9, 1)
    put(spark, folder, "run-b", range(2), 0.4, 2, "U")  # replaces two, spelled otherwise
    same(spark, folder)
    put(spark, folder, "run-c", range(20, 22), 0.7, 3)  # touches nobody
    same(spark, folder)
    marks = {r.run_id: r.gen for r in P._read_marks(spark, folder, 2).collect()}
    assert marks == {"run a=1": 1, "run-b": 1, "run-c": 2}
    # written again without one of its files: the version it had replaced is back
    put(spark, folder, "run-b", [1], 0.2, 4)
    full = same(spark, folder)
    assert "observations=8" in "".join(full["vw_FieldStatsByAnalyzer"])
    compact(spark, folder)
    vacuum(spark, folder)
    same(spark, folder)
    put(spark, folder, "run-d", range(3, 5), 0.1, 5)
    same(spark, folder)
    # a run whose folder is gone
    shutil.rmtree(f"{folder}/documents/run_id=run-d")
    shutil.rmtree(f"{folder}/fields/run_id=run-d")
    same(spark, folder)
    P.vacuum_shares(spark, folder)
    same(spark, folder)
    assert len(os.listdir(f"{folder}/_reports/marks")) == 1


def test_a_refresh_that_broke_off_does_not_count(spark, folder):
    put(spark, folder, "run-a", range(3), 0.9, 6)
    first = same(spark, folder)["vw_FieldStatsByAnalyzer"]
    put(spark, folder, "run-b", range(3), 0.1, 7)
    assert P.refresh(spark, folder) == 2
    shutil.rmtree(f"{folder}/_reports/marks/2")
    assert sorted(map(str, P.report(spark, folder, "fields").collect())) == first
    assert same(spark, folder)["vw_FieldStatsByAnalyzer"] != first


def test_shares_are_folded_beyond_a_number_of_generations(spark, folder, monkeypatch):
    monkeypatch.setattr(P, "GENERATIONS", 2)
    for run in range(3):
        put(spark, folder, f"run-{run}", [run], 0.5, 8)
        P.refresh(spark, folder)
    assert {r.gen for r in P._read_marks(spark, folder, 3).collect()} == {3}
    same(spark, folder)
    put(spark, folder, "run-3", [0], 0.6, 9)
    same(spark, folder)
    assert {r.run_id: r.gen for r in P._read_marks(spark, folder, 4).collect()} == {"run-0": 4, "run-1": 3, "run-2": 3, "run-3": 4}


def test_patches_of_checks_are_followed(spark, folder):
    def store(table, run, ids, **columns):
        rows = spark.createDataFrame([(i,) for i in ids], "check_id long").withColumns({c: F.lit(v) for c, v in columns.items()})
        schema = spark.createDataFrame([], T.TABLES[table]).schema
        T.publish(rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]), folder, table, run)

    for run, ids in (("r1", range(6)), ("r2", range(10, 13))):
        store("checks", run, ids, usecase="u", analyzer_name="a", passed=True, score=90, error_count=0, warning_count=1, checked_at="2024-01-01 00:00:00")
    same(spark, folder)
    store("patches", "s1", [0, 1], cu_status="Succeeded", completed_at="2024-01-02 00:00:00")
    store("patches", "s2", [1], cu_status="Failed", completed_at="2024-01-03 00:00:00")
    summary = same(spark, folder)["vw_PreProcessDailySummary"][0]
    assert "cu_succeeded_count=1" in summary and "cu_failed_count=1" in summary
    marks = {r.run_id: r.gen for r in P._read_marks(spark, folder, 2).collect()}
    assert marks == {"r1": 2, "r2": 1, "s1": 2, "s2": 2}
    shutil.rmtree(f"{folder}/patches/run_id=s2")  # its patch is taken back
    assert "cu_succeeded_count=2" in same(spark, folder)["vw_PreProcessDailySummary"][0]
