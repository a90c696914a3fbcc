"""What a batch and a refresh read: each input as few times as its outputs need."""

import os

import pytest

from docpulse.functions.paths import is_result_path, parse_result_paths
from docpulse.plans import ingest
from docpulse.plans import partials as P
from docpulse.session import staging_dir
from docpulse.sources import tables as T
from test_partials import put

GOOD = '{"fieldLabels":{"f":{"valueString":"x"}}}'
REFUSED = '{"fieldLabels":{"f":{"type":"date","valueDate":"never"}}}'


@pytest.fixture
def plans(spark, monkeypatch):
    """Optimized plan of every table that is published (by table) or settled (by folder)."""
    found = {}

    def keep(name, df):
        found[name] = df._jdf.queryExecution().optimizedPlan().toString()

    publish, settle = ingest.publish, ingest._settle
    monkeypatch.setattr(ingest, "publish", lambda df, out, table, run: (keep(table, df), publish(df, out, table, run))[1])
    monkeypatch.setattr(ingest, "_settle", lambda df, folder: (keep(folder.rsplit("/", 1)[-1], df), settle(df, folder))[1])
    return found


def stored_files(spark, folder, rows):
    spark.createDataFrame(rows, "path STRING, value STRING").coalesce(1).write.parquet(f"{folder}/files")
    return spark.read.parquet(f"{folder}/files")


def test_batch_numbers_take_one_look_at_the_paths(spark, folder, plans):
    files = stored_files(spark, folder, [("u/a/x.json", GOOD), ("x.json", GOOD)])
    assert ingest.ingest_batch(files, f"{folder}/t", "r1") == {"processed": 1, "failed": 0, "skipped": 1, "deferred": 0}
    assert plans["batches"].count("Relation [path#") == 1
    assert "disposition" not in plans["batches"]  # nor at the manifest


def test_violations_are_known_before_they_meet_headers(spark, folder, plans):
    files = stored_files(spark, folder, [("u/a/x.json", GOOD), ("u/a/y.json", REFUSED)])
    ingest.ingest_batch(files, f"{folder}/t", "r1")
    assert "Aggregate" in plans["violations"]
    assert "Join" in plans["refused"] and "Aggregate" not in plans["refused"]


def test_batch_with_null_repeated_and_misplaced_paths(spark, folder):
    rows = 2 * [("u/a/x.json", GOOD), ("u/a/bad.json", "{"), ("u/a/y.json", REFUSED), ("x.json", GOOD), (None, GOOD)] + [("u/a/null.json", None)]
    files = stored_files(spark, folder, rows)
    assert ingest.ingest_batch(files, f"{folder}/t", "r1") == {"processed": 2, "failed": 3, "skipped": 4, "deferred": 0}
    stored = lambda table: sorted(r[0] for r in T.read_table(spark, f"{folder}/t", table).collect())
    assert T.read_table(spark, f"{folder}/t", "errors").groupBy("error_kind").count().orderBy("error_kind").collect() == [
        ("ParseError", 1), ("ReadError", 1), ("SqlError", 2)]
    assert stored("manifest") == [f"source/u/a/{n}.json" for n in ("bad", "null", "x", "x", "y")]
    assert T.documents(spark, f"{folder}/t").count() == 2


def test_result_paths_are_told_as_they_are_parsed(spark):
    rows = spark.createDataFrame([(p,) for p in ("u/a/x.json", "u/a/x.JSON", "u//x.json", "u/a/x.txt", "x.json", "u/a/b/x.json", "u/a/", "", None)], "path STRING")
    assert rows.filter(is_result_path()).collect() == parse_result_paths(rows).select("path").collect()
    assert rows.filter(~is_result_path()).count() == 6  # NULL among them


def test_a_refresh_finds_current_documents_once(spark, folder, monkeypatch):
    plans, share = {}, P._share
    monkeypatch.setattr(P, "_share", lambda rows, name: (plans.update({name: rows._jdf.queryExecution().optimizedPlan().toString()}), share(rows, name))[1])
    put(spark, folder, "run-a", range(4), 0.9, 1)
    put(spark, folder, "run-b", range(2), 0.4, 2, "U")
    assert P.refresh(spark, folder) == 1
    assert all("Aggregate" not in plans[name] and "LeftSemi" not in plans[name] for name in ("fields", "documents"))
    rows = {r.usecase: r.document_count for r in P.report(spark, folder, "documents").collect()}
    assert rows == {"u": 2, "U": 2}
    assert not os.path.exists(staging_dir(spark, folder, f"{P.ROOT}-1"))  # deleted once published


def test_a_refresh_looks_for_touched_runs_among_the_others(spark, folder, monkeypatch):
    seen, runs_with = [], P._runs_with
    monkeypatch.setattr(P, "_runs_with", lambda rows, keys: (seen.append(sorted(r.run_id for r in rows.select("run_id").distinct().collect())), runs_with(rows, keys))[1])
    put(spark, folder, "run-a", range(4), 0.9, 1)
    put(spark, folder, "run-b", range(4, 6), 0.9, 1)
    P.refresh(spark, folder)
    assert seen == []  # all are new, so there are no others
    put(spark, folder, "run-c", range(2), 0.4, 2)
    put(spark, folder, "run-d", range(2), 0.5, 3)
    P.refresh(spark, folder)
    assert seen == [["run-a", "run-b"]]
    assert {r.run_id: r.gen for r in P._read_marks(spark, folder, 2).collect()} == {"run-a": 2, "run-b": 1, "run-c": 2, "run-d": 2}
