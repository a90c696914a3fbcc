"""Listing stream, sidecars, timeouts of checks and the state of open checks."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from docpulse.plans.gate import check_batch, settle_outcomes
from docpulse.schemas import OUTCOMES
from docpulse.sources import sidecars as S
from docpulse.sources import tables as T
from docpulse.sources.listing import ListingReader, Log, admit, stream_files
from docpulse.sources.stores import safe_path
from docpulse.streaming.loops import start_ingest, start_settlement
from docpulse.streaming.timeouts import settle_stream

GOOD = '{"fieldLabels":{"k":{"valueString":"v"}}}'


def write(root, path, text, at=None):
    full = f"{root}/{path}"
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w") as f:
        f.write(text)
    if at is not None:
        os.utime(full, (at, at))


def files_of(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names)


# --- listing ---------------------------------------------------------------------------------


def test_admission_by_age_number_and_bytes():
    found = [(3, "c", 10), (1, "b", 10), (1, "a", 10), (2, "d", 0)]
    assert admit(found, 3, None) == [(1, "a", 10), (1, "b", 10), (2, "d", 0)]
    assert admit(found, 9, 20) == [(1, "a", 10), (1, "b", 10), (2, "d", 0)]
    assert admit([(1, "big", 99), (2, "x", 1)], 9, 5) == [(1, "big", 99)] and admit([], 9, 5) == []


def test_listing_knows_versions_and_compacts(folder):
    src, log = f"{folder}/src", f"{folder}/log"
    for i in range(5):
        write(src, f"u/a/{i}.json", "x" * i, at=1000 + i)
    write(src, "u/a/_hidden.json", "x")
    write(src, "u/a/x.txt", "x")
    options = {"path": src, "log": log, "maxfiles": "2", "names": r".*\.json"}
    reader = ListingReader(options)
    seen = []

    def step(reader, last):
        end = reader.latestOffset()
        rows = [r for s in reader.partitions({"batch": last}, end) for r in reader.read(s)]
        reader.commit(end)
        return end["batch"], [(os.path.basename(p), n, d) for p, _, n, d in rows]

    last, rows = step(reader, 0)
    assert rows == [("0.json", 0, 3), ("1.json", 1, 3)]
    reader = ListingReader(options)  # a restart goes on from the log
    last, rows = step(reader, last)
    assert rows == [("2.json", 2, 1), ("3.json", 3, 1)]
    write(src, "u/a/0.json", "new", at=2000)
    last, rows = step(reader, last - 1)  # a batch that is run again has its files again, with those that follow
    assert rows[:2] == [("2.json", 2, 1), ("3.json", 3, 1)]
    for i in range(240):
        write(src, "u/a/4.json", "y" * (i + 7), at=3000 + i)
        last, rows = step(reader, last)
        seen += rows
    assert ("4.json", 7 + 239, 0) in seen and len(Log(log).entries()["batch"]) < 150 and len(Log(log).entries()["known"]) == 1
    again = ListingReader(options)
    assert again.latestOffset()["batch"] == last and again.known == reader.known and "u/a/0.json" in again.known


def test_a_failed_batch_has_its_files_again(spark, folder):
    src, checkpoint = f"{folder}/src", f"{folder}/c"
    for i in range(3):
        write(src, f"{i}.txt", "x" * i)
    got = []

    def run(fail):
        def handle(batch, number):
            got.append((number, sorted(r.path for r in batch.collect())))
            if fail:
                raise RuntimeError("lost")
        query = stream_files(spark, src, f"{checkpoint}/files", 2).writeStream.foreachBatch(handle).option(
            "checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run(True)
    write(src, "0.txt", "changed meanwhile")
    run(False)
    assert got[0] == got[1] and got[0][0] == 0
    run(False)
    assert set(got[-1][1]) == {"0.txt", *{"1.txt", "2.txt", "0.txt"} - set(got[0][1])}


def test_ticks_defer_and_rewritten_files_replace(spark, folder):
    src, out = f"{folder}/source", f"{folder}/out"
    for i in range(3):
        write(src, f"u/a/{i}.json", GOOD, at=1000 + i)
    write(src, "u/a/3.json", "", at=1003)
    tick = lambda: start_ingest(spark, src, out, f"{folder}/c", max_files=3, sidecars=f"{folder}/routed", drain=False).awaitTermination()
    tick()
    tick()
    write(src, "u/a/3.json", GOOD.replace('"v"', '"w"'))
    tick()
    counts = sorted((r.run_id, r.processed, r.failed, r.deferred) for r in T.read_table(spark, out, "batches").collect())
    assert counts == [("ingest-000000000000", 3, 0, 1), ("ingest-000000000001", 0, 1, 0), ("ingest-000000000002", 1, 0, 0)]
    assert sorted(r.value_string for r in T.fields(spark, out).collect()) == ["v", "v", "v", "w"]
    assert [(r.path, r.text[:12]) for r in S.read_sidecars(spark, f"{folder}/routed").collect()] == [("failed/u/a/3.json.error.txt", "[ParseError]")]


# --- sidecars --------------------------------------------------------------------------------


def test_paths_stay_below_their_folder():
    assert safe_path("../a/./b//c.txt") == "%2E%2E/a/%2E/b/%20/c.txt" and safe_path("a/b..c") == "a/b..c"


def test_only_committed_attempts_are_published(spark, folder):
    import pyarrow as pa

    batch = lambda text: pa.RecordBatch.from_pydict({"path": ["failed/u/x.error.txt", "failed/u/y.error.txt"], "text": [text, None]})
    writer = S.SidecarWriter(folder, "job")
    writer.write(iter([batch("lost attempt")]))
    kept = writer.write(iter([batch("kept attempt")]))
    assert not os.path.exists(f"{folder}/failed")
    S.finish(spark, folder)  # nothing is committed yet
    assert not os.path.exists(f"{folder}/failed")
    writer.commit([kept, None])
    S.finish(spark, folder)
    assert [f for f in files_of(folder)] == ["failed/u/x.error.txt", "failed/u/y.error.txt"]
    assert open(f"{folder}/failed/u/x.error.txt").read() == "kept attempt"
    S.finish(spark, folder)
    dropped = S.SidecarWriter(folder, "other")
    dropped.abort([dropped.write(iter([batch("aborted")]))])
    assert open(f"{folder}/failed/u/x.error.txt").read() == "kept attempt" and len(files_of(folder)) == 2


def test_sidecars_of_many_tasks(spark, folder):
    rows = [(f"rejected/u {i % 3}/a+b/{i}%.report.json", f"text {i} é") for i in range(60)] + [(None, "no path"), ("rejected/0.report.json", "b"), ("rejected/0.report.json", "a")]
    df = spark.createDataFrame(rows, "path string, text string").repartition(5)
    for _ in range(2):  # a batch that is run again leaves one file each
        S.publish_sidecars(df, folder)
    want = {(p, t) for p, t in rows if p} - {("rejected/0.report.json", "b")}
    assert {tuple(r) for r in S.read_sidecars(spark, folder).collect()} == want and len(files_of(folder)) == len(want)


# --- outcomes --------------------------------------------------------------------------------

EVENTS = "check_id BIGINT, event_time TIMESTAMP, kind STRING, status STRING, operation_location STRING, error_message STRING, write_ok BOOLEAN, failed_call BOOLEAN"


def events(*rows):
    start = datetime.datetime(2024, 1, 1)
    return [(c, start + datetime.timedelta(seconds=s), "outcome" if status else "submitted", status, "op", None, True, False) for c, s, status in rows]


def test_outcomes_and_timeouts(spark, folder):
    src, out = f"{folder}/events", f"{folder}/out"
    batches = [
        events((1, 0, None), (2, 0, None), (3, 0, None), (4, 0, None), (5, 50, "Succeeded"), (7, 0, None), (8, 10, "Succeeded")),
        events((1, 100, "Succeeded"), (2, 540, "Failed"), (5, 60, None), (6, 60, None), (1, 120, "Failed")),
        events((3, 541, "Succeeded"), (7, 100, "Failed"), (7, 90, "Succeeded")),
        events((9, 5_000, None)),
        events((4, 5_100, "Succeeded"), (10, 9_000, None)),
        events((9, 5_200, "Succeeded")),  # late by more than the delay: its check has timed out
    ]
    for rows in batches:
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(src)
        stream = settle_stream(spark.readStream.schema(EVENTS).parquet(src), delay="600 seconds")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start().awaitTermination()
    got = {r.check_id: r.status for r in spark.read.parquet(out).collect()}
    assert got == {1: "Succeeded", 2: "Failed", 3: "Timeout", 4: "Timeout", 5: "Succeeded", 6: "Timeout", 7: "Succeeded", 9: "Timeout"}
    assert spark.read.parquet(out).count() == len(got)


def test_open_checks_are_read_and_closed(spark, folder):
    rows = [(f"u/a/{i}.{'xyz' if i % 4 == 3 else 'txt'}", datetime.datetime(2024, 1, 1), 1, b"x") for i in range(40)]
    content = spark.createDataFrame(rows, "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
    out = f"{folder}/out"
    check_batch(content, out, "r1")
    checks = {r.file_name: r.check_id for r in T.checks(spark, out).collect()}
    assert T.read_open(spark, out).count() == 40
    for run, names in (("s1", ["0.txt"]), ("s1", ["0.txt"]), ("s2", ["1.txt", "2.txt"])):
        outcomes = spark.createDataFrame([(checks[n], "Succeeded", "op", None, True, False) for n in names], OUTCOMES)
        routed = settle_outcomes(spark, out, outcomes, run)
        plan = routed._jdf.queryExecution().toString()
        assert "/checks" not in plan
    left = {r.file_name for r in T.read_open(spark, out).collect()}
    assert left == {f"{i}.txt" for i in range(40) if i % 4 != 3} - {"0.txt", "1.txt", "2.txt"}
    state = {r.file_name: r.cu_status for r in T.checks(spark, out).collect()}
    assert state["0.txt"] == state["2.txt"] == "Succeeded" and state["3.xyz"] == "Skipped" and state["4.txt"] is None


def test_settlement_loop(spark, folder):
    """Stored checks meet a stream of outcomes: one in time, one failed, one never."""
    out = f"{folder}/out"
    rows = [(f"u/a/{n}.{e}", datetime.datetime(2024, 1, 1), 1, b"x") for n, e in (("good", "txt"), ("bad", "txt"), ("never", "txt"), ("odd", "xyz"))]
    check_batch(spark.createDataFrame(rows, "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"), out, "r1")
    ids = {r.file_name: (r.check_id, r.checked_at) for r in T.checks(spark, out).collect()}
    second = datetime.timedelta(seconds=1)
    said = [(*ids["good.txt"], "Succeeded"), (ids["bad.txt"][0], ids["bad.txt"][1] + 5 * second, "Failed"), (-1, ids["bad.txt"][1] + 9_000 * second, "Failed")]
    table = spark.createDataFrame([(c, t, s, "op", None, True, False) for c, t, s in said], EVENTS.replace(" kind STRING,", ""))
    table.coalesce(1).write.parquet(f"{folder}/said")
    for _ in range(2):
        stream = spark.readStream.schema(table.schema).parquet(f"{folder}/said")
        start_settlement(stream, out, f"{folder}/s", sidecars=f"{folder}/routed").awaitTermination()
    assert {r.file_name: r.cu_status for r in T.checks(spark, out).collect()} == {
        "good.txt": "Succeeded", "bad.txt": "Failed", "never.txt": "Timeout", "odd.xyz": "Skipped"}
    assert T.read_open(spark, out).count() == 0
    assert sorted(r.path for r in S.read_sidecars(spark, f"{folder}/routed").collect()) == [f"rejected/u/a/{n}.report.json" for n in ("bad.txt", "never.txt", "odd.xyz")]


def test_a_batch_of_one_split_is_spread(spark):
    """A source may hand a batch out as one split; its files are parsed on all cores, and none is lost."""
    from docpulse.streaming.loops import spread

    batch = spark.range(1000).coalesce(1)
    rows = spread(batch)
    assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
    assert sorted(r.id for r in rows.collect()) == list(range(1000))
    assert spread(rows) is rows
