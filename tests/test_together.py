"""Batches that are there at once go through one plan and stay runs of their own; a listing serves all of them."""

import os

from pyspark.sql import Row

from docpulse.sources import listing
from docpulse.sources import tables as T
from docpulse.streaming import loops
from docpulse.streaming.loops import start_ingest, start_quality, together

GOOD = '{"fieldLabels":{"k":{"valueString":"%s"}}}'


def write(root, path, text, at):
    full = f"{root}/{path}"
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w") as f:
        f.write(text)
    os.utime(full, (at, at))


def counted(monkeypatch, module, name):
    calls, function = [], getattr(module, name)

    def call(*args, **kwargs):
        calls.append(args)
        return function(*args, **kwargs)

    monkeypatch.setattr(module, name, call)
    return calls


def test_one_listing_serves_many_batches(folder, monkeypatch):
    src = f"{folder}/src"
    for i in range(9):
        write(src, f"u/a/{i}.json", "x" * (i + 1), at=1000 + i)
    calls = counted(monkeypatch, listing, "list_files")
    reader = listing.ListingReader({"path": src, "log": f"{folder}/log", "maxfiles": "2", "together": "4"})
    read = lambda a, b: [(os.path.basename(p), n, d, k) for s in reader.partitions({"batch": a}, {"batch": b}) for p, _, n, d, k in reader.read(s)]
    assert reader.latestOffset() == {"batch": 2}
    assert read(0, 2) == [("0.json", 1, 7, 1), ("1.json", 2, 7, 1), ("2.json", 3, 5, 2), ("3.json", 4, 5, 2)]
    write(src, "u/a/5.json", "changed", at=2000)
    os.remove(f"{src}/u/a/7.json")
    assert reader.latestOffset() == {"batch": 5} and len(calls) == 1
    assert [(r[0], r[3]) for r in read(2, 5)] == [("4.json", 3), ("6.json", 4), ("8.json", 5)]  # as listed; the others have changed or are gone
    assert reader.latestOffset() == {"batch": 6} and len(calls) == 2
    assert read(5, 6) == [("5.json", 7, 0, 6)]
    assert reader.latestOffset() == {"batch": 6}


def test_bytes_bound_what_is_handed_out_together(folder, monkeypatch):
    for i in range(5):
        write(f"{folder}/src", f"{i}.json", "x" * 10, at=1000 + i)
    monkeypatch.setattr(listing, "MOST_BYTES", 25)
    reader = listing.ListingReader({"path": f"{folder}/src", "log": f"{folder}/log", "maxfiles": "1", "maxbytes": "10", "together": "100"})
    assert [reader.latestOffset()["batch"] for _ in range(4)] == [2, 4, 5, 5]


def test_whole_batches_without_a_path_twice():
    rows = [Row(path=p, batch=b) for b, p in ((2, "x"), (1, "x"), (1, "y"), (2, "z"), (3, "y"), (4, "q"))]
    assert [[(r.batch, r.path) for r in part] for part in together(rows)] == [[(1, "x"), (1, "y")], [(2, "x"), (2, "z"), (3, "y"), (4, "q")]]


def tables(spark, out):
    columns = {"documents": "blob_path, field_count, processed_blob_url, run_id", "fields": "field_path, value_string, run_id", "errors": "blob_path, error_kind, error_message, run_id",
               "manifest": "src_path, dest_path, sidecar_path, run_id", "batches": "processed, failed, skipped, deferred, run_id",
               "checks": "blob_path, passed, score, run_id", "issues": "code, severity, run_id"}
    found = {name: sorted(str(r) for r in T.read_table(spark, out, name).selectExpr(*names.split(", ")).collect()) for name, names in columns.items()}
    found["open"] = sorted(str(r) for r in T.read_open(spark, out).select("blob_path", "state", "run_id").collect())
    return found


def test_batches_of_one_plan_are_the_runs_of_single_ones(spark, folder, monkeypatch):
    for i in range(7):
        write(f"{folder}/source", f"u/a/{i}.json", "{" if i == 3 else "" if i == 4 else GOOD % i, at=1000 + i)
        write(f"{folder}/incoming", f"u/a/{i}.{'xyz' if i == 2 else 'txt'}", "" if i == 4 else f"text {i}", at=1000 + i)
    write(f"{folder}/source", "elsewhere/1.json", "{}", at=1002.5)
    write(f"{folder}/incoming", "elsewhere.txt", "x", at=1002.5)
    calls = counted(monkeypatch, loops, "ingest_batch"), counted(monkeypatch, loops, "check_listed")
    for out, drain, starts in (("one", True, 1), ("many", False, 5)):
        for _ in range(starts):
            start_ingest(spark, f"{folder}/source", f"{folder}/{out}", f"{folder}/{out}-i", max_files=2, sidecars=f"{folder}/{out}-routed", drain=drain).awaitTermination()
            start_quality(spark, f"{folder}/incoming", f"{folder}/{out}", f"{folder}/{out}-q", max_files=2, drain=drain).awaitTermination()
        assert [len(c) for c in calls] == ([1, 1] if drain else [5, 5])
    one, many = tables(spark, f"{folder}/one"), tables(spark, f"{folder}/many")
    assert one == many and len(one["batches"]) == 8 and len(one["documents"]) == 5 and len(one["errors"]) == 2 and len(one["open"]) == 7
    of = lambda where: sorted(f for _, _, names in os.walk(f"{folder}/{where}-routed") for f in names)
    assert of("one") == of("many") == ["3.json.error.txt", "4.json.error.txt"]
