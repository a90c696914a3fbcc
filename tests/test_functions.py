import math
import random

from pyspark.sql import functions as F

from docpulse.functions import paths, scoring, text
from docpulse.operators.parse import iso_datetime


def values(spark, items, fn, kind="string"):
    """fn over every item, by one query."""
    rows = spark.createDataFrame(list(enumerate(items)), f"i INT, v {kind}")
    return [r.o for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_round_and_float_text_match_python(spark):
    rng = random.Random(1)
    xs = [0.05, 0.15, 0.25, 0.35, 2.675, 1e15 + 0.25, 0.0, -0.15, -0.25, 99.95, 151.5] + [rng.uniform(-1000, 1000) for _ in range(500)]
    xs += [rng.randint(0, 10**6) / rng.randint(1, 400) for _ in range(500)] + [k / 20 for k in range(400)]
    assert values(spark, xs, text.round_tenth, "double") == [round(x, 1) for x in xs]
    ys = xs + [1e16, 1.5e16, 123456789012345.6, 1e-4, 9.99e-5, 1e-5, 1.2345e-7, 1e22, 1e100, 1.5e300, 1e-120, -1e20, math.inf, -math.inf]
    assert values(spark, ys, text.float_text, "double") == [repr(float(y)) for y in ys]


def test_coerce_int(spark):
    assert values(spark, ["7", " -7 ", "+7", "7.0", "", "x", None, "99999999999999999999"], text.coerce_int) == [7, -7, 7, None, None, None, None, None]


def test_suffix_and_stem(spark):
    names = ["a.pdf", "a.b.c", ".env", "a.", "plain", "..pdf", "x.JSON"]
    assert values(spark, names, paths.suffix) == [".pdf", ".c", "", "", "", ".pdf", ".JSON"]
    assert values(spark, names, paths.stem) == ["a", "a.b", ".env", "a.", "plain", ".", "x"]
    assert values(spark, names, paths.checked_extension) == [".pdf", ".c", ".bin", ".bin", ".bin", ".pdf", ".json"]


def test_content_types(spark):
    names = ["a.PDF", "a.md", "a.msg", "a.csv", "a.txt.gz", "a.tgz", "none", ".pdf", "a.unknownext"]
    assert values(spark, names, paths.content_type) == [
        "application/pdf", "text/markdown", "application/vnd.ms-outlook", "text/csv", "text/plain", "application/x-tar",
        "application/octet-stream", "application/octet-stream", "application/octet-stream"]


def test_paths(spark):
    rows = [("u/a/x.json",), ("u/a/x.JSON",), ("u//x.json",), ("u/x.json",), ("a/b/c/x.json",), ("u/a/x.pdf",), ("u/a/x",)]
    df = spark.createDataFrame(rows, "path STRING")
    assert [r.path for r in paths.parse_result_paths(df).collect()] == ["u/a/x.json", "u/a/x.JSON", "u//x.json"]
    assert [r.blob_path for r in paths.parse_raw_paths(df).collect()] == ["incoming/u/a/x.json", "incoming/u/a/x.JSON", "incoming/u//x.json", "incoming/u/a/x.pdf"]


def test_candidate_batch_takes_first_conforming(spark):
    names = [f"skip{i}" for i in range(5)] + [f"u/a/{i}.json" for i in range(9)]
    df = spark.createDataFrame([(n,) for n in names], "path STRING")
    # Of the first 8 names by order, the last 3 conform.
    assert [r.path for r in paths.candidate_batch(df, 2).collect()] == ["u/a/0.json", "u/a/1.json"]
    # Names beyond the listed ones are left to the next batch.
    assert [r.path for r in paths.candidate_batch(df, 1).collect()] == []
    assert paths.raw_candidate_batch(df, 3).count() == 0


def test_score_and_band_boundaries(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 1, 0), (0, 2, 2), (1, 0, 0), (1, 2, 0), (2, 1, 2), (2, 1, 3), (4, 0, 0), (0, 0, 5)], "e INT, w INT, i INT")
    s = scoring.score(F.col("e"), F.col("w"), F.col("i"))
    got = [tuple(r) for r in df.select(s, scoring.band(s)).collect()]
    assert got == [(100, "excellent"), (90, "excellent"), (76, "good"), (70, "fair"), (50, "fair"), (26, "poor"), (24, "unusable"), (0, "unusable"), (90, "excellent")]
    bands = values(spark, [90, 89, 75, 74, 50, 49, 25, 24], scoring.band, "int")
    assert bands == ["excellent", "good", "good", "fair", "fair", "poor", "poor", "unusable"]


def test_confidence_bucket(spark):
    got = values(spark, ["0.9000", "0.8999", "0.7000", "0.6999", None], lambda c: scoring.confidence_bucket(c.cast("decimal(5,4)")))
    assert got == ["high", "medium", "medium", "low", "unknown"]


def test_iso_datetime(spark):
    texts = ["2026-05-20T11:08:00Z", "2026-05-20 11:08:00+02:00", "20260520T110800", "20260520", "2026-05-20T11", "2026-05-20T11:08:00.5+0530", " 2026-05-20 ",
             "2026", "2026-05", "2026-5-2", "2026-13-01", "x", "", "2026-05-20 11:00:00 UTC", None]
    got = values(spark, texts, lambda c: iso_datetime(c).cast("string"))
    assert got == ["2026-05-20 11:08:00", "2026-05-20 09:08:00", "2026-05-20 11:08:00", "2026-05-20 00:00:00", "2026-05-20 11:00:00", "2026-05-20 05:38:00.5",
                   "2026-05-20 00:00:00", None, None, None, None, None, None, None, None]


def test_json_helpers(spark):
    df = spark.createDataFrame([('a"b\né', None)], "s STRING, n STRING")
    row = df.select(text.json_object([("k", text.json_text(F.col("s"))), ("n", F.col("n")), ("x", F.lit(1))]).alias("o"),
                    text.json_object([("n", F.col("n"))]).alias("none")).first()
    assert row.o == '{"k": "a\\"b\\né", "x": 1}' and row.none is None
