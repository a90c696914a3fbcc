import datetime
import json
import struct
import zlib
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docpulse.constants import LIMITS
from docpulse.operators.decode import decode_text
from docpulse.operators.pages import estimate_skew, page_dpi, page_sample, sampled_pages, scan_page_sample
from docpulse.operators.pixels import image_features
from docpulse.operators.rules import judge, with_kind
from docpulse.plans.quality import IMAGE, METRICS, PAGES, check_files
from docpulse.schemas import FILE_METRICS, PAGE_METRICS
from docpulse.sources.files import read_images
from workload.standins import spread

OK = dict(found=True, is_file=True, length=10)
PDF, PNG = b"%PDF-1.7", b"\x89PNG\r\n\x1a\n..."
ZIP = b"PK\x03\x04"


def image(**more):
    return {**dict(decoded=True, width=2000, height=1500, image_mode="L", mean=120.0, stdev=60.0, blur=900.0), **more}


def metrics(**more):
    return {**dict(open_error=None, encrypted=False, page_count=3, character_count=100, sheet_count=1, slide_count=1, scan_skipped=False), **more}


def page(n=0, **more):
    return {**dict(page=n, stdev=40.0, mean=120.0, blur_var=900.0, skew=0, skew_conf=1.0, dpi=300.0), **more}


def pages(**more):
    base = dict(sampled_pages=3, total_chars=3000, avg_chars=1000.0, low_text_pages=0, empty_pages=0, low_ratio=0.0, scan_pages=0, scan_blur=900.0,
                scan_stdev=40.0, scan_mean=120.0, scan_dpi=300.0, blurry=[], low_contrast=[], skewed=[], low_dpi=[])
    return {**base, **more}


def scan(**lists):
    return pages(scan_pages=2, low_text_pages=2, avg_chars=100.0 if False else 300.0, **lists)


# (name, file columns, expected codes); every rule once firing, and its neighbour not firing
CASES = [
    ("gone.pdf", dict(found=False, is_file=False, length=None), ["FILE_NOT_FOUND"]),
    ("dir.pdf", dict(is_file=False, length=0), ["NOT_A_FILE"]),
    ("a.pdf", dict(length=None), ["STAT_FAILED"]),
    ("a.txt", dict(length=0), ["FILE_EMPTY"]),
    ("a.zzz", dict(), ["UNSUPPORTED_EXTENSION"]),
    ("noext", dict(), ["UNSUPPORTED_EXTENSION"]),
    ("a.txt", dict(length=2**20, chars=5, head=b"x"), []),
    ("a.txt", dict(length=2**20 + 1, chars=5, head=b"x"), ["FILE_TOO_LARGE"]),
    ("a.pdf", dict(length=200 * 2**20, head=PDF, metrics=metrics(), pages=pages()), []),
    ("a.pdf", dict(length=200 * 2**20 + 1, head=PDF, metrics=metrics(), pages=pages()), ["FILE_TOO_LARGE"]),
    ("a.pdf", dict(head=b"hello", metrics=metrics(), pages=pages()), ["MAGIC_MISMATCH"]),
    ("a.txt", dict(head=None), ["READ_FAILED"]),
    ("a.heic", dict(head=b"0000ftypheic", image=None), ["IMAGE_DEEP_CHECK_SKIPPED"]),
    ("a.heic", dict(head=b"0000ftypxxxx", image=image(decoded=False)), ["MAGIC_MISMATCH", "IMAGE_DEEP_CHECK_SKIPPED"]),
    ("a.txt", dict(head=b"x", chars=1_000_000), []),
    ("a.txt", dict(head=b"x", chars=1_000_001), ["TEXT_TOO_MANY_CHARS"]),
    ("a.txt", dict(head=b"x", chars=0), ["TEXT_EMPTY"]),
    ("a.png", dict(head=PNG, image=image()), []),
    ("a.png", dict(head=PNG, image=image(decoded=False)), ["IMAGE_OPEN_FAILED"]),
    ("a.png", dict(head=PNG, image=image(height=50)), []),
    ("a.png", dict(head=PNG, image=image(height=49)), ["IMAGE_TOO_SMALL"]),
    ("a.png", dict(head=PNG, image=image(width=10_000)), []),
    ("a.png", dict(head=PNG, image=image(width=10_001)), ["IMAGE_TOO_LARGE"]),
    ("a.png", dict(head=PNG, image=image(width=1000, height=999)), []),
    ("a.png", dict(head=PNG, image=image(width=999, height=999)), ["IMAGE_LOW_RESOLUTION"]),
    ("a.png", dict(head=PNG, image=image(blur=50.0)), []),
    ("a.png", dict(head=PNG, image=image(blur=49.9)), ["IMAGE_BLURRY"]),
    ("a.png", dict(head=PNG, image=image(stdev=15.0)), []),
    ("a.png", dict(head=PNG, image=image(stdev=14.9, mean=231.0)), ["IMAGE_LOW_CONTRAST"]),
    ("a.pdf", dict(head=PDF, metrics=None), ["PDF_DEEP_CHECK_SKIPPED"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(open_error="broken")), ["PDF_OPEN_FAILED"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(encrypted=True, page_count=301), pages=None), ["PDF_PASSWORD_PROTECTED", "PDF_TOO_MANY_PAGES"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(page_count=0), pages=None), ["PDF_NO_PAGES"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(page_count=300), pages=pages()), []),
    ("a.pdf", dict(head=PDF, metrics=metrics(page_count=301), pages=pages()), ["PDF_TOO_MANY_PAGES"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(), pages=pages(avg_chars=4.9, low_ratio=1.0, low_text_pages=3, empty_pages=3)), ["PDF_LIKELY_SCANNED"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(), pages=pages(avg_chars=5.0)), ["PDF_LOW_TEXT_DENSITY"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(), pages=pages(avg_chars=200.0, low_ratio=0.3, low_text_pages=1)), []),
    ("a.pdf", dict(head=PDF, metrics=metrics(), pages=pages(low_ratio=0.3, low_text_pages=2)), ["PDF_MANY_LOW_TEXT_PAGES"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(), pages=pages(low_ratio=0.29, low_text_pages=2, empty_pages=1)), ["PDF_BLANK_PAGES"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(scan_skipped=True), pages=pages(low_text_pages=1)), ["PDF_SCAN_CHECK_SKIPPED"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(), pages=scan(blurry=[page(3)])), ["PDF_SCAN_BLURRY"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(), pages=scan(low_contrast=[page(3)])), ["PDF_SCAN_LOW_CONTRAST"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(), pages=scan(skewed=[page(3, skew=-4)])), ["PDF_SCAN_SKEWED"]),
    ("a.pdf", dict(head=PDF, metrics=metrics(), pages=scan(low_dpi=[page(3, dpi=96.04)])), ["PDF_SCAN_LOW_DPI"]),
    ("a.docx", dict(head=ZIP, metrics=metrics(character_count=1_000_000)), []),
    ("a.docx", dict(head=ZIP, metrics=metrics(character_count=1_000_001)), ["OFFICE_TOO_MANY_CHARS"]),
    ("a.docx", dict(head=ZIP, metrics=metrics(open_error="File is ENCRYPTED")), ["DOCX_PASSWORD_PROTECTED"]),
    ("a.docx", dict(head=ZIP, metrics=metrics(open_error="no zip")), ["DOCX_OPEN_FAILED"]),
    ("a.xlsx", dict(head=ZIP, metrics=metrics(open_error="password")), ["XLSX_PASSWORD_PROTECTED"]),
    ("a.xlsx", dict(head=ZIP, metrics=metrics(open_error="no zip")), ["XLSX_OPEN_FAILED"]),
    ("a.pptx", dict(head=ZIP, metrics=metrics(open_error="password")), ["PPTX_OPEN_FAILED"]),
    ("a.pptx", dict(head=ZIP, metrics=None), ["PPTX_DEEP_CHECK_SKIPPED"]),
    ("a.xlsx", dict(head=ZIP, metrics=None), ["XLSX_DEEP_CHECK_SKIPPED"]),
    ("a.docx", dict(head=ZIP, metrics=None), ["DOCX_DEEP_CHECK_SKIPPED"]),
]
ROW = (f"i INT, path STRING, file_name STRING, found BOOLEAN, is_file BOOLEAN, length BIGINT, head BINARY, chars BIGINT, encoding STRING, "
       f"metrics {METRICS}, pages {PAGES}, image {IMAGE}")
KEYS = [c.split()[0] for c in "i,path,file_name,found,is_file,length,head,chars,encoding,metrics,pages,image".split(",")]


def judged(spark, cases, mode="standard"):
    rows = []
    for i, (name, columns, _) in enumerate(cases):
        row = {**dict.fromkeys(KEYS), **OK, "i": i, "path": "u/a/" + name, "file_name": name, **columns}
        rows.append(tuple(row[k] for k in KEYS))
    df = judge(with_kind(spark.createDataFrame(rows, ROW)), mode)
    return {r.i: r for r in df.select("i", "issues", "metadata_json", "score", "passed", "extension", "detected_kind").collect()}


def test_every_rule(spark):
    got = judged(spark, CASES)
    assert [[x.code for x in got[i].issues] for i in range(len(CASES))] == [codes for _, _, codes in CASES]
    for row in got.values():
        assert row.passed == all(x.severity != "ERROR" for x in row.issues)
        for x in row.issues:
            assert x.message and (x.details_json is None or json.loads(x.details_json))


def test_pro_mode(spark):
    cases = [("a.txt", dict(head=b"x", chars=1), 0), ("a.pdf", dict(length=100 * 2**20 + 1, head=PDF, metrics=metrics(page_count=151), pages=pages()), 0)]
    got = judged(spark, cases, "pro")
    assert [[x.code for x in got[i].issues] for i in range(2)] == [["PRO_MODE_UNSUPPORTED_EXTENSION"], ["FILE_TOO_LARGE", "PDF_TOO_MANY_PAGES"]]
    with pytest.raises(ValueError):
        judged(spark, cases, "other")


def test_details_and_metadata(spark):
    cases = [c for c in CASES if c[2] in (["PDF_SCAN_LOW_DPI"], ["PDF_SCAN_SKEWED"], ["IMAGE_LOW_CONTRAST"])]
    got = judged(spark, cases)
    details = {x.code: x.details_json for r in got.values() for x in r.issues}
    assert details["PDF_SCAN_LOW_DPI"] == '{"low_dpi_pages": [{"page": 4, "dpi": 96.0}], "pages_analyzed": 2, "threshold_dpi": 150.0, "min_dpi": 96.0}'
    assert details["PDF_SCAN_SKEWED"] == '{"skewed_pages": [{"page": 4, "angle_deg": -4}], "pages_analyzed": 2, "threshold_deg": 2.0}'
    assert details["IMAGE_LOW_CONTRAST"] == '{"mean_intensity": 231.0, "stdev_intensity": 14.9}'
    meta = {json.loads(r.metadata_json)["mime_type"] for r in got.values()}
    assert meta == {"application/pdf", "image/png"}


def test_page_sample_counts(spark):
    counts = spark.createDataFrame([(str(n), n) for n in (0, 1, 100, 101, 250)], "path STRING, page_count INT")
    got = {}
    for r in page_sample(counts).collect():
        got.setdefault(int(r.path), []).append(r.page)
    want = {n: sorted({int(i * (n / 100)) for i in range(100)}) if n > 100 else list(range(n)) for n in (1, 100, 101, 250)}
    assert {k: sorted(v) for k, v in got.items()} == want


def test_scan_sample_counts(spark):
    for n in (1, 5, 6, 15):
        low = F.array(*[F.struct(F.lit(i).alias("page")) for i in range(n)])
        picked = [p.page for p in spark.range(1).select(scan_page_sample(low).alias("p")).first().p]
        k = min(n, 5)
        assert picked == [int(i * (n / k)) for i in range(k)]


def test_skew_ties_and_floor(spark):
    flat = [("flat", 0, a, r, 5) for a in range(-10, 11) for r in range(4)]
    tie = [("tie", 0, a, r, (100 if a in (-3, 7) else 1) * r) for a in range(-10, 11) for r in range(4)]
    got = {r.path: r for r in estimate_skew(spark.createDataFrame(flat + tie, "path STRING, page INT, angle INT, row INT, ink BIGINT")).collect()}
    assert (got["flat"].skew, got["flat"].skew_conf) == (-10, 0.0)
    assert (got["tie"].skew, got["tie"].skew_conf) == (-3, 12500.0 / 1.25)


def test_page_dpi_ties_and_skips(spark):
    rows = [("p", 0, 0, 0.0, 0.0, 72.0, 72.0, 100, 200), ("p", 0, 1, 0.0, 0.0, 72.0, 72.0, 900, 900), ("p", 0, 2, 0.0, 0.0, 720.0, 720.0, 0, 9), ("p", 1, 0, 0.0, 0.0, 0.0, 5.0, 9, 9)]
    got = page_dpi(spark.createDataFrame(rows, "path STRING, page INT, pos INT, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, width_px INT, height_px INT")).collect()
    assert [(r.page, r.dpi) for r in got] == [(0, 100.0)]


def test_encodings(spark):
    texts = ["hé", "﻿x", "\U0001F600"]
    data = [t.encode("utf-8") for t in texts] + ["héllo".encode("utf-16"), b"\xff\xfe", b"h\xe9l", b"h\x81\xe9", "x\U0001F600".encode("utf-16"), b"\xed\xa0\x80"]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(data)], "i INT, content BINARY")
    got = [(r.encoding, r.chars) for r in decode_text(df, F.lit(True)).orderBy("i").collect()]

    def plain(raw):
        for name in ("utf-8", "utf-8-sig", "utf-16", "cp1252", "latin-1"):
            try:
                return name, len(raw.decode(name))
            except UnicodeDecodeError:
                pass

    assert got == [plain(d) for d in data]


def png(width, height, rows, color=0):
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    body = zlib.compress(b"".join(b"\0" + r for r in rows))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, color, 0, 0, 0)) + chunk(b"IDAT", body) + chunk(b"IEND", b"")


def test_images(spark, folder):
    import os

    os.makedirs(f"{folder}/u/a")
    checker = [bytes(255 * ((x + y) % 2) for x in range(60)) for y in range(60)]
    files = {"flat.png": png(60, 60, [bytes([200] * 60)] * 60), "sharp.png": png(60, 60, checker),
             "red.png": png(2, 2, [bytes([255, 0, 0] * 2)] * 2, 2), "broken.png": b"\x89PNG\r\n\x1a\nxx"}
    for name, body in files.items():
        open(f"{folder}/u/a/{name}", "wb").write(body)
    got = {r.path[4:]: r for r in image_features(read_images(spark, folder)).collect()}
    assert not got["broken.png"].decoded and got["broken.png"].mean is None
    assert (got["flat.png"].mean, got["flat.png"].stdev, got["flat.png"].image_mode) == (200.0, 0.0, "L")
    # Only the kept border differs from zero: 236 of 3600 pixels at 200.
    share = 236 / 3600
    assert got["flat.png"].blur == pytest.approx(200 * 200 * share * (1 - share))
    assert got["sharp.png"].blur > 10_000 and got["sharp.png"].stdev == 127.5
    assert got["red.png"].mean == 76.0 and got["red.png"].image_mode == "RGB"


def test_pdf_path_end_to_end(spark):
    low = replace(LIMITS, page_sample=10)
    files = spark.createDataFrame([("u/a/p.pdf", True, True, 9, PDF, datetime.datetime(2024, 1, 1))], "path STRING, found BOOLEAN, is_file BOOLEAN, length BIGINT, head BINARY, modified TIMESTAMP")
    fm = spark.createDataFrame([("u/a/p.pdf", None, False, 12, None, None, None)], FILE_METRICS)
    pm = spark.createDataFrame([("u/a/p.pdf", i, 10, None if i == 4 else 40.0, 100.0, 100.0, 5, 1.2, None) for i in range(11)], PAGE_METRICS)
    (r,) = check_files(files, fm, pm, limits=low).collect()
    meta = json.loads(r.metadata_json)
    # 10 of 12 pages are sampled, the last of them is missing from the metrics and counts as empty.
    assert meta["sampled_pages"] == 10 and meta["low_text_pages"] == 10 and meta["total_chars_sampled"] == 100
    # Scan pages 0, 2, 4, 7, 9 of the low-text list; page 4 could not be rendered.
    assert meta["scan_pages_analyzed"] == 4
    assert [x.code for x in r.issues] == ["PDF_LOW_TEXT_DENSITY", "PDF_MANY_LOW_TEXT_PAGES", "PDF_SCAN_BLURRY", "PDF_SCAN_SKEWED"]


def test_pixels_by_bands_equal_those_of_the_whole(spark, folder):
    """An image of three bands, with the neighbours of rows in other bands."""
    height, width = 3_000, 3_001
    noise = np.random.default_rng(5).integers(0, 256, (height, width), dtype=np.uint8)
    g = noise.astype(np.int64)
    edges = g.copy()
    edges[1:-1, 1:-1] = np.clip(g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1], 0, 255)
    pq.write_table(pa.table({"path": ["a"], "height": [height], "width": [width], "data": [noise.tobytes()]}), f"{folder}/image.parquet")
    images = spark.read.parquet(f"{folder}/image.parquet").selectExpr(
        "path", "struct(CAST(height AS INT) AS height, CAST(width AS INT) AS width, 1 AS nChannels, 0 AS mode, data) AS image")
    row = image_features(images).first()
    assert (row.mean, row.stdev, row.blur) == pytest.approx((noise.mean(), noise.std(), edges.var()))


def test_page_metrics_are_not_sent_through_the_driver(spark):
    """Metrics out of an explode are estimated as small as their source; the join must not broadcast them."""
    counts = spark.range(50).select(F.col("id").cast("string").alias("path"), F.lit(120).alias("page_count"))
    metrics = counts.select("path", F.explode(F.sequence(F.lit(0), F.lit(117))).alias("page")).withColumn("chars", F.lit(7))
    joined = sampled_pages(metrics, counts)
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50 * 100 and joined.filter("chars = 0").count() == 50


def test_rows_that_become_many_are_spread(spark):
    """Partitions grow with the rows, whatever the bytes say: each page of a part is 252 rows in its task."""
    few = spread(spark.range(1000).repartition(1), 400)
    many = spread(spark.range(100_000).repartition(1), 1000)
    cores = spark.sparkContext.defaultParallelism
    assert few.rdd.getNumPartitions() == max(2 * cores, 3) and many.rdd.getNumPartitions() == 100
    assert many.distinct().count() == 100_000
