"""Quality rules, page operators, scoring, gate and routing."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from docpulse.constants import LIMITS
from docpulse.functions import scoring
from docpulse.operators import gate as G
from docpulse.operators import pages as P
from docpulse.operators.decode import decode_text, page_equivalent as pages_of
from docpulse.operators.pixels import image_features
from docpulse.operators.rules import judge, with_kind
from docpulse.plans import quality as Q
from workload import standins as S
from workload.registry import query

SMALL = replace(
    LIMITS, max_bytes_text=10_000, max_bytes_pdf=5_000, max_bytes_image=2_000, max_bytes_office=1_000,
    max_bytes_pro=3_000, max_chars_text=10_000, max_chars_office=5_000,
)


def verdict():
    """Codes found, score, band and verdict of judged rows."""
    return [F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("codes"), "score", "band", "passed"]


def bare(rows):
    """Add the inputs a rule group may look at and these rows do not have."""
    more = {"metrics": Q.METRICS, "pages": Q.PAGES, "image": Q.IMAGE, "head": "binary", "encoding": "string", "chars": "bigint"}
    for name, kind in more.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    for name, value in (("found", True), ("is_file", True), ("length", 1)):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(value))
    if "path" not in rows.columns:
        rows = rows.withColumn("path", F.col("file_name"))
    return with_kind(rows)


def verdict_sql(src: str, codes: str, errors: str, warnings: str = "0", infos: str = "0") -> str:
    """Score, band and verdict from the severities of the findings."""
    return f"""SELECT doc_id, codes, score, CASE WHEN score >= 90 THEN 'excellent' WHEN score >= 75 THEN 'good' WHEN score >= 50 THEN 'fair'
  WHEN score >= 25 THEN 'poor' ELSE 'unusable' END AS band, passed FROM (SELECT doc_id, {codes} AS codes,
  CAST(GREATEST(0, 100 - 30 * ({errors}) - 10 * ({warnings}) - 2 * ({infos})) AS INTEGER) AS score, ({errors}) = 0 AS passed FROM {src}) t"""


def one(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def joined(*pairs: tuple[str, str]) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{code}' END" for code, c in pairs) + ")"


def total(*conds: str) -> str:
    return " + ".join(one(c) for c in conds) or "0"


def pick(*values: str, by="doc_id"):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(by) % len(values) + 1).cast("int"))


# --- G1..G7 ---------------------------------------------------------------------------------

EXTS = (".pdf", ".png", ".docx", ".txt", ".zzz")
_LEN = "CASE WHEN doc_id % 50 = 13 THEN NULL WHEN doc_id % 50 = 17 THEN 0 ELSE n_chars END"
SIZE_SQL = f"""f AS (SELECT doc_id, doc_id % 5 AS e, doc_id % 50 <> 11 AS found, doc_id % 50 NOT IN (7, 11) AS is_file, {_LEN} AS len FROM documents),
g AS (SELECT *, is_file AND len > 0 AND e <> 4 AS live, CASE e WHEN 0 THEN 3000 WHEN 1 THEN 3000 WHEN 2 THEN 1000 ELSE 10000 END AS lim FROM f)"""
_SIZE = [("FILE_NOT_FOUND", "NOT found"), ("NOT_A_FILE", "found AND NOT is_file"), ("STAT_FAILED", "is_file AND len IS NULL"),
         ("FILE_EMPTY", "is_file AND len = 0"), ("UNSUPPORTED_EXTENSION", "is_file AND len > 0 AND e = 4"),
         ("PRO_MODE_UNSUPPORTED_EXTENSION", "live AND e IN (2, 3)"), ("FILE_TOO_LARGE", "live AND len > lim")]


@query(f"WITH {SIZE_SQL} " + verdict_sql("g", joined(*_SIZE), total(*[c for _, c in _SIZE])))
def q_size_ext(spark, sf_dir):
    key = F.col("doc_id")
    rows = S.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(key.cast("string"), pick(*EXTS)).alias("file_name"), (key % 50 != 11).alias("found"),
        (~(key % 50).isin(7, 11)).alias("is_file"),
        F.when(key % 50 == 13, None).when(key % 50 == 17, 0).otherwise(F.col("n_chars")).alias("length"))
    return judge(bare(rows), "pro", SMALL, ["size"]).select("doc_id", *verdict())


# --- G8, G9 ---------------------------------------------------------------------------------

HEADS = ("255044462D", "89504E470D0A1A0A", "49492A00", "4D4D002A", "504B0304", "00000018667479706D696631", "0000")
MAGIC_EXTS = (".pdf", ".png", ".tif", ".tiff", ".docx", ".heic", ".txt", ".bmp", ".jpg")
# Which head fits which extension, by position in the two lists above.
_FITS = "((e = 0 AND h = 0) OR (e = 1 AND h = 1) OR (e IN (2, 3) AND h IN (2, 3)) OR (e = 4 AND h = 4) OR (e = 5 AND h = 5) OR e = 6)"
_MAGIC = [("READ_FAILED", "lost"), ("MAGIC_MISMATCH", f"NOT lost AND NOT {_FITS}")]


@query("WITH f AS (SELECT doc_id, doc_id % 9 AS e, doc_id % 7 AS h, doc_id % 50 = 3 AS lost FROM documents) "
       + verdict_sql("f", joined(*_MAGIC), one("lost"), one(_MAGIC[1][1])))
def q_magic(spark, sf_dir):
    head = F.concat(F.unhex(pick(*HEADS)), F.encode("text", "UTF-8"))
    rows = S.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.col("doc_id").cast("string"), pick(*MAGIC_EXTS)).alias("file_name"),
        F.when(F.col("doc_id") % 50 != 3, F.substring(head, 1, 32)).alias("head"))
    return judge(bare(rows), "standard", SMALL, ["magic"]).select("doc_id", *verdict())


# --- G10..G12, G42, G43 ---------------------------------------------------------------------

_BOM = "doc_id % 40 = 3"
_TEXT = [("TEXT_TOO_MANY_CHARS", f"NOT ({_BOM}) AND n_chars > 10000"), ("TEXT_EMPTY", _BOM)]


def text_bytes(spark, sf_dir):
    """Texts as UTF-8 bytes; some files are a bare UTF-16 byte order mark."""
    return S.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
        F.when(F.col("doc_id") % 40 == 3, F.unhex(F.lit("FFFE"))).otherwise(F.encode("text", "UTF-8")).alias("content"))


@query("WITH f AS (SELECT doc_id, n_chars FROM documents) " + verdict_sql("f", joined(*_TEXT), total(*[c for _, c in _TEXT])))
def q_text(spark, sf_dir):
    rows = decode_text(text_bytes(spark, sf_dir), F.lit(True))
    return judge(bare(rows), "standard", SMALL, ["text"]).select("doc_id", *verdict())


# Two bytes E9 after the text spoil UTF-8; an odd length rules out UTF-16.
@query("""WITH f AS (SELECT doc_id, text, doc_id % 3 AS k, CAST(strlen(text) AS BIGINT) AS n, regexp_matches(hex(encode(text)), '^(..)*(81|8D|8F|90|9D)') AS gaps FROM documents)
SELECT doc_id, CASE WHEN k = 0 THEN 'utf-8' WHEN k = 1 THEN 'utf-16' WHEN gaps THEN 'latin-1' ELSE 'cp1252' END AS encoding,
  CASE WHEN k < 2 THEN CAST(length(text) AS BIGINT) WHEN n % 2 = 0 THEN n + 1 ELSE n + 2 END AS chars FROM f""")
def text_decode(spark, sf_dir):
    utf8 = F.encode("text", "UTF-8")
    tail = F.when(F.length(utf8) % 2 == 0, F.unhex(F.lit("E9"))).otherwise(F.unhex(F.lit("E9E9")))
    rows = S.table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 3 == 0, utf8)
        .when(F.col("doc_id") % 3 == 1, F.concat(F.unhex(F.lit("FFFE")), F.encode("text", "UTF-16LE")))
        .otherwise(F.concat(utf8, tail)).alias("content"))
    return decode_text(rows, F.lit(True))


@query("""SELECT doc_id, CAST(CEIL(GREATEST(n_chars - 40, 0) / 3000.0) AS BIGINT) AS docx_pages, GREATEST(1, CAST(CEIL(n_chars / 3000.0) AS BIGINT)) AS text_pages
FROM documents""")
def page_equivalent(spark, sf_dir):
    rows = S.table(spark, sf_dir, "documents")
    return rows.select("doc_id", pages_of(F.greatest(F.col("n_chars") - 40, F.lit(0)), 3000).alias("docx_pages"), pages_of(F.col("n_chars"), 3000, 1).alias("text_pages"))


# --- G13..G18 -------------------------------------------------------------------------------

IMG_SQL = """f AS (SELECT p_partkey AS doc_id, p_partkey % 13 = 5 AS missing, p_partkey % 17 <> 4 AS decoded, CAST(p_size * 240 % 12000 + 30 AS INTEGER) AS w,
  CAST(p_partkey * 7 % 1200 AS INTEGER) AS h, p_partkey % 100 AS blur, p_partkey % 40 AS stdev, p_partkey % 256 AS mean FROM part)"""
_SEEN = "NOT missing AND decoded"
_IMG = [("IMAGE_DEEP_CHECK_SKIPPED", "missing"), ("IMAGE_OPEN_FAILED", "NOT missing AND NOT decoded"),
        ("IMAGE_TOO_SMALL", f"{_SEEN} AND LEAST(w, h) < 50"), ("IMAGE_TOO_LARGE", f"{_SEEN} AND GREATEST(w, h) > 10000"),
        ("IMAGE_LOW_RESOLUTION", f"{_SEEN} AND GREATEST(w, h) < 1000"), ("IMAGE_BLURRY", f"{_SEEN} AND blur < 50"),
        ("IMAGE_LOW_CONTRAST", f"{_SEEN} AND stdev < 15")]


@query(f"WITH {IMG_SQL} " + verdict_sql("f", joined(*_IMG), total(*[c for _, c in _IMG[1:4]]), total(*[c for _, c in _IMG[4:]]), one("missing")))
def q_image(spark, sf_dir):
    key = F.col("p_partkey")
    image = F.struct(
        (key % 17 != 4).alias("decoded"), (F.col("p_size") * 240 % 12000 + 30).cast("int").alias("width"), (key * 7 % 1200).cast("int").alias("height"),
        F.lit("L").alias("image_mode"), (key % 256).cast("double").alias("mean"), (key % 40).cast("double").alias("stdev"), (key % 100).cast("double").alias("blur"))
    rows = S.table(spark, sf_dir, "part").select(
        key.alias("doc_id"), F.concat(key.cast("string"), F.lit(".png")).alias("file_name"), F.when(key % 13 != 5, image).alias("image"))
    return judge(bare(rows), "standard", LIMITS, ["image"]).select("doc_id", *verdict())


PIXEL_SQL = """px AS (SELECT vec_id, i - 1 AS i, (i - 1) // 8 AS y, (i - 1) % 8 AS x,
    GREATEST(0, LEAST(255, CAST(floor(CAST(embedding[i] AS DOUBLE) * 256) AS BIGINT) + 128)) AS g FROM embeddings, range(1, 65) r(i)),
ed AS (SELECT p.vec_id, p.g, CASE WHEN p.x IN (0, 7) OR p.y IN (0, 7) THEN p.g ELSE GREATEST(0, LEAST(255,
    LAG(g, 8) OVER w + LEAD(g, 8) OVER w + LAG(g, 1) OVER w + LEAD(g, 1) OVER w - 4 * g)) END AS e FROM px p WINDOW w AS (PARTITION BY vec_id ORDER BY i))"""


@query(f"""WITH {PIXEL_SQL} SELECT vec_id, CAST(SUM(g) AS DOUBLE) / 64 AS mean, ROUND(sqrt(CAST(64 * SUM(g * g) - SUM(g) * SUM(g) AS DOUBLE) / 4096), 9) AS stdev,
  CAST(64 * SUM(e * e) - SUM(e) * SUM(e) AS DOUBLE) / 4096 AS blur FROM ed GROUP BY vec_id""")
def image_pixel_stats(spark, sf_dir):
    """Each embedding seen as an 8 x 8 grey image."""
    level = lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(x.cast("double") * 256) + 128))
    text = F.array_join(F.transform("embedding", lambda x: F.lpad(F.hex(level(x)), 2, "0")), "")
    images = S.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("path"),
        F.struct(F.lit("").alias("origin"), F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"),
                 F.lit(0).alias("mode"), F.unhex(text).alias("data")).alias("image"))
    return image_features(images).select(F.col("path").cast("bigint").alias("vec_id"), "mean", F.round("stdev", 9).alias("stdev"), "blur")


# --- G19..G30, G36..G41: pages of one PDF per supplier ---------------------------------------

PAGES_SQL = """cnt AS (SELECT CAST(s_suppkey AS VARCHAR) AS path, s_suppkey AS k, CAST(s_suppkey * 13 % 350 AS INTEGER) AS page_count FROM supplier),
smp AS (SELECT DISTINCT path, k, page_count, page FROM (
  SELECT path, k, page_count, CASE WHEN page_count <= 100 THEN i ELSE CAST(floor(i * (CAST(page_count AS DOUBLE) / CAST(100 AS DOUBLE))) AS BIGINT) END AS page
  FROM cnt, range(0, 100) r(i) WHERE page_count > 0 AND (page_count > 100 OR i < page_count)) t),
met AS (SELECT *, CASE WHEN k % 5 = 0 THEN (k + page) % 4 WHEN (k * 31 + page * 17) % 11 = 0 THEN page % 60 ELSE (k * 31 + page * 17) % 700 END AS chars,
  CAST((k + page * 3) % 40 AS DOUBLE) AS stdev, CAST((k * 3 + page) % 256 AS DOUBLE) AS mean, CAST((k + page * 7) % 500 AS DOUBLE) AS blur,
  (k + page) % 7 - 3 AS skew, 1.0 + (page % 4) * 0.1 AS conf, CASE WHEN page % 3 > 0 THEN CAST(100 + (k + page) % 100 AS DOUBLE) END AS dpi FROM smp),
sts AS (SELECT path, COUNT(*) AS sampled_pages, CAST(SUM(chars) AS BIGINT) AS total_chars, CAST(SUM(chars) AS DOUBLE) / COUNT(*) AS avg_chars,
  CAST(SUM(CASE WHEN chars < 50 THEN 1 ELSE 0 END) AS BIGINT) AS low_text_pages, CAST(SUM(CASE WHEN chars < 5 THEN 1 ELSE 0 END) AS BIGINT) AS empty_pages FROM met GROUP BY path),
low AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY path ORDER BY page) - 1 AS rn, COUNT(*) OVER (PARTITION BY path) AS nlow FROM met WHERE chars < 50),
scn AS (SELECT DISTINCT low.* FROM low, range(0, 5) r(i) WHERE i < LEAST(nlow, 5) AND rn = CAST(floor(i * (CAST(nlow AS DOUBLE) / LEAST(nlow, 5))) AS BIGINT))"""


def page_counts(spark, sf_dir):
    return S.spread(S.table(spark, sf_dir, "supplier").select("s_suppkey"), 20_000).select(
        F.col("s_suppkey").cast("string").alias("path"), F.col("s_suppkey").alias("k"), (F.col("s_suppkey") * 13 % 350).cast("int").alias("page_count"))


def page_metrics(spark, sf_dir):
    k, page = F.col("k"), F.col("page")
    mix = k * 31 + page * 17
    d = lambda c: c.cast("double")
    return page_counts(spark, sf_dir).filter("page_count > 0").select(
        "path", "k", F.explode(F.sequence(F.lit(0), F.col("page_count") - 1)).alias("page")).select(
        "path", "page",
        F.when(k % 5 == 0, (k + page) % 4).when(mix % 11 == 0, page % 60).otherwise(mix % 700).cast("int").alias("chars"),
        d((k + page * 3) % 40).alias("stdev"), d((k * 3 + page) % 256).alias("mean"), d((k + page * 7) % 500).alias("blur_var"),
        ((k + page) % 7 - 3).cast("int").alias("skew"), (F.lit(1.0) + (page % 4) * F.lit(0.1)).alias("skew_conf"),
        F.when(page % 3 > 0, d(100 + (k + page) % 100)).alias("dpi"))


def text_stats(spark, sf_dir):
    sampled = P.sampled_pages(page_metrics(spark, sf_dir), page_counts(spark, sf_dir).select("path", "page_count"))
    return P.page_text_stats(sampled)


@query(f"WITH {PAGES_SQL} SELECT path, CAST(page AS INTEGER) AS page FROM smp")
def page_sample(spark, sf_dir):
    return P.page_sample(page_counts(spark, sf_dir))


@query(f"WITH {PAGES_SQL} SELECT *, CAST(low_text_pages AS DOUBLE) / sampled_pages AS low_ratio FROM sts")
def page_text_stats(spark, sf_dir):
    return text_stats(spark, sf_dir).drop("low_pages")


@query(f"WITH {PAGES_SQL} SELECT path, CAST(page AS INTEGER) AS page FROM scn")
def scan_page_sample(spark, sf_dir):
    return text_stats(spark, sf_dir).select("path", F.explode(P.scan_page_sample(F.col("low_pages"))).alias("p")).select("path", "p.page")


SCAN_SQL = """sc AS (SELECT path, CAST(COUNT(*) AS INTEGER) AS scan_pages, SUM(blur) / COUNT(*) AS scan_blur, SUM(stdev) / COUNT(*) AS scan_stdev, SUM(mean) / COUNT(*) AS scan_mean,
  SUM(dpi) / COUNT(dpi) AS scan_dpi, COALESCE(string_agg(CASE WHEN stdev >= 12 AND blur < 200 THEN CAST(page AS VARCHAR) END, ',' ORDER BY page), '') AS blurry,
  COALESCE(string_agg(CASE WHEN stdev < 12 THEN CAST(page AS VARCHAR) END, ',' ORDER BY page), '') AS low_contrast,
  COALESCE(string_agg(CASE WHEN stdev >= 12 AND abs(skew) >= 2 AND conf >= 1.15 THEN CAST(page AS VARCHAR) END, ',' ORDER BY page), '') AS skewed,
  COALESCE(string_agg(CASE WHEN dpi < 150 THEN CAST(page AS VARCHAR) END, ',' ORDER BY page), '') AS low_dpi FROM scn GROUP BY path)"""
LISTS = ["blurry", "low_contrast", "skewed", "low_dpi"]


@query(f"WITH {PAGES_SQL}, {SCAN_SQL} SELECT * FROM sc")
def scan_page_stats(spark, sf_dir):
    stats = P.scan_page_stats(text_stats(spark, sf_dir)).filter("scan_pages > 0")
    return stats.select("path", "scan_pages", "scan_blur", "scan_stdev", "scan_mean", "scan_dpi", *[
        F.array_join(F.transform(c, lambda p: p["page"].cast("string")), ",").alias(c) for c in LISTS])


_READ = "opened AND NOT enc AND page_count > 0"
_TXT = f"{_READ} AND avg_chars >= 5"
_PDF = [("PDF_DEEP_CHECK_SKIPPED", "skipped"), ("PDF_OPEN_FAILED", "NOT skipped AND NOT opened"), ("PDF_PASSWORD_PROTECTED", "opened AND enc"),
        ("PDF_NO_PAGES", "opened AND page_count = 0"), ("PDF_TOO_MANY_PAGES", "opened AND page_count > 300"),
        ("PDF_LIKELY_SCANNED", f"{_READ} AND avg_chars < 5"), ("PDF_LOW_TEXT_DENSITY", f"{_TXT} AND avg_chars < 200"),
        ("PDF_MANY_LOW_TEXT_PAGES", f"{_TXT} AND CAST(low_text_pages AS DOUBLE) / sampled_pages >= 0.3 AND low_text_pages > 1"),
        ("PDF_BLANK_PAGES", f"{_TXT} AND empty_pages > 0"), ("PDF_SCAN_BLURRY", f"{_READ} AND blurry <> ''"), ("PDF_SCAN_LOW_CONTRAST", f"{_READ} AND low_contrast <> ''"),
        ("PDF_SCAN_SKEWED", f"{_READ} AND skewed <> ''"), ("PDF_SCAN_LOW_DPI", f"{_READ} AND low_dpi <> ''")]
_pdf = dict(_PDF)
_PDF_WARN, _PDF_INFO = ["PDF_LIKELY_SCANNED", "PDF_LOW_TEXT_DENSITY"], ["PDF_DEEP_CHECK_SKIPPED", "PDF_BLANK_PAGES"]


@query(f"""WITH {PAGES_SQL}, {SCAN_SQL}, f AS (SELECT CAST(cnt.path AS BIGINT) AS doc_id, k % 19 = 3 AS skipped, k % 19 <> 3 AND k % 23 <> 2 AS opened, k % 29 = 4 AS enc,
  page_count, sampled_pages, avg_chars, low_text_pages, empty_pages, COALESCE(blurry, '') AS blurry, COALESCE(low_contrast, '') AS low_contrast,
  COALESCE(skewed, '') AS skewed, COALESCE(low_dpi, '') AS low_dpi FROM cnt LEFT JOIN sts USING (path) LEFT JOIN sc USING (path)) """
       + verdict_sql("f", joined(*_PDF), total(*[c for n, c in _PDF if n not in _PDF_WARN + _PDF_INFO]), total(*[_pdf[n] for n in _PDF_WARN]),
                     total(*[_pdf[n] for n in _PDF_INFO])))
def q_pdf_pages(spark, sf_dir):
    """The whole path of a PDF: file metrics, page sample, text and scan statistics, rules."""
    counts = page_counts(spark, sf_dir)
    name = F.concat(F.lit("u/a/"), "path", F.lit(".pdf"))
    files = counts.select(name.alias("path"), F.lit(True).alias("found"), F.lit(True).alias("is_file"), F.lit(1).alias("length"),
                          F.encode(F.lit("%PDF-"), "UTF-8").alias("head"))
    metrics = counts.filter("k % 19 <> 3").select(
        name.alias("path"), F.when(F.col("k") % 23 == 2, "damaged").alias("open_error"), (F.col("k") % 29 == 4).alias("encrypted"), "page_count",
        F.lit(None).cast("bigint").alias("character_count"), F.lit(None).cast("int").alias("sheet_count"), F.lit(None).cast("int").alias("slide_count"))
    page_rows = page_metrics(spark, sf_dir).withColumn("path", name)
    return Q.check_files(files, metrics, page_rows).select(
        F.regexp_extract("path", r"(\d+)", 1).cast("bigint").alias("doc_id"), *verdict())


# Ink per row of a page at each angle, from parts.
@query("""WITH r AS (SELECT p_partkey, a.a - 10 AS angle, (p_partkey * (a.a + 1) * 7 + w.w * w.w * 13 * (a.a % 5 + 1)) % 1000 AS ink FROM part, range(0, 21) a(a), range(0, 12) w(w)),
v AS (SELECT p_partkey, angle, CAST(CAST(COUNT(*) * SUM(ink * ink) - SUM(ink) * SUM(ink) AS BIGINT) AS DOUBLE) / (COUNT(*) * COUNT(*)) AS var FROM r GROUP BY 1, 2),
z AS (SELECT p_partkey, var AS zero FROM v WHERE angle = 0)
SELECT p_partkey, CAST(angle AS INTEGER) AS skew, var / GREATEST(zero, 1.0) AS skew_conf FROM v JOIN z USING (p_partkey)
QUALIFY ROW_NUMBER() OVER (PARTITION BY p_partkey ORDER BY var DESC, angle) = 1""")
def skew_argmax(spark, sf_dir):
    a, w, k = F.col("a"), F.col("row"), F.col("p_partkey")
    profiles = S.spread(S.table(spark, sf_dir, "part").select("p_partkey"), 20_000).select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("a")).select(
        "p_partkey", "a", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("row")).select(
        k.cast("string").alias("path"), F.lit(0).alias("page"), (a - 10).alias("angle"), "row",
        ((k * (a + 1) * 7 + w * w * 13 * (a % 5 + 1)) % 1000).alias("ink"))
    return P.estimate_skew(profiles).select(F.col("path").cast("bigint").alias("p_partkey"), "skew", "skew_conf")


@query("""WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey * 1000 + l_suppkey AS pos, l_quantity AS bw, 10.0 AS bh, l_partkey % 500 AS w, l_suppkey % 300 AS h FROM lineitem)
SELECT l_orderkey, l_linenumber AS page, LEAST(w / (bw / 72), h / (CAST(10 AS DOUBLE) / 72)) AS dpi FROM i WHERE w <> 0 AND h <> 0 AND bw > 0
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY bw * bh DESC, pos) = 1""")
def page_image_dpi(spark, sf_dir):
    images = S.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("path"), F.col("l_linenumber").alias("page"), (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("pos"),
        F.col("l_quantity").alias("x0"), F.lit(0.0).alias("x1"), F.lit(0.0).alias("y0"), F.lit(10.0).alias("y1"),
        (F.col("l_partkey") % 500).alias("width_px"), (F.col("l_suppkey") % 300).alias("height_px"))
    return P.page_dpi(images).withColumnRenamed("path", "l_orderkey")


# --- G31..G35 -------------------------------------------------------------------------------

_OFF = [("{n}_DEEP_CHECK_SKIPPED", "k = 0"), ("{n}_PASSWORD_PROTECTED", "k IN (1, 2) AND n <> 'PPTX'"), ("{n}_OPEN_FAILED", "k = 3 OR (k IN (1, 2) AND n = 'PPTX')"),
        ("OFFICE_TOO_MANY_CHARS", "k > 3 AND n = 'DOCX' AND n_chars > 5000")]


@query("""WITH f AS (SELECT doc_id, doc_id % 7 AS k, CASE doc_id % 3 WHEN 0 THEN 'DOCX' WHEN 1 THEN 'XLSX' ELSE 'PPTX' END AS n, n_chars FROM documents) """
       + verdict_sql("f", "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN replace('{code}', '{{n}}', n) END" for code, c in _OFF) + ")",
                     total(*[c for _, c in _OFF[1:]]), "0", one("k = 0")))
def q_office(spark, sf_dir):
    key = F.col("doc_id")
    errors = F.array(F.lit("file is Encrypted"), F.lit("bad PassWord"), F.lit("not a zip file"))
    metrics = F.struct(F.when(key % 7 <= 3, F.get(errors, (key % 7 - 1).cast("int"))).alias("open_error"), F.lit(False).alias("encrypted"), F.lit(0).alias("page_count"),
                       F.col("n_chars").alias("character_count"), F.lit(1).alias("sheet_count"), F.lit(1).alias("slide_count"), F.lit(False).alias("scan_skipped"))
    rows = S.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(key.cast("string"), pick(".docx", ".xlsx", ".pptx")).alias("file_name"), F.when(key % 7 != 0, metrics).alias("metrics"))
    return judge(bare(rows), "standard", SMALL, ["office"]).select("doc_id", *verdict())


# --- H1..H4 ---------------------------------------------------------------------------------

COUNTS = "SELECT doc_id, n_chars % 4 AS e, doc_id % 5 AS w, doc_id % 9 AS i FROM documents"


def severities(spark, sf_dir):
    return S.table(spark, sf_dir, "documents").select(
        "doc_id", (F.col("n_chars") % 4).alias("e"), (F.col("doc_id") % 5).alias("w"), (F.col("doc_id") % 9).alias("i"))


def scored(spark, sf_dir):
    return severities(spark, sf_dir).withColumn("score", scoring.score(F.col("e"), F.col("w"), F.col("i")))


@query(f"SELECT doc_id, CAST(GREATEST(0, LEAST(100, 100 - 30 * e - 10 * w - 2 * i)) AS INTEGER) AS score FROM ({COUNTS}) t")
def quality_score(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", "score")


@query(f"""SELECT doc_id, CASE WHEN s >= 90 THEN 'excellent' WHEN s >= 75 THEN 'good' WHEN s >= 50 THEN 'fair' WHEN s >= 25 THEN 'poor' ELSE 'unusable' END AS band
FROM (SELECT doc_id, GREATEST(0, LEAST(100, 100 - 30 * e - 10 * w - 2 * i)) AS s FROM ({COUNTS}) t) u""")
def quality_band(spark, sf_dir):
    return scored(spark, sf_dir).select("doc_id", scoring.band(F.col("score")).alias("band"))


@query(f"SELECT doc_id, CAST(e AS INTEGER) AS error_count, CAST(w AS INTEGER) AS warning_count, CAST(i AS INTEGER) AS info_count, e = 0 AS passed FROM ({COUNTS}) t")
def quality_counts(spark, sf_dir):
    issue = lambda severity, n: F.array_repeat(F.struct(F.lit(severity).alias("severity")), F.col(n).cast("int"))
    rows = severities(spark, sf_dir).withColumn("issues", F.concat(issue("INFO", "i"), issue("ERROR", "e"), issue("WARNING", "w")))
    count = lambda s: scoring.severity_count(F.col("issues"), s)
    return rows.select("doc_id", count("ERROR").alias("error_count"), count("WARNING").alias("warning_count"), count("INFO").alias("info_count"),
                       (count("ERROR") == 0).alias("passed"))


@query(f"WITH {S.CHK_SQL} SELECT check_id, passed AS gate, passed AND warning_count = 0 AS strict_gate FROM chk")
def quality_gate(spark, sf_dir):
    return S.checks(spark, sf_dir).select("check_id", G.gate_passed().alias("gate"), G.gate_passed(strict=True).alias("strict_gate"))


# --- H5..H12 --------------------------------------------------------------------------------

OUT_SQL = """oc AS (SELECT *, CASE WHEN check_id % 11 = 1 THEN NULL ELSE 'op/' || CAST(check_id AS VARCHAR) END AS loc, check_id % 11 = 2 AS failed_call, check_id % 11 <> 3 AS write_ok,
  CASE WHEN cu_status IN ('Failed', 'Timeout') THEN 'msg ' || CAST(check_id AS VARCHAR) WHEN check_id % 11 IN (2, 3) THEN 'broke' END AS msg, check_id % 13 <> 4 AS called,
  CASE WHEN cu_status = 'Skipped' THEN 'Succeeded' ELSE cu_status END AS st FROM chk),
rt AS (SELECT *, usecase || '/' || analyzer_name || '/' || file_name AS rel, CASE WHEN NOT passed THEN 'QualityCheckFailed' WHEN NOT called THEN NULL WHEN failed_call THEN 'CuError'
  WHEN st <> 'Succeeded' THEN 'CuNonSuccess' WHEN NOT write_ok THEN 'StorageError' END AS reason FROM oc),
rr AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN called THEN 'processed' ELSE 'pending' END AS disposition,
  CASE WHEN reason = 'StorageError' THEN 'the extraction succeeded but its result was not written: ' || COALESCE(msg, '') WHEN reason IN ('CuError', 'CuNonSuccess') THEN msg END AS given FROM rt)"""


def outcome_rows(spark, sf_dir):
    key, status = F.col("check_id"), F.col("cu_status")
    return S.checks(spark, sf_dir).filter(key % 13 != 4).select(
        "check_id", F.when(status == "Skipped", "Succeeded").otherwise(status).alias("status"),
        F.when(key % 11 != 1, F.concat(F.lit("op/"), key.cast("string"))).alias("operation_location"),
        F.when(status.isin("Failed", "Timeout"), F.concat(F.lit("msg "), key.cast("string"))).when((key % 11).isin(2, 3), "broke").alias("error_message"),
        (key % 11 != 3).alias("write_ok"), (key % 11 == 2).alias("failed_call"))


def routed(spark, sf_dir):
    return G.route_outcomes(S.checks(spark, sf_dir).drop("cu_status"), outcome_rows(spark, sf_dir))


@query(f"""WITH {S.CHK_SQL}, {OUT_SQL} SELECT check_id, reason, disposition, CASE WHEN disposition <> 'pending' THEN passed END AS submitted_to_cu,
  CASE WHEN reason = 'QualityCheckFailed' THEN 'Skipped' WHEN reason = 'CuError' THEN 'Failed' WHEN reason = 'CuNonSuccess' THEN st WHEN disposition <> 'pending' THEN 'Succeeded' END AS cu_status,
  CASE WHEN passed AND called AND NOT failed_call THEN loc END AS cu_operation_location,
  COALESCE(given, reason || ': quality score=' || CAST(score AS VARCHAR) || ' band=' || band) AS cu_error_message,
  CASE disposition WHEN 'rejected' THEN 'rejected/' || rel WHEN 'processed' THEN 'processed-raw/' || rel END AS routed_to_blob_path,
  CASE WHEN disposition = 'processed' THEN 'source/' || replace(rel, '.txt', '.json') END AS cu_result_blob_path FROM rr""")
def route_outcomes(spark, sf_dir):
    return routed(spark, sf_dir).select("check_id", "reason", "disposition", "submitted_to_cu", "cu_status", "cu_operation_location",
                                        "cu_error_message", "routed_to_blob_path", "cu_result_blob_path")


@query(f"""WITH {S.CHK_SQL}, {OUT_SQL} SELECT 'incoming/' || rel AS blob_path, usecase, analyzer_name, reason AS error_kind, COALESCE(given, 'Quality check failed: score=' || CAST(score AS VARCHAR)
  || ' band=' || band || ' errors=' || CAST(error_count AS VARCHAR) || ' warnings=' || CAST(warning_count AS VARCHAR)) AS error_message FROM rr WHERE disposition = 'rejected'""")
def rejection_errors(spark, sf_dir):
    return G.rejection_errors(routed(spark, sf_dir))


@query(f"WITH {S.CHK_SQL}, {OUT_SQL} SELECT replace(rel, '.txt', '.json') AS result_path, check_id, rel AS raw_path FROM rr WHERE disposition = 'processed'")
def result_links(spark, sf_dir):
    return G.result_links(routed(spark, sf_dir))


@query(f"""WITH {S.CHK_SQL}, {OUT_SQL} SELECT 'incoming/' || rel AS src_path, CASE disposition WHEN 'rejected' THEN 'rejected/' ELSE 'processed-raw/' END || rel AS dest_path,
  CASE disposition WHEN 'rejected' THEN 'rejected' ELSE 'processed-raw' END AS disposition,
  CASE WHEN disposition = 'rejected' THEN 'rejected/' || rel || '.report.json' END AS sidecar_path, CASE WHEN disposition = 'rejected' THEN reason END AS report_reason,
  CASE WHEN disposition = 'rejected' THEN CAST(score AS BIGINT) END AS report_score FROM rr WHERE disposition <> 'pending'""")
def routing_manifest(spark, sf_dir):
    checks = S.checks(spark, sf_dir).drop("cu_status").withColumn("issues", F.array().cast("array<struct<code:string,severity:string,message:string,details_json:string>>"))
    out = G.raw_manifest(G.route_outcomes(checks, outcome_rows(spark, sf_dir)))
    return out.withColumn("report_reason", F.get_json_object("sidecar_text", "$.reason")).withColumn(
        "report_score", F.get_json_object("sidecar_text", "$.report.score").cast("bigint")).drop("sidecar_text")


def failure_rows(spark, sf_dir, area):
    return S.table(spark, sf_dir, "pages").select(
        F.concat(F.lit(f"{area}/web/an/"), F.col("page_id").cast("string")).alias("blob_path"), F.lit("web").alias("usecase"), F.lit("an").alias("analyzer_name"),
        pick("ReadError", "QualityCheckError", "SqlError", by="page_id").alias("error_kind"), F.col("html").alias("error_message"))


QUARANTINE = """SELECT '{area}/web/an/' || CAST(page_id AS VARCHAR) AS blob_path, 'web' AS usecase, 'an' AS analyzer_name, k AS error_kind, LEFT(html, 4000) AS error_message,
  '{to}/web/an/' || CAST(page_id AS VARCHAR) AS dest_path, '{to}/web/an/' || CAST(page_id AS VARCHAR) || '.error.txt' AS sidecar_path, '[' || k || '] ' || html || chr(10) || chr(10) AS sidecar_text
FROM (SELECT *, CASE page_id % 3 WHEN 0 THEN 'ReadError' WHEN 1 THEN 'QualityCheckError' ELSE 'SqlError' END AS k FROM pages) p"""


def quarantined(spark, sf_dir, area):
    errors, manifest = G.quarantine_rows(failure_rows(spark, sf_dir, area), area)
    return errors.join(manifest.select(F.col("src_path").alias("blob_path"), "dest_path", "sidecar_path", "sidecar_text"), "blob_path")


@query(QUARANTINE.format(area="incoming", to="rejected"))
def quarantine_rows(spark, sf_dir):
    return quarantined(spark, sf_dir, "incoming")


@query(QUARANTINE.format(area="source", to="failed"))
def ingest_failures(spark, sf_dir):
    return quarantined(spark, sf_dir, "source")


@query("""SELECT COUNT(*) FILTER (event_id % 5 = 0) AS processed, COUNT(*) FILTER (event_id % 5 IN (1, 2)) AS failed, COUNT(*) FILTER (event_id % 5 = 3) AS skipped,
  COUNT(*) FILTER (event_id % 5 = 4) AS deferred FROM events""")
def batch_summary(spark, sf_dir):
    return G.batch_summary(S.table(spark, sf_dir, "events").select(pick("processed", "failed", "failed", "skipped", "deferred", by="event_id").alias("outcome")))


@query("""SELECT event_id AS check_id, CASE k WHEN 0 THEN 'Succeeded' WHEN 6 THEN 'Timeout' WHEN 7 THEN 'Timeout' ELSE 'Failed' END AS status,
  CASE k WHEN 0 THEN NULL WHEN 1 THEN 'bad ' || event_type WHEN 2 THEN 'status ' || event_type WHEN 3 THEN 'Cancelled' WHEN 4 THEN 'refused' WHEN 5 THEN 'no response'
    WHEN 6 THEN 'no final state within 540s (last status=Running)' ELSE 'no final state within 540s (last status=Unknown)' END AS error_message, k = 0 AS has_result
FROM (SELECT *, event_id % 8 AS k FROM events) t""")
def normalize_outcome(spark, sf_dir):
    kind = F.col("event_type")
    body = [F.lit('{"status":"SUCCEEDED"}'), F.concat(F.lit('{"status":"failed","error":{"message":"bad '), kind, F.lit('"}}')),
            F.concat(F.lit('{"status":"Canceled","statusMessage":"status '), kind, F.lit('"}')), F.lit('{"status":"Cancelled"}'),
            F.lit(None), F.lit(None), F.lit('{"status":"Running"}'), F.lit("{}")]
    responses = S.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("check_id"), F.lit("op").alias("operation_location"), F.element_at(F.array(*body), (F.col("event_id") % 8 + 1).cast("int")).alias("body"),
        F.when(F.col("event_id") % 8 == 4, "refused").alias("request_error"))
    return G.normalize_outcomes(responses).select("check_id", "status", "error_message", "has_result")
