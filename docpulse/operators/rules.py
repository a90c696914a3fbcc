"""The rules table: one entry per finding, evaluated as columns in the order of reporting.

An entry is ``rule(code, severity, condition, message, details)``. ``RULE_GROUPS`` lists the
groups; a new rule is a new entry in the list its group returns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpulse import constants as C
from docpulse.constants import LIMITS, Limits
from docpulse.functions.paths import checked_extension, detect_kind, mime_of
from docpulse.functions.scoring import band, score, severity_count
from docpulse.functions.text import (
    grouped_text, json_list, json_object, json_text, tenth_text, whole_text,
)
from docpulse.operators.decode import page_equivalent

ISSUE = "struct<code:string, severity:string, message:string, details_json:string>"


def rule(code, severity: str, condition: Column, message, details: list | None = None) -> Column:
    """An issue struct where the condition holds, NULL elsewhere."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.when(condition, F.struct(
        as_column(code).alias("code"), F.lit(severity).alias("severity"),
        as_column(message).alias("message"),
        (json_object(details) if details else F.lit(None)).cast("string").alias("details_json"),
    ))


def collect(rules: list[Column]) -> Column:
    """Array of the issues that fired, in order."""
    return F.array_compact(F.array(*rules)).cast(f"array<{ISSUE}>")


def _say(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def _int(x: Column) -> Column:
    return x.cast("string")


_one = tenth_text


def with_kind(files: DataFrame) -> DataFrame:
    """Add ``extension``, ``detected_kind`` and ``live``: files the content rules look at.

    A missing, empty or odd file is not looked at further, its extension stays empty.
    """
    seen = F.col("is_file") & (F.coalesce("length", F.lit(0)) > 0)
    ext = F.when(seen, checked_extension(F.col("file_name"))).otherwise("")
    kind = detect_kind(F.col("extension"))
    return files.withColumn("extension", ext).withColumn("detected_kind", kind).withColumn(
        "live", F.col("detected_kind") != "unknown"
    )


def size_rules(mode: str = "standard", limits: Limits = LIMITS) -> list[Column]:
    """Presence, size and extension."""
    ext, kind, size, live = F.col("extension"), F.col("detected_kind"), F.col("length"), F.col("live")
    pro = mode == "pro"
    limit = (
        F.when(kind == "text", limits.max_bytes_text)
        .when(kind == "office", limits.max_bytes_office)
        .when(kind == "image", limits.max_bytes_pro if pro else limits.max_bytes_image)
        .otherwise(limits.max_bytes_pro if pro else limits.max_bytes_pdf)
    )
    supported = ", ".join(sorted(e for es in C.KIND_EXTENSIONS.values() for e in es))
    # Megabytes exactly: a division by a power of two has a finite decimal text.
    mb = F.bround(size.cast("decimal(15,0)") * F.lit("0.00000095367431640625").cast("decimal(20,20)"), 2)
    return [
        rule("FILE_NOT_FOUND", "ERROR", ~F.col("found"), _say("no such file: ", F.col("path"))),
        rule("NOT_A_FILE", "ERROR", F.col("found") & ~F.col("is_file"), _say("not a regular file: ", F.col("path"))),
        rule("STAT_FAILED", "ERROR", F.col("is_file") & size.isNull(), "the size of the file is unknown"),
        rule("FILE_EMPTY", "ERROR", F.col("is_file") & (size == 0), "the file has zero bytes"),
        rule("UNSUPPORTED_EXTENSION", "ERROR", F.col("is_file") & (size > 0) & ~live,
             _say("extension '", ext, f"' is not one of {supported}")),
        rule("PRO_MODE_UNSUPPORTED_EXTENSION", "ERROR", live & F.lit(pro) & ~ext.isin(C.PRO_EXTENSIONS),
             _say("pro mode takes PDF and image files only, not '", ext, "'")),
        rule("FILE_TOO_LARGE", "ERROR", live & (size > limit),
             _say("the file has ", _int(mb), " MB; ", kind, f" files in {mode} mode may have ", whole_text(limit / C.MB), " MB"),
             [("size_bytes", size), ("limit_bytes", limit)]),
    ]


def largest(limits: Limits) -> int:
    """Size beyond which a file of any kind is too large; its bytes are not read."""
    return max(limits.max_bytes_pdf, limits.max_bytes_image, limits.max_bytes_office, limits.max_bytes_text, limits.max_bytes_pro)


def magic_rules(limits: Limits = LIMITS) -> list[Column]:
    """First bytes against the extension; extensions without a signature are not tested."""
    ext, head, live = F.col("extension"), F.col("head"), F.col("live")
    fits = F.lit(None).cast("boolean")
    for extension, signatures in C.SIGNATURES.items():
        hit = F.lit(False)
        for signature in signatures:
            hit = hit | F.startswith(head, F.lit(signature))
        fits = F.when(ext == extension, hit).otherwise(fits)
    brand = F.lit(False)
    for name in C.HEIF_BRANDS:
        brand = brand | F.contains(head, F.lit(name).cast("binary"))
    fits = F.when(ext.isin(C.HEIF_EXTENSIONS), brand).otherwise(fits)
    tested = ext.isin([*C.SIGNATURES, *C.HEIF_EXTENSIONS]) | (F.col("detected_kind") == "text")
    return [
        rule("READ_FAILED", "ERROR", live & tested & head.isNull() & (F.col("length") <= largest(limits)), "the file could not be read"),
        rule("MAGIC_MISMATCH", "WARNING", live & head.isNotNull() & ~fits,
             _say("the first bytes do not belong to a ", ext, " file; it may be renamed or damaged"),
             [("first_bytes", json_text(F.lower(F.hex(F.substring(head, 1, 8)))))]),
    ]


def text_rules(limits: Limits = LIMITS) -> list[Column]:
    """Length of the decoded text. Every text decodes in the last encoding tried, so a finding
    for undecodable text cannot occur."""
    chars = F.col("chars")
    live = F.col("live") & (F.col("detected_kind") == "text")
    return [
        rule("TEXT_TOO_MANY_CHARS", "ERROR", live & (chars > limits.max_chars_text),
             _say("the text has ", grouped_text(chars), f" characters; the limit is {limits.max_chars_text:,}")),
        rule("TEXT_EMPTY", "ERROR", live & (chars == 0), "the text is empty once decoded"),
    ]


def image_rules(limits: Limits = LIMITS) -> list[Column]:
    """Dimensions, sharpness and contrast."""
    i = lambda name: F.col(f"image.{name}")
    live = F.col("live") & (F.col("detected_kind") == "image")
    heif = F.col("extension").isin(C.HEIF_EXTENSIONS)
    decoded = F.coalesce(i("decoded"), F.lit(False))
    seen = live & decoded
    w, h, blur, stdev, mean = i("width"), i("height"), i("blur"), i("stdev"), i("mean")
    size = [("width", w), ("height", h)]
    pixels = _say("the image has ", _int(w), "x", _int(h), " pixels; ")
    why = (
        F.when(mean > limits.white_mean, "almost all white, perhaps a blank page")
        .when(mean < limits.black_mean, "almost all black")
        .otherwise("hardly any variation")
    )
    return [
        rule("IMAGE_DEEP_CHECK_SKIPPED", "INFO", live & (F.col("image").isNull() | (heif & ~decoded)),
             "no decoder for this image; resolution and damage were not checked"),
        rule("IMAGE_OPEN_FAILED", "ERROR", live & F.col("image").isNotNull() & ~decoded & ~heif,
             "the image could not be decoded, it is likely damaged"),
        rule("IMAGE_TOO_SMALL", "ERROR", seen & (F.least(w, h) < limits.image_min_side),
             _say(pixels, f"each side needs {limits.image_min_side}"), size),
        rule("IMAGE_TOO_LARGE", "ERROR", seen & (F.greatest(w, h) > limits.image_max_side),
             _say(pixels, f"a side may have {limits.image_max_side}"), size),
        rule("IMAGE_LOW_RESOLUTION", "WARNING", seen & (F.greatest(w, h) < limits.image_low_resolution),
             f"the long edge has fewer than {limits.image_low_resolution} pixels, too few for text recognition"),
        rule("IMAGE_BLURRY", "WARNING", seen & (blur < limits.image_blur),
             _say("the image looks blurry (Laplacian variance ", tenth_text(blur), f", threshold {limits.image_blur})"),
             [("blur_variance", _one(blur)), ("threshold", F.lit(str(limits.image_blur)))]),
        rule("IMAGE_LOW_CONTRAST", "WARNING", seen & (stdev < limits.image_contrast),
             _say("low contrast: ", why, " (stdev ", tenth_text(stdev), ")"),
             [("mean_intensity", _one(mean)), ("stdev_intensity", _one(stdev))]),
    ]


def _pages(pages: Column, each) -> Column:
    return json_list(F.transform(pages, each))


def _page_numbers(pages: Column) -> Column:
    return _pages(pages, lambda p: (p["page"] + 1).cast("string"))


def pdf_rules(mode: str = "standard", limits: Limits = LIMITS) -> list[Column]:
    """Opening, page count, text density and scan quality."""
    m, p = (lambda n: F.col(f"metrics.{n}")), (lambda n: F.col(f"pages.{n}"))
    live = F.col("live") & (F.col("detected_kind") == "pdf")
    known = live & F.col("metrics").isNotNull()
    opened = known & m("open_error").isNull()
    encrypted = F.coalesce(m("encrypted"), F.lit(False))
    count = m("page_count")
    limit = limits.max_pages_pro if mode == "pro" else limits.max_pages
    read = opened & ~encrypted & (count > 0)
    avg, low, empty, sampled = p("avg_chars"), p("low_text_pages"), p("empty_pages"), p("sampled_pages")
    textual = read & (avg >= limits.empty_chars)
    scanned = read & (p("scan_pages") > 0)
    n = _int(p("scan_pages"))
    of = lambda pages: _say(_int(F.size(pages)), " of ", n, " scanned pages ")
    mean = p("scan_mean")
    why = (
        F.when(mean > limits.white_mean, "nearly white")
        .when(mean < limits.black_mean, "nearly black")
        .otherwise("hardly any variation")
    )
    least_dpi = F.array_min(F.transform(p("low_dpi"), lambda x: x["dpi"]))
    most_skew = F.array_max(F.transform(p("skewed"), lambda x: F.abs(x["skew"])))
    return [
        rule("PDF_DEEP_CHECK_SKIPPED", "INFO", live & F.col("metrics").isNull(),
             "no page metrics; page count, encryption and text were not checked"),
        rule("PDF_OPEN_FAILED", "ERROR", known & m("open_error").isNotNull(),
             _say("the PDF could not be opened, it is likely damaged: ", m("open_error"))),
        rule("PDF_PASSWORD_PROTECTED", "ERROR", opened & encrypted, "the PDF is protected by a password"),
        rule("PDF_NO_PAGES", "ERROR", opened & (count == 0), "the PDF has no pages"),
        rule("PDF_TOO_MANY_PAGES", "ERROR", opened & (count > limit),
             _say("the PDF has ", _int(count), f" pages; the limit is {limit}"),
             [("page_count", count), ("limit", F.lit(limit))]),
        rule("PDF_LIKELY_SCANNED", "WARNING", read & (avg < limits.empty_chars),
             "almost no text on any sampled page; the PDF looks like a scan",
             [("avg_chars_per_page", _one(avg))]),
        rule("PDF_LOW_TEXT_DENSITY", "WARNING", textual & (avg < limits.min_avg_chars),
             _say("on average ", whole_text(avg), f" characters per page, fewer than {limits.min_avg_chars}"),
             [("avg_chars_per_page", _one(avg)), ("threshold", F.lit(limits.min_avg_chars))]),
        rule("PDF_MANY_LOW_TEXT_PAGES", "ERROR", textual & (p("low_ratio") >= limits.low_text_ratio) & (low > 1),
             _say(_int(low), " of ", _int(sampled), " sampled pages (", whole_text(p("low_ratio") * 100),
                  f"%) have fewer than {limits.low_text_chars} characters"),
             [("low_text_pages", low), ("sampled_pages", sampled), ("char_threshold", F.lit(limits.low_text_chars))]),
        rule("PDF_BLANK_PAGES", "INFO", textual & (empty > 0),
             _say(_int(empty), " of ", _int(sampled), " sampled pages look blank"),
             [("empty_pages", empty), ("sampled_pages", sampled)]),
        rule("PDF_SCAN_CHECK_SKIPPED", "INFO", read & (low > 0) & F.coalesce(m("scan_skipped"), F.lit(False)),
             "pages could not be rendered; scan quality was not checked"),
        rule("PDF_SCAN_BLURRY", "ERROR", scanned & (F.size(p("blurry")) > 0),
             _say(of(p("blurry")), "look blurry (average Laplacian variance ", tenth_text(p("scan_blur")),
                  f", threshold {limits.scan_blur})"),
             [("blurry_pages", _page_numbers(p("blurry"))), ("pages_analyzed", n),
              ("avg_blur_variance", _one(p("scan_blur"))), ("threshold", F.lit(str(limits.scan_blur)))]),
        rule("PDF_SCAN_LOW_CONTRAST", "ERROR", scanned & (F.size(p("low_contrast")) > 0),
             _say(of(p("low_contrast")), "have low contrast: ", why, " (average stdev ", tenth_text(p("scan_stdev")),
                  f", threshold {limits.scan_contrast})"),
             [("low_contrast_pages", _page_numbers(p("low_contrast"))), ("pages_analyzed", n),
              ("avg_stdev", _one(p("scan_stdev"))), ("avg_mean_intensity", _one(mean))]),
        rule("PDF_SCAN_SKEWED", "ERROR", scanned & (F.size(p("skewed")) > 0),
             _say(of(p("skewed")), f"are tilted by {limits.scan_skew} degrees or more (at most ", _int(most_skew), ")"),
             [("skewed_pages", _pages(p("skewed"), lambda x: json_object(
                 [("page", x["page"] + 1), ("angle_deg", x["skew"])]))),
              ("pages_analyzed", n), ("threshold_deg", F.lit(str(limits.scan_skew)))]),
        rule("PDF_SCAN_LOW_DPI", "ERROR", scanned & (F.size(p("low_dpi")) > 0),
             _say(of(p("low_dpi")), f"hold images below {limits.scan_dpi:.0f} DPI (least ", whole_text(least_dpi), ")"),
             [("low_dpi_pages", _pages(p("low_dpi"), lambda x: json_object(
                 [("page", x["page"] + 1), ("dpi", _one(x["dpi"]))]))),
              ("pages_analyzed", n), ("threshold_dpi", F.lit(str(limits.scan_dpi))), ("min_dpi", _one(least_dpi))]),
    ]


def office_rules(limits: Limits = LIMITS) -> list[Column]:
    """Opening of office files, and the length of documents."""
    m = lambda n: F.col(f"metrics.{n}")
    ext = F.col("extension")
    live = F.col("live") & (F.col("detected_kind") == "office")
    known = live & F.col("metrics").isNotNull()
    name = F.upper(F.substring(ext, 2, 4))
    error = m("open_error")
    locked = F.lower(error).rlike("encrypted|password") & (ext != ".pptx")
    chars = m("character_count")
    return [
        rule(_say(name, "_DEEP_CHECK_SKIPPED"), "INFO", live & F.col("metrics").isNull(),
             _say("no file metrics; the content of the ", name, " file was not checked")),
        rule(_say(name, "_PASSWORD_PROTECTED"), "ERROR", known & locked,
             _say("the ", name, " file is protected by a password")),
        rule(_say(name, "_OPEN_FAILED"), "ERROR", known & error.isNotNull() & ~locked,
             _say("the ", name, " file could not be opened, it is likely damaged: ", error)),
        rule("OFFICE_TOO_MANY_CHARS", "ERROR",
             known & error.isNull() & (ext == ".docx") & (chars > limits.max_chars_office),
             _say("the document has ", grouped_text(chars), f" characters; the limit is {limits.max_chars_office:,}"),
             [("character_count", chars), ("limit", F.lit(limits.max_chars_office))]),
    ]


def metadata_json(limits: Limits = LIMITS) -> Column:
    """What is known of a file as JSON, NULL when nothing is."""
    m, p, i = (lambda n: F.col(f"metrics.{n}")), (lambda n: F.col(f"pages.{n}")), (lambda n: F.col(f"image.{n}"))
    kind, ext, live = F.col("detected_kind"), F.col("extension"), F.col("live")
    of = lambda cond, value: F.when(cond, value.cast("string"))
    opened = live & m("open_error").isNull()
    pdf, image, text = opened & (kind == "pdf"), live & (kind == "image"), live & (kind == "text")
    read = pdf & ~F.coalesce(m("encrypted"), F.lit(False))
    scan = read & (p("scan_pages") > 0)
    docx, xlsx, pptx = (opened & (ext == e) for e in (".docx", ".xlsx", ".pptx"))
    low_dpi = F.array_min(F.transform(p("low_dpi"), lambda x: x["dpi"]))
    skew = F.array_max(F.transform(p("skewed"), lambda x: F.abs(x["skew"])))
    pages = (
        F.when(docx, page_equivalent(m("character_count"), limits.chars_per_page))
        .when(xlsx, m("sheet_count")).when(pptx, m("slide_count"))
        .when(text, page_equivalent(F.col("chars"), limits.chars_per_page, 1))
    )
    mime = mime_of(ext)
    return json_object([
        ("mime_type", F.when((ext != "") & mime.isNotNull(), json_text(mime))),
        ("page_count", of(pdf, m("page_count"))),
        ("sampled_pages", of(read, p("sampled_pages"))),
        ("total_chars_sampled", of(read, p("total_chars"))),
        ("avg_chars_per_page", of(read, _one(p("avg_chars")))),
        ("low_text_pages", of(read, p("low_text_pages"))),
        ("empty_pages", of(read, p("empty_pages"))),
        ("scan_pages_analyzed", of(scan, p("scan_pages"))),
        ("scan_avg_blur_variance", of(scan, _one(p("scan_blur")))),
        ("scan_avg_stdev", of(scan, _one(p("scan_stdev")))),
        ("scan_avg_mean_intensity", of(scan, _one(p("scan_mean")))),
        ("scan_max_skew_deg", of(scan, skew)),
        ("scan_min_image_dpi", of(scan, _one(low_dpi))),
        ("scan_avg_image_dpi", of(scan & (F.size(p("low_dpi")) > 0), _one(p("scan_dpi")))),
        ("width", of(image, i("width"))),
        ("height", of(image, i("height"))),
        ("mode", F.when(image & i("width").isNotNull(), json_text(i("image_mode")))),
        ("mean_intensity", of(image, _one(i("mean")))),
        ("stdev_intensity", of(image, _one(i("stdev")))),
        ("blur_variance", of(image, _one(i("blur")))),
        ("sheet_count", of(xlsx, m("sheet_count"))),
        ("slide_count", of(pptx, m("slide_count"))),
        ("encoding", F.when(text & F.col("encoding").isNotNull(), json_text(F.col("encoding")))),
        ("character_count", of(docx, m("character_count"))),
        ("character_count", of(text, F.col("chars"))),
        ("page_equivalent", pages.cast("string")),
    ])


RULE_GROUPS = {
    "size": lambda mode, limits: size_rules(mode, limits),
    "magic": lambda mode, limits: magic_rules(limits),
    "pdf": pdf_rules,
    "image": lambda mode, limits: image_rules(limits),
    "office": lambda mode, limits: office_rules(limits),
    "text": lambda mode, limits: text_rules(limits),
}


def judge(files: DataFrame, mode: str = "standard", limits: Limits = LIMITS, groups=None) -> DataFrame:
    """Add issues, counts, score, band, verdict and metadata to files with their features.

    With only some rule groups asked for, the metadata is left out.
    """
    if mode not in ("standard", "pro"):
        raise ValueError(f"mode must be 'standard' or 'pro', not {mode!r}")
    rules = [r for name in (groups or RULE_GROUPS) for r in RULE_GROUPS[name](mode, limits)]
    judged = files.withColumn("mode", F.lit(mode)).withColumn("issues", collect(rules))
    if groups is None:
        judged = judged.withColumn("metadata_json", metadata_json(limits))
    issues = F.col("issues")
    return with_verdict(judged.withColumns({
        "error_count": severity_count(issues, "ERROR"),
        "warning_count": severity_count(issues, "WARNING"),
        "info_count": severity_count(issues, "INFO"),
    }))


def with_verdict(rows: DataFrame) -> DataFrame:
    """Add score, band and ``passed`` to rows with severity counts."""
    points = score(*[F.col(f"{s}_count") for s in ("error", "warning", "info")])
    return rows.withColumns({
        "score": points, "band": band(points), "passed": F.col("error_count") == 0,
    })
