"""Page operators of PDF files over page metrics, embedded images and row profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpulse.constants import LIMITS, Limits


def page_sample(counts: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Pages to look at (``path, page``): all of a short file, evenly spread ones of a long one."""
    n, cap = F.col("page_count"), limits.page_sample
    step = n / F.lit(float(cap))
    few = F.sequence(F.lit(0), n - 1)
    spread = F.array_distinct(
        F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), lambda i: F.floor(i * step).cast("int"))
    )
    return counts.filter(n > 0).select(
        "path",
        F.explode(F.when(n <= cap, few).otherwise(spread).cast("array<int>")).alias("page"),
    )


_SCAN = ["page", "stdev", "mean", "blur_var", "skew", "skew_conf", "dpi"]


def sampled_pages(metrics: DataFrame, counts: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Metrics of the sampled pages; the pair (path, page) is unique, so no key is hot.

    A page whose text could not be read has 0 characters. Metrics that come out of an explode look as small as
    what they were made of, so the planner would send all of them through the driver: the join is a merge join.
    """
    return page_sample(counts, limits).join(metrics.hint("merge"), ["path", "page"], "left").withColumn(
        "chars", F.coalesce("chars", F.lit(0))
    )


def page_text_stats(sampled: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Per file: text statistics of the sampled pages, and the low-text ones for the scan checks.

    The list is bounded by the page sample.
    """
    chars = F.col("chars")
    low = chars < limits.low_text_chars
    kept = [c for c in _SCAN if c in sampled.columns]
    return sampled.groupBy("path").agg(
        F.count(F.lit(1)).alias("sampled_pages"),
        F.sum("chars").alias("total_chars"),
        (F.sum("chars") / F.count(F.lit(1))).alias("avg_chars"),
        F.count_if(low).alias("low_text_pages"),
        F.count_if(chars < limits.empty_chars).alias("empty_pages"),
        (F.count_if(low) / F.count(F.lit(1))).alias("low_ratio"),
        F.sort_array(F.collect_list(F.when(low, F.struct(*kept)))).alias("low_pages"),
    )


def scan_page_sample(low_pages: Column, limits: Limits = LIMITS) -> Column:
    """At most five of the low-text pages, evenly spread."""
    size = F.size(low_pages)
    n = F.least(size, F.lit(limits.scan_sample))
    picked = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get(low_pages, F.floor(i * (size / n)).cast("int")),
    )
    return F.when(size > 0, picked).otherwise(F.slice(low_pages, 1, 0))


def _avg(pages: Column, name: str) -> Column:
    total = F.aggregate(pages, F.lit(0.0), lambda acc, p: acc + p[name])
    return F.try_divide(total, F.size(pages))


def scan_page_stats(stats: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Per file: averages over the analysed scan pages, and the pages with each defect.

    A page that could not be rendered has no metrics and leaves the average.
    """
    rendered = F.filter(
        scan_page_sample(F.col("low_pages"), limits), lambda p: p["stdev"].isNotNull()
    )
    s = stats.withColumn("scan", rendered)
    scan = F.col("scan")
    flat = lambda p: p["stdev"] < limits.scan_contrast
    dpis = F.filter(scan, lambda p: p["dpi"].isNotNull())
    return s.withColumns({
        "scan_pages": F.size(scan),
        "scan_blur": _avg(scan, "blur_var"),
        "scan_stdev": _avg(scan, "stdev"),
        "scan_mean": _avg(scan, "mean"),
        "scan_dpi": _avg(dpis, "dpi"),
        "blurry": F.filter(scan, lambda p: ~flat(p) & (p["blur_var"] < limits.scan_blur)),
        "low_contrast": F.filter(scan, flat),
        # Skew is only estimated on pages with enough contrast.
        "skewed": F.filter(
            scan,
            lambda p: ~flat(p) & (F.abs(p["skew"]) >= limits.scan_skew)
            & (p["skew_conf"] >= limits.scan_skew_confidence),
        ),
        "low_dpi": F.filter(dpis, lambda p: p["dpi"] < limits.scan_dpi),
    }).drop("scan", "low_pages")


def estimate_skew(profiles: DataFrame) -> DataFrame:
    """Skew per page from its ink per row at each angle: the angle with the greatest variance.

    The first greatest wins. Sums are exact decimals, so neither partitioning nor rounding can
    decide a tie; both aggregates combine map-side.
    """
    ink = F.col("ink").cast("decimal(18,0)")
    per_angle = profiles.groupBy("path", "page", "angle").agg(
        F.count(F.lit(1)).alias("n"), F.sum(ink).alias("s"), F.sum((ink * ink).cast("decimal(28,0)")).alias("q")
    )
    spread = F.col("n") * F.col("q").cast("decimal(28,0)") - (F.col("s") * F.col("s")).cast("decimal(38,0)")
    variance = per_angle.select(
        "path", "page", "angle", "n", spread.cast("decimal(38,0)").alias("spread"),
    ).withColumn("var", F.col("spread").cast("double") / (F.col("n") * F.col("n")))
    best = variance.groupBy("path", "page").agg(
        F.max(F.struct("var", (-F.col("angle")).alias("minus"))).alias("best"),
        F.max(F.when(F.col("angle") == 0, F.col("var"))).alias("zero"),
    )
    return best.select(
        "path", "page", (-F.col("best.minus")).cast("int").alias("skew"),
        (F.col("best.var") / F.greatest(F.coalesce("zero", F.lit(0.0)), F.lit(1.0))).alias("skew_conf"),
    )


def page_dpi(images: DataFrame) -> DataFrame:
    """Effective resolution per page: that of its largest image, the first one on ties."""
    width, height = F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0"))
    dpi = F.least(F.col("width_px") / (width / 72), F.col("height_px") / (height / 72))
    usable = images.filter(
        (F.col("width_px") != 0) & (F.col("height_px") != 0) & (width > 0) & (height > 0)
    )
    return usable.groupBy("path", "page").agg(
        F.max_by(dpi, F.struct((width * height).alias("area"), (-F.col("pos")).alias("minus"))).alias("dpi")
    )
