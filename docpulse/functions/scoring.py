"""Score, band and severity counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docpulse import constants as C


def score(errors: Column, warnings: Column, infos: Column) -> Column:
    """100 minus the penalties, kept within 0..100."""
    points = (
        F.lit(100)
        - errors * C.PENALTY["ERROR"]
        - warnings * C.PENALTY["WARNING"]
        - infos * C.PENALTY["INFO"]
    )
    return F.greatest(F.lit(0), F.least(F.lit(100), points)).cast("int")


def band(points: Column) -> Column:
    """Name of the band a score falls in."""
    name = F.lit(C.LAST_BAND)
    for threshold, label in reversed(C.BANDS):
        name = F.when(points >= threshold, label).otherwise(name)
    return name


def severity_count(issues: Column, severity: str) -> Column:
    """How many issues of an issue array have a severity."""
    return F.size(F.filter(issues, lambda issue: issue["severity"] == severity))


def confidence_bucket(
    confidence: Column, low: float = C.LOW_CONFIDENCE, high: float = C.HIGH_CONFIDENCE
) -> Column:
    """unknown / high / medium / low."""
    return (
        F.when(confidence.isNull(), "unknown")
        .when(confidence >= as_confidence(high), "high")
        .when(confidence >= as_confidence(low), "medium")
        .otherwise("low")
    )


def as_confidence(value: float) -> Column:
    """A threshold in the type of the confidence column, so that filters reach the scan."""
    return F.lit(f"{value:.4f}").cast("decimal(5,4)")
