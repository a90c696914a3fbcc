"""Quality checks as stored rows: insert, and patch with what became of the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpulse import constants as C

OUTCOME_COLUMNS = [
    "cu_operation_location", "cu_status", "cu_error_message", "routed_to_blob_path",
    "cu_result_blob_path",
]


def check_rows(checked: DataFrame, checked_at, *more: Column) -> DataFrame:
    """Header rows of a run's checks, with ``more`` columns; a later check of the same file adds a row."""
    text = F.lit(None).cast("string")
    return checked.select(
        "check_id", "blob_path", "usecase", "analyzer_name", "file_name", "extension",
        "detected_kind", "file_size_bytes", "mode", "passed", "score", "band", "error_count",
        "warning_count", "info_count", "metadata_json",
        F.lit(False).alias("submitted_to_cu"),
        *[text.alias(c) for c in OUTCOME_COLUMNS],
        checked_at.alias("checked_at"),
        F.lit(None).cast("timestamp").alias("completed_at"),
        *more,
    )


def stored_issues() -> Column:
    """The issues of a check as they are stored, in one list; a file has at most one issue per rule."""
    return F.transform("issues", lambda i, pos: F.struct(
        F.xxhash64("check_id", pos).alias("issue_id"), i["code"].alias("code"), i["severity"].alias("severity"),
        F.left(i["message"], F.lit(C.ISSUE_MESSAGE_CHARS)).alias("message"), i["details_json"].alias("details_json")))


def issue_rows(checked: DataFrame, *more: str) -> DataFrame:
    """One row per issue of a check, message shortened to its stored width, with ``more`` columns of the check."""
    return checked.select("check_id", *more, F.posexplode("issues").alias("pos", "i")).select(
        F.xxhash64("check_id", "pos").alias("issue_id"),
        "check_id", "i.code", "i.severity",
        F.left(F.col("i.message"), F.lit(C.ISSUE_MESSAGE_CHARS)).alias("message"),
        "i.details_json", *more,
    )


def apply_outcomes(checks: DataFrame, patches: DataFrame, completed_at=None) -> DataFrame:
    """Patch checks by id: ``submitted_to_cu`` is overwritten, the other columns keep their value
    where the patch has none. Checks without a patch stay as they are. The time of completion is
    the patch's own, else ``completed_at``, else now."""
    if "completed_at" in patches.columns:
        now = F.col("completed_at")
    else:
        now = completed_at if completed_at is not None else F.current_timestamp()
    new = patches.select(
        "check_id", F.col("submitted_to_cu").alias("__submitted"), F.lit(True).alias("__hit"),
        now.alias("__now"),
        *[F.col(c).alias(f"__{c}") for c in OUTCOME_COLUMNS],
    )
    changed = {
        "submitted_to_cu": F.when(F.col("__hit"), F.col("__submitted")).otherwise(F.col("submitted_to_cu")),
        "completed_at": F.when(F.col("__hit"), F.col("__now")).otherwise(F.col("completed_at")),
        **{c: F.coalesce(f"__{c}", c) for c in OUTCOME_COLUMNS},
    }
    changed["cu_error_message"] = F.left(changed["cu_error_message"], F.lit(C.ERROR_MESSAGE_CHARS))
    return checks.join(new, "check_id", "left").select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in checks.columns]
    )
