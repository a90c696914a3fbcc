"""Gate and routing: which checked files go on, what became of them, where they go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpulse import constants as C
from docpulse.functions.paths import result_path
from docpulse.functions.text import json_list, json_object, json_text


def gate_passed(strict: bool = False) -> Column:
    """Passed, and in strict mode without warnings. The stored ``passed`` ignores strict mode."""
    passed = F.col("passed")
    return passed & (F.col("warning_count") == 0) if strict else passed


def normalize_outcomes(responses: DataFrame, cap_seconds: int = 540) -> DataFrame:
    """Final state of the extraction calls from the service's last answer.

    Input ``check_id, operation_location, body`` (JSON text, NULL when a request failed) and
    ``request_error``. Adds ``status``, ``error_message`` and ``has_result``.
    """
    given = F.expr("nullif(variant_get(b, '$.status', 'string'), '')")
    state = F.coalesce(given, F.lit("Unknown"))
    reason = F.coalesce(
        F.expr("nullif(variant_get(b, '$.error.message', 'string'), '')"),
        F.expr("nullif(variant_get(b, '$.statusMessage', 'string'), '')"),
        state,
    )
    lower = F.lower(state)
    failed = lower.isin("failed", "canceled", "cancelled")
    message = (
        F.when(F.col("b").isNull(), F.coalesce("request_error", F.lit("no response")))
        .when(lower == "succeeded", None)
        .when(failed, reason)
        .otherwise(F.concat(F.lit(f"no final state within {cap_seconds}s (last status="), state, F.lit(")")))
    )
    parsed = responses.withColumn("b", F.expr("try_parse_json(body)"))
    return parsed.select(
        "*",
        F.when(F.col("b").isNull() | failed, "Failed")
        .when(lower == "succeeded", "Succeeded")
        .otherwise("Timeout").alias("status"),
        F.left(message, F.lit(C.OUTCOME_MESSAGE_CHARS)).alias("error_message"),
        (F.col("b").isNotNull() & (lower == "succeeded")).alias("has_result"),
    ).drop("b")


def route_outcomes(checks: DataFrame, outcomes: DataFrame, strict: bool = False) -> DataFrame:
    """What became of each checked file.

    ``outcomes``: ``check_id, status, operation_location, error_message, write_ok, failed_call``;
    a file that passed the gate and has no outcome yet is ``pending``. Adds ``reason`` (NULL when
    accepted), ``disposition`` and the columns a check is patched with.
    """
    o = outcomes.select(
        "check_id", "status", "operation_location", "error_message",
        F.coalesce("write_ok", F.lit(True)).alias("write_ok"),
        F.coalesce("failed_call", F.lit(False)).alias("failed_call"),
        F.lit(True).alias("called"),
    )
    joined = checks.withColumn("gate_passed", gate_passed(strict)).join(o, "check_id", "left")
    gate, called = F.col("gate_passed"), F.coalesce("called", F.lit(False))
    status = F.col("status")
    reason = (
        F.when(~gate, "QualityCheckFailed")
        .when(~called, None)
        .when(F.col("failed_call"), "CuError")
        .when(status.isNull() | (status != "Succeeded"), "CuNonSuccess")
        .when(~F.col("write_ok"), "StorageError")
    )
    out = joined.withColumn("reason", reason).withColumn(
        "disposition",
        F.when(F.col("reason").isNotNull(), "rejected").when(called, "processed").otherwise("pending"),
    )
    reason = F.col("reason")
    relative = F.concat_ws("/", "usecase", "analyzer_name", "file_name")
    given = F.when(reason == "StorageError", F.concat(
        F.lit("the extraction succeeded but its result was not written: "), F.coalesce("error_message", F.lit("")),
    )).when(reason.isin("CuError", "CuNonSuccess"), F.col("error_message"))
    default = F.concat(reason, F.format_string(": quality score=%d band=%s", "score", "band"))
    settled = F.col("disposition") != "pending"
    return out.select(
        *checks.drop(*_PATCHED).columns, "gate_passed", "reason", "disposition", relative.alias("relative"),
        F.when(settled, gate).alias("submitted_to_cu"),
        F.when(reason == "QualityCheckFailed", "Skipped").when(reason == "CuError", "Failed")
        .when(reason == "CuNonSuccess", F.coalesce("status", F.lit("Failed")))
        .when(settled, "Succeeded").alias("cu_status"),
        F.when(gate & ~F.coalesce("failed_call", F.lit(False)), F.col("operation_location")).alias("cu_operation_location"),
        F.nullif(given, F.lit("")).alias("given_message"),
        F.coalesce(F.nullif(given, F.lit("")), default).alias("cu_error_message"),
        F.when(reason.isNotNull(), F.concat_ws("/", F.lit(C.REJECTED), relative))
        .when(settled, F.concat_ws("/", F.lit(C.PROCESSED_RAW), relative)).alias("routed_to_blob_path"),
        F.when(settled & reason.isNull(), F.concat_ws(
            "/", F.lit(C.SOURCE), result_path(F.col("usecase"), F.col("analyzer_name"), F.col("file_name"))
        )).alias("cu_result_blob_path"),
    )


_PATCHED = [
    "submitted_to_cu", "cu_status", "cu_operation_location", "cu_error_message",
    "routed_to_blob_path", "cu_result_blob_path",
]


def outcome_patches(routed: DataFrame) -> DataFrame:
    """The patch of every settled check."""
    return routed.filter("disposition <> 'pending'").select("check_id", *_PATCHED)


def result_links(routed: DataFrame) -> DataFrame:
    """Result path and check id of every accepted file: the stamp used by the back-link."""
    accepted = routed.filter("disposition = 'processed'")
    return accepted.select(
        result_path(F.col("usecase"), F.col("analyzer_name"), F.col("file_name")).alias("result_path"),
        "check_id", F.col("relative").alias("raw_path"),
    )


def stem_collisions(links: DataFrame) -> DataFrame:
    """Result paths that more than one raw file writes; the last one wins."""
    return links.groupBy("result_path").agg(F.count(F.lit(1)).alias("files")).filter("files > 1")


def rejection_errors(routed: DataFrame) -> DataFrame:
    """An error row for every rejected file, of the kind of its reason."""
    text = F.format_string(
        "Quality check failed: score=%d band=%s errors=%d warnings=%d",
        "score", "band", "error_count", "warning_count",
    )
    return routed.filter("disposition = 'rejected'").select(
        F.concat_ws("/", F.lit(C.INCOMING), "relative").alias("blob_path"), "usecase", "analyzer_name",
        F.col("reason").alias("error_kind"),
        F.left(F.coalesce("given_message", text), F.lit(C.ERROR_MESSAGE_CHARS)).alias("error_message"),
    )


def routing_manifest(rows: DataFrame, area: str, disposition: Column) -> DataFrame:
    """Where files go: ``src_path, dest_path, disposition`` plus an optional sidecar file.

    Moving the bytes is left to the storage; ``rows`` has ``relative`` and may have
    ``sidecar_suffix`` and ``sidecar_text``.
    """
    out = rows.withColumn("disposition", disposition)
    sidecar = [F.lit(None).cast("string").alias(c) for c in ("sidecar_path", "sidecar_text")]
    if "sidecar_text" in rows.columns:
        sidecar = [
            F.when(F.col("sidecar_text").isNotNull(), F.concat(
                "disposition", F.lit("/"), "relative", F.col("sidecar_suffix"))).alias("sidecar_path"),
            F.col("sidecar_text"),
        ]
    return out.select(
        F.concat_ws("/", F.lit(area), "relative").alias("src_path"),
        F.concat_ws("/", "disposition", "relative").alias("dest_path"),
        "disposition", *sidecar,
    )


def error_sidecar(kind: Column, message: Column) -> Column:
    """Text of the ``.error.txt`` next to a failed file: kind, message and details."""
    return F.concat(F.lit("["), kind, F.lit("] "), message, F.lit("\n\n"))


def report_json(issues: Column) -> Column:
    """The ``.report.json`` next to a rejected file."""
    issue_texts = F.transform(issues, lambda i: json_object([
        ("code", json_text(i["code"])), ("severity", json_text(i["severity"])),
        ("message", json_text(i["message"])),
        ("details", F.coalesce(i["details_json"], F.lit("{}"))),
    ], full=True))
    flag = lambda c: F.col(c).cast("string")
    report = json_object([
        ("file_path", json_text(F.col("file_name"))), ("file_size_bytes", flag("file_size_bytes")),
        ("extension", json_text(F.col("extension"))), ("detected_kind", json_text(F.col("detected_kind"))),
        ("mode", json_text(F.col("mode"))), ("passed", flag("passed")), ("issues", json_list(issue_texts)),
        ("metadata", F.coalesce("metadata_json", F.lit("{}"))), ("score", flag("score")),
        ("band", json_text(F.col("band"))), ("error_count", flag("error_count")),
        ("warning_count", flag("warning_count")), ("info_count", flag("info_count")),
    ], full=True)
    called = F.col("reason") != "QualityCheckFailed"
    return json_object([
        ("reason", json_text(F.col("reason"))),
        ("cu_status", json_text(F.when(called, F.col("cu_status")))),
        ("cu_error_message", json_text(F.when(called, F.col("given_message")))),
        ("report", report),
    ], full=True)


def raw_manifest(routed: DataFrame) -> DataFrame:
    """Routing manifest of settled raw files; rejected ones get a report next to them."""
    settled = routed.filter("disposition <> 'pending'")
    rejected = F.col("reason").isNotNull()
    if "issues" in settled.columns:
        settled = settled.withColumns({
            "sidecar_suffix": F.lit(".report.json"),
            "sidecar_text": F.when(rejected, report_json(F.col("issues"))),
        })
    return routing_manifest(
        settled, C.INCOMING, F.when(rejected, C.REJECTED).otherwise(C.PROCESSED_RAW)
    )


def quarantine_rows(failures: DataFrame, area: str) -> tuple[DataFrame, DataFrame]:
    """Files that could not be handled (``blob_path, usecase, analyzer_name, error_kind,
    error_message``): their error rows and their routing manifest with ``.error.txt`` texts."""
    target = C.FAILED if area == C.SOURCE else C.REJECTED
    errors = failures.select(
        "blob_path", "usecase", "analyzer_name", "error_kind",
        F.left(F.col("error_message"), F.lit(C.ERROR_MESSAGE_CHARS)).alias("error_message"),
    )
    rows = failures.select(
        F.substring(F.col("blob_path"), F.lit(len(area) + 2), F.length("blob_path")).alias("relative"),
        F.lit(".error.txt").alias("sidecar_suffix"),
        error_sidecar(F.col("error_kind"), F.col("error_message")).alias("sidecar_text"),
    )
    return errors, routing_manifest(rows, area, F.lit(target))


def batch_summary(outcomes: DataFrame, deferred: int | Column = 0, *keys: str) -> DataFrame:
    """Files per outcome of a batch: processed, failed, skipped and deferred, with those its source left for later.

    With ``keys`` a row for each of several batches, whose ``deferred`` is an aggregate.
    """
    out = F.col("outcome")
    return outcomes.groupBy(*keys).agg(
        F.count_if(out == "processed").alias("processed"),
        F.count_if(out == "failed").alias("failed"),
        F.count_if(out == "skipped").alias("skipped"),
        (F.count_if(out == "deferred") + deferred).alias("deferred"),
    )
