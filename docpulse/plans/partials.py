"""Reports from partial measures: refreshed by the runs that changed, read without a look at documents, fields or checks.

Each stored run has its share of the three summaries: the measures of what is current in it, by exact spelling. A report merges
the shares of all runs. ``refresh`` finds the runs that are new, written again or gone, and the runs that hold other versions of
their documents, or whose checks were patched by them; it computes the shares of these anew, which retracts replaced versions and
brings back those whose replacement is gone. Other shares stay. What a run once held is known from ``keys``, stored with its share.

Shares are stored by generation, one a refresh. The list of marks, which run counts with which generation, is written last and
makes the generation valid; a refresh that broke off is simply run again. One refresh at a time, between batches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpulse.functions.text import ci_key
from docpulse.operators.documents import current_documents
from docpulse.plans import views as V
from docpulse.plans.ingest import _settle as settle
from docpulse.session import clear_staging, configure, staging_dir
from docpulse.sources import tables
from docpulse.sources.snapshots import list_folder, newest, read_state, stored_runs

ROOT = "_reports"
# Beyond so many generations all shares are written to one.
GENERATIONS = 16
# Columns of current documents that the shares are made of.
LIVE = ["document_id", "version_id", "usecase", "analyzer_name", "ingested_at", "run_id", "field_count", "avg_confidence", "min_confidence"]
MARKS = "source STRING, run_id STRING, files STRING, gen INT"
# Summary -> names, other keys, measures, report, the table whose runs it is made of, the view's name.
REPORTS = {
    "fields": (V.FIELD_NAMES, [], V.field_measures, V.field_report, "documents", "vw_FieldStatsByAnalyzer"),
    "documents": (V.GROUP_NAMES, ["ingested_date"], V.document_measures, V.document_report, "documents", "vw_DailyIngestion"),
    "checks": (V.GROUP_NAMES, ["checked_date"], V.check_measures, V.check_report, "checks", "vw_PreProcessDailySummary"),
}
_SHARE = "run_id STRING, usecase STRING, analyzer_name STRING, "
SHARES = {
    "fields": _SHARE + "field_name STRING, field_type STRING, observations BIGINT, confidence_sum DECIMAL(15,4), "
    "min_confidence DECIMAL(5,4), max_confidence DECIMAL(5,4), low_count BIGINT, high_count BIGINT, first_seen TIMESTAMP, last_seen TIMESTAMP",
    "documents": _SHARE + "ingested_date DATE, document_count BIGINT, total_fields BIGINT, average_sum DECIMAL(15,4), rated BIGINT, "
    "worst_field_confidence DECIMAL(5,4)",
    "checks": _SHARE + "checked_date DATE, total_inspected BIGINT, passed_count BIGINT, rejected_count BIGINT, cu_succeeded_count BIGINT, "
    "cu_failed_count BIGINT, score_sum BIGINT, total_errors BIGINT, total_warnings BIGINT",
    "keys": "run_id STRING, source STRING, key BIGINT",
}


def _newest_marks(spark: SparkSession, out: str) -> int:
    """Number of the newest complete list of marks; 0 if there is none."""
    names = [s.getPath().getName() for s in list_folder(spark, f"{out}/{ROOT}/marks")]
    for number in sorted((int(n) for n in names if n.isdigit()), reverse=True):
        if any(s.getPath().getName() == "_SUCCESS" for s in list_folder(spark, f"{out}/{ROOT}/marks/{number}")):
            return number
    return 0


def _read_marks(spark: SparkSession, out: str, number: int) -> DataFrame:
    return spark.read.schema(MARKS).parquet(f"{out}/{ROOT}/marks/{number}") if number else spark.createDataFrame([], MARKS)


def shares(spark: SparkSession, out: str, table: str, source: str) -> DataFrame:
    """The valid shares of all runs of ``source``."""
    marks = _read_marks(spark, out, _newest_marks(spark, out)).filter(F.col("source") == source).drop("files")
    schema = SHARES[table] + ", gen INT"
    generations = [r.gen for r in marks.select("gen").distinct().collect()]  # GENERATIONS at most
    if not generations:
        return spark.createDataFrame([], schema)
    base = f"{out}/{ROOT}/{table}"
    rows = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/gen={g}" for g in generations])
    on = ["source", "run_id", "gen"] if table == "keys" else ["run_id", "gen"]
    return rows.join(marks, on, "left_semi")


def report(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A summary as of the last refresh: ``fields``, ``documents`` or ``checks``. Reads shares only."""
    names, exact, measures, finish, source, _ = REPORTS[name]
    return finish(V.merge_partials(shares(spark, out, name, source), names, exact, measures()))


def register(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Register the three summaries, as of the last refresh, under their views' names."""
    found = {view: report(spark, out, name) for name, (*_, view) in REPORTS.items()}
    for view, rows in found.items():
        rows.createOrReplaceTempView(view)
    return found


def _among(rows: DataFrame, runs: list[str] | None) -> DataFrame:
    """Rows of the given runs, which a scan by partitions leaves the others out for; all rows for None."""
    return rows if runs is None else rows.filter(F.col("run_id").isin(runs))


def _touched(rows: DataFrame, changed: list[str], runs: dict[str, str], keys: DataFrame) -> set[str]:
    """Of the runs that did not change, those whose rows have one of the keys."""
    if {*runs} <= {*changed}:
        return set()
    return _runs_with(rows.filter(~F.col("run_id").isin(changed)), keys)


def _runs_with(rows: DataFrame, keys: DataFrame) -> set[str]:
    """Runs of the rows that have one of the keys."""
    return {r.run_id for r in rows.join(keys.distinct(), "key", "left_semi").select("run_id").distinct().collect()}


def _share(rows: DataFrame, name: str) -> DataFrame:
    names, exact, measures, *_ = REPORTS[name]
    return V.exact_partials(rows, names, ["run_id", *exact], measures())


def refresh(spark: SparkSession, out: str) -> int:
    """Bring the shares up to date with the stored tables and return their generation; 0 where nothing is stored."""
    configure(spark)
    number = _newest_marks(spark, out)
    known = {(r.source, r.run_id): (r.files, r.gen) for r in _read_marks(spark, out, number).collect()}
    runs = {"documents": {**newest(spark, out)[1], **stored_runs(spark, out)}}
    runs.update({source: stored_runs(spark, out, source) for source in ("checks", "patches")})
    changed = {source: sorted(
        {r for r, files in found.items() if known.get((source, r), (None,))[0] != files}
        | {r for s, r in known if s == source and r not in found}) for source, found in runs.items()}
    if not any(changed.values()):
        return number
    held = {source: shares(spark, out, "keys", source).filter(F.col("run_id").isin(changed[source])).select("key")
            for source in ("documents", "patches")}

    documents = read_state(spark, out, "documents").withColumn("key", F.xxhash64(ci_key("blob_path"), ci_key("content_path")))
    checks = tables.read_table(spark, out, "checks").withColumn("key", F.col("check_id"))
    patches = tables.read_table(spark, out, "patches").select("run_id", F.col("check_id").alias("key"))
    stale: dict[str, list[str] | None] = {"documents": changed["documents"], "checks": changed["checks"], "patches": changed["patches"]}
    if changed["documents"]:
        touched = _touched(documents, changed["documents"], runs["documents"], _among(documents, changed["documents"]).select("key").unionByName(held["documents"]))
        stale["documents"] = sorted({*changed["documents"], *touched} & {*runs["documents"]})
    if changed["patches"]:
        touched = _touched(checks, changed["checks"], runs["checks"], _among(patches, changed["patches"]).select("key").unionByName(held["patches"]))
        stale["checks"] = sorted({*changed["checks"], *touched} & {*runs["checks"]})
    # Where all runs are to be read, no list of them goes into the plan.
    few = {source: None if len(stale[source]) == len(runs[source]) else stale[source] for source in stale}

    rivals = documents
    if few["documents"] is not None:
        rivals = documents.join(_among(documents, few["documents"]).select("key").distinct(), "key", "left_semi")
    following = number + 1
    # Both reports on documents read what is current, which is found out once.
    staged = f"{ROOT}-{following}"
    live = settle(_among(current_documents(rivals.drop("key")), few["documents"]).select(*LIVE), f"{staging_dir(spark, out, staged)}/live")
    key_rows = lambda rows, source: _among(rows, few[source]).select("run_id", F.lit(source).alias("source"), "key").distinct()
    new = {
        "fields": _share(V.rated_fields(_among(read_state(spark, out, "fields"), few["documents"]), live, "run_id"), "fields"),
        "documents": _share(live.withColumn("ingested_date", F.to_date("ingested_at")), "documents"),
        "checks": _share(tables.checks(spark, out, few["checks"]).withColumn("checked_date", F.to_date("checked_at")), "checks"),
        "keys": key_rows(documents, "documents").unionByName(key_rows(patches, "patches")),
    }
    marks = {(source, run): (files, following if run in set(stale[source]) else known[source, run][1])
             for source, found in runs.items() for run, files in found.items()}
    if len({gen for _, gen in marks.values()}) > GENERATIONS:
        for table in SHARES:
            sources = ["documents", "patches"] if table == "keys" else [REPORTS[table][4]]
            kept = [shares(spark, out, table, s).filter(~F.col("run_id").isin(stale[s] + changed[s])).drop("gen") for s in sources]
            new[table] = reduce(DataFrame.unionByName, kept, new[table])
        marks = {mark: (files, following) for mark, (files, _) in marks.items()}
    for table, rows in new.items():
        columns = spark.createDataFrame([], SHARES[table]).schema
        rows.select(*[F.col(f.name).cast(f.dataType) for f in columns]).write.mode("overwrite").parquet(f"{out}/{ROOT}/{table}/gen={following}")
    listed = spark.createDataFrame([(*mark, *value) for mark, value in sorted(marks.items())], MARKS)
    listed.coalesce(1).write.mode("overwrite").parquet(f"{out}/{ROOT}/marks/{following}")
    clear_staging(spark, out, staged)
    return following


def vacuum_shares(spark: SparkSession, out: str) -> None:
    """Delete generations no run counts with, and older marks. Reports that still read them have to be over."""
    number = _newest_marks(spark, out)
    if not number:
        return
    used = {f"gen={r.gen}" for r in _read_marks(spark, out, number).select("gen").distinct().collect()} | {str(number)}
    for table in (*SHARES, "marks"):
        for status in list_folder(spark, f"{out}/{ROOT}/{table}"):
            if status.getPath().getName() not in used:
                status.getPath().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(status.getPath(), True)
