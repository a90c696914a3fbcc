"""The stored tables: written per run, read as current state.

Every table is partitioned by ``run_id``; writing a run again replaces its partition, so a
retried batch leaves no second copy.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docpulse import schemas
from docpulse.operators.checks import OUTCOME_COLUMNS, apply_outcomes
from docpulse.operators.documents import current_documents, current_fields, late_links, surviving_children
from docpulse.plans.views import register_views

PATCHES = "check_id BIGINT, submitted_to_cu BOOLEAN, " + ", ".join(
    f"{c} STRING" for c in OUTCOME_COLUMNS) + ", completed_at TIMESTAMP, run_id STRING"
MANIFEST = ("src_path STRING, dest_path STRING, disposition STRING, sidecar_path STRING, "
            "sidecar_text STRING, run_id STRING")
BATCHES = "processed BIGINT, failed BIGINT, skipped BIGINT, deferred BIGINT, run_id STRING"

TABLES = {
    "documents": schemas.DOCUMENTS, "fields": schemas.FIELDS, "errors": schemas.ERRORS,
    "checks": schemas.CHECKS, "issues": schemas.ISSUES, "links": schemas.LINKS,
    "patches": PATCHES, "manifest": MANIFEST, "batches": BATCHES,
}

# Checks that wait for an outcome, apart from the history of all checks. A part is a hash of the check; ``state`` tells
# what settles it: the gate alone, the gate in strict mode, or an outcome.
OPEN_PARTS = 16
OPEN = schemas.CHECKS.replace(", run_id STRING", "") + (
    ", issues ARRAY<STRUCT<issue_id: BIGINT, code: STRING, severity: STRING, message: STRING, details_json: STRING>>"
    ", state STRING, part INT, run_id STRING")


def publish(df: DataFrame, out: str, table: str, run_id: str | None) -> None:
    """Write one run of a table, replacing an earlier attempt of the same run; without ``run_id`` the runs its rows name."""
    columns = schemas.names(TABLES[table])
    rows = df.select(*columns).hint("rebalance", F.col("run_id")) if run_id is None else df.withColumn("run_id", F.lit(run_id)).select(*columns)
    rows.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{out}/{table}")


def read_table(spark: SparkSession, out: str, table: str) -> DataFrame:
    """All stored rows of a table; no rows before the first run."""
    try:
        return spark.read.schema(TABLES[table]).parquet(f"{out}/{table}")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], TABLES[table])


def read_run(spark: SparkSession, out: str, table: str, run_id: str) -> DataFrame:
    """The rows of one stored run, read from its folder: no other run is listed. No rows where it has none."""
    columns = [f for f in spark.createDataFrame([], TABLES[table]).schema if f.name != "run_id"]
    quoted = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run_id)
    try:
        rows = spark.read.schema(StructType(columns)).parquet(f"{out}/{table}/run_id={quoted}")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], TABLES[table])
    return rows.withColumn("run_id", F.lit(run_id))


def publish_open(checked: DataFrame, out: str, run_id: str | None) -> None:
    """Keep the checks of a run, or of the runs rows name, that wait for what becomes of them (columns of ``checks``, and ``issues``)."""
    state = F.when(~F.col("passed"), "refused").when(F.col("warning_count") > 0, "warned").otherwise("clean")
    # Several runs are as many times the files, which one small task would write one after another.
    keys = ["state", "part"] if run_id is not None else [2 * checked.sparkSession.sparkContext.defaultParallelism, "state", "part", "run_id"]
    checked.withColumns({"state": state, "part": F.pmod(F.xxhash64("check_id"), F.lit(OPEN_PARTS)).cast("int"), "run_id": F.col("run_id") if run_id is None else F.lit(run_id)}).select(
        *StructType.fromDDL(OPEN).names).repartition(*keys).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("state", "part", "run_id").parquet(f"{out}/open")


def read_open(spark: SparkSession, out: str) -> DataFrame:
    """The checks that wait; one that an interrupted settlement has written anew counts once."""
    try:
        return spark.read.schema(OPEN).parquet(f"{out}/open")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], OPEN)


def close_checks(left: DataFrame, taken: list[str], out: str, run_id: str) -> None:
    """Replace the partitions ``taken`` (folders below ``open``) by what is ``left`` of them, in one run."""
    spark = left.sparkSession
    publish_open(left, out, f"left-{run_id}")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for folder in taken:
        if not folder.endswith(f"/run_id=left-{run_id}"):
            path = hadoop.Path(f"{out}/open/{folder}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, out: str) -> DataFrame:
    """Current documents, from the newest snapshot and the runs after it, with links that came later than they did."""
    from docpulse.sources.snapshots import read_state

    return late_links(current_documents(read_state(spark, out, "documents")), read_table(spark, out, "links"))


def fields(spark: SparkSession, out: str, current: DataFrame | None = None) -> DataFrame:
    """Fields of the current documents."""
    from docpulse.sources.snapshots import read_state

    current = documents(spark, out) if current is None else current
    return current_fields(read_state(spark, out, "fields"), current)


def checks(spark: SparkSession, out: str, runs: list[str] | None = None) -> DataFrame:
    """Checks, of ``runs`` where given, with the newest outcome of each; checking a file again adds a check."""
    found, patches = read_table(spark, out, "checks"), read_table(spark, out, "patches")
    if runs is not None:
        found = found.filter(F.col("run_id").isin(runs))
        patches = patches.join(found.select("check_id"), "check_id", "left_semi")
    columns = [c for c in patches.columns if c not in ("check_id", "run_id")]
    newest = patches.groupBy("check_id").agg(
        F.max_by(F.struct(*columns), F.struct("completed_at", "run_id")).alias("p")
    ).select("check_id", "p.*")
    # Every run's check of a file is a check of its own.
    return apply_outcomes(found, newest)


def issues(spark: SparkSession, out: str, current: DataFrame | None = None) -> DataFrame:
    """Issues of the current checks."""
    current = checks(spark, out) if current is None else current
    return surviving_children(read_table(spark, out, "issues"), current, ["check_id", "run_id"])


def register(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Register the nine reporting views over the current state.

    The views join fields with the current documents by version, which leaves out the fields of
    replaced versions by itself: they get the stored fields as they are.
    """
    from docpulse.sources.snapshots import read_state

    d, c = documents(spark, out), checks(spark, out)
    return register_views(spark, d, read_state(spark, out, "fields"), c, issues(spark, out, c))


def save_bucketed(df: DataFrame, name: str, key: str = "document_id", buckets: int = 64) -> None:
    """Save a current table bucketed by its join key, so that the reports join without a shuffle.

    Spread the rows over the buckets first: otherwise every task writes a file per bucket.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
