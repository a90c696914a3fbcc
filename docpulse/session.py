"""Session settings, and the shared folder intermediate tables go to."""

from __future__ import annotations

import hashlib
import tempfile

from pyspark.sql import SparkSession

# Runtime settings: adaptive plans split skewed join partitions and size shuffles from real
# bytes; days are days in UTC; duplicate JSON keys keep the last one; a writer with few partitions keeps their
# files open instead of sorting its rows; the files of a batch are looked up by few tasks, not by one each; Arrow batches are bounded in bytes, since one decoded image may be hundreds of megabytes.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}

# Launch setting for drivers and executors: long chains of projections are long generated methods,
# which HotSpot would otherwise leave to the interpreter. Those of the flattening are kept short.
JAVA_OPTIONS = "-XX:-DontCompileHugeMethods"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; launch settings stay the cluster's."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, **extra: str) -> SparkSession:
    """A session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("docpulse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.driver.extraJavaOptions", JAVA_OPTIONS)
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data.

    A session within one JVM (local[...]) without one gets a temporary folder; otherwise a missing
    setting is an error, because a machine-local folder would not survive the loss of an executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="docpulse-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def staging_dir(spark: SparkSession, out: str, run_id: str) -> str:
    """Folder for the intermediate tables of one run into the tables below ``out``."""
    return f"{shared_dir(spark)}/docpulse-staging/{hashlib.md5(out.encode()).hexdigest()[:12]}/{run_id}"


def clear_staging(spark: SparkSession, out: str, run_id: str) -> None:
    """Delete the intermediate tables of a run whose tables are published."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging_dir(spark, out, run_id))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df, spark: SparkSession | None = None):
    """Write ``df`` to the shared folder and go on from there."""
    spark = spark or df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
