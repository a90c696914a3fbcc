"""What the operators share: tables, a scratch folder all executors reach, columns with clashing names."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import docpulse.llm
from docpulse.session import configure, shared_dir

# Functions go to the tasks with their code, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(docpulse.llm)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated function under its name, with its SQL counterpart if there is one."""

    def keep(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Removes the shuffle files of a query once it ends. By default they stay until the driver happens to collect its garbage, which a
# driver that does little besides planning may not do for the whole of an operator.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder, a folder for each value of ``by``, and go on from there.

    The table cuts the lineage: what is lost with an executor is read again, not computed again. It
    stays until the owner of the folder clears it, since the result that reads it is lazy. The shuffle files of the
    write go with it, so that the disk holds those of one write at a time.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docpulse-llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame, part: str = "") -> None:
    """Delete the files of a ``stored`` table, or of a part of it (``column=value``), that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles() if f.rpartition("/")[0].endswith(part)}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns whose names an operator's own columns take."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def words(text) -> "F.Column":
    """Number of runs of characters other than space, tab, line and page breaks; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
