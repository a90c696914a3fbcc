"""File sources: result files as text, raw files as bytes, listings with empty files."""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docpulse.session import shared_dir
from docpulse.sources import stores
from docpulse.sources.stores import open_store

cloudpickle.register_pickle_by_value(stores)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RESULT_GLOB = "*.[jJ][sS][oO][nN]"
RAW = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
# The longest text or byte array a row can hold is below 2 GiB; a text needs some room to be decoded.
LONGEST_TEXT = 1 << 30


def root_path(spark: SparkSession, src: str) -> str:
    """Path of a folder without scheme and host, as it shows up in file paths."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(src)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().getPath().rstrip("/")


def relative_path(full: Column, root: str, encoded: bool) -> Column:
    """Path below ``root``; metadata paths are percent-encoded, those of binary files are not."""
    plain = F.regexp_replace(full, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    if encoded:
        # In a path a plus sign is itself, not a blank.
        plain = F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))
    return F.substring(plain, F.lit(len(root) + 2), F.length(plain))


def located(src: str, paths: list[str] | None) -> str | list[str]:
    """``src`` or files below it, for a reader: a name is that name, whatever glob signs it has."""
    if paths is None:
        return src
    return [f"{src.rstrip('/')}/" + re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]


def read_results(spark: SparkSession, src: str, paths: list[str] | None = None) -> DataFrame:
    """Result files below ``src`` (or just ``paths`` of it) as ``path, value``."""
    rows = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).text(
        located(src, paths), wholetext=True, recursiveFileLookup=True, pathGlobFilter=RESULT_GLOB)
    return rows.select(
        relative_path(F.col("_metadata.file_path"), root_path(spark, src), True).alias("path"), "value"
    )


def read_listed_results(spark: SparkSession, src: str, listed: DataFrame) -> DataFrame:
    """Texts of listed files (``path, length``): every file has a row, NULL where it cannot be read.

    The paths are those of one batch, whose size the source bounds. Empty files, which Spark's file sources leave out,
    have an empty text.
    """
    paths = [r.path for r in listed.filter(F.col("length").between(1, LONGEST_TEXT)).select("path").collect()]
    empty = F.when(F.col("length") == 0, F.lit(""))
    if not paths:
        return listed.select("path", empty.alias("value"))
    return listed.join(read_results(spark, src, paths), "path", "left").select("path", F.coalesce(empty, "value").alias("value"))


def read_contents(spark: SparkSession, src: str, paths: list[str], longest: int) -> DataFrame:
    """Bytes of the given files up to ``longest`` bytes; files that cannot be read have no row."""
    if not paths:
        return spark.createDataFrame([], RAW)
    reader = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    return _raw(reader, spark, src, located(src, paths)).filter(F.col("length") <= longest)


def read_heads(spark: SparkSession, src: str, listed: DataFrame, size: int) -> DataFrame:
    """The first ``size`` bytes of listed files (``path``) as ``path, head``, read in tasks; NULL for files that cannot be read."""
    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(src)
        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                try:
                    with store.open_input_file(f"{root}/{path}") as file:
                        found.append(file.read_at(size, 0))
                except OSError:
                    found.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["path", "head"])

    return listed.select("path").mapInArrow(heads, "path STRING, head BINARY")


def _raw(reader, spark: SparkSession, src: str, where) -> DataFrame:
    rows = reader.format("binaryFile").option("recursiveFileLookup", True).load(where)
    return rows.withColumn("path", relative_path(F.col("path"), root_path(spark, src), False))


def read_raw(
    spark: SparkSession, src: str, paths: list[str] | None = None, prefix: str | None = None
) -> DataFrame:
    """Raw files below ``src`` as ``path, modificationTime, length, content``.

    ``prefix`` keeps paths that start with it; a whole folder in it narrows the listing.
    """
    root = src.rstrip("/")
    if paths is not None:
        return _raw(spark.read, spark, src, located(src, paths))
    folder = prefix.rpartition("/")[0] if prefix else ""
    rows = _raw(spark.read, spark, src, f"{root}/{folder}" if folder else root)
    return rows.filter(F.col("path").startswith(prefix)) if prefix else rows


def read_images(spark: SparkSession, src: str, paths: list[str] | None = None) -> DataFrame:
    """Images below ``src`` as ``path, image``; undecodable ones have a height of -1."""
    rows = spark.read.format("image").option("recursiveFileLookup", True).load(located(src, paths))
    origin = relative_path(F.col("image.origin"), root_path(spark, src), True)
    return rows.select(origin.alias("path"), "image")


def list_files(spark: SparkSession, src: str, prefix: str = "", most: int | None = None) -> DataFrame:
    """Manifest ``path, is_file, length`` of the third level below ``src``, empty files too, from any store.

    Folders are listed level by level in tasks, a folder each, and what a level finds is written before the next one begins,
    so that no name goes through the driver. A folder that cannot hold names that start with ``prefix`` is not
    opened; ``most`` keeps the first names in order.
    """
    folder = f"{shared_dir(spark)}/docpulse-listing-{uuid.uuid4().hex}"

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(src)
        for batch in batches:
            for own in batch.column(0).to_pylist():
                base = f"{root}/{own}" if own else root
                found = store.get_file_info(pafs.FileSelector(base, allow_not_found=True))
                for start in range(0, len(found), 10_000):
                    part = [i for i in found[start:start + 10_000]
                            if not i.base_name.startswith(("_", ".")) or i.type == pafs.FileType.File]
                    files = [i.type == pafs.FileType.File for i in part]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f"{own}/{i.base_name}".lstrip("/") for i in part], pa.string()), pa.array(files, pa.bool_()),
                        pa.array([i.size if f else 0 for i, f in zip(part, files)], pa.int64())], ["path", "is_file", "length"])

    rows = spark.createDataFrame([("",)], "path STRING")
    for level in range(3):
        # a folder a task: a level of many folders is spread by name, one wide folder is one listing call
        tasks = rows.repartition("path") if level else rows
        tasks.mapInArrow(below, "path STRING, is_file BOOLEAN, length BIGINT").write.parquet(f"{folder}/{level}")
        found = spark.read.schema("path STRING, is_file BOOLEAN, length BIGINT").parquet(f"{folder}/{level}")
        rows = found.filter("NOT is_file").select("path")
        if prefix:
            inside = F.concat("path", F.lit("/"))
            rows = rows.filter(F.startswith(F.lit(prefix), inside) | F.startswith(inside, F.lit(prefix)))
    found = found.filter(F.col("path").startswith(prefix)) if prefix else found
    return found if most is None else found.orderBy("path").limit(most)
