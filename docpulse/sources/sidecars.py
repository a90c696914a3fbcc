"""Sidecar files: one named text file per row, next to where the rejected or failed file goes.

A data source in Python writes them with a two-phase commit. Every task attempt writes its files into a
folder of its own and reports that folder. When all tasks are done the driver commits the reported folders as one
small file; what failed or repeated attempts left is not in it. Committed files are then moved to their places by tasks,
a folder each; a move that is repeated finds the rest of its folder. A crash before the commit leaves no sidecar, one after it
is made good by the next :func:`publish_sidecars` or :func:`finish`.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from docpulse.session import shared_dir
from docpulse.sources import stores
from docpulse.sources.stores import entries, open_store, safe_path

# Sources and functions go to the tasks with their code, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(stores)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "docpulse_sidecars"
STAGED, COMMITTED = "_staged", "_committed"
PIECE = 10_000  # sidecars of a task, and names of a batch
LISTED = pa.schema([("path", pa.string()), ("is_file", pa.bool_())])
READ = pa.schema([("path", pa.string()), ("text", pa.binary())])


class Written(WriterCommitMessage):
    """The folder a task attempt has written, and how many files."""

    def __init__(self, folder: str, files: int):
        self.folder, self.files = folder, files


class SidecarWriter(DataSourceArrowWriter):
    """Rows of ``path``, ``text``."""

    def __init__(self, folder: str, job: str):
        self.folder, self.job = folder, job

    def write(self, iterator) -> Written:
        store, root = open_store(self.folder)
        attempt = f"{STAGED}/{self.job}/{uuid.uuid4().hex}"
        names = set()
        for batch in iterator:
            for path, text in zip(batch.column("path"), batch.column("text")):
                name = safe_path(path.as_py())
                target = f"{root}/{attempt}/{name}"
                store.create_dir(target.rpartition("/")[0], recursive=True)
                with store.open_output_stream(target) as out:
                    out.write((text.as_py() or "").encode())
                names.add(name)
        return Written(attempt, len(names))

    def commit(self, messages: list[Written | None]) -> None:
        done = [m.folder for m in messages if m is not None and m.files]
        if done:
            store, root = open_store(self.folder)
            store.create_dir(f"{root}/{COMMITTED}", recursive=True)
            draft = f"{root}/{STAGED}/{self.job}.json"
            with store.open_output_stream(draft) as out:
                out.write(json.dumps(done).encode())
            store.move(draft, f"{root}/{COMMITTED}/{self.job}.json")  # whole or not at all

    def abort(self, messages: list[Written | None]) -> None:
        store, root = open_store(self.folder)
        if store.get_file_info(f"{root}/{STAGED}/{self.job}").type != pafs.FileType.NotFound:
            store.delete_dir(f"{root}/{STAGED}/{self.job}")


class Sidecars(DataSource):
    """``df.write.format("docpulse_sidecars").mode("append").option("path", folder)``; files are in place after :func:`finish`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path STRING, text STRING"

    def writer(self, schema, overwrite: bool) -> SidecarWriter:
        return SidecarWriter(self.options["path"], uuid.uuid4().hex)


def publish_sidecars(rows: DataFrame, folder: str) -> None:
    """Write ``rows`` (``path`` below ``folder``, ``text``) as files; NULL text is an empty file, a NULL path none.

    An earlier file of a path is replaced. Of rows with one path one is kept, the one with the smallest text.
    """
    spark = rows.sparkSession
    spark.dataSource.register(Sidecars)
    one = rows.filter("path IS NOT NULL").groupBy("path").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    one.write.format(FORMAT).mode("append").option("path", folder).save()
    finish(spark, folder)


def finish(spark: SparkSession, folder: str) -> None:
    """Move the files of all commits to their places; tasks list and move a committed folder each."""
    store, root = open_store(folder)
    jobs = [i.path for i in store.get_file_info(pafs.FileSelector(f"{root}/{COMMITTED}", allow_not_found=True))
            if i.path.endswith(".json")]
    jobs = [(job, json.loads(store.open_input_stream(job).read())) for job in sorted(jobs)]
    folders = [(f,) for _, own in jobs for f in own]
    if folders:
        def move(batches: Iterator) -> Iterator:
            store, root = open_store(folder)
            for batch in batches:
                for attempt in batch.column(0).to_pylist():
                    _move(store, root, attempt)
                yield batch

        attempts = spark.createDataFrame(folders, "attempt STRING").repartition(len(folders))
        attempts.mapInArrow(move, "attempt STRING").write.format("noop").mode("overwrite").save()
    for job, own in jobs:
        store.delete_file(job)
        for top in {f.rpartition("/")[0] for f in own}:
            if store.get_file_info(f"{root}/{top}").type != pafs.FileType.NotFound:
                store.delete_dir(f"{root}/{top}")


def _move(store: pafs.FileSystem, root: str, attempt: str) -> None:
    base = f"{root}/{attempt}"
    for info in store.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True)):
        if info.type == pafs.FileType.File:
            target = f"{root}/{info.path[len(base) + 1:]}"
            store.create_dir(target.rpartition("/")[0], recursive=True)
            try:
                store.move(info.path, target)
            except FileNotFoundError:  # another attempt of this task has moved it
                pass


def read_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecars below ``folder`` that are in place, as ``path, text``; empty ones are left out.

    There may be one for every file that was ever rejected: names are listed level by level in tasks and written, and texts are read in
    tasks, so that neither goes through the driver. As in Spark's own listings names that begin with a dot or an underscore do not count.
    """
    store, root = open_store(folder)
    if store.get_file_info(root).type == pafs.FileType.NotFound:
        raise FileNotFoundError(folder)
    listing = f"{shared_dir(spark)}/docpulse-sidecars-{uuid.uuid4().hex}"

    def below(batches: Iterator) -> Iterator:
        store, root = open_store(folder)
        for batch in batches:
            for own in batch.column("path").to_pylist():
                found = []
                for name, is_file, length in entries(store, f"{root}/{own}" if own else root):
                    if not _hidden(name) and (not is_file or length and name.endswith((".error.txt", ".report.json"))):
                        found.append({"path": f"{own}/{name}" if own else name, "is_file": is_file})
                    if len(found) == PIECE:
                        yield pa.RecordBatch.from_pylist(found, LISTED)
                        found = []
                yield pa.RecordBatch.from_pylist(found, LISTED)

    def texts(batches: Iterator) -> Iterator:
        store, root = open_store(folder)
        for batch in batches:
            found, size = [], 0
            for path in batch.column("path").to_pylist():
                try:
                    with store.open_input_stream(f"{root}/{path}") as file:
                        text = file.read()
                except FileNotFoundError:  # gone meanwhile
                    continue
                found.append({"path": path, "text": text})
                size += len(text)
                if size > 1 << 23:
                    yield pa.RecordBatch.from_pylist(found, READ)
                    found, size = [], 0
            yield pa.RecordBatch.from_pylist(found, READ)

    schema, level = "path STRING, is_file BOOLEAN", 0
    rows = spark.createDataFrame([("",)], "path STRING")
    while not rows.isEmpty():
        rows.repartition("path").mapInArrow(below, schema).write.parquet(f"{listing}/{level}")
        rows = spark.read.schema(schema).parquet(f"{listing}/{level}").filter("NOT is_file").select("path")
        level += 1
    paths = spark.read.schema(schema).parquet(*[f"{listing}/{i}" for i in range(level)]).filter("is_file").select("path")
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-paths.count() // PIECE))
    return paths.repartition(tasks).mapInArrow(texts, "path STRING, text BINARY").withColumn("text", F.col("text").cast("string"))


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")
