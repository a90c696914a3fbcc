"""A stream of file listings: new files, empty ones and rewritten ones, admitted by number and bytes.

Spark's file source goes by path: it leaves out empty files and never hands out a path twice. This one tells a file by path,
time and length, so that a rewritten file is a new one. What a batch admits is written to a log before its offset is
planned: a batch that is run again has the same files. A batch takes the oldest files first, up to a number
and a sum of bytes, one at least; each row also has the number of files that were left for later. What a listing finds and a batch leaves
goes to the batches after it, before there is another listing; a file that has changed since is left to that.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from docpulse.sources import stores
from docpulse.sources.stores import open_store

cloudpickle.register_pickle_by_value(stores)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "docpulse_listing"
SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, deferred BIGINT"
SLICE = 10_000  # listed files of one partition
MOST_BATCHES, MOST_BYTES = 64, 1 << 30  # of what is handed out together
ENTRY = re.compile(r"(\d{12})\.(batch|known)\.json")


class Log:
    """Batches of a stream: ``<n>.batch.json`` is what batch n admits, ``<n>.known.json`` all files up to batch n."""

    def __init__(self, folder: str):
        self.store, self.root = open_store(folder)

    def entries(self) -> dict[str, list[int]]:
        found: dict[str, list[int]] = {"batch": [], "known": []}
        for info in self.store.get_file_info(pafs.FileSelector(self.root, allow_not_found=True)):
            if name := ENTRY.fullmatch(info.base_name):
                found[name[2]].append(int(name[1]))
        return {kind: sorted(numbers) for kind, numbers in found.items()}

    def read(self, number: int, kind: str = "batch") -> dict:
        with self.store.open_input_stream(f"{self.root}/{number:012d}.{kind}.json") as file:
            return json.loads(file.read())

    def write(self, number: int, content: dict, kind: str = "batch") -> None:
        self.store.create_dir(self.root, recursive=True)
        draft, name = f"{self.root}/.{number:012d}.{kind}", f"{self.root}/{number:012d}.{kind}.json"
        with self.store.open_output_stream(draft) as file:
            file.write(json.dumps(content).encode())
        self.store.move(draft, name)

    def drop(self, number: int, kind: str) -> None:
        self.store.delete_file(f"{self.root}/{number:012d}.{kind}.json")


class Slice(InputPartition):
    def __init__(self, rows: list, deferred: int, batch: int):
        self.rows, self.deferred, self.batch = rows, deferred, batch


def admit(found: list[tuple[int, str, int]], max_files: int, max_bytes: int | None) -> list[tuple[int, str, int]]:
    """The oldest of ``found`` (time, path, length): at most so many files and bytes, but one at least."""
    taken, size = [], 0
    for row in sorted(found)[:max_files]:
        size += row[2]
        if taken and max_bytes is not None and size > max_bytes:
            break
        taken.append(row)
    return taken


class ListingReader(DataSourceStreamReader):
    def __init__(self, options: dict):  # names of options come in lower case
        self.src, self.log = options["path"], Log(options["log"])
        self.most = int(options.get("maxfiles", 1000))
        self.bytes = int(options["maxbytes"]) if options.get("maxbytes") else None
        self.names = re.compile(options.get("names", ".*"), re.S).fullmatch
        self.together = int(options["together"]) if options.get("together") else None
        self.known: dict[str, list] | None = None  # path -> [time, length]
        self.left: list[tuple[int, str, int]] = []  # found by the last listing and in no batch yet, the newest first
        self.last = 0

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def _load(self) -> None:
        entries = self.log.entries()
        base = entries["known"][-1] if entries["known"] else 0
        self.known = self.log.read(base, "known") if base else {}
        self.last = base
        for number in entries["batch"]:
            if number > base:
                self._learn(self.log.read(number)["files"])
                self.last = number

    def _learn(self, files: list) -> None:
        self.known.update((path, [time, length]) for time, path, length in files)

    def latestOffset(self) -> dict:
        if self.known is None:
            self._load()
        files = size = 0
        first = self.last
        while taken := self._next(listing=not files):
            self.log.write(self.last + 1, {"files": taken, "deferred": len(self.left)})
            self.last += 1
            self._learn(taken)
            files, size = files + len(taken), size + sum(row[2] for row in taken)
            if files + self.most > (self.together or 0) or size + (self.bytes or 0) > MOST_BYTES or self.last - first == MOST_BATCHES:
                break
        return {"batch": self.last}

    def _next(self, listing: bool) -> list[tuple[int, str, int]]:
        """The files of the next batch: of those left, else of a new listing, if there may be one."""
        while taken := admit(self.left[-self.most:], self.most, self.bytes):
            del self.left[-len(taken):]
            if same := unchanged(self.src, taken):
                return same
        if not listing:
            return []
        found = [row for row in list_files(self.src, self.names) if self.known.get(row[1]) != [row[0], row[2]]]
        self.left = sorted(found, reverse=True)
        taken = admit(self.left[-self.most:], self.most, self.bytes)
        del self.left[len(self.left) - len(taken):]
        return taken

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        slices = []
        for number in range(start["batch"] + 1, end["batch"] + 1):
            entry = self.log.read(number)
            rows = entry["files"]
            slices += [Slice(rows[i:i + SLICE], entry["deferred"], number) for i in range(0, len(rows), SLICE)]
        return slices

    def read(self, partition: Slice) -> Iterator[tuple]:
        number = () if self.together is None else (partition.batch,)
        for time, path, length in partition.rows:
            yield path, datetime.fromtimestamp(time / 1e6, UTC), length, partition.deferred, *number

    def commit(self, end: dict) -> None:
        """Batches that are over become part of what is known, a hundred at a time; the last two hand-outs stay readable."""
        entries = self.log.entries()
        base, upto = (entries["known"] or [0])[-1], end["batch"] - 2 * (MOST_BATCHES if self.together else 1)
        if upto - base < 100:
            return
        known = self.log.read(base, "known") if base else {}
        for number in range(base + 1, upto + 1):
            known.update((path, [time, length]) for time, path, length in self.log.read(number)["files"])
        self.log.write(upto, known, "known")
        for kind, numbers in entries.items():
            for number in numbers:
                if number <= upto and (kind, number) != ("known", upto):
                    self.log.drop(number, kind)


def list_files(src: str, names) -> Iterator[tuple[int, str, int]]:
    """(time in microseconds, path below ``src``, length) of all files whose name passes ``names``, folder by folder."""
    store, root = open_store(src)
    folders = [root]
    while folders:
        for info in store.get_file_info(pafs.FileSelector(folders.pop(), allow_not_found=True)):
            if info.type == pafs.FileType.Directory:
                if not info.base_name.startswith(("_", ".")):
                    folders.append(info.path)
            elif names(info.base_name) and not info.base_name.startswith(("_", ".")):
                yield info.mtime_ns // 1000, info.path[len(root) + 1:], info.size


def unchanged(src: str, files: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Those of listed files that are as they were listed."""
    store, root = open_store(src)
    now = store.get_file_info([f"{root}/{path}" for _, path, _ in files])
    return [row for row, info in zip(files, now)
            if info.type == pafs.FileType.File and (info.mtime_ns // 1000, info.size) == (row[0], row[2])]


class Listing(DataSource):
    """Options: ``path``, ``log`` (a folder kept with the checkpoint), ``maxFiles``, ``maxBytes``, ``names`` (a pattern), ``together``.

    With ``together``, rows name their batch, and batches that follow each other are handed out together, up to so many files.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"{SCHEMA}, batch BIGINT" if self.options.get("together") else SCHEMA

    def streamReader(self, schema) -> ListingReader:
        return ListingReader(dict(self.options))


def stream_files(spark: SparkSession, src: str, log: str, max_files: int, max_bytes: int | None = None, names: str = ".*",
                 together: int | None = None) -> DataFrame:
    """New files below ``src`` as a stream of ``path, modificationTime, length, deferred``, with ``together`` also ``batch``."""
    spark.dataSource.register(Listing)
    reader = spark.readStream.format(FORMAT).option("path", src).option("log", log).option("maxFiles", max_files).option("names", names)
    for option, value in (("maxBytes", max_bytes), ("together", together)):
        reader = reader.option(option, value) if value is not None else reader
    return reader.load()
