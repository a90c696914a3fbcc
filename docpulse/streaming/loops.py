"""The two incremental loops as file streams.

The source hands each version of a file to one batch, empty ones too; a batch retried after a failure has the same
id and files and so the same ``run_id``, whose partitions it replaces.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery

from docpulse import constants as C
from docpulse.constants import LIMITS, Limits
from docpulse.plans.gate import check_batch, check_listed, links_of, settle_outcomes
from docpulse.plans.ingest import ingest_batch
from docpulse.session import configure
from docpulse.sources.files import read_listed_results, read_results
from docpulse.sources.listing import stream_files
from docpulse.sources.tables import TABLES
from docpulse.streaming.timeouts import CAP_SECONDS, answers, settle_stream, submissions

RESULT_NAME = r".*\.[jJ][sS][oO][nN]"
TOGETHER = 10_000  # files of the batches that one plan goes over
LISTED = "path STRING, modificationTime TIMESTAMP, length BIGINT, deferred BIGINT, batch BIGINT, run_id STRING"


def _start(stream: DataFrame, handle, checkpoint: str, name: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(availableNow=True)
        .start()
    )


class Drained:
    """A query over a source that grows by batches: waiting for its end runs it until nothing is left, then stops it."""

    def __init__(self, query: StreamingQuery):
        self.query = query

    def awaitTermination(self) -> None:
        try:
            self.query.processAllAvailable()
        finally:
            self.query.stop()

    def __getattr__(self, name: str):
        return getattr(self.query, name)


def _start_listing(spark: SparkSession, src: str, checkpoint: str, name: str, max_files: int, max_bytes: int | None,
                   names: str, drain: bool, handle) -> StreamingQuery | Drained:
    """Start ``handle(listed files, first run, files deferred, runs or None)`` over new files, in batches until nothing is new, or for one.

    A plan costs seconds whatever it goes over. So batches that are there at once go through one plan, up to ``TOGETHER`` files; each
    remains a run of its own, with the files the source has dealt to it.
    """
    stream = stream_files(spark, src, f"{checkpoint}/files", max_files, max_bytes, names, TOGETHER if drain else 1)

    def each(batch: DataFrame, _: int) -> None:
        for rows in together(batch.collect()):  # the listing of these batches: the source bounds it
            listed = spark.createDataFrame([(*r, run_id(name, r.batch - 1)) for r in rows], LISTED)
            several = listed.select("path", "run_id", "deferred") if rows[0].batch != rows[-1].batch else None
            handle(listed, run_id(name, rows[0].batch - 1), rows[0].deferred, several)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).queryName(name)
    return Drained(writer.trigger(processingTime="0 seconds").start()) if drain else writer.trigger(availableNow=True).start()


def together(rows: list[Row]) -> list[list[Row]]:
    """Listed files of one or several batches, in batch order, as few lists of whole batches that name no path twice."""
    lists: list[list[Row]] = []
    paths: set[str] = set()
    for _, own in groupby(sorted(rows, key=lambda r: r.batch), key=lambda r: r.batch):
        own = list(own)
        if not lists or not paths.isdisjoint(r.path for r in own):  # a path that has changed between two listings
            lists.append([])
            paths = set()
        lists[-1] += own
        paths.update(r.path for r in own)
    return lists


def run_id(name: str, batch: int) -> str:
    """Run of a micro-batch; sorts in batch order."""
    return f"{name}-{batch:012d}"


def start_ingest(
    spark: SparkSession, src: str, out: str, checkpoint: str, max_files: int = C.INGEST_MAX_FILES,
    name: str = "ingest", max_bytes: int | None = None, sidecars: str | None = None, drain: bool = True,
) -> StreamingQuery | Drained:
    """Ingest the result files that are new or rewritten below ``src``, the oldest first, then stop.

    A batch takes ``max_files`` files and ``max_bytes`` bytes at most; with ``drain`` batches go on until nothing is new,
    without it one batch is run and table ``batches`` tells how many files it deferred to the next start. The stream hands
    out listings; a file is read in its batch, so that one which cannot be read is an error row and not the end of
    the stream. Batches that are there at once are runs of their own and go through one plan. Error texts of failed files go to files below ``sidecars``, where given.
    """
    configure(spark)

    def handle(listed: DataFrame, run: str, deferred: int, runs: DataFrame | None) -> None:
        ingest_batch(read_listed_results(spark, src, listed), out, run, links_of(spark, out), deferred=deferred, sidecars=sidecars, runs=runs)

    return _start_listing(spark, src, checkpoint, name, max_files, max_bytes, RESULT_NAME, drain, handle)


def spread(batch: DataFrame) -> DataFrame:
    """The rows of a batch over all cores: a source may hand them out as one split."""
    parts = 2 * batch.sparkSession.sparkContext.defaultParallelism
    return batch if batch.rdd.getNumPartitions() >= parts else batch.repartition(parts)


def ingest_stream(stream: DataFrame, out: str, checkpoint: str, name: str = "ingest") -> StreamingQuery:
    """Ingest a stream of result files (``path, value``), whatever its source."""

    def handle(batch: DataFrame, number: int) -> None:
        ingest_batch(spread(batch), out, run_id(name, number), links_of(batch.sparkSession, out))

    return _start(stream, handle, checkpoint, name)


def ingest_paths(spark: SparkSession, src: str, paths: list[str], out: str, run: str) -> dict[str, int]:
    """Ingest the given paths again, for instance new versions of files already seen."""
    configure(spark)
    return ingest_batch(read_results(spark, src, paths), out, run, links_of(spark, out))


def start_quality(
    spark: SparkSession, src: str, out: str, checkpoint: str, max_files: int = C.QUALITY_MAX_FILES,
    mode: str = "standard", limits: Limits = LIMITS, file_metrics: DataFrame | None = None,
    page_metrics: DataFrame | None = None, name: str = "quality", max_bytes: int | None = None, drain: bool = True,
) -> StreamingQuery | Drained:
    """Check the raw files that are new or rewritten below ``src``; batches as in :func:`start_ingest`.

    ``file_metrics`` and ``page_metrics`` are tables the inspectors fill; files they do not know
    yet get a notice instead of the deep checks. The stream hands out listings; bytes are read in the batch.
    """
    configure(spark)

    def handle(listed: DataFrame, run: str, deferred: int, runs: DataFrame | None) -> None:
        check_listed(spark, src, listed, out, run, mode, limits, file_metrics, page_metrics, deferred, runs)

    return _start_listing(spark, src, checkpoint, name, max_files, max_bytes, ".*", drain, handle)


def quality_stream(
    stream: DataFrame, out: str, checkpoint: str, mode: str = "standard", limits: Limits = LIMITS,
    file_metrics: DataFrame | None = None, page_metrics: DataFrame | None = None, name: str = "quality",
) -> StreamingQuery:
    """Check a stream of raw files (``path, modificationTime, length, content``), whatever its
    source; images get the notice that they were not inspected."""

    def handle(batch: DataFrame, number: int) -> None:
        check_batch(batch, out, run_id(name, number), mode, limits, None, file_metrics, page_metrics)

    return _start(stream, handle, checkpoint, name)


def start_settlement(
    outcomes: DataFrame, out: str, checkpoint: str, name: str = "settle", strict: bool = False,
    cap_seconds: int = CAP_SECONDS, delay: str = "1 minute", clock: bool = False, sidecars: str | None = None,
) -> StreamingQuery:
    """Settle stored checks with a stream of outcomes (``event_time`` and the columns of ``route_outcomes``), then stop.

    The checks come as a stream of their stored runs. Checks the gate refused are routed with the next settlement; those
    without an outcome within the cap are routed as ``Timeout``.
    """
    spark = configure(outcomes.sparkSession)
    stored = spark.readStream.schema(TABLES["checks"]).parquet(f"{out}/checks")
    events = submissions(stored).unionByName(answers(outcomes))

    def handle(batch: DataFrame, number: int) -> None:
        settle_outcomes(batch.sparkSession, out, batch, run_id(name, number), strict, sidecars)

    return _start(settle_stream(events, cap_seconds, delay, clock), handle, checkpoint, name)
