"""Outcomes of submitted checks, and a timeout for those that never get one.

Two kinds of events meet by check: that it was submitted, and what the service said. State holds a check between the
two. The first outcome within the cap settles it; a timer settles the others. When its time is over a check
leaves the state, so that this is bounded by what was submitted within the cap.

Checks share state by a hash of their id, ``BUCKETS`` parts of one value and one timer each: every call for state or timers goes from
Python to the JVM and back, so that a batch makes some for each part it touches and not for each check.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAP_SECONDS = 540
EVENT = ["check_id", "event_time", "kind", "status", "operation_location", "error_message", "write_ok", "failed_call"]
OUTCOME = ("check_id BIGINT, status STRING, operation_location STRING, error_message STRING, write_ok BOOLEAN, failed_call BOOLEAN")
STATE = "checks BINARY, timer BIGINT"
BUCKETS = 2048  # a fixed number, since state is found by it
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Settle(StatefulProcessor):
    """Times are milliseconds: of the events, or with ``clock`` of their arrival.

    A part holds, by check, when it was submitted, whether it is settled, and its first outcome: when, and what was said.
    """

    def __init__(self, cap: int, clock: bool):
        self.cap, self.clock = cap, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.part = handle.getValueState("part", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        checks, timer = self.load()
        now = timerValues.getCurrentProcessingTimeInMs() if self.clock else None
        touched = {}
        for _, _, check, at, kind, *said in rows:
            at = now if self.clock else at
            submitted, settled, outcome = checks.get(check) or (None, False, None)
            if kind == "submitted":
                if submitted is not None and submitted <= at:
                    continue
                submitted = at
            elif outcome is None or at < outcome[0]:
                outcome = (at, *said)
            checks[check] = touched[check] = (submitted, settled, outcome)
        for check, (submitted, settled, outcome) in touched.items():
            if submitted is not None and outcome is not None and not settled:
                checks[check] = (submitted, True, outcome)
                yield self.settled(check, outcome if outcome[0] <= submitted + self.cap else None)
        self.keep(checks, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        checks, timer = self.load()
        now = timerValues.getCurrentProcessingTimeInMs() if self.clock else timerValues.getCurrentWatermarkInMs()
        now = max(now, expiredTimerInfo.getExpiryTimeInMs() + 1)
        left = {}
        for check, held in checks.items():
            if self.ends(held) >= now:
                left[check] = held
            elif held[0] is not None and not held[1]:
                yield self.settled(check, None)
        self.keep(left, None)  # the timer that fired is gone

    def ends(self, held: tuple) -> int:
        """When a check leaves: an outcome without a submission waits for it, no longer than a check waits for its outcome."""
        submitted, _, outcome = held
        return (submitted if submitted is not None else outcome[0]) + self.cap

    def load(self) -> tuple[dict, int | None]:
        if not self.part.exists():
            return {}, None
        checks, timer = self.part.get()
        return pickle.loads(checks), timer

    def keep(self, checks: dict, timer: int | None) -> None:
        """Store a part with a timer at the end of the first check to leave; one without checks goes."""
        first = min(map(self.ends, checks.values()), default=None)
        if timer != first:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        if checks:
            self.part.update((pickle.dumps(checks, pickle.HIGHEST_PROTOCOL), first))
        else:
            self.part.clear()

    def settled(self, check: int, outcome: tuple | None) -> Row:
        if outcome is None:
            late = f"no final state within {self.cap // 1000}s"
            return Row(check_id=check, status="Timeout", operation_location=None, error_message=late, write_ok=True, failed_call=False)
        _, status, operation, message, write_ok, failed_call = outcome
        return Row(check_id=check, status=status, operation_location=operation, error_message=message, write_ok=write_ok, failed_call=failed_call)

    def close(self) -> None:
        pass


def submissions(checks: DataFrame) -> DataFrame:
    """The event of every check that passed the gate, from rows of table ``checks``."""
    text = F.lit(None).cast("string")
    return checks.filter("passed").select(
        "check_id", F.col("checked_at").alias("event_time"), F.lit("submitted").alias("kind"), text.alias("status"),
        text.alias("operation_location"), text.alias("error_message"), F.lit(True).alias("write_ok"), F.lit(False).alias("failed_call"))


def answers(outcomes: DataFrame) -> DataFrame:
    """Events of outcomes (the columns ``route_outcomes`` takes, and ``event_time``)."""
    return outcomes.withColumn("kind", F.lit("outcome")).select(*EVENT)


def settle_stream(events: DataFrame, cap_seconds: int = CAP_SECONDS, delay: str = "1 minute", clock: bool = False) -> DataFrame:
    """A row per check that is settled, by its outcome or as ``Timeout``, ready for ``settle_outcomes``.

    By event time a check has timed out once the watermark, ``delay`` behind the newest event, has passed its cap, and an outcome
    counts by its own time; with ``clock`` both go by the time of arrival. A second outcome, or one after the timeout,
    changes nothing; an outcome that comes before its submission waits for it as long.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = events.filter("check_id IS NOT NULL AND event_time IS NOT NULL").withWatermark("event_time", delay)
    part = F.pmod(F.xxhash64("check_id"), F.lit(BUCKETS)).cast("int")
    rows = rows.select(part.alias("part"), "event_time", "check_id", F.unix_millis("event_time").alias("at"), *EVENT[2:])
    return rows.groupBy("part").transformWithState(
        Settle(1000 * cap_seconds, clock), OUTCOME, "append", "ProcessingTime" if clock else "EventTime")
