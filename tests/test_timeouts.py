"""State of many checks in one part: few calls for it, each check by itself."""

import datetime
import random
from types import SimpleNamespace

from docpulse.streaming.timeouts import BUCKETS, Settle, settle_stream


class Value:
    """A value of state that counts the calls for it, and the part's timers."""

    def __init__(self):
        self.held, self.calls, self.timers = None, 0, set()

    def getValueState(self, name, schema):
        return self

    def called(self, result=None):
        self.calls += 1
        return result

    def exists(self):
        return self.called(self.held is not None)

    def get(self):
        return self.called(self.held)

    def update(self, value):
        self.held = self.called(value)

    def clear(self):
        self.held = self.called()

    def registerTimer(self, at):
        self.called(self.timers.add(at))

    def deleteTimer(self, at):
        self.called(self.timers.remove(at))


def batch(settle, state, rows, watermark):
    times = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
    said = list(settle.handleInputRows((0,), iter([(0, None, c, at, kind, status, "op", None, True, False) for c, at, kind, status in rows]), times))
    for at in sorted(t for t in state.timers if t < watermark):
        said += settle.handleExpiredTimer((0,), times, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at))
        state.timers.discard(at)
    return {r.check_id: r.status for r in said}


def test_a_part_takes_few_calls():
    settle, state = Settle(540_000, False), Value()
    settle.init(state)
    start = 1_000_000
    rows = [(c, start + c, "submitted", None) for c in range(3_000)]
    rows += [(c, start + c + (540_000 if c % 3 else 540_001), "outcome", "Succeeded") for c in range(2_000)]
    random.Random(1).shuffle(rows)
    got = batch(settle, state, rows, 0)
    assert got == {c: "Succeeded" if c % 3 else "Timeout" for c in range(2_000)}
    assert state.calls < 10 and state.timers == {start + 540_000}
    got = batch(settle, state, [(0, start, "outcome", "Failed"), (2_500, start, "outcome", "Failed")], start + 540_000 + 2_900)
    assert got == {2_500: "Failed", **{c: "Timeout" for c in range(2_000, 2_900) if c != 2_500}}
    assert state.timers == {start + 540_000 + 2_900} and state.calls < 25
    assert batch(settle, state, [], start + 10_000_000) == {c: "Timeout" for c in range(2_900, 3_000)}
    assert state.held is None and not state.timers


def test_checks_of_one_part_in_a_stream(spark, folder):
    """More checks than parts, over two batches and a later clock."""
    schema = "check_id BIGINT, event_time TIMESTAMP, kind STRING, status STRING, operation_location STRING, error_message STRING, write_ok BOOLEAN, failed_call BOOLEAN"
    start, n = datetime.datetime(2024, 1, 1), BUCKETS + 500
    event = lambda c, s, status: (c, start + datetime.timedelta(seconds=s), "outcome" if status else "submitted", status, None, None, True, False)
    for rows in ([event(c, c % 7, None) for c in range(n)], [event(c, 100, "Succeeded") for c in range(0, n, 2)], [event(-1, 100_000, "Failed")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/events")
        settle_stream(spark.readStream.schema(schema).parquet(f"{folder}/events"), delay="600 seconds").writeStream.format("parquet").option(
            "path", f"{folder}/out").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start().awaitTermination()
    got = [(r.check_id, r.status) for r in spark.read.parquet(f"{folder}/out").collect()]
    assert sorted(got) == [(c, "Timeout" if c % 2 else "Succeeded") for c in range(n)]
