"""What a bucket of retries asks of its state: a call for many messages, not one or two for each."""

import pandas as pd

from quillspark.streaming.stateful import Retries


class Held:
    """State and timers in memory, with a count of calls."""

    def __init__(self):
        self.rows, self.due, self.timers, self.calls = [], None, set(), 0

    def getListState(self, *_):  # noqa: N802
        return self.List(self)

    def getValueState(self, *_):  # noqa: N802
        return self.Value(self)

    def registerTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.discard(at)

    class Part:
        def __init__(self, of):
            self.of = of

    class List(Part):
        def appendList(self, rows):  # noqa: N802
            self.of.calls += 1
            self.of.rows += rows

        def appendValue(self, row):  # noqa: N802
            self.appendList([row])

        def get(self):
            self.of.calls += 1
            return iter(list(self.of.rows))

        def put(self, rows):
            self.of.calls += 1
            self.of.rows = list(rows)

        def clear(self):
            self.put([])

    class Value(Part):
        def exists(self):
            self.of.calls += 1
            return self.of.due is not None

        def get(self):
            self.of.calls += 1
            return (self.of.due,)

        def update(self, row):
            self.of.calls += 1
            self.of.due = row[0]

        def clear(self):
            self.of.calls += 1
            self.of.due = None


class Times:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.at

    def getExpiryTimeInMs(self):  # noqa: N802
        return self.at


def test_calls_do_not_grow_with_messages():
    held, bucket = Held(), Retries(True)
    bucket.init(held)
    rows = pd.DataFrame({"message_id": [f"m{k}" for k in range(3000)], "value": None, "count_": [k % 6 for k in range(3000)], "failed_ms": [100 * k for k in range(3000)]})
    dead = pd.concat(bucket.handleInputRows((0,), iter([rows[:2000], rows[2000:]]), Times(0)))
    assert len(dead) == 1000 and set(dead.retry_count) == {4, 5} and set(dead.route) == {"dead"}
    assert len(held.rows) == 2000 and held.timers == {1000} and held.calls <= 8
    back = pd.concat(bucket.handleExpiredTimer((0,), Times(100_000), Times(1000)))
    want = {(f"m{k}", k % 6 + 1, 100 * k + 1000 * 2 ** (k % 6)) for k in range(3000) if k % 6 < 4}
    soon = {x for x in want if x[2] <= 100_000}
    assert {(x.message_id, x.retry_count, x.due.value // 1_000_000) for x in back.itertuples()} == soon and set(back.route) == {"retry"}
    assert held.timers - {1000} == {min(x[2] for x in want - soon)} and held.calls <= 14
    late = pd.DataFrame({"message_id": ["x"], "value": ["v"], "count_": [0], "failed_ms": [99_500]})
    assert list(bucket.handleInputRows((0,), iter([late]), Times(100_000))) == []
    assert held.timers - {1000} == {min(100_500, min(x[2] for x in want - soon))}
    rest = pd.concat(bucket.handleExpiredTimer((0,), Times(10_000_000), Times(100_500)))
    assert len(rest) == len(want) - len(soon) + 1 and held.rows == [] and held.due is None
