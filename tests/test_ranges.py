"""Id ranges of about equal rows."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rulefold.sources.ingest import TableImport
from rulefold.sources.ranges import IdRange, equal_ranges
from rulefold.sources.tables import FrameSource, JdbcSource


def counts_of(ids, asked=None):
    def counts(within, origin, width):
        if asked is not None:
            asked.append(len(within))
        inside = [i for i in ids if any(low <= i <= high for low, high in within)]
        return dict(Counter(i - (i - origin) % width for i in inside))

    return counts


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(10**12), 10**12), min_size=40, max_size=400), st.integers(1, 20))
def test_ranges_of_distinct_ids_are_nearly_equal(ids, parts):
    ids = sorted(ids)
    bounds = IdRange(ids[0], ids[-1])
    ranges = equal_ranges(counts_of(ids), bounds, ranges=parts)
    assert (ranges[0].low, ranges[-1].high) == (bounds.low, bounds.high)
    assert all(a.high + 1 == b.low for a, b in zip(ranges, ranges[1:], strict=False))
    sizes = [bisect_right(ids, r.high) - bisect_left(ids, r.low) for r in ranges]
    assert sum(sizes) == len(ids) and max(sizes) <= len(ids) / parts * 1.25 + 1


def test_a_gap_and_a_hot_id():
    ids = list(range(1000)) + list(range(10**9, 10**9 + 1000)) + [10**9 + 5] * 5000
    asked = []
    ranges = equal_ranges(counts_of(ids, asked), IdRange(0, 10**9 + 999), rows=500)
    sizes = [sum(r.low <= i <= r.high for i in ids) for r in ranges]
    assert sum(sizes) == len(ids)
    hot = next(n for n, r in enumerate(ranges) if r.low <= 10**9 + 5 <= r.high)
    assert all(n <= 625 for k, n in enumerate(sizes) if k != hot) and sizes[hot] <= 5000 + 625
    assert len(asked) <= 8


@pytest.mark.parametrize("ids", [[7], [7] * 9, [-3, 4]])
def test_few_ids(ids):
    ranges = equal_ranges(counts_of(ids), IdRange(min(ids), max(ids)), ranges=4)
    assert ranges[0].low == min(ids) and ranges[-1].high == max(ids)
    assert equal_ranges(counts_of([]), IdRange(1, 9), rows=3) == [IdRange(1, 9)]
    with pytest.raises(ValueError, match="positive"):
        equal_ranges(counts_of(ids), IdRange(1, 2))


def test_frames_count_as_plain_python_does(spark):
    ids = [-50, -49, -1, 0, 3, 3, 900, 10**12]
    frame = FrameSource({"findings": spark.createDataFrame([(i,) for i in [*ids, None]], "id long")})
    within, origin, width = [(-50, 10), (900, 10**12)], -50, 16
    assert frame.id_counts(spark, "findings", "id", within, origin, width) == counts_of(ids)(within, origin, width)
    step = TableImport("findings", 2, rows_per_batch=4)
    batches = step.batches(spark, frame, (-50, 10**12))
    assert sum(step.read(spark, frame, b).count() for b in batches) == len(ids)
    assert step.batches(spark, frame, (-50, 10**12), max_id=-51) == []
    assert step.batches(spark, frame, (-50, 10**12), max_id=3)[-1].high == 3


class Calls:
    """Stands in for a session and remembers how it reads."""

    def __init__(self):
        self.asked = {}
        self.read = self

    def jdbc(self, **options):
        self.asked = options
        return self

    def collect(self):
        return [{"slot": 3, "table_rows": 9}]


def test_databases_count_slots_and_read_one_task_per_range():
    calls, source = Calls(), JdbcSource("jdbc:x:y")
    assert source.id_counts(calls, "t", "id", [(1, 8), (20, 30)], 1, 4) == {3: 9}
    assert calls.asked["table"] == (
        "(SELECT slot, count(*) AS table_rows FROM (SELECT id - MOD(id - (1), 4) AS slot FROM t "
        "WHERE id BETWEEN 1 AND 8 OR id BETWEEN 20 AND 30) AS ids GROUP BY slot) AS counted"
    )
    source.read_ranges(calls, "t", "id", [(1, 8), (9, 30)])
    assert calls.asked["predicates"] == ["id BETWEEN 1 AND 8", "id BETWEEN 9 AND 30"]
