"""Differences by digests of ranges, against brute force."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rulefold.operators import digests
from rulefold.operators.digests import changed_ranges, range_difference

SCHEMA = "group_identifier string, finding_id long, tags array<string>"


def expected_rows(left, right, distinct):
    a, b = Counter(left), Counter(right)
    if distinct:
        a, b = Counter(set(left)), Counter(set(right))
    both = [(*row, "missing") for row in (a - b).elements()] + [(*row, "unexpected") for row in (b - a).elements()]
    return Counter(both)


def difference_rows(spark, left, right, **options):
    def frame(rows):
        return spark.createDataFrame([(g, n, None if t is None else list(t)) for g, n, t in rows], SCHEMA)

    rows = range_difference(frame(left), frame(right), **options).collect()
    return Counter((r[0], r[1], None if r[2] is None else tuple(r[2]), r[3]) for r in rows)


LEFT = [(f"g{n % 7}", n, None if n % 5 == 0 else ("a", None, str(n % 3))) for n in range(400)]
LEFT += LEFT[:5] * 3 + [(None, 1, None), (None, None, None), ("x", None, ())] * 2


@pytest.mark.parametrize("distinct", [True, False])
@pytest.mark.parametrize("most", [digests.MOST_RANGES, 3])
def test_differences_equal_brute_force(spark, monkeypatch, distinct, most):
    monkeypatch.setattr(digests, "MOST_RANGES", most)
    right = LEFT[3:390] + [("new", n, None) for n in range(9)] + LEFT[400:] + LEFT[50:60] * 2 + [(None, None, None)]
    got = difference_rows(spark, LEFT, right, distinct=distinct)
    assert got == expected_rows(LEFT, right, distinct)


@pytest.mark.parametrize(("left", "right"), [(LEFT, LEFT), (LEFT, []), ([], LEFT), ([], []), (LEFT, LEFT[::-1])])
def test_equal_empty_and_shuffled_tables(spark, left, right):
    assert difference_rows(spark, left, right, distinct=False) == expected_rows(left, right, False)


def test_a_null_that_moves_is_a_difference(spark):
    left = spark.createDataFrame([("a", None, ["x", None])], "p string, q string, r array<string>")
    for right in ([(None, "a", ["x", None])], [("a", None, [None, "x"])]):
        other = spark.createDataFrame(right, left.schema)
        assert range_difference(left, other, distinct=False).count() == 2


def test_rows_of_equal_ranges_are_not_shuffled(spark):
    big = spark.range(100_000).select(F.col("id").cast("string").alias("group_identifier"), "id")
    other = big.where("id <> 77")
    level, ranges = changed_ranges(big, other)
    assert level >= 1 and len(ranges) == 1
    left = digests.within_ranges(big, digests.row_hash(big), level, ranges)
    assert left.count() <= 100_000 // 4096 * 3
    assert [tuple(r) for r in range_difference(big, other).collect()] == [("77", 77, "missing")]
