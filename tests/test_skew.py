"""Joins and expansions over hot keys give what the plain operators give."""

import pytest
from pyspark.sql import functions as F

from rulefold.operators.skew import (
    COPIES,
    copies_by_key,
    expand_copies,
    materialize,
    skew_join,
)
from tests.helpers import rows_of


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 9,000 rows has key 7, another third has none."""
    return spark.range(9000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN id % 500 END AS key", "id % 2 AS tenant"
    )


@pytest.fixture(scope="module")
def names(spark):
    """Key 7 occurs twice, keys from 400 on are missing."""
    return spark.range(400).selectExpr("id AS k", "concat('n', id) AS name").unionByName(
        spark.sql("SELECT 7L AS k, 'again' AS name")
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_the_plain_join(skewed, names, no_broadcast, how):
    got = skew_join(skewed, names, "key", "k", how, "id")
    want = skewed.join(names, F.col("key") == F.col("k"), how).drop("k")
    assert got.columns == want.columns
    assert rows_of(got) == rows_of(want)


def test_rows_without_a_key_spread_over_partitions(spark, skewed, names, no_broadcast):
    joined = skew_join(skewed.where("key IS NULL"), names, "key", "k", "left", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 0.4 * sum(sizes)


def test_adaptive_execution_can_cut_a_hot_key_after_another_join_on_it(spark, names, no_broadcast):
    """A key with a hundredth of the rows, in partitions that are small without it."""
    left = spark.range(400_000).selectExpr("id", "CASE WHEN id % 100 = 0 THEN 7 ELSE id END AS key", "repeat('x', 50) AS pad")
    other = names.groupBy("k").agg(F.max("name").alias("other"))
    right = names.join(other, "k")  # already partitioned by the key
    small = {
        "spark.sql.shuffle.partitions": "200",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        joined = skew_join(left, right, "key", "k", "inner", "id")
        assert joined.count() == 4000 * 2 + sum(1 for n in range(400) if n % 100 and n != 7) + 2
        counted = joined.select("id", "name")
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_shared_columns_must_agree(skewed, names, no_broadcast):
    by_tenant = names.withColumn("tenant", F.col("k") % 2)
    got = skew_join(skewed, by_tenant, "key", "k", "left", "id", shared=["tenant"])
    other = by_tenant.withColumnRenamed("tenant", "t")
    want = skewed.join(other, (F.col("key") == F.col("k")) & (F.col("tenant") == F.col("t")), "left")
    assert rows_of(got) == rows_of(want.drop("k", "t"))


def test_small_sides_are_broadcast(skewed, names):
    plan = skew_join(skewed, names, "key", "k", "left", "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_other_join_types_are_refused(skewed, names):
    with pytest.raises(ValueError):
        skew_join(skewed, names, "key", "k", "full", "id")


def test_copies_by_key_counts_what_a_join_would_multiply(skewed, names):
    counted = copies_by_key(names, "k")
    assert rows_of(counted.where(F.col(COPIES) > 1)) == [(7, 2)]
    assert counted.count() == 400


def test_expand_copies_writes_every_copy_once(spark):
    df = spark.createDataFrame([("a", 1), ("b", 25), ("c", 10), ("d", 11)], "id string, row_copies long")
    got = expand_copies(df, per_piece=10)
    want = [(k, n) for k, count in (("a", 1), ("b", 25), ("c", 10), ("d", 11)) for n in range(count)]
    assert rows_of(got, "id", "copy_number") == sorted(want, key=repr)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_rows_without_copies_stay(spark):
    df = spark.createDataFrame([("a",)], "id string")
    assert rows_of(expand_copies(df)) == [("a", 0)]


def test_materialize_keeps_the_rows_and_cuts_the_plan(skewed):
    stored = materialize(skewed.groupBy("tenant").count())
    assert rows_of(stored) == [(0, 4500), (1, 4500)]
    assert "Aggregate" not in stored._jdf.queryExecution().optimizedPlan().toString()


def test_materialize_writes_to_the_folder_it_is_given(skewed, tmp_path):
    stored = materialize(skewed, str(tmp_path))
    assert stored.count() == 9000 and any(tmp_path.glob("stored-*/*.parquet"))
