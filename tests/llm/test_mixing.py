"""Source weights against direct computation, and the query against its SQL."""

import math

import pytest
from pyspark.sql import functions as F

from checks.compare import difference, duckdb_over
from llm.mixing import OP1_SQL, mixed, op1_source_mixing, plan, realised

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    """Three sources with 600, 120 and 30 words in documents of three words."""
    rows = [(i, "one two three", "big" if i < 200 else "mid" if i < 240 else "small") for i in range(250)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_equals_its_sql(spark):
    got = op1_source_mixing(spark, SF_DIR).toPandas()
    assert difference(got, duckdb_over(SF_DIR).execute(OP1_SQL).df()) is None


def test_the_exponent_meets_an_entropy(docs):
    for target in (0.7, 0.9, 1.05):
        a = plan(docs, entropy=target)[1]["exponent"]
        powers = [p**a for p in (0.8, 0.16, 0.04)]
        weights = [x / sum(powers) for x in powers]
        assert abs(-sum(w * math.log(w) for w in weights) - target) < 1e-6


def test_the_exponent_meets_a_repetition_limit(docs):
    entries, facts = plan(docs, repetitions=4.0)
    assert abs((0.8 / 0.04) ** (1 - facts["exponent"]) - 4.0) < 1e-6
    assert plan(docs, repetitions=1000.0)[1]["exponent"] < 1e-9
    assert abs(plan(docs, repetitions=1.0)[1]["exponent"] - 1.0) < 1e-9
    passes = {r[0]: r[1] for r in entries.groupBy("_source").agg(F.sum("_tokens") / 3).collect()}
    assert passes["big"] == 200 and passes["small"] == 40 and 40 <= passes["mid"] <= 40 * 4


def test_passes_are_whole_but_for_the_last(docs):
    got = mixed(docs, repetitions=2.5, blocks=16)
    per_pass = {(r[0], r[1]): r[2] for r in got.groupBy("source", "_pass").count().collect()}
    assert per_pass["big", 0] == 200 and per_pass["small", 0] == per_pass["small", 1] == 10
    assert per_pass.get(("small", 2), 0) <= 5
    places = got.agg(F.min("_place"), F.max("_place")).first()
    assert 0 <= places[0] < places[1] <= 1


def test_a_smaller_budget_cuts(docs):
    got = mixed(docs, repetitions=1.0, budget=375.0, blocks=64)
    assert 90 <= got.where("source = 'big'").count() <= 100


def test_odd_documents(odd_documents, no_documents):
    got = realised(odd_documents, repetitions=1.0)
    assert got.schema == odd_documents.schema and got.count() >= 12
    assert got.select("_source").distinct().collect() == [("x",)]
    assert got.where("doc_id IS NULL").count() >= 1 and got.where("text IS NULL").count() >= 1
    assert realised(no_documents).count() == 0
    silent = odd_documents.withColumn("text", F.lit(None).cast("string"))
    assert realised(silent).count() == 12


def test_the_plan_has_no_python(spark):
    plan_text = op1_source_mixing(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan_text and "Arrow" not in plan_text
