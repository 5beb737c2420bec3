"""Fingerprints against exact sets of shingles."""

import hashlib

from pyspark.sql import functions as F

from llm.common import read
from llm.fingerprints import (
    as_text,
    containment,
    distinct_count,
    fingerprints,
    merge,
    merge_all,
    op9_fingerprints,
    resemblance,
    with_sketch,
)
from tests.llm.test_ngram_join import shingles

SF_DIR = "/root/testdata/sf0.001"


def test_edited_texts_and_likeness(spark):
    got = {r.doc_id: r for r in op9_fingerprints(spark, SF_DIR).collect()}
    docs = sorted((r.doc_id, r.text) for r in read(spark, SF_DIR, "documents").select("doc_id", "text").collect())
    errors = []
    for (d, text), (_, following) in zip(docs, docs[1:] + docs[:1], strict=True):
        cut = len(text) // 2
        edited = text[: len(text) - cut] + following[:cut]
        assert got[d].n_chars == len(text) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for near, other in ((got[d].near_edited, edited), (got[d].near_next, following)):
            a, b = shingles(text), shingles(other)
            errors.append(near - len(a & b) / max(1, len(a | b)))
    assert len(got) == len(docs) and abs(sum(errors)) / len(errors) < 0.02 and max(map(abs, errors)) < 0.3


def test_estimates(spark):
    words = [f"w{i}" for i in range(3004)]
    rows = [("whole", " ".join(words)), ("part", " ".join(words[:1504])), ("few", " ".join(words[:24]))]
    df = with_sketch(spark.createDataFrame(rows, "name string, text string"), "text", "s", 256)
    s = {r.name: r for r in df.select("name", "s", distinct_count(F.col("s"), 256).alias("n")).collect()}
    assert abs(s["whole"].n / 3000 - 1) < 0.2 and abs(s["part"].n / 1500 - 1) < 0.2 and s["few"].n == 20
    a, b = (df.where(F.col("name") == n).select(F.col("s").alias(n)) for n in ("whole", "part"))
    pair = a.join(b, F.lit(True)).select(
        resemblance(F.col("whole"), F.col("part"), 256).alias("r"),
        containment(F.col("part"), F.col("whole"), 256).alias("c"),
        (merge(F.col("whole"), F.col("part"), 256) == F.col("whole")).alias("m"),
    )
    r = pair.first()
    assert abs(r.r - 0.5) < 0.12 and r.c > 0.75 and r.m


def test_parts_merge_to_the_whole(spark):
    words = [f"w{i}" for i in range(500)]
    parts = [(i % 2, " ".join(words[i * 10 : i * 10 + 14])) for i in range(49)] + [(0, ""), (1, None)]
    df = with_sketch(spark.createDataFrame(parts, "g int, text string"), "text", "s", 32)
    whole = with_sketch(spark.createDataFrame([(" ".join(words[:494]),)], "text string"), "text", "s", 32).first().s
    merged = merge_all(df.withColumn("all", F.lit(1)), "s", "all", k=32).first().s
    assert merged == whole and merge_all(df, "s", "g", k=32).count() == 2


def test_odd_documents(odd_documents, no_documents):
    got = fingerprints(odd_documents).collect()
    assert len(got) == 12 and len({r.fingerprint for r in got if r.doc_id in (1, 2)}) == 1
    empty = [r for r in got if r.doc_id in (4, 5, 6)]
    assert all(r.fingerprint == "" for r in empty) and [r.near_next for r in sorted(empty, key=lambda r: r.doc_id)] == [1.0, 1.0, 0.0]
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    order = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in odd_documents.collect()))
    texts = [t for _, _, t in order]
    want = sorted(hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest() for t, n in zip(texts, texts[1:] + texts[:1], strict=True))
    assert sorted(r.edited_sha256 for r in got) == want
    assert fingerprints(no_documents).count() == 0
    alone = fingerprints(odd_documents.where("doc_id = 1")).first()
    assert alone.near_next == 1.0


def test_text_form(spark):
    assert spark.range(1).select(as_text(F.array(F.lit(-1), F.lit(10))).alias("t")).first().t == "f" * 16 + "0" * 15 + "a"


def test_the_plan_has_no_python(spark):
    plan = op9_fingerprints(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
