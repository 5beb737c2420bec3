"""Held-out accuracy, and parts of the training."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.common import read
from llm.language_id import LEAST_SCORE, UNKNOWN, held_out, keep_identified, op5_language_id, predict, temperature, train

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op5_language_id(spark, SF_DIR)
    docs = read(spark, SF_DIR, "documents").select("doc_id", "lang")
    joined = got.join(docs, "doc_id").groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"))
    right = {r.held_out: r.right for r in joined.collect()}
    assert right[True] > 0.98 and right[False] > 0.98
    scores = got.agg(F.min("score"), F.max("score")).first()
    assert 0 <= scores[0] <= scores[1] <= 1


def test_held_out_rows_are_a_fifth_by_id(spark):
    assert 150 < spark.range(1000).withColumnRenamed("id", "doc_id").where(held_out()).count() < 250


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = read(spark, SF_DIR, "documents").select("doc_id", "text", "lang").where("doc_id < 200")
    other = docs.withColumn("lang", F.when(held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (train(d.where(~held_out()), 256) for d in (docs, other))
    assert a[0] == b[0] and np.array_equal(a[1], b[1])


def test_calibration_finds_the_temperature():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3))
    p = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    truth = np.array([rng.choice(3, p=row) for row in p])
    assert 2.6 < temperature(3 * logits, truth) < 3.4


def test_scores_are_probabilities_and_strangers_are_rejected(spark):
    docs = read(spark, SF_DIR, "documents")
    langs, table = train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    draw, parts = np.random.default_rng(1), []
    for r in docs.where(held_out()).select("lang", "text").collect():
        words = r.text.split()
        for size in (2, 4, 8, 16, len(words)):
            at = int(draw.integers(0, max(1, len(words) - size)))
            parts.append((size, r.lang, " ".join(words[at : at + size])))
    got = predict(spark.createDataFrame(parts, "size int, lang string, text string").coalesce(2), langs, table).collect()
    bins = {}
    for r in got:
        bins.setdefault(min(int(10 * r.score), 9), []).append(r.score - (r.lang == r.lang_pred))
    assert sum(abs(sum(b)) for b in bins.values()) / len(got) < 0.05
    assert np.mean([r.score < LEAST_SCORE for r in got]) < 0.02
    strange = ["xqzv kkjw pqpq zzxx", "Ελληνική πρόταση για δοκιμή", "日本語の文章をここに書きます", "Привет как дела сегодня"]
    for r in predict(spark.createDataFrame([(t,) for t in strange], "text string"), langs, table).collect():
        assert r.score < LEAST_SCORE
    mixed = docs.limit(20).unionByName(spark.createDataFrame([(-1 - i, t, "en", "s", 9) for i, t in enumerate(strange)], docs.schema))
    kept = predict(mixed, langs, table).where(F.col("score") >= LEAST_SCORE)
    assert kept.count() == 20 and kept.where("doc_id < 0").count() == 0


def test_too_many_languages_are_refused(spark):
    docs = spark.range(600).selectExpr("id AS doc_id", "'some text' AS text", "concat('l', id) AS lang")
    with pytest.raises(ValueError, match="languages"):
        train(docs)


def test_odd_documents(spark, odd_documents, no_documents):
    langs, table = train(odd_documents.select("doc_id", "text", "lang"), 64)
    assert langs == ["en", "fr"]
    got = predict(odd_documents.select("doc_id", "text"), langs, table).collect()
    assert len(got) == 12
    for r in got:
        assert (r.lang_pred == UNKNOWN) == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1
    kept = keep_identified(odd_documents)
    scored = [r.score for r in predict(odd_documents.drop("score"), *train(odd_documents.where(~held_out()))).collect()]
    assert kept.columns == odd_documents.columns and kept.count() == sum(x >= LEAST_SCORE for x in scored) > 0
    assert kept.select("score").distinct().collect() == [(0.5,)]
    assert keep_identified(no_documents).count() == 0
    langs, table = train(odd_documents.where("lang IS NULL").select("doc_id", "text", "lang"))
    assert langs == [] and predict(odd_documents, langs, table).where("lang_pred <> 'und'").count() == 0


def test_a_language_rarer_than_the_sample_is_learned(spark):
    common = [(n, f"the cat and the dog number {n} went over there", "en") for n in range(900)]
    common += [(n, f"le chat et le chien numero {n} sont dans la maison", "fr") for n in range(900, 1800)]
    rare = [(n, f"kissa ja koira yksi {n} menivat yhdessa kotiin", "fi") for n in range(5000, 5003)]
    docs = spark.createDataFrame([*common, *rare], "doc_id long, text string, lang string")
    smallest = docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(64)
    assert smallest.where("lang = 'fi'").count() == 0
    langs, table = train(docs, 64)
    assert langs == ["en", "fi", "fr"]
    got = predict(docs, langs, table).groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).collect()
    assert dict(got)["fi"] == 1 and min(dict(got).values()) > 0.95
