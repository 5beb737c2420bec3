"""Exact deduplication against a plain grouping by text."""

import hashlib
import random
import re

import pytest

from checks.compare import difference, duckdb_over
from llm.exact_dedup import OP11_SQL, STORE, ExactDedup, decisions, op11_exact_dedup

SF = "/root/testdata/sf0.001"


def plainly(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for content, members in groups.items():
        best = min(members)
        first = True
        for m in sorted(members):
            out.append((m[3], best[3], len(members), m[:3] == best[:3] and first, hashlib.sha256(content.encode()).hexdigest()))
            first = first and m[:3] != best[:3]
    return sorted(out, key=str)


def columns(df):
    return sorted((tuple(r) for r in df.drop("keep_file", "keep_row").collect()), key=str)


def corpus(seed, n=300):
    r = random.Random(seed)
    texts = ["".join(r.choice("ab é\t\n\x0b\U0001f642") for _ in range(r.randrange(8))) for _ in range(n)]
    return [(i if r.random() < 0.9 else r.choice([None, 1]), r.choice([t, None]) if r.random() < 0.1 else t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_equals_a_plain_grouping(spark, tmp_path, digest_bytes):
    rows = corpus(3)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/in")
    assert columns(decisions(spark, f"{tmp_path}/in", digest_bytes=digest_bytes)) == plainly(rows)


def test_the_state_outlives_a_run(spark, tmp_path):
    rows, path, folder = corpus(4), f"{tmp_path}/in", f"{tmp_path}/kept"
    for at in (0, 100, 200):
        spark.createDataFrame(rows[at : at + 100], "doc_id long, text string").coalesce(2).write.mode("append").parquet(path)
        got = decisions(spark, path, folder)
        assert columns(got) == plainly(rows[: at + 100])
    read = spark.read.parquet(f"{folder}/digests").count()
    assert read == 300  # every row once, whatever the number of runs
    assert columns(decisions(spark, path, folder)) == plainly(rows)


def test_locators_lead_to_the_content(spark, tmp_path):
    rows = corpus(5, 60)
    path = f"{tmp_path}/in"
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(path)
    got = decisions(spark, path)
    content = spark.read.parquet(path)
    at = content.metadataColumn("_metadata")
    content = content.select("text", at["file_path"].alias("keep_file"), at["row_index"].alias("keep_row"))
    for r in got.join(content, ["keep_file", "keep_row"]).collect():
        assert hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", "", r.text or "").encode()).hexdigest() == r.text_sha256


def test_odd_documents(spark, odd_documents, no_documents, tmp_path):
    odd_documents.withColumnRenamed("row_key", "_metadata").withColumnRenamed("spans", "digest").write.parquet(f"{tmp_path}/odd")
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert columns(decisions(spark, f"{tmp_path}/odd")) == plainly(rows)
    no_documents.write.parquet(f"{tmp_path}/none")
    assert decisions(spark, f"{tmp_path}/none").count() == 0


def test_one_file_and_the_sessions_own_store(spark):
    before = spark.conf.get(STORE)
    got = op11_exact_dedup(spark, SF)
    assert spark.conf.get(STORE) == before
    assert difference(got.toPandas(), duckdb_over(SF).execute(OP11_SQL).df()) is None


def test_a_hot_text_is_combined_before_its_shuffle(spark, tmp_path):
    hot = [(i, "same text") for i in range(3000)] + [(i, f"t{i}") for i in range(3000, 4000)]
    spark.createDataFrame(hot, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/in")
    held = ExactDedup(spark, f"{tmp_path}/in").run().state()
    assert held.count() == 1001 and held.where("size = 3000").count() == 1
