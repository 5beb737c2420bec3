"""The pipeline's stages, each against what it must keep and do."""

import hashlib

import sentencepiece

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from llm.common import read, stored
from llm.sentencepiece_codec import default_model
from tests.llm.test_ngram_join import by_all_pairs
from tests.llm.test_suffix_dedup import by_all_windows

SF_DIR = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = read(spark, SF_DIR, "documents")
    columns, results = docs.columns, [docs]
    for name, stage in pipeline.STAGES:
        results.append(stored(stage(spark, results[-1], SF_DIR), name))
    assert all(r.columns == columns for r in results[:-1])
    pairs = [{r.doc_id: r.text for r in df.select("doc_id", "text").collect()} for df in results[:-1]]
    raw, identified, single, cut, mixed = pairs
    assert set(identified) <= set(raw) and len(identified) > 0.97 * len(raw)
    rows = sorted(identified.items())
    assert set(single) == {d for d, _, c in by_all_pairs(rows) if d == c}
    want = {d: (removed, sha) for d, _, removed, _, sha in by_all_windows(sorted(single.items()), 400)}
    assert set(cut) == set(single)
    for d, text in cut.items():
        assert len(text.encode()) <= len(single[d].encode()) - want[d][0]
        if len(text.encode()) == len(single[d].encode()) - want[d][0]:
            assert hashlib.sha256(text.encode()).hexdigest() == want[d][1]
    assert mixed == cut  # no document is lost, small sources repeat
    repeats = {r.source: r["count"] for r in results[4].groupBy("source").count().collect()}
    once = {r.source: r["count"] for r in results[3].groupBy("source").count().collect()}
    assert all(once[s] <= repeats[s] <= 2 * once[s] for s in once)
    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    for r in results[5].collect():
        ids = library.encode(mixed[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_registered():
    queries, sql = contract.queries(), contract.oracle_sql()
    ours = [n for n in queries if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in ours] == list(range(1, 14)) and "pipeline" in queries
    assert {n for n in sql if n.startswith("op")} == {n for n in ours if n.split("_")[0] in ("op1", "op3", "op4", "op8", "op11", "op13")}
    assert "pipeline" not in sql and pipeline.ORACLE_SQL is None


def test_an_empty_table_passes_all_stages(spark):
    docs = read(spark, SF_DIR, "documents").limit(0)
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
    assert docs.count() == 0
