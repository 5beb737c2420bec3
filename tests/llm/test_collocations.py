"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

import llm.collocations as co
from checks.compare import difference
from llm.collocations import OP13_SQL, Bloom, accepted, collocations, double_array, op13_collocations, words_of
from llm.common import RollingHash

SCHEMA = "doc_id long, text string, lang string"


def plainly(rows, top=2000):
    counts, totals, names = Counter(), Counter(), {}
    for _, text, lang in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                counts.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    out = {}
    for (lang, *words), a in counts.items():
        if len(words) < 2 or a < 10:
            continue
        if len(words) == 2 and any(
            n >= 10 and 100 * n >= 50 * a for (other, *w), n in counts.items() if other == lang and len(w) == 3 and (w[:2] == words or w[1:] == words)
        ):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    rows = []
    for lang, found in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(rows)


def corpus(seed, n=300):
    r = random.Random(seed)
    vocabulary = ["The", "of", "été", "日本", "x", "Y", "\U0001f642", "a1", "-", "\xa0nb"] + [f"w{i}" for i in range(30)]
    fixed = ["new york city", "of the", "Été x", "q r s t"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(r.randrange(40)):
            words.append(r.choice(fixed) if r.random() < 0.2 else r.choice(vocabulary[: r.choice([3, 40])]))
            words.append(r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", "; "]))
        rows.append((i, "".join(words), r.choice(["en", "fr", None, "und"])))
    return rows + [(1, None, "en"), (2, "", "en"), (3, "alone", "xx"), (4, "hot pair " * 400, "en")]


@pytest.mark.parametrize("shard, bits, block", [(1 << 20, 1 << 27, 1 << 21), (20, 64, 300)])
def test_equals_a_plain_count(spark, monkeypatch, shard, bits, block):
    monkeypatch.setattr(co, "SHARD_PHRASES", shard)  # many shards, several passes
    monkeypatch.setattr(co, "FILTER_BITS", bits)  # a filter that holds everything
    monkeypatch.setattr(co, "BLOCK", block)
    rows = corpus(1)
    got = collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), top=30)
    assert sorted(tuple(r) for r in got.collect()) == plainly(rows, 30)


def test_texts_are_read_as_often_however_many_candidates_there_are(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(4, 120), SCHEMA).coalesce(2)
    found = []
    for shard in (1 << 20, 2):  # all candidates at once, or tries of two phrases
        monkeypatch.setattr(co, "SHARD_PHRASES", shard)
        reads = spark.sparkContext.accumulator(0)

        def read(batches, reads=reads):
            reads.add(1)
            yield from batches

        rows = collocations(docs.mapInArrow(read, SCHEMA), top=30).collect()
        found.append((reads.value, sorted(tuple(r) for r in rows)))
    assert found[0] == found[1] and len(found[0][1]) > 20


def test_query_and_sql(spark, tmp_path):
    rows = corpus(2)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = op13_collocations(spark, str(tmp_path))
    assert difference(got.toPandas(), con.execute(OP13_SQL).df()) is None
    assert sorted(tuple(r) for r in got.collect()) == plainly(rows)


@pytest.mark.parametrize("seed", range(4))
def test_double_array_accepts_its_phrases_only(seed):
    r = np.random.default_rng(seed)
    letters = r.integers(1, 1 << 60, 40).astype(np.uint64)
    text = letters[np.minimum(r.geometric(0.15, 3000) - 1, 39)]
    wanted = sorted({tuple(r.choice(letters, r.integers(2, 4))) for _ in range(300)} | {tuple(text[i : i + 2]) for i in range(0, 90, 3)})
    sizes = np.array([len(x) for x in wanted])
    phrases = np.array([(*x, 0)[:3] for x in wanted], np.uint64)
    trie = double_array(phrases, sizes)
    hashes = RollingHash()
    words = words_of(hashes, np.frombuffer(b"a " * 3000, np.uint8), np.array([0, 6000]), np.zeros(1, np.uint64))
    words.symbols = text
    words.follows[r.integers(0, 3000, 200)] = False
    found = Counter(accepted(trie, words).tolist())
    for number, phrase in enumerate(wanted):
        k = len(phrase)
        places = [i for i in range(3000 - k + 1) if tuple(text[i : i + k]) == phrase and words.follows[i : i + k - 1].all()]
        assert found.get(number, 0) == len(places)


def test_filters_never_miss():
    values = np.random.default_rng(1).integers(0, 1 << 40, 500).astype(np.uint64)
    for bits in (64, 1 << 14):
        words = np.zeros(bits // 64, np.uint64)
        for word, bit in co._probes(values, bits):
            np.bitwise_or.at(words, word, np.uint64(1) << bit)
        assert Bloom(words).holds(values).all()


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r.doc_id, r.text, r.lang) for r in odd_documents.collect()]
    assert sorted(tuple(r) for r in collocations(odd_documents).collect()) == plainly(rows)
    many = odd_documents
    for _ in range(3):
        many = many.unionByName(many)
    assert sorted(tuple(r) for r in collocations(many.where("length(text) < 1000")).collect()) == plainly(
        [r for r in rows * 8 if r[1] is not None and len(r[1]) < 1000]
    )
    assert collocations(no_documents).count() == 0
