"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased and cut into all their 1- to 3-grams of code points, hashed into a
fixed number of buckets. Document frequencies come from all training rows. The weights are
trained with follow-the-regularised-leader under L1 and L2 penalties on at most
``train_rows`` training rows (those with the smallest hash of the id; a documented bound). A
language with fewer than ``LEAST_ROWS`` of them takes part with its own ``LEAST_ROWS`` rows of
smallest hash, so that every labelled language is learned however rare it is. A fifth of
each other language is kept back to fit the temperature of the softmax, on whole rows and on
short excerpts of them. Prediction reads whole texts: the weight of an n-gram already holds its
IDF, and frequencies are relative, so a score is the mean of a table's rows over the n-grams of
the text. It is multiplied by how familiar the n-grams are: a text that none of the learned
languages would write scores low, whichever of them is the likeliest. More than ``MOST_LABELS``
different labels are refused before anything is collected.

Rows whose text is null or has no letter get ``und`` and score 0. Null labels are not
learned from; without any labelled row with letters every prediction is ``und``. Repeated rows count as
often as they occur. An empty table gives an empty result. Extra columns are not read, and
neither label, source nor id enters a prediction.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from llm.common import bounded_batches, by_bytes, mix64, read

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
TRAIN_ROWS, LEAST_ROWS = 4096, 64
ALPHA, BETA, L1, L2, EPOCHS = 0.3, 1.0, 0.02, 0.02, 3
SCALE = 100.0
EXCERPTS = (5, 10, 20, 40)  # n-grams
MOST_LABELS = 512
LEAST_SCORE = 0.5
SLICE_BYTES = 256 << 10
UNKNOWN = "und"


def held_out(id_column: str = "doc_id") -> Column:
    """Rows never learned from: a fifth, by the id alone."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all texts and the text number of each, orders one by one."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    buckets, owners = [], []
    value = points
    for order in range(1, max(ORDERS) + 1):
        if order > 1:
            value = value[:-1] * np.uint64(0x100000001B3) + points[order - 1 :]
        if order in ORDERS:
            same = slice(None) if order == 1 else owner[: len(value)] == owner[order - 1 :]
            salted = value[same] + np.uint64(order << 56)
            buckets.append((mix64(salted) & np.uint64(BUCKETS - 1)).astype(np.int32))
            owners.append(owner[: len(value)][same])
    return np.concatenate(buckets), np.concatenate(owners)


def _lowered(batch: pa.RecordBatch) -> list[str]:
    return [(text or "").lower() for text in batch.column("text").to_pylist()]


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of rows of ``docs`` and, per bucket, of rows that hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in by_bytes(batches, "text", SLICE_BYTES, 256):
            texts = _lowered(batch)
            rows += len(texts)
            buckets, owners = _grams(texts)
            present = np.zeros((len(texts), BUCKETS), bool)
            present[owners, buckets] = True
            total += present.sum(axis=0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], rows))],
            names=["bucket", "n"],
        )

    counted = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # BUCKETS + 1 rows at most
    frequency = np.zeros(BUCKETS, np.int64)
    inside = found["bucket"] >= 0
    frequency[found["bucket"][inside]] = found["n"][inside]
    return int(found["n"][~inside].sum()), frequency


def _features(rows: DataFrame) -> DataFrame:
    """Labelled n-gram counts of rows ``h, lang, text``."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", SLICE_BYTES):
            buckets, owners = _grams(_lowered(batch))
            order = np.argsort(owners, kind="stable")
            ends = np.searchsorted(owners[order], np.arange(batch.num_rows + 1))
            rows = []
            for i in range(batch.num_rows):
                at, n = np.unique(buckets[order[ends[i] : ends[i + 1]]], return_counts=True)
                rows.append((at.astype(np.int32).tobytes(), n.astype(np.int32).tobytes()))
            at, n = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("lang"), pa.array(at, pa.binary()), pa.array(n, pa.binary())],
                names=["h", "lang", "buckets", "counts"],
            )

    return rows.mapInArrow(features, "h long, lang string, buckets binary, counts binary").orderBy("h", "lang", "buckets", "counts")


def _decoded(rows: list) -> list:
    return [(r.lang, np.frombuffer(r.buckets, np.int32), np.frombuffer(r.counts, np.int32)) for r in rows]


def sample_features(docs: DataFrame, train_rows: int) -> tuple[list, set[str]]:
    """Labelled n-gram counts of the rows with the smallest id hashes, the bounded sample, and
    the languages too rare for it, which hold their own rows of smallest hash instead."""
    hashed = docs.select("doc_id", F.xxhash64("doc_id").alias("h"), "lang", "text")
    last = hashed.select("doc_id", "h").orderBy("h", "doc_id").limit(train_rows).agg(F.max("h")).first()[0]
    if last is None:
        return [], set()
    sample = _decoded(_features(hashed.where(F.col("h") <= last).select("h", "lang", "text")).limit(train_rows).collect())
    taken = Counter(lang for lang, _, _ in sample)
    totals = {r.lang: r.n for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LABELS + 1).collect()}
    if len(totals) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} languages: weights for all of them would not fit a task")
    rare = {lang for lang, n in totals.items() if taken[lang] < min(n, LEAST_ROWS)}
    if not rare:
        return sample, rare
    # Spark limits each partition to LEAST_ROWS rows a language before it shuffles them
    first = Window.partitionBy("lang").orderBy("h", "doc_id", F.xxhash64("text"))
    own = hashed.where(F.col("lang").isin(*rare)).withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= LEAST_ROWS)
    added = _decoded(_features(own.select("h", "lang", "text")).collect())
    common = [row for row in sample if row[0] not in rare]
    # spread among the others, so that no language comes last in every epoch
    places = [*range(len(common)), *((i + 0.5) * len(common) / len(added) for i in range(len(added)))]
    order = sorted(range(len(places)), key=places.__getitem__)
    both = common + added
    return [both[i] for i in order], rare


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(sample: list, idf: np.ndarray, langs: list[str]) -> np.ndarray:
    """Weights per bucket and language; the elastic net leaves most of them at zero."""
    z, n = np.zeros((BUCKETS, len(langs))), np.zeros((BUCKETS, len(langs)))

    def weights(at: np.ndarray) -> np.ndarray:
        near = z[at]
        shrunk = np.sign(near) * np.maximum(np.abs(near) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for lang, at, counts in sample:
            x = SCALE * idf[at] * counts / counts.sum()
            w = weights(at)
            p = _softmax(x @ w)
            p[langs.index(lang)] -= 1.0
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(BUCKETS))


def excerpts(rows: list, of: dict[str, int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Short texts in place of ``rows``: the rows themselves and a few of their n-grams, drawn
    with a fixed seed, so that what is fitted on them holds for little evidence as well."""
    draw, bags, truth = np.random.default_rng(5), [], []
    for lang, at, counts in rows:
        bags.append(np.repeat(at, counts))
        bags += [draw.choice(bags[-1], size) for size in EXCERPTS]
        truth += [of[lang]] * (1 + len(EXCERPTS))
    return bags, np.array(truth, np.int64)


def temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The softmax temperature, 1 at least, with the least log loss, by golden section."""
    if not len(truth):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-300)).mean())

    low, high, ratio = 0.0, 8.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def familiarity(learned: list, langs: list[str], bags: list[np.ndarray]) -> np.ndarray:
    """Per bucket, how much an n-gram speaks for a text of any learned language: the logarithm
    of its share, languages weighing alike, on a scale on which ``bags`` of known texts have 6
    in the median and n-grams drawn evenly from all buckets -6."""
    shares = np.zeros((len(langs), BUCKETS))
    of = {lang: i for i, lang in enumerate(langs)}
    for lang, at, counts in learned:
        shares[of[lang], at] += counts
    mixed = (shares / np.maximum(shares.sum(axis=1, keepdims=True), 1)).mean(axis=0)
    logs = np.log(0.9 * mixed + 0.1 / BUCKETS)
    known, noise = float(np.median([logs[bag].mean() for bag in bags])), float(logs.mean())
    return 12.0 * (logs - (known + noise) / 2) / max(known - noise, 1e-9)


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """``(languages, table)``: IDF, weights and temperature in one row per bucket, and its
    familiarity in the last column.

    ``labelled`` has doc_id, text and lang; rows without a label or a letter are passed over.
    """
    bounded_batches(labelled.sparkSession)
    usable = labelled.where(F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    rows, frequency = document_frequencies(usable)
    sample, rare = sample_features(usable, train_rows)
    langs = sorted({lang for lang, _, _ in sample})
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    idf = np.log((1.0 + rows) / (1.0 + frequency)) + 0.1
    seen, kept_back, learned = Counter(), [], []
    for row in sample:
        seen[row[0]] += 1
        (kept_back if row[0] not in rare and seen[row[0]] % 5 == 0 else learned).append(row)
    w = follow_the_leader(learned, idf, langs)
    table = SCALE * idf[:, None] * w
    bags, truth = excerpts(kept_back or learned, {lang: i for i, lang in enumerate(langs)})
    logits = np.array([table[bag].mean(axis=0) for bag in bags])
    known = familiarity(learned, langs, bags)
    return langs, np.column_stack([table / temperature(logits, truth), known]).astype(np.float32)


def predict(docs: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (which replace columns so named)."""
    bounded_batches(docs.sparkSession)
    schema = docs.drop("lang_pred", "score")
    fields = StructType(list(schema.schema.fields)).add("lang_pred", "string").add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", SLICE_BYTES):
            names, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            texts = _lowered(batch)
            if langs:
                buckets, owners = _grams(texts)
                sums = np.stack(
                    [np.bincount(owners, weights=table[:, c][buckets], minlength=len(texts)) for c in range(len(langs) + 1)],
                    axis=1,
                )
                means = sums / np.maximum(np.bincount(owners, minlength=len(texts)), 1)[:, None]
                p = _softmax(means[:, :-1])
                known = 1 / (1 + np.exp(-means[:, -1]))
                best = p.argmax(axis=1)
                for i, text in enumerate(texts):
                    if any(map(str.isalpha, text)):
                        names[i], scores[i] = langs[best[i]], float(p[i, best[i]] * known[i])
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return schema.mapInArrow(score, fields)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    langs, table = train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text"), langs, table).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


def keep_identified(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """``docs`` without the rows whose language is unknown or scored below ``least_score``: by
    default those whose language is more likely another one, or none of the learned ones."""
    langs, table = train(docs.where(~held_out()).select("doc_id", "text", "lang"))
    if not langs:
        return docs.where(F.lit(False))
    scored = predict(docs.withColumnsRenamed({"lang_pred": "_lang_pred", "score": "_score"}), langs, table)
    kept = scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).drop("lang_pred", "score")
    return kept.withColumnsRenamed({"_lang_pred": "lang_pred", "_score": "score"}).select(*docs.columns)
