"""Exact removal of long repeated byte strings by prefix-free parsing and suffix sorting.

* **Parse.** A rolling hash over 128-byte grams runs over each text. Neighbouring starts
  of 400-byte strings whose smallest gram is the same trigger form one phrase, which reaches
  399 bytes past its last start. Neighbouring phrases so overlap by 399 bytes: the phrases
  are prefix-free for 400-byte strings, every such string lies in one phrase of each of its
  occurrences, and equal strings have equal triggers.
* **Parse order.** Phrases whose trigger occurs once hold no repeat and drop out. A phrase
  that occurs twice or more repeats as a whole: the parse alone decides it.
* **Dictionary.** Different phrases with one trigger meet in the dictionary. Its suffixes of
  at least 400 bytes are sorted by their first 400 bytes (ranks by prefix doubling); strings
  that get equal ranks are repeats. Longer contexts, where the order of the parse would
  break ties, do not matter to strings of 400 bytes.

A trigger with more dictionary text than one task should hold is decided by hashes (128 bits)
of its single 400-byte strings, counted by Spark.

Passages of words are found the same way, over words in place of bytes: a gram is ``WORD_GRAM``
words, and texts are compared as their words with one space behind each, so that how words are
spaced does not matter.

Null texts are empty and lose nothing, like all texts shorter than the window. Repeated rows
repeat each other's texts and lose them like any copy. An empty table gives an empty result.
Only the id and the text are read; other columns, whatever their names, pass through
``remove_repeats`` unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import RollingHash, batches_of, bounded_batches, by_bytes, mix64, read, row_key, stored, text_buffer, told_apart, words_at

WINDOW = 400
GRAM = 128
WORD_GRAM = 8
TEXT_ROWS = 64
SLICE_BYTES = 256 << 10
DICTIONARY_BYTES = 16 << 20
SORTED_BYTES = 512 << 10


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, in three passes whatever the width."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def cut(hashes: RollingHash, sums: np.ndarray, starts: np.ndarray, window: int, gram: int):
    """``(first, runs, trigger)`` of the phrases of several texts, given the prefix sums of their
    bytes or words: the first start, the number of starts, and the trigger."""
    grams = hashes.grams(sums, gram)
    triggers = sliding_min(grams, window - gram + 1)
    n = len(triggers)
    firsts, lasts = starts[:-1], starts[1:] - window + 1
    long_enough = lasts > firsts
    firsts, lasts = firsts[long_enough], lasts[long_enough]
    if not len(firsts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    level = np.zeros(n + 1, np.int32)
    np.add.at(level, firsts, 1)
    np.add.at(level, lasts, -1)
    inside = np.cumsum(level[:n]) > 0
    edge = np.ones(n, bool)
    edge[1:] = (triggers[1:] != triggers[:-1]) | (inside[1:] != inside[:-1])
    edge |= grams[window - gram :] == triggers  # the trigger comes again: one phrase for each
    edge[firsts] = True
    edges = np.append(np.flatnonzero(edge), n)
    kept = inside[edges[:-1]]
    return edges[:-1][kept], np.diff(edges)[kept], triggers[edges[:-1][kept]]


class Words:
    """The words of several texts, which follow each other with one space behind each; ``opens``
    has where each begins in there, ``starts`` the number of each text's first word."""

    def __init__(self, hashes: RollingHash, raw: np.ndarray, starts: np.ndarray) -> None:
        opens, closes = words_at(raw, starts)
        self.sums = hashes.sums_of(mix64(hashes.spans(hashes.sums(raw), opens, closes) + (closes - opens).astype(np.uint64)))
        self.starts = np.searchsorted(opens, starts)
        sizes = closes - opens + 1
        self.opens = np.concatenate([[0], np.cumsum(sizes)])
        self.raw = np.full(self.opens[-1], 0x20, np.uint8)
        inside = np.arange(self.opens[-1]) - np.repeat(self.opens[:-1], sizes)
        of_word = inside < np.repeat(sizes, sizes) - 1
        self.raw[of_word] = raw[(inside + np.repeat(opens, sizes))[of_word]]


def phrases(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, words: bool = False) -> DataFrame:
    """``row_key, first, runs, trigger, phrase`` of ``docs`` (row_key, text), in bytes or words."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = RollingHash()
        for batch in by_bytes(batches, "text", SLICE_BYTES):
            raw, starts = text_buffer(batch.column("text"))
            if words:
                of_words = Words(hashes, raw, starts)
                raw, starts, sums = of_words.raw, of_words.starts, of_words.sums
            else:
                sums = hashes.sums(raw)
            first, runs, trigger = cut(hashes, sums, starts, window, gram)
            owner = np.searchsorted(starts, first, side="right") - 1
            opens, closes = first, first + runs + window - 1
            if words:
                opens, closes = of_words.opens[opens], of_words.opens[closes]
            view = memoryview(raw)
            names = [hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(opens.tolist(), closes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_key").take(pa.array(owner)),
                    pa.array((first - starts[owner]).astype(np.int32)),
                    pa.array(runs.astype(np.int32)),
                    pa.array(trigger.view(np.int64)),
                    pa.array(names, pa.binary()),
                ],
                names=["row_key", "first", "runs", "trigger", "phrase"],
            )

    return docs.select("row_key", "text").mapInArrow(
        parse, "row_key binary, first int, runs int, trigger long, phrase binary"
    )


def equal_ranks(data: np.ndarray, window: int) -> np.ndarray:
    """A number per start such that starts have equal numbers exactly if their ``window``
    bytes, or numbers of words, are equal, and numbers follow the order of the suffixes."""
    size = 1
    ranks = data.astype(np.uint64)
    while data.dtype == np.uint8 and size < min(8, window):
        step = min(size, window - size)
        ranks = ranks[: len(ranks) - step] << np.uint64(8 * step) | (
            ranks[step:] & np.uint64((1 << (8 * step)) - 1)
        )
        size += step
    while size < window:
        step = min(size, window - size)
        dense = np.unique(ranks, return_inverse=True)[1].astype(np.uint64)
        n = len(dense) - step
        ranks = dense[:n] * np.uint64(len(dense) + 1) + dense[step:]
        size += step
    return np.unique(ranks, return_inverse=True)[1]


def repeated_starts(contents: list[bytes], copies: list[int], window: int, words: bool = False) -> list[np.ndarray]:
    """For each phrase, whether each of its starts begins a string that occurs elsewhere."""
    if words:
        split = [x.split() for x in contents]
        number: dict[bytes, int] = {}
        data = np.array([number.setdefault(word, len(number)) for x in split for word in x], np.int64)
        sizes = np.array([len(x) for x in split])
    else:
        data = np.frombuffer(b"".join(contents), np.uint8)
        sizes = np.array([len(x) for x in contents])
    ends = np.cumsum(sizes)
    ranks = equal_ranks(data, window)
    starts = [np.arange(e - s, e - window + 1) for s, e in zip(sizes, ends, strict=True)]
    of_all = ranks[np.concatenate(starts)]
    weights = np.repeat(np.array(copies), [len(x) for x in starts])
    repeated = np.bincount(of_all, weights=weights)[of_all] >= 2
    return np.split(repeated, np.cumsum([len(x) for x in starts])[:-1])


def _runs(flags: np.ndarray) -> list[int]:
    """Runs of true flags, each as offset << 32 | length."""
    change = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a) << 32) | int(b - a) for a, b in zip(change[::2], change[1::2], strict=True)]


def _sort_dictionary(window: int, words: bool):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def decided() -> Iterator[pa.RecordBatch]:
            found = repeated_starts([r[3] for r in rows], [r[2] for r in rows], window, words)
            picked = [(r[0], r[1], _runs(flags)) for r, flags in zip(rows, found, strict=True) if r[2] == 1 and flags.any()]
            if picked:
                trigger, phrase, runs = zip(*picked, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(trigger, pa.int64()), pa.array(phrase, pa.binary()), pa.array(runs, pa.list_(pa.int64()))],
                    names=["trigger", "phrase", "runs"],
                )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("trigger", "phrase", "copies", "content")), strict=True):
                if held >= SORTED_BYTES and row[0] != rows[-1][0]:
                    yield from decided()
                    rows, held = [], 0
                rows.append(row)
                held += len(row[3])
        if rows:
            yield from decided()

    return sort


def _single_strings(window: int, words: bool):
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for trigger, phrase, copies, content in zip(
                *(batch.column(c).to_pylist() for c in ("trigger", "phrase", "copies", "content")), strict=True
            ):
                # every word has one space behind it
                edges = [0, *(i + 1 for i, x in enumerate(content) if x == 0x20)] if words else range(len(content) + 1)
                n = len(edges) - window
                names = [hashlib.blake2b(content[edges[i] : edges[i + window]], digest_size=16).digest() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([trigger] * n, pa.int64()),
                        pa.array([phrase] * n, pa.binary()),
                        pa.array([copies] * n, pa.int64()),
                        pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(names, pa.binary()),
                    ],
                    names=["trigger", "phrase", "copies", "at", "string"],
                )

    return explode


def _content(docs: DataFrame, wanted: DataFrame, window: int, words: bool) -> DataFrame:
    """The bytes of the phrases of ``wanted``, each from the row that stands for it."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = RollingHash()
        for batch in by_bytes(batches, "text", SLICE_BYTES):
            raw, starts = text_buffer(batch.column("text"))
            opens = None
            if words:
                of_words = Words(hashes, raw, starts)
                raw, starts, opens = of_words.raw, of_words.starts, of_words.opens
            view = memoryview(raw)
            for i, parts in enumerate(batch.column("parts").to_pylist()):
                edges = [(starts[i] + p["first"], starts[i] + p["first"] + p["runs"] + window - 1) for p in parts]
                found = [view[a:b] if opens is None else view[opens[a] : opens[b]] for a, b in edges]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p["trigger"] for p in parts], pa.int64()),
                        pa.array([p["phrase"] for p in parts], pa.binary()),
                        pa.array([p["copies"] for p in parts], pa.int64()),
                        pa.array([bytes(x) for x in found], pa.binary()),
                    ],
                    names=["trigger", "phrase", "copies", "content"],
                )

    parts = wanted.groupBy("row_key").agg(
        F.collect_list(F.struct("trigger", "phrase", "copies", "first", "runs")).alias("parts")
    )
    # rows equal in id and text share a key: one of them serves
    parts = stored(parts, "wanted-parts")
    joined = told_apart(docs.select("row_key", "text"), parts, "row_key")[0].join(parts, "row_key")
    schema = "trigger long, phrase binary, copies long, content binary"
    return joined.select("text", "parts").mapInArrow(pick, schema).dropDuplicates(["trigger", "phrase"])


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, words: bool = False) -> DataFrame:
    """``row_key, spans`` of the rows of ``docs`` (row_key, text) that hold repeats: ranges of
    bytes or of words, as start << 32 | end, which may overlap."""
    parsed = stored(phrases(docs, window, gram, words), "phrases")
    shared = parsed.groupBy("trigger").agg(F.count(F.lit(1)).alias("_n")).where("_n >= 2").select("trigger")
    shared = stored(shared, "shared-triggers")  # joined as read, hot triggers can be split
    parsed = told_apart(parsed, shared, "trigger")[0]  # most phrases have a trigger of their own
    parsed = stored(parsed.join(shared, "trigger", "left_semi"), "shared-phrases")
    kinds = parsed.groupBy("trigger", "phrase").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("row_key", "first", "runs")).alias("at")
    )
    kinds = stored(kinds, "phrase-kinds")
    several = kinds.groupBy("trigger").agg(
        F.count(F.lit(1)).alias("_kinds"),
        F.min("copies").alias("_least"),
        F.sum(F.col("at.runs").cast("long") + window - 1).alias("_bytes"),
    )
    several = several.where("_kinds >= 2 AND _least = 1").select("trigger", (F.col("_bytes") > DICTIONARY_BYTES).alias("large"))
    wanted = kinds.join(several, "trigger").select("trigger", "phrase", "copies", "at.*", "large")
    with batches_of(docs.sparkSession, TEXT_ROWS):  # each text comes with its phrases, and gives them again
        dictionary = stored(_content(docs, wanted, window, words), "dictionary")
    large = several.where("large").select("trigger")
    sorted_out = (
        dictionary.join(large, "trigger", "left_anti")
        .repartition("trigger")
        .sortWithinPartitions("trigger")
        .mapInArrow(_sort_dictionary(window, words), "trigger long, phrase binary, runs array<long>")
    )
    single = dictionary.join(large, "trigger", "left_semi").mapInArrow(
        _single_strings(window, words), "trigger long, phrase binary, copies long, at int, string binary"
    )
    often = single.groupBy("string").agg(F.sum("copies").alias("_n")).where("_n >= 2").select("string")
    counted = (
        single.where("copies = 1")
        .join(often, "string", "left_semi")
        .groupBy("trigger", "phrase")
        .agg(F.collect_list(F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.lit(1))).alias("runs"))
    )
    partly = sorted_out.unionByName(counted).withColumnRenamed("runs", "parts")
    wholly = kinds.where("copies >= 2").select("trigger", "phrase", F.lit(None).cast("array<long>").alias("parts"))
    decided = wholly.unionByName(partly)
    whole = F.array(F.col("runs").cast("long"))
    spans = parsed.join(decided, ["trigger", "phrase"]).select(
        "row_key",
        F.explode(F.coalesce("parts", whole)).alias("_part"),
        F.col("first").cast("long").alias("_first"),
    )
    start = F.col("_first") + F.shiftright("_part", 32)
    end = start + F.col("_part").bitwiseAND(F.lit(0xFFFFFFFF)) + (window - 1)
    # a set: rows equal in id and text share a key, and each of them brings the same spans
    return spans.groupBy("row_key").agg(F.collect_set(F.shiftleft(start, 32).bitwiseOR(end)).alias("spans"))


def merged_spans(spans: np.ndarray) -> list[tuple[int, int]]:
    """Maximal ranges of packed ranges; ranges that touch are one."""
    packed = np.unique(spans)
    starts, ends = packed >> 32, np.maximum.accumulate(packed & 0xFFFFFFFF)
    if not len(starts):
        return []
    opens = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
    closes = np.append(opens[1:], len(starts)) - 1
    return list(zip(starts[opens].tolist(), ends[closes].tolist(), strict=True))


def _kept(raw: memoryview, spans: list[tuple[int, int]]) -> list[memoryview]:
    out, at = [], 0
    for start, end in spans:
        out.append(raw[at:start])
        at = end
    out.append(raw[at:])
    return out


def _decoded(parts: list[memoryview]) -> str:
    return "".join(bytes(p).decode("utf-8", "ignore") for p in parts)


def _with_spans(docs: DataFrame, window: int, gram: int, passage: int | None = None) -> DataFrame:
    """``docs`` with ``spans`` of bytes and, if ``passage`` is given, ``passages`` of words."""
    bounded_batches(docs.sparkSession)
    keyed = docs.withColumn("row_key", row_key())
    texts = keyed.select("row_key", "text")
    spans = repeated_spans(texts, window, gram)
    if passage is not None:
        gram = min(WORD_GRAM, passage)
        spans = spans.join(repeated_spans(texts, passage, gram, words=True).withColumnRenamed("spans", "passages"), "row_key", "full")
    spans = stored(spans, "spans")
    hit, clean = told_apart(keyed, spans, "row_key")
    return hit.join(spans, "row_key", "left").unionByName(clean, allowMissingColumns=True)


def removal_report(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, text`` per row of ``docs``; ``text``
    is what is left, without characters that a cut splits, and null where it was null."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts = text_buffer(batch.column("text"))
            view = memoryview(raw)
            rows, known = [], batch.column("text").is_valid().to_pylist()
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                merged = merged_spans(np.array(spans or [], np.int64))
                parts = _kept(view[starts[i] : starts[i + 1]], merged)
                sha = hashlib.sha256()
                for part in parts:
                    sha.update(part)
                text = _decoded(parts) if known[i] else None
                rows.append((int(starts[i + 1] - starts[i]), sum(b - a for a, b in merged), len(merged), sha.hexdigest(), text))
            size, removed, count, digest, texts = zip(*rows, strict=True) if rows else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(size, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(texts, pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"],
            )

    joined = _with_spans(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), window, gram)
    return joined.select("doc_id", "text", "spans").mapInArrow(
        report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"
    )


def _bytes_of(hit: list[int], raw: np.ndarray) -> np.ndarray:
    """Ranges of the words of one text as ranges of its bytes."""
    opens, closes = words_at(raw, np.array([0, len(raw)]))
    packed = np.array(hit, np.int64)
    return opens[packed >> 32] << 32 | closes[(packed & 0xFFFFFFFF) - 1]


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, passage: int | None = None) -> DataFrame:
    """``docs`` with the repeated bytes gone from ``text``; with ``passage``, also every stretch of
    as many words, however short or spaced, that occurs elsewhere. Characters that a cut would
    split go whole; null texts stay null; all rows and other columns stay."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    at = docs.columns.index("text")
    numbered = plain.withColumnsRenamed({f"c{at}": "text", f"c{docs.columns.index('doc_id')}": "doc_id"})
    names = numbered.columns
    lists = ["spans"] if passage is None else ["spans", "passages"]
    joined = _with_spans(numbered, window, gram, passage).select(*names, *lists)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts = text_buffer(batch.column("text"))
            view = memoryview(raw)
            texts = []
            found = zip(batch.column("text").is_valid().to_pylist(), *(batch.column(x).to_pylist() for x in lists), strict=True)
            for i, (known, spans, *passages) in enumerate(found):
                a, b = starts[i], starts[i + 1]
                packed = [np.array(spans or [], np.int64), *(_bytes_of(x, raw[a:b]) for x in passages if x)]
                parts = _kept(view[a:b], merged_spans(np.concatenate(packed)))
                texts.append(_decoded(parts) if known else None)
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(strip, numbered.schema).toDF(*docs.columns)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(read(spark, sf_dir, "documents"))
