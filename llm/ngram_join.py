"""Similarity join of documents on their word n-grams, by prefix trees.

A document's set holds 64-bit hashes of its distinct 5-word shingles of lower-cased words.
Sets that share at least 75 of 100 n-grams of their union are linked.

1. *Counts.* Tasks emit their sets as postings, packed per range of hashes. Each range
   counts in how many sets an n-gram occurs and returns those that occur twice or more to the
   block of documents they came from, which is bounded by construction.
2. *Global order.* N-grams are ordered by count (rare first), then hash. Two linked sets share
   an n-gram among the first n - ceil(0.75 n) + 1 of each: the prefix. A set whose prefix is
   made of n-grams that occur nowhere else has no partner and leaves. Equal sets become one.
3. *Trees.* Sets with a prefix n-gram in common meet. There they are stored in a trie in the
   global order; each set walks the trie once, carries the overlap of the shared part along,
   and leaves a subtree when what remains on either side cannot reach the threshold, or when
   all sets below already are in its component. Only links that join components are emitted.
4. *Twice.* First each set visits only the group of its commonest prefix n-gram, cut into
   blocks: this joins most of each family. Then sets that share a prefix n-gram with a set of
   another component are searched whole, as families or by n-gram, whichever weighs less;
   what exceeds ``GROUP_BYTES`` as pairs of blocks. No pair within the threshold is missed,
   whatever the first walk found.

Null and empty texts have no n-grams and are linked with nothing. Texts with fewer than five
words have one n-gram, the whole sequence. Repeated rows are copies of each other. An empty
table gives an empty result. Only id and text are read; columns whose names clash stay as
they are in ``keep_one``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import RollingHash, batches_of, bounded_batches, by_bytes, mix64, read, stored, task_count, text_buffer, told_apart
from llm.components import connected_components

WORDS = 5
SLICE_BYTES = 512 << 10
BLOCK_NGRAMS = 1 << 19
RANGES_PER_TASK = 4
RESULT_BYTES = 1 << 20
PACKED_ROWS = 64
GROUP_BYTES = 4 << 20
MOST_COUNTED = 4095
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_WEIGHTS = mix64(np.arange(11, 11 + WORDS, dtype=np.uint64)) | np.uint64(1)


def ngram_sets(hashes: RollingHash, raw: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each of several texts."""
    raw = _LOWER[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[starts] = True
    word = np.append(~_SPACE[raw], False)
    before = np.append(False, word[:-1])
    opens = np.flatnonzero(word & (~before | first))
    closes = np.flatnonzero(before & (~word | first))
    names = mix64(hashes.spans(hashes.sums(raw), opens, closes) + (closes - opens).astype(np.uint64))
    owner = np.searchsorted(starts, opens, side="right") - 1
    at = np.searchsorted(owner, np.arange(len(starts)))  # first word of each text
    n = max(len(names) - WORDS + 1, 0)
    grams = np.zeros(n, np.uint64)
    for j in range(WORDS):
        grams += names[j : j + n] * _WEIGHTS[j]
    grams = mix64(grams)
    out = []
    for begin, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if end - begin >= WORDS:
            out.append(np.unique(grams[begin : end - WORDS + 1]))
        elif end > begin:
            few = (names[begin:end] * _WEIGHTS[: end - begin]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix64(few + np.uint64(end - begin)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _digest(ngrams: np.ndarray) -> bytes:
    return hashlib.blake2b(ngrams.tobytes(), digest_size=16).digest()


def document_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set`` with a digest that names the set."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = RollingHash()
        for batch in by_bytes(batches, "text", SLICE_BYTES):
            sets = ngram_sets(hashes, *text_buffer(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([_digest(x) for x in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set"],
            )

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return columns.mapInArrow(digests, "doc_id long, n_shingles long, set binary")


_POSTINGS = "bucket int, block long, kind int, payload binary"


def _packed(ngrams: np.ndarray, sets: np.ndarray, counts: np.ndarray | None = None) -> bytes:
    """Sorted hashes as bytes of their differences, plane by plane, then the set numbers."""
    planes = np.diff(ngrams, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    parts = [len(ngrams).to_bytes(8, "little"), planes.tobytes(), sets.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()]
    if counts is not None:
        parts.append(counts.astype(np.uint16).tobytes())
    return b"".join(parts)


def _unpacked(payload: bytes, counted: bool = False) -> tuple[np.ndarray, ...]:
    n = int.from_bytes(payload[:8], "little")
    planes = np.frombuffer(payload, np.uint8, 8 * n, 8).reshape(8, n).T
    ngrams = np.cumsum(np.ascontiguousarray(planes).view(np.uint64).ravel(), dtype=np.uint64)
    planes = np.frombuffer(payload, np.uint8, 4 * n, 8 + 8 * n).reshape(4, n).T
    sets = np.ascontiguousarray(planes).view(np.uint32).ravel()
    return (ngrams, sets, np.frombuffer(payload, np.uint16, n, 8 + 12 * n)) if counted else (ngrams, sets)


def _postings(buckets: int):
    """Blocks of documents as packed postings per range of hashes, with the block's table."""

    def emit(sets: dict[bytes, np.ndarray]) -> Iterator[pa.RecordBatch]:
        table = b"".join(name + len(x).to_bytes(8, "little") for name, x in sets.items())
        block = int.from_bytes(hashlib.blake2b(table, digest_size=8).digest(), "little", signed=True)
        ngrams = np.concatenate(list(sets.values()))
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets.values()])
        order = np.argsort(ngrams)
        ngrams, owner = ngrams[order], owner[order]
        edges = [(i << 64) // buckets for i in range(1, buckets)]
        cuts = [0, *np.searchsorted(ngrams, np.array(edges, np.uint64)).tolist(), len(ngrams)]
        rows = [(i, 0, _packed(ngrams[a:b], owner[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        rows.append((block % buckets, 1, table))
        bucket, kind, payload = zip(*rows, strict=True)
        for at in range(0, len(rows), 32):
            part = slice(at, at + 32)
            size = len(bucket[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[part], pa.int32()), pa.array([block] * size, pa.int64()), pa.array(kind[part], pa.int32()), pa.array(payload[part], pa.binary())],
                names=["bucket", "block", "kind", "payload"],
            )

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sets, held = RollingHash(), {}, 0
        for batch in by_bytes(batches, "text", SLICE_BYTES):
            for ngrams in ngram_sets(hashes, *text_buffer(batch.column("text"))):
                if len(ngrams):
                    name = _digest(ngrams)
                    held += len(ngrams) if name not in sets else 0
                    sets[name] = ngrams
            if held >= BLOCK_NGRAMS:
                yield from emit(sets)
                sets, held = {}, 0
        if sets:
            yield from emit(sets)

    return postings


def _count(rows: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
    """Of one range of hashes, rows ``(block, kind, payload)``: the postings of n-grams in two
    sets or more, by block. Payloads are unpacked one by one into arrays for the whole range."""
    packed: dict[int, bytes] = {}
    for block, kind, payload in rows:
        if kind == 1:
            yield block, kind, payload
        else:
            packed[block] = payload  # equal blocks hold equal postings
    rows.clear()
    if not packed:
        return
    names = list(packed)
    sizes = [int.from_bytes(packed[name][:8], "little") for name in names]
    edges = np.cumsum([0, *sizes])
    ngrams, sets = np.empty(edges[-1], np.uint64), np.empty(edges[-1], np.uint32)
    for name, a, b in zip(names, edges, edges[1:], strict=False):
        ngrams[a:b], sets[a:b] = _unpacked(packed.pop(name))
    order = np.argsort(ngrams, kind="stable").astype(np.uint32 if len(ngrams) < 1 << 32 else np.int64)
    ordered = ngrams[order]
    opens = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    del ordered
    times = np.diff(np.append(opens, len(order)))
    counts = np.zeros(len(order), np.uint16)
    counts[order] = np.repeat(np.minimum(times, MOST_COUNTED).astype(np.uint16), times)
    del order
    for name, a, b in zip(names, edges, edges[1:], strict=False):
        kept = np.flatnonzero(counts[a:b] >= 2) + a
        if len(kept):
            yield name, 0, _packed(ngrams[kept], sets[kept], counts[kept])


def prefix_length(n: int) -> int:
    """How many of n ordered n-grams hold one in common with any set linked to them."""
    return n - (75 * n + 99) // 100 + 1


def _candidates(rows: list[tuple[int, bytes]]) -> Iterator[tuple]:
    """Of one block, rows ``(kind, payload)``: the sets that may have a partner, with their
    shared n-grams in global order."""
    table = next(payload for kind, payload in rows if kind == 1)
    parts = [payload for kind, payload in rows if kind == 0]
    rows.clear()
    if not parts:
        return
    edges = np.cumsum([0, *(int.from_bytes(x[:8], "little") for x in parts)])
    keys, sets = np.empty(edges[-1], np.uint64), np.empty(edges[-1], np.uint32)
    for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        ngrams, sets[a:b], counts = _unpacked(parts[i], True)
        keys[a:b] = counts.astype(np.uint64) << np.uint64(52) | ngrams & np.uint64((1 << 52) - 1)
        parts[i] = b""
    order = np.argsort(sets, kind="stable")
    keys, sets = keys[order], sets[order]
    del order
    names, cuts = np.unique(sets, return_index=True)
    for number, a, b in zip(names.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(sets)], strict=True):
        n = int.from_bytes(table[24 * number + 16 : 24 * number + 24], "little")
        prefix = prefix_length(n) - (n - (b - a))  # n-grams of this set alone come first
        if prefix > 0:
            own = np.sort(keys[a:b])
            tokens = own[:prefix].view(np.int64)
            yield table[24 * number : 24 * number + 16], n, own.tobytes(), own.nbytes, tokens, int(tokens[-1])


def _by_group(found, schema: pa.Schema, most: int):
    """Applies ``found`` to the rows of each group; rows come sorted by their first column, the
    group, so that one group at a time is held. Results leave in batches of ``most`` bytes."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(rows: list) -> Iterator[pa.RecordBatch]:
            out, held = [], 0
            for row in found(rows):
                out.append(row)
                held += sum(len(x) for x in row if isinstance(x, bytes))
                if held >= most:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

        group, rows = None, []
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i, name in enumerate(columns[0].to_pylist()):
                if name != group and rows:
                    yield from results(rows)
                    rows = []
                group = name
                rows.append(tuple(c[i].as_py() for c in columns[1:]))
            del columns, batch
        if rows:
            yield from results(rows)

    return apply


_COUNTED = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
_SETS = pa.schema(
    [("set", pa.binary()), ("n", pa.int32()), ("ngrams", pa.binary()), ("size", pa.int64()), ("prefix", pa.list_(pa.int64())), ("commonest", pa.int64())]
)


class Trie:
    """Sets in one order as a compressed trie over rows sorted by their sequences."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int]) -> None:
        rows = len(sets)
        self.sets, self.size = sets, np.array(sizes)
        common = [0] * (rows + 1)
        for i in range(1, rows):
            n = min(len(sets[i - 1]), len(sets[i]))
            apart = np.flatnonzero(sets[i - 1][:n] != sets[i][:n])
            common[i] = int(apart[0]) if len(apart) else n
        #: row whose sequence holds the edge, its span, rows below, sizes and rest below
        self.nodes: list[tuple[int, int, int, int, int, int, int, int]] = []
        self.children: list[list[int]] = []
        lengths = np.array([len(x) for x in sets])
        todo = [(0, rows, 0, -1)]
        while todo:
            low, high, depth, parent = todo.pop()
            end = len(sets[low]) if high - low == 1 else min(common[low + 1 : high])
            below = self.size[low:high]
            number = len(self.nodes)
            self.nodes.append((low, depth, end, low, high, int(below.min()), int(below.max()), int(lengths[low:high].max()) - end))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(number)
            if high - low > 1:
                cuts = [low, *(i for i in range(low + 1, high) if common[i] == end), high]
                todo += [(a, b, end, number) for a, b in zip(cuts, cuts[1:], strict=False)]

    def links(self, labels: np.ndarray, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Links between rows of different labels that join them; ``labels`` is updated. With
        ``sides``, only rows of different sides are compared."""
        found = []
        width = max((int(x[-1]) for x in self.sets if len(x)), default=-1) + 1
        held = np.zeros(width, bool)
        for row, own in enumerate(self.sets):
            if (labels[row + 1 :] == labels[row]).all():
                continue
            n, total = int(self.size[row]), len(own)
            held[own] = True
            todo = [(0, 0, total)]
            while todo:
                number, overlap, left = todo.pop()
                at, start, end, low, high, least, most, rest = self.nodes[number]
                if high <= row + 1 or 100 * most < 75 * n or 75 * least > 100 * n:
                    continue
                if (labels[low:high] == labels[row]).all() or (sides is not None and (sides[low:high] == sides[row]).all()):
                    continue
                if end > start:
                    edge = self.sets[at][start:end]
                    overlap += int(np.count_nonzero(held[edge]))
                    left = total - int(np.searchsorted(own, edge[-1], side="right"))
                smallest = max(least, (75 * n + 99) // 100)
                if 7 * (overlap + min(left, rest)) < 3 * (n + smallest):
                    continue
                if high - low > 1:
                    todo += [(child, overlap, left) for child in self.children[number]]
                elif low > row and 7 * overlap >= 3 * (n + least):
                    found.append((row, low))
                    labels[labels == labels[low]] = labels[row]
            held[own] = False
        return found


def joined_links(sets: list[np.ndarray], sizes: list[int], labels: list, sides: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that join the components of ``sets``, which all are sorted in the global order."""
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    flat = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)[1]
    ends = np.cumsum([len(sets[i]) for i in order])[:-1]
    trie = Trie(np.split(flat, ends), [sizes[i] for i in order])
    number: dict = {}
    names = np.array([number.setdefault(labels[i], len(number)) for i in order])
    side = None if sides is None else np.array([sides[i] for i in order])
    if side is not None and (side == side[0]).all():
        side = None
    return [(order[a], order[b]) for a, b in trie.links(names, side)]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each group of rows, which come sorted by group."""

    def links(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        sets = [np.frombuffer(r["ngrams"], np.uint64) for r in rows]
        found = joined_links(sets, [r["n"] for r in rows], [r["label"] for r in rows], [r["side"] for r in rows])
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[i]["set"] for i, _ in found], pa.binary()), pa.array([rows[j]["set"] for _, j in found], pa.binary())],
                names=["a", "b"],
            )

    group, rows = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for row in batch.slice(at, 256).to_pylist():
                key = (row["key"], row["one"], row["other"])
                if key != group:
                    yield from links(rows)
                    group, rows = key, []
                rows.append(row)
    yield from links(rows)


def _searched(rows: DataFrame, sizes: DataFrame, whole: bool) -> DataFrame:
    """Links found among ``rows`` (key, set, n, ngrams, label) with equal keys; groups above
    ``GROUP_BYTES`` in blocks, compared in pairs if ``whole``. ``sizes`` has key and size."""
    blocks = sizes.groupBy("key").agg(F.ceil(F.sum("size") / GROUP_BYTES).cast("int").alias("_blocks"))
    blocks = stored(blocks.where("_blocks > 1"), "large-groups")  # few or none, and Spark knows their size
    several = F.coalesce("_blocks", F.lit(1))
    rows = rows.join(blocks, "key", "left").withColumn("side", F.pmod(F.xxhash64("set"), several).cast("int"))
    others = F.sequence(F.lit(0), several - 1) if whole else F.array("side")
    rows = rows.withColumn("_other", F.explode(others))
    keys = ["key", "one", "other"]
    return (
        rows.withColumns({"one": F.least("side", "_other"), "other": F.greatest("side", "_other")})
        .select(*keys, "side", "set", "n", "ngrams", "label")
        .repartition(*keys)
        .sortWithinPartitions(*keys, "set")
        .mapInArrow(_search, "a binary, b binary")
    )


def _families(prefixes: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """``key, set``: groups in which all pairs still to be compared meet.

    Sets that share a prefix n-gram across components are joined to families, each searched
    as a whole: its sets travel once. A family above ``GROUP_BYTES`` whose pairs of blocks
    would weigh more than its n-grams' groups is searched by those groups instead.
    """
    labelled = prefixes.join(labels, "set", "left").withColumn("label", F.coalesce("label", "set"))
    mixed = labelled.groupBy("token").agg(
        F.min("label").alias("_low"), F.max("label").alias("_high"), F.min("set").alias("_root")
    )
    mixed = stored(mixed.where("_low <> _high").select("token", "_root"), "mixed-tokens")
    members = stored(prefixes.join(mixed, "token"), "mixed-members")
    joined = connected_components(members.select(F.col("set").alias("a"), F.col("_root").alias("b")))
    families = joined.select(F.col("node").alias("set"), F.col("component").alias("key"))
    families = families.unionByName(joined.select(F.col("component").alias("set"), F.col("component").alias("key")).distinct())
    families = stored(families, "families")
    tokens_of = members.groupBy("set").agg(F.count(F.lit(1)).alias("_tokens"))
    weighed = families.join(sets.select("set", "size"), "set").join(tokens_of, "set")
    weighed = weighed.groupBy("key").agg(
        F.sum("size").alias("_bytes"), F.sum(F.col("size") * F.col("_tokens")).alias("_per_token")
    )
    in_pairs = F.col("_bytes") * F.ceil(F.col("_bytes") / GROUP_BYTES)
    by_token = stored(weighed.where(F.col("_per_token") < in_pairs).select("key"), "families-by-token")
    whole = families.join(by_token, "key", "left_anti")
    tokens = members.join(families.join(by_token, "key", "left_semi").select("set"), "set")
    return whole.select("key", "set").unionByName(tokens.select(F.col("token").cast("string").cast("binary").alias("key"), "set"))


def set_components(docs: DataFrame) -> DataFrame:
    """``set, component`` of the digests of sets that are not the smallest of their
    component."""
    spark = docs.sparkSession
    buckets = RANGES_PER_TASK * task_count(spark)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    postings = texts.mapInArrow(_postings(buckets), _POSTINGS).repartition("bucket").sortWithinPartitions("bucket")
    counted = postings.mapInArrow(_by_group(_count, _COUNTED, RESULT_BYTES), "block long, kind int, payload binary")
    counted = counted.repartition("block").sortWithinPartitions("block")
    candidates = counted.mapInArrow(
        _by_group(_candidates, _SETS, RESULT_BYTES),
        "set binary, n int, ngrams binary, size long, prefix array<long>, commonest long",
    )
    with batches_of(spark, PACKED_ROWS):
        sets = stored(candidates.dropDuplicates(["set"]), "candidate-sets")
    own = sets.withColumn("key", F.col("commonest").cast("string").cast("binary"))
    first = _searched(own.select("key", "set", "n", "ngrams", F.col("set").alias("label")), own.select("key", "size"), False)
    first = stored(first, "first-links")
    labels = connected_components(first).select(F.col("node").alias("set"), F.col("component").alias("label"))
    labels = stored(labels, "first-labels")
    families = stored(_families(sets.select("set", F.explode("prefix").alias("token")), labels, sets), "search-groups")
    rows = families.join(sets.select("set", "n", "ngrams"), "set").join(labels, "set", "left")
    rows = rows.withColumn("label", F.coalesce("label", "set"))
    rest = _searched(rows, families.join(sets.select("set", "size"), "set").select("key", "size"), True)
    rest = stored(rest, "rest-links")  # else a task runs the search and the contraction at once, in two workers
    # what the first walk joined counts as one: the rest links few labels
    roots = rest.select("a", "b")
    for end in ("a", "b"):
        label = labels.select(F.col("set").alias("_set"), F.col("label").alias("_label"))
        roots = roots.join(label, F.col(end) == F.col("_set"), "left").withColumn(end, F.coalesce("_label", end)).drop("_set", "_label")
    later = stored(connected_components(roots), "later-labels").select(F.col("node").alias("_node"), "component")
    every = labels.join(later, F.col("label") == F.col("_node"), "left").select(
        "set", F.coalesce("component", "label").alias("component")
    )
    return every.unionByName(later.select(F.col("_node").alias("set"), "component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs`` (doc_id, text)."""
    bounded_batches(docs.sparkSession)
    named = stored(document_sets(docs), "document-sets")
    labelled = named.join(set_components(docs), "set", "left").withColumn(
        "_label", F.coalesce("component", "set")
    )
    labelled = labelled.where("n_shingles > 0")
    least = labelled.groupBy("_label").agg(F.min("doc_id").alias("component_id"))
    linked = labelled.join(least, "_label").select("doc_id", "n_shingles", "component_id")
    empty = named.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(empty)


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id. Rows
    without n-grams all stay. Ids name documents: rows with one id go or stay together."""
    found = stored(near_duplicates(docs.select("doc_id", "text")), "components")
    gone = stored(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    doubtful, stay = told_apart(docs, gone, "doc_id")
    gone = gone.select(F.col("doc_id").alias("_gone"))
    return stay.unionAll(doubtful.join(gone, doubtful["doc_id"] == gone["_gone"], "left_anti"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
