"""Exact deduplication as a stateful stream with disk-backed keyed state.

Two streams run until their input is used up. The first reads the documents and appends, per
row, the SHA-256 of its normalised text (all white space of ``[\\x20\\x09-\\x0D]`` gone), its
number of code points and its locator (file and row number in it). The second groups those rows
by digest in a state store kept by RocksDB in the checkpoint folder: per digest the number of
rows and the row that stays, by identifier and locator. Nothing expires: no watermark is set.
Spark combines the rows of a digest before they are shuffled, so a text that a third of all
rows repeat is one row per task.

A digest that is found again is a hit, and hits are checked by their full bytes: per digest,
the least and the greatest normalised text must be the same string, that of the row at the
locator among them. Texts are again combined before they are shuffled. Different texts with
one digest are told apart by the texts themselves, whatever their number.

A run over the same ``folder`` goes on where the last one ended: only new files are read, and
the decisions are those of one run over all files.

Null texts count as empty, and empty texts and texts of white space are equal. Of equal texts
the row with most code points stays, then the one with the smallest id (null ids last); of
repeated rows, equal in id and text, the one that comes first by file and row number. Texts of
any length pass through whole. An empty table gives an empty result. Only id and text are read:
other columns, whatever their names, do no harm.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from llm.common import shared_folder, stored

SPACES = r"[\x20\x09-\x0D]+"
STORE = "spark.sql.streaming.stateStore.providerClass"
#: RocksDB keeps the state; without files of fixed size, of which many small partitions have many
ON_DISK = {
    STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
BATCHES = 4
DIGEST_BYTES = 32
BROADCAST_KEYS = 500_000  # of 8 bytes


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), SPACES, "")


def _sha() -> Column:
    return F.unhex(F.sha2(normalised().cast("binary"), 256))


def _key(digest_bytes: int) -> Column:
    return F.substring(_sha(), 1, digest_bytes)


def _digests(rows: DataFrame, digest_bytes: int, *more: Column) -> DataFrame:
    """``doc_id, digest, sha, points, file, row`` of rows read from files, and ``more``."""
    at = rows.metadataColumn("_metadata")
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _key(digest_bytes).alias("digest"),
        _sha().alias("sha"),
        F.coalesce(F.char_length(F.col("text").cast("string")), F.lit(0)).alias("points"),
        at["file_path"].alias("file"),
        at["row_index"].alias("row"),
        *more,
    )


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Settings of the streams started here; the session's own return."""
    before = {key: spark.conf.get(key, None) for key in ON_DISK}
    for key, value in ON_DISK.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _any_of(path: str) -> str:
    """A pattern that only ``path`` fits: streams take single files only through patterns."""
    path = path.rstrip("/")
    return path if not path[-1].isalnum() else f"{path[:-1]}[{path[-1]}]"


class ExactDedup:
    """Deduplication of the Parquet files under ``path``, with all it keeps in ``folder``."""

    def __init__(self, spark: SparkSession, path: str, folder: str | None = None, digest_bytes: int = DIGEST_BYTES) -> None:
        self.spark, self.path, self.digest_bytes = spark, path, digest_bytes
        self.folder = folder or f"{shared_folder(spark)}/exact-dedup-{uuid.uuid4().hex}"
        known = {f.name: f for f in spark.read.parquet(path).schema}
        self.schema = StructType([known["doc_id"], known["text"]])

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def _seen(self) -> DataFrame:
        return self.spark.read.schema(self._kept_schema).parquet(f"{self.folder}/digests")

    def run(self, batches: int = BATCHES) -> ExactDedup:
        """Reads what is new, in about ``batches`` micro-batches per stream."""
        reader = self.spark.readStream.schema(self.schema)
        files = -(-max(len(self._rows().inputFiles()), 1) // batches)
        incoming = _digests(reader.option("maxFilesPerTrigger", files).parquet(_any_of(self.path)), self.digest_bytes)
        self._kept_schema = incoming.schema
        sink = incoming.writeStream.format("parquet").option("checkpointLocation", f"{self.folder}/read")
        sink.trigger(availableNow=True).start(f"{self.folder}/digests").awaitTermination()
        files = -(-max(len(self._seen().inputFiles()), 1) // batches)
        rows = self.spark.readStream.schema(incoming.schema).option("maxFilesPerTrigger", files).parquet(f"{self.folder}/digests")
        state = rows.groupBy("digest").agg(F.count(F.lit(1)), F.min(_rank()))
        with _state_on_disk(self.spark):
            kept = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{self.folder}/state")
            kept.trigger(availableNow=True).start().awaitTermination()
        return self

    def state(self) -> DataFrame:
        """``digest, size, stays``: what the state store holds after the last run."""
        if not self._seen().head(1):
            rows = self._seen()
            return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("size"), F.min(_rank()).alias("stays"))
        held = self.spark.read.format("statestore").load(f"{self.folder}/state")
        return held.select("key.digest", F.col("value.count").alias("size"), F.col("value.min").alias("stays"))

    def _mixed(self, state: DataFrame) -> DataFrame:
        """``digest`` of the hits whose bytes differ."""
        hits = state.where("size > 1").select("digest")
        texts = self._rows().select(_key(self.digest_bytes).alias("digest"), normalised().alias("content"))
        keys = hits.select(F.xxhash64("digest").alias("_key")).distinct()
        if state.where("size > 1").count() <= BROADCAST_KEYS:  # else all texts are compared with themselves
            texts = texts.join(F.broadcast(keys), F.xxhash64("digest") == F.col("_key"), "left_semi")
        both = texts.groupBy("digest").agg(F.min("content").alias("_least"), F.max("content").alias("_greatest"))
        return both.where("_least <> _greatest").select("digest")

    def rows(self) -> DataFrame:
        """``doc_id, sha, file, row, size, stays`` of every row seen, by full bytes."""
        state = stored(self.state(), "dedup-state")
        mixed = stored(self._mixed(state), "mixed-digests")
        seen = self._seen()
        columns = ["doc_id", "sha", "file", "row", "size", "stays"]
        if mixed.isEmpty():
            return seen.join(state, "digest").select(*columns)
        clean = seen.join(mixed, "digest", "left_anti").join(state, "digest").select(*columns)
        told = _digests(self._rows(), self.digest_bytes, normalised().alias("content"))
        told = told.join(mixed, "digest", "left_semi")
        kinds = told.groupBy("digest", "content").agg(F.count(F.lit(1)).alias("size"), F.min(_rank()).alias("stays"))
        return clean.unionByName(told.join(kinds, ["digest", "content"]).select(*columns))


def _rank() -> Column:
    """The row that stays is the least by this."""
    return F.struct((-F.col("points")).alias("shorter"), F.col("doc_id").isNull().alias("nameless"), "doc_id", "file", "row")


def decisions(spark: SparkSession, path: str, folder: str | None = None, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, keep_file, keep_row`` per row under
    ``path``: the last two locate the content that stays."""
    rows = ExactDedup(spark, path, folder, digest_bytes).run().rows()
    stays = F.col("stays")
    return rows.select(
        "doc_id",
        stays["doc_id"].alias("keep_id"),
        F.col("size").alias("group_size"),
        ((F.col("file") == stays["file"]) & (F.col("row") == stays["row"])).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        stays["file"].alias("keep_file"),
        stays["row"].alias("keep_row"),
    )


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(spark, f"{sf_dir}/documents.parquet").drop("keep_file", "keep_row")


OP11_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(length(text), 0) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS content
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY content ORDER BY points DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER (PARTITION BY content ORDER BY points DESC, doc_id) = 1 AS kept,
       sha256(content) AS text_sha256
FROM texts
"""
