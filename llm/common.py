"""What several operators share: stored tables, table reading, row keys and rolling hashes."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_own_folders: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    environment = spark.sparkContext.environment  # of the workers, wherever the driver was started
    here = str(Path(__file__).resolve().parent.parent)
    if here not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, environment.get("PYTHONPATH", "")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Lets Arrow batches of this session hold at most ``BATCH_ROWS`` rows: rows here are whole
    texts, and a batch is held by the executor and by its Python worker at once."""
    if int(spark.conf.get(_BATCH)) > BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Actions in here send at most ``rows`` rows to a Python worker at once: for rows that are
    packed and large. The session's own number returns."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, min(rows, int(before)))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a folder of our own on a local master only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="llm-")
    return _own_folders[context.applicationId]


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read back: a cut in the lineage that survives
    the loss of executors. The files stay until the folder's owner removes them."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def task_count(spark: SparkSession) -> int:
    """The number of shuffle partitions, which the cluster's owner sizes with the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """16 bytes that tell rows apart by id and text. Rows equal in both share the key; what
    is decided from an id and a text is the same for them."""
    return F.unhex(
        F.md5(
            F.concat(
                F.coalesce(F.col(id_column).cast("string"), F.lit("null")),
                F.lit(":"),
                F.coalesce(F.col(text_column), F.lit("")),
            )
        )
    )


FILTER_BITS, BITS_PER_KEY, BITMAP_BITS = 1 << 27, 16, 1 << 15  # Spark's bitmaps hold 2**15 bits


def told_apart(df: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """``df`` in two parts: rows whose ``column`` may be among those of ``keys``, and rows whose
    is not, null ones included. Only the first need a join, so rows with texts are not shuffled
    to find a few of them. A filter of at most ``FILTER_BITS`` bits is broadcast, as bitmaps;
    when it is full, the first part has more rows, never fewer."""
    bits = BITMAP_BITS
    wanted = min(keys.count() * BITS_PER_KEY, FILTER_BITS)
    while bits < wanted:
        bits *= 2
    place = F.pmod(F.xxhash64("_key"), F.lit(bits))
    held = keys.select(F.col(column).alias("_key")).where("_key IS NOT NULL").select(place.alias("_at"))
    held = held.groupBy(F.expr(f"_at div {BITMAP_BITS}").alias("_bitmap"))
    held = held.agg(F.bitmap_construct_agg(F.col("_at") % BITMAP_BITS).alias("_held"))
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    names = plain.columns
    key = F.col(f"c{df.columns.index(column)}").cast(keys.schema[column].dataType)
    keyed = plain.withColumn("_key", key).withColumn("_at", F.when(F.col("_key").isNotNull(), place))
    marked = keyed.join(F.broadcast(held), F.expr(f"_at div {BITMAP_BITS}") == F.col("_bitmap"), "left")
    octet = f"CAST(conv(hex(substring(_held, CAST(_at % {BITMAP_BITS} div 8 AS INT) + 1, 1)), 16, 10) AS BIGINT)"
    marked = marked.withColumn("_may", F.expr(f"coalesce(getbit({octet}, CAST(_at % 8 AS INT)) = 1, false)"))
    return tuple(marked.where(part).select(*names).toDF(*df.columns) for part in ("_may", "NOT _may"))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, starts)`` of a text column; document i has bytes starts[i]:starts[i + 1].
    Nulls have none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1]
    starts = offsets.astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text and ``rows`` rows; a longer
    text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, starts = text_buffer(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(starts, starts[at] + most, side="right")) - 1
            end = min(max(end, at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def words_at(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of several texts begin and end; no word goes from one text to the next."""
    first = np.zeros(len(raw) + 1, bool)
    first[starts] = True
    word = np.append(~_SPACE[raw], False)
    before = np.append(False, word[:-1])
    return np.flatnonzero(word & (~before | first)), np.flatnonzero(before & (~word | first))


class RollingHash:
    """Polynomial hashes modulo 2**64 of all spans of a byte buffer, from prefix sums."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        inverse = pow(self.BASE, -1, 1 << 64)
        self.powers, self.inverse = np.ones(n, np.uint64), np.ones(n, np.uint64)
        self.powers[1:], self.inverse[1:] = np.uint64(self.BASE), np.uint64(inverse)
        np.multiply.accumulate(self.powers, out=self.powers)
        np.multiply.accumulate(self.inverse, out=self.inverse)

    def sums(self, data: np.ndarray) -> np.ndarray:
        return self.sums_of(self.values[data])

    def sums_of(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums over values of one's own, such as hashes of words."""
        if len(values) >= len(self.powers):
            self._grow(2 * len(values))
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((sums[ends] - sums[starts]) * self.inverse[starts])

    def grams(self, sums: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the spans of ``size`` bytes at every start."""
        n = len(sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix64((sums[size:] - sums[:n]) * self.inverse[:n])
