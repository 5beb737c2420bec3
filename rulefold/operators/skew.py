"""Joins, expansions and stored tables for inputs where one key may hold a large share of the rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COPIES = "row_copies"
COPY_NUMBER = "copy_number"
COPIES_PER_PIECE = 100_000
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def skew_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str,
    spread_by: str,
    shared: Sequence[str] = (),
) -> DataFrame:
    """Equi-join (inner or left) whose left side may be skewed on ``left_key``.

    Which side is broadcast, and into how many slices a hot key is cut, adaptive execution
    decides from the sizes it measures. Two things it cannot do are done here. Left rows
    without a key match nothing and would all meet in one task: a second key, the hash of
    ``spread_by``, deals them to all tasks. And it can only cut a side that was shuffled for
    this very join: the second key, which no earlier partitioning has, makes sure of that.
    ``shared`` columns, where the right side has them, must be equal too. The right side's
    keys are dropped.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"skew_join does inner and left joins, not {how!r}")
    shared = [c for c in shared if c in right.columns]
    columns = [*left.columns, *[c for c in right.columns if c not in (right_key, *shared)]]
    right = right.withColumnsRenamed({right_key: "__right_key", **{c: f"__right_{c}" for c in shared}})
    same = F.col(left_key) == F.col("__right_key")
    for c in shared:
        same = same & (F.col(c) == F.col(f"__right_{c}"))
    # always 0 where there is a key, on both sides; written so that it is not folded away
    nothing = F.pmod(F.xxhash64("__right_key"), F.lit(1))
    spread = F.when(F.col(left_key).isNull(), F.xxhash64(spread_by)).otherwise(F.pmod(F.xxhash64(left_key), F.lit(1)))
    joined = left.withColumn("__salt", spread).join(
        right.withColumn("__right_salt", nothing), same & (F.col("__salt") == F.col("__right_salt")), how
    )
    return joined.select(*columns)


def copies_by_key(
    df: DataFrame, key: str, copies: Column | None = None, shared: Sequence[str] = ()
) -> DataFrame:
    """``(*shared, key, row_copies)``: how many rows a join on ``key`` would turn one row into.

    Stands in for a join whose columns are not used. Counts combine map-side, so a hot
    key reaches the shuffle as one row per input partition.
    """
    counted = F.count(F.lit(1)) if copies is None else F.sum(copies)
    lead = [c for c in shared if c in df.columns]
    return (
        df.where(F.col(key).isNotNull()).groupBy(*lead, key).agg(counted.cast("long").alias(COPIES))
    )


def copies_of(df: DataFrame) -> Column:
    """How many rows each row of ``df`` stands for; one where it has no such column."""
    return F.col(COPIES) if COPIES in df.columns else F.lit(1).cast("long")


def expand_copies(df: DataFrame, per_piece: int = COPIES_PER_PIECE) -> DataFrame:
    """One row per copy, in place; replaces ``row_copies`` by ``copy_number`` (from 0).

    Rows are cut into pieces of at most ``per_piece`` copies, so no array of all copies of a
    hot row exists, and nothing is shuffled.
    """
    if COPIES not in df.columns:
        return df.withColumn(COPY_NUMBER, F.lit(0).cast("long"))
    copies, piece = F.col(COPIES), F.col("__piece")
    others = [c for c in df.columns if c != COPIES]
    last = ((copies - 1) / per_piece).cast("long")
    pieces = df.withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    first = piece * per_piece
    size = F.least(F.lit(per_piece).cast("long"), copies - first)
    return pieces.select(*others, F.explode(F.sequence(first, first + size - 1)).alias(COPY_NUMBER))


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for files that all executors share, or one in the warehouse
    of a local master; a cluster that names none raises."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("name a folder, or set spark.checkpoint.dir to one that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/_stored"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is planned and run in here has its shuffle files removed when it ends, rather than when
    the driver's collector finds it unused: for steps whose results are stored. A task that is
    run again finds them made again. The session's own setting returns."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)


def materialize(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` computed once, for several readers: written as parquet and read back.

    The folder is the caller's, or the one the session names for such files
    (``spark.checkpoint.dir``). A local master without one uses a folder in its warehouse; a
    cluster without one raises, since executors would not find each other's files.
    """
    spark = df.sparkSession
    folder = folder or shared_folder(spark)
    path = f"{folder.rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
