"""Sharding by balanced label propagation over linked documents.

Documents are linked through groups (here: equal texts). Every document starts in a shard by a
hash. In each round every group names the shard that holds most of its bytes, and its other
documents ask to move there; a shard takes them while its quota lasts, small groups whole.
Groups and shards meet in joins of narrow rows; only loads per shard reach the driver.

What quotas leave uneven is settled exactly: a shard keeps its rows, linked ones first, up to
the mean size; the rest, mostly unlinked rows, fills the rooms of shards below it in order.
Every shard's size then is within the largest single document of the mean (law ``bytes``).

Null and empty texts have size 1 and the checksum 0; they are linked with nothing. Repeated
rows have equal texts and are linked like other copies; they get slots of their own. Null ids
are hashed like any other value. An empty table gives an empty result. Only id and text are
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import read, stored, task_count

SHARDS = 16
ROUNDS = 5
SLACK = 0.05
LAW = "bytes"


def _by_shard(values: dict[int, float], shards: int, of: str = "shard") -> Column:
    """The value of a shard, from a constant array of one entry per shard."""
    listed = F.array(*(F.lit(float(values.get(i, 0.0))) for i in range(shards)))
    return F.element_at(listed, F.col(of) + 1)


def _sums(df: DataFrame, by: str, what: Column) -> dict[int, float]:
    """Sums per shard: as many rows as shards."""
    return {r[0]: float(r[1] or 0) for r in df.groupBy(by).agg(F.sum(what)).collect()}


def preceding(df: DataFrame, part: str, bucket: str, order: list[str], value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before each in its ``part``, in the order
    of bucket, then ``order``: a window per bucket, and one over the sums of the buckets."""
    valued = df.withColumn("_value", value)
    sums = valued.groupBy(part, bucket).agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    within = Window.partitionBy(part, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = valued.withColumn("_inside", F.coalesce(F.sum("_value").over(within), F.lit(0)))
    joined = inside.join(sums, [part, bucket])
    return joined.withColumn(name, F.col("_offset") + F.col("_inside")).drop("_offset", "_inside", "_value")


def propagate(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """``rows`` (id, size, group; null groups are unlinked) with ``shard`` after label
    propagation: a shard's linked rows get ``1 + slack`` mean sizes, half of what asks to
    leave counting as free. Unlinked rows do not count; they make room when sizes are settled.
    Adds ``large`` for groups of more than an eighth of a shard."""
    current = stored(rows.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(shards)).cast("int")), "labels")
    mean = sum(_sums(current, "shard", F.col("size")).values()) / shards
    linked = stored(
        current.where("group IS NOT NULL").groupBy("group").agg(F.sum("size").alias("_all"), F.count(F.lit(1)).alias("_n")).where("_n > 1"),
        "groups",
    )
    for number in range(rounds):
        votes = current.where("group IS NOT NULL").groupBy("group", "shard").agg(F.sum("size").alias("_votes"))
        strongest = F.max(F.struct("_votes", F.xxhash64("group", "shard").alias("_tie"), "shard"))
        wishes = votes.groupBy("group").agg(strongest.alias("_best"))
        wishes = stored(wishes.join(linked, "group").select("group", F.col("_best.shard").alias("_wish"), "_all"), "wishes")
        asked = current.join(wishes, "group", "left").withColumn(
            "_asks", F.coalesce(F.col("_wish") != F.col("shard"), F.lit(False))
        )
        asked = stored(asked, "asked")
        load = _sums(asked.where("_wish IS NOT NULL"), "shard", F.col("size"))  # unlinked rows can make room
        demand = _sums(asked.where("_asks"), "_wish", F.col("size"))
        if not demand:
            break
        leaving = _sums(asked.where("_asks"), "shard", F.col("size"))
        free = {s: (1 + slack) * mean - load.get(s, 0.0) + leaving.get(s, 0.0) / 2 for s in demand}
        share = {s: min(1.0, max(0.0, free[s]) / d) for s, d in demand.items() if d}
        small = F.col("_all") <= F.lit(mean / 8)
        drawn = F.pmod(F.when(small, F.xxhash64("group", F.lit(number))).otherwise(F.xxhash64("id", F.lit(number))), F.lit(1 << 20))
        moves = F.col("_asks") & (drawn < _by_shard(share, shards, "_wish") * (1 << 20))
        current = stored(
            asked.withColumn("shard", F.when(moves, F.col("_wish")).otherwise(F.col("shard"))).drop("_wish", "_all", "_asks"), "labels"
        )
    large = linked.where(F.col("_all") > F.lit(mean / 8)).select("group", F.lit(True).alias("large"))
    # fewer than 8 * shards groups can hold an eighth of a shard
    return current.join(F.broadcast(large), "group", "left").withColumn("large", F.coalesce("large", F.lit(False)))


def settled(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``rows`` (also with ``large``) with ``shard`` changed where needed to bring every shard
    to the mean size. Small groups stay in a row, so that a cut divides few of them."""
    buckets = max(64, 4 * task_count(rows.sparkSession))
    spread = F.pmod(F.xxhash64(F.coalesce("group", F.lit("")), F.when(F.col("group").isNull(), F.col("id"))), F.lit(buckets))
    salted = F.when(F.col("large") | F.col("group").isNull(), F.pmod(F.xxhash64("id"), F.lit(8))).otherwise(0)
    # linked rows first; large groups in eight parts, as no task should hold one
    bucket = F.when(F.col("group").isNull(), buckets * 8).otherwise(0) + spread * 8 + salted
    placed = preceding(rows.withColumn("_bucket", bucket), "shard", "_bucket", ["group", "id", "size"], F.col("size"), "_before")
    placed = stored(placed, "placed")
    load = _sums(placed, "shard", F.col("size"))
    mean = sum(load.values()) / shards
    stays = F.col("_before") + F.col("size") <= F.lit(mean)
    kept = _sums(placed.where(stays), "shard", F.col("size"))
    over, rooms, position = {}, [], 0.0
    for s in range(shards):
        over[s] = position - kept.get(s, 0.0)
        position += load.get(s, 0.0) - kept.get(s, 0.0)
    room, upto = 0.0, []
    for s in range(shards):
        room += mean - kept.get(s, 0.0)
        upto.append(room)
    at = F.col("_before") + F.col("size") / 2 + _by_shard(over, shards)
    found = F.size(F.filter(F.array(*(F.lit(x) for x in upto[:-1])), lambda x: x <= at)) if shards > 1 else F.lit(0)
    return placed.withColumn("shard", F.when(stays, F.col("shard")).otherwise(found.cast("int"))).drop("_before", "_bucket", "large")


def numbered(rows: DataFrame, name: str = "slot") -> DataFrame:
    """``rows`` with gapless numbers from 0 per shard."""
    buckets = max(64, 4 * task_count(rows.sparkSession))
    spread = rows.withColumn("_bucket", F.pmod(F.xxhash64("id", "crc"), F.lit(buckets)))
    return preceding(spread, "shard", "_bucket", ["id", "crc"], F.lit(1).cast("long"), name).drop("_bucket")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row of ``docs``."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        F.when(F.length(text) > 0, F.md5(text.cast("binary"))).alias("group"),
    )
    placed = stored(settled(propagate(rows, shards, rounds), shards), "shards")
    return numbered(placed).select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"))
