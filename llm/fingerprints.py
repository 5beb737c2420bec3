"""Document fingerprints: bottom-k sketches of word shingles, with built-in functions only.

A fingerprint holds the ``K`` smallest distinct 64-bit hashes of a text's 5-word shingles
(lower-cased words between white space; fewer words are one shingle). The k smallest hashes of
a union are among the k smallest of its parts, so fingerprints of parts merge into that of the
whole, within a row (``merge``) or as an aggregate (``merge_all``, which keeps k hashes per
group and never a group's list). From two of them follow resemblance, containment and the
numbers of distinct shingles.

Null and empty texts have an empty fingerprint (an empty string); two empty ones resemble each
other fully, an empty and another one not at all. Equal texts have equal fingerprints;
repeated rows are rows of their own. In the order of documents, rows with equal ids follow by
text, and null ids come first. An empty table gives an empty result, a single document is its
own next. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import read, stored, task_count

K = 64
WORDS = 5
_LARGEST = 9223372036854775807


def words(text: Column) -> Column:
    """Words between white space, A-Z lower-cased."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def with_sketch(df: DataFrame, text: str, sketch: str, k: int = K) -> DataFrame:
    """``df`` with the array column ``sketch``: the k smallest shingle hashes of ``text``."""
    hashes = F.transform(words(F.coalesce(F.col(text), F.lit(""))), lambda w: F.xxhash64(w))
    named = df.withColumn("_words", hashes)
    n = F.size("_words")
    shifted = [F.slice("_words", i + 1, F.greatest(n - (WORDS - 1), F.lit(0))) for i in range(WORDS)]
    shingles = F.transform(F.arrays_zip(*(s.alias(f"w{i}") for i, s in enumerate(shifted))), lambda s: F.xxhash64(s))
    few = F.when(n > 0, F.array(F.xxhash64("_words", F.lit(0)))).otherwise(F.array().cast("array<bigint>"))
    named = named.withColumn("_shingles", F.when(n >= WORDS, shingles).otherwise(few)).drop("_words")
    smallest = F.slice(F.sort_array(F.array_distinct("_shingles")), 1, k)
    return named.withColumn(sketch, smallest).drop("_shingles")


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_all(df: DataFrame, sketch: str, *keys: str, k: int = K) -> DataFrame:
    """One sketch per group of ``keys``: hashes are made distinct per group before and after
    the shuffle, and the k-th smallest is found by an ordered window of the distinct ones."""
    hashes = df.select(*keys, F.explode(sketch).alias("_h")).distinct()
    ranked = hashes.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))).where(F.col("_r") <= k)
    return ranked.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(sketch))


def distinct_count(sketch: Column, k: int = K) -> Column:
    """The estimated number of distinct shingles; exact below k."""
    last = F.element_at(sketch, k).cast("double") / F.lit(2.0**64) + 0.5
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / last)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of the union's shingles that both have, 0 to 1."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of a's shingles that b has too, 0 to 1."""
    r = resemblance(a, b, k)
    shared = r * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def as_text(sketch: Column) -> Column:
    """A sketch as a string of 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def ranged(df: DataFrame, id_column: str, ranges: int) -> DataFrame:
    """``df`` with ``_range``: ranges of ids of about the same number of rows, in order."""
    key = F.col(id_column)
    at = [i / ranges for i in range(1, ranges)]
    splits = sorted(set(df.agg(F.percentile_approx(key, at, 10_000).alias("s")).first().s or []))
    number = F.size(F.filter(F.lit(splits).cast("array<bigint>"), lambda s: s < key)) if splits else F.lit(0)
    return df.withColumn("_range", F.when(key.isNull(), F.lit(-1)).otherwise(number))


def heads(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """The first row of each ``_range``: as many rows as ranges, found by their ids first."""
    least = df.groupBy("_range").agg(F.min(id_column).alias("_least")).withColumnRenamed("_range", "_of")
    same = (F.col("_range") == F.col("_of")) & F.col(id_column).eqNullSafe(F.col("_least"))
    found = df.join(F.broadcast(least), same)  # a row per range: bounded by the partitions
    return found.groupBy("_range", id_column).agg(F.min(text).alias(text))


def with_next(df: DataFrame, firsts: DataFrame, order: list[str], carried: list[str]) -> DataFrame:
    """``df`` with ``_next_<c>`` of each carried column: its value in the next row by
    ``order``, and in the first row after the last.

    A window runs within each ``_range``; a range's last row takes the row of ``firsts`` that
    opens the next range, and the last range's the first of all.
    """
    window = Window.partitionBy("_range").orderBy(*(F.col(c).asc_nulls_first() for c in order))
    led = df.withColumn("_next", F.lead(F.struct(*carried)).over(window))
    ring = Window.orderBy("_range")  # over one number per range
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("_range").over(ring), F.first("_range").over(whole))
    follow = firsts.select("_range").select(F.col("_range").alias("_of"), after.alias("_follower"))
    opens = firsts.select(F.col("_range").alias("_follower"), F.struct(*carried).alias("_after"))
    joined = led.join(follow.join(opens, "_follower").drop("_follower"), led["_range"] == F.col("_of"))
    taken = F.coalesce("_next", "_after")
    return joined.withColumns({f"_next_{c}": taken[c] for c in carried}).drop("_range", "_next", "_of", "_after")


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """The fingerprint of each row's text, of its edited text (the second half replaced by
    the start of the next document), and how alike both and the next document's are."""
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = ranged(own, "doc_id", 2 * task_count(docs.sparkSession))
    firsts = with_sketch(stored(heads(own, "doc_id", "text"), "range-heads"), "text", "_sketch", k)
    led = with_next(with_sketch(own, "text", "_sketch", k), firsts, ["doc_id", "text"], ["text", "_sketch"])
    n = F.length("text")
    cut = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("_next_text"), F.lit(1), cut))
    led = with_sketch(led.withColumn("_edited", edited), "_edited", "_edited_sketch", k)
    return led.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        as_text(F.col("_sketch")).alias("fingerprint"),
        as_text(F.col("_edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("_sketch"), F.col("_edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("_sketch"), F.col("_next__sketch"), k).alias("near_next"),
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))
