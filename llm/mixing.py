"""Mixing sources to target weights, with DataFrame functions only.

A source's share of all tokens (words between white space) is raised to an exponent between
0 (equal weights) and 1 (as they come) and normalised. The exponent is bisected until the
weights meet a target: an entropy, or a limit on how often a source may be repeated. Several
bisection steps are evaluated per aggregation over the table of sources.

The weights become a plan over blocks. A document belongs to one of ``blocks`` blocks of its
source by a hash of its id. A source with weight w gets w * budget tokens: as many whole
passes over its blocks as fit, then a prefix of one more permutation. Each pass has its own
permutation, and every entry a place in the mixture that spreads each source evenly.
The budget defaults to the least one that gives every document a pass, so nothing is dropped;
a smaller one cuts, which is then what is asked for.

Null sources are one source. Null and empty texts have no tokens; they go wherever their
block goes. Repeated rows count as often as they occur. With an empty table, or no tokens at
all, every document is taken once. Extra columns pass through ``mixed`` untouched; the plan's
own columns replace columns of the same name.

Every aggregate is combined before its shuffle; a hot source is spread over its blocks, which
are the unit of every join. The table of blocks is broadcast only if it has at most
``BROADCAST_ROWS`` rows, and joined by source and block otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.common import read, stored

BLOCKS = 256
STEPS = 5
ROUNDS = 8
REPETITIONS = 2.0
BROADCAST_ROWS = 20_000
PLAN = ["_source", "_block", "_pass", "_place"]


def token_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def permuted(*parts: Column) -> Column:
    """A number below 2**32 from the MD5 of values: the same in every SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(p.cast("string") for p in parts))), 1, 8), 16, 10).cast("long")


def block_of(blocks: int, id_column: str = "doc_id") -> Column:
    return permuted(F.coalesce(F.col(id_column).cast("string"), F.lit("null"))) % blocks


def _bisected(shares: DataFrame, meets: Column, grows: bool) -> float:
    """The exponent at which ``meets``, an aggregate over (p, a, z), changes: 2**STEPS - 1
    exponents are tried per aggregation, ROUNDS times. ``meets`` is true up to the answer if
    it ``grows`` with weight on large sources, else from the answer on."""
    low, high, parts = 0.0, 1.0, 1 << STEPS
    for _ in range(ROUNDS):
        tried = [low + (high - low) * i / parts for i in range(1, parts)]
        sums = shares.select("p", F.explode(F.array(*(F.lit(x) for x in tried))).alias("a"))
        good = {r.a for r in sums.groupBy("a").agg(meets.alias("ok")).where("ok").collect()}  # at most 31 rows
        if grows:
            low, high = max([low, *good]), min([high, *(x for x in tried if x not in good)])
        else:
            low, high = max([low, *(x for x in tried if x not in good)]), min([high, *good])
    return low if grows else high


def _power() -> Column:
    return F.pow("p", F.col("a"))


def exponent(shares: DataFrame, entropy: float | None = None, repetitions: float | None = None) -> float:
    """The exponent for weights of at least ``entropy`` (nats), or the smallest at which no
    source is repeated more than ``repetitions`` times as often as the least repeated one.

    The entropy of the weights falls as the exponent grows from 0; how much more often the
    smallest source is seen than the largest, (p_max / p_min) ** (1 - a), falls as well.
    """
    if entropy is not None:
        z = F.sum(_power())
        found = F.log(z) - F.sum(_power() * F.log(_power())) / z
        return _bisected(shares, found >= entropy, True)
    if repetitions is None:
        return 1.0
    most = F.max(_power() / F.col("p")) / F.min(_power() / F.col("p"))
    return _bisected(shares, most <= repetitions, False)


def plan(
    docs: DataFrame,
    entropy: float | None = None,
    repetitions: float | None = REPETITIONS,
    budget: float | None = None,
    blocks: int = BLOCKS,
) -> tuple[DataFrame, dict]:
    """``(entries, facts)``: one entry per block of a source and pass over it, with the
    weight and place; facts are the exponent and the budget in tokens."""
    source = F.col("source").cast("string")
    sums = docs.select(source.alias("_source"), block_of(blocks).alias("_block"), token_count().alias("_tokens"))
    sums = stored(sums.groupBy("_source", "_block").agg(F.sum("_tokens").alias("_tokens")), "block-sums")
    sizes = sums.groupBy("_source").agg(F.sum("_tokens").alias("_size"))
    total = sizes.agg(F.sum("_size")).first()[0] or 0
    shares = stored(sizes.where("_size > 0").select("_source", "_size", (F.col("_size") / F.lit(total)).alias("p")), "shares")
    a = exponent(shares, entropy, repetitions) if total else 1.0
    z = (shares.agg(F.sum(F.pow("p", F.lit(a)))).first()[0] or 1.0) if total else 1.0
    weights = shares.select("_source", (F.pow("p", F.lit(a)) / z).alias("_weight"))
    needed = F.max(F.col("_size") / F.col("_weight"))
    if budget is None:
        budget = float(shares.join(weights, shares["_source"].eqNullSafe(weights["_source"])).agg(needed).first()[0] or 0.0)
    per_source = sizes.join(weights.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s")), "left")
    passes = F.when(F.col("_size") > 0, F.lit(budget) * F.col("_weight") / F.col("_size")).otherwise(1.0)
    per_source = per_source.select(
        F.col("_source").alias("_s"), "_size", F.coalesce("_weight", F.lit(0.0)).alias("_weight"), passes.alias("_passes")
    )
    joined = sums.join(per_source, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    name = F.coalesce("_source", F.lit("null"))
    passed = joined.withColumn("_pass", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("_passes") - 1e-9).cast("int"), F.lit(1)) - 1)))
    passed = passed.withColumn("_order", permuted(name, F.col("_pass"), F.col("_block")))
    walk = Window.partitionBy("_source", "_pass").orderBy("_order", "_block")
    running = F.sum("_tokens").over(walk.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    passed = passed.withColumn("_upto", running)
    whole = F.col("_pass") + 1 <= F.col("_passes") + 1e-9
    part = F.col("_upto") <= (F.col("_passes") - F.col("_pass")) * F.col("_size")
    middle = F.col("_pass") + (F.col("_upto") - F.col("_tokens") / 2) / F.greatest(F.col("_size"), F.lit(1))
    entries = passed.where(whole | part).withColumn("_place", middle / F.col("_passes"))
    return stored(entries.select("_source", "_block", "_pass", "_weight", "_tokens", "_place"), "mixture"), {
        "exponent": a,
        "budget": budget,
    }


def mixed(docs: DataFrame, entropy: float | None = None, repetitions: float | None = REPETITIONS,
          budget: float | None = None, blocks: int = BLOCKS) -> DataFrame:
    """``docs`` once for each time the plan takes their block, with the plan's columns
    ``_source, _block, _pass, _weight, _place``; sorting by ``_place`` gives the mixture."""
    entries, _ = plan(docs, entropy, repetitions, budget, blocks)
    right = entries.drop("_tokens").withColumnsRenamed({"_source": "_s", "_block": "_b"})
    if entries.count() <= BROADCAST_ROWS:
        right = F.broadcast(right)
    own = docs.drop(*PLAN, "_weight", "_s", "_b").withColumn("_source", F.col("source").cast("string")).withColumn("_block", block_of(blocks))
    same = F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b"))
    return own.join(right, same).drop("_s", "_b")


def realised(docs: DataFrame, **how) -> DataFrame:
    """The columns of ``docs`` alone, rows as often as the mixture takes them."""
    read_by_name = {docs.columns.index(c): c for c in ("doc_id", "source", "text")}
    plain = docs.toDF(*(read_by_name.get(i, f"c{i}") for i in range(len(docs.columns))))
    return mixed(plain, **how).select(*plain.columns).toDF(*docs.columns)


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and pass: which block of its source it is in, where the block
    comes in the mixture (millionths), and the source's weight (millionths)."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixed(docs).select(
        "doc_id",
        F.col("_source").alias("source"),
        F.col("_pass").alias("pass"),
        F.col("_block").alias("block"),
        token_count().alias("n_tokens"),
        F.round(F.col("_weight") * 1e6).cast("long").alias("weight_ppm"),
        F.round(F.col("_place") * 1e6).cast("long").alias("place_ppm"),
    )


def nats(sources: int) -> float:
    """The entropy of equal weights."""
    return math.log(sources)


OP1_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, source,
         coalesce(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8))::BIGINT % {BLOCKS}, 0) AS block,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens
  FROM documents),
sums AS (SELECT source, block, sum(n_tokens)::BIGINT AS tokens FROM words GROUP BY ALL),
sizes AS (SELECT source, sum(tokens)::BIGINT AS size FROM sums GROUP BY source),
shares AS (SELECT source, size, size / (SELECT sum(size) FROM sizes) AS p FROM sizes WHERE size > 0),
spread AS (SELECT max(p) / min(p) AS r FROM shares),
bisect(step, low, high) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1,
         CASE WHEN pow(r, 1 - (low + high) / 2) <= {REPETITIONS} THEN low ELSE (low + high) / 2 END,
         CASE WHEN pow(r, 1 - (low + high) / 2) <= {REPETITIONS} THEN (low + high) / 2 ELSE high END
  FROM bisect, spread WHERE step < {STEPS * ROUNDS}),
answer AS (SELECT high AS a FROM bisect WHERE step = {STEPS * ROUNDS}),
weights AS (SELECT source, size, pow(p, a) / (SELECT sum(pow(p, a)) FROM shares, answer) AS weight FROM shares, answer),
budget AS (SELECT max(size / weight) AS tokens FROM weights),
per_source AS (
  SELECT s.source, s.size, coalesce(w.weight, 0) AS weight,
         CASE WHEN s.size > 0 THEN (SELECT tokens FROM budget) * w.weight / s.size ELSE 1 END AS passes
  FROM sizes s LEFT JOIN weights w ON s.source IS NOT DISTINCT FROM w.source),
passed AS (
  SELECT b.source, b.block, b.tokens, p.size, p.weight, p.passes,
         unnest(range(greatest(CAST(ceil(p.passes - 1e-9) AS BIGINT), 1))) AS pass
  FROM sums b JOIN per_source p ON b.source IS NOT DISTINCT FROM p.source),
ordered AS (
  SELECT *, ('0x' || substr(md5(coalesce(source, 'null') || ':' || pass || ':' || block), 1, 8))::BIGINT AS o FROM passed),
walked AS (
  SELECT *, sum(tokens) OVER (PARTITION BY source, pass ORDER BY o, block ROWS UNBOUNDED PRECEDING) AS upto FROM ordered)
SELECT d.doc_id, d.source, w.pass::INTEGER AS pass, d.block, d.n_tokens,
       round(w.weight * 1e6)::BIGINT AS weight_ppm,
       round((w.pass + (w.upto - w.tokens / 2) / greatest(w.size, 1)) / w.passes * 1e6)::BIGINT AS place_ppm
FROM words d JOIN walked w ON d.source IS NOT DISTINCT FROM w.source AND d.block = w.block
WHERE w.pass + 1 <= w.passes + 1e-9 OR w.upto <= (w.passes - w.pass) * w.size
"""
