"""URL rules by a cascade of Bloom filters, with built-in functions only.

A rule names a host with its subdomains and the start of a path, and blocks or allows. The
keys of a URL are its host's suffixes (at dots) joined with the starts of its path, of those
numbers of labels and those lengths that rules have. The universe is the set of keys of the whole corpus. Level 1
encodes the listed keys; level 2 those keys of the universe that level 1 passes wrongly;
level 3 the listed ones that level 2 passes, and so on until no level passes anything wrongly. The
first level that does not pass a key tells on which side it is: membership is exact for every
key of the universe, without a join, and filters are small since each level encodes the
errors of the one before. Blocking and allowing rules have a cascade each.

Filters travel as constants in the plan. They hold ``BITS_PER_KEY`` bits per listed key or
error; a list that needs more than ``FILTER_BITS`` bits in all is joined by its keys instead.

Of the rules that fit, the longest (host and path together) decides; of two of one length,
the one with the longer host, then the smaller text. Rules listed on both sides block. URLs
without ``://`` and null ones have an empty host and path, and fit no rule; no rule means
``default``. Empty rule hosts are passed over. Repeated rows are judged alike; an empty table
gives an empty result. Other columns pass through ``judged``, except those it adds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import read, stored

BITS_PER_KEY = 16
HASHES = 5
FILTER_BITS = 1 << 22
LEVELS = 64
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lower = F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: Column, path: Column, lengths: Sequence[int], labels: Sequence[int]) -> Column:
    """Keys a rule could have to fit, the deciding one first; a host is told from a path by
    the first ``/`` or, for empty paths, by the end. Only suffixes of as many ``labels`` as some
    rule's host has are made, however long the host is."""
    own = F.split(host, r"\.")
    suffixes = F.transform(
        F.filter(F.array(*map(F.lit, sorted(labels, reverse=True))), lambda n: n <= F.size(own)),
        lambda n: F.array_join(F.slice(own, F.size(own) - n + 1, n), "."),
    )
    keys = F.flatten(
        F.transform(
            F.filter(suffixes, lambda s: s != ""),
            lambda s: F.filter(
                F.array(*(F.when(F.length(path) >= n, F.struct(
                    (-(F.length(s) + n)).alias("rank"), (-F.length(s)).alias("host"), F.concat(s, F.substring(path, 1, n)).alias("key")
                )) for n in sorted(lengths))),
                lambda k: k.isNotNull(),
            ),
        )
    )
    return F.transform(F.array_sort(keys), lambda k: k["key"])


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    first, second = F.xxhash64(key, F.lit(2 * level)), F.xxhash64(key, F.lit(2 * level + 1))
    half = F.lit(1 << 31)
    return [F.pmod(F.pmod(first, half) + F.lit(i) * F.pmod(second, half), F.lit(bits)) for i in range(HASHES)]


def bloom(keys: DataFrame, level: int, bits: int) -> str:
    """A filter over ``key`` as text: 32-bit words with commas. Bits are made distinct per
    word before the driver gets them: never more than the words of ``FILTER_BITS``."""
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), level, bits))).alias("at"))
    words = at.groupBy(F.expr("at div 32").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(at % 32))")).alias("held"))
    held = dict(words.collect())
    return ",".join(str(held.get(i, 0)) for i in range(-(-bits // 32)))


def passes(key: Column, level: int, bits: int, words: str) -> Column:
    """Whether a filter passes ``key``. The words are a folded constant of the plan."""
    array = F.split(F.lit(words), ",").cast("array<bigint>")
    tests = [
        F.call_function("getbit", F.element_at(array, (F.floor(at / 32) + 1).cast("int")), (at % 32).cast("int")) == 1
        for at in _positions(key, level, bits)
    ]
    return reduce(lambda a, b: a & b, tests)


class Cascade:
    """Levels of filters for one list of keys over one universe."""

    def __init__(self, listed: DataFrame, universe: DataFrame, bits_per_key: int = BITS_PER_KEY, most_bits: int = FILTER_BITS) -> None:
        self.levels: list[tuple[int, str]] = []
        self.too_large = False
        listed = stored(listed.select("key").where("key IS NOT NULL").distinct(), "listed-keys")
        self.listed = listed
        inside = listed.join(universe, "key", "left_semi")
        outside = universe.join(listed, "key", "left_anti")
        inside, outside = stored(inside, "listed"), stored(outside, "unlisted")
        spent = 0
        for level in range(LEVELS):
            wanted, other = (inside, outside) if level % 2 == 0 else (outside, inside)
            count = wanted.count()
            if not count:
                return
            bits = max(64, count * bits_per_key)
            spent += bits
            if spent > most_bits:
                self.too_large = True
                return
            words = bloom(wanted, level, bits)
            self.levels.append((bits, words))
            wrong = stored(other.where(passes(F.col("key"), level, bits, words)), "passed-wrongly")
            inside, outside = (inside, wrong) if level % 2 == 0 else (wrong, outside)
        self.too_large = True  # not even one key apart after all levels

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the parity of the first level that does
        not pass it."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            bits, words = self.levels[level]
            out = F.when(~passes(key, level, bits, words), F.lit(level % 2 == 1)).otherwise(out)
        return out


def judged(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    bits_per_key: int = BITS_PER_KEY,
    most_bits: int = FILTER_BITS,
) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``; ``rules`` has host, path and verdict."""
    rules = rules.where("coalesce(host, '') <> ''").select(
        F.concat(F.col("host"), F.coalesce("path", F.lit(""))).alias("key"),
        F.length(F.coalesce("path", F.lit(""))).alias("length"),
        F.size(F.split("host", r"\.")).alias("labels"),
        "verdict",
    )
    lengths, labels = ([r[0] for r in rules.select(c).distinct().collect()] for c in ("length", "labels"))
    pages = pages.drop("host", "path", "rule", "verdict", "_keys")
    named = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    named = named.withColumn("_keys", keys_of(F.col("host"), F.col("path"), lengths, labels) if lengths else F.array().cast("array<string>"))
    universe = stored(named.select(F.explode("_keys").alias("key")).distinct(), "url-keys")
    sides = {v: Cascade(rules.where(F.col("verdict") == v), universe, bits_per_key, most_bits) for v in ("block", "allow")}
    if any(c.too_large for c in sides.values()):
        return _joined(named, rules, default)
    block, allow = sides["block"], sides["allow"]
    fits = F.filter("_keys", lambda k: block.holds(k) | allow.holds(k))
    named = named.withColumn("rule", F.get(fits, F.lit(0))).drop("_keys")
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(block.holds(F.col("rule")), F.lit("block")).otherwise("allow")
    return named.withColumn("verdict", verdict)


def _joined(named: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same by a join on distinct keys, for lists too large for a constant."""
    known = rules.groupBy("key").agg(F.max("verdict").alias("_verdict"))
    row = F.struct(*named.columns)
    keyed = named.select(F.monotonically_increasing_id().alias("_row"), row.alias("_all"))
    keyed = stored(keyed, "urls")
    keys = keyed.select("_row", F.posexplode("_all._keys").alias("_at", "key")).join(known, "key")
    best = keys.groupBy("_row").agg(F.min(F.struct("_at", "key", "_verdict")).alias("_best"))
    out = keyed.join(best, "_row", "left").select("_all.*", "_best").drop("_keys")
    return out.select("*", F.col("_best.key").alias("rule"), F.coalesce("_best._verdict", F.lit(default)).alias("verdict")).drop("_best")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP4_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                          ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT parts.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""
