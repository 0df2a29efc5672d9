"""URL filters: rules on hosts and paths, looked up in cascades of Bloom filters.

A rule (host, path, verdict) fits a url of its host or of a subdomain whose path starts with the rule's. All
rules that could fit a url are few keys, ``host suffix || path prefix``, of the shapes (labels of the host, length
of the path) that the list has. Which of these keys are listed is told by a cascade of Bloom filters over the
corpus's complete key universe: level 1 holds the listed keys, level 2 the corpus's unlisted keys that pass level
1, level 3 the listed keys that pass level 2, and so on until nothing passes wrongly. For every key of the
corpus the answer is exact, and it is an expression over the row: pages are neither joined nor shuffled.

What is sent to executors are the filters, as literals of at most ``FILTER_BYTES`` each; a longer list is cut by a
hash of its keys into parts, which are looked up one after the other.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule; where no rule
fits, the verdict is ``allow`` (no listed key is met) and the rule null. Of the rules that fit the longest wins
(characters of host and path together), on ties the one with the longer host. Equal rules with both verdicts
block. Rules with a null anywhere, or whose path neither is empty nor begins with ``/``, never fit. Empty tables
give empty results; repeated rows are judged each; other columns of pages pass through ``judged`` untouched, whatever
their names (its own four are renamed by underscores if they clash)."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, written

FILTER_BYTES = 4 << 20  # of one filter, at most
FIRST = (10, 7)  # bits a key and hashes, first level
LATER = (5, 3)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in small letters; then up to ``?``, ``#`` or the end."""
    pattern = r"://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def listed_keys(rules: DataFrame) -> DataFrame:
    """One row for each key of the list: key, labels, length (of its path), blocked."""
    host, path = F.translate("host", UPPER, LOWER), F.col("path")
    good = rules.where(F.col("host").isNotNull() & path.isNotNull() & F.col("verdict").isNotNull() & ((path == "") | path.startswith("/")) & (host != ""))
    keys = good.select(F.concat(host, path).alias("key"), F.size(F.split(host, r"\.", -1)).alias("labels"), F.length(path).alias("length"), (F.col("verdict") != "allow").alias("blocked"))
    return keys.groupBy("key", "labels", "length").agg(F.max("blocked").alias("blocked"))


def candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Keys of these shapes that a url has, as structs (size, host_size, key)."""
    labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1

    def one(labels_of: int, length: int) -> Column:
        key = F.concat(F.substring_index(host, ".", -labels_of), F.substring(path, 1, length))
        there = (labels >= labels_of) & (F.length(path) >= length) & (host != "")
        return F.when(there, F.struct(F.length(key).alias("size"), (F.length(key) - length).alias("host_size"), key.alias("key")))

    if not shapes:
        return F.array().cast("array<struct<size:int,host_size:int,key:string>>")
    return F.filter(F.array(*[one(*s) for s in shapes]), lambda c: c.isNotNull())


def _spots(key: Column, level: int, bits: int, hashes: int) -> Column:
    """Bit positions of a key in the filter of a level."""
    h = F.xxhash64(key, F.lit(level))
    low, high = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda j: F.pmod(low + j * high, F.lit(bits)))


class Filter:
    """A Bloom filter as words of 64 bits."""

    def __init__(self, keys: DataFrame, count: int, level: int, per_key: int, hashes: int):
        self.level, self.hashes = level, hashes
        self.bits = 64 * max(1, math.ceil(count * per_key / 64))
        spots = keys.select(F.explode(_spots(F.col("key"), level, self.bits, hashes)).alias("spot"))
        words = spots.groupBy(F.expr("spot div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(spot % 64 as int)))").alias("set"))
        there = {r["word"]: r["set"] for r in words.collect()} if count else {}  # self.bits / 64 rows at most
        self.words = json.dumps([there.get(w, 0) for w in range(self.bits // 64)])

    def passes(self, key: Column) -> Column:
        words = F.from_json(F.lit(self.words), "array<bigint>")  # folded into one literal
        return F.forall(_spots(key, self.level, self.bits, self.hashes), lambda p: F.getbit(F.get(words, F.floor(p / 64).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1)


class Cascade:
    """Exact membership of keys of a universe: ``listed`` against ``others``, tables of distinct keys.

    ``others`` gets the first filter and returns those keys beyond the list that pass it."""

    def __init__(self, listed: DataFrame, others, first: tuple[int, int] = FIRST, later: tuple[int, int] = LATER):
        inside, n = listed.select("key"), listed.count()
        self.filters = [Filter(inside, n, 1, *first)]
        wrong = written(others(self.filters[0]).select("key"), "passing")
        while n := wrong.count():
            self.filters.append(f := Filter(wrong, n, len(self.filters) + 1, *later))
            inside, wrong = wrong, written(inside.where(f.passes(F.col("key"))), "passing")

    def has(self, key: Column) -> Column:
        out = F.lit(len(self.filters) % 2 == 1)
        for k in range(len(self.filters), 0, -1):
            out = F.when(self.filters[k - 1].passes(key), out).otherwise(F.lit(k % 2 == 0))
        return out


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", first: tuple[int, int] = FIRST, later: tuple[int, int] = LATER, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Every page with host, path, rule and verdict.

    rules: host, path, verdict (``allow``, or it blocks). The distinct shapes of rules come to the driver."""
    host, path, rule, verdict, best = fresh(pages, "host", "path", "rule", "verdict", "best")
    listed = written(listed_keys(rules), "listed")
    shapes = sorted((r["labels"], r["length"]) for r in listed.select("labels", "length").distinct().collect())
    parts = max(1, math.ceil(listed.count() * first[0] / 8 / filter_bytes))
    part = lambda key: F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts))
    of_host, of_path = host_and_path(F.col(f"`{url}`").cast("string"))
    rows = pages.withColumns({host: of_host, path: of_path})
    keys = candidates(F.col(f"`{host}`"), F.col(f"`{path}`"), shapes)
    out = rows.withColumn(best, F.lit(None).cast("struct<size:int,host_size:int,key:string,blocked:boolean>"))

    def of_part(k: int) -> Column:
        """The longest listed key of a part that a url has."""
        mine = listed.where(part(F.col("key")) == k)

        def unlisted(f: Filter) -> DataFrame:
            universe = rows.select(F.explode(keys).alias("c")).select(F.col("c.key").alias("key"))
            return universe.where((part(F.col("key")) == k) & f.passes(F.col("key"))).distinct().join(mine, "key", "left_anti")

        members = Cascade(mine, unlisted, first, later)
        blocked = Cascade(mine.where("blocked"), lambda f: mine.where(~F.col("blocked") & f.passes(F.col("key"))), first, later)
        top = F.array_max(F.filter(keys, lambda c: (part(c["key"]) == k) & members.has(c["key"])))
        return F.when(top.isNotNull(), F.struct(top["size"].alias("size"), top["host_size"].alias("host_size"), top["key"].alias("key"), blocked.has(top["key"]).alias("blocked")))

    for k in range(parts):
        out = out.withColumn(best, F.greatest(F.col(f"`{best}`"), of_part(k)))
        if k < parts - 1:
            out = written(out, "judged")
    b = F.col(f"`{best}`")
    out = out.withColumns({rule: b["key"], verdict: F.when(b["blocked"], "block").otherwise("allow")})
    return out.select(*[F.col(f"`{c}`") for c in (*pages.columns, host, path, rule, verdict)])


RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``pages`` by the five rules."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judged(pages, rules).select("page_id", "host", "path", "rule", "verdict")


SQL13 = r"""
WITH rules(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (
  SELECT page_id, url, row_number() OVER () AS at,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
f AS (
  SELECT p.at, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.at ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM p LEFT JOIN f ON p.at = f.at AND f.k = 1
"""
