"""Document fingerprints: one-permutation MinHash of five-word shingles, all in Spark's own functions.

A shingle is hashed once; the top bits name its bin, the rest compete there. Sentinels, one for
each bin, are sorted in among the hashes, so that one ordered pass yields the least value of every
bin. An empty bin borrows from the first bin that has a value on a walk of its own through all bins
(optimal densification: start and stride are hashes of the bin alone). Of each bin the low bits are
packed, and likeness corrects the share of equal bins for equality by chance.

Defined results: a null text counts as empty; a text with no word has the empty fingerprint, which
is like another empty one (1) and unlike all others (0); a text with one to four words has one
shingle, of all its words; equal texts have equal fingerprints.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_or_empty, written
from .exact_dedup import sha256_text

WORDS = 5
BINS = 256
KEPT_BITS = 4
PER_LONG = 64 // KEPT_BITS
_SHIFT = 63 - (BINS.bit_length() - 1)
_EMPTY = (1 << _SHIFT) - 1
ROWS_PER_BUCKET = 2_000
QUANTILES = 1_024
BUCKETS_PER_GROUP = 1_024  # ranges whose first rows one task sees


def _long(x: int) -> Column:
    return F.lit(x).cast("bigint")


def _walks(seed: int = 11) -> tuple[Column, Column]:
    """A start and an odd stride for each bin: the walk meets every bin once."""
    rng = random.Random(seed)
    return F.array(*[F.lit(rng.randrange(BINS)) for _ in range(BINS)]), F.array(*[F.lit(rng.randrange(1, BINS, 2)) for _ in range(BINS)])


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with a column ``out``: the fingerprint as an array of longs (empty array: no word).

    Every step that a later one reads more than once is a column of its own."""
    h, s, d, m = (f"__{out}_{x}" for x in "hsdm")
    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    df = df.withColumn(h, F.transform(words, lambda w: F.xxhash64(w)))
    shingle = lambda x, i: F.shiftrightunsigned(F.xxhash64(x, *[F.get(F.col(h), i + k) for k in range(1, WORDS)]), 1)
    own = F.transform(F.slice(F.col(h), F.lit(1), F.greatest(F.size(h) - (WORDS - 1), F.least(F.size(h), F.lit(1)))), shingle)
    sentinels = F.array(*[_long((j << _SHIFT) | _EMPTY) for j in range(BINS)])
    df = df.withColumn(s, F.sort_array(F.concat(own, sentinels)))
    bin_of = lambda x: F.shiftright(x, _SHIFT)
    least = F.filter(F.col(s), lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col(s), i - 1))))
    df = df.withColumn(d, F.transform(least, lambda x: x.bitwiseAND(_long(_EMPTY))))
    df = df.withColumn(m, F.size(F.filter(F.col(d), lambda x: x != _EMPTY)))
    start, stride = _walks()
    full = F.col(d)

    def borrowed(j: Column) -> Column:
        at = lambda r: F.get(full, (F.get(start, j) + r * F.get(stride, j)).bitwiseAND(F.lit(BINS - 1)))
        among = lambda a, b: F.get(F.filter(F.transform(F.sequence(a, b), at), lambda x: x != _EMPTY), F.lit(0))
        soon = F.least(F.lit(BINS) - F.col(m), F.expr(f"cast(3 * {BINS} / `{m}` as int)"))
        return F.coalesce(among(F.lit(0), soon), among(F.lit(0), F.lit(BINS) - F.col(m)))

    dense = F.when(F.col(m) == 0, F.expr("cast(array() as array<bigint>)")).when(F.col(m) == BINS, full).otherwise(F.transform(full, lambda x, j: F.when(x != _EMPTY, x).otherwise(borrowed(j))))
    f = f"__{out}_f"
    df = df.withColumn(f, dense)
    low = _long((1 << KEPT_BITS) - 1)
    pack = lambda g: F.aggregate(F.slice(F.col(f), g * PER_LONG + 1, PER_LONG), _long(0), lambda a, x: F.shiftleft(a, KEPT_BITS).bitwiseOR(x.bitwiseAND(low)))
    groups = F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1))
    packed = F.when(F.size(f) == 0, F.expr("cast(array() as array<bigint>)")).otherwise(F.transform(groups, pack))
    return df.withColumn(out, packed).drop(h, s, d, m, f)


def hex_of(fp: Column) -> Column:
    """The fingerprint as a string: a hex digit for each bin."""
    return F.array_join(F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two fingerprints, 0 to 1, corrected for bins equal by chance."""
    ones = _long(int("1" * PER_LONG, 16))
    differ = lambda x: F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseOR(F.shiftright(x, 2)).bitwiseOR(F.shiftright(x, 3)).bitwiseAND(ones))
    wrong = F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)), F.lit(0), lambda n, x: n + differ(x))
    chance = 1 / (1 << KEPT_BITS)
    j = (1 - wrong / F.lit(BINS) - chance) / (1 - chance)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), j)))


def _bucketed(df: DataFrame, ids: DataFrame) -> DataFrame:
    """df with ``__bucket``, which descends with doc_id: quantiles, and even parts of each in large tables."""
    n = ids.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).first()
    q = max(1, min(QUANTILES, n["n"] // ROWS_PER_BUCKET))
    parts = max(1, n["n"] // (QUANTILES * 10 * ROWS_PER_BUCKET))
    if n["a"] is None:
        return df.withColumn("__bucket", _long(0))
    cuts = ids.agg(F.percentile_approx("doc_id", [i / q for i in range(1, q)] or [0.5], 20 * q).alias("x")).first()["x"] if q > 1 else []
    cuts = sorted({int(c) for c in cuts})
    edges = F.array(*[_long(x) for x in [n["a"], *cuts, n["b"] + 1]])
    k = F.size(F.filter(F.array(*[_long(c) for c in cuts]), lambda c: c <= F.col("doc_id"))) if cuts else F.lit(0)
    df = df.withColumn("__k", k)
    low, high = F.get(edges, F.col("__k")), F.get(edges, F.col("__k") + 1)
    part = F.floor((F.col("doc_id") - low) / F.greatest(high - low, _long(1)) * parts).cast("bigint")
    return df.withColumn("__bucket", F.coalesce(-(F.col("__k").cast("bigint") * parts + F.least(part, _long(parts - 1))), _long(1))).drop("__k")


def _next_heads(heads: DataFrame) -> DataFrame:
    """heads (__bucket, h) with ``n``, the h of the next bucket, after the last of the first.

    In two steps: within groups of buckets, and from group to group, a row each: at 50 billion documents
    some thousand."""
    heads = written(heads.withColumn("__g", F.floor(F.col("__bucket") / BUCKETS_PER_GROUP).cast("bigint")), "heads")
    line = Window.orderBy("__g")
    first = heads.groupBy("__g").agg(F.min(F.struct("__bucket", "h")).alias("f")).select("__g", F.col("f.h").alias("h"))
    ends = first.select("__g", F.coalesce(F.lead("h").over(line), F.first("h").over(line.rowsBetween(Window.unboundedPreceding, 0))).alias("__end"))
    within = F.lead("h").over(Window.partitionBy("__g").orderBy("__bucket"))
    return heads.withColumn("__lead", within).join(ends, "__g").select("__bucket", "h", F.coalesce("__lead", "__end").alias("n"))


def with_next(docs: DataFrame, finish, carry: list[str], out: str) -> DataFrame:
    """finish(docs) with a struct ``out`` of the next row's ``carry`` columns: by descending doc_id, after the last the first.

    docs is (doc_id, text); ``finish`` adds columns to rows, each by itself. Rows are dealt out by ranges of doc_id and sorted within; the first row of each range is looked
    up for the range before it. Null identifiers come last; ties go by a hash of the text."""
    ids = docs.select("doc_id")
    docs = docs.withColumn("__tie", F.xxhash64("text"))
    df = _bucketed(docs, ids)
    heads = _next_heads(df.groupBy("__bucket").agg(F.max(F.struct("doc_id", "__tie")).alias("h")))
    heads = written(heads.select(F.col("__bucket").alias("__b"), F.col("n.doc_id").alias("__id"), F.col("n.__tie").alias("__t")), "heads")
    small = heads.count() <= 10_000  # three numbers a row
    edge = docs.join(F.broadcast(heads) if small else heads, docs["doc_id"].eqNullSafe(heads["__id"]) & (docs["__tie"] == heads["__t"]))
    edge = edge.groupBy(F.col("__b").alias("__bucket")).agg(F.any_value("doc_id").alias("doc_id"), F.any_value("text").alias("text"))
    edge = finish(edge).select("__bucket", F.struct(*carry).alias("__edge"))
    order = Window.partitionBy("__bucket").orderBy(F.col("doc_id").desc_nulls_last(), F.col("__tie").desc())
    df = finish(df).withColumn("__lead", F.lead(F.struct(*carry)).over(order)).join(edge, "__bucket", "left")
    return df.withColumn(out, F.coalesce("__lead", "__edge")).drop("__lead", "__edge", "__bucket", "__tie")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and its likeness to this and the next document."""
    df = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    df = with_next(df, lambda rows: with_fingerprint(rows, "text", "fp"), ["text", "fp"], "next")
    n, cut = F.length("text").cast("bigint"), F.expr("cast(length(text) div 3 as int)")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - cut), F.substring(F.col("next.text"), F.lit(1), cut))
    df = df.select("doc_id", n.alias("n_chars"), edited.alias("edited"), "fp", F.col("next.fp").alias("next_fp"))
    df = with_fingerprint(df, "edited", "edited_fp")
    return df.select(
        "doc_id", "n_chars", sha256_text(F.col("edited")).alias("edited_sha256"), hex_of(F.col("fp")).alias("fingerprint"), hex_of(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
