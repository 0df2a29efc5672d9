"""Mixing sources to target weights by Sainte-Laguë apportionment.

The seats of the mix are its words. Sources get them by highest quotients of their targets
(t / 1, t / 3, t / 5, ...), within a source so do groups of ``SHARDS_PER_GROUP`` shards, by their words,
and within a group its shards. In a shard the
documents lie end to end in a seeded order; the shard's quota takes all its words as often as it
divides, and the rest by blocks in a seeded permutation, of the last one only the first words that
are due. Blocks bound the plan, not what is taken. Texts are read once, for their sizes; only
identifiers and sizes are shuffled. A source has as many shards as its documents need, so a
source with a third of all rows is dealt out over many tasks.

Defined results: a null text has size 0; a null source is a source of its own, after all others;
rows of size 0 are taken 0 times; an empty table gives an empty result; rows equal in doc_id and
text are rows of their own, which share the words the mix takes from both in either order.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh, located, place, text_or_empty, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3  # times that the mix may take a word
BLOCKS_PER_SOURCE = 20_000
MOST_BLOCK = 4096
DOCS_PER_SHARD = 2_000
SHARDS_PER_GROUP = 4_096  # of a source of n documents one task sees n / 8 million groups, another 4,096 shards
MOST_SOURCES = 1_000_000  # the inventory of sources is planned on the driver; more are refused
STRIDE = 2_147_483_647  # a prime above any shard's number of blocks


def apportion(claims: list[float], seats: int, caps: list[int] | None = None) -> list[int]:
    """Seats by highest quotients claim / (2 n + 1), none above its cap; ties go to the first.

    Rounded shares of one divisor are an apportionment of their own sum; from there single seats
    are given or taken by quotient, which leads to the same seats as a count from nothing."""
    total = math.fsum(claims)
    caps = caps or [seats] * len(claims)
    if total <= 0 or seats <= 0:
        return [0] * len(claims)
    n = [min(cap, int(c * seats / total + 0.5)) for c, cap in zip(claims, caps, strict=True)]
    excess = sum(n) - seats
    if excess > 0:
        heap = [(c / (2 * k - 1), -i) for i, (c, k) in enumerate(zip(claims, n, strict=True)) if k]
        heapq.heapify(heap)
        for _ in range(excess):
            i = -heapq.heappop(heap)[1]
            n[i] -= 1
            if n[i]:
                heapq.heappush(heap, (claims[i] / (2 * n[i] - 1), -i))
    elif excess < 0:
        heap = [(-c / (2 * k + 1), i) for i, (c, k, cap) in enumerate(zip(claims, n, caps, strict=True)) if k < cap and c > 0]
        heapq.heapify(heap)
        for _ in range(-excess):
            if not heap:
                break
            i = heapq.heappop(heap)[1]
            n[i] += 1
            if n[i] < caps[i]:
                heapq.heappush(heap, (-claims[i] / (2 * n[i] + 1), i))
    return n


def targets(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Shares of all words by weight; what is above ``most`` times a source's words is shared anew."""
    total, full, out = float(sum(sizes)), set(), [0.0] * len(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in full]
        left = total - math.fsum(most * sizes[i] for i in full)
        whole = math.fsum(weights[i] for i in free)
        for i in free:
            out[i] = left * weights[i] / whole
        over = [i for i in free if out[i] > most * sizes[i]]
        for i in over:
            out[i] = float(most * sizes[i])
        full.update(over)
        if not over or len(full) == len(sizes):
            return out


def sized(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, words and a digest of each row; written, as all that follows works on it."""
    text = text_or_empty()
    return written(docs.select(*carry, "doc_id", F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"), F.xxhash64(text).alias("digest")), "sizes")


def plan_sources(rows: DataFrame, weights=WEIGHTS, docs_per_shard: int = DOCS_PER_SHARD, block: int | None = None) -> tuple[list[dict], int]:
    """The mix's sources (by code point, null last) with targets and seats (words), and the words in a block."""
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in found]
    want = targets(sizes, [weights[i % len(weights)] for i in range(len(found))]) if found else []
    block = block or max(1, min(MOST_BLOCK, sum(sizes) // (BLOCKS_PER_SOURCE * max(1, len(found)))))
    seats = apportion(want, round(math.fsum(want)), [MOST * s for s in sizes]) if found else []
    return [
        {"source": r["source"], "idx": i, "source_size": r["size"], "target": want[i], "seats": seats[i], "shards": max(1, -(-r["n"] // docs_per_shard))}
        for i, r in enumerate(found)
    ], block


PLAN = "source string, idx int, source_size bigint, target double, seats bigint, shards bigint"


def _quotas(pdf: pd.DataFrame) -> pd.DataFrame:
    """The seats of a row's parent among the rows, by their words."""
    pdf = pdf.sort_values("part")
    pdf["quota"] = apportion([float(w) for w in pdf["words"]], int(pdf["seats"].iloc[0]), [MOST * int(w) for w in pdf["words"]])
    return pdf[["idx", "parent", "part", "words", "quota"]]


def shard_quotas(shards: DataFrame, per_group: int = SHARDS_PER_GROUP) -> DataFrame:
    """(idx, shard, words, quota) of a written table (idx, shard, words, seats): a source's seats among groups of shards, a group's among its shards."""
    schema = "idx int, parent bigint, part bigint, words bigint, quota bigint"
    group = F.expr(f"shard div {per_group}")
    groups = shards.groupBy("idx", F.lit(0).cast("bigint").alias("parent"), group.alias("part")).agg(F.sum("words").alias("words"), F.first("seats").alias("seats"))
    seats = groups.groupBy("idx", "parent").applyInPandas(_quotas, schema).select("idx", F.col("part").alias("parent"), F.col("quota").alias("seats"))
    parts = shards.select("idx", group.alias("parent"), F.col("shard").alias("part"), "words").join(seats, ["idx", "parent"])
    return parts.groupBy("idx", "parent").applyInPandas(_quotas, schema).select("idx", F.col("part").alias("shard"), "words", "quota")


def placed(rows: DataFrame, plan: list[dict], seed: int) -> DataFrame:
    """Each row with its source's plan, its place in its shard (first word) and the shard's quota."""
    spark = rows.sparkSession
    sources = spark.createDataFrame([tuple(p.values()) for p in plan], PLAN)
    if len(plan) <= 10_000:
        sources = F.broadcast(sources)  # at most 10,000 rows of a name and five numbers
    rows = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    order = F.xxhash64(F.col("doc_id"), F.col("digest"), F.lit(seed))
    rows = rows.withColumns({"order": order, "shard": F.pmod(F.xxhash64(order, F.lit(seed + 1)), F.col("shards"))})
    shards = written(rows.groupBy("idx", "shard").agg(F.sum("size").alias("words"), F.first("seats").alias("seats")), "shards")
    quotas = shard_quotas(shards)
    line = Window.partitionBy("idx", "shard").orderBy("order", "doc_id", "digest")
    rows = rows.withColumn("start", F.sum("size").over(line) - F.col("size"))
    return rows.join(quotas, ["idx", "shard"])


def _overlaps(block: int, seed: int) -> tuple[Column, Column]:
    """Whole passes over the shard, and of the last pass the runs of a row's words that are taken."""
    words, m = F.col("words"), F.ceil(F.col("words") / F.lit(block)).cast("bigint")
    passes, rest = F.expr("quota div greatest(1, words)"), F.pmod(F.col("quota"), F.greatest(F.lit(1), words))
    offset = F.pmod(F.xxhash64(F.col("idx"), F.col("shard"), F.lit(seed + 2)), F.greatest(F.lit(1), m))
    turn = lambda i: F.pmod(i * F.lit(STRIDE) + offset, m)
    blocks = F.when((F.col("size") > 0) & (rest > 0), F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).otherwise(F.expr("array()").cast("array<bigint>"))

    def run(i: Column) -> Column:
        lack = F.when(turn(i) > turn(m - 1), m * block - words).otherwise(0)  # the last block is short
        there = F.least(F.lit(block), words - i * block)
        due = F.greatest(F.lit(0), F.least(there, rest - turn(i) * block + lack))
        return F.struct(F.greatest(i * block - F.col("start"), F.lit(0)).alias("first"), F.least(i * block + due - F.col("start"), F.col("size")).alias("end"))

    return passes, F.filter(F.transform(blocks, run), lambda x: x["end"] > x["first"])


def mix(docs: DataFrame, seed: int = 17, weights=WEIGHTS, docs_per_shard: int = DOCS_PER_SHARD, block: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row for each row of docs: the columns to carry, doc_id, digest, size, source_size, target, taken, passes, and ranges.

    ``ranges`` holds first and end (exclusive) of the runs of the row's words that the last, partial
    pass takes; ``taken`` is ``passes`` times the size and those. The same input and seed give the
    same rows."""
    rows = sized(docs, carry)
    plan, block = plan_sources(rows, weights, docs_per_shard, block)
    passes, ranges = _overlaps(block, seed)
    rows = placed(rows, plan, seed).select(*carry, "doc_id", "digest", "source", "size", "source_size", "target", passes.alias("passes"), ranges.alias("ranges"))
    part = F.aggregate("ranges", F.lit(0).cast("bigint"), lambda a, r: a + r["end"] - r["first"])
    return rows.withColumn("taken", F.col("passes") * F.col("size") + part)


def mixed_documents(docs: DataFrame, seed: int = 17, weights=WEIGHTS) -> DataFrame:
    """The mix as documents: a row as often as it is taken whole, and one with the words of its partial take.

    Rows of which the mix takes no word go. Columns are those of docs; n_chars is counted anew."""
    docs = located(docs)
    file, row, passes, ranges, words, part = fresh(docs, "at_file", "at_row", "times", "runs", "words", "part")
    at = dict(zip((file, row), place(docs), strict=True))
    take = mix(docs.withColumns(at), seed, weights, carry=(file, row)).where("taken > 0").select(file, row, F.col("passes").alias(passes), F.col("ranges").alias(ranges))
    rows = docs.withColumns(at).join(take, [file, row])
    some, none = F.size(ranges) > 0, F.expr("cast(array() as array<string>)")
    rows = rows.withColumn(words, F.when(some, F.regexp_extract_all(text_or_empty(), F.lit(WORD), F.lit(0))))
    runs = F.flatten(F.transform(ranges, lambda r: F.slice(F.col(words), (r["first"] + 1).cast("int"), (r["end"] - r["first"]).cast("int"))))
    rows = rows.withColumn(part, F.when(some, F.array(F.array_join(runs, " "))).otherwise(none))
    rows = rows.withColumn("text", F.explode(F.concat(F.array_repeat(text_or_empty(), F.col(passes).cast("int")), F.col(part))))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: the words that the mix takes of each."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")
