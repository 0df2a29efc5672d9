"""Resampling by importance towards a target distribution, over hashed features.

The features of a text are its runs of ``ngrams`` consecutive words; a feature's bucket is its crc32 modulo
``buckets``. Texts become inverted postings: for each bucket and batch of documents one row of the documents that
have it and how often. Postings are dealt out by bucket; a bucket's gain, the logarithm of how much likelier
it is in the target, is computed there from the counts of both corpora, which are summed before they are dealt out; what
each posting contributes is summed by document. The postings of a bucket that most documents have are many
rows, each of a bounded batch, so that adaptive execution can split its join. Ranks come from a sort by ranges: a row's
place in its range, and how many rows the ranges before it have.

Defined results: null and empty texts have no feature, weight 0, and are never drawn; rows with equal identifier are
documents of their own (same hash, ties in any order); a null identifier counts as an empty text in the hash and comes last on
ties. With an empty target all gains follow from the source's counts alone. Empty tables give empty results. Other
columns of either table, whatever their names, are neither read nor returned."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settings, utf8_buffers, written

BUCKETS = 10_000
LONG = 64  # bytes of a word from which it is hashed alone
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _crc_table() -> np.ndarray:
    """The table of the reflected polynomial that zlib uses, byte by byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of all words; ``data`` has small letters and begins at ``at[0]`` = 0."""
    inside = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def crc32_on(crc: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of what had ``crc``, followed by data[start:end], for each of them."""
    size = ends - starts
    out = crc.astype(np.uint32)
    for i in np.flatnonzero(size > LONG):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(crc[i]))
    short = np.flatnonzero(size <= LONG)
    order = short[np.argsort(-size[short], kind="stable")]
    longest = -size[order]
    state = ~out[order]
    for k in range(int(-longest[0]) if len(order) else 0):
        n = np.searchsorted(longest, -k, "left")  # those longer than k
        state[:n] = _CRC[(state[:n] ^ data[starts[order[:n]] + k]) & 0xFF] ^ (state[:n] >> 8)
    out[order] = ~state
    return out


def feature_hashes(data: np.ndarray, at: np.ndarray, ngrams: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and crc32 of each feature, and the words of each text."""
    starts, ends, of = words_of(data, at)
    space = np.array([32], np.uint8)
    texts, hashes = [], []
    crc = np.zeros(len(starts), np.uint32)
    for n in range(1, ngrams[1] + 1):
        left = max(0, len(starts) - n + 1)
        crc = crc[:left]
        if n > 1:
            crc = crc32_on(crc, space, np.zeros(left, np.int64), np.ones(left, np.int64))
        crc = crc32_on(crc, data, starts[n - 1 :], ends[n - 1 :])
        if n >= ngrams[0]:
            whole = of[:left] == of[n - 1 :]
            texts.append(of[:left][whole])
            hashes.append(crc[whole])
    return np.concatenate(texts), np.concatenate(hashes), np.bincount(of, minlength=len(at) - 1)


def postings(docs: DataFrame, id: str = "doc_id", text: str = "text", ngrams: tuple[int, int] = (1, 1), buckets: int = BUCKETS) -> DataFrame:
    """Inverted postings, and (where bucket is null) a batch's identifiers and counts.

    bucket, n (features), base, docs (a document is base + docs[i]), counts; ids, features, words."""
    kind = docs.select(F.col(f"`{id}`").alias("id")).schema["id"].dataType.simpleString()

    def invert(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        lists = lambda at, values: pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            raw, at = utf8_buffers(batch.column(1))
            data, at = _LOWER[raw[at[0] : at[-1]]], at - at[0]
            of, crc, words = feature_hashes(data, at, ngrams)
            keys, counts = np.unique((crc % np.uint32(buckets)).astype(np.int64) * n + of, return_counts=True)
            bucket = keys // n
            new = np.flatnonzero(np.diff(bucket, prepend=-1))
            sums = np.add.reduceat(counts, new) if len(new) else np.zeros(0, np.int64)
            m = len(new)
            head = [*np.append(new, len(keys)), len(keys)]  # the last row, of identifiers, has no postings
            none = [0] * (m + 1) + [n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*bucket[new].tolist(), None], pa.int32()),
                    pa.array([*sums.tolist(), 0], pa.int64()),
                    pa.array([base] * (m + 1), pa.int64()),
                    lists(head, pa.array((keys % n).astype(np.int32))),
                    lists(head, pa.array(counts.astype(np.int32))),
                    lists(none, batch.column(0)),
                    lists(none, pa.array(np.bincount(of, minlength=n).astype(np.int64))),
                    lists(none, pa.array(words.astype(np.int64))),
                ],
                ["bucket", "n", "base", "docs", "counts", "ids", "features", "words"],
            )
            base += n

    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(invert, f"bucket int, n bigint, base bigint, docs array<int>, counts array<int>, ids array<{kind}>, features array<bigint>, words array<bigint>")


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The gain of each bucket of the source, from the postings of both corpora."""
    count = lambda p, s, t: p.where("bucket IS NOT NULL").select("bucket", *[(F.col("n") if x else F.lit(0).cast("bigint")).alias(c) for x, c in ((s, "s"), (t, "t"))])
    counted = count(source, 1, 0).unionByName(count(target, 0, 1)).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    total = counted.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("s"), F.coalesce(F.sum("t"), F.lit(0)).alias("t")).first()
    ratio = (F.col("t") + 1).cast("double") * (total["s"] + buckets) / ((F.col("s") + 1).cast("double") * (total["t"] + buckets))
    return counted.where("s > 0").select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weights(source: DataFrame, gain: DataFrame) -> DataFrame:
    """doc, id, n_features, n_words and weight (floored mean gain) of each document of written postings."""
    met = source.where("bucket IS NOT NULL").select("bucket", "base", "docs", "counts").join(gain.hint("shuffle_hash"), "bucket")
    each = met.select("base", "gain", F.explode(F.arrays_zip("docs", "counts")).alias("x"))
    parts = each.select((F.col("base") + F.col("x.docs")).alias("doc"), (F.col("gain") * F.col("x.counts")).alias("part"))
    heads = source.where("bucket IS NULL").select("base", F.posexplode(F.arrays_zip("ids", "features", "words")).alias("at", "x"))
    heads = heads.select((F.col("base") + F.col("at")).alias("doc"), F.lit(0).cast("bigint").alias("part"), "x")
    summed = heads.unionByName(parts, allowMissingColumns=True).groupBy("doc").agg(F.sum("part").alias("sum"), F.any_value("x", ignoreNulls=True).alias("x"))
    rows = summed.select("doc", "sum", F.col("x.ids").alias("id"), F.col("x.features").alias("n_features"), F.col("x.words").alias("n_words"))
    return rows.withColumn("weight", F.expr("CASE WHEN n_features = 0 THEN 0L ELSE (sum - pmod(sum, n_features)) div n_features END")).drop("sum")


def ranked(rows: DataFrame, order: list, draw: int) -> DataFrame:
    """rows with ``rank`` in this order, null beyond ``draw``; no task holds more than a range of them."""
    spark = rows.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = written(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ranged")
    sizes = {r["range"]: r["n"] for r in placed.groupBy(F.shiftright("at", 33).alias("range")).agg(F.count("*").alias("n")).collect()}
    before, offsets = 0, []
    for k in sorted(sizes):  # one entry a range
        offsets.append((k, before))
        before += sizes[k]
    starts = F.broadcast(spark.createDataFrame(offsets, "range bigint, before bigint"))
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.withColumn("range", F.shiftright("at", 33)).join(starts, "range").withColumn("rank", F.when(rank <= draw, rank)).drop("range", "before", "at")


def resample(source: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", ngrams: tuple[int, int] = (1, 1), buckets: int = BUCKETS, least: int = 20, percent: int = 10, seed: str = "2024", target_text: str | None = None) -> DataFrame:
    """Weight, score and rank of every document of source; ``percent`` of those with ``least`` words are drawn without replacement.

    A score is the weight plus noise of the Gumbel distribution, both in thousandths, so that the highest are a weighted sample."""
    with settings(source.sparkSession, ARROW):
        mine = written(postings(source, id, text, ngrams, buckets), "postings")
        theirs = written(postings(target.withColumn("none", F.lit(0)), "none", target_text or text, ngrams, buckets), "postings")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    scored = written(weights(mine, gains(mine, theirs, buckets)).withColumn("score", F.col("weight") + noise), "scored")
    large = F.col("n_words") >= least
    draw = scored.where(large).count() * percent // 100
    in_order = ranked(scored.where(large), [F.desc("score"), F.asc_nulls_last("id"), F.asc("doc")], draw)
    out = in_order.unionByName(scored.where(~large).withColumn("rank", F.lit(None).cast("bigint")))
    return out.select(F.col("id").alias(id), "n_features", "weight", "score", "rank")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` towards ``benchmark``."""
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL11 = r"""
WITH RECURSIVE hexes AS (SELECT lower(printf('%02x', range)) AS h, range AS v FROM range(256)),
poly(v, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT v, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM poly WHERE k < 8),
tab AS (SELECT list(c ORDER BY v) AS t FROM poly WHERE k = 8),
d AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
both_texts AS (SELECT row, 0 AS target, text FROM d UNION ALL SELECT row_number() OVER (), 1, text FROM benchmark),
words AS (
  SELECT row, target, unnest(list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS word
  FROM both_texts),
kinds AS (SELECT DISTINCT word FROM words),
bytes AS (
  SELECT word, list_transform(range(1, strlen(word) + 1), lambda i: hex(encode(word))[2 * i - 1 : 2 * i]) AS b FROM kinds),
hashed(word, b, c, k) AS (
  SELECT word, b, 4294967295::BIGINT, 1 FROM bytes
  UNION ALL
  SELECT word, b, xor(c >> 8, (SELECT t FROM tab)[xor(c & 255, ('0x' || b[k])::BIGINT) + 1]), k + 1 FROM hashed WHERE k <= len(b)),
bucketed AS (SELECT word, xor(c, 4294967295) % 10000 AS bucket FROM hashed WHERE k = len(b) + 1),
f AS (SELECT row, target, bucket FROM words JOIN bucketed USING (word)),
c AS (SELECT bucket, count(*) FILTER (target = 0) AS s, count(*) FILTER (target = 1) AS t FROM f GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM c),
g AS (
  SELECT bucket, floor(1000 * ln((c.t + 1)::DOUBLE * (totals.s + 10000) / ((c.s + 1)::DOUBLE * (totals.t + 10000))))::BIGINT AS gain FROM c, totals),
w AS (
  SELECT d.row, d.doc_id, count(g.gain) AS n_features, coalesce(sum(g.gain), 0)::BIGINT AS total
  FROM d LEFT JOIN f ON f.row = d.row AND f.target = 0 LEFT JOIN g USING (bucket) GROUP BY d.row, d.doc_id),
v AS (
  SELECT *, CASE WHEN n_features = 0 THEN 0 ELSE ((total - ((total % n_features) + n_features) % n_features) // n_features)::BIGINT END AS weight,
         ('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT AS h
  FROM w),
x AS (SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))))::BIGINT AS score FROM v),
r AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM x WHERE n_features >= 20)
SELECT x.doc_id, x.n_features, x.weight, x.score,
       CASE WHEN r.rank <= (SELECT count(*) FROM r) * 10 // 100 THEN r.rank END AS rank
FROM x LEFT JOIN r USING (row)
"""
