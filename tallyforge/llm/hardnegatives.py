"""Hard negatives by product quantisation with bounds that never miss.

Components are scaled and floored to integers, and a row's score for an anchor is their integer inner product. A row is
coded as the nearest of 256 integer centroids in each pair of dimensions, and keeps the norm of what the code leaves
over. For an anchor, the scores of all centroids are a table; a row's score is the sum of its codes' entries, plus or
minus the anchor's norm times the row's residual norm (Cauchy and Schwarz). In a block of rows only those whose
interval can still reach the block's best are scored exactly, so that results equal those of scoring all pairs.

Anchors are a stated query set: they meet all rows in blocks of ``ANCHORS`` by ``ROWS``. Of rows of equal vector and
label only the first few by identifier can be among the best, and anchors of equal vector and label are asked for
once. Centroids are fitted on ``SAMPLE`` rows (by a hash); they bear on speed alone.

Defined results: rows without identifier, label or vector, or with a null or non-finite component, take no part; shorter vectors
are padded with zeros; repeated rows are rows of their own, ties go by identifier. Components must stay
below 2^23 in magnitude, scaled, else the query ends with an error. Empty tables give empty results. Other columns,
whatever their names, are neither read nor returned."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settings, written

SAMPLE, ROUNDS, CENTROIDS = 2048, 5, 256
ANCHORS, ROWS = 512, 4096  # of a block
LARGEST = 1 << 23
CELLS = 1 << 19  # scores that are held at once
NONE = -(1 << 62)


def packed(rows: DataFrame, dims: int, scale: int) -> DataFrame:
    """id, label, anchor, q: components as 32-bit integers in bytes."""

    def pack(batches):
        import pyarrow as pa

        for b in batches:
            x = b.column(3)
            at = x.offsets.to_numpy().astype(np.int64) if b.num_rows else np.zeros(1, np.int64)
            values = x.values.to_numpy(zero_copy_only=False)
            q = np.zeros((b.num_rows, dims))
            size = np.diff(at)
            row = np.repeat(np.arange(b.num_rows), size)
            q[row, np.arange(at[0], at[-1]) - np.repeat(at[:-1], size)] = np.floor(scale * values[at[0] : at[-1]])
            if q.size and np.abs(q).max() >= LARGEST:
                raise ValueError(f"components of vectors must stay below {LARGEST / scale:g}")
            data = pa.py_buffer(q.astype("<i4").tobytes())
            ends = pa.py_buffer((np.arange(b.num_rows + 1) * 4 * dims).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.BinaryArray.from_buffers(pa.binary(), b.num_rows, [None, ends, data])], ["id", "label", "anchor", "q"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "label", "anchor", "x").mapInArrow(pack, f"id {kind}, label string, anchor boolean, q binary")


def matrix(column, width: int, kind: str) -> np.ndarray:
    """A binary column of equal lengths as rows of numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def fit(sample: np.ndarray) -> np.ndarray:
    """Integer centroids (pairs of dimensions, at most CENTROIDS, 2) by k-means, of each pair of dimensions alone."""
    n, dims = sample.shape
    k = min(CENTROIDS, n)
    out = np.zeros((dims // 2, k, 2), np.int64)
    for m in range(dims // 2):
        x = sample[:, 2 * m : 2 * m + 2].astype(np.float64)
        c = x[np.linspace(0, n - 1, k).astype(int)].copy()
        for _ in range(ROUNDS):
            near = nearest(x, c)
            size = np.bincount(near, minlength=k)
            for d in range(2):
                c[:, d] = np.where(size > 0, np.bincount(near, x[:, d], minlength=k) / np.maximum(size, 1), c[:, d])
        out[m] = np.rint(c)
    return out


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)


def coded(rows: DataFrame, book: np.ndarray) -> DataFrame:
    """rows with codes (a byte for each pair of dimensions) and residual (the norm of what they leave over)."""
    shared = rows.sparkSession.sparkContext.broadcast(book)  # CENTROIDS numbers a dimension

    def code(batches):
        import pyarrow as pa

        book = shared.value
        for b in batches:
            q = matrix(b.column("q"), 2 * len(book), "<i4").astype(np.int64)
            codes = np.zeros((len(q), len(book)), np.uint8)
            left = q.copy()
            for m, c in enumerate(book):
                codes[:, m] = nearest(q[:, 2 * m : 2 * m + 2].astype(np.float64), c.astype(np.float64))
                left[:, 2 * m : 2 * m + 2] -= c[codes[:, m]]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(np.sqrt((left * left).sum(1).astype(np.float64)))], [*b.schema.names, "codes", "residual"])

    return rows.mapInArrow(code, rows.select("*").schema.add("codes", "binary").add("residual", "double"))


def bounds(q: np.ndarray, book: np.ndarray, codes: np.ndarray, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of each anchor with each row, by the anchors' tables."""
    score = np.zeros((len(q), len(codes)), np.int64)
    for m, c in enumerate(book):
        score += np.take(q[:, 2 * m : 2 * m + 2] @ c.T, codes[:, m], axis=1)
    norm = np.sqrt((q * q).sum(1).astype(np.float64))
    off = np.ceil(norm[:, None] * residual * (1 + 1e-9) + 1e-6).astype(np.int64)  # rounded to the safe side
    return score - off, score + off


def top(of: np.ndarray, rows: np.ndarray, scores: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Positions of the first ``most`` of each ``of``: higher scores first, then by ``order`` of the row."""
    by = np.lexsort((order[rows], -scores, of))
    start = np.searchsorted(of[by], of[by], "left")
    return by[np.arange(len(by)) - start < most]


def best_in_block(q, marks, allowed, book, v, codes, residual, order, most: int, low: int, high: int):
    """(anchor, mark, row, score) of the best rows of a block for each anchor and mark, exactly.

    marks: for each anchor a list of positive scores, whose windows limit the rows; None: one window without limits."""
    found = [[], [], [], []]
    step = max(1, CELLS // max(1, len(v)))
    for a in range(0, len(q), step):
        mine = allowed(slice(a, a + step))
        lo, hi = bounds(q[a : a + step], book, codes, residual)
        for k in range(1 if marks is None else max((len(x) for x in marks[a : a + step]), default=0)):
            if marks is None:
                here, least, most_of = np.ones(len(lo), bool), np.full(len(lo), NONE), np.full(len(lo), -NONE)
            else:
                here = np.array([len(x) > k for x in marks[a : a + step]])
                least = np.array([-((-low * x[k]) // 100) if len(x) > k else 0 for x in marks[a : a + step]])
                most_of = np.array([high * x[k] // 100 if len(x) > k else -1 for x in marks[a : a + step]])
            sure = np.where(mine & here[:, None] & (lo >= least[:, None]) & (hi <= most_of[:, None]), lo, NONE)
            reach = np.partition(sure, -most, axis=1)[:, -most] if sure.shape[1] >= most else np.full(len(sure), NONE)
            who, row = np.nonzero(mine & here[:, None] & (hi >= np.maximum(least, reach)[:, None]) & (lo <= most_of[:, None]))
            for part in range(0, len(who), CELLS):  # the exact scores of what may be among the best
                w, r = who[part : part + CELLS], row[part : part + CELLS]
                score = np.concatenate([np.einsum("ij,ij->i", q[a + w[i : i + 4096]], v[r[i : i + 4096]]) for i in range(0, len(w), 4096)])
                good = (score >= least[w]) & (score <= most_of[w])
                w, r, score = w[good], r[good], score[good]
                keep = top(w, r, score, order, most)
                for out, x in zip(found, (a + w[keep], [k] * len(keep), r[keep], score[keep]), strict=True):
                    out.extend(x)
    return [np.array(x, np.int64) for x in found]


def met(queries: DataFrame, rows: DataFrame, book: np.ndarray, most: int, same: bool, low: int = 0, high: int = 0) -> DataFrame:
    """qid, mark (null for positives), key, id, score: the best rows of each block for each query."""
    spark = rows.sparkSession
    blocks, groups = max(1, -(-rows.count() // ROWS)), max(1, -(-queries.count() // ANCHORS))
    shared = spark.sparkContext.broadcast(book)
    kind = rows.schema["id"].dataType.simpleString()

    def block(queries, rows):
        import pyarrow as pa
        import pyarrow.compute as pc

        book = shared.value
        names = pa.schema([("qid", pa.int64()), ("mark", pa.int64()), ("key", pa.int64()), ("id", rows.schema.field("id").type), ("score", pa.int64())])
        if not queries.num_rows or not rows.num_rows:
            return names.empty_table()
        dims = 2 * len(book)
        q, v = (matrix(t.column("q"), dims, "<i4").astype(np.int64) for t in (queries, rows))
        codes = matrix(rows.column("codes"), len(book), np.uint8)
        labels, of = np.unique(np.array(queries.column("label").to_pylist() + rows.column("label").to_pylist()), return_inverse=True)
        mine, theirs = of[: len(q)], of[len(q) :]
        order = np.empty(len(v), np.int64)
        order[pc.sort_indices(rows.select(["id", "key"]), [("id", "ascending"), ("key", "ascending")]).to_numpy()] = np.arange(len(v))
        residual = rows.column("residual").to_numpy()
        parts = []
        if same:  # each label meets its own rows alone
            for k in range(len(labels)):
                a, r = np.flatnonzero(mine == k), np.flatnonzero(theirs == k)
                if len(a) and len(r):
                    w, _, x, s = best_in_block(q[a], None, lambda i, n=len(r): np.ones((1, n), bool), book, v[r], codes[r], residual[r], order[r], most, low, high)
                    parts.append((a[w], None, r[x], s))
        else:
            marks = queries.column("marks").to_pylist()
            w, k, x, s = best_in_block(q, marks, lambda i: mine[i, None] != theirs, book, v, codes, residual, order, most, low, high)
            parts.append((w, np.array([marks[i][j] for i, j in zip(w, k, strict=True)], np.int64), x, s))
        tables = [
            pa.Table.from_arrays([queries.column("qid").take(w), pa.nulls(len(w), pa.int64()) if m is None else pa.array(m), rows.column("key").take(x), rows.column("id").take(x), pa.array(s)], schema=names)
            for w, m, x, s in parts
        ]
        return pa.concat_tables(tables) if tables else names.empty_table()

    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("g", F.pmod(F.xxhash64("qid"), F.lit(groups)).cast("int")).withColumn("b", each(blocks))
    right = rows.select("key", "id", "label", "q", "codes", "residual").withColumn("b", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).withColumn("g", each(groups))
    return left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInArrow(block, f"qid bigint, mark bigint, key bigint, id {kind}, score bigint")


def first(rows: DataFrame, by: list[str], order: list, most: int, name: str = "place") -> DataFrame:
    """The first rows of each group; Spark drops the others before they are dealt out."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= most)


def mine(rows: DataFrame, anchor: Column, id: str = "vec_id", label: Column | str = "label", vector: str = "embedding", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Of each anchor and each of its first ``positives`` other rows of the same label, the first ``negatives`` rows of other
    labels with low * positive score <= 100 * score <= high * positive score."""
    spark = rows.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    x = F.col(f"`{vector}`").cast("array<double>")
    taken = rows.select(F.col(f"`{id}`").alias("id"), label.cast("string").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), x.alias("x"))
    taken = taken.where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL AND forall(x, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('inf'))")
    dims = taken.agg(F.max(F.size("x"))).first()[0] or 0
    dims = max(2, dims + dims % 2)
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "4096"}):
        base = written(packed(taken, dims, scale).withColumn("key", F.monotonically_increasing_id()), "vectors")
        # beyond these, rows of equal vector and label are never among the best
        useful = first(base, ["label", "q"], ["id", "key"], max(positives + 1, negatives)).select("key", "id", "label", "q")
        sample = useful.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("q").collect()  # bounded
        book = fit(np.frombuffer(b"".join(bytes(r["q"]) for r in sample), "<i4").reshape(-1, dims)) if sample else np.zeros((dims // 2, 1, 2), np.int64)
        table = written(coded(useful, book), "coded")
        asked = base.where("anchor")
        queries = written(asked.groupBy("label", "q").agg(F.min("key").alias("qid")), "queries")
        order = [F.desc("score"), F.asc("id"), F.asc("key")]
        tops = written(first(met(queries, table, book, positives + 1, True), ["qid"], order, positives + 1).select("qid", "key", "id", "score"), "tops")
        own = asked.select(F.col("key").alias("anchor_key"), F.col("id").alias("anchor_id"), "label", "q").join(queries, ["label", "q"]).drop("label", "q")
        pairs = first(own.join(tops, "qid").where("key <> anchor_key"), ["anchor_key"], order, positives)
        pairs = pairs.select("qid", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        marks = tops.groupBy("qid").agg(F.sort_array(F.collect_set("score")).alias("marks"))  # positives + 1 at most
        windows = met(queries.join(marks, "qid"), table, book, negatives, False, low, high)
        chosen = written(first(windows, ["qid", "mark"], order, negatives, "rank"), "negatives")
    chosen = chosen.select("qid", F.col("mark").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(chosen, ["qid", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``embeddings``: anchors are the rows whose vec_id is divisible by 50."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, F.col("vec_id") % 50 == 0, label=label)


SQL12 = r"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q, row_number() OVER () AS key
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM r WHERE vec_id % 50 = 0),
s AS (
  SELECT a.key AS anchor, a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, r.key, list_inner_product(a.q, r.q)::BIGINT AS score
  FROM a JOIN r ON a.key <> r.key),
p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, key) AS k FROM s WHERE same),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.key ORDER BY s.score DESC, s.vec_id, s.key)::INTEGER AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
  WHERE p.k <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
