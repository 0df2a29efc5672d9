"""Near-duplicate detection with DartMinHash signatures.

Elements are five-word shingles. ``signatures`` weighs them 1 + floor(log2(occurrences)); the bands are
made of distinct shingles, each of weight 1, as what is verified is the likeness of sets, and so that
texts with the same set have the same bands. For every element, darts
fall on the plane of weight and rank: its region is split into dyadic strips of weight, and in a
strip the darts' ranks are a Poisson process with the strip's width as its rate, made from the
element's hash alone. A text of total weight W sees the darts with rank below t / W that lie under
its elements' weights: t on average, whatever W. Each dart has a coordinate; the earliest dart of
each coordinate is the signature. A text that lacks a coordinate looks twice as far.

Texts with the same set of shingles are one node. Nodes that share a band of coordinates are linked
to the least node of the bucket, if the Jaccard likeness of their shingle sets is at least 0.8.
Buckets whose nodes are not yet of one component are split by pairs of bands and linked anew; in what
is left of several components every pair of nodes of different components is verified, in blocks of
nodes, so that each pair that shares a band is of one class or known to be below the likeness.

Defined results: a null text counts as empty; texts without a word are one class; rows with equal
doc_id are rows of their own; a null doc_id names a class only if no other row is in it; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shingles
from .common import arrow_bounds, flagged, located, place, release, text_or_empty, tidy, utf8_buffers, without, written
from .components import components

LIKE = 0.8
BANDS, ROWS = 20, 4
COORDINATES = BANDS * ROWS
DARTS = COORDINATES * (np.log(COORDINATES) + 3)
BLOCK_NODES, BLOCK_BYTES = 1024, 1 << 22  # of a block of a bucket, at most but for one node
COLUMNS = 4096  # shingles that are counted at a time
_GOLD = np.uint64(0x9E3779B97F4A7C15)
OWN = "struct<no_id:boolean,doc_id:bigint,file:string,row:bigint>"


def _throw(h: np.ndarray, weight: np.ndarray, doc: np.ndarray, far: np.ndarray, best: np.ndarray) -> None:
    """Throw the darts of all elements up to the rank ``far`` of their text; ``best`` keeps the earliest."""
    low, width, strip = 0.0, 1.0, 0
    while (sel := np.flatnonzero(weight > low)).size:
        key, at, w, limit = shingles.mix(h[sel] + np.uint64(strip + 1) * _GOLD), doc[sel], weight[sel], far[doc[sel]]
        rank, turn = np.zeros(len(sel)), 0
        while len(key):
            turn += 1
            x = shingles.mix(key + np.uint64(turn) * _GOLD)
            rank = rank - np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
            live = rank < limit
            key, at, w, limit, rank, x = key[live], at[live], w[live], limit[live], rank[live], x[live]
            if not len(key):
                break
            y = shingles.mix(x ^ _GOLD)
            place = low + width * ((y >> np.uint64(32)).astype(np.float64) * 2.0**-32)
            under = place < w
            spot = at[under] * COORDINATES + ((y & np.uint64(0xFFFFFFFF)) % np.uint64(COORDINATES)).astype(np.int64)[under]
            np.minimum.at(best, spot, rank[under])
        low, width, strip = low + width, max(1.0, low + width), strip + 1


def signatures(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """n rows of COORDINATES ranks from hashes and texts of shingles; infinite where a text has none."""
    best = np.full(n * COORDINATES, np.inf)
    if not len(h):
        return best.reshape(n, -1)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))
    start = np.flatnonzero(new)
    count = np.diff(np.concatenate((start, [len(h)])))
    h, doc, weight = h[start], doc[start], 1.0 + np.floor(np.log2(count))
    total = np.bincount(doc, weight, n)
    far = DARTS / np.maximum(total, 1)
    with np.errstate(over="ignore"):
        _throw(h, weight, doc, far, best)
        while True:
            lack = np.isinf(best.reshape(n, -1)).any(1) & (total > 0)
            if not lack.any():
                return best.reshape(n, -1)
            far = np.where(lack, far * 2, far)
            some = lack[doc]
            _throw(h[some], weight[some], doc[some], far, best)


def node_and_bands(data: np.ndarray, at: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Of each text the identity of its set of shingles, and a hash for each band."""
    nodes: list[bytes] = []
    bands = np.zeros((len(at) - 1, BANDS), np.int64)
    for first, last in shingles.chunks(at):
        h, doc = shingles.shingle_hashes(data, at[first : last + 1])
        n = last - first
        order = np.lexsort((h, doc))
        hs, ds = h[order], doc[order]
        new = np.concatenate(([True], (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1]))) if len(hs) else np.zeros(0, bool)
        one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            np.add.at(one, ds[new], shingles.mix(hs[new] + np.uint64(1)))
            np.add.at(two, ds[new], shingles.mix(hs[new] ^ _GOLD))
            nodes += [x.tobytes() for x in np.stack((one, two), 1)]
            sig = np.ascontiguousarray(signatures(hs[new], ds[new], n)).view(np.uint64).reshape(n, BANDS, ROWS)
            key = np.zeros((n, BANDS), np.uint64)
            for r in range(ROWS):
                key = shingles.mix(key * np.uint64(31) + sig[:, :, r])
            bands[first:last] = key.view(np.int64)
    return nodes, bands


def signed(docs: DataFrame) -> DataFrame:
    """(own, node, bands, text) for each row; written. own: what tells rows apart and orders them."""
    docs = located(docs)
    arrow_bounds(docs.sparkSession)
    file, row = place(docs)
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("bigint").alias("doc_id"), file.alias("file"), row.alias("row"))

    def sign(batches):
        import pyarrow as pa

        for batch in batches:
            nodes, bands = node_and_bands(*utf8_buffers(batch.column(1)))
            offsets = pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(bands.ravel())), batch.column(1)], ["own", "node", "bands", "text"])
        release()

    return written(docs.select(own.alias("own"), text_or_empty().alias("text")).mapInArrow(sign, f"own {OWN}, node binary, bands array<bigint>, text string"), "signed")


def shared_buckets(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of buckets with several nodes, with the bucket's least node ``b``; written."""
    least = written(buckets.groupBy(*keys).agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "least")
    return written(buckets.join(least, keys), "shared")


def needed_texts(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """(node, text) of the needed nodes, written. A bitmap of a bounded size keeps most other texts from
    being dealt out; what it lets through by chance falls in the join. Copies collapse before they are dealt out."""
    some = flagged(rows.select("node", "text"), F.xxhash64("node"), needed.select(F.xxhash64("node")), "hit").where("hit")
    return written(some.groupBy("node").agg(F.any_value("text").alias("text")).join(needed, "node", "left_semi"), "texts")


def verified(pairs: DataFrame, texts: DataFrame, like: float = LIKE) -> DataFrame:
    """The pairs whose texts have Jaccard likeness ``like`` at least, by their full sets of shingles."""

    def compare(batches):
        import pyarrow as pa

        last: tuple[bytes, np.ndarray] = (b"", np.zeros(0, np.uint64))
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                if last[0] != b[k]:
                    last = (b[k], shingles.shingle_set(y.as_buffer().to_pybytes()))
                keep.append(shingles.jaccard(shingles.shingle_set(x.as_buffer().to_pybytes()), last[1]) >= like)
            at = [k for k, x in enumerate(keep) if x]
            yield pa.RecordBatch.from_arrays([pa.array([a[k] for k in at], pa.binary()), pa.array([b[k] for k in at], pa.binary())], ["a", "b"])

    arrow_bounds(pairs.sparkSession)
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a binary, b binary")


def _linked(shared: DataFrame, rows: DataFrame, tested: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes and their buckets' least nodes that were not tested before, and which of them are links."""
    pairs = shared.where("node != b").select(F.col("node").alias("a"), "b").distinct()
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    pairs = written(pairs, "pairs")
    needed = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "needed")
    tidy(pairs.sparkSession)
    return pairs, written(verified(pairs, needed_texts(rows, needed)), "links")


def _rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) of all nodes, written; one without links is its own root."""
    return written(nodes.select("node").join(components(links), "node", "left").select("node", F.coalesce("root", "node").alias("root")), "member")


def _split(shared: DataFrame, member: DataFrame) -> DataFrame:
    """(band, h, node, root) of the buckets whose nodes are of several components; written."""
    placed = written(shared.select("band", "h", "node").join(member, "node"), "placed")
    split = placed.groupBy("band", "h").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y").select("band", "h")
    return written(placed.join(written(split, "split"), ["band", "h"]), "open")


def _rest(apart: DataFrame, nodes: DataFrame, rows: DataFrame, like: float = LIKE) -> DataFrame:
    """Links (a, b) among all pairs of nodes of different components in the buckets of ``apart``; written.

    A bucket's nodes are dealt into blocks by component, and two blocks meet unless both are of the same
    one. A pair is verified in the first band that it shares, and only there."""
    texts = needed_texts(rows, written(apart.select("node").distinct(), "needed"))
    weight = F.greatest(F.octet_length("text").cast("bigint"), F.lit(BLOCK_BYTES // BLOCK_NODES))
    weights = texts.select("node", weight.alias("weight"))
    line = Window.partitionBy("band", "h").orderBy("root", "node")
    blocks = written(apart.join(weights, "node").withColumn("block", F.floor((F.sum("weight").over(line) - 1) / F.lit(BLOCK_BYTES))), "blocks")
    ends = blocks.groupBy("band", "h", "block").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    meet = ends.select("band", "h", F.col("block").alias("i"), "x").join(ends.select("band", "h", F.col("block").alias("j"), "y"), ["band", "h"]).where("i <= j and x != y").select("band", "h", "i", "j")
    sides = meet.select("*", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    dealt = sides.join(blocks.select("band", "h", "block", "node", "root"), ["band", "h", "block"])
    dealt = dealt.join(nodes.select("node", "bands"), "node").join(texts, "node").select("band", "h", "i", "j", "block", "node", "root", "bands", "text")

    def compare(table):
        import pyarrow as pa

        node, root = table["node"].to_pylist(), np.unique(np.array([x.hex() for x in table["root"].to_pylist()]), return_inverse=True)[1]
        bands = np.array(table["bands"].to_pylist(), np.int64).reshape(len(node), BANDS)
        band, i, j = (table[c][0].as_py() for c in ("band", "i", "j"))
        block = table["block"].to_numpy()
        sets = [shingles.shingle_set((x or "").encode()) for x in table["text"].to_pylist()]
        size = np.array([len(x) for x in sets])
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        could = (root[left][:, None] != root[right][None, :]) & (np.minimum(size[left][:, None], size[right][None, :]) >= like * np.maximum(size[left][:, None], size[right][None, :]))
        for b in range(band):  # an earlier band that both have: verified there
            could &= bands[left, b][:, None] != bands[right, b][None, :]
        if i == j:
            could &= left[:, None] < right[None, :]
        both = shingles.shared([sets[k] for k in left], [sets[k] for k in right], COLUMNS)
        a, b = np.nonzero(could & (both >= like * (size[left][:, None] + size[right][None, :] - both)))
        return pa.table({"a": pa.array([node[left[k]] for k in a], pa.binary()), "b": pa.array([node[right[k]] for k in b], pa.binary())})

    return written(dealt.groupBy("band", "h", "i", "j").applyInArrow(compare, "a binary, b binary").distinct(), "links")


def near_classes(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: own, doc_id, class_id (its class's least doc_id), class_size, kept."""
    rows = signed(docs)
    nodes = written(rows.groupBy("node").agg(F.min("own").alias("least"), F.count(F.lit(1)).alias("n"), F.any_value("bands").alias("bands")), "nodes")
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "h"))
    shared = shared_buckets(buckets, ["band", "h"])
    pairs, links = _linked(shared, rows, None)
    member = _rooted(nodes, links)
    apart = _split(shared, member)
    # a node is in BANDS buckets at most
    own = apart.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("band", "h"))).alias("s")).where(F.size("s") > 1)
    two = own.select("node", F.explode(F.flatten(F.transform("s", lambda x, i: F.transform(F.slice("s", i + 2, F.size("s")), lambda y: F.struct(x["band"].alias("i"), y["band"].alias("j"), F.xxhash64(x["h"], y["h"]).alias("h")))))).alias("p"))
    two = written(two.select("node", "p.*"), "two")
    if not two.isEmpty():
        _, more = _linked(shared_buckets(two, ["i", "j", "h"]), rows, pairs)
        if not more.isEmpty():
            links = links.union(more)
            member = _rooted(nodes, links)
            apart = _split(apart, member.select("node", "root"))
    if not apart.isEmpty():
        last = _rest(apart, nodes, rows)
        if not last.isEmpty():
            member = _rooted(nodes, links.union(last))
    of = nodes.select("node", "least", "n").join(member, "node")
    classes = of.groupBy("root").agg(F.min("least").alias("keep"), F.sum("n").alias("class_size"))
    of = written(of.select("node", "root").join(classes, "root").select("node", "keep", "class_size"), "classes")
    found = rows.select("own", "node").join(of, "node")
    return found.select("own", F.col("own.doc_id").alias("doc_id"), F.col("keep.doc_id").alias("class_id"), "class_size", F.col("own").eqNullSafe(F.col("keep")).alias("kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """One row of each class, with all columns of docs."""
    docs = located(docs)
    return without(docs, written(near_classes(docs).where("not kept").select("own.file", "own.row"), "dropped"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: the class of each."""
    return near_classes(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "class_size", "kept")
