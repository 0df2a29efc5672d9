"""Exact deduplication by stateful streaming.

Arrivals are a log of (digest, stable identifier, content locator). A streaming aggregation keeps
one keyed row per digest in RocksDB, without expiry: how often the digest came and the identifier
and locator of the row that stays. Each trigger writes the keys that changed to a table in the
shared folder. Where a digest was hit more than once, the full texts are compared; texts that
share a digest and differ are told apart. Everything here is DataFrame code.

Defined results: a null text counts as empty; rows whose doc_id is null take part, and stay only
if their group has no other; of rows with equal doc_id and text, the one that lies last in the
storage stays; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flagged, located, place, remove, settings, text_or_empty, without, work_path, written

#: Of an arrival's row, in the order that decides which row stays.
KEEP = "struct<doc_id:bigint,file:string,row:bigint>"
ROWS_PER_STATE = 1_000_000  # keys of a partition of the state, about
LEAST_PER_STATE = 20_000  # smaller tables take fewer partitions than there are cores
ROCKS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    # commits write what changed; small stores reserve no disk ahead, and closed ones go soon
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}


def sha256_text(text: Column) -> Column:
    """Lowercase hex of the SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


def sha256_bytes(text: Column) -> Column:
    """The 32 bytes of the SHA-256 of a text's UTF-8 bytes."""
    return F.unhex(sha256_text(text))


def _own(docs: DataFrame) -> Column:
    file, row = place(docs)
    return F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), file.alias("file"), row.alias("row"))


def arrivals(docs: DataFrame, digest=sha256_bytes) -> DataFrame:
    """(digest, keep) of each row of a table read from files, batch or stream."""
    return docs.select(digest(text_or_empty()).alias("digest"), _own(docs).alias("keep"))


def keyed_state(log: DataFrame, to: str, checkpoint: str, rows: int, seen: set[int] | None = None):
    """Start the stateful query over a stream of arrivals; it ends when what is there has been read.

    ``to`` gets one folder for each batch with the keys that changed in it. A batch that is run
    again after a failure overwrites its folder, so that each takes effect once. ``rows``: how many
    arrivals to expect, which fixes the state's partitions when it is made."""

    def put(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{to}/batch={batch}")
        if seen is not None:
            seen.add(batch)

    spark = log.sparkSession
    parts = max(min(spark.sparkContext.defaultParallelism, -(-rows // LEAST_PER_STATE)), -(-rows // ROWS_PER_STATE), 1)
    with settings(spark, ROCKS | {"spark.sql.shuffle.partitions": str(parts)}):
        return (
            log.groupBy("digest")
            .agg(F.count(F.lit(1)).alias("n"), F.max("keep").alias("keep"))
            .writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(put)
            .trigger(availableNow=True)
            .start()
        )


def dedup_state(log: DataFrame, bytes_per_batch: int = 16 << 30) -> tuple[DataFrame, DataFrame]:
    """The log as written, and (digest, n, keep) for each of its digests, by the stateful stream.

    When the stream has ended, its checkpoint goes."""
    spark, home = log.sparkSession, work_path(log.sparkSession, "dedup")
    log.write.parquet(f"{home}/log")
    arrived = spark.read.schema(log.schema).parquet(f"{home}/log")
    kind = log.schema["digest"].dataType.simpleString()
    schema = f"digest {kind}, n bigint, keep {KEEP}"
    spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{home}/state/batch=-1")
    stream = spark.readStream.schema(log.schema).option("maxBytesPerTrigger", str(bytes_per_batch)).parquet(f"{home}/log")
    batches: set[int] = set()
    query = keyed_state(stream, f"{home}/state", f"{home}/checkpoint", arrived.count(), batches)
    query.awaitTermination()
    if error := query.exception():
        raise error
    remove(spark, f"{home}/checkpoint")
    state = spark.read.schema(f"{schema}, batch bigint").parquet(f"{home}/state")
    if len(batches) > 1:  # counts only grow: of a key's rows the last batch has the largest
        last = F.max(F.struct("batch", "n", "keep")).alias("x")
        state = written(state.groupBy("digest").agg(last).select("digest", "x.n", "x.keep"), "dedup-state")
        remove(spark, f"{home}/state")
    return arrived, state.select("digest", "n", "keep")


def differing(docs: DataFrame, state: DataFrame, digest=sha256_bytes) -> DataFrame:
    """Digests that stand for more than one text: full bytes of the rows of the digests that were hit.

    A bitmap of those digests tells where rows are read which may be among them (others that it lets
    through do no harm); equal texts collapse within each task before they are dealt out by text."""
    hit = state.where("n > 1").select(F.xxhash64("digest"))
    rows = flagged(docs.select(text_or_empty().alias("text")), F.xxhash64(digest(F.col("text"))), hit, "hit")
    texts = rows.where("hit").select("text").distinct().select(digest(F.col("text")).alias("digest"))
    return texts.groupBy("digest").count().where("count > 1").select("digest")


def exact_dedup(docs: DataFrame, digest=sha256_bytes, bytes_per_batch: int = 16 << 30) -> DataFrame:
    """A row for each row of docs: keep (identifier and locator), keep_id, group_size, kept, digest.

    ``digest`` is a function of the text's column; another one serves to test what happens when
    different texts share a digest."""
    docs = located(docs)
    log, state = dedup_state(arrivals(docs, digest), bytes_per_batch)
    marked = log.withColumnRenamed("keep", "own").join(state, "digest")
    clash = written(differing(docs, state, digest), "dedup-clash")
    if not clash.isEmpty():
        rows = _clashing(docs, clash, digest)
        marked = marked.join(clash, "digest", "left_anti").unionByName(rows)
    return marked.select("digest", "own", "keep", F.col("own.doc_id").alias("doc_id"), F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"), F.col("own").eqNullSafe(F.col("keep")).alias("kept"))


def _clashing(docs: DataFrame, clash: DataFrame, digest) -> DataFrame:
    """Of digests that stand for several texts, the rows grouped by their full text."""
    rows = docs.select(digest(text_or_empty()).alias("digest"), text_or_empty().alias("text"), _own(docs).alias("own")).join(clash, "digest")
    groups = rows.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("keep"))
    return rows.join(groups, ["digest", "text"]).select("digest", "own", "n", "keep")


def kept_documents(docs: DataFrame, digest=sha256_bytes) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    docs = located(docs)
    return without(docs, written(exact_dedup(docs, digest).where("not kept").select("own.file", "own.row"), "dropped"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: which row of equal texts stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


#: DuckDB's own words for the same rows.
SQL6 = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
