"""What the operators share: the cluster's shared folder, written tables, Arrow text access."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import threading
import uuid

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILTER_BYTES = 64 << 20  # of a bitmap that is broadcast, at most
_made: list[tuple[object, str]] = []
_thread = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder stands in, but only if Spark runs on this machine alone."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tallyforge-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; it goes when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_clean)
    _made.append((spark, path))
    if (paths := getattr(_thread, "paths", None)) is not None:
        paths.append(path)
    return path


@contextlib.contextmanager
def gathering(paths: list[str]):
    """Within the block, new work paths of this thread are added to ``paths``."""
    before, _thread.paths = getattr(_thread, "paths", None), paths
    try:
        yield
    finally:
        _thread.paths = before
        if before is not None:
            before += paths


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path through Hadoop's file system, wherever it lies."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
    _made[:] = [x for x in _made if x[1] != path]


def _clean() -> None:
    for spark, path in list(_made):
        try:
            remove(spark, path)
        except Exception:  # the session has gone: its folder is the cluster's to clear
            return


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, outlives executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings that hold within a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that df doesn't have."""
    there, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in there:
            name += "_"
        there.add(name.lower())
        out.append(name)
    return out


def place(docs: DataFrame) -> tuple[Column, Column]:
    """File and row number of each row of a table that ``located`` returned, whatever its own columns are called."""
    meta = docs.metadataColumn("_metadata")
    return meta["file_path"], meta["row_index"]


def located(docs: DataFrame) -> DataFrame:
    """The same rows read from files, so that file and row number locate each; lands them if need be."""
    try:
        docs.select(*place(docs)).schema  # noqa: B018  resolves the columns
    except AnalysisException:  # not read from files
        return written(docs, "landed")
    return docs


def flagged(rows: DataFrame, key: Column, keys: DataFrame, flag: str) -> DataFrame:
    """rows with a boolean ``flag``: false only where no row of keys, hashes in its one column, equals ``key``.

    The keys are a bitmap of about 16 bits each, ``FILTER_BYTES`` at most, which is broadcast: rows are
    told apart where they are read. A bitmap that is too small flags more rows, never fewer."""
    bits = 1 << max(15, min((8 * FILTER_BYTES).bit_length() - 1, (16 * keys.count()).bit_length()))
    of = lambda c: F.pmod(c, F.lit(bits)) + 1
    at, bucket, bitmap = fresh(rows, "at", "bucket", "bitmap")
    h = of(F.col(f"`{keys.columns[0]}`"))
    maps = keys.groupBy(F.bitmap_bucket_number(h).alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(h)).alias(bitmap))
    spot = F.bitmap_bit_position(F.col(at))
    octet = F.conv(F.hex(F.substring(F.col(bitmap), (F.shiftright(spot, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = octet.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (F.pmod(spot, F.lit(8)) + 1).cast("int"))) != 0
    met = rows.withColumn(at, of(key)).withColumn(bucket, F.bitmap_bucket_number(F.col(at))).join(F.broadcast(maps), bucket, "left")
    return met.withColumn(flag, F.coalesce(bit, F.lit(False))).drop(at, bucket, bitmap)


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of a located table but those at ``dropped`` (file, row), a written table.

    Only rows whose place may be among them are dealt out; the others stay where they are read."""
    file, row, flag = fresh(docs, "file", "row", "flag")
    at_file, at_row = place(docs)
    rows = docs.withColumns({file: at_file, row: at_row})
    rows = flagged(rows, F.xxhash64(file, row), dropped.select(F.xxhash64("file", "row")), flag)
    gone = dropped.select(F.col("file").alias(file), F.col("row").alias(row))
    stay = rows.where(~F.col(flag)).unionByName(rows.where(F.col(flag)).join(gone, [file, row], "left_anti"))
    return stay.select(*[F.col(f"`{c}`") for c in docs.columns])


def arrow_bounds(spark: SparkSession) -> None:
    """Hold Arrow batches to sizes that a Python worker takes whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def utf8_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1) of an Arrow string column, nulls as empty; no copy of the bytes."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column, "").cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at


def release() -> None:
    """Hand memory that large arrays have left behind back to the system, where the C library can."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more; it does so when the JVM collects garbage."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
