"""Sharded storage with size-tiered compaction and versioned manifests.

Arrivals are appended as runs of small immutable Parquet files. A run's tier is the power of
``fan_in`` that its bytes reach; where a tier has ``fan_in`` runs, they are merged into one run with
files of the target size, each file written by one task that reads its share of the inputs, without
a shuffle. Runs whose files have the target size are sealed: they are left alone, and a manifest names
them by immutable lists of ``SEGMENT`` runs, so that it stays short however many there are. Every change
is a new manifest: a JSON file, written beside and renamed into place, which fails if another writer
has made that version; the change is then made anew on that version, unless it takes runs that have gone.
(Where a store's rename isn't atomic, one writer at a time must be seen to.) Readers use the latest
manifest and one scan over its paths; files of no kept version, and leftovers of failed writers that are
older than a grace period, go with ``vacuum``, so keep as many versions as readers may still read.

Defined results: rows pass through unchanged, repeated ones, nulls and empty texts included; an empty
arrival commits a version with no run; a failed merge leaves the last manifest as it was; the column that
names a row's run has another name where the rows have one of that name.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, place, remove, text_or_empty, work_path
from .exact_dedup import sha256_text

SMALL = 1 << 20
TARGET = 64 << 20
FAN_IN = 4
ARRIVALS = 16
SEGMENT = 1_000  # sealed runs that a list holds
TRIES = 20  # of a commit that other writers overtake
GRACE = 24 * 3600  # seconds after which files that no manifest names are taken for leftovers


@dataclass
class Run:
    """Immutable files that were written together."""

    id: str
    path: str
    bytes: int
    files: int

    def tier(self, small: int, fan_in: int) -> int:
        return max(0, math.floor(math.log(max(1, self.bytes / small), fan_in)))


@dataclass
class Manifest:
    """A version of the store: its runs, and the schema they share."""

    version: int = 0
    schema: str = ""
    runs: list[Run] = field(default_factory=list)  # but those of the segments
    segments: list[str] = field(default_factory=list)  # lists of sealed runs


class CommitConflict(RuntimeError):
    """Another writer has committed the version."""


class ShardStore:
    """A store below a path that all executors reach, by any file system Hadoop knows."""

    def __init__(self, spark: SparkSession, path: str, small: int = SMALL, target: int = TARGET, fan_in: int = FAN_IN):
        self.spark, self.path, self.small, self.target, self.fan_in = spark, path.rstrip("/"), small, target, fan_in
        self._jpath = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._jpath(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _list(self, path: str) -> list[tuple[str, int]]:
        p = self._jpath(path)
        return [(x.getPath().getName(), x.getLen()) for x in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n, _ in self._list(f"{self.path}/manifests") if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        """A version's manifest; the latest by default."""
        version = version if version is not None else max(self.versions(), default=0)
        if not version:
            return Manifest()
        x = self._load(f"{self.path}/manifests/v{version:08d}.json")
        return Manifest(x["version"], x["schema"], [Run(**r) for r in x["runs"]], x["segments"])

    def _load(self, path: str):
        stream = self._fs.open(self._jpath(path))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _save(self, path: str, x) -> None:
        out = self._fs.create(self._jpath(path), False)
        out.write(bytearray(json.dumps(x).encode()))
        out.close()

    def runs(self, of: Manifest) -> list[Run]:
        """All runs of a version, sealed ones first."""
        return [Run(**r) for s in of.segments for r in self._load(f"{self.path}/segments/{s}")] + of.runs

    def commit(self, new: Manifest) -> Manifest:
        """Make a manifest the next version, all or nothing."""
        home = f"{self.path}/manifests"
        self._fs.mkdirs(self._jpath(home))
        to, tmp = self._jpath(f"{home}/v{new.version:08d}.json"), self._jpath(f"{home}/.{uuid.uuid4().hex}")
        sealed = [r for r in new.runs if self._full(r)]
        while len(sealed) >= SEGMENT:  # what isn't committed after all is a leftover
            part, sealed = sealed[:SEGMENT], sealed[SEGMENT:]
            name = f"s{new.version:08d}-{uuid.uuid4().hex}.json"
            self._fs.mkdirs(self._jpath(f"{self.path}/segments"))
            self._save(f"{self.path}/segments/{name}", [asdict(r) for r in part])
            ids = {r.id for r in part}
            new = Manifest(new.version, new.schema, [r for r in new.runs if r.id not in ids], [*new.segments, name])
        self._save(tmp.toString(), asdict(new))
        jvm = self.spark._jvm
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), self.spark._jsc.hadoopConfiguration()).rename(tmp, to, none)
        except Exception as error:
            self._fs.delete(tmp, False)
            if self._fs.exists(to):
                raise CommitConflict(f"version {new.version} is there") from error
            raise
        return new

    def change(self, gone: list[Run], new: list[Run], schema: str) -> Manifest:
        """Commit a version without some runs and with others, on top of whatever version is the latest by then."""
        for _ in range(TRIES):
            now, ids = self.manifest(), {r.id for r in gone}
            if not ids <= {r.id for r in now.runs}:
                raise CommitConflict("runs that were merged have gone")
            try:
                return self.commit(Manifest(now.version + 1, schema or now.schema, [r for r in now.runs if r.id not in ids] + new, now.segments))
            except CommitConflict:
                continue
        raise CommitConflict(f"overtaken {TRIES} times")

    def _new(self, kind: str) -> str:
        """A folder for new files. Its name without the last part is what a run is called."""
        return f"{self.path}/data/{kind}-v{max(self.versions(), default=0) + 1:08d}-{uuid.uuid4().hex}"

    def _run(self, path: str) -> Run | None:
        files = [(n, size) for n, size in self._list(path) if n.endswith(".parquet")]
        return Run(path[len(self.path) + 6 :], path, sum(s for _, s in files), len(files)) if files else None

    def append(self, df: DataFrame) -> Manifest:
        """One arrival as a run; commits a version."""
        (name,) = fresh(df, "arrival")
        return self.append_all(df.withColumn(name, F.lit(0)), name)[-1]

    def append_all(self, df: DataFrame, by: str) -> list[Manifest]:
        """Arrivals told apart by a column (which isn't stored), written by one job, a version for each in its order."""
        landed = self._new("in")
        schema = df.drop(by).schema.json()
        df.write.partitionBy(by).parquet(landed)
        names = sorted((n for n, _ in self._list(landed) if "=" in n), key=lambda n: (not n.split("=")[1].isdigit(), n.split("=")[1].zfill(20)))
        runs = [run for name in names if (run := self._run(f"{landed}/{name}"))]
        return [self.change([], [run], schema) for run in runs] or [self.change([], [], schema)]

    def _full(self, run: Run) -> bool:
        return run.bytes / run.files >= self.target / 2

    def _groups(self, now: Manifest) -> list[list[Run]]:
        tiers: dict[int, list[Run]] = {}
        for run in now.runs:
            if not self._full(run):
                tiers.setdefault(run.tier(self.small, self.fan_in), []).append(run)
        return [runs[k : k + self.fan_in] for runs in tiers.values() for k in range(0, len(runs) - self.fan_in + 1, self.fan_in)]

    def _merge(self, runs: list[Run], schema, k: int) -> Run:
        to = self._new(f"m{k}")
        n = max(1, round(sum(r.bytes for r in runs) / self.target))
        self.spark.read.schema(schema).parquet(*[r.path for r in runs]).coalesce(n).write.parquet(to)
        return self._run(to)

    def compact(self) -> Manifest:
        """Merge until no tier has enough runs; a version for each round of merges."""
        from pyspark.sql.types import StructType

        now = self.manifest()
        while groups := self._groups(now):
            schema = StructType.fromJson(json.loads(now.schema))
            with ThreadPoolExecutor(4) as pool:
                merged = list(pool.map(lambda x: self._merge(x[1], schema, x[0]), enumerate(groups)))
            try:
                now = self.change([r for g in groups for r in g], merged, "")
            except CommitConflict:  # another writer has merged some of them
                for run in merged:
                    remove(self.spark, run.path)
                now = self.manifest()
        return now

    def vacuum(self, keep: int = 1, grace: float = GRACE) -> int:
        """Delete what only versions older than the last ``keep`` hold, and leftovers; returns the number of runs that went."""
        versions = self.versions()
        kept, old = [self.manifest(v) for v in versions[-keep:]], [self.manifest(v) for v in versions[:-keep]]
        live = {r.path for m in kept for r in self.runs(m)}
        dead = {r.path for m in old for r in self.runs(m)} - live
        for path in dead:
            remove(self.spark, path)
        for m in old:
            remove(self.spark, f"{self.path}/manifests/v{m.version:08d}.json")
        for name in {s for m in old for s in m.segments} - {s for m in kept for s in m.segments}:
            remove(self.spark, f"{self.path}/segments/{name}")
        named = {p[len(self.path) + 6 :].split("/")[0] for p in live}
        for home, there in (("data", named), ("segments", {s for m in kept for s in m.segments})):
            folder = self._jpath(f"{self.path}/{home}")
            for x in self._fs.listStatus(folder) if self._fs.exists(folder) else []:
                if x.getPath().getName() not in there and x.getModificationTime() / 1000 < time.time() - grace:
                    self._fs.delete(x.getPath(), True)
        return len(dead)

    def read(self, version: int | None = None, name: str = "shard_run") -> DataFrame:
        """The rows of a version by one scan, with ``shard_run`` (or a name that the rows don't have), the run that each lies in."""
        from pyspark.sql.types import StructType

        now = self.manifest(version)
        schema = StructType.fromJson(json.loads(now.schema)) if now.schema else StructType()
        runs = self.runs(now)
        if not runs:
            out = self.spark.createDataFrame([], schema)
            return out.withColumn(fresh(out, name)[0], F.lit(None).cast("string"))
        out = self.spark.read.schema(schema).parquet(*[r.path for r in runs])
        parts = [F.regexp_extract(place(out)[0], r"/data/(\w+-v\d+)-[0-9a-f]+(/[^/]+)?/[^/]+$", k) for k in (1, 2)]
        return out.withColumn(fresh(out, name)[0], F.concat(*parts))


def compacted(docs: DataFrame, path: str | None = None, arrivals: int = ARRIVALS) -> tuple[ShardStore, Manifest]:
    """Append docs as arrivals, by ranges of doc_id as they would come, and compact the store."""
    spark = docs.sparkSession
    store = ShardStore(spark, path or work_path(spark, "shards"))
    cuts = docs.agg(F.percentile_approx(F.col("doc_id").cast("bigint"), [k / arrivals for k in range(1, arrivals)], 10_000).alias("x")).first()["x"] or []
    nr = F.lit(0)
    for cut in sorted(set(cuts)):
        nr = nr + F.when(F.col("doc_id") >= cut, 1).otherwise(0)
    (name,) = fresh(docs, "arrival")
    store.append_all(docs.withColumn(name, nr), name)
    now = store.compact()
    store.vacuum()
    return store, now


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, read back from the compacted store: where each row lies, and its text's digest."""
    store, now = compacted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return store.read().select("doc_id", "source", "n_chars", F.lit(now.version).alias("version"), "shard_run", sha256_text(text_or_empty()).alias("text_sha256"))
