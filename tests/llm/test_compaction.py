import pytest

from tallyforge.llm import compaction as cp


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_content_survives_and_runs_merge(spark, odd, tmp_path):
    store, now = cp.compacted(odd, f"file://{tmp_path}/s", arrivals=8)
    assert rows_of(store.read().drop("shard_run")) == rows_of(odd)
    assert len(now.runs) < 8 and now.version > 8
    assert store.versions() == [now.version]


def test_versions_are_snapshots(spark, odd, tmp_path):
    store = cp.ShardStore(spark, f"file://{tmp_path}/s", small=100, fan_in=2)
    one = store.append(odd.limit(10))
    two = store.append(odd.limit(20))
    after = store.compact()
    assert (one.version, two.version) == (1, 2) and after.version == 3 and len(after.runs) == 1
    assert store.read(1).count() == 10 and store.read(2).count() == 30 and store.read().count() == 30
    assert store.vacuum() == 2
    assert store.versions() == [3] and store.read().count() == 30


def test_full_files_are_left_alone(spark, odd, tmp_path):
    store = cp.ShardStore(spark, f"file://{tmp_path}/s", small=10, target=100, fan_in=2)
    for _ in range(4):
        store.append(odd)
    assert store.compact().version == 4


def test_a_version_is_committed_once(spark, odd, tmp_path):
    store = cp.ShardStore(spark, f"file://{tmp_path}/s")
    now = store.append(odd)
    with pytest.raises(cp.CommitConflict):
        store.commit(cp.Manifest(now.version, now.schema, []))
    assert store.manifest().runs == now.runs


def test_empty(spark, empty, tmp_path):
    store, now = cp.compacted(empty, f"file://{tmp_path}/s")
    assert now.runs == [] and store.read().count() == 0 and set(empty.columns) <= set(store.read().columns)


def model(sizes, small, target, fan_in):
    """Which runs merge into which, by the rule alone: runs as sets of arrivals with their bytes in single files."""
    rounds, runs = 0, [({k}, b) for k, b in enumerate(sizes)]
    while True:
        tiers = {}
        for r in runs:
            if r[1] < target / 2:
                tier = 0
                while r[1] >= small * fan_in ** (tier + 1):
                    tier += 1
                tiers.setdefault(tier, []).append(r)
        groups = [x[k : k + fan_in] for x in tiers.values() for k in range(0, len(x) - fan_in + 1, fan_in)]
        if not groups:
            return rounds, runs
        merged = [(set().union(*(m for m, _ in g)), sum(b for _, b in g)) for g in groups]
        runs = [r for r in runs if not any(r in g for g in groups)] + merged
        rounds += 1


def test_tiers_are_those_of_a_model(spark, tmp_path):
    store = cp.ShardStore(spark, f"file://{tmp_path}/s", small=1000, target=1 << 30, fan_in=3)
    df = spark.range(40_000).selectExpr("id", "cast(case when id < 20000 then id % 7 else 7 + id % 4 end as int) as nr", "uuid() as x")
    store.append_all(df, "nr")
    sizes = [r.bytes for r in store.manifest().runs]
    now = store.compact()
    rounds, want = model(sizes, 1000, 1 << 30, 3)
    got = store.read().join(df.select("id", "nr"), "id").groupBy("shard_run").agg({"nr": "collect_set"}).collect()
    got = {frozenset(r[1]) for r in got}
    assert got == {frozenset(m) for m, _ in want} and now.version == len(sizes) + rounds


def test_names_that_clash(spark, odd, tmp_path):
    docs = odd.selectExpr("*", "'own' as arrival", "'mine' as shard_run", "7 as _metadata")
    store, _ = cp.compacted(docs, f"file://{tmp_path}/s", arrivals=3)
    out = store.read()
    assert out.columns == [*docs.columns, "shard_run_"] and rows_of(out.select(docs.columns)) == rows_of(docs)


def test_sealed_runs_move_to_segments(spark, odd, tmp_path, monkeypatch):
    monkeypatch.setattr(cp, "SEGMENT", 2)
    store = cp.ShardStore(spark, f"file://{tmp_path}/s", small=10, target=100, fan_in=2)
    for _ in range(5):
        now = store.append(odd.coalesce(1))
    now = store.manifest()
    assert len(now.segments) == 2 and len(now.runs) == 1 and len(store.runs(now)) == 5
    assert store.read().count() == 5 * odd.count()
    store.vacuum()
    assert store.read().count() == 5 * odd.count()


def test_overtaken_writers_and_leftovers(spark, odd, tmp_path):
    store, other = (cp.ShardStore(spark, f"file://{tmp_path}/s", small=100, fan_in=2) for _ in range(2))
    store.append(odd.limit(10))
    before = store.manifest
    turns = []

    def late(version=None):
        now = before(version)
        if not turns:  # another writer commits between this one's look and its commit
            turns.append(other.append(odd.limit(5)))
        return now

    store.manifest = late
    store.append(odd.limit(20))
    store.manifest = before
    assert store.read().count() == 35 and len(store.manifest().runs) == 3
    odd.limit(3).write.parquet(f"file://{tmp_path}/s/data/m0-v00000009-abc")  # of a merge that died
    store.vacuum(grace=-60)
    assert store.read().count() == 35 and len(list((tmp_path / "s/data").iterdir())) == 3
