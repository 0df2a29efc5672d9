import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import mixing


def by_quotients(claims, seats, caps):
    n = [0] * len(claims)
    for _ in range(seats):
        free = [i for i in range(len(claims)) if n[i] < caps[i] and claims[i] > 0]
        if not free:
            break
        n[max(free, key=lambda i: (claims[i] / (2 * n[i] + 1), -i))] += 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 40)), min_size=1, max_size=8), st.integers(0, 200))
def test_apportion_is_by_highest_quotients(rows, seats):
    """With caps and ties: the first of equal quotients gets the seat."""
    claims, caps = [float(c) for c, _ in rows], [cap for _, cap in rows]
    assert mixing.apportion(claims, seats, caps) == by_quotients(claims, seats, caps)
    assert mixing.apportion(claims, seats) == by_quotients(claims, seats, [seats] * len(claims))


def test_targets_stop_at_three_times():
    out = mixing.targets([1000, 10, 500], [1, 2, 3])
    assert out[1] == 30 and abs(sum(out) - 1510) < 1e-6 and abs(out[2] / out[0] - 3) < 1e-9
    assert mixing.targets([0, 0], [1, 2]) == [0.0, 0.0]


def test_mix_meets_targets(odd, odd_rows):
    out = mixing.mix(odd).collect()
    assert len(out) == len(odd_rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(r["size"] for r in out) == sorted(size(r[1]) for r in odd_rows)
    words, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        words[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r["size"]
    order = sorted(words, key=lambda s: (s is None, s or ""))
    want = mixing.targets([words[s] for s in order], [mixing.WEIGHTS[i % 3] for i in range(len(order))])
    for s, t in zip(order, want, strict=True):
        assert abs(target[s] - t) < 1e-6 and abs(taken[s] - t) <= max(2, 0.01 * t), s


def test_reruns_agree(odd):
    one = sorted((str(r.doc_id), r.digest, r.taken) for r in mixing.mix(odd).collect())
    assert one == sorted((str(r.doc_id), r.digest, r.taken) for r in mixing.mix(odd.repartition(7)).collect())


def test_many_shards(odd):
    out = mixing.mix(odd, docs_per_shard=3, block=5).collect()
    taken, target, shards = defaultdict(int), {}, defaultdict(int)
    for r in out:
        taken[r.source] += r.taken
        target[r.source] = r.target
        shards[r.source] += 1
        assert r.taken <= 3 * r["size"]
    for s in target:
        assert abs(taken[s] - target[s]) <= 5 * (shards[s] + 1)


def test_small_sources_meet_their_targets_whatever_the_block(spark):
    """Sources far below a block, and shards whose last block is short."""
    rows = [(k, f"w{k} " * 100, f"big{k % 3}") for k in range(300)] + [(1000 + k, "a b c d e f g h i j", "small") for k in range(6)] + [(2000, "x " * 1000, "zmid")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for shard in (2000, 7):
        taken, target = defaultdict(int), {}
        for r in mixing.mix(docs, docs_per_shard=shard, block=4096).collect():
            taken[r.source] += r.taken
            target[r.source] = r.target
            assert r.taken <= 3 * r["size"]
        assert all(abs(taken[s] - target[s]) <= 1 for s in target), (dict(taken), target)


def test_mixed_documents_hold_what_is_taken(odd):
    docs = mixing.mixed_documents(odd)
    assert docs.columns == odd.columns
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sum(size(r.text) for r in docs.collect()) == sum(r.taken for r in mixing.mix(odd).collect())


def test_empty(empty):
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0


def test_quotas_and_blocks_are_those_of_brute_force(spark, odd):
    """Shards, their quotas, and which words the blocks take, word by word."""
    import struct

    import xxhash

    block, seed = 5, 17
    rows = mixing.sized(odd)
    plan, _ = mixing.plan_sources(rows, docs_per_shard=4, block=block)
    placed = mixing.placed(rows, plan, seed).collect()
    of, shards = {p["idx"]: p for p in plan}, defaultdict(list)
    for r in placed:
        shards[r.idx, r.shard].append(r)
    words = {at: sum(r["size"] for r in part) for at, part in shards.items()}
    want = {}
    for idx in of:
        own = sorted(k for i, k in shards if i == idx)
        quota = by_quotients([words[idx, k] for k in own], of[idx]["seats"], [3 * words[idx, k] for k in own])
        for shard, q in zip(own, quota, strict=True):
            part = sorted(shards[idx, shard], key=lambda r: (r.order, r.doc_id is not None, r.doc_id or 0, r.digest))
            assert {r.quota for r in part} == {q}
            line = [k for k, r in enumerate(part) for _ in range(r["size"])]
            taken = [r["size"] * (q // max(1, len(line))) for r in part]
            m, rest = -(-len(line) // block), q % max(1, len(line))
            h = 42
            for v, form in ((idx, "<i"), (shard, "<q"), (seed + 2, "<i")):
                h = xxhash.xxh64_intdigest(struct.pack(form, v), h)
            offset = (h - 2**64 if h >= 2**63 else h) % max(1, m)
            for b in sorted(range(m), key=lambda i: (i * mixing.STRIDE + offset) % m):
                for k in line[b * block : (b + 1) * block][:rest]:
                    taken[k] += 1
                rest -= min(rest, len(line[b * block : (b + 1) * block]))
            for r, n in zip(part, taken, strict=True):
                want.setdefault((str(r.doc_id), r.digest), []).append(n)
    got = {}
    for r in mixing.mix(odd, docs_per_shard=4, block=block).collect():
        got.setdefault((str(r.doc_id), r.digest), []).append(r.taken)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_names_that_clash(odd):
    from pyspark.sql import functions as F

    docs = odd.withColumns({"words": F.lit("own"), "at_file": F.lit(5), "_metadata": F.lit("m")})
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and {(r.words, r.at_file, r._metadata) for r in out.collect()} == {("own", 5, "m")}


def test_groups_of_shards_share_a_source(spark):
    rows = [(0, k, 10 + k % 7, 900) for k in range(50)]
    out = mixing.shard_quotas(spark.createDataFrame(rows, "idx int, shard bigint, words bigint, seats bigint"), per_group=8).collect()
    assert sum(r.quota for r in out) == 900 and all(abs(r.quota - 900 * r.words / sum(x[2] for x in rows)) <= 1.5 for r in out)
