import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyforge.llm import resampling as rs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def features(text, ngrams, buckets):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(ngrams[0], ngrams[1] + 1) for i in range(len(w) - n + 1)]


def brute(source, target, ngrams, buckets, least, percent):
    s = Counter(b for _, t in source for b in features(t, ngrams, buckets))
    t = Counter(b for x in target for b in features(x, ngrams, buckets))
    total, goal = sum(s.values()), sum(t.values())
    out = []
    for i, text in source:
        f = features(text, ngrams, buckets)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (goal + buckets)))) for b in f]
        weight = sum(gain) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    large = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(large[: len(large) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize(("ngrams", "buckets"), [((1, 1), 10_000), ((1, 2), 97), ((2, 3), 1000)])
def test_matches_brute_force(spark, odd, odd_rows, ngrams, buckets):
    target = [" ".join((r[1] or "").split()[:40]) for r in odd_rows[:20]] + [None, "", "日本語 word"]
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, none int")
    out = rs.resample(odd, goal, ngrams=ngrams, buckets=buckets, percent=30)
    want = brute([(r[0], r[1]) for r in odd_rows], target, ngrams, buckets, 20, 30)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    # rows of equal id and score may share their ranks in any order
    assert sorted((g[0], g[3], g[4]) for g in got if g[4]) == sorted((w[0], w[3], w[4]) for w in want if w[4]) or Counter(g[4] for g in got) == Counter(w[4] for w in want)


def test_ranks_are_whole_and_in_order(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("abcdefgh") for _ in range(30)) if k % 3 else "same text of a hot group " * 5) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = rs.resample(docs, docs.limit(10), percent=100).collect()
    assert [r.doc_id for r in sorted(out, key=lambda r: r["rank"])] == [r.doc_id for r in sorted(out, key=lambda r: (-r.score, r.doc_id))]
    assert sorted(r["rank"] for r in out) == list(range(1, 601))


def test_empty_tables(spark, odd, empty):
    assert rs.resample(empty, odd).collect() == []
    assert rs.resample(odd, empty).count() == odd.count()


def test_string_identifiers_and_target_columns(spark):
    docs = spark.createDataFrame([("a", "one two"), (None, "two")], "name string, body string")
    goal = spark.createDataFrame([("two two",)], "words string")
    out = rs.resample(docs, goal, id="name", text="body", least=1, percent=50, target_text="words").collect()
    assert {r["name"]: r["n_features"] for r in out} == {"a": 2, None: 1}
    assert sum(r["rank"] is not None for r in out) == 1


def test_crc_of_long_and_joined_words():
    rng = random.Random(1)
    for _ in range(50):
        w = ["".join(rng.choice("abcé日") for _ in range(rng.choice([1, 2, 5, 30, 200]))) for _ in range(rng.randrange(1, 8))]
        data = np.frombuffer(" ".join(w).encode(), np.uint8)
        of, crc, n = rs.feature_hashes(data, np.array([0, len(data)]), (1, 3))
        want = [zlib.crc32(" ".join(w[i : i + k]).encode()) for k in (1, 2, 3) for i in range(len(w) - k + 1)]
        assert crc.tolist() == want and n.tolist() == [len(w)] and not of.any()


def test_postings_are_joined_by_bucket_and_split_when_hot(spark, odd):
    mine = rs.written(rs.postings(odd), "postings")
    plan = rs.weights(mine, rs.gains(mine, mine))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
    assert max(r.n for r in mine.where("bucket IS NOT NULL").selectExpr("size(docs) n").collect()) <= 1000
