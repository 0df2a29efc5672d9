import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import hardnegatives as hn

KIND = "vec_id bigint, embedding array<float>, label int, score double, q string, key string"


def brute(rows, positives=5, negatives=3, low=50, high=95):
    good = []
    for k, (i, v, label, *_) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, k, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a in good:
        if a[0] % 50:
            continue
        others = [(-score(a[3], r[3]), r[0], r[1], r[2]) for r in good if r[1] != a[1]]
        for p in sorted(o for o in others if o[3] == a[2])[:positives]:
            fit = sorted(o for o in others if o[3] != a[2] and low * -p[0] <= 100 * -o[0] <= high * -p[0])
            out += [(a[0], p[1], k + 1, n[1], -p[0], -n[0]) for k, n in enumerate(fit[:negatives])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "q", "key") for r in rows], KIND)


def vectors(n, seed, dims=16, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dims))
    out = []
    for k in range(n):
        label = int(rng.integers(labels))
        v = centre[label] * 0.4 + rng.normal(size=dims)
        out.append((k, [float(x) for x in v / np.linalg.norm(v)], label))
    return out


def mined(df, **more):
    return sorted(tuple(r) for r in hn.mine(df, F.col("vec_id") % 50 == 0, **more).collect())


def test_equals_scoring_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 150)
    monkeypatch.setattr(hn, "ANCHORS", 3)
    monkeypatch.setattr(hn, "CELLS", 700)
    rows = vectors(900, 1)
    assert mined(table(spark, rows)) == brute(rows)


def test_copies_ties_nulls_and_odd_lengths(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 40)
    rng = random.Random(2)
    rows = vectors(200, 3, dims=7)
    rows += [(k, rows[100][1], rows[100][2]) for k in range(200, 320)]  # a third are copies, anchors among them
    rows += [(k, rows[100][1], (rows[100][2] + 1) % 4) for k in range(320, 360)]
    rows += [(k, rows[k - 360][1], rows[k - 360][2]) for k in range(360, 400)]
    rows += [(400, None, 1), (401, [1.0] * 7, None), (402, [1.0, None] + [0.0] * 5, 1), (403, [float("nan")] * 7, 1), (404, [float("inf")] * 7, 1), (405, [0.5], 1), (406, [], 2), (450, [0.0] * 7, 1), (500, [-1.0] * 7, 0)]
    rng.shuffle(rows)
    assert mined(table(spark, rows)) == brute(rows)


def test_repeated_identifiers_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, [1.0, 0.1], 0), (2, [0.8, 0.0], 1), (3, [0.7, 0.0], 1)]
    assert mined(table(spark, rows)) == brute(rows)


def test_empty_and_missing(spark):
    assert mined(table(spark, vectors(10, 1)).limit(0)) == []
    assert mined(table(spark, [(1, [1.0], 0), (2, [1.0], 1)])) == []
    assert mined(table(spark, [(0, None, None)])) == []


def test_large_components_end_with_an_error(spark):
    with pytest.raises(Exception, match="must stay below"):
        mined(table(spark, [(0, [1e30], 0)]))


def test_bounds_hold_and_leave_few_to_be_scored():
    rng = np.random.default_rng(4)
    v = np.floor(256 * (x := rng.normal(size=(4000, 64))) / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)
    book = hn.fit(v[:2048])
    codes = np.stack([hn.nearest(v[:, 2 * m : 2 * m + 2].astype(float), c.astype(float)) for m, c in enumerate(book)], axis=1).astype(np.uint8)
    left = v - np.concatenate([c[codes[:, m]] for m, c in enumerate(book)], axis=1)
    lo, hi = hn.bounds(v[:50], book, codes, np.sqrt((left * left).sum(1)))
    exact = v[:50] @ v.T
    assert (lo <= exact).all() and (exact <= hi).all()
    reach = np.sort(lo, axis=1)[:, -5]
    assert (hi >= reach[:, None]).mean() < 0.1


def test_only_the_first_copies_are_dealt_out(spark):
    df = table(spark, vectors(50, 1)).withColumn("q", F.lit(b"1"))
    plan = hn.first(df, ["label", "q"], ["vec_id"], 6)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
