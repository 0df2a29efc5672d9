import hashlib
import random
import struct

import numpy as np
import pytest
import xxhash

from tallyforge.llm import fingerprint as fp


def shingles(t):
    w = t.split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_edits_next_document_and_likeness(spark, words):
    import random

    rng = random.Random(9)
    rows = [(k * 3, " ".join(rng.choice(words) for _ in range(rng.randrange(150, 300)))) for k in range(120)]
    rows += [(500, ""), (501, None), (502, "one two"), (503, rows[7][1]), (504, "é日🙂" * 3)]
    out = {r.doc_id: r for r in fp.edited_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    ordered = sorted(rows, key=lambda r: -r[0])
    errors = []
    for (k, t), (_, n) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        t, n = t or "", n or ""
        cut = len(t) // 3
        edited = t[: len(t) - cut] + n[:cut]
        assert out[k].n_chars == len(t) and out[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = shingles(t), shingles(edited), shingles(n)
        if len(t) > 100:
            errors.append(out[k].near_edited - len(a & b) / len(a | b))
            if c:
                assert abs(out[k].near_next - len(a & c) / len(a | c)) < 0.12
        assert 0 <= out[k].near_edited <= 1 and 0 <= out[k].near_next <= 1
    assert np.std(errors) < 0.06 and abs(np.mean(errors)) < 0.02
    assert out[503].fingerprint == out[21].fingerprint and out[500].fingerprint == out[501].fingerprint == ""
    assert out[501].near_next == 1.0 and out[502].fingerprint != ""


def brute(text):
    """The fingerprint in plain Python: least hash of each bin, empty bins by their walks, the low bits as hex digits."""
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in text.split()]
    if not h:
        return ""
    start, stride = (list(x) for x in _walks())
    bins = {}
    for i in range(max(1, len(h) - 4)):
        x = 42
        for v in h[i : i + 5]:
            x = xxhash.xxh64_intdigest(struct.pack("<Q", v), x)
        x >>= 1
        j, low = x >> 55, x & ((1 << 55) - 1)
        bins[j] = min(bins.get(j, low), low)
    full = [bins.get(j, next((bins[k] for k in ((start[j] + r * stride[j]) & 255 for r in range(257)) if k in bins), None)) for j in range(256)]
    return "".join(f"{x & 15:x}" for x in full)


def _walks(seed=11):
    rng = random.Random(seed)
    return [rng.randrange(256) for _ in range(256)], [rng.randrange(1, 256, 2) for _ in range(256)]


def test_fingerprints_are_those_of_brute_force(spark, words):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(words) for _ in range(n))) for k, n in enumerate((0, 1, 3, 5, 6, 9, 40, 200, 256, 700, 4000))]
    out = {r.doc_id: r for r in fp.edited_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for k, t in rows:
        assert out[k].fingerprint == brute(t), k


@pytest.mark.parametrize("group", [1024, 3, 1])
def test_ranges_are_stitched(spark, monkeypatch, group):
    monkeypatch.setattr(fp, "ROWS_PER_BUCKET", 7)
    monkeypatch.setattr(fp, "BUCKETS_PER_GROUP", group)
    rows = [(k * k, f"doc {k} " + "word " * k) for k in range(100)] + [(None, "null id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = fp.with_next(df, lambda x: x, ["text"], "next").collect()
    ordered = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else -1))
    want = {a[0]: b[1] for a, b in zip(ordered, ordered[1:] + ordered[:1], strict=True)}
    assert {r.doc_id: r.next.text for r in out} == want


def test_ties_repeated_rows_and_empty(odd, odd_rows, empty):
    assert fp.edited_fingerprints(odd).count() == len(odd_rows)
    assert fp.edited_fingerprints(empty).count() == 0


def test_plan_is_native(odd):
    plan = fp.edited_fingerprints(odd.limit(5))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
