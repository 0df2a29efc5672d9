import random

import numpy as np

from tallyforge.llm import dartminhash as dm
from tallyforge.llm import shingles
from tallyforge.llm.components import components


def brute(rows):
    """Class of each row by all pairs of sets of five words."""
    sets = []
    for r in rows:
        w = (r[1] or "").split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (a and b and len(a & b) >= 0.8 * len(a | b)):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return sorted((min((x for x in g if x is not None), default=-1), len(g)) for g in groups.values())


def test_classes_match_all_pairs(odd, odd_rows):
    out = dm.near_classes(odd).collect()
    assert len(out) == len(odd_rows)
    got = sorted({(r.class_id if r.class_id is not None else -1, r.class_size) for r in out})
    assert got == brute(odd_rows)
    assert sum(r.kept for r in out) == len(brute(odd_rows))


def test_long_chain_is_one_class(spark, words):
    """Neighbours are near, ends are not: links must not hang on one centre."""
    rng = random.Random(3)
    text = [rng.choice(words) for _ in range(200)]
    rows = []
    for k in range(40):
        text[k * 5] = f"new{k}"
        rows.append((k, " ".join(text)))
    out = dm.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.class_id, r.class_size) for r in out} == {(0, 40)}


def test_copies_meet_in_a_bucket_whose_least_node_is_neither(spark):
    """Texts that share a passage just under the likeness, with near copies among them, and one band for all."""
    shared = [f"p{k}" for k in range(180)]
    rows = []
    for k in range(60):
        both = [*shared, *(f"b{k}w{j}" for j in range(4))]
        rows += [(2 * k + e, " ".join([*both, *(f"t{k}e{e}w{j}" for j in range(20))])) for e in (0, 1)]
    out = dm.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted({(r.class_id, r.class_size) for r in out}) == brute(rows) == [(2 * k, 2) for k in range(60)]


def test_look_alikes_lose_no_link(spark):
    """Two hundred pairs (0.82) that all share a passage just under the likeness (0.79): every pair is found, nothing else."""
    shared, rows = [f"p{k}" for k in range(176)], []
    for k in range(200):
        both = [*shared, *(f"b{k}w{j}" for j in range(4))]
        rows += [(2 * k + e, " ".join([*both, *(f"t{k}e{e}w{j}" for j in range(20))])) for e in (0, 1)]
    out = dm.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.class_id, r.class_size) for r in out} == {(2 * k, 2) for k in range(200)}


def test_signature_estimates_weighted_likeness():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
    a, b = np.concatenate((pool[:300], pool[:20])), pool[100:400]
    h = np.concatenate((a, b))
    doc = np.concatenate((np.zeros(len(a), int), np.ones(len(b), int)))
    sig = dm.signatures(h, doc, 2)
    want = 200 / (300 + 20 + 100)  # weights 2 on twenty that b lacks
    assert abs((sig[0] == sig[1]).mean() - want) < 0.2
    many = np.mean([(lambda s: (s[0] == s[1]).mean())(dm.signatures(shingles.mix(h + np.uint64(k)), doc, 2)) for k in range(40)])
    assert abs(many - want) < 0.03


def test_bands_are_of_sets_whatever_the_counts():
    """A text and the same text pasted several times share bands; equal sets have equal ones."""
    texts = []
    for k in range(20):
        one = " ".join(f"t{k}w{j}" for j in range(200))
        texts += [one, " ".join([one] * 8), f"{one} {one}", f"{one} {one} {one}"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    nodes, bands = dm.node_and_bands(data, np.cumsum([0, *map(len, texts)]))
    for k in range(0, len(texts), 4):
        assert (bands[k] == bands[k + 1]).any()
        assert nodes[k + 1] == nodes[k + 2] == nodes[k + 3] and (bands[k + 1] == bands[k + 2]).all() and (bands[k + 1] == bands[k + 3]).all()


def test_shingles_are_as_words_in_python(odd_rows):
    for r in odd_rows:
        t = r[1] or ""
        w = t.split()
        n = len({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}) if w else 0
        assert len(shingles.shingle_set(t.encode())) == n


def test_shared_counts_are_those_of_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 400, rng.integers(0, 90)).astype(np.uint64)) for _ in range(30)]
    got = shingles.shared(sets[:12], sets[12:], 64)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(50)] + [(100, 101), (102, 101)], "a bigint, b bigint")
    root = {r.node: r.root for r in components(links).collect()}
    assert root == {k: 0 for k in range(1, 51)} | {101: 100, 102: 100}


def test_empty_and_kept(empty, odd):
    assert dm.near_classes(empty).count() == 0
    kept = dm.kept_documents(odd)
    assert kept.columns == odd.columns
