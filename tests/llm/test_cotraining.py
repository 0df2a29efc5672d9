import random

import numpy as np
from pyspark.sql import functions as F

from tallyforge.llm import cotraining as ct


def corpus(spark, words):
    rng = random.Random(11)
    docs, labels = [], []
    for k in range(500):
        good = k % 3 != 0
        text = " ".join(rng.choice(words) + ("" if good else "%%%") for _ in range(rng.randrange(30, 90)))
        docs.append((k, text, "en", f"src{k % 3 if rng.random() < 0.8 else rng.randrange(3)}", 1.0))
        if k % 4 == 0:
            labels.append((k, int(good)))
    docs += [(900, None, None, None, 1.0), (901, "", "en", "src1", 1.0), (None, "no id", None, None, 1.0), (902, "word " * 50_000, None, None, 1.0)]
    return spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, score double"), spark.createDataFrame([*labels, (8, None), (None, 1), (9999, 0)], "doc_id bigint, quality int")


def test_unlabelled_documents_are_told_apart(spark, words):
    docs, labels = corpus(spark, words)
    out = {r.doc_id: r for r in ct.score(docs, ct.train(docs, labels)).collect()}
    assert len(out) == docs.count()
    right = [out[k].good == (k % 3 != 0) for k in range(500) if k % 4]
    assert np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 for r in out.values()) and 900 in out and None in out


def test_pseudo_labels_help_the_weaker_view():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 1200).astype(np.float32)
    t = (rng.normal(size=(1200, 20)) + y[:, None] * 0.9).astype(np.float32)
    m = np.zeros((1200, ct.META), np.float32)
    m[:, :5] = rng.normal(size=(1200, 5)) + y[:, None] * 1.2
    model = ct.fit(t[:40], m[:40], y[:40], t[40:700], m[40:700])
    both, one, two = model.score(t[700:] @ model.text[0] + model.text[1], m[700:] @ model.meta[0] + model.meta[1])
    hit = lambda p: ((p >= 0.5) == (y[700:] == 1)).mean()
    assert hit(both) > 0.9 and hit(both) >= max(hit(one), hit(two)) - 0.02


def test_the_pool_is_the_whole_table(spark, words):
    """What a round takes of a table is what it takes of arrays of the same rows."""
    docs, labels = corpus(spark, words)
    rows = docs.where("doc_id is not null").select(F.xxhash64(F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))).alias("h"), "doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    labelled = labels.select("doc_id").where("doc_id is not null")
    vectors = ct._vectors(rows.join(labelled, "doc_id", "left_anti").withColumn("y", F.lit(None).cast("int")))
    rng = np.random.default_rng(5)
    models = {"text": (rng.normal(size=len(vectors[0][2])).astype(np.float32) * 9, 0.1), "meta": (rng.normal(size=ct.META).astype(np.float32) * 9, -0.2)}
    table, arrays = ct.TablePool(rows, labelled), ct.ArrayPool(np.stack([v[2] for v in vectors]), np.stack([v[3] for v in vectors]))
    for _ in range(2):
        a, b = table.pick(models, 7, 5), arrays.pick(models, 7, 5)
        for view in ct.VIEWS:
            assert a[view][1] == b[view][1] and len(a[view][1]) > 3
    assert all(len(table.given[v]) == len(arrays.given[v]) for v in ct.VIEWS)
    seen = {v: {vectors[k][0] for k in arrays.given[v]} for v in ct.VIEWS}
    assert len(seen["text"] & table.given["text"]) >= 0.8 * len(seen["text"])  # ties of metadata aside
    assert len(seen["meta"] & table.given["meta"]) >= 0.95 * len(seen["meta"])


def test_repeated_rows_count_once(spark, words):
    docs, labels = corpus(spark, words)
    many = docs.unionByName(docs.where("doc_id in (0, 4)").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("k"))
    one, two = ct.train(docs, labels), ct.train(many, labels)
    assert np.allclose(one.text[0], two.text[0]) and np.allclose(one.combine, two.combine)


def test_one_class_no_label_and_empty(spark, words, empty):
    docs, labels = corpus(spark, words)
    assert {r.score for r in ct.score(docs, ct.train(docs, labels.where("quality = 1"))).collect()} == {1.0}
    assert {r.score for r in ct.score(docs, ct.train(docs, labels.limit(0))).collect()} == {0.5}
    assert ct.score(empty, ct.train(empty, labels.limit(0))).count() == 0
