import numpy as np
from pyspark.sql import functions as F

from tallyforge.llm import langid


def corpus(spark):
    say = {"en": "the quick brown fox jumps over the lazy dog and then some more of it", "de": "der schnelle braune fuchs springt über den faulen hund und noch mehr davon", "fr": "le rapide renard brun saute par dessus le chien paresseux et encore plus"}
    rows = []
    for k in range(300):
        lang = ("en", "de", "fr")[k % 3]
        w = say[lang].split()
        rows.append((k, " ".join(w[(k * 7 + j) % len(w)] for j in range(6 + k % 9)), None if k % 10 == 9 else lang, "s", 0.1))
    rows += [(1000, None, "en", None, 0.1), (1001, "", None, None, 0.1), (1002, "1234 !!", "de", None, 0.1), (None, "der hund und der fuchs", None, None, 0.1), (1003, "fox " * 40_000, None, None, 0.1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score double")


def test_codebooks_keep_languages_apart():
    for n in (2, 3, 4, 6, 9, 40):
        code = langid.codebook(n)
        assert code.shape[0] == n and len({tuple(c) for c in code}) == n
        assert all(0 < code[:, b].sum() < n for b in range(code.shape[1]))
        assert n < 4 or min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 3


def test_held_out_accuracy_and_undetermined(spark):
    docs = corpus(spark)
    model = langid.train(docs.where(~langid.held_out()))
    out = {(r.doc_id, r.text): r for r in langid.predict(docs, model).collect()}
    assert len(out) == docs.count()
    held = {r.doc_id for r in docs.where(langid.held_out() & F.col("lang").isNotNull() & (F.col("doc_id") < 300)).collect()}
    right = [out[r.doc_id, r.text].lang_pred == ("en", "de", "fr")[r.doc_id % 3] for r in docs.collect() if r.doc_id in held]
    assert len(right) > 30 and np.mean(right) > 0.97
    for key in ((1000, None), (1001, ""), (1002, "1234 !!")):
        assert out[key].lang_pred == "und" and out[key].score == 0 and not out[key].ambiguous
    assert all(0 <= r.score <= 1 for r in out.values())


def test_decoding_is_loss_weighted():
    """The nearest codeword by hand, on given margins."""
    rng = np.random.default_rng(1)
    code = langid.codebook(4)
    model = langid.Model(["a", "b", "c", "d"], code, np.zeros((0, 0)), np.zeros(code.shape[1]), rng.uniform(0.5, 2, code.shape[1]))
    margins = rng.normal(0, 2, (50, code.shape[1]))
    best, score, gap = model.decode(margins)
    for k in range(50):
        cost = [sum(t * np.log1p(np.exp(-m * (1 if bit else -1))) for t, m, bit in zip(model.trust, margins[k], word, strict=True)) for word in code]
        order = np.argsort(cost)
        assert best[k] == order[0] and np.isclose(gap[k], cost[order[1]] / cost[order[0]] - 1)
        weight = [np.exp(-langid.SHARP * c / model.trust.sum()) for c in cost]
        assert np.isclose(score[k], max(weight) / sum(weight))


def test_texts_between_languages_are_flagged(spark):
    docs = corpus(spark)
    model = langid.train(docs.where(~langid.held_out()))
    rows = docs.where("doc_id < 300").collect()
    of = lambda lang: " ".join(r.text for r in rows if r.lang == lang)
    a, b = of("en"), of("de")
    found = None
    for share in np.linspace(0.2, 0.8, 61):  # somewhere between the two the margin is nil
        n = int(1500 * share)
        text = a[:n] + " " + b[: 1500 - n]
        out = langid.predict(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), model).first() if found is None else None
        found = found or (out if out.ambiguous else None)
    assert found is not None
    clean = langid.predict(docs.where("doc_id < 300"), model)
    assert clean.where("ambiguous").count() <= 1


def test_sample_is_of_the_smallest_hashes_and_repeated_rows_count_once(spark):
    same = [(7, "the same row", "en")] * 2000 + [(7, f"text {k}", "de") for k in range(2000)] + [(k, f"un texte {k}", "fr") for k in range(30)]
    docs = spark.createDataFrame(same, "doc_id bigint, text string, lang string")
    got = langid.sample(docs, 50).collect()
    hashes = docs.select("lang", F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit("sample")).alias("h")).distinct().collect()
    want = {(lang, h) for lang in ("en", "de", "fr") for h in sorted(r.h for r in hashes if r.lang == lang)[:50]}
    assert {(r.lang, r.h) for r in got} == want and len(got) == 1 + 50 + 30


def test_names_that_clash(spark):
    docs = corpus(spark).withColumns({"lang_pred": F.lit("own"), "ambiguous": F.lit(3), "text_": F.lit("t"), "_metadata": F.lit("m")})
    kept = langid.accepted_documents(docs)
    assert kept.columns == docs.columns and {(r.lang_pred, r.ambiguous, r.text_) for r in kept.collect()} == {("own", 3, "t")}


def test_stage_keeps_columns_and_clean_rows(spark):
    docs = corpus(spark)
    kept = langid.accepted_documents(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert {r.score for r in rows} == {0.1}
    assert {1000, 1001, 1002}.isdisjoint({r.doc_id for r in rows}) and len(rows) >= 299


def test_no_label_one_language_and_empty(spark, empty):
    rows = spark.createDataFrame([(1, "some text", None), (2, "more text", None)], "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in langid.predict(rows, langid.train(rows)).collect()} == {"und"}
    one = rows.withColumn("lang", F.lit("xx"))
    assert {(r.lang_pred, r.score) for r in langid.predict(one, langid.train(one)).collect()} == {("xx", 1.0)}
    assert langid.predict(empty, langid.train(empty)).count() == 0
