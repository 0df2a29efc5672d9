from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tallyforge.llm import exact_dedup as ed


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def test_groups_and_kept(odd, odd_rows):
    out = ed.exact_dedup(odd).collect()
    want = expected(odd_rows)
    assert len(out) == len(odd_rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in out) == Counter((r[0], *want[r[1] or ""]) for r in odd_rows)
    assert sum(r.kept for r in out) == len(want)


def test_state_over_several_batches(spark, odd, odd_rows, tmp_path):
    odd.repartition(5).write.parquet(str(tmp_path / "d"))
    out = ed.exact_dedup(spark.read.parquet(str(tmp_path / "d")), bytes_per_batch=1).collect()
    want = expected(odd_rows)
    assert {(r.keep_id, r.group_size) for r in out} == set(want.values())


def test_texts_that_share_a_digest_are_told_apart(odd, odd_rows):
    weak = lambda t: F.substring(F.sha2(F.encode(t, "UTF-8"), 256), 1, 1)
    out = ed.exact_dedup(odd, digest=weak).collect()
    want = expected(odd_rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in out) == Counter((r[0], *want[r[1] or ""]) for r in odd_rows)


def test_kept_documents_have_all_columns(odd, odd_rows):
    out = ed.kept_documents(odd)
    assert out.columns == odd.columns
    assert sorted(r.text or "" for r in out.collect()) == sorted({r[1] or "" for r in odd_rows})


def test_empty(empty):
    assert ed.exact_dedup(empty).count() == 0
    assert ed.kept_documents(empty).count() == 0


def test_hot_text_over_many_partitions(spark, tmp_path):
    """Half of all rows are one text, in 211 partitions; the rest are pairs."""
    rows = spark.range(4000).selectExpr("id as doc_id", "case when id % 2 = 0 then repeat('same text ', 200) else concat('pair ', id div 4) end as text")
    rows.repartition(211).write.parquet(str(tmp_path / "documents.parquet"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    try:
        out = ed.op6(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    hot = [r for r in out if r.doc_id % 2 == 0]
    assert len(out) == 4000 and {(r.keep_id, r.group_size) for r in hot} == {(3998, 2000)} and sum(r.kept for r in out) == 1001


def test_plan_is_native(odd):
    plan = ed.exact_dedup(odd)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_names_that_clash(odd, odd_rows):
    docs = odd.withColumns({"file": F.lit("own"), "row": F.lit(3), "flag": F.lit("f"), "bitmap": F.lit("b"), "_metadata": F.lit("m")})
    out = ed.kept_documents(docs)
    assert out.columns == docs.columns and out.count() == len({r[1] or "" for r in odd_rows})
    assert {(r.file, r.row, r.flag, r.bitmap, r._metadata) for r in out.collect()} == {("own", 3, "f", "b", "m")}
