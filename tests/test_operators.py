"""Statement operators on small rows whose results are worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import checks, derive, fuzzy, merges, pages, rules, scores, spatial
from tallyforge.plans import schema, statement

CELLS = "doc_id bigint, block string, sl_no int, field string, value double"


def d_cells(spark, rows):
    return spark.createDataFrame([(1, "D", sl, "opening_rs", float(v)) for sl, v in rows.items()], CELLS)


def as_dict(cells):
    return {r.sl_no: r.value for r in cells.collect()}


LEAVES = {1: 100, 2: 20, 3: 30, 5: 40, 6: 10, 8: 15, 9: 25, 10: 5, 12: 60, 13: 35, 14: 5}


def test_derived_rows(spark):
    out = as_dict(derive.recompute(d_cells(spark, LEAVES)))
    assert {k: out[k] for k in (4, 7, 11, 15, 16)} == {4: 150, 7: 200, 11: 245, 15: 100, 16: 145}
    again = derive.recompute(derive.recompute(d_cells(spark, LEAVES)))
    assert as_dict(again) == out
    assert as_dict(derive.recompute(d_cells(spark, {1: 0, 4: 9}))) == {1: 0, 4: 9}


def test_autocorrect_fills_only_zeros_in_order(spark):
    out = as_dict(derive.autocorrect(d_cells(spark, LEAVES | {4: 0, 7: 0, 11: 7, 15: 0, 16: 0})))
    assert {k: out[k] for k in (4, 7, 11, 15, 16)} == {4: 150, 7: 200, 11: 7, 15: 100, 16: -93}


def test_scale_and_residual(spark):
    rows = spark.createDataFrame([(1, sl, v, 660.0) for sl, v in ((2, 100.0), (3, 200.0), (4, 300.0), (7, 50.0))], "doc_id int, sl_no int, v double, anchor double")
    scaled = derive.scale_to_anchor(rows, "v", "anchor")
    assert {r.sl_no: r.v for r in scaled.collect()} == {2: 102, 3: 203, 4: 305, 7: 51}
    done = derive.residual_to_largest(scaled, "v", "anchor", "sl_no")
    assert {r.sl_no: r.v for r in done.collect()} == {2: 102, 3: 203, 4: 304, 7: 51}
    far = rows.withColumn("anchor", F.lit(710.0))
    far = derive.residual_to_largest(derive.scale_to_anchor(far, "v", "anchor"), "v", "anchor", "sl_no")
    assert {r.sl_no: r.v for r in far.collect()} == {2: 100, 3: 200, 4: 300, 7: 50}


def test_imputation_takes_the_plainest_row(spark):
    rows = spark.createDataFrame([(1, 2, 50e6, 200e6), (1, 3, 90e6, 200e6), (1, 4, 40e6, 200e6)], "doc_id int, sl_no int, v double, sub double")
    out = {r.sl_no: (r.v, r.imputed) for r in derive.impute_from_subtotal(rows, "v", "sub", "sl_no").collect()}
    assert out == {2: (50e6, False), 3: (110e6, True), 4: (40e6, False)}


def c_row(**kw):
    return {f: 0.0 for f in schema.C_FIELDS} | {"doc_id": 1} | kw


def test_row_identities(spark):
    df = spark.createDataFrame([c_row(sl_no=3, net_opening=80.0, dep_up_to_beginning=20.0, dep_provided_during_year=5.0, net_closing=90.0, gross_opening=7.0, gross_addition_reval=3.0), c_row(sl_no=8, net_opening=1.0, dep_up_to_beginning=1.0)])
    out = {r.sl_no: r for r in derive.repair_identities(df).collect()}
    r = out[3]
    assert (r.dep_up_to_end, r.gross_opening, r.gross_closing, r.gross_addition_actual, r.gross_deduction, r.gross_addition_reval) == (25, 100, 115, 15, 0, 0)
    assert out[8].gross_opening == 0
    flagged = spark.createDataFrame([c_row(sl_no=3, net_opening=80.0, gross_opening=110.0, net_closing=90.0, gross_closing=130.0) | {"imp": True}])
    r = derive.repair_identities(flagged, imputed="imp").first()
    assert (r.dep_up_to_beginning, r.dep_up_to_end, r.dep_provided_during_year, r.gross_addition_actual) == (30, 40, 10, 20)


def test_depreciation_is_capped(spark):
    df = spark.createDataFrame([c_row(sl_no=2, gross_closing=100.0, dep_up_to_end=150.0, net_closing=5.0)])
    r = derive.cap_depreciation(df).first()
    assert (r.dep_up_to_end, r.net_closing) == (100, 0)


def test_array_helpers(spark):
    df = spark.createDataFrame([([5.0, 5.04, 5.08, 5.2], [3.0, 1.0, 2.0, 4.0])], "a array<double>, b array<double>")
    r = df.select(derive.keep_last_kept(F.col("a")).alias("k"), derive.upper_median(F.col("b")).alias("m"), derive.merge_positions(F.col("b"), [0, 3, 9]).alias("s"), derive.right_aligned(F.col("b"), 6).alias("w"), derive.top_two(F.col("b")).alias("t")).first()
    assert r.k == [5.0, 5.08, 5.2] and r.m == 3.0 and r.s == 7.0 and r.w == [0, 0, 3, 1, 2, 4] and (r.t.closing, r.t.opening) == (4, 3)


def test_merges(spark):
    rows = spark.createDataFrame([(1, 2, 0, 0.0), (1, 2, 1, 7.0), (1, 2, 2, 9.0), (1, 3, 0, 0.0)], "doc_id int, sl_no int, page int, value double")
    assert {(r.sl_no, r.value) for r in merges.first_nonzero(rows, ["doc_id", "sl_no"], ["page"]).collect()} == {(2, 7.0), (3, 0.0)}
    assert {(r.sl_no, r.value) for r in merges.last_nonzero(rows, ["doc_id", "sl_no"], ["page"]).collect()} == {(2, 9.0)}
    d = spark.createDataFrame([(1, 1, 0, 10.0, 10.0), (1, 1, 1, 5.0, 30.0), (1, 9, 0, 10.0, 10.0), (1, 9, 1, 5.0, 30.0), (1, 8, 0, 0.0, 0.0), (1, 8, 1, 1.0, 2.0)], "doc_id int, sl_no int, ord int, opening_rs double, closing_rs double")
    assert {(r.sl_no, r.opening_rs, r.closing_rs) for r in merges.dedupe_detail(d, "ord").collect()} == {(1, 5, 30), (9, 10, 10), (8, 1, 2)}


def test_template_has_all_rows_and_keeps_labels(spark):
    rows = spark.createDataFrame([(1, 3, " ", 5.0), (1, 4, "Own", None), (2, 17, None, 1.0)], "doc_id int, sl_no int, label string, opening_rs double")
    out = merges.template_merge(rows, "D")
    assert out.count() == 34
    got = {(r.doc_id, r.sl_no): (r.label, r.opening_rs) for r in out.collect()}
    assert got[1, 3] == (schema.D_LABELS[2], 5.0) and got[1, 4] == ("Own", 0.0) and got[2, 17][1] == 1.0


def test_components_merge(spark):
    kind = "doc_id int, key string, opening double, closing double"
    a = spark.createDataFrame([(1, "schedule_8.total", 1.0, 2.0), (1, "note_20.total", 1.0, 2.0), (1, "face.x", 4.0, 5.0), (1, "only.a", 1.0, 1.0)], kind)
    b = spark.createDataFrame([(1, "schedule_8.total", 3.0, 4.0), (1, "note_20.total", 3.0, 4.0), (1, "face.x", 8.0, 9.0), (1, "only.b", 2.0, 2.0)], kind)
    assert {r.key: (r.opening, r.closing) for r in merges.merge_components(a, b).collect()} == {"schedule_8.total": (3, 4), "note_20.total": (1, 2), "face.x": (8, 9), "only.a": (1, 1), "only.b": (2, 2)}


def test_rules(spark):
    comp = spark.createDataFrame([(1, "a", 10.0, 20.0), (1, "b", 3.0, 4.0)], "doc_id int, key string, opening double, closing double")
    one = [("p", 1, s, k, g) for s in ("opening", "closing") for k, g in (("a", 1), ("b", -1))]
    split = [("p", 2, "opening", "a", 1), ("p", 2, "closing", "b", 1), ("p", 3, "opening", "none", 1), ("q", 1, "opening", "a", 1)]
    out = rules.evaluate(comp, spark.createDataFrame(one + split, rules.RULES))
    assert {(r.profile, r.sl_no, r.opening, r.closing) for r in out.collect()} == {("p", 1, 7, 16), ("p", 2, 10, 4), ("q", 1, 10, 0)}
    assert [tuple(r) for r in rules.choose_profile(out, {"q": 0, "p": 1}).collect()] == [(1, "p", 2)]
    target = spark.createDataFrame([(1, 5, 7.0, 16.0), (1, 6, 10.0, 20.0), (1, 7, 99.0, 1.0)], "doc_id int, sl_no int, opening double, closing double")
    assert {(r.sl_no, r.formula, r.terms) for r in rules.find_formulas(comp, target).collect()} == {(5, "+a-b", 2), (6, "+a", 1)}


def test_band_join_is_complete(spark):
    import random

    rng = random.Random(2)
    v, t = [rng.uniform(1, 1e6) for _ in range(800)], [rng.uniform(1, 1e6) for _ in range(200)]
    out = rules.values_near(spark.createDataFrame([(k, x) for k, x in enumerate(v)], "k int, value double"), spark.createDataFrame([(k, x) for k, x in enumerate(t)], "target_id int, target double"), 0.02)
    assert {(r.k, r.target_id) for r in out.collect()} == {(i, j) for i, x in enumerate(v) for j, y in enumerate(t) if abs(x - y) <= 0.02 * y}


def test_checks_of_consistent_rows_pass(spark):
    cells = derive.recompute(d_cells(spark, LEAVES | {17: 5}))
    rows = merges.to_rows(cells.unionByName(cells.withColumn("field", F.lit("closing_rs"))), "D")
    out = checks.checks_d(rows)
    assert out.where("not ok").count() == 0
    r = checks.report(out).first()
    assert r.score_pct == 100 and r.ok and r.failures == []
    bad = checks.checks_d(rows.withColumn("opening_rs", F.when(F.col("sl_no") == 11, 0.0).when(F.col("sl_no") == 9, -1.0).otherwise(F.col("opening_rs"))))
    assert {(r.code, r.sl_no) for r in bad.where("not ok").collect()} == {("D_DERIVED_11", 11), ("D_DERIVED_16", 16), ("D_NON_NEGATIVE", 9)}
    assert checks.verdict(checks.audit_checks(rows, "D")).first().status == "APPROVED"


def test_asset_checks(spark):
    rows = [c_row(sl_no=k, net_opening=4e6, dep_up_to_beginning=1e6, gross_opening=5e6, net_closing=4.5e6, dep_provided_during_year=5e5, dep_up_to_end=1.5e6, gross_closing=6e6, gross_addition_actual=1e6) for k in range(2, 8)]
    cells = derive.recompute(merges.to_cells(spark.createDataFrame(rows), "C"))
    good = merges.to_rows(cells, "C")
    assert checks.checks_c(good).where("not ok").count() == 0
    face = spark.createDataFrame([(1, 24e6, 30e6)], "doc_id bigint, opening double, closing double")
    assert {(r.field, r.ok) for r in checks.face_checks(good, face).collect()} == {("net_opening", True), ("net_closing", False)}


def test_scores_against_itself(spark):
    cells = d_cells(spark, LEAVES)
    assert [r.pct for r in scores.accuracy(scores.against_golden(cells, cells)).collect()] == [100.0, 100.0]
    off = cells.withColumn("value", F.when(F.col("sl_no") == 1, 5000.0).otherwise(F.col("value")))
    assert scores.against_golden(off, cells).where("not ok").count() == 1
    tries = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.9), (1, 3, 0.9)], "doc_id int, attempt int, rate double")
    assert scores.best_attempt(tries).first().attempt == 2


def test_defects_keep_the_first_group(spark):
    kind = "block string, sl_no int, field string, m string"
    a, b = spark.createDataFrame([("D", 1, "x", "a")], kind), spark.createDataFrame([("D", 1, "x", "b"), ("D", 2, "x", "b")], kind)
    out = merges.union_distinct_on([a, b], ["block", "sl_no", "field"], ["m"])
    assert {(r.sl_no, r.m) for r in out.collect()} == {(1, "a"), (2, "b")}


def test_boxes_become_rows(spark):
    boxes = [(1, 1, 500, y, x, 0.9, t) for y, x, t in ((10.0, 5.0, "b"), (11.0, 1.0, "a"), (30.0, 1.0, "c"), (31.0, 9.0, "d"), (50.0, 1.0, "e"))] + [(1, 1, 500, 12.0, 7.0, 0.2, "noise")]
    out = spatial.boxes_to_text(spark.createDataFrame(boxes, "doc_id int, page_no int, page_height int, y double, x double, conf double, text string"))
    assert out.first().text == "a\tb\nc\td\ne"


def test_grid_lines_and_overlaps(spark):
    df = spark.createDataFrame([([0.0, 9.0, 9.0, 0.0, 0.0, 9.0, 0.0],)], "p array<double>")
    assert df.select(spatial.runs_to_positions(F.col("p"))).first()[0] == [1, 5]
    cells = spark.createDataFrame([(1, 1, "c1", [0.0, 0.0, 10.0, 10.0]), (1, 1, "c2", [10.0, 0.0, 20.0, 10.0])], "doc_id int, page_no int, cell_id string, bbox array<double>")
    lines = spark.createDataFrame([(1, 1, 1, [1.0, 1.0, 12.0, 3.0], "wide"), (1, 1, 2, [2.0, 5.0, 4.0, 6.0], "small"), (1, 2, 3, [0.0, 0.0, 9.0, 9.0], "other")], "doc_id int, page_no int, line_id int, bbox array<double>, text string")
    pairs = spatial.overlapping(cells, lines, 3.0)
    assert {(r.cell_id, r.line_id, r.area) for r in pairs.collect()} == {("c1", 1, 18.0), ("c2", 1, 4.0), ("c1", 2, 2.0)}
    assert {(r.cell_id, r.text) for r in spatial.cell_texts(pairs).collect()} == {("c1", "wide small"), ("c2", "wide")}


def test_fuzzy_scores_and_headers(spark):
    assert fuzzy.token_set("raw materials", "materials raw and more") == 100 and fuzzy.token_set("abc", "xyz") < 20
    assert fuzzy.partial("net block", "the net block of it") == 100
    aliases = spark.createDataFrame([("opening", "opening balance", 0), ("closing", "closing balance", 1)], "canonical string, alias string, ordinal int")
    cells = spark.createDataFrame([(1, 0, "Opening Balance"), (1, 1, "???")], "table_id int, col int, header string")
    assert {(r.col, r.field, r.confidence) for r in fuzzy.map_headers(cells, aliases).collect()} == {(0, "opening", 100.0), (1, "closing", 55.0)}
    tables = spark.createDataFrame([(1, "gross block and net block of assets", 8), (2, "sundry debtors list", 3), (3, "gross block", 3)], "table_id int, text string, n_cols int")
    signals = spark.createDataFrame([("C", "gross block"), ("D", "sundry debtors")], "block string, phrase string")
    assert {r.table_id: r.block for r in fuzzy.classify_tables(tables, signals).collect()} == {1: "C", 2: "D", 3: "unknown"}
    grid = spark.createDataFrame([([["1", "2"], ["Item", "Amount"], ["x", "3"]], ["a", "(1,000)"])], "g array<array<string>>, row array<string>")
    cols = F.array(F.struct(F.lit("v").alias("field"), F.lit(1).alias("col")), F.struct(F.lit("w").alias("field"), F.lit(7).alias("col")))
    r = grid.select(fuzzy.header_row(F.col("g")).alias("h"), fuzzy.row_values(F.col("row"), cols).alias("v"), spatial.clean_grid(F.col("g")).alias("g")).first()
    assert r.h == 1 and r.v == {"v": -1000.0} and len(r.g) == 3


def test_page_tags(spark):
    texts = ["Auditor says Schedule 5", "Balance Sheet as at X. Total assets", "Balance sheet as at; note 4; net block", "land building vehicle 12,34,567", "schedule 8 sundry creditor", None, "land building vehicle"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    got = [r.t for r in df.select("k", pages.page_tags(F.col("text")).alias("t")).orderBy("k").collect()]
    assert got == [["skip"], ["summary"], ["block_c"], ["block_c"], ["block_d"], [], []]


def test_pages_to_cells(spark):
    text = "SCHEDULE 7 TRADE RECEIVABLES\nMore than six months 12,00,000 9,50,000\nLess than six months 3,00,000 4,50,000\nSCHEDULE 3 SECURED LOANS\nCash Credit from Bank 25,00,000 20,00,000\nFrom Others 40,00,000 35,00,000"
    out = statement.extract_cells(spark.createDataFrame([(1, 1, text)], "doc_id bigint, page_no int, text string"))
    assert {(r.sl_no, r.field): r.value for r in out.collect()} == {(9, "opening_rs"): 1400000, (9, "closing_rs"): 1500000, (13, "opening_rs"): 2000000, (13, "closing_rs"): 2500000, (17, "opening_rs"): 3500000, (17, "closing_rs"): 4000000}


def test_units_do_not_change_cells(spark):
    rupees = "Finished goods 12,34,500 5,00,000"
    lakhs = "Amounts in Lacs\nFinished goods 12.345 5.00"
    out = statement.extract_cells(spark.createDataFrame([(1, 1, rupees), (2, 1, lakhs)], "doc_id bigint, page_no int, text string"))
    got = {(r.doc_id, r.field): r.value for r in out.collect()}
    assert got[1, "closing_rs"] == got[2, "closing_rs"] == 1234500 and got[1, "opening_rs"] == got[2, "opening_rs"] == 500000


def test_supervisor_settles(spark):
    cells = merges.to_cells(merges.template_merge(merges.to_rows(d_cells(spark, LEAVES), "D"), "D"), "D")
    candidates = d_cells(spark, {17: 500, 9: 90000, 16: 1})
    done, pending, rounds = statement.supervise(cells, candidates)
    got = {(r.sl_no, r.field): r.value for r in done.collect()}
    assert got[17, "opening_rs"] == 500 and got[9, "opening_rs"] == 25 and got[16, "opening_rs"] == 145 and rounds <= 5
    assert {(r.sl_no, r.reason) for r in pending.where("field = 'opening_rs'").collect()} == {(9, "bs_mismatch"), (16, "bs_mismatch")}


def test_reconcile_runs_to_consistent_rows(spark):
    c = spark.createDataFrame([c_row(sl_no=k, net_opening=100.0 * k, net_closing=110.0 * k, dep_up_to_beginning=10.0, dep_provided_during_year=5.0) for k in range(2, 8)])
    face = spark.createDataFrame([(1, 2754.0, 2970.0)], "doc_id bigint, opening double, closing double")
    rows, cells = statement.reconcile(c, d_cells(spark, LEAVES), face)
    got = {r.sl_no: r for r in rows.collect()}
    assert sum(got[k].net_opening for k in range(2, 8)) == 2754 and got[8].net_opening == pytest.approx(2754) and got[10].net_closing == pytest.approx(got[8].net_closing)
    assert as_dict(cells)[16] == 145


def test_golden_amounts_are_met_within_a_share_of_them(spark, tmp_path):
    from tallyforge.plans import catalog_forms

    spark.createDataFrame([(6000,), (6006,), (6126,)], "doc_id bigint").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog_forms.golden_from_json(spark, str(tmp_path)).where("field = 'opening_rs'")
    assert {(r.doc_id, r.got, r.ok) for r in got.collect()} == {(6000, 306000.0, True), (6006, 306006.0, False), (6126, 306126.0, False)}


def test_imputation_sorts_rows_once(spark):
    """Sums and picks were joined back, each with sorts of its own in the same task."""
    rows = spark.range(10).selectExpr("id % 3 AS doc_id", "id AS sl_no", "id * 1e6 AS v", "9e8 AS sub")
    plan = derive.impute_from_subtotal(rows, "v", "sub", "sl_no")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort ") == 1 and "Join" not in plan


def test_derived_parts_are_made_after_cells_are_dealt_out(spark):
    """Cells went through the exchange with their parts in derived rows, some four times as many rows."""
    plan = derive.recompute(d_cells(spark, LEAVES))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.index("Generate ") < plan.index("Exchange ")
