"""Similarity joins, formulas, pictures, attempts, SQL functions and assembled pages against plain Python."""

import random
from collections import Counter
from itertools import combinations, product

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import numbers
from tallyforge.functions import sql as S
from tallyforge.operators import formulas, merges, raster, similar
from tallyforge.plans import attempts, schema
from tallyforge.session import shared_path
from tallyforge.streaming import assemble, ingest


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_similar_pairs_lose_nothing(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 14))) for _ in range(120)]
    near = [w[: k % (len(w) + 1)] + rng.choice("abcz") + w[k % (len(w) + 1) :] for k, w in enumerate(words[:80])]
    left = spark.createDataFrame([(w,) for w in [*near, None, "", "  ", "AAA  bbb"]], "t string")
    right = spark.createDataFrame([(w,) for w in [*words, None, "", "aaa bbb"]], "t string")
    got = {(r.left_text, r.right_text) for r in similar.similar_pairs(left, right, 0.75).collect()}
    want = {(a, b) for a in {*near, "aaa bbb"} for b in {*words, "aaa bbb"} if 1 - edits(a, b) / max(len(a), len(b)) >= 0.75 - 1e-9}
    assert got == want
    with pytest.raises(ValueError, match="exceed"):
        similar.similar_pairs(left, right, 0.5)


def test_few_candidates_and_no_python(spark):
    rng = random.Random(2)
    names = [" ".join(rng.choice(["steel", "brass", "copper", "nickel", "tin", "large", "small", "polished", "plated", "burnished"]) + str(rng.randrange(100)) for _ in range(3)) for _ in range(800)]
    left, right = (spark.createDataFrame([(n[::s],) for n in names], "t string") for s in (1, 1))
    plan = similar.similar_pairs(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert similar.similar_pairs(left, right, 0.99).count() == len(set(names))


def brute_formula(parts, o, c, most):
    near = lambda want, got: abs(want - got) <= 1e-6 * max(abs(want), 1)
    keys = sorted(parts)
    for n in range(1, most + 1):
        for combo in combinations(keys, n):
            for signs in product((-1, 1), repeat=n):
                if near(o, sum(s * parts[k][0] for s, k in zip(signs, combo, strict=True))) and near(c, sum(s * parts[k][1] for s, k in zip(signs, combo, strict=True))):
                    return "".join(("+" if s > 0 else "-") + k for s, k in zip(signs, combo, strict=True)), n
    return None


def test_formulas_match_all_combinations(spark):
    rng = random.Random(3)
    parts, goals, want = [], [], {}
    for doc in range(12):
        own = {f"k{j}": (float(rng.randrange(-3, 60)), float(rng.randrange(-3, 60))) for j in range(6)}
        parts += [(doc, k, *v) for k, v in own.items()]
        for sl in range(3):
            chosen = rng.sample(sorted(own), rng.randrange(1, 6))
            o, c = (sum(own[k][x] * (1 if k < "k3" else -1) for k in chosen) for x in (0, 1))
            o += 1e6 * (sl == 2 and doc % 3 == 0)
            goals.append((doc, sl, o, c))
            if found := brute_formula(own, o, c, 5):
                want[doc, sl] = found
    got = formulas.search(spark.createDataFrame(parts, "doc_id int, key string, opening double, closing double"), spark.createDataFrame(goals, "doc_id int, sl_no int, opening double, closing double"), 1e-6)
    assert {(r.doc_id, r.sl_no): (r.formula, r.terms) for r in got.collect()} == want


def test_five_terms_of_twenty(spark):
    rng = random.Random(4)
    own = {f"k{j:02d}": (float(rng.randrange(10**6, 10**8)), float(rng.randrange(10**6, 10**8))) for j in range(20)}
    terms = (("k01", 1), ("k05", -1), ("k08", 1), ("k13", 1), ("k19", -1))
    goal = [(1, 7, *(sum(s * own[k][x] for k, s in terms) for x in (0, 1))), (1, 8, 1.0, 1.0)]
    got = formulas.search(spark.createDataFrame([(1, k, *v) for k, v in own.items()], "doc_id int, key string, opening double, closing double"), spark.createDataFrame(goal, "doc_id int, sl_no int, opening double, closing double"), 1e-9)
    assert [(r.sl_no, r.formula, r.terms) for r in got.collect()] == [(7, "+k01-k05+k08+k13-k19", 5)]


def otsu(levels):
    h = Counter(levels)
    n, s, best = len(levels), sum(levels), None
    for t in sorted(h):
        w = sum(h[v] for v in h if v <= t)
        if w < n:
            m0, m1 = sum(v * h[v] for v in h if v <= t) / w, sum(v * h[v] for v in h if v > t) / (n - w)
            b = w * (n - w) * (m0 - m1) ** 2
            if best is None or b > best[0] * (1 + 1e-12):
                best = (b, t)
    return best[1] if best else s // n


def test_otsu_matches_class_means(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([30, 40, 200, 220]) + rng.randrange(12) for _ in range(50)]) for i in range(8) for _ in range(3)] + [(9, [7, 7, 7]), (10, [0, 255]), (11, None), (12, [])]
    got = {r.image: r.threshold for r in raster.otsu_threshold(spark.createDataFrame(rows, "image int, levels array<int>")).collect()}
    want = {i: otsu([v for k, vs in rows if k == i for v in vs]) for i in [*range(8), 9, 10]}
    assert got == want


def test_ruled_lines_of_a_drawn_grid(spark):
    dark = lambda y, x: y in (5, 6, 20) and 2 <= x < 58 or x in (10, 40) and 3 <= y < 38 or (y == 30 and x % 3 == 0) or y == 39 or x == 59
    rows = [(1, y, [bool(dark(y, x)) for x in range(60)]) for y in range(40)] + [(2, y, [False] * 9) for y in range(3)] + [(3, 0, None)]
    out = {r.image: (r.ys, r.xs) for r in raster.ruled_lines(spark.createDataFrame(rows, "image int, y int, mask array<boolean>")).collect()}
    assert out == {1: ([6, 20], [10, 40]), 2: ([], [])}  # lines at the very end aren't closed


def test_text_columns_by_gutters(spark):
    boxes = [(1, 1, 0.0, 10.0, "a"), (1, 1, 10.0, 20.0, "b"), (1, 1, 30.0, 40.0, "c"), (1, 1, 32.0, 35.0, "d"), (1, 1, 50.0, 50.0, "e"), (1, 1, None, 3.0, "f"), (2, 1, 5.0, 1.0, "g"), (1, 1, 41.0, 42.0, "h")]
    out = raster.text_columns(spark.createDataFrame(boxes, "doc_id int, page_no int, x1 double, x2 double, t string"), least_gap=2.0)
    assert {r.t: (r.col, r.col_left, r.col_right) for r in out.collect()} == {"a": (0, 0, 20), "b": (0, 0, 20), "c": (1, 30, 42), "d": (1, 30, 42), "h": (1, 30, 42), "e": (2, 50, 50), "g": (0, 1, 5)}


def test_attempts_end_early_and_restore_the_best(spark):
    leaves = [k for k in range(1, 18) if k not in schema.DERIVED["D"]]
    cell = lambda doc, sl, v: [(doc, "D", sl, f, v) for f in schema.D_FIELDS]
    first = [c for doc in (1, 2, 3) for sl in leaves for c in cell(doc, sl, None if doc > 1 and sl == 9 else 100000.0 + sl)]
    cells = merges.patch_cells(schema.empty_cells(spark, spark.range(1, 4).withColumnRenamed("id", "doc_id")), spark.createDataFrame([c for c in first if c[4] is not None], schema.CELLS))
    second = spark.createDataFrame([*cell(2, 9, 5.0), *cell(3, 10, -7.0), *cell(1, 9, 1.0)], schema.CELLS)
    done, log = attempts.run_attempts(cells, [second], most=3)
    rows = {(r.doc_id, r.attempt): (r.passed, r.kept) for r in log.collect()}
    assert rows == {(1, 1): (True, True), (2, 1): (False, False), (2, 2): (True, True), (3, 1): (False, True), (3, 2): (False, False)}
    at = {(r.doc_id, r.sl_no): r.value for r in done.where("field = 'opening_rs'").collect()}
    assert at[1, 9] == 100009.0 and at[2, 9] == 5.0 and at[3, 10] == 100010.0 and done.count() == cells.count()


def test_sql_functions_are_those_of_columns(spark):
    S.register_functions(spark, "tf_")
    values = ["1,23,456", "12,34,567.50", "(1,234)", "-5,000", "NIL", "-", "", None, "1234.5", "abc", "--", " 7 ", "1,2345", "1.2.3"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    for name, f in (("indian_parse", numbers.indian_parse), ("clean_number", numbers.clean_number), ("signed_amount", numbers.signed_amount), ("parse_number", numbers.parse_number), ("line_tokens", numbers.line_tokens), ("unit_of", numbers.unit_of)):
        got = spark.sql(f"SELECT tf_{name}(x) AS a FROM {{df}}", df=df)
        assert [r[0] for r in got.collect()] == [r[0] for r in df.select(f(F.col("x"))).collect()], name
    plan = spark.sql("SELECT t.* FROM {df} d, LATERAL tf_page_candidates(d.x, 'cash') t", df=df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Exchange" not in plan


def test_pages_go_on_after_a_restart(spark):
    kind = "doc_id bigint, page_no int, n_pages int, text string, ts timestamp"
    inbox, out, state = (shared_path(spark, x) for x in ("inbox", "out", "state"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", assemble.ROCKSDB)
    at = lambda s: f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}"
    rounds = [
        [(1, 2, 2, "b", at(1)), (2, 1, 3, "x", at(2)), (3, 1, 1, None, at(3)), (None, 1, 1, "n", at(3)), (4, 9, 2, "beyond", at(4))],
        [(1, 2, 2, "late copy", at(5)), (1, 1, 2, "a", at(5)), (2, 3, 3, "z", at(6)), (3, 1, 1, "again", at(6))],
        [(-1, 1, 2, "", at(3000))],
        [(2, 2, 3, "too late", at(7))],
    ]
    try:
        for rows in rounds:
            spark.createDataFrame([(*r[:4], r[4]) for r in rows], kind.replace("timestamp", "string")).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(inbox)
            ingest.write_available(assemble.assembled(spark.readStream.schema(kind).parquet(inbox), wait=60, late="10 seconds"), out, state).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = sorted(tuple(r) for r in spark.read.schema(assemble.OUT).parquet(out).collect())
    assert got == [(1, 2, 2, True, "a\nb"), (2, 3, 2, False, "x\nz"), (3, 1, 1, True, ""), (4, 2, 0, False, "")]


def test_halves_are_never_broadcast(spark):
    from tallyforge.operators import formulas

    parts = spark.createDataFrame([(1, [("a", 1.0, 2.0), ("b", 3.0, 4.0)])], "doc_id bigint, parts array<struct<key:string,opening:double,closing:double>>")
    goals = spark.createDataFrame([(1, 1, 4.0, 6.0)], "doc_id bigint, sl_no int, opening double, closing double")
    found = formulas._met(parts, goals, 0.02, range(1, 4))
    joins = [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in x and "cell" in x]
    assert joins and not any("Broadcast" in x for x in joins)
    assert [tuple(r) for r in found.collect()] == [(1, 1, "+a+b", 2)]
