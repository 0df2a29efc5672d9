"""Queries of searches and pictures, over whole tables with near misses and ties; the SQL compares all with all."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import formulas, raster, similar
from ..session import table
from .catalog import query

# --- similarity

_TYPO = """CASE doc_id % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN substr(p_name, 1, 3) || substr(p_name, 5)
  WHEN 2 THEN substr(p_name, 1, 2) || 'x' || substr(p_name, 4) || 'y' ELSE substr(p_name, 1, 4) || 'zzqqj' END"""


@query(
    "similar_top1",
    f"""WITH l AS (SELECT doc_id, {_TYPO} AS label FROM documents JOIN part ON p_partkey = doc_id * 31 % (SELECT max(p_partkey) FROM part) + 1),
names AS (SELECT p_name AS canonical, min(p_partkey) AS ordinal FROM part GROUP BY p_name),
d AS (SELECT DISTINCT lower(label) AS t FROM l),
s AS (SELECT t, canonical, 1 - levenshtein(t, lower(canonical)) / CAST(greatest(length(t), length(canonical)) AS DOUBLE) AS likeness, ordinal FROM d, names),
b AS (SELECT t, arg_min(canonical, (-likeness, ordinal)) AS canonical, max(likeness) AS likeness FROM s WHERE likeness >= 0.8 - 1e-9 GROUP BY t)
SELECT l.doc_id, l.label, b.canonical, round(b.likeness, 9) AS likeness FROM l LEFT JOIN b ON lower(l.label) = b.t""",
)
def similar_top1(spark, sf):
    """A misspelt part name for each document, found again among all names where it is like enough."""
    part = table(spark, sf, "part")
    most = part.agg(F.max("p_partkey")).first()[0]
    docs = table(spark, sf, "documents").select("doc_id", (F.expr(f"doc_id * 31 % {most} + 1")).alias("p_partkey"))
    labels = docs.join(part.select("p_partkey", "p_name"), "p_partkey").select("doc_id", F.expr(_TYPO).alias("label"))
    names = part.groupBy(F.col("p_name").alias("canonical")).agg(F.min("p_partkey").alias("ordinal")).withColumn("alias", F.col("canonical"))
    return similar.best_similar(labels, names).withColumn("likeness", F.round("likeness", 9))


# --- formulas over the components of a vector: ten of them, the tenth as large as the second

_PLANTED = {0: (("+", 1), ("-", 3), ("+", 5), ("-", 6), ("-", 9)), 1: (("-", 2), ("+", 4), ("+", 7)), 2: (("+", 2),), 3: (("+", 1), ("+", 3), ("+", 4), ("+", 8))}


def _amount(k: int, side: int) -> str:
    return f"round(CAST(embedding[{{base}} + {(2 if k == 10 else k) + 12 * side}] AS DOUBLE) * 1000000)"


def _target(side: int, base: int) -> str:
    terms = lambda ts: " ".join(f"{m} {_amount(k, side).format(base=base)}" for m, k in ts)
    return "CASE vec_id % 5 " + " ".join(f"WHEN {r} THEN {terms(ts)}" for r, ts in _PLANTED.items()) + f" ELSE {[terms(_PLANTED[0]), 98765432][side]} END"


@query(
    "formula_search",
    "SELECT vec_id AS doc_id, CAST(1 AS INT) AS sl_no, CASE vec_id % 5 " + " ".join(f"WHEN {r} THEN '{''.join(f'{m}k{k:02d}' for m, k in ts)}'" for r, ts in _PLANTED.items()) + " END AS formula, CAST(CASE vec_id % 5 " + " ".join(f"WHEN {r} THEN {len(ts)}" for r, ts in _PLANTED.items()) + " END AS INT) AS terms FROM embeddings WHERE vec_id % 5 < 4"
    + " UNION ALL SELECT vec_id, CAST(2 AS INT), '+k01+k02', CAST(2 AS INT) FROM embeddings",
)
def formula_search(spark, sf):
    """Formulas of one to five terms, some among equal components, others not to be found; a target that only one column meets."""
    vectors = table(spark, sf, "embeddings").where("embedding is not null and size(embedding) >= 24")
    amounts = F.array(*[F.struct(F.lit(f"k{k:02d}").alias("key"), F.expr(_amount(k, 0).format(base=-1)).alias("opening"), F.expr(_amount(k, 1).format(base=-1)).alias("closing")) for k in range(1, 11)])
    parts = vectors.select(F.col("vec_id").alias("doc_id"), F.inline(amounts))
    two = lambda side: " + ".join(_amount(k, side).format(base=-1) for k in (1, 2))
    goals = F.array(
        F.struct(F.lit(1).alias("sl_no"), F.expr(_target(0, -1)).alias("opening"), F.expr(_target(1, -1)).alias("closing")),
        F.struct(F.lit(2).alias("sl_no"), F.expr(two(0)).alias("opening"), F.expr(two(1)).alias("closing")),
    )
    return formulas.search(parts, vectors.select(F.col("vec_id").alias("doc_id"), F.inline(goals)), tol=1e-6)


# --- pictures: 32 vectors are one, a vector is a row of pixels

_GREY = "CAST(greatest(0, least(255, floor((x + 0.5) * 255))) AS INT)"


@query(
    "otsu_thresholds",
    f"""WITH p AS (SELECT vec_id // 32 AS image, unnest(embedding) AS x FROM embeddings),
h AS (SELECT image, {_GREY} AS v, count(*) AS n FROM p WHERE x IS NOT NULL GROUP BY ALL),
c AS (SELECT image, v, sum(n) OVER (PARTITION BY image ORDER BY v) AS w0, sum(n * v) OVER (PARTITION BY image ORDER BY v) AS s0, sum(n) OVER (PARTITION BY image) AS w, sum(n * v) OVER (PARTITION BY image) AS s FROM h),
b AS (SELECT image, v, CASE WHEN w = w0 THEN 0 ELSE CAST(s0 * w - s * w0 AS DOUBLE) * CAST(s0 * w - s * w0 AS DOUBLE) / (CAST(w0 AS DOUBLE) * (w - w0)) END AS b FROM c)
SELECT image, CAST(arg_min(v, (-b, v)) AS INT) AS threshold FROM b GROUP BY image""",
)
def otsu_thresholds(spark, sf):
    """The threshold of each picture by its histogram."""
    rows = table(spark, sf, "embeddings").select(F.expr("vec_id div 32").alias("image"), F.expr(f"transform(embedding, x -> {_GREY})").alias("levels"))
    return raster.otsu_threshold(rows)


# dark where a vector's component is large, and on lines: rows 4, 5 and 20 (gaps in row 20 of some), columns 7, 8, 31 and 50, of which some are too short
_DARK = """(x > 0.2 OR (y IN (4, 5) AND i BETWEEN 3 AND 60) OR (y = 20 AND (image % 3 > 0 OR i % 4 > 0)) OR (i IN (7, 8) AND y BETWEEN 2 AND 29)
  OR (i = 31 AND (image % 2 = 0 OR y < 7)) OR (i = 50 AND y > 3 AND y <> 15))"""
_PIXELS = f"""SELECT image, y, i, {_DARK} AS dark FROM (
  SELECT vec_id // 32 AS image, CAST(vec_id % 32 AS INT) AS y, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS i, unnest(embedding) AS x FROM embeddings)"""


_LINES_SQL = f"""WITH px AS (SELECT *, max(y) OVER (PARTITION BY image) + 1 AS size_y, max(i) OVER (PARTITION BY image) + 1 AS size_i FROM ({_PIXELS})),
dark AS (SELECT *, i - row_number() OVER (PARTITION BY image, y ORDER BY i) AS gi, y - row_number() OVER (PARTITION BY image, i ORDER BY y) AS gy FROM px WHERE dark),
flat AS (SELECT image, y AS p, size_y AS size, sum(n) AS cover, any_value(size_i) AS o FROM (SELECT image, y, gi, count(*) AS n, any_value(size_y) AS size_y, any_value(size_i) AS size_i FROM dark GROUP BY image, y, gi HAVING count(*) >= 8) GROUP BY image, y, size_y HAVING sum(n) > 0.3 * any_value(size_i)),
upright AS (SELECT image, i AS p, size_i AS size, sum(n) AS cover, any_value(size_y) AS o FROM (SELECT image, i, gy, count(*) AS n, any_value(size_y) AS size_y, any_value(size_i) AS size_i FROM dark GROUP BY image, i, gy HAVING count(*) >= 8) GROUP BY image, i, size_i HAVING sum(n) > 0.3 * any_value(size_y)),
ys AS (SELECT image, CAST(floor(min(p) + count(*) / 2.0) AS INT) AS pos FROM (SELECT *, p - row_number() OVER (PARTITION BY image ORDER BY p) AS g FROM flat) GROUP BY image, g, size HAVING max(p) + 1 < size),
xs AS (SELECT image, CAST(floor(min(p) + count(*) / 2.0) AS INT) AS pos FROM (SELECT *, p - row_number() OVER (PARTITION BY image ORDER BY p) AS g FROM upright) GROUP BY image, g, size HAVING max(p) + 1 < size),
rows_ AS (SELECT image, (row_number() OVER w) - 1 AS k, pos AS a, lead(pos) OVER w AS b FROM ys WINDOW w AS (PARTITION BY image ORDER BY pos)),
cols_ AS (SELECT image, (row_number() OVER w) - 1 AS k, pos AS a, lead(pos) OVER w AS b FROM xs WINDOW w AS (PARTITION BY image ORDER BY pos))
SELECT r.image, CAST(r.k AS INT) AS row, CAST(c.k AS INT) AS col, r.a AS y1, r.b AS y2, c.a AS x1, c.b AS x2 FROM rows_ r JOIN cols_ c ON r.image = c.image WHERE r.b IS NOT NULL AND c.b IS NOT NULL"""


@query("ruled_cells", _LINES_SQL)
def ruled_cells(spark, sf):
    """Cells between the ruled lines of pictures: thick, broken and short lines among dark noise."""
    v = table(spark, sf, "embeddings").select(F.expr("vec_id div 32").alias("image"), F.expr("cast(vec_id % 32 as int)").alias("y"), "embedding")
    return raster.ruled_cells(raster.ruled_lines(v.select("image", "y", F.expr(f"transform(embedding, (x, i) -> {_DARK})").alias("mask"))))


_TEXT_BOX = """SELECT vec_id AS box_id, vec_id // 40 AS doc_id, CAST(vec_id // 8 % 5 AS INT) AS page_no,
  CAST(round(embedding[{0}] * 200) AS DOUBLE) + 100 * CAST(vec_id % 3 AS DOUBLE) AS x1,
  CAST(round(embedding[{0}] * 200) AS DOUBLE) + 100 * CAST(vec_id % 3 AS DOUBLE) + CASE WHEN embedding[{1}] > 0.2 THEN 120 WHEN embedding[{1}] < -0.25 THEN 0 ELSE 30 END AS x2 FROM embeddings"""


@query(
    "text_columns",
    f"""WITH b AS ({_TEXT_BOX.format(1, 2)}),
o AS (SELECT *, max(x2) OVER (PARTITION BY doc_id, page_no ORDER BY x1, x2, box_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM b),
g AS (SELECT *, sum(CASE WHEN before + 5 < x1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_no ORDER BY x1, x2, box_id) AS col FROM o)
SELECT box_id, CAST(col AS INT) AS col, min(x1) OVER w AS col_left, max(x2) OVER w AS col_right FROM g WINDOW w AS (PARTITION BY doc_id, page_no, col)""",
)
def text_columns(spark, sf):
    """Table columns of boxes by the gutters between them: touching, nested, wide and empty boxes."""
    sql = _TEXT_BOX.format(0, 1).replace("vec_id // 8 % 5", "vec_id div 8 % 5").replace("vec_id // 40", "vec_id div 40").replace("FROM embeddings", "FROM {v}")
    boxes = spark.sql(sql, v=table(spark, sf, "embeddings"))
    return raster.text_columns(boxes, least_gap=5.0).select("box_id", "col", "col_left", "col_right")


# --- the functions of SQL


@query(
    "sql_functions",
    """WITH n AS (SELECT doc_id, coalesce(text, '') AS text, doc_id * 7919 % 900000 + 100000 AS a, doc_id * 104729 % 900000 + 100000 AS b FROM documents)
SELECT doc_id, CAST(0 AS INT) AS line_no, CAST(a AS DOUBLE) AS closing, CAST(b AS DOUBLE) AS opening, CAST(-a AS DOUBLE) AS signed, CASE WHEN doc_id % 2 = 0 THEN 'lakhs' ELSE 'rupees' END AS unit,
       len(list_filter(regexp_extract_all(text, '[0-9,.]+'), lambda x: regexp_matches(x, '[0-9]'))) AS tokens FROM n
UNION ALL SELECT doc_id, CAST(len(string_split(text, chr(10))) + 3 AS INT), CAST(b AS DOUBLE), CAST(a AS DOUBLE), CAST(-a AS DOUBLE), CASE WHEN doc_id % 2 = 0 THEN 'lakhs' ELSE 'rupees' END,
       len(list_filter(regexp_extract_all(text, '[0-9,.]+'), lambda x: regexp_matches(x, '[0-9]'))) FROM n""",
)
def sql_functions(spark, sf):
    """Pages by SQL alone: candidates of a label, units, signed amounts and tokens by the registered functions."""
    from ..functions.sql import register_functions

    register_functions(spark, "tallyforge_")
    docs = table(spark, sf, "documents").selectExpr("doc_id", "coalesce(text, '') AS text", "cast(doc_id * 7919 % 900000 + 100000 AS double) AS a", "cast(doc_id * 104729 % 900000 + 100000 AS double) AS b")
    return spark.sql(
        """WITH p AS (SELECT doc_id, text, '(' || tallyforge_indian_format(a) || ')' AS negative, CASE WHEN doc_id % 2 = 0 THEN 'Amounts in Lacs' ELSE 'Rs.' END AS head,
                 concat_ws('\n', 'Sundry Creditors ' || tallyforge_indian_format(a) || ' 12 ' || tallyforge_indian_format(b), text, 'sundry creditors 17', 'creditors 5,000 6,000', 'of sundry creditors 1 ' || tallyforge_indian_format(b) || ' 2.5 ' || tallyforge_indian_format(a)) AS page FROM {docs})
           SELECT doc_id, t.line_no, t.closing, t.opening, tallyforge_signed_amount(negative) AS signed, tallyforge_unit_of(head) AS unit, cast(size(tallyforge_line_tokens(text)) AS bigint) AS tokens
           FROM p, LATERAL tallyforge_page_candidates(p.page, 'sundry creditors') t""",
        docs=docs,
    )
