"""Queries of notes, faces and layout over whole ``documents``: what is to be found stands among the lines of the real texts,
with near misses, ties and second readings; the SQL works from the numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import faces, notes, schedules
from ..session import table
from .catalog import query

#: Numbers from 0 to 8999 for each document, and one from 0 to 5.
NUMBERS = """SELECT doc_id, doc_id * 7919 % 9000 AS a, doc_id * 104729 % 9000 AS b, doc_id * 1299709 % 9000 AS c, doc_id % 6 AS k FROM documents"""
N = f"WITH n AS ({NUMBERS})"


def lac(x: str) -> Column:
    """Hundredths of a lakh (SQL) as statements write them."""
    return F.format_number(F.expr(x) / 100.0, 2)


def row(*parts) -> Column:
    """A line of texts and columns joined by spaces."""
    return F.concat_ws(" ", *[F.lit(x) if isinstance(x, str) else x for x in parts])


def noisy(spark: SparkSession, sf: str, *lines, amid: int = 1) -> DataFrame:
    """One page a document: these lines (null: none) with the document's whole text after the line ``amid``."""
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("noise"))
    n = docs.withColumns({x: F.expr(f"doc_id * {m} % 9000") for x, m in (("a", 7919), ("b", 104729), ("c", 1299709))}).withColumn("k", F.expr("doc_id % 6"))
    parts = [F.lit(x) if isinstance(x, str) else x for x in lines]
    return n.select("doc_id", F.lit(1).alias("page_no"), F.concat_ws("\n", *parts[:amid], "noise", *parts[amid:]).alias("text"))


# --- the asset note: (row, order) -> net closing, net opening, charge, gross closing, gross opening, addition, deduction

_ASSETS = (
    (1, "10000 + a", "10000 + b", "0", "0", "0", "0", "0"),
    (2, "20000 + a", "19000 + a - b % 1000", "1000 + b % 1000", "60000 + a", "52000 + b % 8000", "3000 + c % 5000", "600 + c % 300"),
    (3, "30000 + b", "28000 + c % 1000", "1200 + a % 800", "80000 + c", "70000 + a", "0", "0"),
    (4, "5000 + c % 3000", "4000 + a % 900", "0", "0", "0", "0", "0"),
    (5, "3000 + a % 900", "2500 + a % 900", "500", "0", "0", "0", "0"),
    (5, "2000 + b % 900", "1900 + c % 900", "0", "0", "0", "0", "0"),
    (7, "7000 + a % 500", "6500 + b % 400", "1500 + c % 100", "12000 + a % 1000", "0", "12000 + a % 1000", "0"),
)
_TC, _TO = "1234567 + a", "1122333 + b"  # totals of the note


def _aligned(src: str) -> str:
    """SQL: additions, deductions and depreciation of rows that agree with their closing values."""
    return f"""
SELECT * REPLACE (CASE WHEN begin > 0 OR charge > 0 THEN greatest(0, begin + charge) ELSE fin END AS fin) FROM (
  SELECT * REPLACE (CASE WHEN gc > 0 AND go > 0 AND (added = 0 OR abs(added - greatest(0, gc - go - ded)) > greatest(greatest(0, gc - go - ded) * 0.5, 50)) THEN greatest(0, gc - go - ded) ELSE added END AS added) FROM (
    SELECT * REPLACE (CASE WHEN gc > 0 AND go > 0 AND gc < go AND ded = 0 THEN go - gc ELSE ded END AS ded, CASE WHEN gc > 0 AND go > 0 AND gc < go AND ded = 0 THEN 0 ELSE added END AS added) FROM {src}))"""


def _imputed(src: str, field: str, other: str, subtotal: str) -> str:
    """SQL: the row that a sub-total of documents with k < 2 contradicts takes what the others leave."""
    move = "gc - x.implied" if field == "go" else "x.implied - go"
    more = "true" if field == "go" else "go > 0"
    return f"""
SELECT {src}.* EXCLUDE ({field}, added), CASE WHEN {src}.sl = x.sl THEN x.implied ELSE {field} END AS {field},
       CASE WHEN {src}.sl = x.sl AND added = 0 AND {more} AND {move} > 0 THEN {move} - ded ELSE added END AS added, {src}.sl = x.sl AS hit
FROM {src} LEFT JOIN (
  SELECT doc_id, max_by(sl, (v, sl)) AS sl, max_by(implied, (v, sl)) AS implied FROM (
    SELECT doc_id, sl, {field} AS v, ({subtotal}) - (sum({field}) OVER (PARTITION BY doc_id) - {field}) AS implied FROM {src} WHERE sl IN (2, 3, 4, 5, 7) AND k < 2)
  WHERE implied > 0 AND abs(v - implied) / implied > 0.02 GROUP BY doc_id) x USING (doc_id)"""


_RAW = " UNION ALL ".join(f"SELECT *, {sl} AS sl, {nc} AS nc, {no} AS no, {ch} AS charge, {gc} AS gc, {go} AS go, {ad} AS added, {de} AS ded FROM n" for sl, nc, no, ch, gc, go, ad, de in _ASSETS)
_SUM = "sum({0}) AS {0}".format
SQL_NOTE = f"""{N},
raw AS ({_RAW}),
dep AS (SELECT *, CASE WHEN go > 0 AND no > 0 THEN greatest(0, go - no) ELSE 0 END AS begin, CASE WHEN gc > 0 AND nc > 0 THEN greatest(0, gc - nc) ELSE 0 END AS fin FROM raw),
one AS (SELECT doc_id, a, b, k, sl, {", ".join(_SUM(x) for x in ("nc", "no", "charge", "gc", "go", "added", "ded", "begin", "fin"))} FROM ({_aligned("dep")}) GROUP BY doc_id, a, b, k, sl),
op AS ({_imputed("one", "go", "gc", _TC)}),
op2 AS (SELECT * EXCLUDE (hit) FROM op WHERE hit IS NOT TRUE UNION ALL BY NAME SELECT * EXCLUDE (hit) FROM ({_aligned("(SELECT * FROM op WHERE hit)")})),
cl AS ({_imputed("op2", "gc", "go", _TO)}),
cl2 AS (SELECT * EXCLUDE (hit) FROM cl WHERE hit IS NOT TRUE UNION ALL BY NAME SELECT * EXCLUDE (hit) FROM ({_aligned("(SELECT * FROM cl WHERE hit)")})),
more AS (
  SELECT doc_id, sl, nc, no, charge, gc, go, added, ded, begin, fin FROM cl2
  UNION ALL SELECT doc_id, 9, 90000 + b, 60000 + a, 0, 0, 0, 0, 0, 0, 0 FROM n
  UNION ALL SELECT doc_id, 10, {_TC}, {_TO}, 0, 0, 0, 0, 0, 0, 0 FROM n)
SELECT doc_id, CAST(sl AS INT) AS sl_no, CAST(1000 * nc AS DOUBLE) AS net_closing, CAST(1000 * no AS DOUBLE) AS net_opening, CAST(1000 * charge AS DOUBLE) AS dep_provided_during_year,
       CAST(1000 * gc AS DOUBLE) AS gross_closing, CAST(1000 * go AS DOUBLE) AS gross_opening, CAST(1000 * added AS DOUBLE) AS gross_addition_actual, CAST(1000 * ded AS DOUBLE) AS gross_deduction,
       CAST(1000 * begin AS DOUBLE) AS dep_up_to_beginning, CAST(1000 * fin AS DOUBLE) AS dep_up_to_end
FROM more"""


@query("asset_note_lines", SQL_NOTE)
def asset_note_lines(spark, sf):
    """The asset note by transitions: labels and figures together, apart and in cells, second readings, sub-totals, rows 9 and 10."""
    k, when = F.col("k"), F.when
    land, building, plant, vehicle, computer, office, furniture = _ASSETS
    text = noisy(
        spark, sf, "Amounts in Lacs",
        when(k == 5, row("4 Property.Plant and Equipment", lac(_TC), lac(_TO))).otherwise("4 Property.Plant and Equipment"),
        row("Landing charges", lac("a"), lac("b + 100")), row("Land", lac(land[1]), lac(land[2])), row("Land", lac("b + 100"), lac("a + 100")),
        "Building", row(lac(building[1]), lac(building[2]), "7.00", lac(building[3]), "5.00 5.00 5.00 5.00", lac(building[4]), lac(building[5]), lac(building[6]), lac(building[7])),
        "Buildings under lease 1.00 2.00",
        F.concat_ws("\t", F.lit("Plant and Equipment"), lac(plant[1]), lac(plant[2]), F.lit("9.00"), F.lit("400.00"), lac(plant[3]), F.lit("25.00"), F.lit("30.00"), F.lit("35.00"), lac(plant[4]), lac(plant[5])),
        "Vehicles\tas before\tnone", row("Vehicle", lac(vehicle[1]), lac(vehicle[2])), row("Vehicles", lac("a + 100"), lac("b + 100")),
        row("Computers", lac(computer[1]), lac(computer[2]), "1.00 5.00"), "Office equipment", row(lac(office[1]), lac(office[2]), "33.00"),
        F.concat(F.lit("Lab equipment "), F.repeat(F.lit("x"), 200), F.lit(" 12.00 13.00")), "Lab equipment", "no figures", "77.00 88.00",
        row("Furniture", lac(furniture[1]), lac(furniture[2]), "8.00", lac(furniture[3]), "20.00 25.00", lac(furniture[4])),
        "5: Capital work in progress", "Ageing total 700.00 800.00", row("Sub total", lac("60000 + a"), lac("60000 + a"), lac("90000 + b"), "1.00"), "Sub total 900.00 950.00",
        when(k >= 2, "Total 12.00 13.00"), when(k < 3, row("Total", lac(_TC), lac(_TO))), when(k.isin(3, 4), "Total"), when(k.isin(3, 4), row(lac(_TC), lac(_TO))), when(k < 3, "Total 9,999.00 8,888.00"),
        amid=5,
    )
    out = notes.asset_note(text)
    return out.select("doc_id", "sl_no", *[F.round(f, 2).alias(f) for f in notes.FIELDS if f not in ("gross_addition_reval", "dep_adjustment")])


# --- the wide inventory row

_PARTS = {"st": "1500 + a", "fi": "120000 + b", "ra": "110000 + c", "wi": "40000 + a % 700", "st2": "1400 + b", "fi2": "130000 + c", "ra2": "100000 + a", "wi2": "50000 + b % 700"}
_WIDE = f"SELECT *, {', '.join(f'{v} AS {x}' for x, v in _PARTS.items())} FROM n"


@query(
    "inventory_wide_row",
    f"""{N}, w AS ({_WIDE}), r AS (
  SELECT doc_id, 3 AS sl, st2 AS o, st AS c, k FROM w UNION ALL SELECT doc_id, 6, fi2, fi, k FROM w UNION ALL SELECT doc_id, 1, ra2, ra, k FROM w UNION ALL SELECT doc_id, 5, wi2, wi, k FROM w UNION ALL SELECT doc_id, 2, 0, 0, k FROM w)
SELECT doc_id, CAST(sl AS INT) AS sl_no, k <> 5 AS balanced, CAST(1000 * o AS DOUBLE) AS opening_rs, CAST(1000 * c AS DOUBLE) AS closing_rs FROM r""",
)
def inventory_wide_row(spark, sf):
    """Ten amounts of one line, some with their decimals apart, a note number before them; an incomplete line first."""
    k, when, p = F.col("k"), F.when, _PARTS
    apart = lambda x, cond: when(cond, F.regexp_replace(lac(x), r"\.", " ")).otherwise(lac(x))
    total = lambda *names: lac(" + ".join(f"({p[x]})" for x in names))
    wide = row(
        when(k == 3, "8 Inventories").otherwise("Inventories:"), when(k == 5, lac("900000 + a")).otherwise(total("st", "fi", "ra", "wi")), apart(p["st"], k.isin(1, 2)), apart(p["fi"], k == 2),
        when(k == 4, F.regexp_replace(lac(p["ra"]), "^1", "!")).otherwise(lac(p["ra"])), apart(p["wi"], k == 2), total("st2", "fi2", "ra2", "wi2"), lac(p["st2"]), apart(p["fi2"], k == 1), lac(p["ra2"]), apart(p["wi2"], k == 3),
    )
    short = row("Inventories at cost", *[lac(f"{n}0000 + a") for n in range(1, 10)])
    text = noisy(spark, sf, "Note 8", "Inventories of both years", short, wide, row("Inventories again", *[lac(f"{n}1000 + b") for n in range(1, 11)]), amid=2)
    return notes.wide_inventory(text).select("doc_id", "sl_no", "balanced", F.round("opening_rs", 2).alias("opening_rs"), F.round("closing_rs", 2).alias("closing_rs"))


# --- cash

_CASH = "CASE WHEN k IN (0, 1) THEN 0 WHEN k = 2 THEN 9000 + a % 900 ELSE 2000 + a % 2000 END"
_OPEN = "CASE WHEN k IN (0, 1) THEN 0 WHEN k = 2 THEN 111 + 5000 + b % 900 + 55 WHEN k = 3 THEN 111 + 6000 + b % 900 + 55 + 7000 + c % 900 ELSE 111 + 5000 + b % 900 + 55 END"
_BANK = "CASE WHEN k = 5 THEN 275 ELSE 300 + c % 150 END"


@query("cash_note", f"{N} SELECT doc_id, CAST(1000 * ({_OPEN}) AS DOUBLE) AS opening, CAST(1000 * (({_CASH}) + ({_BANK})) AS DOUBLE) AS closing FROM n")
def cash_note(spark, sf):
    """The cash note's wide row split at its pivot, and the last line on deposits."""
    k, when = F.col("k"), F.when
    start = "Cash on hand and bank balances other than cash 10A 10B"
    opening = row("1.00 11.00", lac("5000 + b % 900"), "0.55")
    text = noisy(
        spark, sf, "Cash and cash equivalents", "Cash on hand 25.00 45.00 60.00",
        when(k == 0, row(start, "3.00 4.00", lac("2000 + a % 2000"), "50.00 60.00 70.00")).when(k == 1, row(start, lac("2000 + a % 2000"), "45.81 60.00"))
        .when(k == 2, row(start, "3.00", lac("9000 + a % 900"), "4.00 45.81", opening))
        .when(k == 3, row(start, "3.00", lac("2000 + a % 2000"), "45.81 1.00 11.00 46.10", lac("6000 + b % 900"), "0.55", lac("7000 + c % 900"), "2.00 99.00"))
        .otherwise(row(start, "3.00 4.00", lac("2000 + a % 2000"), "31.00 44.10 41.00", opening)),
        row("Fixed deposits", "3.10 4.90"), row("Remaining maturity of months", "2.50", lac("300 + c % 150"), "120.00 8.00"), when(k == 5, "Maturing within months 2.75 9.00"),
        amid=2,
    )
    return notes.cash_note(text).select("doc_id", F.round("opening", 2).alias("opening"), F.round("closing", 2).alias("closing"))


# --- the face by place

_TR, _LO, _TRO, _LOO = "200000 + a * 10", "90000000 + b", "300000 + c * 10", "80000000 + a"
_FACE_SQL = f"""{N},
tab AS (SELECT *, k IN (0, 1, 2, 5) AS ok FROM n),
r AS (
  SELECT doc_id, 'face.trade_receivables' AS key, CASE WHEN ok THEN {_TRO} WHEN k = 3 THEN 99999 ELSE 160000 + b END AS opening, CASE WHEN ok THEN {_TR} ELSE 150000 + a END AS closing FROM tab
  UNION ALL SELECT doc_id, 'face.loans_and_advances', CASE WHEN ok THEN {_LOO} ELSE 600000 + a END, CASE WHEN ok THEN {_LO} ELSE 700000 + b END FROM tab WHERE k <> 2
  UNION ALL SELECT doc_id, 'face.unsecured_loan', 800000 + c, 900000 + a FROM tab)
SELECT doc_id, key, CAST(opening AS DOUBLE) AS opening, CAST(closing AS DOUBLE) AS closing FROM r"""


@query("face_by_place", _FACE_SQL)
def face_by_place(spark, sf):
    """Components of a tabular face row by their places, with empty cells, missing notes and too few amounts; else by lines."""
    k, when = F.col("k"), F.when
    whole = lambda x: F.expr(x).cast("string")
    cells = lambda *parts: F.concat_ws("\t", *[F.lit(x) if isinstance(x, str) else x for x in parts])
    notes_ = when(k == 1, cells("6", "", "7", "8", "", "9")).when(k == 3, cells("6", "7", "8")).otherwise(cells("6", "7", "8", "9"))
    amounts = [whole(x) for x in ("150000 + a", "160000 + b", _TR, _LO, "170000 + c", "180000 + a", "190000 + b", _TRO, _LOO, "210000 + c")]
    amounts[3] = when(k == 2, whole("110000 + b")).otherwise(amounts[3])  # loans too small to be these
    tabular = when(k == 4, cells("Inventories Trade receivables Cash Loans", notes_, *amounts[:9])).otherwise(cells("Inventories Trade receivables Cash Loans", notes_, "", amounts[0], "99,999", "", *amounts[1:]))
    text = noisy(
        spark, sf, "Balance Sheet as at 31st March", "Trade receivables hypothecation 7 9,99,999 8,88,888", "Total trade receivables 7 7,77,777 6,66,666", "Trade receivables 8 5,55,555 4,44,444", "Trade receivables 7 7,77,77,777 5,55,555",
        tabular, row("Trade receivables 7", whole("500000 + c"), whole("400000 + b"), "3,00,000"), "Loans & advances 9 3,33,333 2,22,222", when(k != 2, row("Loans & advances and other current assets 9", whole("700000 + b"), whole("600000 + a"))),
        F.concat(F.lit("Unsecured loan 4 1,23,456 2,34,567 "), F.repeat(F.lit("y"), 200)), row("Unsecured loan 4", whole("900000 + a"), whole("800000 + c")), "Unsecured loan 4 1,11,111 2,22,222",
        amid=1,
    )
    return notes.face_components(text).select("doc_id", "key", "opening", "closing")


# --- the face of the balance sheet


def _plain(x: str) -> Column:
    return F.expr(x).cast("string")


@query(
    "property_net",
    f"""{N} SELECT doc_id, CAST(CASE k WHEN 0 THEN 1000 * (200000 + b) WHEN 1 THEN 6000000 + b WHEN 2 THEN 1000 * (300000 + b) WHEN 3 THEN 7000000 + b ELSE 8000000 + b END AS DOUBLE) AS opening,
  CAST(CASE k WHEN 0 THEN 1000 * (200000 + a) WHEN 1 THEN 6000000 + a WHEN 2 THEN 1000 * (300000 + a) WHEN 3 THEN 7000000 + a ELSE 8000000 + a END AS DOUBLE) AS closing FROM n WHERE k < 5""",
)
def property_net(spark, sf):
    """Property on the face: misread labels, both units, rows of cells, and amounts too small to be it."""
    k, when = F.col("k"), F.when
    cells = lambda *parts: F.concat_ws("\t", *[F.lit(x) if isinstance(x, str) else x for x in parts])
    text = noisy(
        spark, sf, when(k.isin(0, 2), "Balance sheet, Amounts in Lacs").otherwise("Balance sheet"),
        when(k == 0, row("Propeny, planl & equipments 4", lac("200000 + a"), lac("200000 + b"))).when(k == 1, row("Property, plant and equipment 5", _plain("6000000 + a"), _plain("6000000 + b")))
        .when(k == 2, cells("Property", "Plant", "note 3", lac("300000 + a"), "1.50", lac("300000 + b"), "9,000.00")).when(k == 3, cells("Prope rty and plani", "x9", _plain("7000000 + a"), "4,999,999", _plain("7000000 + b")))
        .when(k == 4, row("Property, plant and equipment 4", _plain("8000000 + a"), _plain("8000000 + b"))).otherwise("Property, plant and equipment 4 4000000 3000000"),
        cells("Properties of plants", "12", "13"), when(k == 4, row("Property, plant and equipment 5 9000000 9000001")),
    )
    return faces.property_net(text)


@query(
    "tax_provision",
    f"""{N} SELECT doc_id, CAST(CASE WHEN k IN (0, 1) THEN b + 10000 ELSE 0 END AS DOUBLE) AS opening, CAST(CASE k WHEN 2 THEN a + 30000 ELSE a + 20000 END AS DOUBLE) AS closing FROM n WHERE k <> 4 AND k <> 5""",
)
def tax_provision(spark, sf):
    """The provision for income tax: on its line, on one of the next three, alone, beyond a total, or too large."""
    k, when = F.col("k"), F.when
    text = noisy(
        spark, sf, "Schedule 10", "Provision for taxes 99,000 98,000", "Income tax refund 97,000",
        when(k == 0, row("Provision for income tax", _plain("a + 20000"), _plain("b + 10000"), "7")).when(k == 5, "Provision for income tax 5,00,00,000 60000000").otherwise("Provision for Income Tax"),
        when(k == 1, row("of both years", "55,555,555,555", _plain("a + 20000"), _plain("b + 10000"))).when(k == 2, "no amount here").when(k == 4, "Total 88,000 77,000").when(k == 5, "Grand total").otherwise("pending"),
        when(k == 2, _plain("a + 30000")).when(k == 3, "nor here"), when(k == 3, row("at last", _plain("a + 20000"))), when(k < 3, "96,000 95,000"),
    )
    return faces.tax_provision(text)


_D10 = {8: ("500000 + a", "600000 + b"), 9: ("700000 + b", "800000 + c"), 10: ("900000 + c", "950000 + a")}
_FACE_CHECK = f"""{N},
r AS ({" UNION ALL ".join(f"SELECT doc_id, k, a, b, c, {sl} AS sl, {o} AS o, {cl} AS cl FROM n" + (" WHERE k <> 4" if sl == 9 else "") for sl, (o, cl) in _D10.items())}),
f AS (
  SELECT doc_id, 8 AS sl, CASE k WHEN 1 THEN 2000000 + b ELSE 550000 + b END AS fo, 900000 + a AS fc FROM n WHERE k IN (0, 1)
  UNION ALL SELECT doc_id, 9, 710000 + b, 810000 + c FROM n WHERE k = 0 UNION ALL SELECT doc_id, 9, 900000 + a, 800000 + c FROM n WHERE k = 1)
SELECT r.doc_id, CAST(r.sl AS INT) AS sl_no,
  CAST(CASE WHEN k = 0 AND r.sl = 8 THEN f.fo WHEN k = 1 AND r.sl = 9 THEN f.fo WHEN k IN (3, 4) AND r.sl = 9 THEN 1000 * (20000 + r.a) ELSE r.o END AS DOUBLE) AS opening_rs,
  CAST(CASE WHEN k = 0 AND r.sl = 8 THEN f.fc WHEN k = 1 AND r.sl = 9 THEN f.fc WHEN k IN (3, 4) AND r.sl = 9 THEN 1000 * (30000 + r.b) WHEN k IN (3, 4) AND r.sl = 10 THEN 1000 * (40000 + r.c) ELSE r.cl END AS DOUBLE) AS closing_rs
FROM r LEFT JOIN f ON f.doc_id = r.doc_id AND f.sl = r.sl
UNION ALL SELECT doc_id, 9, 1000 * (20000 + a), 1000 * (30000 + b) FROM n WHERE k = 4
UNION ALL SELECT doc_id, 17, 1000 * (60000 + b), 1000 * (50000 + a) FROM n WHERE k IN (3, 4)"""


@query("face_crosscheck", _FACE_CHECK)
def face_crosscheck(spark, sf):
    """Block D held against faces in rupees and lakhs: near and far amounts, wild openings, missing rows, pages without a face."""
    k, when = F.col("k"), F.when
    lakh = k.isin(3, 4)
    text = noisy(
        spark, sf, when(lakh, "Balance sheet (Amounts in Lacs)").otherwise("Balance sheet"), "Trade receivables beyond six months 12 13",
        when(k.isin(0, 1), row("Cash & Bank Balances 8", _plain("900000 + a"), _plain("CASE k WHEN 1 THEN 2000000 + b ELSE 550000 + b END"))),
        when(k == 0, row("Trade Receivable 7", _plain("810000 + c"), _plain("710000 + b"))).when(k == 1, row("Trade Receivable 7", _plain("800000 + c"), _plain("900000 + a"))),
        when(k.isin(0, 1), "Loans & Advances 9 111111 222222"), when(lakh, row("Trade receivables 9", lac("30000 + b"), lac("20000 + a"))),
        when(lakh, row("Other current assets 7", lac("40000 + c"), "9.00")), when(lakh, row("Borrowings 13", lac("50000 + a"), lac("60000 + b"))), when(lakh, "Borrowings 16 -"),
    )
    rows = F.array(*[F.struct(F.lit(sl).alias("sl_no"), F.expr(o).cast("double").alias("opening_rs"), F.expr(c).cast("double").alias("closing_rs")) for sl, (o, c) in _D10.items()])
    n = spark.sql(f"SELECT doc_id, a, b, c, k FROM ({NUMBERS.replace('FROM documents', 'FROM {docs}')})", docs=table(spark, sf, "documents"))
    mine = n.select("doc_id", "k", F.inline(rows)).where("not (k = 4 and sl_no = 9)").drop("k")
    out = faces.crosscheck_with_face(mine, text.drop("page_no"))
    return out.select("doc_id", "sl_no", F.round("opening_rs", 2).alias("opening_rs"), F.round("closing_rs", 2).alias("closing_rs"))


@query(
    "total_row",
    f"""{N} SELECT doc_id, CAST(sl AS INT) AS sl_no, CAST(CASE WHEN sl = 10 AND k < 3 THEN 60000000 + b ELSE a + sl END AS DOUBLE) AS net_opening, CAST(CASE WHEN sl = 10 AND k < 3 THEN 70000000 + a ELSE b + sl END AS DOUBLE) AS net_closing
FROM n CROSS JOIN (VALUES (2), (8), (10)) v(sl)""",
)
def total_row(spark, sf):
    """Row 10 of block C by the total line, where it is large enough to be one."""
    k = F.col("k")
    text = noisy(spark, sf, "Fixed assets", "Total (b) 80000000 90000000", F.when(k < 3, row("Total (a)", _plain("70000000 + a"), _plain("60000000 + b"))).when(k == 3, "Total (a) 7000 6000"), "Total (a+b) 99999999 99999998")
    n = spark.sql(f"SELECT doc_id, a, b FROM ({NUMBERS.replace('FROM documents', 'FROM {docs}')})", docs=table(spark, sf, "documents"))
    rows = n.select("doc_id", "a", "b", F.explode(F.array(F.lit(2), F.lit(8), F.lit(10))).alias("sl_no")).select("doc_id", "sl_no", (F.col("a") + F.col("sl_no")).cast("double").alias("net_opening"), (F.col("b") + F.col("sl_no")).cast("double").alias("net_closing"))
    return faces.with_total_row(rows, schedules.total_nets(text))
