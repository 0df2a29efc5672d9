"""Driver-facing queries, each with the SQL that DuckDB runs for the same rows.

Statements are made from the star schema: amounts are whole rupees summed as integers, so that both
engines agree to the last digit. What both engines read alike is written once, as SQL over named
tables (``{orders}`` is a DataFrame in Spark and a view in DuckDB)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import closeness, numbers
from ..functions import text as T
from ..operators import checks, derive, fuzzy, merges, pages, rules, scores, spatial
from ..session import shared_path, table
from ..sources import readers
from ..streaming import ingest
from . import schema, statement

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where SQL can express it."""

    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return put


# --- statements from the star schema

_P = "CAST(round({0}) AS BIGINT)"
D_ROWS = f"""
SELECT o_custkey AS doc_id, CAST(o_orderkey % 17 + 1 AS INT) AS sl_no,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN {_P.format('o_totalprice')} ELSE 0 END) AS DOUBLE) AS opening_rs,
       CAST(sum(CASE WHEN o_orderstatus <> 'O' THEN {_P.format('o_totalprice')} ELSE 0 END) AS DOUBLE) AS closing_rs
FROM {{orders}} GROUP BY o_custkey, o_orderkey % 17 + 1"""
C_BASE = f"""
SELECT l_suppkey AS doc_id, l_linenumber AS sl_no,
       CAST(sum({_P.format('l_extendedprice')}) AS DOUBLE) AS gross_opening,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN {_P.format('l_extendedprice')} ELSE 0 END) AS DOUBLE) AS gross_addition_actual,
       CAST(sum(CASE WHEN l_returnflag = 'A' THEN {_P.format('l_extendedprice')} ELSE 0 END) AS DOUBLE) AS gross_deduction,
       CAST(sum({_P.format('l_extendedprice * l_discount')}) AS DOUBLE) AS dep_up_to_beginning,
       CAST(sum({_P.format('l_extendedprice * l_tax')}) AS DOUBLE) AS dep_provided_during_year
FROM {{lineitem}} GROUP BY l_suppkey, l_linenumber"""
C_ROWS = f"""
SELECT doc_id, CAST(sl_no AS INT) AS sl_no, gross_opening, CAST(0 AS DOUBLE) AS gross_addition_reval, gross_addition_actual, gross_deduction,
       gross_opening + gross_addition_actual - gross_deduction + CASE WHEN sl_no = 3 THEN 50000 ELSE 0 END AS gross_closing,
       dep_up_to_beginning, dep_provided_during_year, CAST(0 AS DOUBLE) AS dep_adjustment,
       dep_up_to_beginning + dep_provided_during_year AS dep_up_to_end,
       gross_opening - dep_up_to_beginning AS net_opening,
       gross_opening + gross_addition_actual - gross_deduction - dep_up_to_beginning - dep_provided_during_year AS net_closing
FROM ({C_BASE}) b"""


def _sql(text: str) -> str:
    return text.format(orders="orders", lineitem="lineitem")


def d_rows(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(D_ROWS, orders=table(spark, sf, "orders"))


def c_rows(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(C_ROWS, lineitem=table(spark, sf, "lineitem"))


_UNPIVOT_D = "SELECT doc_id, sl_no, 'opening_rs' AS field, opening_rs AS value FROM d UNION ALL SELECT doc_id, sl_no, 'closing_rs', closing_rs FROM d"
WITH_D = f"WITH d AS ({_sql(D_ROWS)}), cells AS ({_UNPIVOT_D})"

#: Headers that documents get by their number, so that every kind of page occurs. Fixed values.
HEADERS = (
    "",
    "Amounts in Lacs\nSCHEDULE 5 GROSS BLOCK NET BLOCK",
    "Balance Sheet as at 31 March\nEQUITY AND LIABILITIES (in lakhs)",
    "Auditor report",
    "(Rs. in crores) SCHEDULE 8 sundry creditor inventories",
    "land building vehicle 12,34,567 opening closing balance",
    "Balance sheet as on date\nSources of funds",
    "Property, plant and equipment schedule in detail lacs",
)
_HEAD_SQL = "(CASE {id} % 8 " + " ".join(f"WHEN {k} THEN '{h.replace(chr(10), chr(10))}'" for k, h in enumerate(HEADERS)) + " END)"


def _headed(df: DataFrame, key: str) -> DataFrame:
    head = F.get(F.array(*[F.lit(h) for h in HEADERS]), F.pmod(F.col(key), F.lit(8)).cast("int"))
    return df.withColumn("text", F.concat(head, F.lit("\n"), F.coalesce("text", F.lit(""))))


def _like(t: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({t}, '{p}')" for p in phrases) + ")"


def _count(t: str, phrases) -> str:
    return "(" + " + ".join(f"CAST(contains({t}, '{p}') AS INT)" for p in phrases) + ")"


_DOC = f"SELECT doc_id, {_HEAD_SQL.format(id='doc_id')} || chr(10) || coalesce(text, '') AS text FROM documents"
_CONV = f"SELECT conv_id AS doc_id, CAST(turn AS INT) AS page_no, {_HEAD_SQL.format(id='(conv_id + turn)')} || chr(10) || coalesce(text, '') AS text FROM conversations"
_UNIT = r"""CASE WHEN regexp_matches(u, 'amounts?\s*in\s*crores?|in\s*crores?|in\s*cr\b') THEN 'crores'
     WHEN regexp_matches(u, 'amounts?\s*(in|m)\s*lacs?|in\s*(lacs?|lakhs?)') THEN 'lakhs'
     WHEN contains(u, 'netblock') AND contains(u, 'grossblock') THEN 'rupees'
     WHEN (contains(u, 'property,plant') OR contains(u, 'property.plant')) AND contains(u, 'schedule') AND regexp_matches(u, 'lacs?|lakhs?') THEN 'lakhs'
     ELSE 'rupees' END"""


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return _headed(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def _conv(spark: SparkSession, sf: str) -> DataFrame:
    p = readers.conversation_pages(table(spark, sf, "conversations"))
    return _headed(p.withColumn("__k", F.col("doc_id") + F.col("page_no")), "__k").drop("__k")


# --- scans, lines, tokens


@query("number_tokens", "SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS pos, unnest(l) AS token FROM (SELECT doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '[0-9,.]+'), lambda x: regexp_matches(x, '[0-9]')) AS l FROM documents)")
def number_tokens(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.posexplode(numbers.line_tokens(F.col("text"))).alias("pos", "token"))


@query("doc_lines", "SELECT doc_id, CAST(1 AS INT) AS page_no, CAST(generate_subscripts(l, 1) - 1 AS INT) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)")
def doc_lines(spark, sf):
    return pages.lines(readers.document_pages(table(spark, sf, "documents")))


@query("keyword_quality", f"SELECT doc_id, CAST({_count('t', pages.KEYWORDS)} >= 3 OR len(list_filter(regexp_extract_all(t, '[0-9,]{{5,}}'), lambda x: length(replace(x, ',', '')) >= 4)) >= 5 AS BOOLEAN) AS ok FROM (SELECT doc_id, lower(text) AS t FROM ({_DOC}))")
def keyword_quality(spark, sf):
    return _docs(spark, sf).select("doc_id", pages.quality_ok(F.col("text")).alias("ok"))


_TAGS = f"""CASE WHEN {_like('t', pages.SKIP)} THEN 'skip'
  WHEN (contains(t, 'balance sheet as at') OR contains(t, 'balance sheet as on')) AND NOT {_like('t', ('schedules annexed', 'notes to financial', 'note 4'))}
       AND {_like('t', ('total assets', 'total nssets', 'equity and liabilit', 'sources of funds', 'application of funds'))} THEN 'summary'
  ELSE concat_ws(',', CASE WHEN {_like('t', pages.ASSET_PAGES)} OR ({_count('t', pages.ASSET_NAMES)} >= 3 AND regexp_matches(t, '[0-9,]{{6,}}')) THEN 'block_c' END,
                 CASE WHEN {_like('t', pages.CURRENT_PAGES)} THEN 'block_d' END) END"""


@query("page_route", f"SELECT doc_id, {_TAGS} AS tags FROM (SELECT doc_id, lower(text) AS t FROM ({_DOC}))")
def page_route(spark, sf):
    return _docs(spark, sf).select("doc_id", F.array_join(pages.page_tags(F.col("text")), ",").alias("tags"))


@query("unit_detect", f"SELECT doc_id, {_UNIT} AS unit FROM (SELECT doc_id, replace(lower(text), ' ', '') AS u FROM ({_DOC}))")
def unit_detect(spark, sf):
    return _docs(spark, sf).select("doc_id", numbers.unit_of(F.col("text")).alias("unit"))


_LACS = r"regexp_matches(lower(text), 'balance\s+sheet') AND regexp_matches(lower(text), 'in\s+(lacs?|lakhs?)')"


@query(
    "unit_vote",
    f"""WITH p AS (SELECT doc_id, page_no, {_LACS} AS lacs, {_UNIT.replace('u,', "replace(lower(text), ' ', ''),")} AS unit FROM ({_CONV})),
v AS (SELECT doc_id, unit, count(*) AS n, min(page_no) AS f, bool_or(lacs) AS lacs FROM p GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS k, bool_or(lacs) OVER (PARTITION BY doc_id) AS any_lacs FROM v)
SELECT doc_id, CASE WHEN any_lacs THEN 'lakhs' ELSE unit END AS unit FROM r WHERE k = 1""",
)
def unit_vote(spark, sf):
    return pages.unit_vote(_conv(spark, sf))


@query(
    "summary_page",
    f"""SELECT doc_id, page_no FROM (SELECT doc_id, coalesce(min(CASE WHEN {_LACS} THEN page_no END),
  min(CASE WHEN contains(lower(text), 'sources of funds') OR contains(lower(text), 'application of funds') THEN page_no END)) AS page_no FROM ({_CONV}) GROUP BY doc_id) WHERE page_no IS NOT NULL""",
)
def summary_page(spark, sf):
    return pages.summary_page(_conv(spark, sf))


@query("pages_with_phrase", f"SELECT doc_id, list_sort(list(DISTINCT page_no)) AS page_nos FROM ({_CONV}) WHERE contains(lower(text), 'schedule 8') GROUP BY doc_id")
def pages_with_phrase(spark, sf):
    return pages.pages_with(_conv(spark, sf), "Schedule 8")


_LINES = f"SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS line_no, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM ({_DOC}))"


@query(
    "section_between",
    f"""WITH l AS ({_LINES}), m AS (SELECT *, CASE WHEN regexp_matches(lower(line), '^the ') THEN 'in' WHEN regexp_matches(lower(line), 'tion') THEN 'out' END AS mark FROM l),
s AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS place FROM m)
SELECT doc_id, line_no, line FROM s WHERE place = 'in' AND mark IS NULL""",
)
def section_between(spark, sf):
    return pages.between(pages.lines(_docs(spark, sf)), "^the ", "tion", ["doc_id"], "line_no")


@query(
    "carry_forward",
    f"WITH l AS ({_LINES}) SELECT doc_id, line_no, last_value(CASE WHEN regexp_matches(line, '^[A-Z]') THEN line[1:12] END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section FROM l",
)
def carry_forward(spark, sf):
    head = F.when(F.rlike("line", F.lit("^[A-Z]")), F.substring("line", 1, 12))
    return pages.carry_section(pages.lines(_docs(spark, sf)), head, ["doc_id"], "line_no").select("doc_id", "line_no", "section")


@query(
    "within_header_lines",
    f"""WITH l AS ({_LINES}), h AS (SELECT *, last_value(CASE WHEN regexp_matches(lower(line), '^the') THEN line_no END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS h FROM l)
SELECT doc_id, line_no, line FROM h WHERE line_no - h < 3""",
)
def within_header_lines(spark, sf):
    return pages.within_lines(pages.lines(_docs(spark, sf)), "^the", 3, ["doc_id"], "line_no")


@query(
    "lookahead3",
    """WITH e AS (SELECT user_id, event_id, CASE WHEN value > 50 THEN [round(value, 4)] ELSE [] END AS a FROM events),
n AS (SELECT *, lead(a, 1) OVER w AS a1, lead(a, 2) OVER w AS a2, lead(a, 3) OVER w AS a3 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, event_id, CASE WHEN len(a) > 0 THEN a[1] WHEN len(a1) > 0 THEN a1[1] WHEN len(a2) > 0 THEN a2[1] WHEN len(a3) > 0 THEN a3[1] END AS found FROM n""",
)
def lookahead3(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", F.when(F.col("value") > 50, F.array(F.round("value", 4))).otherwise(F.expr("cast(array() as array<double>)")).alias("a"))
    return pages.amounts_or_following(e, "a", ["user_id"], "event_id").select("user_id", "event_id", F.get("found", F.lit(0)).alias("found"))


@query(
    "gap_cluster",
    """WITH e AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 1 HOUR THEN 1 ELSE 0 END AS n FROM events)
SELECT user_id, event_id, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM e""",
)
def gap_cluster(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf, "events").select("user_id", "ts", "event_id")
    new = F.coalesce((F.col("ts") - F.lag("ts").over(w) > F.expr("INTERVAL '1' HOUR")).cast("int"), F.lit(0))
    return e.withColumn("n", new).select("user_id", "event_id", F.sum("n").over(w).alias("cluster"))


# --- scalars


@query("indian_format", "SELECT o_orderkey, CASE WHEN length(n) <= 3 THEN n ELSE reverse(regexp_replace(reverse(n[1:length(n)-3]), '(\\d\\d)(?:)', '\\1,', 'g')) || ',' || n[-3:] END AS f FROM (SELECT o_orderkey, CAST(CAST(round(o_totalprice) AS BIGINT) AS VARCHAR) AS n FROM orders)".replace("reverse(regexp_replace(reverse(n[1:length(n)-3]), '(\\d\\d)(?:)', '\\1,', 'g'))", "ltrim(reverse(regexp_replace(reverse(n[1:length(n)-3]), '(\\d\\d)', '\\1,', 'g')), ',')"))
def indian_format(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", numbers.indian_format(F.round("o_totalprice")).alias("f"))


@query("indian_parse", "SELECT o_orderkey, CAST(round(o_totalprice) AS DOUBLE) AS v FROM orders")
def indian_parse(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", numbers.indian_parse(numbers.indian_format(F.round("o_totalprice"))).alias("v"))


@query("signed_parse", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END * CAST(round(o_totalprice) AS DOUBLE) AS v FROM orders")
def signed_parse(spark, sf):
    s = numbers.indian_format(F.round("o_totalprice"))
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", numbers.signed_amount(F.when((k % 3 == 0) & (k % 2 == 0), F.concat(F.lit("("), s, F.lit(")"))).when(k % 3 == 0, F.concat(F.lit("-"), s)).otherwise(s)).alias("v"))


@query(
    "lakh_parse",
    "SELECT p_partkey, round(CASE p_partkey % 4 WHEN 0 THEN n / 100.0 WHEN 1 THEN n / 100.0 WHEN 2 THEN n / 100.0 ELSE CASE WHEN n >= 10000 AND n < 100000 THEN n / 100.0 ELSE n END END, 4) AS v FROM (SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS n FROM part)",
)
def lakh_parse(spark, sf):
    n = F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string")
    k = F.col("p_partkey") % 4
    dotted = F.regexp_replace(n, "^(.*)(..)$", "$1.$2")
    token = F.when(k == 0, dotted).when(k == 1, F.regexp_replace(dotted, r"\.", ":")).when(k == 2, F.regexp_replace(n, "^(.+)(...)(..)$", "$1.$2.$3")).otherwise(n)
    return table(spark, sf, "part").select("p_partkey", F.round(numbers.lakhs_decimal(token), 4).alias("v"))


@query("match_score_bands", "SELECT o_orderkey, CAST(CASE WHEN g = 0 AND e = 0 THEN 100 WHEN g = 0 OR e = 0 THEN 40 WHEN abs(g - e) / greatest(abs(g), abs(e)) <= 0.02 THEN 95 WHEN abs(g - e) / greatest(abs(g), abs(e)) < 0.1 THEN 75 WHEN abs(g - e) / greatest(abs(g), abs(e)) < 0.3 THEN 55 ELSE 30 END AS INT) AS score FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_totalprice END AS g, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_totalprice * (1 + (o_orderkey % 50) / 100.0) END AS e FROM orders)")
def match_score_bands(spark, sf):
    o = table(spark, sf, "orders")
    g = F.when(F.col("o_orderkey") % 5 == 0, 0.0).otherwise(F.col("o_totalprice"))
    e = F.when(F.col("o_orderkey") % 7 == 0, 0.0).otherwise(F.col("o_totalprice") * (1 + (F.col("o_orderkey") % 50) / 100.0))
    return o.select("o_orderkey", closeness.match_score(g, e).alias("score"))


@query(
    "closeness_kinds",
    """SELECT o_orderkey, CASE WHEN a = 0 AND b = 0 THEN true WHEN a = 0 OR b = 0 THEN abs(a - b) < 1000 ELSE abs(a - b) / greatest(abs(a), abs(b)) <= 0.02 END AS quality,
abs(a - b) <= greatest(100, 0.02 * greatest(abs(a), abs(b), 1)) AS value, abs(a - b) <= greatest(100, 0.005 * greatest(abs(a), abs(b), 1)) AS financial,
abs(a - b) <= 1 AS strict, abs(a - b) / greatest(abs(b), 1) <= 0.01 AS audit, abs(a - b) <= 0.02 * greatest(abs(a), 1) AS target
FROM (SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE round(o_totalprice) END AS DOUBLE) AS a, CAST(round(o_totalprice) + (o_orderkey % 9) * 250 AS DOUBLE) AS b FROM orders)""",
)
def closeness_kinds(spark, sf):
    a = F.when(F.col("o_orderkey") % 11 == 0, 0.0).otherwise(F.round("o_totalprice"))
    b = F.round("o_totalprice") + (F.col("o_orderkey") % 9) * 250
    o = table(spark, sf, "orders").select("o_orderkey", a.alias("a"), b.cast("double").alias("b"))
    a, b = F.col("a"), F.col("b")
    c = closeness
    return o.select("o_orderkey", c.close_quality(a, b).alias("quality"), c.close_value(a, b).alias("value"), c.close_financial(a, b).alias("financial"), c.close_financial(a, b, strict=True).alias("strict"), c.close_audit(a, b).alias("audit"), c.close_target(a, b).alias("target"))


@query("json_props", "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.v') AS v FROM events")
def json_props(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.v").alias("v"))


@query("json_block_extract", "SELECT event_id, CAST(CASE WHEN event_id % 3 = 2 THEN NULL ELSE event_id END AS BIGINT) AS id FROM events")
def json_block_extract(spark, sf):
    made = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit("}"))
    k = F.col("event_id") % 3
    text = F.when(k == 0, F.concat(F.lit("Sure:\n```json\n"), made, F.lit("\n```\nDone"))).when(k == 1, F.concat(F.lit("Result "), made, F.lit(" as asked"))).otherwise(F.lit("no object {here"))
    return table(spark, sf, "events").select("event_id", F.get_json_object(T.json_block(text), "$.id").cast("bigint").alias("id"))


@query(
    "html_unescape_label",
    r"""SELECT doc_id, CAST(1 AS INT) AS page_no, """ + "replace(" * 8 + r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))""" + "".join(f", '{a.replace(chr(39), chr(39) * 2)}', '{b.replace(chr(39), chr(39) * 2)}')" for a, b in T.ENTITIES) + " AS text FROM (SELECT page_id AS doc_id, html FROM pages)",
)
def html_unescape_label(spark, sf):
    return readers.web_pages(table(spark, sf, "pages"))


# --- merges


@query("missing_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def missing_anti(spark, sf):
    return table(spark, sf, "customer").select("c_custkey").join(table(spark, sf, "orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")


@query("present_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def present_semi(spark, sf):
    return table(spark, sf, "customer").select("c_custkey").join(table(spark, sf, "orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi")


_TEMPLATE_D = "(VALUES " + ", ".join(f"({k}, '{x.replace(chr(39), chr(39) * 2)}')" for k, x in enumerate(schema.D_LABELS, 1)) + ") t(sl_no, label)"


@query("template_merge", f"{WITH_D} SELECT k.doc_id, CAST(t.sl_no AS INT) AS sl_no, t.label, coalesce(d.opening_rs, 0) AS opening_rs, coalesce(d.closing_rs, 0) AS closing_rs FROM (SELECT DISTINCT doc_id FROM d) k CROSS JOIN {_TEMPLATE_D} LEFT JOIN d ON d.doc_id = k.doc_id AND d.sl_no = t.sl_no")
def template_merge(spark, sf):
    return merges.template_merge(d_rows(spark, sf), "D")


@query("missing_rows", f"{WITH_D} SELECT k.doc_id, CAST(t.sl_no AS INT) AS sl_no FROM (SELECT DISTINCT doc_id FROM d) k CROSS JOIN {_TEMPLATE_D} WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.doc_id = k.doc_id AND d.sl_no = t.sl_no AND (opening_rs <> 0 OR closing_rs <> 0))")
def missing_rows(spark, sf):
    return merges.missing_rows(d_rows(spark, sf), "D")


@query("cells_unpivot", f"{WITH_D} SELECT doc_id, 'D' AS block, sl_no, field, value FROM cells")
def cells_unpivot(spark, sf):
    return merges.to_cells(d_rows(spark, sf), "D")


@query("cells_pivot", f"{WITH_D} SELECT doc_id, sl_no, coalesce(max(CASE WHEN field = 'opening_rs' THEN value END), 0) AS opening_rs, coalesce(max(CASE WHEN field = 'closing_rs' THEN value END), 0) AS closing_rs FROM cells GROUP BY doc_id, sl_no")
def cells_pivot(spark, sf):
    return merges.to_rows(merges.to_cells(d_rows(spark, sf), "D"), "D")


@query("first_nonzero", "SELECT user_id, event_type, coalesce(arg_min(v, event_id) FILTER (v <> 0), 0) AS value FROM (SELECT user_id, event_type, event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE value END AS v FROM events) GROUP BY ALL")
def first_nonzero(spark, sf):
    e = table(spark, sf, "events").withColumn("value", F.when(F.col("event_id") % 3 == 0, 0.0).otherwise(F.col("value")))
    return merges.first_nonzero(e, ["user_id", "event_type"], ["event_id"])


@query("last_nonzero", "SELECT user_id, event_type, arg_max(v, event_id) FILTER (v <> 0) AS value FROM (SELECT user_id, event_type, event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE value END AS v FROM events) GROUP BY ALL HAVING count(*) FILTER (v <> 0) > 0")
def last_nonzero(spark, sf):
    e = table(spark, sf, "events").withColumn("value", F.when(F.col("event_id") % 3 == 0, 0.0).otherwise(F.col("value")))
    return merges.last_nonzero(e, ["user_id", "event_type"], ["event_id"])


@query("precedence_dedupe", f"WITH r AS (SELECT o_custkey AS doc_id, CAST(o_orderkey % 17 + 1 AS INT) AS sl_no, o_orderkey AS ord, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE round(o_totalprice) END AS opening_rs, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE round(o_totalprice * 2) END AS closing_rs FROM orders) SELECT doc_id, sl_no, ord, opening_rs, closing_rs FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, sl_no ORDER BY CASE WHEN sl_no IN (1, 3, 5, 6) THEN -(opening_rs + closing_rs) ELSE CASE WHEN opening_rs = 0 AND closing_rs = 0 THEN 1 ELSE 0 END END, ord) AS k FROM r) WHERE k = 1")
def precedence_dedupe(spark, sf):
    k = F.col("o_orderkey")
    zero = lambda x: F.when(k % 4 == 0, 0.0).otherwise(F.round(x))
    r = table(spark, sf, "orders").select(F.col("o_custkey").alias("doc_id"), (k % 17 + 1).cast("int").alias("sl_no"), k.alias("ord"), zero(F.col("o_totalprice")).alias("opening_rs"), zero(F.col("o_totalprice") * 2).alias("closing_rs"))
    return merges.dedupe_detail(r, "ord")


@query("rekey_sum", f"WITH b AS ({_sql(C_BASE)}) SELECT doc_id, CAST(CASE sl_no WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 3 WHEN 4 THEN 7 WHEN 5 THEN 5 ELSE 7 END AS INT) AS sl_no, sum(gross_opening) AS gross_opening, sum(gross_deduction) AS gross_deduction FROM b GROUP BY 1, 2")
def rekey_sum(spark, sf):
    rows = c_rows(spark, sf).withColumn("sl_no", F.element_at(F.create_map(*[F.lit(x) for kv in {1: 1, 2: 32, 3: 3, 4: 71, 5: 51, 6: 72, 7: 7}.items() for x in kv]), F.col("sl_no")))
    return merges.rekey_sum(rows, ["gross_opening", "gross_deduction"])


@query("sanitize_rows", f"{WITH_D} SELECT doc_id, sl_no, opening_rs, closing_rs FROM d")
def sanitize_rows(spark, sf):
    d = d_rows(spark, sf)
    text = lambda c: numbers.indian_format(F.col(c)).alias(c)
    rows = d.select("doc_id", F.col("sl_no").cast("string").alias("sl_no"), F.lit(2).alias("ord"), text("opening_rs"), text("closing_rs"))
    older = rows.withColumns({"ord": F.lit(1), "opening_rs": F.lit("7")})
    junk = rows.withColumn("sl_no", F.lit("x")).unionByName(rows.withColumn("sl_no", F.lit("0.0")))
    return merges.sanitize(rows.unionByName(older).unionByName(junk), "D", "ord").select("doc_id", "sl_no", "opening_rs", "closing_rs")


_FIX = "SELECT doc_id, sl_no, field, CASE WHEN (doc_id + sl_no) % 3 = 0 THEN value * 1.5 WHEN (doc_id + sl_no) % 3 = 1 THEN 0 ELSE value * 1.001 END AS nv FROM cells WHERE sl_no <= 9"


def _fixes(cells: DataFrame) -> DataFrame:
    k = (F.col("doc_id") + F.col("sl_no")) % 3
    return cells.where("sl_no <= 9").withColumn("value", F.when(k == 0, F.col("value") * 1.5).when(k == 1, 0.0).otherwise(F.col("value") * 1.001))


@query("patch_cells", f"{WITH_D}, f AS ({_FIX}) SELECT c.doc_id, 'D' AS block, c.sl_no, c.field, CASE WHEN coalesce(f.nv, 0) <> 0 AND c.field = 'closing_rs' THEN f.nv ELSE c.value END AS value FROM cells c LEFT JOIN f USING (doc_id, sl_no, field)")
def patch_cells(spark, sf):
    cells = merges.to_cells(d_rows(spark, sf), "D")
    return merges.patch_cells(cells, _fixes(cells), ("closing_rs",))


@query("upsert_cells", f"{WITH_D}, f AS ({_FIX}), half AS (SELECT * FROM cells WHERE sl_no > 4) SELECT doc_id, 'D' AS block, sl_no, field, CASE WHEN nv IS NULL OR nv = 0 OR (value IS NOT NULL AND abs(value - nv) <= greatest(100, 0.02 * greatest(abs(value), abs(nv), 1))) THEN coalesce(value, 0) ELSE nv END AS value FROM half FULL JOIN f USING (doc_id, sl_no, field)")
def upsert_cells(spark, sf):
    cells = merges.to_cells(d_rows(spark, sf), "D")
    return merges.upsert_cells(cells.where("sl_no > 4"), _fixes(cells))


@query("fill_guarded", f"{WITH_D}, f AS (SELECT doc_id, sl_no, field, value * CASE WHEN doc_id % 2 = 0 THEN 30 ELSE 3 END AS nv FROM cells WHERE sl_no NOT IN (4, 7, 11, 15, 16)) SELECT doc_id, 'D' AS block, sl_no, field, CASE WHEN nv IS NULL OR nv = 0 OR (value > 0 AND nv > 20 * value) OR abs(value - nv) <= greatest(100, 0.02 * greatest(abs(value), abs(nv), 1)) THEN value ELSE nv END AS value FROM cells LEFT JOIN f USING (doc_id, sl_no, field)")
def fill_guarded(spark, sf):
    cells = merges.to_cells(d_rows(spark, sf), "D")
    return merges.fill_from(cells, cells.withColumn("value", F.col("value") * F.when(F.col("doc_id") % 2 == 0, 30).otherwise(3)))


_COMP = "SELECT c_custkey AS doc_id, CASE c_custkey % 3 WHEN 0 THEN 'schedule_8.total' WHEN 1 THEN 'note_20.total' ELSE 'face.x' END AS key, CAST(CAST(round(c_acctbal) AS BIGINT) AS DOUBLE) AS opening, CAST(CAST(round(c_acctbal * {0}) AS BIGINT) AS DOUBLE) AS closing FROM customer WHERE c_custkey % {1} <> 0"


@query("component_merge", f"WITH a AS ({_COMP.format('1.5', '5')}), b AS ({_COMP.format('(c_custkey % 4)', '7')}) SELECT doc_id, key, CASE WHEN pick THEN b.opening ELSE a.opening END AS opening, CASE WHEN pick THEN b.closing ELSE a.closing END AS closing FROM (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.key, b.key) AS key, a, b, CASE WHEN a.key IS NULL THEN true WHEN b.key IS NULL THEN false WHEN starts_with(a.key, 'schedule_') THEN true WHEN starts_with(a.key, 'note_') THEN false ELSE b.closing > a.closing END AS pick FROM a FULL JOIN b ON a.doc_id = b.doc_id AND a.key = b.key)")
def component_merge(spark, sf):
    c = table(spark, sf, "customer")
    one = lambda f, n: spark.sql(_COMP.format(f, n).replace("customer WHERE", "{c} WHERE"), c=c)
    return merges.merge_components(one("1.5", 5), one("(c_custkey % 4)", 7))


@query("defect_union_distinct", "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY g, event_id) AS k FROM (SELECT user_id, event_type, event_id, 0 AS g FROM events WHERE value > 50 UNION ALL SELECT user_id, event_type, event_id, 1 FROM events WHERE value <= 50)) WHERE k = 1")
def defect_union_distinct(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return merges.union_distinct_on([e.where("value > 50"), e.where("value <= 50")], ["user_id", "event_type"], ["event_id"]).drop("value")


# --- derived rows and reconciliation


_CLOSURE_D = ", ".join(f"({t}, {s}, {w})" for t, sources in schema.closure("D").items() for s, w in sources.items())


@query("derive_closure", f"{WITH_D} SELECT c.doc_id, 'D' AS block, CAST(target AS INT) AS sl_no, field, CAST(sum(value * weight) AS DOUBLE) AS value FROM cells c JOIN (VALUES {_CLOSURE_D}) t(target, source, weight) ON c.sl_no = t.source GROUP BY c.doc_id, target, field")
def derive_closure(spark, sf):
    return derive.derived_cells(merges.to_cells(d_rows(spark, sf), "D"))


@query("recompute_rows", f"{WITH_D}, n AS (SELECT c.doc_id, CAST(target AS INT) AS sl_no, field, CAST(sum(value * weight) AS DOUBLE) AS value FROM cells c JOIN (VALUES {_CLOSURE_D}) t(target, source, weight) ON c.sl_no = t.source WHERE c.doc_id IN (SELECT doc_id FROM cells WHERE value <> 0 AND sl_no NOT IN (4, 7, 11, 15, 16)) GROUP BY c.doc_id, target, field) SELECT doc_id, 'D' AS block, sl_no, field, value FROM n UNION ALL SELECT doc_id, 'D', sl_no, field, value FROM cells c WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.doc_id = c.doc_id AND n.sl_no = c.sl_no AND n.field = c.field)")
def recompute_rows(spark, sf):
    return derive.recompute(merges.to_cells(d_rows(spark, sf), "D"))


@query("subtotals_rollup", "SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS qty, CAST(grouping(l_returnflag) AS INT) AS g1, CAST(grouping(l_linestatus) AS INT) AS g2 FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def subtotals_rollup(spark, sf):
    return table(spark, sf, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("qty"), F.grouping("l_returnflag").cast("int").alias("g1"), F.grouping("l_linestatus").cast("int").alias("g2"))


@query("residual_argmax", "WITH r AS (SELECT o_custkey, o_orderkey, CAST(round(o_totalprice) AS DOUBLE) AS v FROM orders), s AS (SELECT *, sum(v) OVER (PARTITION BY o_custkey) AS t, row_number() OVER (PARTITION BY o_custkey ORDER BY v DESC, o_orderkey) AS k FROM r) SELECT o_custkey, o_orderkey, CASE WHEN k = 1 AND o_custkey % 100 <= 4 THEN v + o_custkey % 100 / 100.0 * 0 + (t + (o_custkey % 100) * 100 - t) ELSE v END AS v FROM s")
def residual_argmax(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.round("o_totalprice").alias("v"))
    extra = F.when(F.col("o_custkey") % 100 <= 4, (F.col("o_custkey") % 100) * 100.0).otherwise(0.0)
    total = o.groupBy("o_custkey").agg(F.sum("v").alias("anchor"))
    rows = o.join(total, "o_custkey").withColumn("anchor", F.col("anchor") + extra)
    return derive.residual_to_largest(rows, "v", "anchor", "o_orderkey", by=("o_custkey",)).drop("anchor")


@query("scale_to_anchor", "WITH r AS (SELECT o_custkey, o_orderkey, CAST(round(o_totalprice) AS DOUBLE) AS v, sum(CAST(round(o_totalprice) AS DOUBLE)) OVER (PARTITION BY o_custkey) AS s FROM orders), a AS (SELECT *, s * (1 + (o_custkey % 20 - 10) / 100.0) AS anchor FROM r) SELECT o_custkey, o_orderkey, CASE WHEN anchor / s BETWEEN 0.92 AND 1.08 AND v > 0 THEN round_even(v * (anchor / s), 0) ELSE v END AS v FROM a")
def scale_to_anchor(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.round("o_totalprice").alias("v"))
    total = o.groupBy("o_custkey").agg(F.sum("v").alias("anchor")).withColumn("anchor", F.col("anchor") * (1 + (F.col("o_custkey") % 20 - 10) / 100.0))
    return derive.scale_to_anchor(o.join(total, "o_custkey"), "v", "anchor", by=("o_custkey",)).drop("anchor")


@query("impute_residual", "WITH r AS (SELECT o_custkey, o_orderkey, CAST(round(o_totalprice) AS DOUBLE) AS v, sum(CAST(round(o_totalprice) AS DOUBLE)) OVER (PARTITION BY o_custkey) * CASE WHEN o_custkey % 2 = 0 THEN 1.1 ELSE 1 END AS sub, sum(CAST(round(o_totalprice) AS DOUBLE)) OVER (PARTITION BY o_custkey) AS s FROM orders), i AS (SELECT *, sub - (s - v) AS implied FROM r), b AS (SELECT *, sub >= 1e5 AND implied > 0 AND abs(v - implied) / greatest(abs(implied), 1) > 0.02 AS bad FROM i), k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY bad DESC, v DESC, o_orderkey DESC) AS n FROM b) SELECT o_custkey, o_orderkey, round(CASE WHEN bad AND n = 1 THEN implied ELSE v END, 4) AS v, bad AND n = 1 AS imputed FROM k")
def impute_residual(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.round("o_totalprice").alias("v"))
    total = o.groupBy("o_custkey").agg(F.sum("v").alias("sub")).withColumn("sub", F.col("sub") * F.when(F.col("o_custkey") % 2 == 0, 1.1).otherwise(1.0))
    out = derive.impute_from_subtotal(o.join(total, "o_custkey"), "v", "sub", "o_orderkey", least=1e5, by=("o_custkey",))
    return out.select("o_custkey", "o_orderkey", F.round("v", 4).alias("v"), "imputed")


_CELLS_C = ", ".join(schema.C_FIELDS)


@query(
    "row_identity_repair",
    f"""WITH c AS ({_sql(C_ROWS)}), a AS (SELECT *, CASE WHEN dep_up_to_beginning > 0 OR dep_provided_during_year > 0 THEN greatest(0, dep_up_to_beginning + dep_provided_during_year - dep_adjustment) ELSE dep_up_to_end END AS de FROM c),
g AS (SELECT *, CASE WHEN net_opening > 0 AND dep_up_to_beginning > 0 THEN net_opening + dep_up_to_beginning ELSE gross_opening END AS go, CASE WHEN net_closing > 0 AND de > 0 THEN net_closing + de ELSE gross_closing END AS gc FROM a)
SELECT doc_id, sl_no, CASE WHEN h THEN go ELSE gross_opening END AS gross_opening, CASE WHEN h THEN gc ELSE gross_closing END AS gross_closing, CASE WHEN h THEN de ELSE dep_up_to_end END AS dep_up_to_end,
CASE WHEN h AND go > 0 AND gc > 0 THEN greatest(go - gc, 0) ELSE gross_deduction END AS gross_deduction, CASE WHEN h AND go > 0 AND gc > 0 THEN greatest(gc - go, 0) ELSE gross_addition_actual END AS gross_addition_actual
FROM (SELECT *, sl_no BETWEEN 2 AND 7 AS h FROM g)""",
)
def row_identity_repair(spark, sf):
    return derive.repair_identities(c_rows(spark, sf)).select("doc_id", "sl_no", "gross_opening", "gross_closing", "dep_up_to_end", "gross_deduction", "gross_addition_actual")


@query("top2_per_key", "SELECT l_suppkey, list_sort(list(l_extendedprice), 'DESC')[1] AS closing, coalesce(list_sort(list(l_extendedprice), 'DESC')[2], 0) AS opening FROM (SELECT l_suppkey, l_orderkey % 50 AS g, max(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY ALL) GROUP BY l_suppkey")
def top2_per_key(spark, sf):
    best = table(spark, sf, "lineitem").groupBy("l_suppkey", (F.col("l_orderkey") % 50).alias("g")).agg(F.max("l_extendedprice").alias("v"))
    return best.groupBy("l_suppkey").agg(derive.top_two(F.collect_list("v")).alias("x")).select("l_suppkey", "x.closing", "x.opening")


@query("upper_median", "SELECT o_custkey, list_sort(list(o_totalprice))[len(list(o_totalprice)) // 2 + 1] AS m, max(o_totalprice) > 2 * list_sort(list(o_totalprice))[len(list(o_totalprice)) // 2 + 1] AND count(*) >= 8 AND max(o_totalprice) >= 1e5 AS inflated FROM orders GROUP BY o_custkey")
def upper_median(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list("o_totalprice").alias("v"))
    return o.select("o_custkey", derive.upper_median(F.col("v")).alias("m"), derive.is_inflated(F.col("v"), 1e5, 2.0).alias("inflated"))


# --- checks and scores


_D_WIDE = "SELECT doc_id, " + ", ".join(f"coalesce(max(CASE WHEN sl_no = {k} THEN {f} END), 0) AS {f[0]}{k}, max(CASE WHEN sl_no = {k} THEN 1 END) AS t{k}" if f == "opening_rs" else f"coalesce(max(CASE WHEN sl_no = {k} THEN {f} END), 0) AS {f[0]}{k}" for k in range(1, 18) for f in schema.D_FIELDS) + " FROM d GROUP BY doc_id"


def _d_checks_sql() -> str:
    one = lambda code, sl, field, ok, got, want, when="true": f"SELECT doc_id, 'D' AS block, CAST({sl} AS INT) AS sl_no, '{field}' AS field, '{code}' AS code, {ok} AS ok, CAST({got} AS DOUBLE) AS got, CAST({want} AS DOUBLE) AS expected FROM w WHERE {when}"
    some = {k: f"(o{k} > 0 OR c{k} > 0)" for k in range(1, 18)}
    n = " + ".join(f"CAST({s} AS INT)" for s in some.values())
    parts = [one("D_COVERAGE", 0, "", f"({n}) >= 8", f"({n})", 8)]
    for f in schema.D_FIELDS:
        for t, sources in schema.FORMULAS["D"].items():
            want = " + ".join(f"{w} * {f[0]}{k}" for k, w in sources.items())
            parts.append(one(f"D_DERIVED_{t}", t, f, f"abs({f[0]}{t} - ({want})) <= 1", f"{f[0]}{t}", f"({want})", f"t{t} IS NOT NULL"))
    parts += [one("D_ROW_DATA", k, "", some[k], 0, 0) for k in (1, 5, 6, 8, 9, 10, 12, 13, 14, 17)]
    parts += [one("D_NON_NEGATIVE", k, "", "false", f"least(o{k}, c{k})", 0, f"least(o{k}, c{k}) < 0") for k in range(1, 18) if k != 16]
    return f"{WITH_D}, w AS ({_D_WIDE}) " + " UNION ALL ".join(parts)


@query("checks_d", _d_checks_sql())
def checks_d(spark, sf):
    return checks.checks_d(d_rows(spark, sf))


@query("check_score", f"WITH k AS ({_d_checks_sql()}) SELECT doc_id, CAST(count(*) FILTER (ok) AS BIGINT) AS passed, count(*) AS total, round(avg(CAST(ok AS INT)) * 100, 6) AS score_pct, bool_and(ok) AS ok FROM k GROUP BY doc_id")
def check_score(spark, sf):
    return checks.report(checks.checks_d(d_rows(spark, sf))).select("doc_id", "passed", "total", F.round("score_pct", 6).alias("score_pct"), "ok")


@query("identity_check", f"WITH c AS ({_sql(C_ROWS)}) SELECT doc_id, sl_no, 'C_GROSS_CLOSE_ID' AS code, abs(gross_closing - (net_closing + dep_up_to_end)) <= greatest(100, 0.005 * greatest(abs(gross_closing), abs(net_closing + dep_up_to_end), 1)) AS ok FROM c WHERE sl_no BETWEEN 2 AND 7 AND net_closing > 0 AND dep_up_to_end > 0 AND gross_closing > 0 UNION ALL SELECT doc_id, sl_no, 'C_GROSS_MOVE', abs(gross_closing - (gross_opening + gross_addition_reval + gross_addition_actual - gross_deduction)) <= greatest(100, 0.005 * greatest(abs(gross_closing), abs(gross_opening + gross_addition_reval + gross_addition_actual - gross_deduction), 1)) FROM c WHERE sl_no BETWEEN 2 AND 7 AND gross_closing > 0 AND gross_opening > 0")
def identity_check(spark, sf):
    return checks.checks_c(c_rows(spark, sf)).where(F.col("code").isin("C_GROSS_CLOSE_ID", "C_GROSS_MOVE")).select("doc_id", "sl_no", "code", "ok")


@query("order_line_identity", "SELECT o_orderkey, CAST(round(o_totalprice) AS DOUBLE) AS got, CAST(s AS DOUBLE) AS expected, abs(round(o_totalprice) - s) <= greatest(100, 0.005 * greatest(abs(round(o_totalprice)), abs(s), 1)) AS ok FROM orders JOIN (SELECT l_orderkey, sum(CAST(round(l_extendedprice) AS BIGINT)) AS s FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey")
def order_line_identity(spark, sf):
    s = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum(F.round("l_extendedprice").cast("bigint")).cast("double").alias("expected"))
    o = table(spark, sf, "orders").select("o_orderkey", F.round("o_totalprice").alias("got")).join(s, F.col("o_orderkey") == F.col("l_orderkey"))
    return o.select("o_orderkey", "got", "expected", closeness.close_financial(F.col("got"), F.col("expected")).alias("ok"))


@query("audit_verdict", f"{WITH_D}, w AS ({_D_WIDE}), k AS (" + " UNION ALL ".join(f"SELECT doc_id, abs({f[0]}{t} - ({e})) / greatest(abs({e}), 1) <= 0.01 AS ok FROM w WHERE {f[0]}{t} <> 0" for f in schema.D_FIELDS for t, s in schema.FORMULAS["D"].items() for e in [" + ".join(f"{w} * {f[0]}{n}" for n, w in s.items())]) + ") SELECT doc_id, count(*) FILTER (NOT ok) AS failures, CASE WHEN count(*) FILTER (NOT ok) <= 2 THEN 'APPROVED' ELSE 'REJECTED' END AS status FROM k GROUP BY doc_id")
def audit_verdict(spark, sf):
    return checks.verdict(checks.audit_checks(d_rows(spark, sf), "D"))


def _golden(cells: DataFrame) -> DataFrame:
    return cells.withColumn("value", F.col("value") * F.when(F.col("sl_no") % 4 == 0, 1.5).when(F.col("sl_no") % 4 == 1, 1.01).otherwise(1.0))


_GOLD = f"{WITH_D}, g AS (SELECT doc_id, sl_no, field, value * CASE sl_no % 4 WHEN 0 THEN 1.5 WHEN 1 THEN 1.01 ELSE 1.0 END AS expected FROM cells WHERE value <> 0 AND sl_no NOT IN (4, 7, 11, 15, 16)), m AS (SELECT g.*, coalesce(c.value, 0) AS got FROM g LEFT JOIN (SELECT * FROM cells WHERE sl_no % 5 <> 0) c USING (doc_id, sl_no, field)), k AS (SELECT *, CASE WHEN got = 0 THEN abs(expected) < 1000 ELSE abs(got - expected) / greatest(abs(got), abs(expected)) <= 0.02 END AS ok FROM m)"


@query("golden_score", f"{_GOLD} SELECT doc_id, sl_no, field, got, round(expected, 4) AS expected, ok FROM k")
def golden_score(spark, sf):
    cells = merges.to_cells(d_rows(spark, sf), "D")
    return scores.against_golden(cells.where("sl_no % 5 <> 0"), _golden(cells)).select("doc_id", "sl_no", "field", "got", F.round("expected", 4).alias("expected"), "ok")


@query("accuracy_rollup", f"{_GOLD} SELECT doc_id, CASE WHEN grouping(b) = 0 THEN b END AS block, count(*) AS fields, count(*) FILTER (ok) AS passed, round(avg(CAST(ok AS INT)) * 100, 6) AS pct, count(*) FILTER (expected <> 0 AND got = 0) AS missing FROM (SELECT *, 'D' AS b FROM k) GROUP BY ROLLUP (doc_id, b) HAVING doc_id IS NOT NULL")
def accuracy_rollup(spark, sf):
    cells = merges.to_cells(d_rows(spark, sf), "D")
    return scores.accuracy(scores.against_golden(cells.where("sl_no % 5 <> 0"), _golden(cells))).withColumn("pct", F.round("pct", 6))


@query("mapping_pct", f"{WITH_D} SELECT doc_id, round(count(DISTINCT sl_no) / 27 * 100, 6) AS mapping_pct FROM cells WHERE value <> 0 GROUP BY doc_id")
def mapping_pct(spark, sf):
    return scores.mapping_pct(merges.to_cells(d_rows(spark, sf), "D")).withColumn("mapping_pct", F.round("mapping_pct", 6))


@query("fill_counts", f"{WITH_D}, r AS (SELECT doc_id, sl_no, count(*) FILTER (value <> 0 OR sl_no = 2) AS f, count(*) AS n, bool_or(value <> 0 OR sl_no = 2) AS there FROM cells WHERE sl_no NOT IN (4, 7, 11, 15, 16) GROUP BY ALL) SELECT doc_id, 'D' AS block, CAST(sum(f) AS BIGINT) AS filled, CAST(sum(n) AS BIGINT) AS total, count(*) FILTER (there) >= 11 AS rows_ok FROM r GROUP BY doc_id")
def fill_counts(spark, sf):
    return checks.fill_counts(merges.to_cells(d_rows(spark, sf), "D"))


@query("pending_cells", f"{WITH_D}, n AS (SELECT doc_id, sl_no, field, value + 5000 AS expected FROM cells WHERE sl_no % 2 = 0), known AS (SELECT c.doc_id, c.sl_no, c.field, value AS got, expected, CASE WHEN value = 0 THEN 'empty_cell' WHEN NOT (CASE WHEN value = 0 OR expected = 0 THEN abs(value - expected) < 1000 ELSE abs(value - expected) / greatest(abs(value), abs(expected)) <= 0.02 END) THEN 'bs_mismatch' END AS reason FROM cells c JOIN n USING (doc_id, sl_no, field)), empty AS (SELECT doc_id, sl_no FROM cells WHERE sl_no NOT IN (2, 4, 7, 11, 15, 16) GROUP BY ALL HAVING bool_and(value = 0)) SELECT doc_id, 'D' AS block, sl_no, field, got, expected, reason FROM known WHERE reason IS NOT NULL UNION ALL SELECT doc_id, 'D', sl_no, '', 0, NULL, 'row_empty' FROM empty")
def pending_cells(spark, sf):
    cells = merges.to_cells(d_rows(spark, sf), "D")
    return checks.pending_cells(cells, cells.where("sl_no % 2 = 0").withColumn("value", F.col("value") + 5000))


@query("cell_status", "SELECT o_orderkey, CASE WHEN v = 0 THEN 'none' WHEN o_orderkey % 3 = 0 THEN 'red' WHEN o_orderkey % 100 < 80 THEN 'yellow' ELSE 'green' END AS status FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_totalprice END AS v FROM orders)")
def cell_status(spark, sf):
    k = F.col("o_orderkey")
    v = F.when(k % 5 == 0, 0.0).otherwise(F.col("o_totalprice"))
    return table(spark, sf, "orders").select("o_orderkey", checks.cell_status(v, (k % 100).cast("double"), k % 3 != 0).alias("status"))


@query("token_presence", f"{WITH_D}, x AS (SELECT doc_id, count(*) AS total FROM cells WHERE value <> 0 GROUP BY doc_id) SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN total ELSE 0 END AS verified, total, CAST(CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS rate, CASE WHEN doc_id % 2 = 0 THEN 'APPROVED' ELSE 'REJECTED' END AS status FROM x")
def token_presence(spark, sf):
    cells = merges.to_cells(d_rows(spark, sf), "D")
    texts = cells.where("doc_id % 2 = 0 and value <> 0").groupBy("doc_id").agg(F.concat_ws(" ; ", F.collect_list(F.when(F.col("sl_no") % 2 == 0, numbers.indian_format(F.col("value"))).otherwise(numbers.western_format(F.col("value"))))).alias("text"))
    return scores.verified_in_text(cells, texts)


# --- rules, bands, boxes, labels


def _rules(spark: SparkSession) -> DataFrame:
    rows = [("a", 1, s, "R", 1) for s in ("opening", "closing")] + [("a", 2, "opening", "A", 1), ("a", 2, "closing", "N", -1), ("b", 1, "opening", "N", 1), ("b", 1, "closing", "A", -1), ("b", 2, "opening", None, 0)]
    return spark.createDataFrame(rows, rules.RULES)


_KEYS = "SELECT l_suppkey AS doc_id, l_returnflag AS key, CAST(sum(CAST(round(l_extendedprice) AS BIGINT)) AS DOUBLE) AS opening, CAST(sum(CAST(round(l_extendedprice * l_discount) AS BIGINT)) AS DOUBLE) AS closing FROM {lineitem} GROUP BY l_suppkey, l_returnflag"
_RULE_SQL = f"WITH k AS ({_KEYS.format(lineitem='lineitem')}), r(profile, sl_no, side, key, sign) AS (VALUES ('a', 1, 'opening', 'R', 1), ('a', 1, 'closing', 'R', 1), ('a', 2, 'opening', 'A', 1), ('a', 2, 'closing', 'N', -1), ('b', 1, 'opening', 'N', 1), ('b', 1, 'closing', 'A', -1)), e AS (SELECT doc_id, profile, CAST(sl_no AS INT) AS sl_no, CAST(sum(CASE WHEN side = 'opening' THEN opening * sign ELSE 0 END) AS DOUBLE) AS opening, CAST(sum(CASE WHEN side = 'closing' THEN closing * sign ELSE 0 END) AS DOUBLE) AS closing FROM k JOIN r USING (key) GROUP BY doc_id, profile, sl_no), x AS (SELECT * FROM e WHERE opening <> 0 OR closing <> 0)"


def _keys(spark, sf):
    return spark.sql(_KEYS, lineitem=table(spark, sf, "lineitem"))


@query("rule_eval", f"{_RULE_SQL} SELECT doc_id, profile, sl_no, opening, closing FROM x")
def rule_eval(spark, sf):
    return rules.evaluate(_keys(spark, sf), _rules(spark))


@query("profile_argmax", f"{_RULE_SQL}, n AS (SELECT doc_id, profile, count(DISTINCT sl_no) AS covered FROM x GROUP BY ALL) SELECT doc_id, profile, covered FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY covered DESC, profile) AS k FROM n) WHERE k = 1")
def profile_argmax(spark, sf):
    return rules.choose_profile(rules.evaluate(_keys(spark, sf), _rules(spark)), {"a": 0, "b": 1})


@query("rule_search", f"WITH k AS ({_KEYS.format(lineitem='lineitem')}) SELECT doc_id, CAST(1 AS INT) AS sl_no, '+A-N' AS formula, CAST(2 AS INT) AS terms FROM k GROUP BY doc_id HAVING count(*) FILTER (key IN ('A', 'N')) = 2")
def rule_search(spark, sf):
    k = _keys(spark, sf)
    at = lambda key, c: F.max(F.when(F.col("key") == key, F.col(c)))
    targets = k.groupBy("doc_id").agg((at("A", "opening") - at("N", "opening")).alias("opening"), (at("A", "closing") - at("N", "closing")).alias("closing")).where("opening is not null").withColumn("sl_no", F.lit(1))
    return rules.find_formulas(k, targets, tol=1e-9)


@query("tolerance_join", "SELECT p_partkey, n_nationkey FROM part JOIN (SELECT n_nationkey, 900 + n_nationkey * 40.0 AS target FROM nation) ON abs(p_retailprice - target) <= 0.02 * target")
def tolerance_join(spark, sf):
    t = table(spark, sf, "nation").select("n_nationkey", (900 + F.col("n_nationkey") * 40.0).alias("target"))
    return rules.values_near(table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("value")), t).select("p_partkey", "n_nationkey")


_BOX = "SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 10 AS x1, CAST(embedding[2] AS DOUBLE) * 10 AS y1, CAST(embedding[1] AS DOUBLE) * 10 + 0.5 + abs(CAST(embedding[3] AS DOUBLE)) AS x2, CAST(embedding[2] AS DOUBLE) * 10 + 0.5 + abs(CAST(embedding[4] AS DOUBLE)) AS y2 FROM embeddings"


@query("bbox_overlap", f"WITH b AS ({_BOX}) SELECT a.vec_id AS cell_id, b.vec_id AS line_id, round(greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)), 6) AS area FROM b a JOIN b ON a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2 WHERE a.vec_id % 2 = 0 AND b.vec_id % 2 = 1 AND greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) > 0")
def bbox_overlap(spark, sf):
    e = lambda k: F.get("embedding", F.lit(k)).cast("double")
    x, y = e(0) * 10, e(1) * 10
    b = table(spark, sf, "embeddings").select("vec_id", F.array(x, y, x + 0.5 + F.abs(e(2)), y + 0.5 + F.abs(e(3))).alias("bbox")).withColumn("page", F.lit(1))
    cells = b.where("vec_id % 2 = 0").withColumnRenamed("vec_id", "cell_id")
    return spatial.overlapping(cells, b.where("vec_id % 2 = 1").withColumnRenamed("vec_id", "line_id"), 1.0, ("page",)).select("cell_id", "line_id", F.round("area", 6).alias("area"))


@query("fuzzy_top1", "SELECT p_partkey, p_name AS canonical, CAST(100 AS DOUBLE) AS score, false AS needs_review FROM part")
def fuzzy_top1(spark, sf):
    """Part names with their words turned about, found again among all names."""
    part = table(spark, sf, "part")
    names = part.groupBy(F.col("p_name").alias("canonical")).agg(F.min("p_partkey").alias("ordinal")).withColumn("alias", F.upper("canonical"))
    turned = F.array_join(F.reverse(F.split("p_name", " ")), "  ")
    return fuzzy.best_match(part.select("p_partkey", turned.alias("label")), names).drop("label")


@query(
    "header_map_patch",
    "SELECT s_suppkey AS table_id, CAST(col AS INT) AS col, header, field, CAST(c AS DOUBLE) AS confidence FROM supplier CROSS JOIN (VALUES (0, 'Particulars', 'label', 100), (1, 'Opening Balance', 'opening', 100), (2, 'Amount', 'closing', 55)) t(col, header, field, c)",
)
def header_map_patch(spark, sf):
    aliases = spark.createDataFrame([("opening", "opening balance", 0), ("closing", "closing balance", 1), ("label", "particulars", 2)], "canonical string, alias string, ordinal int")
    heads = F.array(F.lit("Particulars"), F.lit("Opening Balance"), F.lit("Amount"))
    cells = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("table_id"), F.posexplode(heads).alias("col", "header"))
    return fuzzy.map_headers(cells, aliases)


#: Labels under which block D's rows stand in written statements.
WRITTEN = {1: "Raw materials", 3: "Stores & spares", 5: "Work in progress", 6: "Finished goods", 8: "Cash and bank", 9: "Sundry debtors", 10: "Loans and advances", 12: "Sundry creditors", 13: "Cash credit", 14: "Other current liabilities", 17: "Unsecured loans"}


def statement_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Block D of every customer as a page of text, closing before opening."""
    names = F.create_map(*[F.lit(x) for kv in WRITTEN.items() for x in kv])
    d = d_rows(spark, sf).where(F.col("sl_no").isin(*WRITTEN))
    line = F.concat_ws(" ", F.element_at(names, F.col("sl_no")), numbers.indian_format(F.col("closing_rs")), numbers.indian_format(F.col("opening_rs")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sl_no", line.alias("line")))), lambda x: x["line"]), "\n")
    return d.groupBy("doc_id").agg(text.alias("text")).select("doc_id", F.lit(1).alias("page_no"), F.concat(F.lit("SCHEDULE 6 inventories\n"), "text").alias("text"))


_READ_D = f"SELECT doc_id, sl_no, opening_rs, closing_rs FROM d WHERE sl_no IN ({', '.join(map(str, WRITTEN))}) AND length(CAST(CAST(opening_rs AS BIGINT) AS VARCHAR)) >= 2 AND length(CAST(CAST(closing_rs AS BIGINT) AS VARCHAR)) >= 2"


@query("statement_extract", f"{WITH_D}, r AS ({_READ_D}) SELECT doc_id, 'D' AS block, sl_no, field, value FROM (SELECT doc_id, sl_no, 'opening_rs' AS field, opening_rs AS value FROM r UNION ALL SELECT doc_id, sl_no, 'closing_rs', closing_rs FROM r) WHERE value <> 0")
def statement_extract(spark, sf):
    return statement.extract_cells(statement_pages(spark, sf))


@query("event_sessions", "WITH e AS (SELECT user_id, ts, event_id, value, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 1 HOUR THEN 1 ELSE 0 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 1 HOUR AS \"end\", count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, k")
def event_sessions(spark, sf):
    s = ingest.sessions(table(spark, sf, "events")).withColumn("total", F.round("total", 4))
    return s.withColumns({"start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz")})


@query("event_windows", "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark, sf):
    w = ingest.windowed(table(spark, sf, "events")).withColumn("total", F.round("total", 4))
    return w.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(
    "stream_page_ingest",
    f"SELECT doc_id, {_TAGS} AS tags, {_UNIT.replace('u,', 'u,')} AS unit, len(list_filter(regexp_extract_all(text, '[0-9,.]+'), lambda x: regexp_matches(x, '[0-9]'))) AS n_tokens FROM (SELECT doc_id, text, lower(text) AS t, replace(lower(text), ' ', '') AS u FROM ({_DOC}))",
)
def stream_page_ingest(spark, sf):
    """``documents`` as a stream of pages, routed as they arrive and written exactly once."""
    source = f"{sf}/documents.parquet"
    # a pattern, as the table may be one file or a folder of files
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(f"{sf}/documents.parque[t]")
    routed = ingest.route(_headed(stream.select("doc_id", "text"), "doc_id")).select("doc_id", F.array_join("tags", ",").alias("tags"), "unit", F.col("n_tokens").cast("bigint").alias("n_tokens"))
    home = shared_path(spark, "ingest")
    ingest.write_available(routed, f"{home}/out", f"{home}/state").awaitTermination()
    return spark.read.schema(routed.schema).parquet(f"{home}/out")
