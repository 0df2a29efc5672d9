"""Pages to lines, tags, sections and label-value pairs.

A page is (doc_id, page_no, text). Pattern tables are data: (sl_no, ord, pattern), applied to every
line or page by a broadcast join of a checked size, first match by order winning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import numbers

# Phrases by which pages are told apart.
SKIP = (
    "auditor", "accounting policies", "accounting concepts", "revenue recognition", "borrowing cost", "impairment of asset",
    "intangible asset", "contingent liabilit", "foreign currency", "expenditure during construction",
    "profit and loss account", "profit & loss account",
)
ASSET_PAGES = (
    "schedule 5", "schedule: 5", "gross block", "net block", "property, plant", "property.plant", 'block "a"', 'block "d"',
    "tangible assets", "plant and equipment",
)
ASSET_NAMES = ("land", "building", "furniture", "vehicle", "computer")
CURRENT_PAGES = (
    "schedule 6", "schedule: 6", "schedule 7", "schedule: 7", "schedule 8", "schedule: 8", "schedule 9", "schedule: 9",
    "schedule 10", "schedule: 10", "schedule 3", "schedule: 3", "inventories", "trade receivable", "cash & bank", "cash at hand",
    "loans & advance", "current liabilities", "sundry creditor", "secured loan", "unsecured loan", "raw material", "finished good",
    "work in progress", "stores & spare",
)
KEYWORDS = (
    "schedule", "total", "opening", "closing", "balance", "depreciation", "asset", "capital", "loan", "expense", "income", "sales",
    "creditor", "debtor", "inventory", "cash", "bank", "amount", "profit", "loss", "march", "account", "sheet", "provision",
    "sundry", "plant", "machinery", "building", "land",
)
MOST_PATTERNS = 10_000


def _any(t: Column, phrases: tuple[str, ...]) -> Column:
    """Whether a text has one of the phrases; the first that is there ends the search."""
    found = F.lit(False)
    for p in phrases:
        found = found | F.contains(t, F.lit(p))
    return found


def _hits(t: Column, phrases: tuple[str, ...]) -> Column:
    return sum((F.contains(t, F.lit(p)).cast("int") for p in phrases), F.lit(0))


def page_tags(text: Column) -> Column:
    """array of ``skip``; or ``summary``; or any of ``block_c`` and ``block_d``."""
    t = F.lower(F.coalesce(text, F.lit("")))
    face = _any(t, ("balance sheet as at", "balance sheet as on")) & ~_any(t, ("schedules annexed", "notes to financial", "note 4"))
    face = face & _any(t, ("total assets", "total nssets", "equity and liabilit", "sources of funds", "application of funds"))
    assets = _any(t, ASSET_PAGES) | ((_hits(t, ASSET_NAMES) >= 3) & t.rlike("[0-9,]{6,}"))
    detail = F.array_compact(F.array(F.when(assets, "block_c"), F.when(_any(t, CURRENT_PAGES), "block_d")))
    return F.when(_any(t, SKIP), F.array(F.lit("skip"))).when(face, F.array(F.lit("summary"))).otherwise(detail)


def is_skipped(text: Column) -> Column:
    """Whether ``page_tags`` would be ``skip``, without looking for the others."""
    return _any(F.lower(F.coalesce(text, F.lit(""))), SKIP)


def quality_ok(text: Column) -> Column:
    """Three keywords at least, or five numbers of four digits."""
    t = F.lower(F.coalesce(text, F.lit("")))
    found = F.filter(F.regexp_extract_all(t, F.lit("[0-9,]{5,}"), F.lit(0)), lambda x: F.length(F.regexp_replace(x, ",", "")) >= 4)
    return (_hits(t, KEYWORDS) >= 3) | (F.size(found) >= 5)


def is_scanned(text: Column) -> Column:
    """A page without a text layer to speak of."""
    return F.length(F.trim(F.coalesce(text, F.lit("")))) < 20


def summary_page(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no): the first page that is a balance sheet in lakhs, else the first in the form of funds."""
    t = F.lower("text")
    lacs = t.rlike(r"balance\s+sheet") & t.rlike(r"in\s+(lacs?|lakhs?)")
    funds = _any(t, ("sources of funds", "application of funds"))
    return pages.groupBy("doc_id").agg(F.coalesce(F.min(F.when(lacs, F.col("page_no"))), F.min(F.when(funds, F.col("page_no")))).alias("page_no")).where("page_no is not null")


def pages_with(pages: DataFrame, phrase: str) -> DataFrame:
    """(doc_id, page_nos): sorted numbers of the pages that contain a phrase."""
    return pages.where(F.contains(F.lower("text"), F.lit(phrase.lower()))).groupBy("doc_id").agg(F.array_sort(F.collect_set("page_no")).alias("page_nos"))


def unit_vote(pages: DataFrame) -> DataFrame:
    """(doc_id, unit): lakhs if a balance sheet says so, else the unit of most pages, the one seen first on ties."""
    t = F.lower("text")
    p = pages.withColumn("unit", numbers.unit_of(F.col("text"))).withColumn("lacs", t.rlike(r"balance\s+sheet") & t.rlike(r"in\s+(lacs?|lakhs?)"))
    votes = p.groupBy("doc_id", "unit").agg(F.count(F.lit(1)).alias("n"), F.min("page_no").alias("first"), F.max("lacs").alias("lacs"))
    best = votes.groupBy("doc_id").agg(F.max("lacs").alias("lacs"), F.max(F.struct("n", (-F.col("first")).alias("o"), "unit")).alias("b"))
    return best.select("doc_id", F.when(F.col("lacs"), "lakhs").otherwise(F.col("b.unit")).alias("unit"))


def lines(pages: DataFrame, text: str = "text") -> DataFrame:
    """pages exploded to lines (line_no from 0), without the text."""
    return pages.select(*[c for c in pages.columns if c != text], F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("line_no", "line"))


def carry_section(rows: DataFrame, start: Column, by: list[str], order: str, name: str = "section") -> DataFrame:
    """rows with the last header at or before each; start: the header's name, null for other lines."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(start, ignorenulls=True).over(w))


def between(rows: DataFrame, start: str, end: str, by: list[str], order: str) -> DataFrame:
    """Lines strictly between a header and the next end line; both are patterns of the lower-case line."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    t = F.lower("line")
    mark = F.when(t.rlike(start), "in").when(t.rlike(end), "out")
    rows = rows.withColumn("__at", F.last(mark, ignorenulls=True).over(w)).withColumn("__mark", mark)
    return rows.where("__at = 'in' and __mark is null").drop("__at", "__mark")


def within_lines(rows: DataFrame, header: str, n: int, by: list[str], order: str) -> DataFrame:
    """Lines less than n after the last header line, itself included."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("__h", F.last(F.when(F.lower("line").rlike(header), F.col(order)), ignorenulls=True).over(w)).where(F.col(order) - F.col("__h") < n).drop("__h")


def amounts_or_following(rows: DataFrame, amounts: str, by: list[str], order: str, ahead: int = 3, stop: Column | None = None) -> DataFrame:
    """rows with ``found``: the line's own amounts, else those of the next lines that have some, up to a line that stops."""
    out = F.when(F.size(amounts) > 0, F.col(amounts))
    w = Window.partitionBy(*by).orderBy(order)
    open_ = F.lit(True)
    for k in range(1, ahead + 1):
        if stop is not None:
            open_ = open_ & ~F.coalesce(F.lead(stop, k).over(w), F.lit(False))
        out = out.when(open_ & (F.size(F.lead(amounts, k).over(w)) > 0), F.lead(amounts, k).over(w))
    return rows.withColumn("found", out)


def extract_patterns(rows: DataFrame, patterns: DataFrame, by: list[str], text: str = "line", order: tuple[str, ...] = ("line_no",)) -> DataFrame:
    """(by, sl_no, first, second, ...): the two groups of the first pattern that matches, by pattern order and then
    place. patterns is (sl_no, ord, pattern), broadcast if it is small."""
    few = F.broadcast(patterns) if patterns.count() <= MOST_PATTERNS else patterns
    hit = rows.crossJoin(few).where(F.rlike(F.col(text), F.col("pattern")))
    value = lambda k: F.expr(f"regexp_extract(`{text}`, pattern, {k})")
    first = F.min(F.struct("ord", *order, value(1).alias("first"), value(2).alias("second")))
    return hit.groupBy(*by, "sl_no").agg(first.alias("x")).select(*by, "sl_no", "x.first", "x.second")


def last_pair(rows: DataFrame, by: list[str], order: str, amounts: str = "amounts", least: float = 8e7) -> DataFrame:
    """(by, first, second): of the last line with exactly two amounts above a bound."""
    ok = (F.size(amounts) == 2) & F.forall(amounts, lambda v: v > least)
    return rows.where(ok).groupBy(*by).agg(F.max(F.struct(order, amounts)).alias("x")).select(*by, F.get(f"x.{amounts}", F.lit(0)).alias("first"), F.get(f"x.{amounts}", F.lit(1)).alias("second"))


def largest_pair(rows: DataFrame, by: list[str], order: str, amounts: str = "amounts") -> DataFrame:
    """(by, first, second): of the two-amount line with the largest sum, the first on ties."""
    total = F.get(amounts, F.lit(0)) + F.get(amounts, F.lit(1))
    return rows.where(F.size(amounts) == 2).groupBy(*by).agg(F.max(F.struct(total.alias("t"), (-F.col(order)).alias("o"), F.col(amounts).alias("v"))).alias("x")).select(*by, F.get("x.v", F.lit(0)).alias("first"), F.get("x.v", F.lit(1)).alias("second"))


def section_sum(rows: DataFrame, start: str, end: str, take: str, skip: str, by: list[str], order: str, unit: Column) -> DataFrame:
    """(by, opening, closing): the first two amounts of the section's matching lines, summed, closing first."""
    part = between(rows, start, end, by, order).where(F.lower("line").rlike(take) & ~F.lower("line").rlike(skip)).withColumn("a", numbers.line_amounts(F.col("line"), unit))
    at = lambda k: F.coalesce(F.sum(F.get("a", F.lit(k))), F.lit(0.0))
    return part.groupBy(*by).agg(at(1).alias("opening"), at(0).alias("closing"))


def continued(rows: DataFrame, start: str, by: list[str], order: str) -> DataFrame:
    """(by, first line's order, text): lines joined with those that follow them up to the next line that starts a row."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__s", F.last(F.when(F.col("line").rlike(start), F.col(order)), ignorenulls=True).over(w)).where("__s is not null")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "line"))), lambda x: x["line"]), " ")  # the lines of one row of a form
    return rows.groupBy(*by, F.col("__s").alias(order)).agg(joined.alias("text"))
