"""Schedules and notes read by tables of specifications.

A specification says which lines belong to a component (its section, a label, what to skip), which
amounts count (a band in rupees) and which of them are closing and opening. Lines are exploded once,
joined with the specifications and reduced to one row a component: adding a note is adding a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import numbers
from . import derive, pages

SPECS = "key string, ord int, section string, label string, skip string, low double, high double, pick string"
L = numbers.LAKH

#: Components of lakh notes. Labels, and bands in rupees outside of which a token is no amount.
LAKH_SPECS = (
    ("note_16.cash_credit", 0, "", r"cash\s*cred", "", 500 * L, 10_000 * L, "first_two"),
    ("note_16.current_maturities", 0, "", r"current maturit", "", 50 * L, 8_000 * L, "max_min"),
    ("note_17.micro_creditors", 0, r"17\s+trade\s+payable", r"dues to micro", "", 100 * L, 2_000 * L, "max_min"),
    ("note_17.other_creditors", 0, r"17\s+trade\s+payable", r"creditors other", r"dues to micro", 500 * L, 20_000 * L, "min_max"),
    ("note_18.salary_wages_payable", 0, "", r"salary.*wages.*payable", "", 50 * L, 2_000 * L, "max_min"),
    ("note_20.total", 0, r"20\s+other\s+current\s+liabilit", r"\btotal\b", "tds", 50 * L, 1_000 * L, "first_two"),
    ("note_20.advance_from_customers", 0, "", r"advance.*customer", "", 10 * L, 3_000 * L, "max_min"),
    ("note_9.ageing_bucket", 0, "", r"trade receiv", "", 500 * L, 2_000 * L, "first_both"),
    ("note_9.trade_receivables_as_at", 0, "", r"trade\s+receivables\s+as\s+at\s+31", "", 100 * L, 1e13, "last_two"),
    ("note_11a.current_tax_assets_net", 0, "", r"income tax.*receiv", "", 10 * L, 500 * L, "first_two"),
)
#: Components of rupee schedules. Fixed values.
RUPEE_SPECS = (
    ("schedule_3.cash_credit", 0, "", r"cash\s+credit", "", 1_000.0, 1e13, "first_two"),
    ("schedule_3.unsecured_loan", 0, "", r"from\s+others", "", 1_000.0, 1e13, "first_two"),
    ("schedule_6.goods_in_transit", 0, "", r"goods\s+in\s+transit", "", 1.0, 1e13, "first_two"),
    ("schedule_8.cash_on_hand", 0, "", r"cash\s+at\s+hand", "", 1_000.0, 1e13, "first_two"),
    ("schedule_8.bank", 0, "", r"balances\s+at\s+schedule\s+banks", "", 1_000.0, 1e13, "first_two"),
    ("schedule_8.total", 0, r"schedule\s*:?\s*8\b", r"[0-9]", "", 1e6, 1e8, "largest_pair"),
    ("schedule_9.subsidy_receivable", 0, "", r"subsidy\s+receiv", "", 1_000.0, 1e13, "first_two"),
    ("schedule_9.budgetary_support", 0, "", r"budgetary\s+support\s+receiv", "", 1_000.0, 1e13, "first_two"),
    ("schedule_9.total", 0, r"schedule\s*:?\s*9\b", r"[0-9]", r"amt credit|subsidy|receivable|advances for|balances with|security|prepaid|income tax", 8e7, 1e13, "last_pair"),
    ("schedule_10.creditors_raw_material", 0, "", r"for\s+raw\s+material", "", 1_000.0, 1e13, "first_two"),
    ("schedule_10.creditors_expenses", 0, "", r"for\s+expenses", "", 1_000.0, 1e13, "first_two"),
    ("schedule_10.advance_from_customers", 0, "", r"advance\s+from\s+customers", "", 1_000.0, 1e13, "first_two"),
    ("schedule_10.statutory_dues", 0, "", r"statutory\s+dues", "", 1_000.0, 1e13, "first_two"),
    ("schedule_10.excise_duty_refund", 0, "", r"excise\s+duty\s+refund", "", 1_000.0, 1e13, "first_two"),
    ("schedule_10.provision_income_tax", 0, "", r"provision.*income.*tax", "", 1.0, 5e7, "first_two"),
    ("face.trade_receivables", 0, r"balance\s+sheet\s+as\s+at", r"trade\s+receiv.*\b7\b", r"hypothecation|total", 1e4, 5e7, "first_two"),
    ("face.loans_and_advances", 0, r"balance\s+sheet\s+as\s+at", r"loans?.*advan.*\b9\b", r"hypothecation|total", 1e4, 1e13, "first_two"),
    ("face.unsecured_loan", 0, r"balance\s+sheet\s+as\s+at", r"unsecured\s+loan.*\b4\b", r"hypothecation|total", 1e4, 1e8, "first_two"),
)
#: Components of the face by label and note number. The numbers.
NOTE_ROWS = (
    ("face.trade_receivables", r"trade\s+receiv\w*", 9),
    ("face.borrowings_current", r"borr?\w*wings", 16),
    ("face.borrowings_non_current", r"borr?\w*wings", 13),
    ("face.inventories", r"inventor\w*", 8),
)


def note_pattern(label: str, note: int) -> str:
    """A label, its note number, and two amounts."""
    return rf"{label}[^\d]{{0,20}}\b{note}\s+([\d,.:]+)[^\d]{{1,9}}([\d,.]+)"


#: Components found by one pattern over a page's flattened text, closing before opening, in lakhs. Those written out.
PAGE_PATTERNS = (
    *((key, note_pattern(label, note)) for key, label, note in NOTE_ROWS),
    ("note_9.trade_receivables_total", r"trade\s+receiv\w*[^\d]{0,40}total[^\d]*([\d,.]+)\s+([\d,.]+)"),
    ("face.other_current_assets", r"other\s+current\s+assets[^\d]*(?:\b7\b)?[^\d]*([\d,.]+)\s+([\d,.]+)"),
    ("note_11b.other_current_assets_total", r"11\s*b[^\d]{0,40}other\s+current\s+ass[^\d]{0,80}?total[^\d]*([\d,.]+)\s+([\d,.]+)"),
)
#: Block letters of the older asset schedule and their rows. Fixed values.
LETTER_ROWS = {"A": 2, "B": 2, "C": 7, "D": 3, "E": 5, "F": 4, "G": 5, "H": 7}
#: Columns of the asset grid that make up each row. Fixed values.
GRID_ROWS = {2: (0, 1), 3: (3,), 4: (5,), 5: (6,), 7: (2, 4)}
#: Labels of the lakh note's asset lines. Fixed values.
NOTE_LABELS = ((1, r"^land\b"), (2, r"^building\b"), (3, r"^plant\s+and\s+equipment\b"), (4, r"^vehicles?\b"), (5, r"^(computers?|office)\b"), (6, r"^lab\s*equip"), (7, r"^furniture"))


def _pick(v: Column, pick: Column) -> Column:
    """struct(closing, opening) of a line's amounts by the name of a rule; null if it has too few."""
    at = lambda k: F.get(v, F.lit(k))
    two = F.slice(v, F.lit(1), F.lit(2))
    pair = lambda c, o: F.struct(c.alias("closing"), o.alias("opening"))
    enough = F.size(v) >= 2
    return (
        F.when((pick == "first_two") & enough, pair(at(0), at(1)))
        .when((pick == "last_two") & enough, pair(F.element_at(v, -2), F.element_at(v, -1)))
        .when((pick == "max_min") & enough, pair(F.array_max(two), F.array_min(two)))
        .when((pick == "min_max") & enough, pair(F.array_min(two), F.array_max(two)))
        .when((pick == "first_both") & (F.size(v) >= 1), pair(at(0), at(0)))
        .when(pick.isin("largest_pair", "last_pair") & (F.size(v) == 2), pair(at(0), at(1)))
    )


def extract_components(page_text: DataFrame, specs: tuple = RUPEE_SPECS, unit: str = "rupees", section_end: str = r"schedule\s*:?\s*\d+\b|^\s*\d{1,2}\s+[a-z]") -> DataFrame:
    """(doc_id, key, opening, closing) of pages (doc_id, page_no, text) by line specifications.

    A section runs from its header to the next header of any kind. Of several lines the first counts;
    for ``largest_pair`` the one with the largest sum, for ``last_pair`` the last. All-zero pairs are left out."""
    spark: SparkSession = page_text.sparkSession
    table = spark.createDataFrame([(k, *x[:5], float(x[5]), float(x[6]), x[7]) for k, x in enumerate(specs)], f"spec int, {SPECS}")
    rows = pages.lines(page_text).withColumn("low_line", F.lower("line"))
    w = Window.partitionBy("doc_id", "page_no").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("head", F.last(F.when(F.rlike("low_line", F.lit(section_end)) | F.contains("low_line", F.lit("balance sheet as at")), F.col("low_line")), ignorenulls=True).over(w))

    def wanted(section: str, label: str, skip: str) -> Column:
        here = F.rlike("low_line", F.lit(label))
        if skip:
            here = here & ~F.rlike("low_line", F.lit(skip))
        return here & F.coalesce(F.rlike("head", F.lit(section)), F.lit(False)) & (F.col("head") != F.col("low_line")) if section else here

    # literal patterns, compiled once; what a line is wanted for goes on alone
    of = F.array_compact(F.array(*[F.when(wanted(*x[2:5]), F.lit(k)) for k, x in enumerate(specs)]))
    hit = rows.select("doc_id", "page_no", "line_no", "low_line", F.explode(of).alias("spec")).join(F.broadcast(table), "spec")  # some dozen specifications
    tail = F.expr("regexp_replace(low_line, concat('^.*?(', label, ')'), '')")
    source = F.when(F.col("label") == "[0-9]", F.col("low_line")).otherwise(tail)
    amounts = F.filter(F.transform(numbers.line_tokens(source), lambda t: numbers.token_to_rupees(t, F.lit(unit))), lambda v: (v >= F.col("low")) & (v <= F.col("high")))
    # one value of an array, so that the amounts are read once
    pair = F.filter(F.transform(F.array(amounts), lambda v: _pick(v, F.col("pick"))), lambda p: p.isNotNull() & ((p["opening"] != 0) | (p["closing"] != 0)))
    hit = hit.select("doc_id", "key", "ord", "pick", "page_no", "line_no", F.explode(pair).alias("p"))
    rank = F.when(F.col("pick") == "largest_pair", -(F.col("p.opening") + F.col("p.closing"))).when(F.col("pick") == "last_pair", -(F.col("page_no") * 1e6 + F.col("line_no"))).otherwise(0.0)
    best = F.min(F.struct("ord", rank.alias("rank"), "page_no", "line_no", "p"))
    return hit.groupBy("doc_id", "key").agg(best.alias("b")).select("doc_id", "key", "b.p.opening", "b.p.closing")


def extract_page_pairs(page_text: DataFrame, patterns: tuple = PAGE_PATTERNS) -> DataFrame:
    """(doc_id, key, opening, closing) in rupees of patterns over whole pages in lakhs, the first page that has each."""
    from ..functions.text import one_line, pair_in

    # a page is flattened once, and searched once for each pattern
    found = numbers.let(one_line(F.col("text")), lambda flat: F.array(*[F.struct(F.lit(k).alias("key"), pair_in(flat, p).alias("p")) for k, p in patterns]))
    some = F.filter(found, lambda x: (x["p"]["opening"] != 0) | (x["p"]["closing"] != 0))
    rows = page_text.select("doc_id", "page_no", F.explode(some).alias("x"))
    return rows.groupBy("doc_id", "x.key").agg(F.min(F.struct("page_no", "x.p")).alias("b")).select("doc_id", "key", "b.p.opening", "b.p.closing")


def all_components(page_text: DataFrame) -> DataFrame:
    """Lakh notes and rupee schedules of every document, merged; other current assets of the face are its loans
    less its receivables where a document has both."""
    from .merges import merge_components

    votes = pages.unit_vote(page_text)
    with_unit = page_text.join(votes, "doc_id")
    in_lakhs, in_rupees = with_unit.where(F.col("unit") == "lakhs").drop("unit"), with_unit.where(F.col("unit") != "lakhs").drop("unit")
    notes = merge_components(extract_components(in_lakhs, LAKH_SPECS, "lakhs"), extract_page_pairs(in_lakhs))
    both = merge_components(notes, extract_components(in_rupees))
    side = lambda key, c: F.max(F.when(F.col("key") == key, F.col(c)))
    face = both.groupBy("doc_id").agg(*[side(f"face.{k}", c).alias(f"{n}_{c}") for k, n in (("loans_and_advances", "l"), ("trade_receivables", "t")) for c in ("opening", "closing")])
    rest = face.where("l_closing is not null").select("doc_id", F.lit("face.other_current_assets").alias("key"), *[F.greatest(F.lit(0.0), F.col(f"l_{c}") - F.coalesce(f"t_{c}", F.lit(0.0))).alias(c) for c in ("opening", "closing")])
    return both.join(rest.select("doc_id", "key"), ["doc_id", "key"], "left_anti").unionByName(rest)


def asset_letter_rows(page_text: DataFrame) -> DataFrame:
    """Block C rows of lines ``Block "X"``: of the last seven amounts gross opening, (gross), depreciation at start,
    of the year, at end, net closing, net opening; rows of one number are summed."""
    rows = pages.lines(page_text).withColumn("letter", F.upper(F.regexp_extract("line", "(?i)block\\s*[\"']?([A-H])[\"']?", 1))).where("letter != ''")
    v = F.transform(numbers.line_tokens(F.regexp_replace("line", "(?i)^.*?block\\s*[\"']?[A-H][\"']?", "")), numbers.clean_number)
    rows = rows.withColumn("v", F.when(F.size(v) >= 7, F.slice(v, -7, 7))).where("v is not null")
    at = lambda k: F.get("v", F.lit(k))
    swap = (at(5) > at(0)) & (at(6) < at(0))
    rows = rows.select("doc_id", F.element_at(F.create_map(*[F.lit(x) for kv in LETTER_ROWS.items() for x in kv]), F.col("letter")).alias("sl_no"), at(0).alias("gross_opening"), at(2).alias("dep_up_to_beginning"), at(3).alias("dep_provided_during_year"), at(4).alias("dep_up_to_end"), F.when(swap, at(6)).otherwise(at(5)).alias("net_closing"), F.when(swap, at(5)).otherwise(at(6)).alias("net_opening"))
    rows = rows.withColumn("gross_closing", F.col("net_closing") + F.col("dep_up_to_end"))
    rows = rows.withColumn("gross_addition_actual", F.greatest(F.lit(0.0), F.col("gross_closing") - F.col("gross_opening")))
    fields = [c for c in rows.columns if c not in ("doc_id", "sl_no")]
    return rows.groupBy("doc_id", "sl_no").agg(*[F.sum(f).alias(f) for f in fields])


def trailing_subtotal(amounts: Column, least: float = 5e7) -> Column:
    """The total that a row of nine amounts or more repeats at its end; null if it doesn't."""
    n = F.size(amounts)
    last, before = F.try_element_at(amounts, F.lit(-1)), F.try_element_at(amounts, F.lit(-2))
    return F.when((n >= 9) & (last == before) & (last >= least), last)


def gross_subtotals(page_text: DataFrame, opening_label: str = r"1st?apr.*2023|aprl.*2023", closing_label: str = "2024", least: float = 1e8) -> DataFrame:
    """(doc_id, opening, closing): sub-totals of balance rows, by labels of the first and last day; the last row counts."""
    rows = pages.lines(page_text).withColumn("low", F.regexp_replace(F.lower("line"), " ", "")).where(F.contains("low", F.lit("balance")))
    rows = rows.withColumn("sub", trailing_subtotal(numbers.tab_amounts(F.col("line")))).where(F.col("sub") >= least)
    first = F.rlike("low", F.lit(opening_label))
    last = lambda cond: F.max(F.when(cond, F.struct("page_no", "line_no", "sub")))["sub"]
    return rows.groupBy("doc_id").agg(last(first).alias("opening"), last(~first & F.rlike("low", F.lit(closing_label))).alias("closing"))


def asset_grid_rows(page_text: DataFrame, opening_year: str = "2023", closing_year: str = "2024") -> DataFrame:
    """Block C rows of a grid with eight asset columns: what each balance line is follows from the header above it.

    Lines are typed by the section carried forward, the first line of each type counts, and five rows are
    sums of columns; gaps are filled by the identities of a row."""
    rows = pages.lines(page_text).withColumn("low", F.regexp_replace(F.lower("line"), r"\s", ""))
    has = lambda x: F.contains("low", F.lit(x))
    head = F.when(has("netblock"), "net").when(has("grossblock"), "gross").when(has("accumulated") & has("charg"), "dep")
    rows = pages.carry_section(rows, head, ["doc_id", "page_no"], "line_no").withColumn("section", F.coalesce("section", F.lit("start")))
    raw = numbers.tab_amounts(F.col("line"))
    rows = rows.withColumn("raw", raw).where((F.size("raw") >= 3) & ~has("netblock") & ~has("grossblock"))
    balance, first_day = has("balance") & (F.size("raw") >= 8), F.rlike("low", F.lit(f"(1stapr|aprl).*{opening_year}"))
    kind = (
        F.when(has("accumulated") & has("charg"), "dep_provided_during_year")
        .when(has("180days") & has("lessthan"), "gross_deduction")
        .when(has("180days") & has("morethan"), "gross_addition_actual")
        .when(balance & (F.col("section") == "start") & has(opening_year), "net_opening")
        .when(balance & (F.col("section") == "net") & has(closing_year), "net_closing")
        .when(balance & (F.col("section") == "dep") & first_day, "dep_up_to_beginning")
        .when(balance & (F.col("section") == "gross") & first_day, "gross_opening")
        .when(balance & F.col("section").isin("dep", "gross") & has(closing_year) & ~derive.is_inflated(F.col("raw")), "gross_closing")
    )
    typed = rows.withColumn("kind", kind).where("kind is not null")
    first = typed.groupBy("doc_id", "kind").agg(F.min(F.struct("page_no", "line_no", F.slice(derive.right_aligned(F.col("raw")), 1, 8).alias("v")))["v"].alias("v"))
    grid = F.array(*[F.struct(F.lit(sl).alias("sl_no"), derive.merge_positions(F.col("v"), list(at)).alias("value")) for sl, at in GRID_ROWS.items()])
    cells = first.select("doc_id", "kind", F.explode(grid).alias("g"))
    fields = ("gross_opening", "gross_addition_actual", "gross_deduction", "gross_closing", "dep_up_to_beginning", "dep_provided_during_year", "net_opening", "net_closing")
    wide = cells.groupBy("doc_id", F.col("g.sl_no").alias("sl_no")).agg(*[F.coalesce(F.max(F.when(F.col("kind") == f, F.col("g.value"))), F.lit(0.0)).alias(f) for f in fields])
    wide = wide.where("net_opening != 0 or net_closing != 0").withColumns({"gross_addition_reval": F.lit(0.0), "dep_adjustment": F.lit(0.0), "dep_up_to_end": F.col("dep_up_to_beginning") + F.col("dep_provided_during_year")})
    return derive.repair_identities(wide, force_gross=False)


def net_pair(v: Column) -> Column:
    """struct(opening, closing) of the two neighbours among a note row's amounts that are likest in size.

    Amounts of a row that repeats its first one at the third place are closing, opening, closing."""
    pairs = F.zip_with(F.slice(v, F.lit(1), F.greatest(F.size(v) - 1, F.lit(0))), F.slice(v, F.lit(2), F.greatest(F.size(v) - 1, F.lit(0))), lambda a, b: F.struct((F.least(a, b) / F.greatest(a, b, F.lit(1e-9))).alias("r"), a.alias("opening"), b.alias("closing")))
    pairs = F.filter(pairs, lambda p: p["r"] >= 0.25)
    best = F.get(F.reverse(F.array_sort(pairs)), F.lit(0))
    repeats = (F.size(v) >= 3) & (F.abs(F.get(v, F.lit(0)) - F.get(v, F.lit(2))) < F.greatest(F.get(v, F.lit(0)), F.lit(1.0)) * 0.005)
    return F.when(repeats, F.struct(F.get(v, F.lit(1)).alias("opening"), F.get(v, F.lit(0)).alias("closing"))).otherwise(F.struct(F.coalesce(best["opening"], F.lit(0.0)).alias("opening"), F.coalesce(best["closing"], F.lit(0.0)).alias("closing")))


def asset_note_rows(page_text: DataFrame) -> DataFrame:
    """Block C rows of a lakh note: label lines with their own amounts or those of the next line.

    The first two amounts are net closing and opening; the charge is the fourth if it explains their difference;
    of what follows the eighth the largest two are gross closing and opening. Rows of one number are summed."""
    lacs = page_text.where(F.rlike(F.lower("text"), F.lit(r"in\s+lacs?|amounts?.{0,6}lacs?")) & F.rlike(F.lower("text"), F.lit("property[.,]?\\s*plant")))
    rows = pages.lines(lacs).withColumn("name", F.trim(F.regexp_replace(F.regexp_replace(F.lower("line"), "[^a-z0-9\\s]", " "), r"\s+", " ")))
    tokens = F.filter(F.transform(numbers.line_tokens(F.col("line")), lambda t: numbers.lakhs_decimal(numbers.normalize_lakhs_token(t))), lambda v: v > 0)
    rows = pages.amounts_or_following(rows.withColumn("a", tokens), "a", ["doc_id", "page_no"], "line_no", ahead=1)
    sl = F.lit(None).cast("int")
    for n, pattern in reversed(NOTE_LABELS):
        sl = F.when(F.rlike("name", F.lit(pattern)), n).otherwise(sl)
    rows = rows.withColumn("sl_no", sl).where("sl_no is not null and size(found) >= 2").withColumn("v", derive.without_outliers(F.col("found")))
    at = lambda k: F.get("v", F.lit(k))
    big = F.reverse(F.array_sort(F.filter(F.when(F.size("v") > 8, F.slice("v", 9, 100)).otherwise(F.slice("v", 7, 100)), lambda x: x >= 50)))
    explained = F.abs(at(0) - at(1) - at(3)) <= F.greatest(F.lit(2.0), at(0) * 0.02)
    rupees = lambda x: F.coalesce(x, F.lit(0.0)) * L
    rows = rows.select("doc_id", "sl_no", rupees(at(0)).alias("net_closing"), rupees(at(1)).alias("net_opening"), rupees(F.when(explained, at(3))).alias("dep_provided_during_year"), rupees(F.get(big, F.lit(0))).alias("gross_closing"), rupees(F.get(big, F.lit(1))).alias("gross_opening"))
    left = lambda g, n: F.when((F.col(g) > 0) & (F.col(n) > 0), F.greatest(F.lit(0.0), F.col(g) - F.col(n))).otherwise(0.0)
    rows = rows.withColumns({"dep_up_to_end": left("gross_closing", "net_closing"), "dep_up_to_beginning": left("gross_opening", "net_opening")})
    fields = [c for c in rows.columns if c not in ("doc_id", "sl_no")]
    return rows.groupBy("doc_id", "sl_no").agg(*[F.sum(f).alias(f) for f in fields])


def work_in_progress(page_text: DataFrame) -> DataFrame:
    """(doc_id, opening, closing) of capital work in progress: the last two different amounts of its note's total line."""
    rows = pages.lines(page_text).withColumn("low", F.lower("line"))
    rows = pages.between(rows, r"capital\s+work", r"^\s*\d{1,2}\s*:?\s+(?!.*capital)[a-z]", ["doc_id", "page_no"], "line_no").where(F.rlike("low", F.lit(r"\btotal\b")) & ~F.rlike("low", F.lit(r"ageing|period\s+of")))
    lakhs = F.filter(F.transform(numbers.line_tokens(F.col("line")), lambda t: numbers.lakhs_decimal(numbers.normalize_lakhs_token(t))), lambda v: v.between(500, 20_000))
    rows = rows.withColumn("v", derive.keep_last_kept(lakhs)).where("size(v) >= 2")
    return rows.groupBy("doc_id").agg(F.min(F.struct("page_no", "line_no", "v"))["v"].alias("v")).select("doc_id", (F.element_at("v", -2) * L).alias("opening"), (F.element_at("v", -1) * L).alias("closing"))


def cash_from_face(page_text: DataFrame, most: float = 5e8, times: float = 20.0) -> DataFrame:
    """(doc_id, opening, closing): notes 10A and 10B of the face together; implausible sums are left out."""
    pairs = extract_page_pairs(page_text, (("a", r"cash\s+and\s+cash\w*[^\d]*10A[^\d]*([\d,.]+)\s+([\d,.]+)"), ("b", r"bank\s+balances\s+other[^\d]*10B[^\d]*([\d,.]+)\s+([\d,.]+)")))
    out = pairs.groupBy("doc_id").agg(F.sum("opening").alias("opening"), F.sum("closing").alias("closing"))
    return out.where((F.col("opening") <= most) & (F.col("closing") <= most) & ~((F.col("closing") > 0) & (F.col("opening") > times * F.col("closing"))))


def inventory_note(page_text: DataFrame) -> DataFrame:
    """(doc_id, sl_no, opening, closing) of stock lines in schedule order: raw material, work in progress, finished."""
    rows = pages.lines(page_text).where(F.rlike(F.lower("line"), F.lit(r"stock\s+in\s+hand"))).withColumn("v", F.transform(numbers.line_tokens(F.regexp_extract("line", r"(?i)stock\s+in\s+hand(.*)", 1)), numbers.clean_number)).where("size(v) >= 2")
    w = Window.partitionBy("doc_id").orderBy("page_no", "line_no")
    sl = F.get(F.array(F.lit(1), F.lit(5), F.lit(6)), F.row_number().over(w) - 1)
    return rows.withColumn("sl_no", sl).where("sl_no is not null").select("doc_id", "sl_no", F.get("v", F.lit(1)).alias("opening"), F.get("v", F.lit(0)).alias("closing"))


def face_net(page_text: DataFrame, pattern: str = r"property[^\d]{0,30}plant[^\d]{0,30}equipment[^\d]*\b[45]\b[^\d]*([\d,.\-]+)\s+([\d,.\-]+)") -> DataFrame:
    """(doc_id, opening, closing) of property on the face, in the page's unit; amounts below its least are no match."""

    def read(x: Column) -> Column:
        at = lambda k: numbers.token_to_rupees(F.regexp_extract(x["flat"], f"(?i){pattern}", k), x["unit"])
        return F.struct(at(1).alias("closing"), at(2).alias("opening"), F.when(x["unit"] == "lakhs", 1e8).otherwise(5e6).alias("least"))

    # a page is flattened once, and its unit is asked for only where the pattern is
    flat = F.transform(F.array(F.regexp_replace("text", r"\s+", " ")), lambda t: F.struct(t.alias("flat"), F.rlike(t, F.lit(f"(?i){pattern}")).alias("here")))
    one = F.transform(F.filter(flat, lambda x: x["here"]), lambda x: F.struct(x["flat"], numbers.unit_of(F.col("text")).alias("unit")))
    rows = page_text.select("doc_id", "page_no", F.inline(F.filter(F.transform(one, read), lambda x: (x["closing"] >= x["least"]) & (x["opening"] >= x["least"]))))
    return rows.groupBy("doc_id").agg(F.min(F.struct("page_no", "opening", "closing")).alias("b")).select("doc_id", "b.opening", "b.closing")


def other_liabilities(page_text: DataFrame) -> DataFrame:
    """(doc_id, opening, closing): advances, statutory dues and excise of schedule 10, summed; creditors, provisions
    and totals don't count."""
    rows = pages.lines(page_text)
    out = pages.section_sum(rows, r"schedule\s*:?\s*10\b", r"schedule\s*:?\s*(?!10\b)\d+", r"advance\s*from\s*customers?|statutory\s+dues?|excise\s+duty\s+refund", r"sundry creditor|provision|total", ["doc_id", "page_no"], "line_no", F.lit("rupees"))
    return out.groupBy("doc_id").agg(F.min(F.struct("page_no", "opening", "closing")).alias("b")).select("doc_id", "b.opening", "b.closing").where("opening > 0")


def total_nets(page_text: DataFrame, least: float = 5e7) -> DataFrame:
    """(doc_id, opening, closing) of the fixed assets' line ``Total (a)``: its last two amounts, closing first."""
    rows = pages.lines(page_text).where(F.rlike(F.lower("line"), F.lit(r"total\s*\(a\)")))
    rows = rows.withColumn("v", F.transform(numbers.line_tokens(F.col("line")), numbers.clean_number)).where((F.size("v") >= 2) & (F.try_element_at("v", F.lit(-1)) > least))
    return rows.groupBy("doc_id").agg(F.min(F.struct("page_no", "line_no", "v"))["v"].alias("v")).select("doc_id", F.element_at("v", -1).alias("opening"), F.element_at("v", -2).alias("closing"))


def form_rows_d(page_text: DataFrame) -> DataFrame:
    """Block D rows of a filled form: number, item, opening and closing at the end of the line; the last of each counts."""
    text = page_text.where(F.contains(F.lower("text"), F.lit("block d"))).withColumn("text", F.regexp_replace("text", r"\ninstitutions", " institutions"))
    rows = pages.lines(text).withColumn("line", F.trim("line"))
    line = r"^(\d{1,2})\s+(.+?)\s+(-?[\d,]+)\s+(-?[\d,]+)$"
    at = lambda k: F.regexp_extract("line", line, k)
    rows = rows.where(F.rlike("line", F.lit(line))).select("doc_id", "page_no", "line_no", at(1).cast("int").alias("sl_no"), numbers.signed_amount(at(3)).alias("opening_rs"), numbers.signed_amount(at(4)).alias("closing_rs")).where("sl_no between 1 and 17")
    return rows.groupBy("doc_id", "sl_no").agg(F.max(F.struct("page_no", "line_no", "opening_rs", "closing_rs")).alias("b")).select("doc_id", "sl_no", "b.opening_rs", "b.closing_rs")


def form_rows_c(page_text: DataFrame) -> DataFrame:
    """Block C rows of a filled form: a row goes on over lines until the next number and label.

    Eleven amounts are the fields in their order; with four to ten the first two are gross, the last two net,
    and depreciation is their difference. The row's own number is no amount."""
    from ..plans import schema

    start = r"(?i)^\d{1,2}\s+(land|building|plant|transport|computer|pollution|others|sub|capital|total)"
    rows = pages.continued(pages.lines(page_text.where(F.contains(F.lower("text"), F.lit("block c")))), start, ["doc_id", "page_no"], "line_no")
    body = F.regexp_replace("text", r"(?i)^\d{1,2}\s+(sub-total\(2 to 7\)|total\(1\+8\+9\)|[^\d]+)", "")
    v = F.transform(F.regexp_extract_all(body, F.lit(r"-?[\d,]*\d[\d,]*"), F.lit(0)), numbers.signed_amount)
    rows = rows.select("doc_id", F.regexp_extract("text", r"^(\d{1,2})", 1).cast("int").alias("sl_no"), v.alias("v"))
    total = F.col("sl_no").isin(8, 10)
    rows = rows.where(F.when(total, F.size("v") >= 4).otherwise(F.size("v") >= 5))
    at, full = (lambda k: F.coalesce(F.get("v", F.lit(k)), F.lit(0.0))), F.size("v") >= 11
    short = {"gross_opening": at(0), "gross_closing": F.when(total, F.element_at("v", -3)).otherwise(at(1)), "net_opening": F.element_at("v", -2), "net_closing": F.element_at("v", -1)}
    short |= {"dep_up_to_end": F.when(total, 0.0).otherwise(F.greatest(F.lit(0.0), at(1) - F.element_at("v", -1))), "dep_up_to_beginning": F.when(total, 0.0).otherwise(F.greatest(F.lit(0.0), at(0) - F.element_at("v", -2)))}
    return rows.select("doc_id", "sl_no", *[F.when(full & ~total, at(k)).otherwise(short.get(f, F.lit(0.0))).alias(f) for k, f in enumerate(schema.C_FIELDS)])


def cascade(*parsers: DataFrame) -> DataFrame:
    """Of each document the rows of the first reading that has any; every reading is made once."""
    out = None
    for k, part in enumerate(parsers):
        part = part.withColumn("__k", F.lit(k))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    first = F.min("__k").over(Window.partitionBy("doc_id"))  # a document has some dozen rows
    return out.withColumn("__first", first).where("__k = __first").drop("__k", "__first")


def split_decimal_sum(v: Column, skip: tuple[float, float] = (43.0, 47.0)) -> Column:
    """The sum of an amount row whose decimals may stand apart: a small value followed by one from 10 to 99 is
    one amount; values within the skipped band don't count."""
    start = F.struct(F.lit(0.0).alias("total"), F.lit(None).cast("double").alias("held"))

    def step(acc: Column, x: Column) -> Column:
        joined = acc["held"].isNotNull() & (acc["held"] < 10) & (x >= 10) & (x < 100)
        return F.struct(F.when(joined, acc["total"] + acc["held"] + x / 100).otherwise(acc["total"] + F.coalesce(acc["held"], F.lit(0.0))).alias("total"), F.when(joined, F.lit(None).cast("double")).otherwise(x).alias("held"))

    kept = F.filter(v, lambda x: ~x.between(*skip))
    return F.aggregate(kept, start, step, lambda acc: acc["total"] + F.coalesce(acc["held"], F.lit(0.0)))
