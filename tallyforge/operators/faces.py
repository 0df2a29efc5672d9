"""What the balance sheet's face says of single rows, and rows held against it.

Each page is read within its row; rows meet what was read by one join on document and number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers
from ..functions.numbers import let
from .schedules import note_pattern

PAIR = "struct<closing:double,opening:double>"


def _first_page(rows: DataFrame) -> DataFrame:
    """(doc_id, opening, closing) of the first page that has a pair ``p``."""
    return rows.groupBy("doc_id").agg(F.min(F.struct("page_no", "p.opening", "p.closing")).alias("b")).select("doc_id", "b.opening", "b.closing")


# --- property, plant and equipment

#: Words of the label, one after the other, and its note numbers. Fixed values.
PROPERTY = ((r"prope\w*", r"plan\w*", r"(?:comprien|equip\w*)", "4", 20), ("property", "plant", "equipment", "[45]", 30))


def property_net(page_text: DataFrame) -> DataFrame:
    """(doc_id, opening, closing) of property, plant and equipment on the face, in rupees.

    Of each page the first of these that has two amounts of at least 50 lakhs (in lakhs: 1,000 lakhs): the label with note 4 in
    misread forms, the label with note 4 or 5, a row of cells that names both words. Closing comes first. The page's
    own unit counts; of several pages the first. Null and empty texts have none."""
    likely = page_text.where(F.contains(F.lower("text"), F.lit("prope")))
    one = likely.select("doc_id", "page_no", F.col("text").alias("t"), numbers.unit_of(F.col("text")).alias("unit"))
    least = F.when(F.col("unit") == "lakhs", 1e8).otherwise(5e6)

    def amount(token: Column) -> Column:
        return F.when(F.col("unit") == "lakhs", numbers.lakhs_decimal(token) * numbers.LAKH).otherwise(numbers.indian_parse(token))

    def pair(closing: Column, opening: Column) -> Column:
        made = let(F.struct(closing.alias("closing"), opening.alias("opening")), lambda p: F.when((p["closing"] >= least) & (p["opening"] >= least), p))
        return made

    def by_label(first: str, second: str, third: str, note: str, gap: int) -> Column:
        pattern = rf"(?i){first}[^\d]{{0,{gap}}}{second}[^\d]{{0,{gap}}}{third}[^\d]*\b{note}\b[^\d]*([\d,.\-]+)\s+([\d,.\-]+)"
        flat = F.regexp_replace("t", "\n", " ")
        return let(F.struct(F.regexp_extract(flat, pattern, 1).alias("c"), F.regexp_extract(flat, pattern, 2).alias("o")), lambda x: pair(amount(x["c"]), amount(x["o"])))

    def by_cells(line: Column) -> Column:
        low = F.replace(F.lower(line), F.lit(" "), F.lit(""))
        here = F.contains(line, F.lit("\t")) & F.contains(low, F.lit("prope")) & (F.contains(low, F.lit("plant")) | F.contains(low, F.lit("plani")))
        cells = F.filter(F.split(line, "\t"), lambda c: F.rlike(c, F.lit(r"\d")) & ~(F.rlike(c, F.lit("[A-Za-z]")) & ~F.rlike(c, F.lit("[,.]"))))
        values = F.filter(F.transform(cells, lambda c: amount(F.trim(c))), lambda v: v >= least)
        return F.when(here, let(values, lambda v: F.when(F.size(v) >= 2, F.struct(F.get(v, F.lit(0)).alias("closing"), F.get(v, F.lit(1)).alias("opening")))))

    rows = F.filter(F.transform(F.split("t", "\n"), by_cells), lambda p: p.isNotNull())
    found = F.coalesce(*[by_label(*p) for p in PROPERTY], F.get(rows, F.lit(0)))
    return _first_page(one.select("doc_id", "page_no", F.explode(F.array_compact(F.array(found))).alias("p")))


# --- provision for income tax


def tax_provision(page_text: DataFrame, most: float = 5e7, ahead: int = 3) -> DataFrame:
    """(doc_id, opening, closing) of the provision for income tax: amounts below ``most`` of its line, else of the next
    lines up to a total; closing first, a single one is closing. The first line that yields one counts."""
    likely = page_text.where(F.rlike(F.lower("text"), F.lit("(?s)provision.*tax|tax.*provision")))

    def taken(line: Column) -> Column:
        some = F.filter(F.transform(F.regexp_extract_all(line, F.lit(r"\d[\d,]*\.?\d*"), F.lit(0)), lambda t: numbers.clean_number(t)), lambda v: (v > 0) & (v < most))
        return let(some, lambda v: F.when(F.size(v) > 0, F.struct(F.get(v, F.lit(0)).alias("closing"), F.coalesce(F.get(v, F.lit(1)), F.lit(0.0)).alias("opening"))))

    has = lambda x, word: F.contains(F.lower(x), F.lit(word))
    lines = F.split("text", "\n")

    def read(line: Column, i: Column) -> Column:
        follow = F.slice(lines, i + 2, F.lit(ahead))
        stop = F.array_position(F.transform(follow, lambda x: has(x, "total") & ~has(x, "provision")), True).cast("int")
        next_ = F.when(stop > 0, F.slice(follow, F.lit(1), stop - 1)).otherwise(follow)
        later = F.get(F.filter(F.transform(next_, taken), lambda p: p.isNotNull()), F.lit(0))
        return F.when(has(line, "provision") & has(line, "income") & has(line, "tax"), F.coalesce(taken(line), later))

    found = F.filter(F.transform(lines, read), lambda p: p.isNotNull())
    return _first_page(likely.select("doc_id", "page_no", F.explode(F.slice(found, F.lit(1), F.lit(1))).alias("p")))


# --- block D held against the face

#: Rows of block D on a face in lakhs, by label and note number. Rows and numbers.
LAKH_FACE = (
    (7, r"in?[vm]\w*tor\w*", 8),
    (9, r"trade\s+receiv\w*", 9),
    (10, r"other\s+current\s+assets", 7),
    (13, r"borr?\w*wings", 16),
    (14, r"other\s+current\s+liabilit\w*", 20),
    (17, r"borr?\w*wings", 13),
)
#: Rows on a face in rupees, by label. Fixed values.
RUPEE_FACE = ((8, r"cash\s*&\s*bank"), (9, r"trade\s*receivable"), (10, r"loans?\s*[&.]\s*advan"))


def face_rows(summary: DataFrame) -> DataFrame:
    """(doc_id, sl_no, lakhs, opening, closing) of block D rows that summary pages (doc_id, text) state, in rupees."""
    low = F.lower("text")
    in_lacs = F.contains(low, F.lit("lac")) & F.rlike(low, F.lit(r"amounts?\s+.{0,6}lacs?|in\s+lacs?"))
    one = summary.select("doc_id", low.alias("low"), in_lacs.alias("lakhs")).withColumn("flat", F.when(F.col("lakhs"), F.regexp_replace("low", "\n", " ")))

    def stated(sl: int, text: str, pattern: str, amount) -> Column:
        """A row by the whole match, found once, of which both amounts are read."""
        pair = lambda m: F.struct(F.lit(sl).alias("sl_no"), amount(F.regexp_extract(m, pattern, 2)).alias("opening"), amount(F.regexp_extract(m, pattern, 1)).alias("closing"))
        return let(F.regexp_extract(text, pattern, 0), lambda m: F.when(m != "", pair(m)))

    in_lakhs = F.array(*[stated(sl, "flat", note_pattern(label, note), numbers.lakhs_to_rupees) for sl, label, note in LAKH_FACE])
    in_rupees = F.array(*[stated(sl, "low", rf"{label}.*?(\d[\d,]{{5,}})\s+(\d[\d,]{{5,}})", numbers.clean_number) for sl, label in RUPEE_FACE])
    rows = one.select("doc_id", "lakhs", F.inline(F.array_compact(F.when(F.col("lakhs"), in_lakhs).otherwise(in_rupees))))
    return rows.where("opening != 0 or closing != 0").select("doc_id", "sl_no", "lakhs", "opening", "closing")


def crosscheck_with_face(d_rows: DataFrame, summary: DataFrame, off: float = 0.1) -> DataFrame:
    """Block D rows (doc_id, sl_no, opening_rs, closing_rs) as the face has them.

    A face in lakhs replaces what it states, and adds rows that are missing; its opening counts from ten lakhs on, or where there is
    none. A face in rupees replaces rows 8 and 9 that are more than ``off`` from it on either side, but not by amounts that are both
    below a lakh, nor row 8 by an opening of more than three times the row's; it adds none. Null amounts count as 0."""
    face = face_rows(summary).withColumnsRenamed({"opening": "__o", "closing": "__c", "lakhs": "__l"})
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    both = d_rows.withColumn("__there", F.lit(True)).join(face, ["doc_id", "sl_no"], "full_outer")
    both = both.where(F.col("__there").isNotNull() | F.col("__l")).withColumns({c: zero(c) for c in ("opening_rs", "closing_rs", "__o", "__c")})
    o, c, new_o, new_c = (F.col(x) for x in ("opening_rs", "closing_rs", "__o", "__c"))
    far = lambda now, new: (new > 0) & (F.abs(now - new) / F.greatest(new, F.lit(1.0)) > off)
    wild = (F.col("sl_no") == 8) & (new_o > 0) & (o > 0) & (new_o > 3 * o)
    in_rupees = ~F.col("__l") & F.col("sl_no").isin(8, 9) & ((new_c >= 1e5) | (new_o >= 1e5)) & ~wild & (far(c, new_c) | far(o, new_o))
    opening = F.when(F.col("__l") & (new_o != 0) & ((new_o > 1e6) | (o == 0) | F.col("__there").isNull()), new_o).when(in_rupees, new_o).otherwise(o)
    closing = F.when(F.col("__l") & (new_c != 0), new_c).when(in_rupees, new_c).otherwise(c)
    return both.withColumns({"opening_rs": opening, "closing_rs": closing}).drop("__there", "__o", "__c", "__l")


def with_total_row(c_rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Block C rows with the nets of row 10 as the fixed assets' total line has them (doc_id, opening, closing)."""
    new = totals.select("doc_id", F.col("opening").alias("__o"), F.col("closing").alias("__c"))
    mine = (F.col("sl_no") == 10) & F.col("__o").isNotNull()
    both = c_rows.join(new, "doc_id", "left")
    return both.withColumns({"net_opening": F.when(mine, F.col("__o")).otherwise(F.col("net_opening")), "net_closing": F.when(mine, F.col("__c")).otherwise(F.col("net_closing"))}).drop("__o", "__c")
