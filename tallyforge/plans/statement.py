"""Whole plans: pages to cells, reconciliation, the closed loop of filling and checking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numbers
from ..operators import checks, derive, forms, merges, notes, pages, schedules
from ..session import shared_path
from . import schema

PATTERNS = "block string, sl_no int, ord int, pattern string"

#: Labels of face and schedule lines, each with the closing amount before the opening one. Fixed values.
FACE_PATTERNS = (
    ("D", 1, 0, r"(?i)(?:raw materials?|stock in hand)[^0-9]*([0-9][0-9,.]+)\s+([0-9][0-9,.]+)"),
    ("D", 3, 0, r"(?i)stores?\s*(?:&|and)?\s*spares?[^0-9]*([0-9][0-9,.]+)\s+([0-9][0-9,.]+)"),
    ("D", 5, 0, r"(?i)work[\s-]in[\s-]progress[^0-9]*([0-9][0-9,.]+)\s+([0-9][0-9,.]+)"),
    ("D", 6, 0, r"(?i)finished goods[^0-9]*([0-9][0-9,.]+)\s+([0-9][0-9,.]+)"),
    ("D", 8, 0, r"(?i)cash (?:and|&|in hand|at hand)[^0-9]*([0-9][0-9,.]+)\s+([0-9][0-9,.]+)"),
    ("D", 9, 0, r"(?i)(?:trade receivables?|sundry debtors?)[^0-9]*([0-9][0-9,.]+)\s+([0-9][0-9,.]+)"),
    ("D", 10, 0, r"(?i)(?:other current assets?|loans? (?:&|and) advances?)[^0-9]*([0-9][0-9,.]+)\s+([0-9][0-9,.]+)"),
    ("D", 12, 0, r"(?i)(?:sundry creditors?|trade payables?)[^0-9]*([0-9][0-9,.]+)\s+([0-9][0-9,.]+)"),
    ("D", 13, 0, r"(?i)cash credit[^0-9]*([0-9][0-9,.]+)\s+([0-9][0-9,.]+)"),
    ("D", 14, 0, r"(?i)other current liabilities[^0-9]*([0-9][0-9,.]+)\s+([0-9][0-9,.]+)"),
    ("D", 17, 0, r"(?i)(?:unsecured loans?|long[\s-]term borrowings?|from others)[^0-9]*([0-9][0-9,.]+)\s+([0-9][0-9,.]+)"),
)
#: Pages of a file that ``run_batch`` writes; reading a page costs far more than its bytes tell Spark.
PAGES_OF_FILE = 5_000
#: Lines of ageing under receivables, which add up to row 9.
AGEING = r"(?i)^\s*(?:more|less) than six months[^0-9]*([0-9][0-9,.]+)\s+([0-9][0-9,.]+)"


def extract_cells(page_text: DataFrame, patterns: DataFrame | None = None) -> DataFrame:
    """Cells of pages (doc_id, page_no, text): of each row the first pattern that matches on the first routed page.

    Pages tagged ``skip`` are left out; amounts are in the unit that their page states. A table of patterns
    (block, sl_no, ord, pattern) is a dictionary: it is read by the driver, so that each is compiled once."""
    known = [tuple(r) for r in patterns.select("block", "sl_no", "ord", "pattern").collect()] if patterns is not None else list(FACE_PATTERNS)
    routed = page_text.where(~pages.is_skipped(F.col("text"))).withColumn("unit", numbers.unit_of(F.col("text")))
    rows = pages.lines(routed)
    pair = lambda p: F.struct(F.regexp_extract("line", p, 1).alias("c"), F.regexp_extract("line", p, 2).alias("o"))
    found = [F.when(F.rlike("line", F.lit(p)), F.struct(F.lit(b).alias("block"), F.lit(sl).alias("sl_no"), F.lit(k).alias("ord"), pair(p).alias("x"))) for b, sl, k, p in known]
    some = rows.where(F.rlike("line", F.lit(r"[0-9][0-9,.]+\s+[0-9][0-9,.]+"))) if patterns is None else rows
    hit = some.select("doc_id", "page_no", "line_no", "unit", F.inline(F.array_compact(F.array(*found))))
    amount = lambda x: numbers.token_to_rupees(x, F.col("unit"))
    first = F.min(F.struct("ord", "page_no", "line_no", "unit", "x"))
    found = hit.groupBy("doc_id", "block", "sl_no").agg(first.alias("b")).select("doc_id", "block", "sl_no", "b.unit", "b.x")
    found = found.select("doc_id", "block", "sl_no", F.lit(0).alias("prio"), amount(F.col("x.o")).alias("opening"), amount(F.col("x.c")).alias("closing"))
    ages = rows.where(F.rlike("line", F.lit(AGEING))).select("doc_id", *[amount(F.regexp_extract("line", AGEING, k)).alias(n) for k, n in ((1, "closing"), (2, "opening"))])
    debtors = ages.groupBy("doc_id").agg(F.sum("opening").alias("opening"), F.sum("closing").alias("closing")).select("doc_id", F.lit("D").alias("block"), F.lit(9).alias("sl_no"), F.lit(1).alias("prio"), "opening", "closing")
    both = found.unionByName(debtors).withColumnsRenamed({"opening": "opening_rs", "closing": "closing_rs"}).unpivot(["doc_id", "block", "sl_no", "prio"], ["opening_rs", "closing_rs"], "field", "value")
    return merges.first_nonzero(both, merges.CELL, ["prio"]).where("value != 0")


def extract_assets(page_text: DataFrame) -> DataFrame:
    """Block C rows of pages (doc_id, page_no, text): of each document those of the first reading that has any, in
    the order filled form, lines by block letter, grid with eight columns, lakh note."""
    kept = page_text.where(~pages.is_skipped(F.col("text")))
    read = (schedules.form_rows_c, schedules.asset_letter_rows, schedules.asset_grid_rows, _note_rows)
    rows = schedules.cascade(*[f(kept) for f in read])
    return rows.select("doc_id", "sl_no", *[F.coalesce(F.col(f), F.lit(0.0)).alias(f) for f in schema.C_FIELDS])


def _note_rows(page_text: DataFrame) -> DataFrame:
    """Rows of the lakh note, of each number those of the first page that has it."""
    first = F.min(F.struct("page_no", *notes.FIELDS)).alias("b")
    return notes.asset_note(page_text).groupBy("doc_id", "sl_no").agg(first).select("doc_id", "sl_no", *[f"b.{f}" for f in notes.FIELDS])


def reconcile(c_rows: DataFrame, cells_d: DataFrame, face: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Block C rows and block D cells made consistent: row identities, face anchors (doc_id, opening, closing),
    derived rows, identities and derived rows once more."""
    c_rows = derive.repair_identities(derive.cap_depreciation(c_rows))
    if face is not None:
        c_rows = c_rows.join(face.withColumnsRenamed({"opening": "__o", "closing": "__c"}), "doc_id", "left").withColumns({x: F.coalesce(x, F.lit(0.0)) for x in ("__o", "__c")})
        assets = F.col("sl_no").between(1, 7)
        rest, part = c_rows.where(~assets), c_rows.where(assets)
        for value, anchor in (("net_opening", "__o"), ("net_closing", "__c")):
            part = derive.repair_identities(derive.residual_to_largest(derive.scale_to_anchor(part, value, anchor), value, anchor, "sl_no"))
        c_rows = part.unionByName(rest).drop("__o", "__c")
    cells_c = derive.recompute(merges.to_cells(c_rows, "C"))
    c_rows = derive.repair_identities(merges.to_rows(cells_c, "C"))
    return merges.to_rows(derive.recompute(merges.to_cells(c_rows, "C")), "C"), derive.recompute(cells_d)


def reconcile_rows(rows: DataFrame, face: DataFrame | None = None) -> DataFrame:
    """As ``reconcile``, on rows of both blocks (``forms.rows``), which stay where their document is."""
    rows = derive.repair_identities(derive.cap_depreciation(forms.filled(rows, "C")))
    if face is not None:
        part, rest = rows.where("block = 'C' and sl_no between 1 and 7 and net_closing is not null"), rows.where("not (block = 'C' and sl_no between 1 and 7 and net_closing is not null)")
        part = part.join(face.withColumnsRenamed({"opening": "__o", "closing": "__c"}), "doc_id", "left").withColumns({x: F.coalesce(x, F.lit(0.0)) for x in ("__o", "__c")})
        for value, anchor in (("net_opening", "__o"), ("net_closing", "__c")):
            part = derive.repair_identities(derive.residual_to_largest(derive.scale_to_anchor(part, value, anchor), value, anchor, "sl_no"))
        rows = part.drop("__o", "__c").unionByName(rest)
    return forms.recompute(derive.repair_identities(forms.recompute(rows)))


def supervise(cells: DataFrame, candidates: DataFrame, rounds: int = 5) -> tuple[DataFrame, DataFrame, int]:
    """Cells filled from a second reading and derived anew until no pending cell changes, or the rounds are over.

    Each round's cells and pending cells are written once to the folder that executors share (a checkpoint would make
    them twice); only documents with pending cells are worked on again. Returns cells, pending cells and the number
    of rounds."""
    before, done = None, 0
    cells = forms.stored(cells, "round")
    pending = forms.stored(checks.pending_cells(cells, candidates), "pending")
    for done in range(1, rounds + 1):
        open_docs = pending.select("doc_id").distinct()
        part = derive.recompute(merges.fill_from(cells.join(open_docs, "doc_id", "left_semi"), candidates.join(open_docs, "doc_id", "left_semi")))
        cells = forms.stored(cells.join(open_docs, "doc_id", "left_anti").select(*merges.CELL, "value").unionByName(part.select(*merges.CELL, "value")), "round")
        pending = forms.stored(checks.pending_cells(cells, candidates), "pending")
        now = pending.count()
        if now == 0 or now == before:
            break
        before = now
    return cells, pending, done


def run_batch(page_text: DataFrame, least_rate: float = 0.85) -> dict[str, DataFrame]:
    """All documents of page_text in one plan: cells of both blocks on the whole template, checks, scores and verification."""
    page_text.sparkSession.conf.set("spark.sql.maxPlanStringLength", "100000")  # the driver keeps descriptions of plans, and these would be megabytes each
    # pages are written once: each reading below goes over them, and would carry in its plan, several times, how they are made
    page_text = forms.stored(page_text, "pages", PAGES_OF_FILE)
    # so are the few cells found, which what follows uses several times
    found = forms.stored(extract_cells(page_text).unionByName(merges.to_cells(extract_assets(page_text), "C").where("value != 0")), "found")
    assets = found.where("block = 'C'")
    cells = forms.cells_of(forms.rows(forms.derived(forms.of_all(page_text.select("doc_id"), found))))
    has_assets = cells.join(assets.select("doc_id").distinct(), "doc_id", "left_semi")
    table = checks.checks_d(merges.to_rows(cells, "D")).unionByName(checks.checks_c(merges.to_rows(has_assets, "C")))
    from ..operators.scores import verified_in_text

    texts = page_text.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda x: x["text"]), "\n").alias("text"))  # a document's pages
    return {"cells": cells, "checks": table, "report": checks.report(table), "fill": checks.fill_counts(cells), "verified": verified_in_text(found, texts, least_rate)}
