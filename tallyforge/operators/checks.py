"""Accounting identities and coverage as data: a table of checks, scores over it, pending cells.

A block's rows are first pivoted to one row a document (27 rows, a hash aggregation); checks are then
expressions over that row and one ``inline`` makes the table. Nothing is joined with itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.closeness import close_audit, close_financial, close_quality, match_score
from ..plans import schema
from .merges import CELL

CHECK = "struct<block:string,sl_no:int,field:string,code:string,ok:boolean,got:double,expected:double>"


def wide(rows: DataFrame, block: str) -> DataFrame:
    """One row a document with a struct ``r<n>`` of fields for each row of the block (null: absent)."""
    fields = [f for f in schema.FIELDS[block] if f in rows.columns]
    value = F.struct(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in fields])
    n = len(schema.C_LABELS if block == "C" else schema.D_LABELS)
    return rows.groupBy("doc_id").agg(*[F.max(F.when(F.col("sl_no") == k, value)).alias(f"r{k}") for k in range(1, n + 1)])


def _g(sl: int, field: str) -> Column:
    return F.coalesce(F.col(f"r{sl}.{field}"), F.lit(0.0))


def _check(ok: Column, code: str, block: str, sl: int = 0, field: str = "", got: Column | None = None, expected: Column | None = None, when: Column | None = None) -> Column:
    made = F.struct(F.lit(block).alias("block"), F.lit(sl).alias("sl_no"), F.lit(field).alias("field"), F.lit(code).alias("code"), ok.alias("ok"), (F.lit(0.0) if got is None else got).cast("double").alias("got"), (F.lit(0.0) if expected is None else expected).cast("double").alias("expected"))
    return made if when is None else F.when(when, made)


def _table(df: DataFrame, checks: list[Column]) -> DataFrame:
    return df.select("doc_id", F.inline(F.array_compact(F.array(*checks))))


def _sum(terms) -> Column:
    return sum(terms, F.lit(0.0))


def wanted_c() -> list[Column]:
    """Checks of block C over one row a document (``wide``); null where one doesn't apply."""
    g = _g
    filled = _sum(F.when((g(k, "net_closing") > 0) | (g(k, "net_opening") > 0), 1.0).otherwise(0.0) for k in range(2, 8))
    out = [_check(filled >= 3, "C_COVERAGE", "C", got=filled, expected=F.lit(3.0))]
    for k in range(2, 8):
        go, gc, no, nc = (g(k, x) for x in ("gross_opening", "gross_closing", "net_opening", "net_closing"))
        db, dp, da, de = (g(k, x) for x in ("dep_up_to_beginning", "dep_provided_during_year", "dep_adjustment", "dep_up_to_end"))
        moved = go + g(k, "gross_addition_reval") + g(k, "gross_addition_actual") - g(k, "gross_deduction")
        out += [
            _check(close_financial(go, no + db), "C_GROSS_OPEN_ID", "C", k, "gross_opening", go, no + db, (no > 0) & (db > 0) & (go > 0)),
            _check(close_financial(gc, nc + de), "C_GROSS_CLOSE_ID", "C", k, "gross_closing", gc, nc + de, (nc > 0) & (de > 0) & (gc > 0)),
            _check(close_financial(de, db + dp - da), "C_DEP_ROLL", "C", k, "dep_up_to_end", de, db + dp - da, (de > 0) & ((db > 0) | (dp > 0))),
            _check(close_financial(gc, moved), "C_GROSS_MOVE", "C", k, "gross_closing", gc, moved, (gc > 0) & (go > 0)),
            _check(de <= gc * 1.001, "C_DEP_LE_GROSS", "C", k, "dep_up_to_end", de, gc, (nc > 0) & (gc > 0) & (de > 0)),
        ]
    there8, there10 = F.col("r8").isNotNull(), F.col("r8").isNotNull() & F.col("r10").isNotNull()
    for f in ("gross_opening", "gross_closing", "gross_addition_actual", "gross_deduction", "net_opening", "net_closing", "dep_up_to_beginning", "dep_up_to_end"):
        want = _sum(g(k, f) for k in range(2, 8))
        out.append(_check(close_financial(g(8, f), want, strict=True), "C_SUBTOTAL_8", "C", 8, f, g(8, f), want, there8))
    for f in ("net_opening", "net_closing"):
        want = g(1, f) + g(8, f) + g(9, f)
        out.append(_check(close_financial(g(10, f), want, strict=True), "C_TOTAL_10", "C", 10, f, g(10, f), want, there10))
    out.append(_check(g(10, "net_closing") > 1_000_000, "C_TOTAL_SCALE", "C", 10, "net_closing", g(10, "net_closing"), F.lit(1e6), there10))
    return out


def checks_c(rows: DataFrame) -> DataFrame:
    """Block C: coverage, five identities of each asset row, sub-total, total, scale."""
    return _table(wide(rows, "C"), wanted_c())


def wanted_d(may_be_negative: tuple[int, ...] = (16,)) -> list[Column]:
    """Checks of block D over one row a document (``wide``); null where one doesn't apply."""
    g = _g
    some = lambda k: (g(k, "opening_rs") > 0) | (g(k, "closing_rs") > 0)
    filled = _sum(F.when(some(k), 1.0).otherwise(0.0) for k in range(1, 18))
    out = [_check(filled >= 8, "D_COVERAGE", "D", got=filled, expected=F.lit(8.0))]
    for f in schema.D_FIELDS:
        for target, sources in schema.FORMULAS["D"].items():
            want = _sum(g(k, f) * w for k, w in sources.items())
            out.append(_check(close_financial(g(target, f), want, strict=True), f"D_DERIVED_{target}", "D", target, f, g(target, f), want, F.col(f"r{target}").isNotNull()))
    out += [_check(some(k), "D_ROW_DATA", "D", k) for k in (1, 5, 6, 8, 9, 10, 12, 13, 14, 17)]
    for k in range(1, 18):
        if k not in may_be_negative:
            low = F.least(g(k, "opening_rs"), g(k, "closing_rs"))
            out.append(_check(F.lit(False), "D_NON_NEGATIVE", "D", k, "", low, F.lit(0.0), low < 0))
    return out


def checks_d(rows: DataFrame, may_be_negative: tuple[int, ...] = (16,)) -> DataFrame:
    """Block D: coverage, derived rows of both columns, source rows with data, and negative amounts
    (working capital may be negative; pass ``()`` to hold it to the rule as well)."""
    return _table(wide(rows, "D"), wanted_d(may_be_negative))


def face_checks(rows: DataFrame, face: DataFrame, tol: float = 0.03) -> DataFrame:
    """Sums of asset rows against the balance sheet's face (doc_id, opening, closing), within a share."""
    sums = rows.where(F.col("sl_no").between(1, 7)).groupBy("doc_id").agg(F.sum("net_opening").alias("o"), F.sum("net_closing").alias("c")).join(face, "doc_id")
    one = lambda f, got, want: _check(F.abs(got - want) / want <= tol, "FACE_PPE", "C", 8, f, got, want, (got > 0) & (want > 0))
    return _table(sums, [one("net_opening", F.col("o"), F.col("opening")), one("net_closing", F.col("c"), F.col("closing"))])


def audit_checks(rows: DataFrame, block: str, tol: float = 0.01) -> DataFrame:
    """The auditor's view: formulas at a share of the expected amount, only where a total is reported."""
    df, g, out = wide(rows, block), _g, []
    for f in schema.FIELDS[block]:
        for target, sources in schema.FORMULAS[block].items():
            want = _sum(g(k, f) * w for k, w in sources.items())
            out.append(_check(close_audit(g(target, f), want, tol), f"AUDIT_{block}_{target}", block, target, f, g(target, f), want, g(target, f) != 0))
    if block == "C":
        for k in range(1, 10):
            for net, gross, dep in (("net_opening", "gross_opening", "dep_up_to_beginning"), ("net_closing", "gross_closing", "dep_up_to_end")):
                want = g(k, gross) - g(k, dep)
                out.append(_check(close_audit(g(k, net), want, tol), "AUDIT_C_NET", "C", k, net, g(k, net), want, (g(k, net) != 0) & (g(k, gross) != 0)))
    return _table(df, out)


def verdict(checks: DataFrame, most_failures: int = 2) -> DataFrame:
    """(doc_id, failures, status): approved up to a number of failures."""
    return checks.groupBy("doc_id").agg(F.count_if(~F.col("ok")).alias("failures")).withColumn("status", F.when(F.col("failures") <= most_failures, "APPROVED").otherwise("REJECTED"))


def report(checks: DataFrame) -> DataFrame:
    """(doc_id, passed, total, score_pct, ok, failures): percent of passed checks; failures as sorted codes."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("ok"), F.concat_ws(":", "code", F.col("sl_no").cast("string"), "field"))))  # a document has a bounded number of checks
    return checks.groupBy("doc_id").agg(F.count_if("ok").alias("passed"), F.count(F.lit(1)).alias("total"), F.coalesce(F.avg(F.col("ok").cast("int")) * 100, F.lit(100.0)).alias("score_pct"), F.bool_and("ok").alias("ok"), failed.alias("failures"))


def field_checks(cells: DataFrame, candidates: DataFrame) -> DataFrame:
    """Cells against a second reading: match_score and status of each that the reading has."""
    new = candidates.select(*CELL, F.col("value").alias("expected"))
    out = cells.join(new, CELL).withColumn("match_score", match_score(F.col("value"), F.col("expected")))
    return out.select(*CELL, F.col("value").alias("got"), "expected", "match_score", (F.col("match_score") >= 95).alias("status"))


def pending_cells(cells: DataFrame, candidates: DataFrame) -> DataFrame:
    """What still lacks: empty cells and mismatches that a second reading knows, and rows without any amount."""
    new = candidates.where("value != 0").select(*CELL, F.col("value").alias("expected"))
    known = cells.join(new, CELL).withColumn("reason", F.when(F.col("value") == 0, "empty_cell").when(~close_quality(F.col("value"), F.col("expected")), "bs_mismatch")).where("reason is not null")
    form = F.broadcast(schema.template(cells.sparkSession).where("not is_derived and not is_optional").select("block", "sl_no"))
    empty = cells.join(form, ["block", "sl_no"], "left_semi").groupBy("doc_id", "block", "sl_no").agg(F.max(F.col("value") != 0).alias("some")).where("not some")
    empty = empty.select("doc_id", "block", "sl_no", F.lit("").alias("field"), F.lit(0.0).alias("got"), F.lit(None).cast("double").alias("expected"), F.when(F.col("block") == "C", "asset_row_empty").otherwise("row_empty").alias("reason"))
    return known.select(*CELL, F.col("value").alias("got"), "expected", "reason").unionByName(empty)


def fill_counts(cells: DataFrame) -> DataFrame:
    """(doc_id, block, filled, total, rows_ok): numeric cells of source rows, an optional row counting as filled;
    rows_ok: enough source rows have an amount (5 of C 2 to 7, 11 of D's)."""
    form = F.broadcast(schema.template(cells.sparkSession).where("not is_derived"))
    some = (F.col("value") != 0) | F.col("is_optional")
    rows = cells.join(form, ["block", "sl_no"]).groupBy("doc_id", "block", "sl_no").agg(F.count_if(some).alias("f"), F.count(F.lit(1)).alias("n"), F.max(some).alias("row"))
    counted = F.col("row") & ((F.col("block") == "D") | F.col("sl_no").between(2, 7))
    out = rows.groupBy("doc_id", "block").agg(F.sum("f").alias("filled"), F.sum("n").alias("total"), F.count_if(counted).alias("r"))
    return out.withColumn("rows_ok", F.when(F.col("block") == "C", F.col("r") >= 5).otherwise(F.col("r") >= 11)).drop("r")


def cell_status(value: Column, confidence: Column, verified: Column) -> Column:
    """How a cell is to be shown: blank, red (not verified), yellow (confidence below 80), green."""
    return F.when(value == 0, "none").when(~F.coalesce(verified, F.lit(True)), "red").when(F.coalesce(confidence, F.lit(100.0)) < 80, "yellow").otherwise("green")
