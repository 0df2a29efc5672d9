"""The form as one array a document, in the order of ``forms.PLACES``; null where a document lacks a cell.

An attempt over forms is one pass of array operations over batches of documents: as expressions over rows or columns of
cells it is more code than the JVM compiles, and costs a thousand times as much a document. Results are those of
``statement.reconcile_rows``, ``attempts.repair`` and ``forms.judged``, which say in SQL what is done here; amounts compare
as Spark's do (NaN equals itself and is larger than all others)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import schema
from . import forms
from .merges import CELL

SIZE = len(forms.PLACES)
FORM = "array<double>"
CELLS = "array<struct<at:int,value:double>>"
_C = len(schema.C_LABELS) * len(schema.C_FIELDS)  # block C's cells come first
_AT = {f: i for i, f in enumerate(schema.C_FIELDS)}


def of_cells(cells: DataFrame, to: str = "cells") -> DataFrame:
    """(doc_id, cells): places and amounts of each document's cells (doc_id, block, sl_no, field, value) that are on the form."""
    one = F.when(F.col("__at").isNotNull() & F.col("value").isNotNull(), F.struct(F.col("__at").alias("at"), "value"))  # a list takes no nulls
    return cells.select("doc_id", forms.place().alias("__at"), F.col("value").cast("double").alias("value")).groupBy("doc_id").agg(F.collect_list(one).alias(to))  # of a form


def empty(docs: DataFrame) -> DataFrame:
    """(doc_id, form): the form of each document (doc_id), all of its cells 0."""
    return docs.select("doc_id").distinct().select("doc_id", F.array_repeat(F.lit(0.0), SIZE).alias("form"))


def absent(of: DataFrame, column: str = "cells") -> DataFrame:
    """(doc_id, form): forms that have the cells of ``of_cells`` and no others."""
    kind = dict(of.dtypes)["doc_id"]

    def make(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _to_arrow(*_scattered(batch.column(1)))], ["doc_id", "form"])

    return of.select("doc_id", column).mapInArrow(make, f"doc_id {kind}, form {FORM}")


def cells_of(of: DataFrame) -> DataFrame:
    """Cells of forms (doc_id, form)."""
    part = lambda k, to: F.element_at(F.array(*[F.lit(p[k]) for p in forms.PLACES]), F.col("at") + 1).alias(to)
    return of.select("doc_id", F.posexplode("form").alias("at", "value")).where("value is not null").select("doc_id", part(0, "block"), part(1, "sl_no"), part(2, "field"), "value").select(*CELL, "value")


def attempted(active: DataFrame, fixes: DataFrame | None = None, mapped: DataFrame | None = None, face: DataFrame | None = None) -> DataFrame:
    """(doc_id, form, rate, passed): forms patched by fixes, repaired, and judged.

    fixes and mapped: (doc_id, cells) by ``of_cells``; face: (doc_id, opening, closing).
    Documents meet by merge, as their few bytes on disk would make Spark broadcast cells many times as large."""
    have = active.select("doc_id", "form")
    for name, cells in (("fixes", fixes), ("mapped", mapped)):
        if cells is not None:
            have = have.join(cells.select("doc_id", F.col("cells").alias(name)).hint("merge"), "doc_id", "left")
    if face is not None:
        have = have.join(face.select("doc_id", *[F.coalesce(F.col(x).cast("double"), F.lit(0.0)).alias(x) for x in ("opening", "closing")]).hint("merge"), "doc_id", "left")
    names = have.columns

    def attempt(batches):
        import pyarrow as pa

        for batch in batches:
            got = dict(zip(names, batch.columns, strict=True))
            v, there = _from_arrow(got["form"])
            if "fixes" in got:
                new, some = _scattered(got["fixes"])
                v = np.where(there & some & (new != 0), new, v)
            anchors = [np.asarray(got[x].fill_null(0.0)) for x in ("opening", "closing")] if "opening" in got else None
            with np.errstate(all="ignore"):
                repair(v, there, _scattered(got["mapped"]) if "mapped" in got else None, anchors)
                rate, passed, judged = judge(v, there)
            yield pa.RecordBatch.from_arrays([got["doc_id"], _to_arrow(v, there), pa.array(rate, mask=~judged), pa.array(passed, mask=~judged)], ["doc_id", "form", "rate", "passed"])

    return have.mapInArrow(attempt, f"doc_id {dict(active.dtypes)['doc_id']}, form {FORM}, rate double, passed boolean")


def _from_arrow(column) -> tuple[np.ndarray, np.ndarray]:
    """Amounts (0 where there is none) and which cells are there: a row for each place of the form."""
    flat = column.flatten()
    v, there = np.asarray(flat.fill_null(0.0)), np.asarray(flat.is_valid())
    return np.array(v.reshape(-1, SIZE).T, order="C"), np.array(there.reshape(-1, SIZE).T, order="C")  # copies, which can be written to


def _to_arrow(v: np.ndarray, there: np.ndarray):
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, SIZE, dtype=np.int32)), pa.array(v.T.ravel(), mask=~there.T.ravel()))


def _scattered(column) -> tuple[np.ndarray, np.ndarray]:
    """As ``_from_arrow``, of a column of ``of_cells``. Of a cell that comes twice the larger amount."""
    import pyarrow.compute as pc

    cells, n = column.flatten(), len(column)
    at = np.asarray(cells.field("at")).astype(np.int64) * n + np.asarray(pc.list_parent_indices(column)).astype(np.int64)
    v, there = np.full(SIZE * n, -np.inf), np.zeros(SIZE * n, bool)
    np.maximum.at(v, at, np.asarray(cells.field("value")))
    there[at] = True
    v[~there] = 0.0
    return v.reshape(SIZE, n), there.reshape(SIZE, n)


# --- comparisons as Spark's


def _gt(a: np.ndarray, b) -> np.ndarray:
    return ~(a <= b) & ~np.isnan(b)


def _le(a: np.ndarray, b) -> np.ndarray:
    return ~_gt(a, b)


def _close(a: np.ndarray, b: np.ndarray, strict: bool = False) -> np.ndarray:
    """As ``closeness.close_financial``."""
    return _le(np.abs(a - b), 1.0 if strict else np.maximum(100.0, 0.005 * np.maximum(np.maximum(np.abs(a), np.abs(b)), 1.0)))


# --- repair


def _blocks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Views of both blocks: row, field, document."""
    return x[:_C].reshape(len(schema.C_LABELS), len(schema.C_FIELDS), -1), x[_C:].reshape(len(schema.D_LABELS), len(schema.D_FIELDS), -1)


def repair(v: np.ndarray, there: np.ndarray, mapped: tuple[np.ndarray, np.ndarray] | None = None, face: list[np.ndarray] | None = None) -> None:
    """As ``attempts.repair``, in place."""
    _reconcile(v, there, face)
    if mapped is not None:
        d, has = _blocks(v)[1], _blocks(there)[1]
        new, some = (_blocks(x)[1] for x in mapped)
        d[...] = np.where(some, new, d)
        has[...] = (has | some).any(axis=1, keepdims=True)  # a row with one cell gets the other
        _reconcile(v, there, face)


def _reconcile(v: np.ndarray, there: np.ndarray, face: list[np.ndarray] | None) -> None:
    """As ``statement.reconcile_rows``."""
    c, has = _blocks(v)[0], _blocks(there)[0]
    has[...] = has.any(axis=1, keepdims=True)
    g = lambda f: c[:9, _AT[f]]
    over = _gt(g("gross_closing"), 0.0) & _gt(g("dep_up_to_end"), g("gross_closing"))
    under = _gt(g("gross_opening"), 0.0) & _gt(g("dep_up_to_beginning"), g("gross_opening"))
    for which, net, dep, gross in ((over, "net_closing", "dep_up_to_end", "gross_closing"), (under, "net_opening", "dep_up_to_beginning", "gross_opening")):
        g(net)[which] = 0.0
        g(dep)[which] = g(gross)[which]
    _identities(c)
    if face is not None:
        for f, anchor in zip(("net_opening", "net_closing"), face, strict=True):
            _to_anchor(c[:7, _AT[f]], has[:7, 0], anchor)
            _identities(c)
    _recompute(v, there)
    _identities(c)
    _recompute(v, there)


def _identities(c: np.ndarray) -> None:
    """As ``derive.repair_identities``; rows that aren't there are all 0 and stay so."""
    g = lambda f: c[1:7, _AT[f]]
    begin, during = g("dep_up_to_beginning"), g("dep_provided_during_year")
    moves = _gt(begin, 0.0) | _gt(during, 0.0)
    g("dep_up_to_end")[...] = np.where(moves, np.maximum(0.0, begin + during - g("dep_adjustment")), g("dep_up_to_end"))
    for gross, net, dep in (("gross_opening", "net_opening", "dep_up_to_beginning"), ("gross_closing", "net_closing", "dep_up_to_end")):
        g(gross)[...] = np.where(_gt(g(net), 0.0) & _gt(g(dep), 0.0), g(net) + g(dep), g(gross))
    both = _gt(g("gross_opening"), 0.0) & _gt(g("gross_closing"), 0.0)
    move = g("gross_closing") - g("gross_opening")
    for f, new in (("gross_deduction", np.maximum(-move, 0.0)), ("gross_addition_actual", np.maximum(move, 0.0)), ("gross_addition_reval", 0.0)):
        g(f)[...] = np.where(both, new, g(f))


def _to_anchor(x: np.ndarray, has: np.ndarray, anchor: np.ndarray, within: float = 0.08, residual_within: float = 0.04) -> None:
    """As ``derive.scale_to_anchor`` and ``residual_to_largest``, over rows 1 to 7 (row, document)."""
    total, ratio = x.sum(axis=0), anchor / x.sum(axis=0)
    fits = _gt(anchor, 0.0) & _gt(total, 0.0) & (ratio >= 1 - within) & (ratio <= 1 + within)
    x[...] = np.where(fits & _gt(x, 0.0), np.rint(x * ratio), x)
    residual = anchor - x.sum(axis=0)
    apply = _gt(anchor, 0.0) & (residual != 0) & _le(np.abs(residual), anchor * residual_within) & has.any(axis=0)
    top = np.where(has, x, -np.inf)
    top = np.where(np.isnan(top).any(axis=0), np.isnan(top), top == top.max(axis=0)) & has
    first = top & (np.cumsum(top, axis=0) == 1)  # on ties the row that comes first
    x[...] = np.where(first & apply, x + residual, x)


def _recompute(v: np.ndarray, there: np.ndarray) -> None:
    """As ``forms.recompute``."""
    for block, x, has in zip(("C", "D"), _blocks(v), _blocks(there), strict=True):
        leaves = [k - 1 for k in range(1, len(x) + 1) if k not in schema.DERIVED[block]]
        live = (x[leaves] != 0).any(axis=(0, 1))
        for target, sources in schema.closure(block).items():
            total, some = np.zeros(x.shape[1:]), np.zeros(x.shape[1:], bool)
            for k, weight in sorted(sources.items()):
                total += weight * x[k - 1]
                some |= has[k - 1]
            some &= live
            x[target - 1] = np.where(some, total, x[target - 1])
            has[target - 1] |= some


# --- checks


def judge(v: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rate, passed, which forms have any check), as ``forms.judged``."""
    n = v.shape[1]
    ok, every, rows_ok, any_rows = np.zeros(n, np.int64), np.zeros(n, np.int64), np.ones(n, bool), np.zeros(n, bool)
    for block, x, has, checks, least in zip(("C", "D"), _blocks(v), _blocks(there), (_checks_c, _checks_d), (5, 11), strict=True):
        rows = has.any(axis=1)
        some = (x != 0).any(axis=1)
        here = some.any(axis=0) if block == "C" else rows.any(axis=0)
        for good, applies in checks(x, rows):
            applies = applies & here
            every += applies
            ok += applies & good
        sources = [k for k in range(1, len(x) + 1) if k not in schema.DERIVED[block]]
        full = sum((rows[k - 1] & (some[k - 1] | (k in schema.OPTIONAL[block])) for k in sources if block == "D" or 2 <= k <= 7), np.zeros(n, np.int64))
        known = here & rows[[k - 1 for k in sources]].any(axis=0)
        rows_ok &= ~known | (full >= least)
        any_rows |= known
    judged = every > 0
    return ok / np.maximum(every, 1) * 100, (ok == every) & rows_ok & any_rows, judged


def _checks_c(x: np.ndarray, rows: np.ndarray):
    """As ``checks.wanted_c``: (holds, applies) of each check."""
    all_, pos = np.ones(x.shape[2], bool), lambda a: _gt(a, 0.0)
    g = lambda k, f: x[k - 1, _AT[f]]
    yield sum((pos(g(k, "net_closing")) | pos(g(k, "net_opening")) for k in range(2, 8)), np.zeros(x.shape[2])) >= 3, all_
    for k in range(2, 8):
        go, gc, no, nc = (g(k, f) for f in ("gross_opening", "gross_closing", "net_opening", "net_closing"))
        db, dp, da, de = (g(k, f) for f in ("dep_up_to_beginning", "dep_provided_during_year", "dep_adjustment", "dep_up_to_end"))
        yield _close(go, no + db), pos(no) & pos(db) & pos(go)
        yield _close(gc, nc + de), pos(nc) & pos(de) & pos(gc)
        yield _close(de, db + dp - da), pos(de) & (pos(db) | pos(dp))
        yield _close(gc, go + g(k, "gross_addition_reval") + g(k, "gross_addition_actual") - g(k, "gross_deduction")), pos(gc) & pos(go)
        yield _le(de, gc * 1.001), pos(nc) & pos(gc) & pos(de)
    for f in ("gross_opening", "gross_closing", "gross_addition_actual", "gross_deduction", "net_opening", "net_closing", "dep_up_to_beginning", "dep_up_to_end"):
        yield _close(g(8, f), sum((g(k, f) for k in range(2, 8)), 0.0), strict=True), rows[7]
    for f in ("net_opening", "net_closing"):
        yield _close(g(10, f), g(1, f) + g(8, f) + g(9, f), strict=True), rows[7] & rows[9]
    yield _gt(g(10, "net_closing"), 1_000_000), rows[7] & rows[9]


def _checks_d(x: np.ndarray, rows: np.ndarray):
    """As ``checks.wanted_d``."""
    all_ = np.ones(x.shape[2], bool)
    some = _gt(x, 0.0).any(axis=1)
    yield some.sum(axis=0) >= 8, all_
    for f in range(len(schema.D_FIELDS)):
        for target, sources in schema.FORMULAS["D"].items():
            yield _close(x[target - 1, f], sum((x[k - 1, f] * w for k, w in sources.items()), 0.0), strict=True), rows[target - 1]
    for k in (1, 5, 6, 8, 9, 10, 12, 13, 14, 17):
        yield some[k - 1], all_
    for k in range(1, 18):
        if k != 16:  # working capital may be negative
            yield ~all_, np.fmin(x[k - 1, 0], x[k - 1, 1]) < 0
