"""The form as one row a document, with a column for each of its cells; null where a document lacks one.

Cells of a document are dealt out once, by document, and combine before that. What works on rows gets rows of both blocks
(doc_id, block, sl_no, the fields of both), which stay where their document is: sums over a document are windows over
its 27 rows, so that no step deals them out anew. Cells that aren't on the form have no place here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans import schema
from ..session import shared_path
from . import checks
from .merges import CELL

ROWS = {"C": len(schema.C_LABELS), "D": len(schema.D_LABELS)}
FIELDS = [*schema.C_FIELDS, *schema.D_FIELDS]
#: Block, row and field of each cell of the form.
PLACES = [(b, k, f) for b in ROWS for k in range(1, ROWS[b] + 1) for f in schema.FIELDS[b]]


def name(block: str, sl: int, field: str) -> str:
    return f"{block}{sl}_{field}"


NAMES = [name(*p) for p in PLACES]


def place() -> Column:
    """The number of a cell (block, sl_no, field) in ``PLACES``; null if it isn't on the form."""
    first = {b: PLACES.index((b, 1, schema.FIELDS[b][0])) for b in ROWS}
    at = [F.when((F.col("block") == b) & (F.col("field") == f) & F.col("sl_no").between(1, ROWS[b]), (F.col("sl_no") - 1) * len(schema.FIELDS[b]) + first[b] + i) for b in ROWS for i, f in enumerate(schema.FIELDS[b])]
    return F.coalesce(*at).cast("int")


def to_forms(cells: DataFrame) -> DataFrame:
    """Forms of cells (doc_id, block, sl_no, field, value). Of a cell that comes twice the larger value."""
    at = cells.select("doc_id", place().alias("__at"), F.col("value").cast("double").alias("value"))
    return at.groupBy("doc_id").agg(*[F.expr(f"max(CASE WHEN __at = {i} THEN value END) AS {n}") for i, n in enumerate(NAMES)])


def patched(forms: DataFrame, fixes: DataFrame) -> DataFrame:
    """As ``merges.patch_cells``: cells that are there overwritten by those of fixes (forms) that aren't 0."""
    new = fixes.selectExpr("doc_id", *[f"{n} AS __{n}" for n in NAMES])
    known = set(NAMES)
    return forms.join(new, "doc_id", "left").selectExpr(*[f"CASE WHEN {c} IS NOT NULL AND __{c} != 0 THEN __{c} ELSE {c} END AS {c}" if c in known else c for c in forms.columns])


def of_all(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """The form of each document (doc_id) with these cells; what they lack is 0. One exchange of the cells there are."""
    none = docs.select("doc_id", *[F.lit(None).cast(kind).alias(c) for c, kind in (("block", "string"), ("sl_no", "int"), ("field", "string"), ("value", "double"))])
    return to_forms(dealt_out(cells.select(*CELL, "value").unionByName(none))).selectExpr("doc_id", *[f"coalesce({n}, 0D) AS {n}" for n in NAMES])


def derived(forms: DataFrame) -> DataFrame:
    """As ``derive.recompute``, on forms: nothing is dealt out. A derived cell is there if a cell that it derives from is."""
    of = {}
    leaf = []
    for block, targets in schema.DERIVED.items():
        sources = [k for k in range(1, ROWS[block] + 1) if k not in targets]
        leaf.append(f"({' OR '.join(f'coalesce({name(block, k, f)}, 0D) != 0' for k in sources for f in schema.FIELDS[block])}) AS __live{block}")
        for f in schema.FIELDS[block]:
            for t in targets:
                parts = [(name(block, k, f), w) for k, w in schema.closure(block)[t].items()]
                there = f"coalesce({', '.join(n for n, _ in parts)}) IS NOT NULL"
                total = "0D" + "".join(f" + {w} * coalesce({n}, 0D)" for n, w in parts)
                of[name(block, t, f)] = f"CASE WHEN __live{block} AND {there} THEN {total} ELSE {name(block, t, f)} END AS {name(block, t, f)}"
    return forms.selectExpr("*", *leaf).selectExpr(*[of.get(c, c) for c in forms.columns])


def rows(forms: DataFrame, others: dict[str, str] | None = None) -> DataFrame:
    """Rows of both blocks, all 27 of each document; fields are null where there is no cell.

    others: prefixes of further sets of the form's columns, and of the fields that they become."""
    there = set(forms.columns)
    sets = [("", "", FIELDS), *((p, to, [f for f in FIELDS if any(p + name(b, 1, f) in there for b in ROWS)]) for p, to in (others or {}).items())]

    def row(b: str, k: int) -> str:
        values = [f"{p + name(b, k, f) if p + name(b, k, f) in there else 'CAST(NULL AS DOUBLE)'} AS {to}{f}" for p, to, fields in sets for f in fields]
        return f"struct('{b}' AS block, {k} AS sl_no, {', '.join(values)})"

    return forms.selectExpr("doc_id", f"inline(array({', '.join(row(b, k) for b in ROWS for k in range(1, ROWS[b] + 1))}))")


def from_rows(of: DataFrame) -> DataFrame:
    """Forms of rows of both blocks."""
    return of.groupBy("doc_id").agg(*[F.expr(f"max(CASE WHEN block = '{b}' AND sl_no = {k} THEN {f} END) AS {n}") for (b, k, f), n in zip(PLACES, NAMES, strict=True)])


def cells_of(of: DataFrame) -> DataFrame:
    """Cells of rows of both blocks."""
    made = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in FIELDS])
    return of.select("doc_id", "block", "sl_no", F.inline(F.filter(made, lambda x: x["value"].isNotNull()))).select(*CELL, "value")


def filled(of: DataFrame, block: str) -> DataFrame:
    """A block's rows with 0 for the cells that they lack; rows without any cell stay so."""
    there = (F.col("block") == block) & F.coalesce(*schema.FIELDS[block]).isNotNull()
    return of.withColumns({f: F.when(there, F.coalesce(f, F.lit(0.0))).otherwise(F.col(f)) for f in schema.FIELDS[block]})


def recompute(of: DataFrame) -> DataFrame:
    """As ``derive.recompute``, on rows of both blocks."""
    mine = Window.partitionBy("doc_id", "block").orderBy("sl_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # a form's rows
    leaf, totals, new = [], [], {}
    over = lambda x, to: F.expr(x).over(mine).alias(to)
    for block, targets in schema.DERIVED.items():
        some = " OR ".join(f"coalesce({f}, 0D) != 0" for f in schema.FIELDS[block])
        leaf.append(f"(block = '{block}' AND sl_no NOT IN {targets} AND ({some}))")
        for f in schema.FIELDS[block]:  # null in the other block's rows
            for t in targets:
                less = [k for k, w in schema.closure(block)[t].items() if w == -1]
                more = [k for k, w in schema.closure(block)[t].items() if w == 1]
                minus = f" WHEN sl_no IN ({', '.join(map(str, less))}) THEN -{f}" if less else ""
                totals.append(over(f"sum(CASE WHEN sl_no IN ({', '.join(map(str, more))}) THEN {f}{minus} END)", f"__{block}{t}_{f}"))
            new[f] = f"CASE {' '.join(f'WHEN sl_no = {t} THEN coalesce(__{block}{t}_{f}, {f})' for t in targets)} ELSE {f} END"
            new[f] = f"CASE WHEN __live AND block = '{block}' THEN {new[f]} ELSE {f} END AS {f}"
    summed = of.select("*", over(f"max({' OR '.join(leaf)})", "__live"), *totals)
    return summed.selectExpr(*[new.get(c, c) for c in of.columns])


def judged(forms: DataFrame) -> DataFrame:
    """Forms with (rate, passed): percent of the checks that hold; passed if all do and enough rows are filled.

    Block C counts only where a document has an amount in it. Null where a document has neither block."""

    def row(b: str, k: int) -> Column:
        got = [name(b, k, f) for f in schema.FIELDS[b]]
        return F.expr(f"CASE WHEN coalesce({', '.join(got)}) IS NOT NULL THEN struct({', '.join(f'coalesce({n}, 0D) AS {f}' for n, f in zip(got, schema.FIELDS[b], strict=True))}) END")

    def some(b: str, k: int) -> Column:
        return F.expr("(" + " OR ".join(f"coalesce({name(b, k, f)}, 0D) != 0" for f in schema.FIELDS[b]) + ")")

    out = forms
    there, enough = {}, {}
    for b, wanted in (("C", checks.wanted_c), ("D", checks.wanted_d)):
        ks = range(1, ROWS[b] + 1)
        out = out.withColumns({f"r{k}": row(b, k) for k in ks})
        has = F.coalesce(*[F.col(f"r{k}") for k in ks]).isNotNull()
        sources = [k for k in ks if k not in schema.DERIVED[b]]
        if b == "C":
            for k in ks:
                there[b] = there.get(b, F.lit(False)) | some(b, k)
        else:
            there[b] = has
        full = sum((F.when(F.col(f"r{k}").isNotNull() & (some(b, k) | F.lit(k in schema.OPTIONAL[b])), 1).otherwise(0) for k in sources if b == "D" or 2 <= k <= 7), F.lit(0))
        enough[b] = full >= (5 if b == "C" else 11)
        known = F.coalesce(*[F.col(f"r{k}") for k in sources]).isNotNull()
        out = out.withColumns({f"__has{b}": there[b], f"__rows{b}": F.when(there[b] & known, enough[b]), f"__checks{b}": F.when(there[b], F.transform(F.array_compact(F.array(*wanted())), lambda x: x["ok"]))}).drop(*[f"r{k}" for k in ks])
    none = F.array().cast("array<boolean>")
    out = out.withColumn("__all", F.concat(F.coalesce("__checksC", none), F.coalesce("__checksD", none))).withColumn("__ok", F.size(F.filter("__all", lambda x: x)))
    rows_ok = F.coalesce(F.coalesce("__rowsC", F.lit(True)) & F.coalesce("__rowsD", F.lit(True)) & F.coalesce(F.col("__rowsC"), F.col("__rowsD")).isNotNull(), F.lit(False))
    any_check = F.size("__all") > 0
    return out.select(*forms.columns, F.when(any_check, F.col("__ok") / F.size("__all") * 100).alias("rate"), F.when(any_check, (F.col("__ok") == F.size("__all")) & rows_ok).alias("passed"))


def dealt_out(df: DataFrame) -> DataFrame:
    """df by document in all shuffle partitions: a form costs far more than its few bytes tell, so that adaptive
    execution would put too many into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")


def stored(df: DataFrame, what: str, most: int = 0) -> DataFrame:
    """df written to the folder that executors share, and read again; columns of the form take few bytes there.

    most: rows of a file, as one file of many small rows would be one task."""
    path = shared_path(df.sparkSession, what)
    df.write.option("maxRecordsPerFile", most).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
