"""Merges of statement rows and cells: templates, precedence, patches, candidates.

Rows are keyed by (doc_id, sl_no), cells by (doc_id, block, sl_no, field). Order is always a column;
nothing depends on how rows arrive. The form's tables have at most 27 rows and are broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.closeness import close_value
from ..plans import schema

CELL = ["doc_id", "block", "sl_no", "field"]


def to_cells(rows: DataFrame, block: str) -> DataFrame:
    """Wide rows of a block as cells; columns that are missing give none."""
    fields = [f for f in schema.FIELDS[block] if f in rows.columns]
    return rows.select("doc_id", F.col("sl_no").cast("int").alias("sl_no"), *[F.col(f).cast("double").alias(f) for f in fields]).unpivot(["doc_id", "sl_no"], fields, "field", "value").select("doc_id", F.lit(block).alias("block"), "sl_no", "field", "value")


def to_rows(cells: DataFrame, block: str) -> DataFrame:
    """A block's cells as wide rows; absent cells are 0."""
    pick = [F.coalesce(F.max(F.when(F.col("field") == f, F.col("value"))), F.lit(0.0)).alias(f) for f in schema.FIELDS[block]]
    return cells.where(F.col("block") == block).groupBy("doc_id", "sl_no").agg(*pick)


def sanitize(rows: DataFrame, block: str, ordinal: str) -> DataFrame:
    """Known fields as numbers, whole row numbers, and of a row that comes twice the last by ``ordinal``."""
    from ..functions.numbers import clean_number

    sl = F.col("sl_no").cast("string").try_cast("double").cast("int")
    fields = [(clean_number(F.col(f)) if dict(rows.dtypes)[f] == "string" else F.coalesce(F.col(f).cast("double"), F.lit(0.0))).alias(f) for f in schema.FIELDS[block] if f in rows.columns]
    label = (F.col("label") if "label" in rows.columns else F.lit(None).cast("string")).alias("label")
    rows = rows.select("doc_id", sl.alias("sl_no"), label, F.col(ordinal).alias("__ord"), *fields).where(F.coalesce(F.col("sl_no"), F.lit(0)) != 0)
    last = Window.partitionBy("doc_id", "sl_no").orderBy(F.col("__ord").desc())
    return rows.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n", "__ord")


def template_merge(rows: DataFrame, block: str) -> DataFrame:
    """The block's whole template for every document, its values overwritten by non-null ones of rows."""
    spark = rows.sparkSession
    form = F.broadcast(schema.template(spark, block).select("sl_no", F.col("label").alias("__label")))
    have = rows.withColumns({f: F.lit(None).cast("double") for f in schema.FIELDS[block] if f not in rows.columns})
    have = have if "label" in rows.columns else have.withColumn("label", F.lit(None).cast("string"))
    out = rows.select("doc_id").distinct().crossJoin(form).join(have, ["doc_id", "sl_no"], "left")
    label = F.coalesce(F.nullif(F.trim("label"), F.lit("")), F.col("__label")).alias("label")
    return out.select("doc_id", "sl_no", label, *[F.coalesce(f, F.lit(0.0)).alias(f) for f in schema.FIELDS[block]])


def first_nonzero(cells: DataFrame, keys: list[str], order: list[str | Column], value: str = "value") -> DataFrame:
    """Of each key the first value by order that isn't 0; 0 if there is none. One hash aggregation."""
    first = F.min(F.when(F.col(value) != 0, F.struct(*order, F.col(value).alias("__v"))))
    return cells.groupBy(*keys).agg(F.coalesce(first["__v"], F.lit(0.0)).alias(value))


def last_nonzero(cells: DataFrame, keys: list[str], order: list[str | Column], value: str = "value") -> DataFrame:
    """Of each key the last value by order that isn't 0; keys without one are left out."""
    last = F.max(F.when(F.col(value) != 0, F.struct(*order, F.col(value).alias("__v"))))
    return cells.groupBy(*keys).agg(last["__v"].alias(value)).where(F.col(value).isNotNull())


def rekey_sum(rows: DataFrame, fields: list[str], key: str = "sl_no", mapping: dict[int, int] = schema.SUB_ROWS, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Sub-rows under the row that they belong to, their numbers summed."""
    to = F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), F.col(key))
    return rows.withColumn(key, F.coalesce(to, F.col(key))).groupBy(*by, key).agg(*[F.sum(F.coalesce(f, F.lit(0.0))).alias(f) for f in fields])


def dedupe_detail(rows: DataFrame, order: str, detail: tuple[int, ...] = (1, 3, 5, 6)) -> DataFrame:
    """One row a number: of detail rows the one with the largest sum (first on ties), of others the first that
    isn't all zero, else the first."""
    total = F.col("opening_rs") + F.col("closing_rs")
    rank = [F.when(F.col("sl_no").isin(*detail), -total).otherwise(F.when((F.col("opening_rs") == 0) & (F.col("closing_rs") == 0), 1.0).otherwise(0.0)), F.col(order)]
    first = Window.partitionBy("doc_id", "sl_no").orderBy(*rank)
    return rows.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def patch_cells(cells: DataFrame, fixes: DataFrame, allowed: tuple[str, ...] | None = None) -> DataFrame:
    """Cells overwritten by fixes that aren't 0, for allowed fields; no cell is added."""
    new = fixes.select(*CELL, F.col("value").alias("__new"))
    if allowed is not None:
        new = new.where(F.col("field").isin(*allowed))
    return cells.join(new, CELL, "left").withColumn("value", F.when(F.coalesce("__new", F.lit(0.0)) != 0, F.col("__new")).otherwise(F.col("value"))).drop("__new")


def upsert_cells(cells: DataFrame, pending: DataFrame) -> DataFrame:
    """Cells with pending values put in where they aren't close already, and added where they are missing."""
    new = pending.select(*CELL, F.col("value").alias("__new"))
    both = cells.select(*CELL, "value").join(new, CELL, "full_outer")
    keep = F.col("__new").isNull() | (F.col("__new") == 0) | (F.col("value").isNotNull() & close_value(F.col("value"), F.col("__new")))
    return both.withColumn("value", F.when(keep, F.coalesce("value", F.lit(0.0))).otherwise(F.col("__new"))).drop("__new")


def fill_from(cells: DataFrame, reparsed: DataFrame, guard: float = 20.0) -> DataFrame:
    """As ``upsert_cells``, but derived rows stay and values more than ``guard`` times the present one are not believed."""
    derived = F.lit(False)
    for block, numbers in schema.DERIVED.items():
        derived = derived | ((F.col("block") == block) & F.col("sl_no").isin(*numbers))
    new = reparsed.where(~derived).select(*CELL, F.col("value").alias("__new"))
    both = cells.select(*CELL, "value").join(new, CELL, "full_outer")
    now = F.coalesce("value", F.lit(0.0))
    wild = (now > 0) & (F.col("__new") > guard * now)
    keep = F.col("__new").isNull() | (F.col("__new") == 0) | wild | close_value(now, F.col("__new"))
    return both.withColumn("value", F.when(keep, now).otherwise(F.col("__new"))).drop("__new")


def crosscheck(cells: DataFrame, summary: DataFrame, skip: tuple[int, ...] = (8,)) -> DataFrame:
    """Block D's source rows overwritten by non-zero values of the summary page; cash and derived rows stay."""
    return patch_cells(cells, summary.where((F.col("block") == "D") & ~F.col("sl_no").isin(*skip, *schema.DERIVED["D"])))


def merge_components(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two sets of components (doc_id, key, opening, closing): one-sided ones stay; ``schedule_`` keys are
    taken from the right, ``note_`` keys from the left, others from the side with the larger closing (left on ties)."""
    a = left.select("doc_id", "key", F.struct("opening", "closing").alias("a"))
    b = right.select("doc_id", "key", F.struct("opening", "closing").alias("b"))
    pick = F.when(F.col("a").isNull(), F.col("b")).when(F.col("b").isNull(), F.col("a")).when(F.col("key").startswith("schedule_"), F.col("b")).when(F.col("key").startswith("note_"), F.col("a")).when(F.col("b.closing") > F.col("a.closing"), F.col("b")).otherwise(F.col("a"))
    return a.join(b, ["doc_id", "key"], "full_outer").withColumn("x", pick).select("doc_id", "key", "x.opening", "x.closing")


def union_distinct_on(groups: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """The groups' union, one row a key: of the first group that has it, and there the first by order."""
    out = None
    for k, g in enumerate(groups):
        g = g.withColumn("__group", F.lit(k))
        out = g if out is None else out.unionByName(g)
    first = Window.partitionBy(*keys).orderBy("__group", *order)
    return out.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n", "__group")


def missing_rows(rows: DataFrame, block: str) -> DataFrame:
    """(doc_id, sl_no) of template rows without any number that isn't 0."""
    some = F.lit(False)
    for f in schema.FIELDS[block]:
        if f in rows.columns:
            some = some | (F.coalesce(f, F.lit(0.0)) != 0)
    form = F.broadcast(schema.template(rows.sparkSession, block).select("sl_no"))
    return rows.select("doc_id").distinct().crossJoin(form).join(rows.where(some).select("doc_id", "sl_no"), ["doc_id", "sl_no"], "left_anti")


def useful_rows(rows: DataFrame, missing: DataFrame) -> DataFrame:
    """Rows whose number is missing and that have a value (for filling from another reading)."""
    return rows.where((F.coalesce("opening_rs", F.lit(0.0)) != 0) | (F.coalesce("closing_rs", F.lit(0.0)) != 0)).join(missing, ["doc_id", "sl_no"], "left_semi")


def add_if_absent(rows: DataFrame, extra: DataFrame, keys: tuple[str, ...] = ("doc_id", "sl_no")) -> DataFrame:
    """rows and those of extra whose key they lack."""
    return rows.unionByName(extra.join(rows.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)
