"""Derived rows, reconciliation with anchors, and repair of row identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans import schema
from .merges import CELL


def derived_cells(cells: DataFrame, fields: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Derived rows from leaf rows: one join with the formulas' closure (29 rows) and one aggregation."""
    deps = F.broadcast(schema.dependencies(cells.sparkSession))
    used = cells.join(deps.withColumnRenamed("source", "sl_no"), ["block", "sl_no"])
    if fields:
        keep = F.lit(False)
        for block, names in fields.items():
            keep = keep | ((F.col("block") == block) & F.col("field").isin(*names))
        used = used.where(keep)
    return used.groupBy("doc_id", "block", F.col("target").alias("sl_no"), "field").agg(F.sum(F.col("value") * F.col("weight")).alias("value"))


def recompute(cells: DataFrame, fields: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Cells with derived rows computed anew; a block whose leaves are all 0 is left as it is.

    Each cell goes on as itself and as its part in the rows that derive from it, from a literal table; the cells are
    read once and dealt out once, by document and block."""
    parts = {(b, s): [(t, float(w)) for t in schema.closure(b) for s2, w in schema.closure(b)[t].items() if s2 == s] for b in schema.FORMULAS for s in {x for of in schema.closure(b).values() for x in of}}
    entry = lambda ts: F.array(*[F.struct(F.lit(t).alias("sl_no"), F.lit(w).alias("weight")) for t, w in ts])
    targets = F.create_map(*[x for (b, s), ts in sorted(parts.items()) for x in (F.lit(f"{b}{s}"), entry(ts))])
    mine = F.coalesce(F.try_element_at(targets, F.concat("block", F.col("sl_no").cast("string"))), F.array().cast("array<struct<sl_no:int,weight:double>>"))
    if fields:
        wanted = F.lit(False)
        for block, names in fields.items():
            wanted = wanted | ((F.col("block") == block) & F.col("field").isin(*names))
        mine = F.when(wanted, mine).otherwise(F.array().cast("array<struct<sl_no:int,weight:double>>"))
    derived = ((F.col("block") == "C") & F.col("sl_no").isin(*schema.DERIVED["C"])) | ((F.col("block") == "D") & F.col("sl_no").isin(*schema.DERIVED["D"]))
    own = F.struct(F.col("sl_no").cast("int").alias("sl_no"), F.lit(True).alias("own"), F.col("value").alias("v"))
    others = F.transform(mine, lambda t: F.struct(t["sl_no"].alias("sl_no"), F.lit(False).alias("own"), (F.col("value") * t["weight"]).alias("v")))
    rows = cells.select(*CELL, "value").repartition("doc_id", "block")  # before parts are made, which are some four times as many rows
    rows = rows.select("doc_id", "block", "field", (~derived & (F.col("value") != 0)).alias("leaf"), F.explode(F.concat(F.array(own), others)).alias("x"))
    sums = rows.groupBy("doc_id", "block", F.col("x.sl_no").alias("sl_no"), "field").agg(
        F.max(F.when(F.col("x.own"), F.col("x.v"))).alias("own"), F.bool_or(F.col("x.own")).alias("there"), F.sum(F.when(~F.col("x.own"), F.col("x.v"))).alias("derived"), F.count_if(~F.col("x.own")).alias("n"), F.bool_or("leaf").alias("leaf")
    )
    live = F.coalesce(F.bool_or("leaf").over(Window.partitionBy("doc_id", "block")), F.lit(False))  # a form's cells
    sums = sums.withColumn("new", live & (F.col("n") > 0))
    return sums.where("there or new").select(*CELL, F.when(F.col("new"), F.col("derived")).otherwise(F.col("own")).alias("value"))


def autocorrect(cells: DataFrame) -> DataFrame:
    """Derived cells filled only where they are 0 and their formula, over what stands in the rows, isn't.

    Formulas of one level are applied in their order, each on what the ones before have filled, over one row
    for each document, block and field; cells that are absent stay so."""
    most = max(len(schema.C_LABELS), len(schema.D_LABELS))
    v = lambda k: F.col(f"__v{k}")
    wide = cells.groupBy("doc_id", "block", "field").agg(*[F.max(F.when(F.col("sl_no") == k, F.col("value"))).alias(f"__v{k}") for k in range(1, most + 1)])
    for block, formulas in schema.FORMULAS.items():
        for target, sources in formulas.items():
            calc = sum((F.coalesce(v(k), F.lit(0.0)) * sign for k, sign in sources.items()), F.lit(0.0))
            wide = wide.withColumn(f"__v{target}", F.when((F.col("block") == block) & (v(target) == 0) & (calc != 0), calc).otherwise(v(target)))
    made = F.array(*[F.struct(F.lit(k).alias("sl_no"), v(k).alias("value")) for k in range(1, most + 1)])
    return wide.select("doc_id", "block", "field", F.inline(made)).where("value is not null").select(*CELL, "value")


def cap_depreciation(rows: DataFrame) -> DataFrame:
    """Where accumulated depreciation exceeds the gross amount it becomes that, and the net amount 0 (rows 1 to 9)."""
    over_close = (F.col("sl_no") <= 9) & (F.col("gross_closing") > 0) & (F.col("dep_up_to_end") > F.col("gross_closing"))
    over_open = (F.col("sl_no") <= 9) & (F.col("gross_opening") > 0) & (F.col("dep_up_to_beginning") > F.col("gross_opening"))
    return rows.withColumns({
        "net_closing": F.when(over_close, 0.0).otherwise(F.col("net_closing")),
        "dep_up_to_end": F.when(over_close, F.col("gross_closing")).otherwise(F.col("dep_up_to_end")),
        "net_opening": F.when(over_open, 0.0).otherwise(F.col("net_opening")),
        "dep_up_to_beginning": F.when(over_open, F.col("gross_opening")).otherwise(F.col("dep_up_to_beginning")),
    })


def repair_identities(rows: DataFrame, force_gross: bool = True, imputed: str | None = None, only: tuple[int, int] = (2, 7)) -> DataFrame:
    """Asset rows made to agree with themselves: depreciation rolls forward, gross is net plus depreciation,
    and the year's movement is the difference of the gross amounts. ``imputed``: a boolean column of rows
    whose gross amounts come from a subtotal; there depreciation follows from gross and net."""
    c, here = F.col, F.col("sl_no").between(*only)
    flag = c(imputed) if imputed else F.lit(False)

    def put(df: DataFrame, **new: Column) -> DataFrame:
        return df.withColumns({k: F.when(here, v).otherwise(c(k)) for k, v in new.items()})

    rows = put(
        rows,
        dep_up_to_beginning=F.when(flag & (c("gross_opening") > 0) & (c("net_opening") > 0), c("gross_opening") - c("net_opening")).otherwise(c("dep_up_to_beginning")),
        dep_up_to_end=F.when(flag & (c("gross_closing") > 0) & (c("net_closing") > 0), c("gross_closing") - c("net_closing")).when(~flag & ((c("dep_up_to_beginning") > 0) | (c("dep_provided_during_year") > 0)), F.greatest(F.lit(0.0), c("dep_up_to_beginning") + c("dep_provided_during_year") - c("dep_adjustment"))).otherwise(c("dep_up_to_end")),
    )
    rows = put(rows, dep_provided_during_year=F.when(flag & (c("dep_up_to_end") > c("dep_up_to_beginning")), c("dep_up_to_end") - c("dep_up_to_beginning") + c("dep_adjustment")).otherwise(c("dep_provided_during_year")))

    def gross(name: str, net: str, dep: str) -> Column:
        implied = c(net) + c(dep)
        off = F.lit(True) if force_gross else (c(name) == 0) | (F.abs(c(name) - implied) / F.greatest(implied, F.lit(1.0)) > 0.005)
        return F.when((c(net) > 0) & (c(dep) > 0) & off & ~(flag & (c(name) > implied * 1.02)), implied).otherwise(c(name))

    rows = put(rows, gross_opening=gross("gross_opening", "net_opening", "dep_up_to_beginning"), gross_closing=gross("gross_closing", "net_closing", "dep_up_to_end"))
    both = (c("gross_opening") > 0) & (c("gross_closing") > 0)
    move = c("gross_closing") - c("gross_opening")
    return put(
        rows,
        gross_deduction=F.when(both, F.greatest(-move, F.lit(0.0))).otherwise(c("gross_deduction")),
        gross_addition_actual=F.when(both, F.greatest(move, F.lit(0.0))).otherwise(c("gross_addition_actual")),
        gross_addition_reval=F.when(both, 0.0).otherwise(c("gross_addition_reval")),
    )


def scale_to_anchor(rows: DataFrame, value: str, anchor: str, within: float = 0.08, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Values times anchor over their sum, rounded, where that ratio is within bounds; others stay.

    The anchor is a column that is the same in all rows of a group; sums are a grouped aggregation
    joined back, so that a large group is never one window."""
    sums = rows.groupBy(*by).agg(F.sum(value).alias("__sum"))
    ratio = F.col(anchor) / F.col("__sum")
    fits = (F.col(anchor) > 0) & (F.col("__sum") > 0) & ratio.between(1 - within, 1 + within)
    return rows.join(sums, list(by)).withColumn(value, F.when(fits & (F.col(value) > 0), F.bround(F.col(value) * ratio)).otherwise(F.col(value))).drop("__sum")


def residual_to_largest(rows: DataFrame, value: str, anchor: str, order: str, within: float = 0.04, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """What a group's sum lacks to its anchor, if no more than a share of it, added to its largest value
    (on ties the one with the least ``order``)."""
    top = rows.groupBy(*by).agg(F.sum(value).alias("__sum"), F.max(F.struct(F.col(value).alias("v"), (-F.col(order)).alias("o"))).alias("__top"))
    residual = F.col(anchor) - F.col("__sum")
    apply = (F.col(anchor) > 0) & (residual != 0) & (F.abs(residual) <= F.col(anchor) * within) & (F.col("__top.o") == -F.col(order))
    return rows.join(top, list(by)).withColumn(value, F.when(apply, F.col(value) + residual).otherwise(F.col(value))).drop("__sum", "__top")


def impute_from_subtotal(rows: DataFrame, value: str, subtotal: str, order: str, least: float = 1e8, off: float = 0.02, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The row that a subtotal contradicts most plainly: of rows more than ``off`` from subtotal minus the
    others, the one with the largest value (the later on ties) takes that difference; ``imputed`` marks it."""
    mine = Window.partitionBy(*by)  # one exchange and one sort, which spill; joins of a group's sums and picks sorted the rows anew each time, all in one task
    rows = rows.withColumn("__implied", F.col(subtotal) - (F.sum(value).over(mine) - F.col(value)))
    bad = (F.col(subtotal) >= least) & (F.col("__implied") > 0) & (F.abs(F.col(value) - F.col("__implied")) / F.greatest(F.abs("__implied"), F.lit(1.0)) > off)
    pick = F.max(F.when(bad, F.struct(F.col(value).alias("v"), F.col(order).alias("o")))).over(mine)
    rows = rows.withColumn("imputed", F.coalesce(pick["o"] == F.col(order), F.lit(False)))
    return rows.withColumn(value, F.when(F.col("imputed"), F.col("__implied")).otherwise(F.col(value))).drop("__implied")


def replace_when_off(cells: DataFrame, found: DataFrame, sl_no: int = 14, tol: float = 0.02) -> DataFrame:
    """A block D row replaced by what its schedule sums to (doc_id, field, value), where it is missing or off."""
    new = found.where("value > 0").select("doc_id", "field", F.col("value").alias("__new"))
    here = (F.col("block") == "D") & (F.col("sl_no") == sl_no) & F.col("__new").isNotNull()
    off = (F.col("value") == 0) | (F.abs(F.col("value") - F.col("__new")) / F.greatest(F.abs("__new"), F.lit(1.0)) > tol)
    return cells.join(new, ["doc_id", "field"], "left").withColumn("value", F.when(here & off, F.col("__new")).otherwise(F.col("value"))).drop("__new")


def keep_last_kept(values: Column, apart: float = 0.05) -> Column:
    """An array without values within ``apart`` of the last one that was kept."""
    start = F.expr("cast(array() as array<double>)")
    return F.aggregate(values, start, lambda kept, v: F.when((F.size(kept) > 0) & (F.abs(v - F.element_at(kept, -1)) <= apart), kept).otherwise(F.concat(kept, F.array(v))))


def upper_median(values: Column) -> Column:
    """The middle value of the sorted array, the upper one of two."""
    return F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int"))


def is_inflated(values: Column, large: float = 180e6, times: float = 12.0) -> Column:
    """Eight values or more, of which the largest is large and far above the upper median."""
    return (F.size(values) >= 8) & (F.array_max(values) >= large) & (F.array_max(values) > times * upper_median(values))


def without_outliers(values: Column, times: float = 12.0) -> Column:
    """An array of more than four values without those far above or below its upper median."""
    return F.when(F.size(values) <= 4, values).otherwise(F.flatten(F.transform(F.array(upper_median(values)), lambda m: F.filter(values, lambda v: (v <= times * m) & (v * times >= m)))))


def merge_positions(values: Column, at: list[int]) -> Column:
    """The sum of the array's values at some places; places out of range count 0."""
    return sum((F.coalesce(F.get(values, F.lit(k)), F.lit(0.0)) for k in at), F.lit(0.0))


def right_aligned(values: Column, width: int = 8) -> Column:
    """A short array padded on the left with zeros."""
    return F.concat(F.array_repeat(F.lit(0.0), F.greatest(F.lit(width) - F.size(values), F.lit(0))), values)


def top_two(values: Column) -> Column:
    """struct(closing, opening): the largest value and the one after it."""
    s = F.reverse(F.array_sort(values))
    return F.struct(F.coalesce(F.get(s, F.lit(0)), F.lit(0.0)).alias("closing"), F.coalesce(F.get(s, F.lit(1)), F.lit(0.0)).alias("opening"))


def first_in_order(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by an order of patterns and bodies."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
