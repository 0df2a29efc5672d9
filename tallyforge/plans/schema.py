"""The two statement blocks: templates, fields, formulas, rules' and aliases' tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The form's rows and columns.
C_LABELS = (
    "Land",
    "Building",
    "Plant and Machinery",
    "Transport Equipment",
    "Computer Equipment & software",
    "Pollution control equipment",
    "Others",
    "Sub-total(2 to 7)",
    "Capital Work in Progress",
    "Total(1+8+9)",
)
D_LABELS = (
    "Raw Materials & Components and Packing materials",
    "Fuels & Lubricants",
    "Spares, Stores & others",
    "Sub-Total(1 to 3)",
    "Semi-finished goods/work in progress",
    "Finished goods",
    "Total inventory(4 to 6)",
    "Cash in Hand & at Bank",
    "Sundry Debtors",
    "Other current assests",
    "Total current assets(7 to 10)",
    "Sundry creditors",
    "Over draft,cash credit, other short term loan from banks & other financial institutions",
    "Other current liabilities",
    "Total Current liabilities(12 to 14)",
    "Working Capital(11-15)",
    "Outstanding loans(excluding interest but including deposits)",
)
C_FIELDS = (
    "gross_opening",
    "gross_addition_reval",
    "gross_addition_actual",
    "gross_deduction",
    "gross_closing",
    "dep_up_to_beginning",
    "dep_provided_during_year",
    "dep_adjustment",
    "dep_up_to_end",
    "net_opening",
    "net_closing",
)
D_FIELDS = ("opening_rs", "closing_rs")
FIELDS = {"C": C_FIELDS, "D": D_FIELDS}
DERIVED = {"C": (8, 10), "D": (4, 7, 11, 15, 16)}
OPTIONAL = {"C": (), "D": (2,)}
#: Rows of finer forms and the row that they add to.
SUB_ROWS = {32: 3, 51: 5, 52: 5, 71: 7, 72: 7}

#: One level of each derived row: sources and signs.
FORMULAS = {
    "C": {8: {2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1}, 10: {1: 1, 8: 1, 9: 1}},
    "D": {4: {1: 1, 2: 1, 3: 1}, 7: {4: 1, 5: 1, 6: 1}, 11: {7: 1, 8: 1, 9: 1, 10: 1}, 15: {12: 1, 13: 1, 14: 1}, 16: {11: 1, 15: -1}},
}

CELLS = "doc_id bigint, block string, sl_no int, field string, value double"


def closure(block: str) -> dict[int, dict[int, int]]:
    """Each derived row in rows that are not derived."""
    out: dict[int, dict[int, int]] = {}
    for target, sources in FORMULAS[block].items():
        leaves: dict[int, int] = {}
        for sl, sign in sources.items():
            for leaf, weight in out.get(sl, {sl: 1}).items():
                leaves[leaf] = leaves.get(leaf, 0) + sign * weight
        out[target] = leaves
    return out


def template(spark: SparkSession, block: str | None = None) -> DataFrame:
    """(block, sl_no, label, is_derived, is_optional): 27 rows, or a block's."""
    rows = [(b, k, label, k in DERIVED[b], k in OPTIONAL[b]) for b, labels in (("C", C_LABELS), ("D", D_LABELS)) if block in (None, b) for k, label in enumerate(labels, 1)]
    return spark.createDataFrame(rows, "block string, sl_no int, label string, is_derived boolean, is_optional boolean")


def dependencies(spark: SparkSession, leaves: bool = True) -> DataFrame:
    """(block, target, source, weight): formulas, of leaf rows or of one level."""
    rows = [(b, t, s, float(w)) for b in FORMULAS for t, sources in (closure(b) if leaves else FORMULAS[b]).items() for s, w in sources.items()]
    return spark.createDataFrame(rows, "block string, target int, source int, weight double")


def empty_cells(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """All of the form's cells of each document (doc_id), with value 0."""
    from pyspark.sql import functions as F

    fields = spark.createDataFrame([(b, f) for b, names in FIELDS.items() for f in names], "block string, field string")
    form = template(spark).select("block", "sl_no").join(fields, "block")
    return docs.select("doc_id").distinct().crossJoin(F.broadcast(form)).withColumn("value", F.lit(0.0))  # 126 cells
