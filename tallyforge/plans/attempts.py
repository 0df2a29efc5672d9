"""The loop of attempts: repair, check, and go on only with the documents that fail.

An attempt repairs what it has (reconciliation, mapping of components, reconciliation again) and is checked; documents
that pass are done, the others take what the next reading on the ladder says and are tried once more. All attempts are
kept as tables, so that in the end each document has its best one, even where later ones made it worse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import forms, merges, packed, rules
from . import schema
from .statement import reconcile_rows


def repair(forms_: DataFrame, mapped: DataFrame | None = None, face: DataFrame | None = None) -> DataFrame:
    """Forms of both blocks reconciled, block D's rows overwritten by the best profile of components, and reconciled again.

    mapped: forms of what components map to, or None for one reconciliation. A form costs far more than its few bytes
    tell, so that adaptive execution would put too many into one task."""
    tasks = int(forms_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    forms_ = forms_.repartition(tasks, "doc_id")
    if mapped is None:
        return forms.from_rows(reconcile_rows(forms.rows(forms_), face))
    of_d = [n for n in forms.NAMES if n.startswith("D")]
    both = forms_.join(mapped.select("doc_id", *[F.col(n).alias(f"__{n}") for n in of_d]), "doc_id", "left")
    rows = reconcile_rows(forms.rows(both, {"__": "__"}), face)
    new = F.coalesce(*[f"__{f}" for f in schema.D_FIELDS])
    there = (F.col("block") == "D") & F.coalesce(new, *schema.D_FIELDS).isNotNull()
    rows = rows.withColumns({f: F.when(there, F.coalesce(f"__{f}", f, F.lit(0.0))).otherwise(F.col(f)) for f in schema.D_FIELDS}).drop(*[f"__{f}" for f in schema.D_FIELDS])
    return forms.from_rows(reconcile_rows(rows, face))


def mapped_cells(components: DataFrame, mapping: DataFrame, order: dict[str, int]) -> DataFrame:
    """(doc_id, cells) of each document's rows of block D by its best profile."""
    mapped = rules.best_rows(components, mapping, order)
    cells = mapped.select("doc_id", F.lit("D").alias("block"), "sl_no", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(x).alias("value")) for f, x in zip(schema.D_FIELDS, ("opening", "closing"), strict=True)])))
    return packed.of_cells(cells)


def run_attempts(cells: DataFrame, readings: Sequence[DataFrame] = (), most: int = 3, **more) -> tuple[DataFrame, DataFrame]:
    """(cells, log): each document's best attempt, and (doc_id, attempt, rate, passed, kept) of all that were made.

    cells: the form's cells of the first reading (doc_id, block, sl_no, field, value); readings: cells of others, by the order
    in which they are tried, whose amounts that aren't 0 replace those of documents that failed so far. ``more`` goes
    to ``run_forms``. Of equal rates the earlier attempt is kept. Attempts end when all documents pass, after ``most``, or with the
    last reading. Null values count as 0; an empty table gives empty ones."""
    begun = packed.absent(packed.of_cells(cells.select(*merges.CELL, F.coalesce("value", F.lit(0.0)).alias("value"))))
    tried = run_forms(begun, readings, most, **more)
    return packed.cells_of(with_kept(tried).where("kept")), with_kept(tried.drop("form"))


def run_forms(active: DataFrame, readings: Sequence[DataFrame] = (), most: int = 3, components: DataFrame | None = None, mapping: DataFrame | None = None, order: dict[str, int] | None = None, face: DataFrame | None = None, first: DataFrame | None = None) -> DataFrame:
    """(doc_id, attempt, rate, passed, form) of all attempts over forms (doc_id, form); readings are cells, and so is
    ``first``, which is put into the forms before the first attempt. Each attempt is one job."""
    mapped = None if components is None or mapping is None else forms.stored(mapped_cells(components, mapping, order or {}), "mapped")
    fixes = None if first is None else packed.of_cells(first)
    tried = None
    for attempt in range(1, min(most, len(readings) + 1) + 1):
        now = forms.stored(packed.attempted(active, fixes, mapped, face), "attempt").where("rate is not null")
        numbered = now.select("doc_id", F.lit(attempt).alias("attempt"), "rate", "passed", "form")
        tried = numbered if tried is None else tried.unionByName(numbered)
        active = now.where("not passed")
        if attempt > min(most - 1, len(readings)) or active.isEmpty():
            break
        fixes = packed.of_cells(readings[attempt - 1].where("value is not null"))
    return tried


def with_kept(tried: DataFrame) -> DataFrame:
    """Attempts with ``kept``: whether it is the document's best one, the earlier on ties."""
    best = Window.partitionBy("doc_id").orderBy(F.desc("rate"), "attempt")  # a document's attempts, of which there are few
    return tried.withColumn("kept", F.row_number().over(best) == 1)
