"""Accuracy against golden statements, verification of amounts in a text, best attempts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers
from ..functions.closeness import close_quality, percent_error
from ..plans import schema
from .merges import CELL

GOLDEN_FIELDS = ("gross_closing", "dep_up_to_end", "net_opening", "net_closing", "opening_rs", "closing_rs")


def against_golden(cells: DataFrame, golden: DataFrame, tol: float = 0.02, fields: tuple[str, ...] = GOLDEN_FIELDS, close: Callable[[Column, Column, float], Column] = close_quality) -> DataFrame:
    """A row for each golden source cell that isn't 0: got (0 where missing), expected, ok, pct_error.

    close: when (expected, got, tol) are close enough; by default within a share of the larger, with ``close_target`` of the expected amount."""
    form = F.broadcast(schema.template(golden.sparkSession).where("not is_derived").select("block", "sl_no"))
    want = golden.where((F.col("value") != 0) & F.col("field").isin(*fields)).join(form, ["block", "sl_no"], "left_semi").select(*CELL, F.col("value").alias("expected"))
    out = want.join(cells.select(*CELL, F.col("value").alias("got")), CELL, "left").withColumn("got", F.coalesce("got", F.lit(0.0)))
    return out.withColumns({"ok": close(F.col("expected"), F.col("got"), tol), "pct_error": percent_error(F.col("got"), F.col("expected"))})


def accuracy(matches: DataFrame) -> DataFrame:
    """(doc_id, block, fields, passed, pct, missing): per block and, with a null block, over all."""
    return matches.rollup("doc_id", "block").agg(F.count(F.lit(1)).alias("fields"), F.count_if("ok").alias("passed"), (F.avg(F.col("ok").cast("int")) * 100).alias("pct"), F.count_if((F.col("expected") != 0) & (F.col("got") == 0)).alias("missing")).where("doc_id is not null")


def mapping_pct(cells: DataFrame, rows_of_form: int = 27) -> DataFrame:
    """Share of the form's rows that have an amount, in percent."""
    return cells.where("value != 0").select("doc_id", "block", "sl_no").distinct().groupBy("doc_id").agg((F.count(F.lit(1)) / rows_of_form * 100).alias("mapping_pct"))


def verified_in_text(cells: DataFrame, texts: DataFrame, least_rate: float = 0.85) -> DataFrame:
    """(doc_id, verified, total, rate, status): amounts that stand in their document's text (doc_id, text).

    The text's number tokens are a set; amounts are joined with it in each of their written forms, so that
    no text is searched once for each amount."""
    token = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[0-9]+(?:[,.][0-9]+)*"), F.lit(0))
    tokens = texts.select("doc_id", F.explode(F.array_distinct(token)).alias("form")).distinct()
    some = cells.where("value != 0")
    forms = some.select(*CELL, F.explode(numbers.number_variants(F.col("value"))).alias("form"))
    seen = forms.join(tokens, ["doc_id", "form"], "left_semi").select(*CELL).distinct().withColumn("seen", F.lit(1))
    out = some.join(seen, CELL, "left").groupBy("doc_id").agg(F.count("seen").alias("verified"), F.count(F.lit(1)).alias("total"))
    return out.withColumn("rate", F.col("verified") / F.col("total")).withColumn("status", F.when(F.col("rate") >= least_rate, "APPROVED").otherwise("REJECTED"))


def best_attempt(attempts: DataFrame, rate: str = "rate") -> DataFrame:
    """Of each document's attempts the one with the best rate, the earlier on ties."""
    best = F.max(F.struct(F.col(rate), (-F.col("attempt")).alias("o"), F.struct(*[c for c in attempts.columns if c not in ("doc_id",)]).alias("x")))
    return attempts.groupBy("doc_id").agg(best.alias("b")).select("doc_id", "b.x.*")


def summary_lines(report: DataFrame) -> DataFrame:
    """One printable line for each row of ``accuracy``."""
    name = F.coalesce("block", F.lit("all"))
    return report.select("doc_id", F.format_string("%s: %.2f%% (%d of %d fields, %d missing)", name, "pct", "passed", "fields", "missing").alias("line"))
