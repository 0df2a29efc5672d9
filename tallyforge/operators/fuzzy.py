"""Similarity of labels and the best canonical match, header mapping, table classification.

Scores are Arrow UDFs over distinct labels only. Two measures: ``token_set`` compares the sets of
words (shared words count fully, the rest by sequence), ``partial`` slides the shorter text over the
longer one. Both are 0 to 100."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.window import Window

from ..functions.text import clean_label

ACCEPT, ASSIST, HEADER, BLOCK = 80.0, 50.0, 55.0, 70.0
MOST_ALIASES = 10_000  # that are broadcast


def _ratio(a: str, b: str) -> float:
    return 200.0 * sum(m.size for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()) / (len(a) + len(b)) if a or b else 100.0


@lru_cache(100_000)
def token_set(a: str, b: str) -> float:
    """100 if one's words contain the other's; else the best ratio of the shared words with and without the rest."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    one, two = (" ".join(filter(None, (both, " ".join(sorted(d))))) for d in (x - y, y - x))
    if both and (one == both or two == both):
        return 100.0
    return max(_ratio(one, two), *((_ratio(both, one), _ratio(both, two)) if both else (0.0,)))


@lru_cache(100_000)
def partial(a: str, b: str) -> float:
    """The best ratio of the shorter text with an equally long part of the longer one."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0
    if short in long:
        return 100.0
    starts = {max(0, m.b - m.a) for m in SequenceMatcher(None, short, long, autojunk=False).get_matching_blocks()}
    return max(_ratio(short, long[s : s + len(short)]) for s in starts)


@F.pandas_udf(DoubleType())
def token_set_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def partial_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([partial(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


def _dealt(table: DataFrame) -> DataFrame:
    """A dictionary as the small side of a comparison: broadcast if it is small, else left to the planner."""
    return F.broadcast(table) if table.count() <= MOST_ALIASES else table


def best_match(labels: DataFrame, aliases: DataFrame, least: float = ASSIST, column: str = "label") -> DataFrame:
    """labels with canonical, score and needs_review: the alias most like each label, the first by ordinal on ties.

    aliases is (canonical, alias, ordinal). Of each distinct label those aliases come first whose words hold the
    label's or are held by them (score 100): an equi-join on words, without Python. Only labels without such an
    alias are scored against all of them."""
    words = lambda c: F.array_distinct(F.filter(F.split(clean_label(c), " "), lambda w: w != ""))
    distinct = labels.select(F.col(column).alias("__l")).where("__l is not null").distinct().withColumn("__w", words(F.col("__l")))
    known = aliases.withColumn("__v", words(F.col("alias")))
    # a word of the smaller set is a word of the larger one: the pairs meet on any word
    meet = distinct.withColumn("__t", F.explode("__w")).join(known.withColumn("__t", F.explode("__v")), "__t")
    held = meet.where((F.size(F.array_except("__w", "__v")) == 0) | (F.size(F.array_except("__v", "__w")) == 0))
    whole = held.groupBy("__l").agg(F.max(F.struct(F.lit(100.0).alias("score"), (-F.col("ordinal")).alias("o"), "canonical")).alias("b"))
    rest = distinct.select("__l").join(whole.select("__l"), "__l", "left_anti")
    scored = rest.crossJoin(_dealt(aliases)).withColumn("score", token_set_score(clean_label(F.col("__l")), clean_label(F.col("alias"))))
    best = scored.groupBy("__l").agg(F.max(F.struct("score", (-F.col("ordinal")).alias("o"), "canonical")).alias("b")).where(F.col("b.score") >= least)
    out = labels.join(whole.unionByName(best), labels[column] == F.col("__l"), "left").drop("__l")
    return out.withColumns({"canonical": F.col("b.canonical"), "score": F.coalesce("b.score", F.lit(0.0)), "needs_review": F.coalesce(F.col("b.score") < ACCEPT, F.lit(True))}).drop("b")


def map_headers(cells: DataFrame, aliases: DataFrame, keys: tuple[str, ...] = ("table_id",), least: float = HEADER) -> DataFrame:
    """Columns of tables (keys, col, header) to fields by their headers; a field that no header names takes, in
    order, a column that has none (confidence 55)."""
    found = best_match(cells, aliases, least, "header").withColumnsRenamed({"canonical": "field", "score": "confidence"}).drop("needs_review")
    by = list(keys)
    first = Window.partitionBy(*by, "field").orderBy(F.col("confidence").desc(), "col")
    found = found.withColumn("__n", F.row_number().over(first)).withColumn("field", F.when(F.col("__n") == 1, F.col("field"))).drop("__n")
    fields = aliases.groupBy(F.col("canonical").alias("field")).agg(F.min("ordinal").alias("o"))
    lacking = cells.select(*by).distinct().crossJoin(F.broadcast(fields)).join(found.where("field is not null").select(*by, "field"), [*by, "field"], "left_anti")
    lacking = lacking.withColumn("__k", F.row_number().over(Window.partitionBy(*by).orderBy("o"))).select(*by, "__k", F.col("field").alias("__f"))
    unknown = found.where("field is null").withColumn("__k", F.row_number().over(Window.partitionBy(*by).orderBy("col"))).select(*by, "col", "__k")
    patch = unknown.join(lacking, [*by, "__k"]).select(*by, "col", "__f")
    out = found.join(patch, [*by, "col"], "left")
    return out.select(*by, "col", "header", F.coalesce("field", "__f").alias("field"), F.when(F.col("field").isNotNull(), F.col("confidence")).when(F.col("__f").isNotNull(), 55.0).otherwise(0.0).alias("confidence"))


def columns_by_position(tables: DataFrame, fields: list[str], width: str = "n_cols") -> DataFrame:
    """Fields by position where headers tell nothing (confidence 60): the first column is the label."""
    names = F.array(*[F.lit(f) for f in fields])
    return tables.select("*", F.posexplode(F.slice(names, F.lit(1), F.greatest(F.col(width) - 1, F.lit(0)))).alias("p", "field")).withColumn("col", F.col("p") + 1).drop("p").withColumn("confidence", F.lit(60.0))


def classify_tables(tables: DataFrame, signals: DataFrame, text: str = "text", width: str = "n_cols") -> DataFrame:
    """tables (table_id, text of the first rows, number of columns) with block C, D or unknown by their
    likeness to signal phrases (block, phrase)."""
    score = tables.select("table_id", clean_label(F.col(text)).alias("t")).crossJoin(_dealt(signals)).withColumn("s", partial_score("phrase", "t"))
    of = lambda b: F.max(F.when(F.col("block") == b, F.col("s")).otherwise(0.0)).alias(b)
    out = tables.join(score.groupBy("table_id").agg(of("C"), of("D")), "table_id", "left")
    w = F.col(width)
    kind = F.when((F.col("C") > BLOCK) & (w >= 5), "C").when((F.col("D") > BLOCK) & (w >= 2), "D").when((F.col("C") >= F.col("D")) & (F.col("C") > 0), F.when(w >= 5, "C").otherwise("unknown")).when((F.col("D") > 0) & (w >= 2), "D").otherwise("unknown")
    return out.withColumn("block", kind).drop("C", "D")


def header_row(rows: Column) -> Column:
    """Index of the first row of a grid of which more than half the cells are not numbers; 0 if there is none."""
    numeric = lambda c: F.trim(c).rlike(r"^[\s()\-0-9.,]*[0-9][\s()\-0-9.,]*$")
    header = F.transform(rows, lambda r: F.size(F.filter(r, lambda c: ~numeric(c) & (F.trim(c) != ""))) * 2 > F.size(r))
    return F.greatest(F.array_position(header, True) - 1, F.lit(0)).cast("int")


def row_values(cells: Column, columns: Column) -> Column:
    """map<field, value> of a row of cells by array<struct<field, col>>; columns out of range are left out."""
    from ..functions.numbers import parse_number

    there = F.filter(columns, lambda c: c["field"].isNotNull() & (c["col"] < F.size(cells)))
    return F.map_from_entries(F.transform(there, lambda c: F.struct(c["field"], parse_number(F.get(cells, c["col"])))))
