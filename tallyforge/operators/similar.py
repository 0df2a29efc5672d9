"""Similarity joins of labels without comparing all with all.

Two texts within an edit distance share most of their q-grams, so that of the rarest few of each at least one is
common: only texts that meet there are compared, by the built-in edit distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import clean_label

Q = 2
PAD = "\u0001"


def grams(text: Column, q: int = Q) -> Column:
    """The q-grams of a padded text, repeated ones numbered, so that counts of common grams are counts of a set."""
    padded = F.concat(F.lit(PAD * (q - 1)), text, F.lit(PAD * (q - 1)))
    raw = F.transform(F.sequence(F.lit(1), F.length(padded) - (q - 1)), lambda i: F.substring(padded, i, F.lit(q)))
    counted = F.transform(raw, lambda g, i: F.struct(g.alias("g"), F.size(F.filter(F.slice(raw, F.lit(1), i + 1), lambda x: x == g)).alias("n")))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.transform(counted, lambda c: F.concat(c["g"], c["n"].cast("string"))))


def likeness(a: Column, b: Column) -> Column:
    """1 less the edit distance over the longer length."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def similar_pairs(left: DataFrame, right: DataFrame, least: float = 0.8, q: int = Q) -> DataFrame:
    """(left_text, right_text, likeness) of all distinct texts of two one-column tables that are at least so like.

    Texts are lower-cased with white space collapsed; null and blank ones are like nothing. ``least`` must leave a text more
    grams than edits can destroy (above q / (q + 1)). The candidates are the pairs that share one of their rarest
    grams, of lengths that allow the likeness."""
    if least <= q / (q + 1):
        raise ValueError(f"with {q}-grams the likeness must exceed {q / (q + 1):g}")
    longest = (1 - least) / least  # edits that a text's partner may differ by, of its length

    def texts(df: DataFrame, side: int) -> DataFrame:
        t = clean_label(F.col(df.columns[0]))
        return df.select(t.alias("t")).where("t != ''").distinct().withColumn("side", F.lit(side))

    rows = texts(left, 0).unionByName(texts(right, 1)).select("side", "t", F.length("t").alias("n"), F.explode(grams(F.col("t"), q)).alias("g"))
    often = rows.groupBy("g").agg(F.count("*").alias("often"))
    # any order of grams that both sides share will do; the rarest first leave the fewest candidates
    rank = F.row_number().over(Window.partitionBy("side", "t").orderBy("often", "g"))  # of one text
    first = rows.join(often, "g").withColumn("rank", rank).where(F.col("rank") <= F.floor(F.col("n") * longest + 1e-9) * q + 1)
    side = lambda k, name: first.where(F.col("side") == k).select("g", F.col("t").alias(f"{name}_text"), F.col("n").alias(f"{name}_n"))
    met = side(0, "left").join(side(1, "right"), "g")
    edits = F.floor(F.greatest("left_n", "right_n") * (1 - least) + 1e-9).cast("int")
    met = met.where(F.abs(F.col("left_n") - F.col("right_n")) <= edits).select("left_text", "right_text").distinct()
    return met.withColumn("likeness", likeness(F.col("left_text"), F.col("right_text"))).where(F.col("likeness") >= least - 1e-9)


def best_similar(labels: DataFrame, aliases: DataFrame, least: float = 0.8, column: str = "label") -> DataFrame:
    """labels with canonical and likeness: the alias most like each label, the first by ordinal on ties; null if there is none.

    aliases is (canonical, alias, ordinal)."""
    pairs = similar_pairs(labels.select(column), aliases.select("alias"), least)
    known = aliases.select("canonical", clean_label(F.col("alias")).alias("right_text"), "ordinal")
    best = pairs.join(known, "right_text").groupBy("left_text").agg(F.max(F.struct("likeness", (-F.col("ordinal")).alias("o"), "canonical")).alias("b"))
    keyed = labels.withColumn("__t", clean_label(F.col(column)))
    return keyed.join(best.withColumnRenamed("left_text", "__t"), "__t", "left").drop("__t").withColumns({"canonical": F.col("b.canonical"), "likeness": F.col("b.likeness")}).drop("b")
