"""Mapping rules as data: components to rows by signed sums, choice of profile, search for formulas.

Rules are (profile, sl_no, side, key, sign), a side being ``opening`` or ``closing``; a rule that
makes a row zero has no key and sign 0. Components are (doc_id, key, opening, closing)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RULES = "profile string, sl_no int, side string, key string, sign int"


def evaluate(components: DataFrame, rules: DataFrame) -> DataFrame:
    """(doc_id, profile, sl_no, opening, closing) by every profile; rows that are all 0 are left out.

    Rules are as many as the form's rows and keys: they are broadcast if they are no more than 10,000."""
    used = rules.where("sign != 0")
    hit = components.join(F.broadcast(used) if used.count() <= 10_000 else used, "key")
    side = lambda s: F.sum(F.when(F.col("side") == s, F.col(s) * F.col("sign")).otherwise(0.0)).alias(s)
    return hit.groupBy("doc_id", "profile", "sl_no").agg(side("opening"), side("closing")).where("opening != 0 or closing != 0")


def choose_profile(mapped: DataFrame, order: dict[str, int]) -> DataFrame:
    """(doc_id, profile, covered): the profile that yields most rows, the first by order on ties."""
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in order.items() for x in kv]), F.col("profile"))
    n = mapped.groupBy("doc_id", "profile").agg(F.countDistinct("sl_no").alias("covered"))
    return n.groupBy("doc_id").agg(F.max(F.struct("covered", (-rank).alias("o"), "profile")).alias("b")).select("doc_id", "b.profile", "b.covered")


def best_rows(components: DataFrame, rules: DataFrame, order: dict[str, int]) -> DataFrame:
    """(doc_id, profile, sl_no, opening, closing): the non-zero rows of each document's best profile."""
    mapped = evaluate(components, rules)
    return mapped.join(choose_profile(mapped, order).select("doc_id", "profile"), ["doc_id", "profile"])


def apply_mapping(rows: DataFrame, components: DataFrame, rules: DataFrame, order: dict[str, int]) -> DataFrame:
    """Block D rows overwritten by the non-zero rows of each document's best profile; missing ones are added."""
    new = best_rows(components, rules, order).select("doc_id", "sl_no", F.struct("opening", "closing").alias("n"))
    both = rows.join(new, ["doc_id", "sl_no"], "full_outer")
    return both.withColumns({"opening_rs": F.coalesce("n.opening", "opening_rs", F.lit(0.0)), "closing_rs": F.coalesce("n.closing", "closing_rs", F.lit(0.0))}).drop("n")


def find_formulas(components: DataFrame, targets: DataFrame, tol: float = 0.02, most_terms: int = 3) -> DataFrame:
    """(doc_id, sl_no, formula, terms): the signed sum of fewest components that meets a target
    (doc_id, sl_no, opening, closing) in both columns within a share; ties go to the first in order of keys.

    Combinations are built up within a document, key by ascending key, from a bounded number of components."""
    signed = components.select("doc_id", "key", F.explode(F.array(F.lit(1), F.lit(-1))).alias("s")).join(components, ["doc_id", "key"])
    one = signed.select("doc_id", "key", F.concat(F.when(F.col("s") > 0, "+").otherwise("-"), "key").alias("f"), (F.col("opening") * F.col("s")).alias("o"), (F.col("closing") * F.col("s")).alias("c"))
    level = one.select("doc_id", F.col("key").alias("last"), F.col("f").alias("formula"), "o", "c", F.lit(1).alias("terms"))
    found = None
    for terms in range(1, most_terms + 1):
        near = lambda want, got: F.abs(F.col(want) - F.col(got)) <= tol * F.greatest(F.abs(F.col(want)), F.lit(1.0))
        hit = targets.join(level, "doc_id").where(near("opening", "o") & near("closing", "c")).select("doc_id", "sl_no", "formula", "terms")
        found = hit if found is None else found.unionByName(hit)
        if terms < most_terms:
            more = one.select("doc_id", F.col("key").alias("k"), F.col("f").alias("g"), F.col("o").alias("o2"), F.col("c").alias("c2"))
            level = level.join(more, "doc_id").where("k > last").select("doc_id", F.col("k").alias("last"), F.concat("formula", "g").alias("formula"), (F.col("o") + F.col("o2")).alias("o"), (F.col("c") + F.col("c2")).alias("c"), F.lit(terms + 1).alias("terms"))
    first = Window.partitionBy("doc_id", "sl_no").orderBy("terms", "formula")
    return found.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def merge_formulas(found: DataFrame) -> DataFrame:
    """(sl_no, formula, variants): a row's formula if all documents agree; else null and the variants."""
    v = found.groupBy("sl_no").agg(F.array_sort(F.collect_set("formula")).alias("variants"))
    return v.select("sl_no", F.when(F.size("variants") == 1, F.get("variants", F.lit(0))).alias("formula"), "variants")


def values_near(tokens: DataFrame, targets: DataFrame, tol: float = 0.02) -> DataFrame:
    """Tokens (doc_id, value, ...) within a share of a target (target_id, target): a band join.

    Values of a band lie in the band's or a neighbouring cell of a logarithmic grid, so that it is an
    equi-join on the cell, not a comparison of all with all."""
    step = tol * 2 / (1 - tol)
    cell = lambda v: F.floor(F.log(v) / F.log(F.lit(1 + step))).cast("bigint")
    t = targets.where("target > 0").withColumn("__c", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: cell(F.col("target")) + d)))
    hit = tokens.where("value > 0").withColumn("__c", cell(F.col("value"))).join(t, "__c")
    return hit.where(F.abs(F.col("value") - F.col("target")) <= tol * F.col("target")).drop("__c")
