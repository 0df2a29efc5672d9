"""Search for formulas by meeting in the middle.

A formula of n signed terms is a first half of n div 2 terms and a rest; what a half lacks to a target is looked up
among the others on a grid as fine as the tolerance. Halves are made within a document's
row, so that a document costs its half sums, not its sums; a half is a number of eight bits a term until it is met."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_path

MOST_COMPONENTS = 126  # that eight bits tell apart


def _with_halves(parts: DataFrame, most: int) -> DataFrame:
    """h1, h2, ...: signed sums of 1 to ``most`` components in order of their keys, each made from the one before."""

    def single(p: Column, i: Column) -> Column:
        return F.array(*[F.struct(i.alias("first"), i.alias("last"), (2 * i + 1 + s).cast("bigint").alias("code"), (p["opening"] * (2 * s - 1)).alias("o"), (p["closing"] * (2 * s - 1)).alias("c")) for s in (0, 1)])

    def grown(h: Column) -> Column:
        rest = F.slice("h1", 2 * h["last"] + 3, F.size("h1"))  # two for each component after the last
        return F.transform(rest, lambda s: F.struct(h["first"].alias("first"), s["last"].alias("last"), (h["code"] * 256 + s["code"]).alias("code"), (h["o"] + s["o"]).alias("o"), (h["c"] + s["c"]).alias("c")))

    out = parts.select("doc_id", F.flatten(F.transform("parts", single)).alias("h1"))
    for n in range(2, most + 1):
        out = out.withColumn(f"h{n}", F.flatten(F.transform(f"h{n - 1}", grown)))
    return out


def _terms(code: Column, n: Column) -> Column:
    """The bytes of a half's number, in order."""
    return F.filter(F.transform(F.array(*[F.lit(k) for k in (5, 4, 3, 2, 1, 0)]), lambda k: F.when(k < n, F.floor(code / F.pow(F.lit(256.0), k)).cast("bigint") % 256)), lambda b: b.isNotNull())


def search(components: DataFrame, targets: DataFrame, tol: float = 0.02, most_terms: int = 5) -> DataFrame:
    """(doc_id, sl_no, formula, terms): the signed sum of fewest components (doc_id, key, opening, closing) that meets
    a target (doc_id, sl_no, opening, closing) in both columns within a share; of as many, the first by
    its keys in order, then by its signs, minus first.

    Keys are taken in ascending order, each once. Longer formulas are looked for only where there is none of three
    terms. Components of a document are collected into its row: they are a statement's, some dozen; more than 126 end
    the query with an error. Null amounts count as 0; documents without components or targets have no rows."""
    shared_path(components.sparkSession, "formulas")  # sets the checkpoint folder
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    parts = components.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("key", zero("opening"), zero("closing")))).alias("parts"))
    parts = parts.withColumn("parts", F.when(F.size("parts") <= MOST_COMPONENTS, F.col("parts")).otherwise(F.raise_error(F.lit("too many components in a document"))))
    goals = targets.select("doc_id", "sl_no", zero("opening"), zero("closing"))
    found = _met(parts, goals, tol, range(1, min(3, most_terms) + 1))
    if most_terms > 3:
        found = found.checkpoint()
        rest = goals.join(found.select("doc_id", "sl_no"), ["doc_id", "sl_no"], "left_anti")
        found = found.unionByName(_met(parts, rest, tol, range(4, most_terms + 1)))
    return found


def _met(parts: DataFrame, goals: DataFrame, tol: float, sizes: range) -> DataFrame:
    """The best formula of these numbers of terms for each target."""
    width = lambda t: tol * F.greatest(F.abs(t), F.lit(1.0))
    lefts, rights = sorted({n // 2 for n in sizes}), sorted({n - n // 2 for n in sizes})
    levels = _with_halves(parts.join(goals.select("doc_id").distinct(), "doc_id", "left_semi"), rights[-1])
    none = F.array(F.struct(F.lit(0).alias("n"), F.lit(-1).alias("first"), F.lit(-1).alias("last"), F.lit(0).cast("bigint").alias("code"), F.lit(0.0).alias("o"), F.lit(0.0).alias("c")))
    half = lambda n: F.transform(F.col(f"h{n}"), lambda h: F.struct(F.lit(n).alias("n"), h["first"], h["last"], h["code"], h["o"], h["c"])) if n else none
    side = lambda ns: levels.select("doc_id", F.concat(*[half(n) for n in ns]).alias("h")).join(goals, "doc_id").select("doc_id", "sl_no", "opening", "closing", F.inline("h"))
    cell = lambda v: F.floor(v / width(F.col("opening")))
    right = side(rights).select("doc_id", "sl_no", cell(F.col("o")).alias("cell"), F.col("n").alias("n2"), "first", F.col("code").alias("code2"), F.col("o").alias("o2"), F.col("c").alias("c2"))
    left = side(lefts).drop("first").withColumn("cell", F.explode(F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: cell(F.col("opening") - F.col("o")) + d)))
    near = lambda want, a, b: F.abs(F.col(want) - (F.col(a) + F.col(b))) <= width(F.col(want))
    both = (F.col("n") + F.col("n2")).isin(*sizes) & (F.col("n2") - F.col("n")).between(0, 1)
    # halves are hundreds of rows for each of a small vector's bytes: by its size Spark would send them all through the driver
    hits = left.join(right.hint("merge"), ["doc_id", "sl_no", "cell"]).where((F.col("last") < F.col("first")) & both & near("opening", "o", "o2") & near("closing", "c", "c2"))
    found = hits.select("doc_id", "sl_no", F.concat(_terms(F.col("code"), F.col("n")), _terms(F.col("code2"), F.col("n2"))).alias("t"))
    place = lambda b: F.floor((b - 1) / 2).cast("int")
    order = F.struct(F.size("t").alias("terms"), F.transform("t", place).alias("at"), F.transform("t", lambda b: ((b - 1) % 2).cast("int")).alias("plus"))
    best = found.groupBy("doc_id", "sl_no").agg(F.min(order).alias("b")).join(parts.hint("merge"), "doc_id")
    text = F.array_join(F.zip_with("b.at", "b.plus", lambda i, s: F.concat(F.when(s == 1, "+").otherwise("-"), F.get("parts", i)["key"])), "")
    return best.select("doc_id", "sl_no", text.alias("formula"), F.col("b.terms").alias("terms"))
