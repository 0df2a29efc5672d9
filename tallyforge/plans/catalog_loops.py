"""Queries of loops: attempts over a statement for each of ``documents``, and pages that arrive in a stream."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import forms, merges, packed
from ..session import shared_path, table
from ..streaming import assemble, ingest
from . import attempts, dictionaries, schema
from .catalog import query

#: Source rows of block D, and what each amount is.
_LEAVES = (1, 3, 5, 6, 8, 9, 10, 12, 13, 14, 17)
_VALUE = "(doc_id * 7919 % 900000 + 100000 + {sl} * 1000 + {side})"

# by doc_id % 5: 0 passes at once (every other one by a component), 1 with the second reading, 2 with the third, 3 gets worse, 4 never passes
_LACK = {0: "sl = 9 AND doc_id % 2 = 0", 1: "sl = 9", 2: "sl IN (9, 13)", 3: "sl = 9", 4: "sl IN (9, 12)"}


def _signed(sl: int, side: int) -> str:
    return _VALUE.format(sl=sl, side=side)


def _row_16(side: int) -> str:
    """SQL: working capital of the attempt that is kept."""
    v = lambda sl: _signed(sl, side)
    there = {9: "r IN (3, 4)", 12: "r = 4"}  # what the kept attempt lacks
    part = lambda sl: f"CASE WHEN {there[sl]} THEN 0 ELSE {v(sl)} END" if sl in there else v(sl)
    return " + ".join(part(sl) for sl in (1, 3, 5, 6, 8, 9, 10)) + " - (" + " + ".join(part(sl) for sl in (12, 13, 14)) + ")"


@query(
    "attempt_loop",
    f"""WITH n AS (SELECT doc_id, doc_id % 5 AS r, doc_id % 3 = 0 AS assets FROM documents),
l AS (
  SELECT doc_id, r, assets, CAST(t AS INT) AS attempt, CASE WHEN r = 0 THEN 0 WHEN r = 1 THEN CASE t WHEN 1 THEN 1 ELSE 0 END WHEN r = 2 THEN CASE t WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END
    WHEN r = 3 THEN CASE t WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 5 END ELSE 2 END AS bad,
    CASE WHEN r = 3 THEN t - 1 ELSE 0 END AS extra
  FROM n CROSS JOIN (VALUES (1), (2), (3)) v(t) WHERE t <= CASE r WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END)
SELECT l.doc_id, l.attempt, round(100.0 * (21 + extra + CASE WHEN assets THEN 42 ELSE 0 END - bad) / (21 + extra + CASE WHEN assets THEN 42 ELSE 0 END), 6) AS rate, bad = 0 AS passed,
       attempt = CASE r WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END AS kept,
       CASE WHEN attempt = CASE r WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END THEN CAST({_row_16(0)} AS DOUBLE) END AS capital_opening,
       CASE WHEN attempt = CASE r WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END THEN CAST({_row_16(1)} AS DOUBLE) END AS capital_closing,
       CASE WHEN assets AND attempt = CASE r WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END THEN CAST(2700000 + 6 * (doc_id % 1000) + 6 * 500 AS DOUBLE) END AS assets_closing
FROM l""",
)
def attempt_loop(spark, sf):
    """Statements that pass at the first, second or third attempt, that get worse and are restored, or never pass."""
    docs = table(spark, sf, "documents").select("doc_id", F.expr("doc_id % 5").alias("r"))
    d_cells = F.array(*[F.struct(F.lit(sl).alias("sl"), F.lit(f).alias("field"), F.expr(_signed(sl, side)).cast("double").alias("v")) for sl in _LEAVES for side, f in enumerate(schema.D_FIELDS)])
    right = docs.select("doc_id", "r", F.inline(d_cells)).select("doc_id", "r", F.lit("D").alias("block"), F.col("sl").alias("sl_no"), "field", F.col("v").alias("value"), "sl")
    lacks = F.expr("CASE " + " ".join(f"WHEN r = {r} THEN {cond}" for r, cond in _LACK.items()) + " END")
    # assets: a gross value that grows by 700, depreciated by 200 more
    base = F.expr("sl * 100000 + doc_id % 1000")
    values = {
        "gross_opening": base + 50000, "gross_addition_actual": F.lit(700.0), "gross_closing": base + 50700, "dep_up_to_beginning": F.lit(50000.0),
        "dep_provided_during_year": F.lit(200.0), "dep_up_to_end": F.lit(50200.0), "net_opening": base, "net_closing": base + 500,
    }
    assets = docs.where("doc_id % 3 = 0").select("doc_id", F.explode(F.sequence(F.lit(2), F.lit(7))).alias("sl"))
    c_rows = assets.select("doc_id", F.col("sl").alias("sl_no"), *[values.get(f, F.lit(0.0)).cast("double").alias(f) for f in schema.C_FIELDS])
    first = right.where(~lacks).select(*merges.CELL, "value").unionByName(merges.to_cells(c_rows, "C").select(*merges.CELL, "value"))
    wrong = lambda sl: right.where((F.col("r") == 3) & (F.col("sl") == sl)).withColumn("value", -F.col("value"))
    second = right.where("r in (1, 2) and sl = 9").unionByName(wrong(10)).select(*merges.CELL, "value")
    third = right.where("r = 2 and sl = 13").unionByName(wrong(12)).select(*merges.CELL, "value")
    components = docs.where("r = 0 and doc_id % 2 = 0").select("doc_id", F.lit("face.trade_receivables").alias("key"), F.expr(_signed(9, 0)).cast("double").alias("opening"), F.expr(_signed(9, 1)).cast("double").alias("closing"))
    tried = attempts.run_forms(packed.empty(docs), [second, third], components=components, mapping=dictionaries.mapping_rules(spark), order=dictionaries.PROFILE_ORDER, first=first)
    at = lambda *cell: F.get("form", F.lit(forms.PLACES.index(cell)))
    sums = {"capital_opening": at("D", 16, "opening_rs"), "capital_closing": at("D", 16, "closing_rs"), "assets_closing": F.nullif(at("C", 10, "net_closing"), F.lit(0.0))}
    out = attempts.with_kept(tried.select("doc_id", "attempt", "rate", "passed", *[x.alias(n) for n, x in sums.items()]))
    return out.select("doc_id", "attempt", F.round("rate", 6).alias("rate"), "passed", "kept", *[F.when(F.col("kept"), F.col(n)).alias(n) for n in sums])


# --- pages as they arrive


@query(
    "pages_assembled",
    """WITH p AS (SELECT conv_id AS doc_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INT) AS page_no, CAST(count(*) OVER (PARTITION BY conv_id) AS INT) AS n_pages, coalesce(text, '') AS text FROM conversations),
k AS (SELECT * FROM p WHERE NOT (doc_id % 7 = 3 AND page_no = n_pages))
SELECT doc_id, any_value(n_pages) AS n_pages, CAST(count(*) AS INT) AS found, count(*) = any_value(n_pages) AS complete, string_agg(text, chr(10) ORDER BY page_no) AS text FROM k GROUP BY doc_id""",
)
def pages_assembled(spark, sf):
    """Conversations as documents whose turns arrive shuffled, some twice, some too late, over restarts of the stream."""
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("int")  # of one conversation
    pages = table(spark, sf, "conversations").select("conv_id", "text", number.alias("page_no"), F.count("*").over(Window.partitionBy("conv_id")).cast("int").alias("n_pages"))
    begin = F.lit("2024-01-01 00:00:00").cast("timestamp")
    after = lambda seconds: F.timestamp_seconds(F.unix_timestamp(begin) + seconds)
    pages = pages.select(F.col("conv_id").alias("doc_id"), "page_no", "n_pages", "text", after(F.col("page_no")).alias("ts"))
    missing = (F.col("doc_id") % 7 == 3) & (F.col("page_no") == F.col("n_pages"))
    first = F.pmod(F.xxhash64("doc_id", "page_no"), F.lit(2)) == 0
    again = pages.where(~missing & first & (F.col("doc_id") % 3 == 0)).withColumn("text", F.concat(F.lit("again "), F.coalesce("text", F.lit(""))))
    end = spark.range(1).select(F.lit(-1).cast("bigint").alias("doc_id"), F.lit(1).alias("page_no"), F.lit(2).alias("n_pages"), F.lit("").alias("text"), after(F.lit(86_400)).alias("ts"))
    arrivals = (pages.where(~missing & first), pages.where(~missing & ~first).unionByName(again), end, pages.where(missing))
    inbox, out, checkpoint = (shared_path(spark, x) for x in ("inbox", "assembled", "assembled-state"))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, assemble.ROCKSDB)
    try:
        for batch in arrivals:  # each ends the stream, and the next goes on from the checkpoint
            batch.write.mode("append").parquet(inbox)
            stream = assemble.assembled(spark.readStream.schema(pages.schema).parquet(inbox), wait=60, late="1 minute")
            ingest.write_available(stream, out, checkpoint).awaitTermination()
    finally:
        spark.conf.unset(provider) if before is None else spark.conf.set(provider, before)
    return spark.read.schema(assemble.OUT).parquet(out)
