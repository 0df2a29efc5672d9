"""Not-modified revisits of a web archive resolved to the response that they stand for.

A revisit (an answer 304) has no body. Its response is the latest full one of the same canonical
URL before it: an as-of join. Rows are dealt out by URL and by ranges of time, so that one URL may
hold any share of all rows: within a range a window carries the last response forward; over ranges
a table with the last response of each URL and range does. Bodies are not moved.

The revisit's validators are then compared with the response's: ``ETag`` (weak comparison) if the
revisit has one, else ``Last-Modified``. If they agree, the headers that an answer 304 may update
are merged into those of the response.

Defined results: ``state`` is ``resolved``, ``mismatch`` (validators differ), ``unchecked`` (no
validator on either side to compare: merged all the same) or ``orphan`` (no earlier response). A
response at the same time as a revisit isn't earlier; of responses at one time the one with the
larger record_id counts. Records without URL or time are orphans, as revisits, and resolve nothing,
as responses. Repeated revisits are resolved each. Header names are compared in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: What an answer 304 may update in a stored response (RFC 9110, 15.4.5, and freshness headers).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that don't select a resource.
TRACKING = r"^(utm_[a-z]+|fbclid|gclid)(=|$)"
ROWS_PER_RANGE = 2_000
QUANTILES = 1_024


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, then path without last slash, then the sorted
    query without tracking parameters; scheme and fragment don't count. Null for null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"#.*$", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda x: (x != "") & ~F.rlike(x, F.lit(TRACKING)))
    joined = F.array_join(F.array_sort(query), "&")
    return F.concat(host, path, F.when(joined == "", "").otherwise(F.concat(F.lit("?"), joined)))


def _lower_keys(headers: Column) -> Column:
    """Header names in lower case; of a name that comes twice the last value in the map's order stays."""
    entries = F.map_entries(F.coalesce(headers, F.expr("cast(map() as map<string,string>)")))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(names, i + 2, F.size(names)), lambda n: n == F.lower(e["key"])))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(F.lower(e["key"]), e["value"])))


def _ranges(df: DataFrame) -> DataFrame:
    """df with ``__range``, a number that grows with ts, of some thousand rows each."""
    n = df.agg(F.count("ts").alias("n")).first()["n"]
    q = max(1, min(QUANTILES, n // ROWS_PER_RANGE))
    cuts = df.agg(F.percentile_approx("ts", [i / q for i in range(1, q)], 20 * q).alias("x")).first()["x"] if q > 1 else []
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.expr("cast(array() as array<double>)")
    return df.withColumn("__range", F.size(F.filter(cuts, lambda c: c <= F.col("ts"))))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """A row for each revisit of (record_id, url, ts, kind, headers map<string,string>[, digest]).

    kind is ``response`` or ``revisit``. Returns record_id, canonical_url, ts, response_id,
    response_digest, state, headers (merged; of the revisit alone where it isn't resolved)."""
    digest = F.col("digest") if "digest" in records.columns else F.lit(None).cast("string")
    df = records.select("record_id", canonical_url(F.col("url")).alias("canonical_url"), F.col("ts").cast("double").alias("ts"), (F.col("kind") == "response").alias("full"), _lower_keys(F.col("headers")).alias("headers"), digest.alias("digest"))
    df = _ranges(written(df, "records"))
    usable = F.col("full") & F.col("canonical_url").isNotNull() & F.col("ts").isNotNull()
    place = F.struct("ts", "record_id")
    body = F.struct("record_id", "digest", F.map_entries("headers").alias("headers"))
    # within a range
    line = Window.partitionBy("canonical_url", "__range").orderBy("ts", "full", "record_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = df.withColumn("__near", F.last(F.when(usable, body), ignorenulls=True).over(line)).where("not full")
    # of ranges before: one row for each URL and range
    ends = df.where(usable).groupBy("canonical_url", "__range").agg(F.max_by(body, place).alias("__end"))
    asked = df.where("not full").select("canonical_url", "__range").distinct()
    steps = ends.join(asked, ["canonical_url", "__range"], "full")
    before = Window.partitionBy("canonical_url").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = steps.withColumn("__far", F.last("__end", ignorenulls=True).over(before)).select("canonical_url", "__range", "__far").where("__far is not null")
    found = near.join(written(carried, "carried"), ["canonical_url", "__range"], "left").withColumn("r", F.when(F.col("canonical_url").isNotNull() & F.col("ts").isNotNull(), F.coalesce("__near", "__far")))
    strong = lambda x: F.regexp_replace(x, "^W/", "")
    stored = F.map_from_entries("r.headers")
    found = found.withColumn("__stored", stored)
    etag, theirs = F.element_at("headers", "etag"), F.element_at("__stored", "etag")
    date, their_date = F.element_at("headers", "last-modified"), F.element_at("__stored", "last-modified")
    state = (
        F.when(F.col("r").isNull(), "orphan")
        .when(etag.isNotNull() & theirs.isNotNull(), F.when(strong(etag) == strong(theirs), "resolved").otherwise("mismatch"))
        .when(date.isNotNull() & their_date.isNotNull(), F.when(date == their_date, "resolved").otherwise("mismatch"))
        .otherwise("unchecked")
    )
    found = found.withColumn("state", state)
    allowed = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter("__stored", lambda k, _: ~F.array_contains(F.map_keys(allowed), k))
    merged = F.when(F.col("state").isin("resolved", "unchecked"), F.map_concat(kept, allowed)).otherwise(F.col("headers"))
    return found.select("record_id", "canonical_url", "ts", F.col("r.record_id").alias("response_id"), F.col("r.digest").alias("response_digest"), "state", merged.alias("headers"))


def page_records(pages: DataFrame) -> DataFrame:
    """Archive records of the ``pages`` table: of each page its response, and two answers 304 with the
    page's own validator, one just before it and one a hundred captures later."""
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    etag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    pages = pages.select(F.col("page_id").cast("bigint").alias("p"), "url", digest.alias("digest"), etag.alias("etag"), size.alias("size"))
    text = lambda x: F.concat(F.lit("t"), x.cast("string"))

    def kind(name: str, nr: int, ts: Column) -> Column:
        common = [F.lit("Date"), text(ts), F.lit("ETag"), F.col("etag")]
        headers = F.create_map(*common, F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.col("size")) if name == "response" else F.create_map(*common, F.lit("Content-Length"), F.lit("0"))
        return F.struct((F.col("p") * 3 + nr).alias("record_id"), ts.alias("ts"), F.lit(name).alias("kind"), headers.alias("headers"))

    rows = pages.select("url", "digest", F.explode(F.array(kind("response", 0, F.col("p") * 2), kind("revisit", 1, F.col("p") * 2 - 1), kind("revisit", 2, F.col("p") * 2 + 201))).alias("x"))
    return rows.select("x.record_id", "url", "x.ts", "x.kind", "x.headers", F.when(F.col("x.kind") == "response", F.col("digest")).alias("digest"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``pages``: their not-modified revisits resolved."""
    rows = resolve_revisits(page_records(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    merged = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return rows.select("record_id", "canonical_url", "response_id", "response_digest", "state", merged.alias("headers"))


SQL8 = r"""
WITH p AS (
  SELECT page_id AS p, url, sha256(coalesce(html, '')) AS digest, '"' || sha256(coalesce(html, ''))[1:16] || '"' AS etag,
         strlen(coalesce(html, '')) AS size,
         regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS bare
  FROM pages),
c AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
            || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS base,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|fbclid|gclid)(=|$)'))), '&') AS query
  FROM p),
u AS (SELECT *, base || CASE WHEN query = '' THEN '' ELSE '?' || query END AS canonical_url FROM c),
v AS (
  SELECT p * 3 + 1 AS record_id, canonical_url, p * 2 - 1 AS ts, etag FROM u
  UNION ALL SELECT p * 3 + 2, canonical_url, p * 2 + 201, etag FROM u),
r AS (SELECT p * 3 AS response_id, canonical_url, p * 2 AS ts, etag, digest, size FROM u),
j AS (
  SELECT v.*, r.response_id, r.digest AS response_digest, r.etag AS theirs, r.size
  FROM v ASOF LEFT JOIN r ON v.canonical_url = r.canonical_url AND v.ts > r.ts)
SELECT record_id, canonical_url, response_id, response_digest,
       CASE WHEN response_id IS NULL THEN 'orphan' WHEN etag = theirs THEN 'resolved' ELSE 'mismatch' END AS state,
       CASE WHEN response_id IS NOT NULL AND etag = theirs
            THEN 'content-length=' || size || ';content-type=text/html;date=t' || ts || ';etag=' || etag
            ELSE 'content-length=0;date=t' || ts || ';etag=' || etag END AS headers
FROM j
"""
