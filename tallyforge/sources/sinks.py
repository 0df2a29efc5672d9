"""Sinks of statements, reports and page texts: Parquet, JSON, text and workbooks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a line."""
    df.write.mode("overwrite").json(path)


def nested_report(checks: DataFrame) -> DataFrame:
    """(doc_id, json): a document's checks as one nested JSON object with their counts."""
    row = F.struct(*[c for c in checks.columns if c != "doc_id"])
    one = checks.groupBy("doc_id").agg(F.array_sort(F.collect_list(row)).alias("fields"), F.count(F.lit(1)).alias("total_checks"), F.count_if("ok").alias("passed"))  # a document's checks are bounded
    return one.select("doc_id", F.to_json(F.struct("doc_id", "fields", "total_checks", "passed", (F.col("total_checks") - F.col("passed")).alias("failed"))).alias("json"))


def write_page_texts(pages: DataFrame, path: str, buckets: int = 64) -> None:
    """Page texts as Parquet in a fixed number of folders by hash of the document; names stay columns."""
    bucket = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(buckets)).cast("int")
    pages.select("doc_id", "page_no", "text", bucket.alias("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_page_texts(spark: SparkSession, path: str, schema: str = "doc_id string, page_no int, text string") -> DataFrame:
    """What ``write_page_texts`` wrote."""
    return spark.read.schema(schema).parquet(path).drop("bucket")


def write_workbooks(books: DataFrame, path: str) -> None:
    """(doc_id, content) as Parquet: one binary file a row, for any store that Spark writes to."""
    books.write.mode("overwrite").parquet(path)
