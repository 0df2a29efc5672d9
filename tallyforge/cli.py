"""Command line: extract statements from page texts, score them against golden ones, write workbooks.

    python -m tallyforge.cli extract --pages 'in/*/page_*.txt' --out out [--golden 'golden/*.json']
    python -m tallyforge.cli verify --cells out/cells --golden 'golden/*.json' [--least 95]

Exit code 0: all documents pass; 1: some don't (everything is written all the same); 2: nothing was read."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import merges, scores
from .plans import statement
from .sources import readers, sinks, xlsx


def publishable(report: DataFrame, verified: DataFrame, least: float) -> DataFrame:
    """The documents' reports with ``publishable``: enough checks pass, and amounts stand in the text."""
    return report.join(verified.select("doc_id", "status"), "doc_id", "left").withColumn("publishable", (F.col("score_pct") >= least) & (F.coalesce("status", F.lit("APPROVED")) == "APPROVED"))


def extract(spark: SparkSession, pages: str, out: str, least: float = 95.0) -> int:
    """Cells, checks, reports and workbooks of all documents, written below ``out``."""
    text = readers.merge_engines(readers.read_page_files(spark, pages)).select("doc_id", "page_no", F.concat_ws("\n", "table_text", "text").alias("text"))
    done = statement.run_batch(text)
    done["cells"].write.mode("overwrite").parquet(f"{out}/cells")
    cells = spark.read.parquet(f"{out}/cells")
    rows = {b: merges.template_merge(merges.to_rows(cells, b), b) for b in "CD"}
    sinks.write_workbooks(xlsx.statement_workbooks(rows["C"], rows["D"]), f"{out}/workbooks")
    sinks.write_json(done["checks"], f"{out}/checks")
    report = publishable(done["report"], done["verified"], least)
    sinks.write_json(report, f"{out}/report")
    report = spark.read.json(f"{out}/report")
    if report.isEmpty():
        return 2
    return int(not report.where("not publishable").isEmpty())


def verify(spark: SparkSession, cells: str, golden: str, least: float = 95.0) -> tuple[int, list[str]]:
    """Scores of written cells against golden statements: exit code, and a line for each document and block."""
    report = scores.accuracy(scores.against_golden(spark.read.parquet(cells), readers.read_golden(spark, golden)))
    lines = [r.line for r in scores.summary_lines(report).orderBy("doc_id", "line").limit(1_000).collect()]  # a screenful of a report
    if not lines:
        return 2, lines
    return int(not report.where(F.col("pct") < least).isEmpty()), lines


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tallyforge")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("extract")
    one.add_argument("--pages", required=True)
    one.add_argument("--out", required=True)
    one.add_argument("--golden")
    two = commands.add_parser("verify")
    two.add_argument("--cells", required=True)
    two.add_argument("--golden", required=True)
    for p in (one, two):
        p.add_argument("--least", type=float, default=95.0)
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tallyforge").getOrCreate()
    if a.command == "verify":
        code, lines = verify(spark, a.cells, a.golden, a.least)
    else:
        code, lines = extract(spark, a.pages, a.out, a.least), []
        if a.golden and code != 2:
            scored, lines = verify(spark, f"{a.out}/cells", a.golden, a.least)
            code = max(code, scored)
    print("\n".join(lines))
    return code


if __name__ == "__main__":
    sys.exit(main())
