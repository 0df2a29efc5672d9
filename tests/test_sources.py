"""Readers, workbooks, streams and the catalogue."""

import glob
import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyforge.logs import RunLogs
from tallyforge.plans import catalog, catalog_forms, catalog_loops, catalog_notes, catalog_search, schema  # noqa: F401
from tallyforge.sources import models, pdf, readers, sinks, xlsx
from tallyforge.streaming import ingest

SF = "/root/testdata/sf0.001"


def test_page_files_and_engines(spark, tmp_path):
    (tmp_path / "doc1").mkdir()
    (tmp_path / "doc1" / "page_02.txt").write_text("two\nlines")
    rows = readers.read_page_files(spark, str(tmp_path / "*" / "*.txt")).collect()
    assert [(r.doc_id, r.page_no, r.text) for r in rows] == [("doc1", 2, "two\nlines")]

    def load():
        return lambda content: content.decode().split("\f")

    (tmp_path / "bin").mkdir()
    (tmp_path / "bin" / "a.pdf").write_bytes(b"one\ftwo")
    (tmp_path / "bin" / "b.pdf").write_bytes(b"\xff")
    text, errors = readers.read_documents(spark, str(tmp_path / "bin"), {"page": load})
    assert {(r.doc_id, r.page_no, r.text) for r in text.collect()} == {("a", 1, "one"), ("a", 2, "two")}
    assert [(r.doc_id, "UnicodeDecodeError" in r.error) for r in errors.collect()] == [("b", True)]


def test_rules_and_golden(spark, tmp_path):
    rule = {"profiles": {"p": {"detect_patterns": ["x"], "block_d": {"1": {"add": ["a", "b"], "subtract": ["c"]}, "2": {"zero": True}, "9": {"opening": {"add": ["o"]}, "closing": {"add": ["k"], "subtract": ["m"]}}}}}}
    (tmp_path / "r.json").write_text(json.dumps(rule, indent=1))
    got = {tuple(r) for r in readers.read_rules(spark, str(tmp_path / "r.json")).collect()}
    assert got == {("p", 1, s, k, g) for s in ("opening", "closing") for k, g in (("a", 1), ("b", 1), ("c", -1))} | {("p", 2, s, None, 0) for s in ("opening", "closing")} | {("p", 9, "opening", "o", 1), ("p", 9, "closing", "k", 1), ("p", 9, "closing", "m", -1)}
    (tmp_path / "g.json").write_text(json.dumps({"company": "c", "block_c": [{"sl_no": 1, "net_opening": 5}], "block_d": [{"sl_no": 8, "opening_rs": 1.5, "closing_rs": 2}]}))
    got = {(r.doc_id, r.block, r.sl_no, r.field, r.value) for r in readers.read_golden(spark, str(tmp_path / "g.json")).collect()}
    assert got == {("g", "C", 1, "net_opening", 5.0), ("g", "D", 8, "opening_rs", 1.5), ("g", "D", 8, "closing_rs", 2.0)}


def test_settings():
    s = readers.Settings.from_options({"tolerance": "0.05", "attempts": "2", "other": "x"})
    assert (s.tolerance, s.attempts, s.dpi) == (0.05, 2, 300)


def test_engines_are_merged(spark):
    p = spark.createDataFrame([(1, 1, "page", "a"), (1, 1, "box", "b"), (1, 2, "box", "c")], "doc_id int, page_no int, engine string, text string")
    assert {(r.page_no, r.text, r.table_text) for r in readers.merge_engines(p).collect()} == {(1, "a", "b"), (2, "", "c")}


def test_workbooks_round_trip(spark):
    c = spark.createDataFrame([(1, 2, "Building", *[float(k) for k in range(11)])], "doc_id bigint, sl_no int, label string, " + ", ".join(f"{f} double" for f in schema.C_FIELDS))
    d = spark.createDataFrame([(1, 4, "Sub <&> total", 3.0, 0.0), (2, 1, "Raw", 1.0, 2.0)], "doc_id bigint, sl_no int, label string, opening_rs double, closing_rs double")
    books = xlsx.statement_workbooks(c, d)
    assert xlsx.read_workbook(bytes(books.where("doc_id = 1").first().content))["Block D"][1] == [4.0, "Sub <&> total", 3.0, None]
    cells = {(r.doc_id, r.block, r.sl_no, r.field): r.value for r in xlsx.read_statement_workbooks(books).collect()}
    assert cells[1, "C", 2, "net_closing"] == 10.0 and cells[1, "D", 4, "closing_rs"] == 0.0 and cells[2, "D", 1, "closing_rs"] == 2.0


def test_sinks(spark, tmp_path):
    pages = spark.createDataFrame([("d", 1, "text")], "doc_id string, page_no int, text string")
    sinks.write_page_texts(pages, str(tmp_path / "t"))
    assert [tuple(r) for r in sinks.read_page_texts(spark, str(tmp_path / "t")).collect()] == [("d", 1, "text")]
    checks = spark.createDataFrame([(1, "A", True), (1, "B", False)], "doc_id int, code string, ok boolean")
    got = json.loads(sinks.nested_report(checks).first().json)
    assert (got["total_checks"], got["passed"], got["failed"], len(got["fields"])) == (2, 1, 1, 2)
    sinks.write_json(checks, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_pages_arrive_as_a_stream(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"p{k}").mkdir()
        spark.createDataFrame([(f"d{k}", 1, "page", "schedule 8 inventories in lakhs 1,234.5")], readers.PAGE_TEXT).write.mode("append").json(str(tmp_path / "in"))
    q = ingest.write_available(ingest.route(ingest.page_stream(spark, str(tmp_path / "in"), 1)), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 3 and {(tuple(r.tags), r.unit, r.n_tokens) for r in rows} == {(("block_d",), "lakhs", 2)}


def test_streamed_sessions_equal_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    events.write.parquet(str(tmp_path / "e"))
    late = spark.createDataFrame([(-1, "2100-01-01 00:00:00", 0.0)], "user_id bigint, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    ingest.write_available(ingest.sessions(stream), out, cp).awaitTermination()
    late.write.mode("append").parquet(str(tmp_path / "e"))  # moves the watermark past all sessions
    ingest.write_available(ingest.sessions(stream), out, cp).awaitTermination()
    got = {(r.user_id, r.start, r.n) for r in spark.read.parquet(out).collect()}
    assert got == {(r.user_id, r.start, r.n) for r in ingest.sessions(events).collect()}


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_queries_match_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f if os.path.isfile(f) else f + '/*.parquet'}'")
    got = catalog.QUERIES[name](spark, SF)
    want = con.execute(catalog.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    show = lambda v: round(float(v), 4) if isinstance(v, (int, float)) and not isinstance(v, bool) else list(v) if isinstance(v, (list, tuple)) else v
    rows = lambda some: sorted(str([show(v) for v in r]) for r in some)
    assert rows([tuple(r) for r in got.select(*columns).collect()]) == rows(want.fetchall())


def test_entry_works_without_the_text_operators(tmp_path):
    """In a copy without the subpackage, its pipeline and its tests, and where a dependency of it can't be imported."""
    root = Path(__file__).resolve().parent.parent
    show = "import sys, __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), set(e.oracle_sql()) <= set(e.queries()))"
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    run = lambda code, at: subprocess.run([sys.executable, "-B", "-c", code], cwd=at, capture_output=True, text=True, check=True).stdout.split()
    assert run(show, tmp_path / "r") == [str(len(catalog.QUERIES)), "False", "True"]
    assert run("import sys; sys.modules['regex'] = None\n" + show, root)[2] == "True"


def test_run_logs(tmp_path, capsys):
    logs = RunLogs("some file.pdf", str(tmp_path))
    logs.mapping.warning("row %d is off", 3)
    logs.ocr.debug("only in the file")
    logs.close()
    assert "WARNING  | tallyforge.some_file.mapping | row 3 is off" in (tmp_path / "some_file/mapping.log").read_text()
    assert "only in the file" in (tmp_path / "some_file/ocr.log").read_text()
    shown = capsys.readouterr().err
    assert "\033[33mWARNING" in shown and "only in" not in shown


def test_legend_and_models(spark):
    c = spark.createDataFrame([(1, 1, "Land", *[0.0] * 11)], "doc_id bigint, sl_no int, label string, " + ", ".join(f"{f} double" for f in schema.C_FIELDS))
    d = spark.createDataFrame([(1, 1, "Raw", 3.0, 0.0)], "doc_id bigint, sl_no int, label string, opening_rs double, closing_rs double")
    tries = spark.createDataFrame([(1, 1, 80.0, 2, "APPROVED", 1.5, "x")], "doc_id bigint, attempt int, rate double, failures int, status string, seconds double, issues string")
    book = xlsx.read_workbook(bytes(xlsx.statement_workbooks(c, d, attempts=tries).first().content))
    assert [r[1] for r in book["Legend"][1:]] == [text for _, text in xlsx.LEGEND] and book["Audit Log"][1] == [1.0, 80.0, 2.0, "APPROVED", 1.5, "x"]
    answers = iter(["", "fine"])
    assert models.with_retry(lambda payload, timeout: next(answers), {}, 1.0, (0.0, 0.0)) == ("fine", 2, None)
    assert not models.is_alive("http://127.0.0.1:9/", 0.2)


def test_pdf_text_layer():
    assert pdf.content_text(b"BT (a\\(b\\)\\101) Tj T* [(He) -300 (llo)] TJ 0 -12 Td <FEFF00E9> Tj 5 0 Td (x) Tj ET") == "a(b)A\nHe llo\n\u00e9\tx"
    assert pdf.page_texts(pdf.make([["one", "two (2)"], [], ["\u00e9"]], deflate=False)) == ["one\ntwo (2)", "", "\u00e9"]
    with pytest.raises(ValueError):
        pdf.page_texts(b"%PDF-1.4 nothing")


def test_workbooks_are_dealt_out_to_all_tasks(spark):
    """Rows of few bytes were put into one task, and each document was a pandas group."""
    d = spark.range(40).selectExpr("id AS doc_id", "1 AS sl_no", "'Raw' AS label", "1D AS opening_rs", "2D AS closing_rs")
    c = d.selectExpr("doc_id", "sl_no", "'Land' AS label", *[f"0D AS {f}" for f in schema.C_FIELDS])
    books = xlsx.statement_workbooks(c, d)
    assert books.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and books.select("doc_id").distinct().count() == 40
