"""Workbooks as zipped XML, read and written with the standard library alone.

A statement's workbook is 27 rows of one document: sheets are made in the task that has the document's
rows (collected by doc_id, bounded by the form), never on the driver."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable
from functools import lru_cache
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006"
#: Fill colours of cell states.
FILLS = {"none": None, "green": "FFC6EFCE", "yellow": "FFFFEB9C", "red": "FFFFC7CE", "header": "FFD9E1F2"}


#: What the colours of cells stand for. Fixed values.
LEGEND = (
    ("green", "read from the pages, and found there once more"),
    ("yellow", "read with doubts: look at it"),
    ("red", "not to be found in the pages"),
    ("none", "nothing there"),
    ("header", "a sum of other rows"),
)
BOOKS = 500  # that a task holds at once
AUDIT_LOG = ("attempt", "rate", "failures", "status", "seconds", "issues")


@lru_cache(1_000)
def _letters(col: int) -> str:
    out = ""
    while True:
        col, rest = divmod(col, 26)
        out = chr(65 + rest) + out
        if not col:
            return out
        col -= 1


def _cell(row: int, col: int, value, style: int) -> str:
    at = f'r="{_letters(col)}{row}" s="{style}"'
    if value is None or value == "" or (isinstance(value, float) and value != value):
        return f"<c {at}/>"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f"<c {at}><v>{value!r}</v></c>"
    return f'<c {at} t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def workbook(sheets: dict[str, Iterable[Iterable]], states: dict[str, dict[tuple[int, int], str]] | None = None) -> bytes:
    """Bytes of a workbook: sheets as rows of values, the first a header; states: fill of (row, col) by name of FILLS."""
    names, styles = list(sheets), list(FILLS)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'<Types xmlns="{_PKG}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{parts}</Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{_PKG}/relationships"><Relationship Id="rId1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PKG}/relationships">' + "".join(f'<Relationship Id="rId{k}" Type="{_REL}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1)) + f'<Relationship Id="rIdS" Type="{_REL}/styles" Target="styles.xml"/></Relationships>')
        fills = "".join('<fill><patternFill patternType="none"/></fill>' if c is None else f'<fill><patternFill patternType="solid"><fgColor rgb="{c}"/></patternFill></fill>' for c in FILLS.values())
        xfs = "".join(f'<xf numFmtId="0" fontId="0" fillId="{k}" borderId="0" applyFill="1"/>' for k in range(len(styles)))
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{_MAIN}"><fonts count="1"><font/></fonts><fills count="{len(styles)}">{fills}</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="{len(styles)}">{xfs}</cellXfs></styleSheet>')
        for k, name in enumerate(names, 1):
            marks, style = (states or {}).get(name, {}), {n: k for k, n in enumerate(styles)}
            rows = []
            for r, row in enumerate(sheets[name], 1):
                rows.append(f'<row r="{r}">' + "".join(_cell(r, c, v, style["header" if r == 1 else marks.get((r - 1, c), "none")]) for c, v in enumerate(row)) + "</row>")
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(rows)}</sheetData></worksheet>')
    return buffer.getvalue()


@lru_cache(1_000)
def _column(letters: str) -> int:
    """The place of a column from its letters, from 1."""
    col = 0
    for x in letters:
        col = col * 26 + ord(x) - 64
    return col


def read_workbook(content: bytes) -> dict[str, list[list]]:
    """Sheets of a workbook as rows of text, numbers and None."""
    tag = {x: f"{{{_MAIN}}}{x}" for x in ("t", "si", "sheet", "row", "c", "v")}.__getitem__
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(tag("t"))) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(tag("si"))]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out = {}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(tag("sheet")):
            target = targets[sheet.get(f"{{{_REL}}}id")].lstrip("/")
            root = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            rows = []
            for row in root.iter(tag("row")):
                values: list = []
                for c in row.iter(tag("c")):
                    col = _column(c.get("r", "A").rstrip("0123456789"))
                    values += [None] * (col - 1 - len(values))
                    v, kind = c.find(tag("v")), c.get("t")
                    if kind == "inlineStr":
                        values.append("".join(t.text or "" for t in c.iter(tag("t"))))
                    elif v is None:
                        values.append(None)
                    elif kind == "s":
                        values.append(shared[int(v.text)])
                    else:
                        values.append(v.text if kind == "str" else float(v.text))
                rows.append(values)
            out[sheet.get("name")] = rows
    return out


def statement_workbooks(c_rows: DataFrame, d_rows: DataFrame, unit: float = 1.0, attempts: DataFrame | None = None) -> DataFrame:
    """(doc_id, content): a workbook for each document with a sheet for each block; zeros are blank, totals marked.

    With attempts (doc_id and the columns of ``AUDIT_LOG``) it has their log and a legend of the colours, too."""
    from ..plans import schema

    kind = dict(c_rows.dtypes)["doc_id"]
    value = lambda f: F.nullif(F.col(f) * unit, F.lit(0.0))
    c = c_rows.select("doc_id", F.lit("C").alias("block"), F.col("sl_no").cast("int").alias("sl_no"), "label", F.array(*[value(f) for f in schema.C_FIELDS]).alias("v"))
    d = d_rows.select("doc_id", F.lit("D").alias("block"), F.col("sl_no").cast("int").alias("sl_no"), "label", F.array(*[value(f) for f in schema.D_FIELDS]).alias("v"))

    def book(rows: list[dict]) -> bytes:
        sheets, states, of = {}, {}, {"log": [], **{block: [] for block in schema.FIELDS}}
        for row in sorted(rows, key=lambda r: r["sl_no"]):
            of[row["block"]].append(row)
        for block, fields in schema.FIELDS.items():
            name, part = f"Block {block}", of[block]
            sheets[name] = [["Sl. No.", "Item", *fields], *([r["sl_no"], r["label"], *r["v"]] for r in part)]
            states[name] = {(k, c): "green" for k, r in enumerate(part, 1) if r["sl_no"] in schema.DERIVED[block] for c in range(len(fields) + 2)}
        if of["log"]:
            # attempt, rate, failures, status, seconds, issues
            sheets["Audit Log"] = [list(AUDIT_LOG), *([r["sl_no"], *r["v"][:2], status, r["v"][2], issues] for r in of["log"] for status, issues in [r["label"].split("\t")])]
            sheets["Legend"] = [["Colour", "Meaning"], *(["", text] for _, text in LEGEND)]
            states["Legend"] = {(r, 0): state for r, (state, _) in enumerate(LEGEND, 1)}
        return workbook(sheets, states)

    def make(batches):
        import pyarrow as pa

        for batch in batches:
            for k in range(0, batch.num_rows, BOOKS):
                part = batch.slice(k, BOOKS)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([book(rows) for rows in part.column(1).to_pylist()], pa.binary())], ["doc_id", "content"])

    rows = c.unionByName(d)
    if attempts is not None:
        number = F.array(*[F.col(x).cast("double") for x in ("rate", "failures", "seconds")])
        label = F.concat_ws("\t", "status", F.coalesce("issues", F.lit("")))
        rows = rows.unionByName(attempts.select("doc_id", F.lit("log").alias("block"), F.col("attempt").cast("int").alias("sl_no"), label.alias("label"), number.alias("v")))
    # a workbook costs far more than its rows' few bytes tell, so that adaptive execution would make one or two tasks
    one = rows.groupBy("doc_id").agg(F.collect_list(F.struct("block", "sl_no", "label", "v")).alias("rows"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return one.repartition(tasks).mapInArrow(make, f"doc_id {kind}, content binary")


def read_audit_logs(files: DataFrame) -> DataFrame:
    """The attempts of workbooks (doc_id, content) that have their log."""
    kind = dict(files.dtypes)["doc_id"]

    def take(batches):
        for batch in batches:
            out = [(doc_id, int(r[0]), r[1], int(r[2]), r[3], r[4], r[5] or "") for doc_id, content in zip(batch["doc_id"], batch["content"], strict=True) for r in read_workbook(content).get("Audit Log", [])[1:]]
            yield pd.DataFrame(out, columns=["doc_id", *AUDIT_LOG])

    return files.select("doc_id", "content").mapInPandas(take, f"doc_id {kind}, attempt int, rate double, failures int, status string, seconds double, issues string")


def read_statement_workbooks(files: DataFrame) -> DataFrame:
    """cells of statement workbooks (doc_id, content): headers name the fields, blank cells are 0."""
    from ..plans import schema

    kind = dict(files.dtypes)["doc_id"]

    def take(batches):
        for batch in batches:
            out = []
            for doc_id, content in zip(batch["doc_id"], batch["content"], strict=True):
                for name, rows in read_workbook(content).items():
                    block = name[-1]
                    if block not in schema.FIELDS or not rows:
                        continue
                    for row in rows[1:]:
                        for header, v in zip(rows[0], row, strict=False):
                            if header in schema.FIELDS[block] and row[0]:
                                out.append((doc_id, block, int(row[0]), header, float(v or 0)))
            yield pd.DataFrame(out, columns=["doc_id", "block", "sl_no", "field", "value"])

    return files.select("doc_id", "content").mapInPandas(take, f"doc_id {kind}, block string, sl_no int, field string, value double")
