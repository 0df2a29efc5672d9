"""Readers of pages, grids, rules and golden statements; adapters from the driver's tables.

OCR engines and model endpoints are functions that the caller registers: none is part of this library,
and none is on the tested path. A reader runs an engine over Arrow batches of images, each worker
loading it once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.rules import RULES
from ..plans import schema

PAGE_TEXT = "doc_id string, page_no int, engine string, text string"


@dataclass(frozen=True)
class Settings:
    """Limits and gates; ``from_options`` reads them from strings, as given on a command line or by an environment."""

    tolerance: float = 0.02
    least_quality: float = 95.0
    least_financial: float = 100.0
    attempts: int = 3
    rounds: int = 5
    dpi: int = 300
    opening_year: int = 2023
    closing_year: int = 2024

    @classmethod
    def from_options(cls, options: dict[str, str]) -> Settings:
        return cls(**{f.name: type(f.default)(options[f.name]) for f in fields(cls) if f.name in options})


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Text files named ``page_<n>.txt`` in a folder for each document, as page_text."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("p"), F.col("value").alias("text"))
    return files.select(F.regexp_extract("p", r"([^/]+)/[^/]*$", 1).alias("doc_id"), F.regexp_extract("p", r"page_0*(\d+)", 1).try_cast("int").alias("page_no"), F.lit("page").alias("engine"), "text")


@lru_cache(16)
def _engine(name: str, load: Callable[[], Callable[[bytes], list[str]]]) -> Callable[[bytes], list[str]]:
    return load()


def read_documents(spark: SparkSession, path: str, engines: dict[str, Callable[[], Callable[[bytes], list[str]]]]) -> tuple[DataFrame, DataFrame]:
    """(page_text, errors) of the binary documents below a path, named by their files; see ``pages_of``."""
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).alias("doc_id"), "content")
    return pages_of(files, engines)


def text_layer() -> Callable[[bytes], list[str]]:
    """The engine that reads the text layer of PDF files."""
    from .pdf import page_texts

    return page_texts


def pages_of(files: DataFrame, engines: dict[str, Callable[[], Callable[[bytes], list[str]]]]) -> tuple[DataFrame, DataFrame]:
    """(page_text, errors) of documents (doc_id string, content), each engine turning a file's bytes into a list of page texts.

    A file that an engine can't read is a row of errors (doc_id, engine, error); other files go on."""

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, content in zip(batch["doc_id"], batch["content"], strict=True):
                for name, load in engines.items():
                    try:
                        out += [(doc_id, k, name, t, None) for k, t in enumerate(_engine(name, load)(content), 1)]
                    except Exception as error:  # an engine's own failure is data
                        out.append((doc_id, 0, name, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(out, columns=["doc_id", "page_no", "engine", "text", "error"])

    rows = files.mapInPandas(pages, PAGE_TEXT + ", error string")
    return rows.where("error is null").drop("error"), rows.where("error is not null").select("doc_id", "engine", "error")


def merge_engines(pages: DataFrame, table_engine: str = "box") -> DataFrame:
    """(doc_id, page_no, text, table_text): a row a page; text of the page engine, with the table engine's beside it."""
    table = F.max(F.when(F.col("engine") == table_engine, F.col("text")))
    page = F.max(F.when(F.col("engine") != table_engine, F.col("text")))
    return pages.groupBy("doc_id", "page_no").agg(F.coalesce(page, F.lit("")).alias("text"), table.alias("table_text"))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule JSON (profiles, each with rows of add, subtract, zero, or both sides apart) as (profile, sl_no, side, key, sign)."""
    side = "add array<string>, subtract array<string>"
    row = f"struct<{side.replace(' array', ':array')}, zero:boolean, opening:struct<{side.replace(' array', ':array')}>, closing:struct<{side.replace(' array', ':array')}>>"
    kind = f"profiles map<string, struct<detect_patterns:array<string>, block_d:map<string, {row}>>>"
    df = spark.read.schema(kind).option("multiLine", True).json(path).select(F.explode("profiles").alias("profile", "p")).select("profile", F.explode("p.block_d").alias("sl", "r"))
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.coalesce(F.col(f"r.{s}.add"), F.col("r.add")).alias("add"), F.coalesce(F.col(f"r.{s}.subtract"), F.col("r.subtract")).alias("sub")) for s in ("opening", "closing")])
    df = df.select("profile", F.col("sl").cast("int").alias("sl_no"), "r", F.explode(sides).alias("s"))
    signed = lambda c, n: F.transform(F.coalesce(c, F.expr("cast(array() as array<string>)")), lambda k: F.struct(k.alias("key"), F.lit(n).alias("sign")))
    zero = F.when(F.coalesce("r.zero", F.lit(False)), F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(0).alias("sign")))).otherwise(F.concat(signed(F.col("s.add"), 1), signed(F.col("s.sub"), -1)))
    return df.select("profile", "sl_no", "s.side", F.explode(zero).alias("k")).select("profile", "sl_no", "side", "k.key", "k.sign").to(spark.createDataFrame([], RULES).schema)


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """Golden statements (company, psl, block_c, block_d) as cells with doc_id from the file's name."""
    c = ", ".join(f"{f}:double" for f in schema.C_FIELDS)
    kind = f"company string, psl string, block_c array<struct<sl_no:int, asset_type:string, {c}>>, block_d array<struct<sl_no:int, item_name:string, opening_rs:double, closing_rs:double>>"
    df = spark.read.schema(kind).option("multiLine", True).json(path).withColumn("doc_id", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)\.json$", 1))
    out = None
    for block, name in (("C", "block_c"), ("D", "block_d")):
        rows = df.select("doc_id", F.inline(name)).select("doc_id", "sl_no", *schema.FIELDS[block]).unpivot(["doc_id", "sl_no"], list(schema.FIELDS[block]), "field", "value").where("value is not null")
        rows = rows.select("doc_id", F.lit(block).alias("block"), "sl_no", "field", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


# --- adapters from the driver's tables


def document_pages(docs: DataFrame) -> DataFrame:
    """``documents`` as one-page documents."""
    return docs.select("doc_id", F.lit(1).alias("page_no"), F.coalesce("text", F.lit("")).alias("text"))


def conversation_pages(conv: DataFrame) -> DataFrame:
    """``conversations`` as documents with a page for each turn."""
    return conv.select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("page_no"), F.coalesce("text", F.lit("")).alias("text"))


def web_pages(pages: DataFrame) -> DataFrame:
    """``pages`` as one-page documents of their visible text."""
    return pages.select(F.col("page_id").alias("doc_id"), F.lit(1).alias("page_no"), T.html_unescape(T.strip_tags(F.coalesce("html", F.lit("")))).alias("text"))
