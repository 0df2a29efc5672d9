"""Language identification by error-correcting output codes.

Each language has a codeword of bits. For each bit a binary classifier over hashed character
n-grams tells on which side a text lies. Decoding sums the bits' logistic losses against each
codeword, weighted by how well the bit's classifier did on texts held back from its training, and
takes the language with the least. A text is flagged as ambiguous where its two best codewords cost
nearly the same: the second costs less than ``1 + clear`` times the first, where ``clear`` is a quarter
of the least such margin among the held-back texts that were decoded rightly. So the flag depends on
two codewords only, however many there are.

The classifiers are fitted on a bounded sample of labelled rows: ``per_language`` of each, fewer where
more than ``MOST_ROWS`` came together, those with the smallest hash of doc_id and text; rows that are
equal in both count once. Predictions read whole texts and nothing else.

Defined results: a text that is null or has no letter is ``und`` with score 0 and isn't ambiguous;
with no labelled row all texts are; with one language all other texts have it, with score 1; rows
without lang serve prediction only; repeated rows are predicted each; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import ngrams
from .common import arrow_bounds, fresh, release, text_or_empty, utf8_buffers, written

UND = "und"
PER_LANGUAGE = 250  # labelled rows of each language that the classifiers are fitted on, at most
MOST_ROWS = 10_000  # of all languages together
SHARP = 4.0  # steepness of the score

_LETTER = regex.compile(r"\p{L}")


def codebook(n: int, seed: int = 5) -> np.ndarray:
    """Codewords (n rows of bits): all splits for up to six languages, else the best of random codes."""
    if n <= 6:
        return np.array([[1] * (2 ** (n - 1) - 1)] + [[(c >> (n - 1 - r)) & 1 for c in range(2 ** (n - 1) - 1)] for r in range(1, n)], np.int8).reshape(n, -1) if n > 1 else np.zeros((n, 0), np.int8)
    rng, length = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, apart = None, -1
    for _ in range(50):
        code = rng.integers(0, 2, (n, length), np.int8)
        near = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        used = code.min(0) != code.max(0)
        if near > apart and used.all():
            best, apart = code, near
    return best


@dataclass
class Model:
    """Languages, their codewords, the bits' classifiers and weights."""

    languages: list[str]
    code: np.ndarray
    w: np.ndarray
    b: np.ndarray
    trust: np.ndarray
    clear: float = 0.0

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its score, and how much more the second one costs, as a share, for each row of margins."""
        if not self.code.shape[1]:
            return np.zeros(len(margins), int), np.ones(len(margins)), np.full(len(margins), np.inf)
        sign = 2.0 * self.code - 1
        loss = np.stack([(self.trust * np.logaddexp(0, -margins * s)).sum(1) for s in sign], 1) / self.trust.sum()
        p = np.exp(-SHARP * (loss - loss.min(1, keepdims=True)))
        p /= p.sum(1, keepdims=True)
        two = np.partition(loss, 1, 1)[:, :2]
        return loss.argmin(1), p.max(1), two[:, 1] / np.maximum(two[:, 0], 1e-12) - 1


def fit(x: np.ndarray, names: list[str], seed: int = 5) -> Model:
    """Classifiers for the bits; a fifth of the rows is held back to weigh them."""
    languages = sorted(set(names))
    code = codebook(len(languages), seed)
    if len(languages) < 2:
        return Model(languages, code, np.zeros((ngrams.DIM, 0), np.float32), np.zeros(0, np.float32), np.zeros(0))
    y = code[[languages.index(x) for x in names]]
    held = np.arange(len(x)) % 5 == 4
    if held.sum() < 20 or len(set(np.array(names)[~held])) < len(languages):
        held[:] = False
    w, b = ngrams.logistic(x, y, use=~held)
    seen = held if held.any() else ~held
    margins = (x @ w + b)[seen]
    loss = np.logaddexp(0, -margins * (2.0 * y[seen] - 1)).mean(0)
    model = Model(languages, code, w, b, 1 / (0.05 + loss))
    best, _, gap = model.decode(margins)
    right = gap[np.array(languages)[best] == np.array(names)[seen]]
    model.clear = float(right.min()) / 4 if len(right) else 0.0
    return model


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, h, text) of labelled rows with the smallest hash of doc_id and text, up to the bound for each language.

    One scan estimates how many different rows a language has, another keeps those below a hash that nearly
    surely leaves enough; equal rows collapse where they are read, and the few that are left are ranked."""
    rows = docs.where("lang is not null").select(F.col("lang").cast("string").alias("lang"), text_or_empty().alias("text"), F.col("doc_id").cast("string").alias("id"))
    rows = rows.select("lang", "text", F.xxhash64("id", "text", F.lit("sample")).alias("h"))
    counts = written(rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")), "languages")
    each = max(1, min(per_language, MOST_ROWS // max(1, counts.count())))
    share = F.least(F.lit(1.0), F.lit(1.25 * (each + 6 * each**0.5 + 20)) / F.greatest("n", F.lit(1)))
    # a number for each language; a hash may lie below share of the range of 64 bits
    few = rows.join(counts.select("lang", share.alias("share")), "lang").where((F.col("h") / F.lit(2.0**64) + 0.5) <= F.col("share"))
    few = few.groupBy("lang", "h").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    return few.withColumn("rank", rank).where(F.col("rank") <= each).drop("rank")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on a bounded sample of docs; the n-grams are counted on the executors."""
    release()
    rows = sample(docs, per_language).select("lang", "text", "h")

    def vectors(batches):
        import pyarrow as pa

        for batch in batches:
            x = ngrams.features(*utf8_buffers(batch.column(1))).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "h", "x"])

    got = sorted(rows.mapInArrow(vectors, "lang string, h bigint, x binary").collect(), key=lambda r: (r["h"], r["lang"], r["x"]))
    if not got:
        return Model([], np.zeros((0, 0), np.int8), np.zeros((ngrams.DIM, 0), np.float32), np.zeros(0, np.float32), np.zeros(0))
    x, names = np.zeros((len(got), ngrams.DIM), np.float32), [r["lang"] for r in got]
    for k, r in enumerate(got):
        x[k] = np.frombuffer(r["x"], np.float16)
    del got
    model = fit(x, names)
    del x
    release()
    return model


def predict(docs: DataFrame, model: Model, names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """docs with lang_pred, score and ambiguous (by these or other names, in place of columns of the same name)
    from the text alone; no shuffle."""
    arrow_bounds(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: DIM weights a bit

    def label(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        m = shared.value
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            n = batch.num_rows
            data, at = utf8_buffers(text)
            letters = np.array([bool(_LETTER.search(x)) if x else False for x in pc.fill_null(text, "").to_pylist()], bool)
            best, score, gap = np.zeros(n, int), np.zeros(n), np.full(n, np.inf)
            if m.languages:
                margins = np.zeros((n, len(m.b)))
                for k, c in enumerate(ngrams.counts(data, at)):
                    at_k = c.nonzero()[0]
                    v = np.sqrt(c[at_k])
                    margins[k] = (v @ m.w[at_k]) / max(1e-9, np.sqrt(c.sum())) + m.b
                best, score, gap = m.decode(margins)
            known = letters & bool(m.languages)
            labels = pa.array(np.array([*m.languages, UND], object)[np.where(known, best, -1)], pa.string())
            cols = [*batch.columns[:-1], labels, pa.array(np.where(known, score, 0.0)), pa.array(known & (gap < m.clear))]
            yield pa.RecordBatch.from_arrays(cols, names_)

    fields = [f for f in docs.schema.fields if f.name not in names]
    names_ = [f.name for f in fields] + list(names)
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    schema = StructType([*fields, *[StructField(n, t) for n, t in zip(names, (StringType(), DoubleType(), BooleanType()), strict=True)]])
    return docs.select(*[F.col(f"`{f.name}`") for f in fields], F.col("text").cast("string").alias(fresh(docs, "text")[0])).mapInArrow(label, schema)


def held_out() -> Column:
    """Rows that no classifier may learn from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out()))
    out = F.coalesce(held_out(), F.lit(False)).alias("held_out")
    return predict(docs.select("doc_id", out, "text"), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The rows whose language is known and clear; all their columns. Labels come from docs itself."""
    model = train(docs.where(~held_out()))
    lang, _, ambiguous = names = fresh(docs, "lang_pred", "score", "ambiguous")
    kept = predict(docs, model, tuple(names)).where((F.col(lang) != UND) & ~F.col(ambiguous))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
