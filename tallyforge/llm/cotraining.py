"""Quality classification by co-training on two views of a document.

The text view has hashed byte n-grams of the whole text and how often they repeat; the metadata view has language, source,
length and the layout of lines, and never a word. Each view's logistic classifier starts from the
labelled sample. In each round both score all unlabelled documents, and a view's most confident ones of
either class (as many as the classes' shares among the labels grant) join the other view's training
set with the label it gave. In the end each view is calibrated on labelled documents that were held
back from its training, and the score of a document is a logistic combination of both calibrated
views.

The labelled sample is bounded (``MOST_LABELS``: the rows with the smallest hash of doc_id). The pool is
the whole table: a round is a scan that leaves two numbers a row, of which the ends are taken, and a scan
for the features of the few that were. Scoring reads all documents and shuffles nothing.

Defined results: a null text counts as empty and is scored; null metadata has a value of its own; a
doc_id with several labels counts once for each, rows that are equal in doc_id and text once in the sample and the pool; with labels of fewer than two classes all scores
are the share of good labels, or 0.5 with no label; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import ngrams
from .common import arrow_bounds, text_or_empty, utf8_buffers, written

MOST_LABELS = 1_500
ROUNDS = 4
GIVEN = 60  # pseudo-labels that a view gives in a round
META = 160
THRESHOLD = 0.5


REPEATS = 16 * 12


def _repeats(c: np.ndarray) -> int:
    """Which cell of length and repetition the counts of n-grams lie in."""
    total, distinct = max(1.0, c.sum()), max(1, np.count_nonzero(c))
    return min(15, int(np.log2(total))) * 12 + min(11, int(3 * np.log2(total / distinct)))


def text_features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Unit vectors of the square roots of n-gram counts, and which cell of repetition a text is in."""
    x = np.zeros((len(at) - 1, ngrams.DIM + REPEATS), np.float32)
    for k, c in enumerate(ngrams.counts(data, at, ngrams.ALL)):
        x[k, : ngrams.DIM] = np.sqrt(c / max(1.0, c.sum()))
        x[k, ngrams.DIM + _repeats(c)] = 0.5
    return x


def _bucket(kind: str, value: str | None, size: int) -> int:
    return zlib.crc32(f"{kind}={value}".encode()) % size


def meta_features(langs: list, sources: list, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row for each document: language, source, and numbers of its length and layout."""
    n = len(at) - 1
    x = np.zeros((n, META), np.float32)
    for k, (a, b) in enumerate(zip(langs, sources, strict=True)):
        x[k, 32 + _bucket("lang", a, 32)] = 0.5
        x[k, 64 + _bucket("source", b, 96)] = 0.5
    for k in range(n):
        b = data[at[k] : at[k + 1]]
        size = len(b)
        lines = int((b == 10).sum()) + 1
        space = int((b == 32).sum())
        x[k, :8] = np.log1p(size) / 8, np.log1p(lines) / 4, np.log1p(size / lines) / 6, space / max(1, size), lines / max(1, space + lines), size == 0, np.log1p(space / lines) / 4, 1
        x[k, 8 + min(15, int(np.log2(size + 1)))] = 1
        x[k, 24 + min(7, int(np.log2(lines)))] = 1
    return x


@dataclass
class Model:
    """Both views' weights, their calibrations, and how they are combined."""

    text: tuple[np.ndarray, float]
    meta: tuple[np.ndarray, float]
    combine: np.ndarray  # weights of both views' logits and a bias
    prior: float | None = None

    def score(self, text_margin: np.ndarray, meta_margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.prior is not None:
            p = np.full(len(text_margin), self.prior)
            return p, p, p
        s = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return s(self.combine[0] * text_margin + self.combine[1] * meta_margin + self.combine[2]), s(text_margin), s(meta_margin)


def _platt(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make a margin a log-odds, on documents that the margin's model hasn't seen."""
    x = np.stack([m / (np.abs(m).mean() + 1e-9)], 1).astype(np.float32)
    w, b = ngrams.logistic(x, y[:, None], rounds=400, l2=1e-2, rate=1.0)
    return float(max(0.0, w[0, 0]) / (np.abs(m).mean() + 1e-9)), float(b[0])


VIEWS = {"text": 4.0, "meta": 1.0}  # and the rate at which they learn


class ArrayPool:
    """Unlabelled documents as rows of two arrays."""

    def __init__(self, text: np.ndarray, meta: np.ndarray):
        self.x, self.given = {"text": text, "meta": meta}, {v: np.zeros(0, int) for v in VIEWS}

    def pick(self, models: dict, good: int, bad: int) -> dict[str, tuple[np.ndarray, list[float]]]:
        """For each view new rows for its training, with the labels that the other view is sure of."""
        out = {}
        for name, other in (("text", "meta"), ("meta", "text")):
            w, b = models[name]
            margin = self.x[name] @ w + b
            free = np.setdiff1d(np.arange(len(margin)), self.given[other])
            order = free[np.argsort(margin[free], kind="stable")]
            best, worst = [i for i in order[::-1][:good] if margin[i] > 1], [i for i in order[:bad] if margin[i] < -1]
            self.given[other] = np.concatenate((self.given[other], np.array(best + worst, int)))
            out[other] = self.x[other][best + worst], [1.0] * len(best) + [0.0] * len(worst)
        return out


class TablePool:
    """Unlabelled documents as a table (h, doc_id, lang, source, text)."""

    def __init__(self, rows: DataFrame, labelled: DataFrame):
        self.rows, self.labelled, self.given = rows, labelled, {v: set() for v in VIEWS}

    def pick(self, models: dict, good: int, bad: int) -> dict[str, tuple[np.ndarray, list[float]]]:
        spark = self.rows.sparkSession
        shared = spark.sparkContext.broadcast(models)  # fixed size

        def margins(batches):
            import pyarrow as pa

            for batch in batches:
                text, meta = _margins(batch, shared.value["text"], shared.value["meta"], 2)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text), pa.array(meta)], ["h", "doc_id", "text", "meta"])

        arrow_bounds(spark)
        found = self.rows.mapInArrow(margins, f"h bigint, doc_id {dict(self.rows.dtypes)['doc_id']}, text double, meta double")
        found = written(found.join(self.labelled, "doc_id", "left_anti").groupBy("h").agg(F.max("text").alias("text"), F.max("meta").alias("meta")), "margins")
        sure: dict[str, list[tuple[int, float]]] = {}
        for name, other in (("text", "meta"), ("meta", "text")):
            end = lambda order, n, name=name, other=other: [(r["h"], r[name]) for r in found.orderBy(order, "h").limit(n + len(self.given[other])).collect() if r["h"] not in self.given[other]][:n]  # noqa: E731  some hundred rows
            best, worst = end(F.col(name).desc(), good), end(F.col(name).asc(), bad)
            sure[other] = [(h, 1.0) for h, m in best if m > 1] + [(h, 0.0) for h, m in worst if m < -1]
            self.given[other] |= {h for h, _ in sure[other]}
        want = sorted({h for x in sure.values() for h, _ in x})
        if not want:
            return {v: (np.zeros((0, n), np.float32), []) for v, n in (("text", ngrams.DIM + REPEATS), ("meta", META))}
        few = spark.createDataFrame([(h,) for h in want], "h bigint")
        got = {h: (t, m) for h, _, t, m in _vectors(self.rows.join(F.broadcast(few), "h").withColumn("y", F.lit(None).cast("int")))}  # two views of good + bad rows
        return {v: (np.stack([got[h][k] for h, _ in sure[v]]) if sure[v] else np.zeros((0, n), np.float32), [y for _, y in sure[v]]) for k, (v, n) in enumerate((("text", ngrams.DIM + REPEATS), ("meta", META)))}


def fit(xt: np.ndarray, xm: np.ndarray, y: np.ndarray, pt: np.ndarray, pm: np.ndarray, rounds: int = ROUNDS, given: int = GIVEN) -> Model:
    """Co-train on labelled documents (text view, metadata view, label 0 or 1) and an unlabelled pool, all in arrays."""
    return co_train(xt, xm, y, ArrayPool(pt, pm), rounds, given)


def co_train(xt: np.ndarray, xm: np.ndarray, y: np.ndarray, pool, rounds: int = ROUNDS, given: int = GIVEN) -> Model:
    """The same, the pool being asked for what the views are sure of."""
    if len(set(y.tolist())) < 2:
        zero = np.zeros(ngrams.DIM + REPEATS, np.float32)
        return Model((zero, 0.0), (np.zeros(META, np.float32), 0.0), np.zeros(3), float(y.mean()) if len(y) else 0.5)
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held[:] = False
    seen = ~held if held.any() else ~held & True
    good = max(1, round(given * y[seen].mean()))
    rows, marks = {"text": xt[seen], "meta": xm[seen]}, {v: y[seen] for v in VIEWS}
    models: dict[str, tuple[np.ndarray, float]] = {}
    for turn in range(rounds + 1):
        for name, rate in VIEWS.items():
            w, b = ngrams.logistic(rows[name], marks[name][:, None], rounds=200, l2=1e-4, rate=rate)
            models[name] = (w[:, 0], float(b[0]))
        if turn == rounds:
            break
        new = pool.pick(models, good, max(1, given - good))
        if not any(len(labels) for _, labels in new.values()):
            break
        for name, (x, labels) in new.items():
            rows[name], marks[name] = np.concatenate((rows[name], x)), np.concatenate((marks[name], np.array(labels, np.float32)))
    test = held if held.any() else seen
    calibrated = {}
    for name, x in (("text", xt), ("meta", xm)):
        w, b = models[name]
        slope, offset = _platt(x[test] @ w + b, y[test])
        calibrated[name] = (w * slope, b * slope + offset)
    both = np.stack([xt[test] @ calibrated["text"][0] + calibrated["text"][1], xm[test] @ calibrated["meta"][0] + calibrated["meta"][1]], 1).astype(np.float32)
    scale = np.abs(both).mean(0) + 1e-9
    w, b = ngrams.logistic(both / scale, y[test][:, None], rounds=400, l2=1e-2, rate=1.0)
    return Model(calibrated["text"], calibrated["meta"], np.array([*(np.maximum(w[:, 0], 0) / scale), b[0]]))


def _column(df: DataFrame, name: str):
    return F.col(name).cast("string").alias(name) if name in df.columns else F.lit(None).cast("string").alias(name)


def _margins(batch, text: tuple[np.ndarray, float], meta: tuple[np.ndarray, float], at: int) -> tuple[np.ndarray, np.ndarray]:
    """Both views' margins of an Arrow batch with lang, source and text from column ``at`` on."""
    data, offsets = utf8_buffers(batch.column(at + 2))
    one = np.zeros(batch.num_rows)
    for k, c in enumerate(ngrams.counts(data, offsets, ngrams.ALL)):
        some = c.nonzero()[0]
        one[k] = np.sqrt(c[some]) @ text[0][some] / max(1e-9, np.sqrt(c.sum())) + 0.5 * text[0][ngrams.DIM + _repeats(c)] + text[1]
    two = meta_features(batch.column(at).to_pylist(), batch.column(at + 1).to_pylist(), data, offsets) @ meta[0] + meta[1]
    return one, two.astype(np.float64)


def _vectors(rows: DataFrame) -> list[tuple]:
    """(h, y, text features, metadata features) of a bounded table (h, y, lang, source, text), in order of h and y."""

    def vectors(batches):
        import pyarrow as pa

        for batch in batches:
            data, at = utf8_buffers(batch.column(4))
            text = text_features(data, at).astype(np.float16)
            meta = meta_features(batch.column(2).to_pylist(), batch.column(3).to_pylist(), data, at)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in text], pa.binary()), pa.array([r.tobytes() for r in meta], pa.binary())], ["h", "y", "t", "m"])

    arrow_bounds(rows.sparkSession)
    # rows that are equal collapse where they are read
    once = rows.groupBy("h", "y").agg(F.min(F.struct("lang", "source", "text")).alias("x")).select("h", "y", "x.lang", "x.source", "x.text")
    got = sorted(once.mapInArrow(vectors, "h bigint, y int, t binary, m binary").collect(), key=lambda r: (r["h"], r["y"] or 0, r["t"]))
    return [(r["h"], r["y"], np.frombuffer(r["t"], np.float16).astype(np.float32), np.frombuffer(r["m"], np.float32)) for r in got]


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", most_labels: int = MOST_LABELS, rounds: int = ROUNDS, given: int = GIVEN) -> Model:
    """Fit on a bounded sample of labelled documents and all unlabelled ones; features are made on the executors."""
    named = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(target).cast("int").alias("y")).distinct()
    marked = named.orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit("labels")), "y").limit(most_labels)
    rows = docs.select("doc_id", _column(docs, "lang"), _column(docs, "source"), text_or_empty().alias("text")).withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    sample = rows.join(F.broadcast(marked), "doc_id")  # most_labels rows of two numbers
    first = F.row_number().over(Window.partitionBy("doc_id", "y").orderBy("h"))  # of an id's different texts one
    sample = sample.dropDuplicates(["h", "y"]).withColumn("first", first).where("first = 1")
    got = _vectors(sample.select("h", "y", "lang", "source", "text"))
    size = ngrams.DIM + REPEATS, META
    xt, xm = (np.stack([r[k] for r in got]) if got else np.zeros((0, n), np.float32) for k, n in zip((2, 3), size, strict=True))
    pool = TablePool(rows.where("doc_id is not null").select("h", "doc_id", "lang", "source", "text"), written(labels.select("doc_id").where("doc_id is not null").distinct(), "labelled"))
    return co_train(xt, xm, np.array([r[1] for r in got], np.float32), pool, rounds, given)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, score_text, score_meta, good) of every document."""
    arrow_bounds(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    kind = dict(docs.dtypes)["doc_id"]

    def mark(batches):
        import pyarrow as pa

        m = shared.value
        for batch in batches:
            text, meta = _margins(batch, m.text, m.meta, 1)
            both, one, two = m.score(text, meta)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x.astype(np.float64)) for x in (both, one, two)], pa.array(both >= THRESHOLD)], ["doc_id", "score", "score_text", "score_meta", "good"])

    rows = docs.select("doc_id", _column(docs, "lang"), _column(docs, "source"), text_or_empty().alias("text"))
    return rows.mapInArrow(mark, f"doc_id {kind}, score double, score_text double, score_meta double, good boolean")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, by what ``labels`` says of quality."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
