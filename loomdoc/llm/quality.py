"""Quality scores: random Fourier features over document statistics, ridge regression, isotonic calibration.

The statistics of a text are a few dozen ratios. A fixed random projection with cosines approximates a Gaussian kernel
over them; its ridge weights follow from sums of products that each partition adds up by itself. Scores of a fold
that the weights have not seen are calibrated by the pool-adjacent-violators rule over fixed bins. Only those sums
(their size does not depend on the rows) reach the driver; all labelled rows count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdoc.llm.common import attach, cut, free_name, shuffle_partitions, slices

WIDTH, SEED, RIDGE, SCALE = 320, 5, 1e-3, 0.16
#: Bins of uncalibrated scores, from LOW to HIGH.
BINS, LOW, HIGH = 768, -1.0, 2.0
#: Sums that a task adds up, and at most that many that the driver does.
FAN_IN = 16

_NAMES = ("upper", "lower", "digit", "space", "newline", "stop", "comma", "bang", "quote", "symbol", "dash", "bracket", "pipe", "beyond")
_SETS = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": b" \t", "newline": b"\n\r", "stop": b".", "comma": b",;:", "bang": b"!?", "quote": b"\"'`", "symbol": b"#$%&*@^~+=\\/_", "dash": b"-", "bracket": b"()[]{}<>", "pipe": b"|", "beyond": range(128, 256)}
_CLASSES = np.zeros((256, len(_NAMES)))
for _k, _n in enumerate(_NAMES):
    _CLASSES[list(_SETS[_n]), _k] = 1


def statistics(text: str) -> np.ndarray:
    """The statistics of a whole text; all finite, for an empty text too."""
    data = text.encode()
    n = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    p = counts[counts > 0] / max(n, 1)
    words, lines = data.split(), data.split(b"\n")
    m = len(words)
    sizes = np.fromiter(map(len, words), np.int64, m) if m else np.zeros(1, np.int64)
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False)))
    caps = sum(map(bytes.isupper, words))
    alpha = sum(map(bytes.isalpha, words))
    ends = sum(w[-1] in b".!?" for w in words)
    return np.concatenate([
        np.sqrt(counts @ _CLASSES / max(n, 1)),
        [np.log1p(n), np.log1p(m), sizes.mean(), sizes.std(), np.log1p(sizes.max()), distinct / max(m, 1), pairs / max(m - 1, 1), caps / max(m, 1), alpha / max(m, 1), ends / max(m, 1), len(set(lines)) / len(lines), np.log1p(len(lines)), np.log1p(n / len(lines)), -(p * np.log2(p)).sum()],
    ])


def _matrix(texts: list) -> np.ndarray:
    return np.array([statistics(t or "") for t in texts]).reshape(len(texts), -1)


@dataclass
class Model:
    """A fitted scorer; all of it is a few hundred numbers, whatever the rows."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def lift(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        w, b = rng.normal(0, SCALE, (x.shape[1], WIDTH)), rng.uniform(0, 2 * np.pi, WIDTH)
        return np.hstack([np.ones((len(x), 1)), z, np.sqrt(2 / WIDTH) * np.cos(z @ w + b)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x) or not len(self.knots):
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def isotonic(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Means of ascending bins made non-decreasing by pooling neighbours; n > 0."""
    blocks: list[list[float]] = []
    for k, (a, t) in enumerate(zip(n, total, strict=True)):
        blocks.append([a, t, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            a2, t2, m2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a2, blocks[-1][1] + t2, blocks[-1][2] + m2]
    return np.repeat([t / a for a, t, _ in blocks], [m for _, _, m in blocks])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its statistics x; null texts are empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_matrix(b.column(1).to_pylist()).tolist(), pa.list_(pa.float64()))], schema=schema)

    return docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{text_col}` as string) as text").mapInArrow(run, "doc_id long, x array<double>")


def fold(col: str = "doc_id"):
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col(col).cast("string")) % 5


def _summed(rows: DataFrame, of) -> np.ndarray:
    """The sum over all rows of of(x, y), an array; partitions add up theirs, a few tasks add those, the driver the rest."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                x = np.array(b.column(0).flatten()).reshape(b.num_rows, -1)
                got = of(x, b.column(1).to_numpy().astype(float))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (np.frombuffer(v.as_py()) for b in batches for v in b.column(0))
        total = None
        for p in parts:
            total = p if total is None else total + p
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    sums = rows.select("x", "y").mapInArrow(part, "sums binary")
    parts = max(1, math.ceil(shuffle_partitions(rows.sparkSession) / FAN_IN))
    while True:  # a task adds about FAN_IN sums, whatever their number
        sums = sums.repartition(parts).mapInArrow(add, "sums binary")
        if parts <= FAN_IN:
            break
        parts = math.ceil(parts / FAN_IN)
    got = sums.collect()
    return sum(np.frombuffer(bytes(r.sums)) for r in got) if got else np.zeros(0)


def fit(feats: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows whose fold isn't 0: weights from folds 2 to 4, calibration from fold 1.

    labels: doc_id and quality; rows without an id or with another quality than 0 and 1 don't count, of several for
    one id the highest does. Without labelled rows every score is 0.5.
    """
    marked = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    held = feats.groupBy("doc_id").agg(F.count("*").alias("n"))
    known = attach(feats.select("doc_id", "x"), cut(marked.join(held, "doc_id")), "doc_id", "n").withColumn("fold", fold()).filter("fold <> 0").select("x", "y", "fold")
    known = cut(known.repartition(shuffle_partitions(feats.sparkSession)))
    d = len(statistics(""))
    empty = Model(np.zeros(d), np.ones(d), np.zeros(0), np.zeros(0), np.zeros(0))
    sums = _summed(known.filter("fold > 1"), lambda x, y: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]))
    if not len(sums):
        return empty
    mean = sums[1 : 1 + d] / sums[0]
    m = Model(mean, np.sqrt(np.maximum(sums[1 + d :] / sums[0] - mean**2, 1e-8)), np.zeros(0), np.zeros(0), np.zeros(0))

    def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = m.lift(x)
        return np.hstack([z.T @ z, (z.T @ y)[:, None]]).ravel()

    k = 1 + d + WIDTH
    both = _summed(known.filter("fold > 1"), products).reshape(k, k + 1)
    m.weights = np.linalg.solve(both[:, :k] + RIDGE * sums[0] * np.diag([0.0] + [1.0] * (k - 1)) + 1e-9 * np.eye(k), both[:, k])

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(((m.raw(x) - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)]).astype(float)

    hist = _summed(known.filter("fold = 1"), binned)
    if not len(hist):
        hist = _summed(known.filter("fold > 1"), binned)
    full = np.flatnonzero(hist[:BINS])
    m.knots = LOW + (full + 0.5) * (HIGH - LOW) / BINS
    m.values = isotonic(hist[full], hist[BINS + full])
    return m


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row; held_out is null for a null id.

    Null texts are scored as empty ones; rows of one id are scored each by their own text, and all count in the fit if
    the id is labelled; columns of any other name, labels' too, are left out. A very long text is a row like others.
    Without labelled rows every score is 0.5; an empty table gives no rows.
    """
    feats = cut(features(docs, id_col, text_col))
    m = fit(feats, labels)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(1).flatten()).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.score(x))], schema=schema)

    scored = feats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all columns, whose score reaches the threshold.

    Null and empty texts are scored like others; rows without an id count by their text. Texts are read once: rows are
    written with their statistics, from which the model is fitted and the choice made.
    """
    names, x = docs.columns, free_name(docs.columns, "statistics_")
    wide = T.StructType([*docs.schema.fields, T.StructField(x, T.ArrayType(T.DoubleType()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = _matrix(b.column(text_col).cast(pa.string()).to_pylist()).tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.list_(pa.float64()))], names=[*b.schema.names, x])

    rows = cut(docs.mapInArrow(measure, wide))
    m = fit(rows.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(x).alias("x")), labels)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column(b.schema.get_field_index(x))
            keep = m.score(np.array(at.flatten()).reshape(b.num_rows, -1)) >= threshold
            yield b.select(names).filter(pa.array(keep))

    return rows.mapInArrow(choose, docs.schema)
