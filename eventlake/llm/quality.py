"""Quality classifier: random Fourier features, ridge regression, isotonic calibration."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import reliable

THRESHOLD = 0.7
N_FEATURES = 256
GAMMA = 0.02
RIDGE = 1.0
SEED = 20
# Raw scores are calibrated on a grid of this many cells, so the driver gets one row for each.
GRID = 2000
# Sums of the normal equations reach the driver from so many tasks at most.
FAN_IN = 16

# Classes of bytes: other, lower, upper, digit, blank, line end, sentence mark, shout, symbol, high.
_CLASSES = 10
_KIND = np.zeros(256, dtype=np.int64)
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
_KIND[[9, 32]] = 4
_KIND[[10, 13]] = 5
_KIND[[ord(c) for c in ".,;:"]] = 6
_KIND[[ord(c) for c in "!?"]] = 7
_KIND[[ord(c) for c in "#$%&*+<=>@[]^_`{|}~/\\"]] = 8
_KIND[128:] = 9


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text; a NULL text is an empty one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(len(raw), 1)
    kinds = np.bincount(_KIND[np.frombuffer(raw, dtype=np.uint8)], minlength=_CLASSES) / n
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n_words, n_lines = max(len(words), 1), max(len(lines), 1)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    packed = len(zlib.compress(raw, 1)) / n if raw else 0.0
    return [
        *kinds.tolist(),
        np.log1p(len(raw)),
        np.log1p(len(words)),
        len(set(words)) / n_words / (1 + 0.1 * np.log1p(len(words))),
        float(lengths.mean()) if len(words) else 0.0,
        np.log1p(float(lengths.max())) if len(words) else 0.0,
        float((lengths <= 3).mean()) if len(words) else 0.0,
        len(set(lines)) / n_lines,
        np.log1p(len(words) / n_lines),
        min(packed, 2.0),
        float(not words),
    ]


DIM = len(statistics(None))


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, x): the statistics of each row. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch({"key": batch.column(0), "x": pa.array(x, pa.list_(pa.float64()))})

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key long, x array<double>")


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 4: 2 is held out, 3 calibrates, 0 and 1 fit."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 4


@dataclass(frozen=True)
class Model:
    """A fitted classifier: a few hundred numbers, whatever the corpus."""

    center: np.ndarray
    scale: np.ndarray
    coef: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated chance of label 1 for each row of statistics."""
        raw = fourier(x, self.center, self.scale) @ self.coef
        return np.interp(raw, self.knots, self.values)


def fourier(x: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of the kernel exp(-GAMMA |x - y|^2) on scaled statistics, and a 1."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(scale=np.sqrt(2 * GAMMA), size=(x.shape[1], N_FEATURES))
    b = rng.uniform(0, 2 * np.pi, N_FEATURES)
    z = np.clip((x - center) / scale, -6, 6)
    return np.hstack([np.sqrt(2 / N_FEATURES) * np.cos(z @ w + b), np.ones((len(x), 1))])


def _sums(rows: DataFrame, add) -> np.ndarray | None:
    """The sum over all rows of the arrays that ``add`` makes of each batch (x, y).

    Each task adds up its rows, ``FAN_IN`` tasks add up those sums one by one, the driver adds up
    theirs: memory is a few arrays anywhere.
    """

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                part = add(np.stack(batch["x"]), batch["y"].to_numpy(float))
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"sums": [total.tobytes()]})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for blob in batch["sums"]:
                part = np.frombuffer(blob)
                total = part.copy() if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"sums": [total.tobytes()]})

    parts = rows.mapInPandas(local, "sums binary").repartition(FAN_IN).mapInPandas(merge, "sums binary")
    blobs = [np.frombuffer(r["sums"]) for r in parts.collect()]
    return sum(blobs) if blobs else None


def fit(rows: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id") -> Model | None:
    """Learn from ``rows`` (key, x) and ``labels``; None if no labelled row may be learned from.

    Rows of fold 2 are never learned from. All others count, each as often as it is labelled;
    NULL labels do not. Folds 0 and 1 fit the ridge, fold 3 the calibration, or those that have
    rows do both.
    """
    y = labels.where(F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(label).cast("double").alias("y"))
    known = rows.join(y, "key").withColumn("fold", fold(F.col("key"))).where("fold <> 2")
    known = reliable(known.select("fold", "x", "y"))

    moments = _sums(known, lambda x, y: np.stack([np.full(DIM, len(x)), x.sum(0), (x * x).sum(0)]).ravel())
    if moments is None:
        return None
    n, first, second = moments.reshape(3, DIM)
    center = first / n
    scale = np.sqrt(np.maximum(second / n - center**2, 0))
    scale = np.where(scale > 1e-9, scale, 1.0)

    size = N_FEATURES + 1

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = fourier(x, center, scale)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    fitted = _sums(known.where("fold < 2"), equations)
    if fitted is None:
        fitted = _sums(known, equations)
    gram, moment = fitted[:-size].reshape(size, size), fitted[-size:]
    penalty = np.diag(np.r_[np.full(N_FEATURES, RIDGE), 1e-9])
    coef = np.linalg.solve(gram + penalty, moment)

    def cells(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        raw = np.clip(fourier(x, center, scale) @ coef, -0.5, 1.5)
        cell = np.minimum(((raw + 0.5) / 2 * GRID).astype(np.int64), GRID - 1)
        count = [np.bincount(cell, weights=v, minlength=GRID) for v in (np.ones(len(y)), y, raw)]
        return np.stack(count).ravel()

    grid = _sums(known.where("fold = 3"), cells)
    if grid is None:
        grid = _sums(known, cells)
    knots, values = isotonic(*grid.reshape(3, GRID))
    return Model(center, scale, coef, knots, values)


def isotonic(count: np.ndarray, ones: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over cells in order; one knot for each pool, at its mean score."""
    pools: list[list[float]] = []
    for n, y, r in zip(count, ones, raw, strict=True):
        if not n:
            continue
        pools.append([n, y, r])
        while len(pools) > 1 and pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    knots = np.array([r / n for n, _, r in pools])
    return knots, np.clip([y / n for n, y, _ in pools], 0.0, 1.0)


def scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row. Without any label to learn from, every score is 0.5.

    NULL and empty texts are scored as empty ones; repeated rows get the same score each; only
    ``text`` is an input of a score. An empty table gives no row.
    """
    rows = reliable(features(docs, key, text))
    model = fit(rows, labels)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = np.full(len(batch), 0.5) if model is None else model.score(np.stack(batch["x"]))
                yield pd.DataFrame({"key": batch["key"], "score": found})

    return rows.mapInPandas(run, "key long, score double")


def keep_good(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more; all of them if nothing was labelled.

    Texts are read twice, once to learn and once to filter, rather than moved through a shuffle.
    Columns stay as they are, whatever they are called.
    """
    model = fit(features(docs, key, text), labels)
    if model is None:
        return docs
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array([statistics(t.as_py()) for t in batch.column(at)])
                yield batch.filter(pa.array(model.score(x) >= threshold))

    # By number while in Python, as columns may have dots or capitals in their names.
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)
