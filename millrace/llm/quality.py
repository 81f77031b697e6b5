"""Quality classifier: random Fourier features, ridge and isotonic calibration (operator 10).

Each whole text becomes a few dozen statistics (byte classes, word lengths, repeated
words and lines, marks). Random Fourier features approximate a Gaussian kernel over
the standardised statistics; the normal equations are summed per partition and then in
levels of at most MEET sums a task, so the driver receives a few matrices whatever the input; ridge scores are
calibrated by isotonic regression on held-back folds of the training rows, counted in
fixed bins.

The statistics are computed once per text and kept in the shared checkpoint folder.
Standardising and the kernel width come from a bounded sample (SCALE_ROWS training
rows by hash order); everything else covers all training rows.

Defined results: null text is empty text and gets a score like any other; rows without
label only get scored; if a document has several labels each counts; without any
training row, or with one class only, the score is the base rate (0.5 if none); an
empty table gives no rows; equal rows get equal scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import doc_fold, small_batches, text_bytes

FEATURES = 192
RIDGE = 1e-3
SEED = 10
FOLDS = 4
HELD_OUT = 2
THRESHOLD = 0.7
#: Bound of the sample that sets the scale of the statistics and the kernel width.
SCALE_ROWS = 20_000
#: Bins of raw ridge scores for calibration.
BINS = 400
#: Sums that meet in one task, level by level, and that the driver adds at last.
MEET = 16
#: Words of a stretch whose distinct words are counted.
STRETCH = 200

_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_HIGH = np.arange(256) >= 128
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_STOP = np.isin(np.arange(256), list(b".,"))
_ODD = np.isin(np.arange(256), list(b"#$%&*@^~_=+<>\\/|[]{}"))
_LOUD = np.isin(np.arange(256), list(b"!?"))
_MARK = ~(_LOWER | _UPPER | _DIGIT | _HIGH | _SPACE)
N_STATS = 24


def statistics(text: bytes | None) -> list[float]:
    """The statistics of one whole text; finite for any text."""
    text = text or b""
    n = len(text)
    if not n:
        return [0.0] * N_STATS
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = counts / n
    words = text.split()
    lines = text.split(b"\n")
    w = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    kinds = len(set(words))
    p = share[share > 0]
    entropy = float(-(p * np.log2(p)).sum())
    body = max(float(share[~_SPACE].sum()), 1e-9)
    cap = [float(share[m].sum()) / body for m in (_LOWER, _UPPER, _DIGIT, _HIGH, _STOP, _ODD, _LOUD, _MARK)]
    local = sum(len(set(words[a : a + STRETCH])) for a in range(0, len(words), STRETCH)) / w
    near = len(set(zip(words, words[1:]))) / w
    distinct_lines = len(set(lines)) / len(lines)
    return [
        *cap,
        np.log1p(n), np.log1p(len(words)), float(lengths.mean()), float(lengths.std()), float(np.log1p(lengths.max())),
        kinds / w, kinds / np.sqrt(w), local, near,
        distinct_lines, np.log1p(len(lines)), np.log1p(n / len(lines)),
        entropy, float(counts[124]) / w, float(counts[10]) / w, float(share[_SPACE].sum()),
    ]


def stats_of(docs: DataFrame) -> DataFrame:
    """doc_id, stats (array of float) of each whole text."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            rows = np.array([statistics(t) for t in text_bytes(batch.column(1))], np.float32).reshape(-1)
            at = pa.array(np.arange(0, len(rows) + 1, N_STATS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(at, pa.array(rows))], ["doc_id", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, stats array<float>")


class Model:
    """Scale, random features, weights and calibration."""

    def __init__(self, sample: np.ndarray, features: int = FEATURES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean = sample.mean(axis=0) if len(sample) else np.zeros(N_STATS)
        self.scale = np.maximum(sample.std(axis=0), 1e-3) if len(sample) else np.ones(N_STATS)
        z = self._scaled(sample[:2000])
        gaps = ((z[: len(z) // 2] - z[len(z) // 2 : len(z) // 2 * 2]) ** 2).sum(axis=1)
        width = float(np.sqrt(np.median(gaps))) if len(gaps) else 1.0
        self.w = rng.normal(size=(N_STATS, features)) / max(width, 1e-3)
        self.b = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros((FOLDS + 1, features + 1))
        self.cuts, self.values = np.array([0.0]), np.array([0.5])
        self.base = 0.5

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant."""
        z = np.cos(self._scaled(np.asarray(x, np.float64)) @ self.w + self.b) * np.sqrt(2 / len(self.b))
        return np.hstack([z, np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of label 1."""
        raw = self.features(x) @ self.weights[FOLDS]
        return np.clip(np.interp(raw, self.cuts, self.values), 0.0, 1.0)


def _sums(rows: DataFrame, make, size: int) -> np.ndarray:
    """Sum of the per-partition vectors that ``make(stats, y, fold)`` adds up; at most MEET of them meet in a task, level by level."""

    def part(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                stats = np.asarray(batch.column(0).flatten(), np.float64).reshape(-1, N_STATS)
                total += make(stats, np.asarray(batch.column(1), np.float64), np.asarray(batch.column(2), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], ["g", "v"])

    def meet(table: pa.Table) -> pa.Table:
        v = np.asarray(table.column("v").combine_chunks().flatten()).reshape(table.num_rows, size).sum(axis=0)
        return pa.table({"g": pa.array([table.column("g")[0].as_py()], pa.int32()), "v": pa.array([v.tolist()], pa.list_(pa.float64()))})

    met, many = rows.select("stats", "y", "fold").mapInArrow(part, "g int, v array<double>"), rows.rdd.getNumPartitions()
    while many > MEET:
        met, many = met.withColumn("g", F.floor(F.col("g") / MEET).cast("int")).groupBy("g").applyInArrow(meet, "g int, v array<double>"), -(-many // MEET)
    met = met.select("v").collect()  # at most MEET rows
    return np.sum([np.asarray(r["v"]) for r in met], axis=0) if met else np.zeros(size)


def isotonic(x: np.ndarray, ones: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins: points of a rising function."""
    blocks: list[list[float]] = []
    for at, k, n in zip(x, ones, count):
        if n:
            blocks.append([k, n, at * n])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                k2, n2, s2 = blocks.pop()
                blocks[-1] = [blocks[-1][0] + k2, blocks[-1][1] + n2, blocks[-1][2] + s2]
    return np.array([s / n for _, n, s in blocks]), np.array([(k + 0.5) / (n + 1) for k, n, _ in blocks])


def fit(stats: DataFrame, labels: DataFrame, features: int = FEATURES, ridge: float = RIDGE) -> Model:
    """Fit on stats joined with labels (doc_id, quality), without the held-out fold."""
    labels = labels.select("doc_id", F.col("quality").cast("double").alias("y")).filter("y is not null and doc_id is not null").filter(doc_fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    rows = stats.join(labels, "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)))
    rows = cut(rows.select("doc_id", "stats", "y", "fold"))
    sample = rows.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(SCALE_ROWS).select("stats").toArrow().column("stats").combine_chunks()
    model = Model(np.asarray(sample.flatten(), np.float64).reshape(-1, N_STATS), features)
    d = features + 1

    def normal(x, y, fold):
        out = np.zeros((FOLDS, d * d + d + 2))
        z = model.features(x)
        for f in range(FOLDS):
            m = fold == f
            out[f, : d * d] = (z[m].T @ z[m]).ravel()
            out[f, d * d : d * d + d] = z[m].T @ y[m]
            out[f, -2:] = m.sum(), y[m].sum()
        return out.ravel()

    sums = _sums(rows, normal, FOLDS * (d * d + d + 2)).reshape(FOLDS, -1)
    n, ones = sums[:, -2].sum(), sums[:, -1].sum()
    if not n or not 0 < ones < n:
        model.base = ones / n if n else 0.5
        model.values = np.array([model.base])
        return model
    for f in range(FOLDS + 1):  # each fold's weights come from the other folds; the last from all
        own = sums.sum(axis=0) - (sums[f] if f < FOLDS else 0)
        gram = own[: d * d].reshape(d, d) + ridge * max(own[-2], 1) * np.diag([*[1.0] * features, 0.0]) / features
        model.weights[f] = np.linalg.lstsq(gram + 1e-9 * np.eye(d), own[d * d : d * d + d], rcond=None)[0]
    low, high = -0.5, 1.5

    def counted(x, y, fold):
        raw = (model.features(x) * model.weights[fold]).sum(axis=1)
        at = np.clip(((raw - low) / (high - low) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, y, BINS), np.bincount(at, minlength=BINS), np.bincount(at, raw, BINS)])

    k, c, s = _sums(rows, counted, 3 * BINS).reshape(3, BINS)
    model.cuts, model.values = isotonic(s / np.maximum(c, 1), k, c)
    return model


def scores(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row of stats."""

    def run(batches):
        for batch in batches:
            x = np.asarray(batch.column(1).flatten(), np.float64).reshape(-1, N_STATS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x) if len(x) else np.zeros(0))], ["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "stats").mapInArrow(run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    stats = cut(stats_of(docs))
    scored = scores(stats, fit(stats, labels))
    return scored.select("doc_id", (doc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of docs with a score of ``threshold`` or more, scored in place by the fitted model."""
    model = fit(cut(stats_of(docs)), labels)

    @F.pandas_udf("double")
    def score(text):
        import pandas as pd

        x = np.array([statistics(t.encode("utf-8", "replace") if isinstance(t, str) else None) for t in text], np.float64).reshape(-1, N_STATS)
        return pd.Series(model.score(x.astype(np.float32)))

    return docs.filter(score(docs["text"]) >= threshold)
