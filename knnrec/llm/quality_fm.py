"""Quality classifier: a factorisation machine over hashed words, structure
statistics and the recorded length.

The score of features x is sigmoid(b + w.x + 1/2 sum_f ((V_f.x)^2 - V_f^2.x^2)):
the pairwise interactions <V_i, V_j> x_i x_j through the sum-of-squares
identity, linear in the number of features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnrec.llm.common import fold, prepare, repeat_rows
from knnrec.llm.features import blocks, collect_features, feature_columns, inputs, labelled_sample


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    shift: np.ndarray
    scale: np.ndarray
    width: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.shift) * self.scale, -8, 8)
        pairs = (x @ self.factors) ** 2 - (x * x) @ (self.factors * self.factors)
        return self.bias + x @ self.weights + 0.5 * pairs.sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x).astype(np.float64), -60, 60)))


def fit(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, width: int, rank: int = 8, epochs: int = 12, seed: int = 7
) -> FactorisationMachine:
    """Adam on the weighted logistic loss. The statistics are standardised;
    one class alone gives a constant score of that class."""
    n, d = x.shape
    shift, scale = np.zeros(d, np.float32), np.ones(d, np.float32)
    if not n or len(np.unique(y)) < 2:
        bias = 4.0 if n and y[0] == 1 else -4.0 if n else 0.0
        return FactorisationMachine(bias, np.zeros(d, np.float32), np.zeros((d, rank), np.float32), shift, scale, width)
    shift[width:] = x[:, width:].mean(axis=0)
    scale[width:] = 0.5 / np.maximum(x[:, width:].std(axis=0), 1e-3)
    z = (x - shift) * scale
    np.clip(z, -8, 8, out=z)
    rng = np.random.default_rng(seed)
    params = [np.zeros(1, np.float32), np.zeros(d, np.float32), rng.normal(0, 0.02, (d, rank)).astype(np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 128):
            rows = order[at : at + 128]
            xb, yb, wb = z[rows], y[rows], weight[rows]
            b, w, v = params
            s = xb @ v
            pairs = s**2 - (xb * xb) @ (v * v)
            p = 1 / (1 + np.exp(-np.clip(b + xb @ w + 0.5 * pairs.sum(axis=1), -30, 30)))
            g = (wb * (p - yb) / wb.sum()).astype(np.float32)
            xg = xb * g[:, None]
            grads = [g.sum(keepdims=True), xg.T.sum(axis=1) + 1e-4 * w, xg.T @ s - v * (xg * xb).sum(axis=0)[:, None] + 1e-3 * v]
            step += 1
            for p_, (m1, m2), grad in zip(params, moments, grads, strict=True):
                m1 += 0.1 * (grad - m1)
                m2 += 0.001 * (grad * grad - m2)
                p_ -= 0.02 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return FactorisationMachine(float(params[0][0]), params[1], params[2], shift, scale, width)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 4000, width: int = 512) -> FactorisationMachine:
    """Fit on at most ``per_class`` labelled documents per value of
    labels.quality with crc32(doc_id) mod 5 not 0, weighted to the share of
    the values among all such labels. The sample's features (per_class x 2 x
    about 2 KB) are the only thing on the driver."""
    prepare(docs.sparkSession)
    train = labels.where(F.col("quality").isin(0, 1) & (fold(F.col("doc_id"), 5) != 0))
    sample, totals = labelled_sample(docs, train, "quality", per_class)
    x, y = collect_features(sample, width)
    weight = np.ones(len(y))
    for value in np.unique(y):
        weight[y == value] = totals[int(value)] / max((y == value).sum(), 1)
    return fit(x, y, weight, width)


def score(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 likelier), predicted (1 if score
    >= threshold). Null and empty texts are scored from their statistics
    alone; repeated rows get equal scores; an empty table gives no rows;
    columns other than doc_id, text and n_chars are ignored."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(batch_scores(batch.columns[1:], model))], names=["doc_id", "score"]
            )

    scored = inputs(docs).mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def batch_scores(columns: list[pa.Array], model: FactorisationMachine) -> np.ndarray:
    scores = np.empty(len(columns[0]))
    for lo, hi, x in blocks(columns[0], columns[1], model.width):
        scores[lo:hi] = model.score(x)
    return scores


def keep_good(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``."""
    prepare(docs.sparkSession)
    return repeat_rows(docs, feature_columns(docs), lambda c: batch_scores(c, model) >= threshold)
