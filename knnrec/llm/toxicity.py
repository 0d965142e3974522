"""Toxicity by a classifier chain of linear models.

The categories are predicted one after the other. Each link is a logistic
model over hashed words (present or not, so a long text does not thin out a
few telling words), structure statistics, and the probabilities of the
earlier links. A later link is trained on out-of-fold predictions of the
earlier ones, since those are what it will meet on unseen text; at scoring
time every link is the one fitted on the whole sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnrec.llm.common import NOT_ALNUM, Words, fold, passes, prepare
from knnrec.llm.features import STATISTICS, dense, inputs, labelled_sample

#: Chain order: (category, label column, value that means yes).
CHAIN = (("poor", "quality", 0), ("toxic", "toxic", 1))
WIDTH = 1 << 16


@dataclass
class Link:
    category: str
    words: np.ndarray  # weight of each hashed word
    rest: np.ndarray  # statistics, then earlier links, then the bias

    def margin(self, word_sum: np.ndarray, rest: np.ndarray) -> np.ndarray:
        return word_sum + rest @ self.rest[:-1] + self.rest[-1]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def text_blocks(texts: pa.Array, n_chars: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, text index and bucket of each different word,
    statistics scaled to about 0..3)."""
    for lo, hi, buf, offs in passes(texts):
        words = Words(buf, offs, ends=NOT_ALNUM)
        cell = np.unique(words.of * WIDTH + (words.hash % np.uint64(WIDTH)).astype(np.int64))
        yield lo, hi, cell // WIDTH, cell % WIDTH, dense(buf, offs, n_chars[lo:hi], 1)[:, 1:]


def collect_sample(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a bounded sample: row and bucket of its words, statistics, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_chars = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False)
            for lo, hi, of, bucket, stats in text_blocks(batch.column(1), n_chars):
                cuts = np.searchsorted(of, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[lo:hi],
                        pa.array([bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                        pa.array([s.tobytes() for s in stats], pa.binary()),
                    ],
                    names=["doc_id", "words", "stats"],
                )

    table = sample.select("doc_id", "text", "n_chars").mapInArrow(run, "doc_id long, words binary, stats binary")
    table = table.toArrow().sort_by("doc_id")
    words = [np.frombuffer(w, np.int32) for w in table["words"].to_pylist()]
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    stats = np.frombuffer(b"".join(table["stats"].to_pylist()), np.float32).reshape(len(words), STATISTICS)
    return row, np.concatenate([*words, np.zeros(0, np.int32)]), stats, table["doc_id"].to_numpy()


def fit_link(
    category: str, row: np.ndarray, bucket: np.ndarray, rest: np.ndarray, y: np.ndarray, weight: np.ndarray,
    penalties: tuple = ((5e-4, 150), (2e-5, 100)),
) -> Link:
    """Accelerated proximal gradient on the weighted logistic loss, with an L1
    penalty on the words, in (penalty, rounds) passes: the first leaves the
    telling words only, the second fits those almost without shrinking them."""
    n = len(y)
    if not n or len(np.unique(y)) < 2:
        out = np.zeros(rest.shape[1] + 1)
        out[-1] = 6.0 if n and y[0] else -6.0
        return Link(category, np.zeros(WIDTH), out)
    weight = weight / weight.sum()
    x = np.column_stack((rest, np.ones(n)))
    seen = np.bincount(bucket, minlength=WIDTH)
    use = (seen >= 5)[bucket]  # too rare to be learned from
    row, bucket = row[use], bucket[use]
    for l1, rounds in penalties:
        w, v = descend(row, bucket, x, y, weight, l1, rounds)
        use = (w != 0)[bucket]
        row, bucket = row[use], bucket[use]
    return Link(category, w, v)


def descend(row, bucket, x, y, weight, l1: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(y)
    # steps scaled by the curvature of each coordinate
    spread = 1.0 / (0.25 * np.bincount(bucket, weights=weight[row], minlength=WIDTH) * 12 + 1e-3)
    spread_x = 1.0 / (0.25 * (weight[:, None] * x * x).sum(axis=0) * 12 + 1e-3)
    w, v = np.zeros(WIDTH), np.zeros(x.shape[1])
    w_at, v_at, t = w, v, 1.0
    for _ in range(rounds):
        p = sigmoid(np.bincount(row, weights=w_at[bucket], minlength=n) + x @ v_at)
        g = weight * (p - y)
        w_new = w_at - spread * np.bincount(bucket, weights=g[row], minlength=WIDTH)
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - spread * l1, 0)
        v_new = v_at - spread_x * (x.T @ g + 1e-4 * v_at)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        w_at, v_at = w_new + (t - 1) / t_new * (w_new - w), v_new + (t - 1) / t_new * (v_new - v)
        w, v, t = w_new, v_new, t_new
    return w, v


def fit_chain(row, bucket, stats, targets: dict[str, np.ndarray], weight: np.ndarray, folds: int = 3) -> list[Link]:
    """Links in order; row r of the sample is in fold r mod ``folds``."""
    n = len(stats)
    part = np.arange(n) % folds
    rest, links = stats.astype(np.float64), []
    for at, (category, y) in enumerate(targets.items()):
        links.append(fit_link(category, row, bucket, rest, y, weight))
        if at + 1 < len(targets):
            unseen = np.zeros(n)
            for k in range(folds):
                fit_rows, out = part != k, part == k
                number = np.cumsum(fit_rows) - 1
                use = fit_rows[row]
                link = fit_link(category, number[row[use]], bucket[use], rest[fit_rows], y[fit_rows], weight[fit_rows])
                total = np.bincount(row, weights=link.words[bucket], minlength=n)
                unseen[out] = sigmoid(link.margin(total, rest))[out]
            rest = np.column_stack((rest, unseen))
    return links


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 4000) -> list[Link]:
    """Fit the chain on at most ``per_class`` documents of every combination
    of category labels with crc32(doc_id) mod 5 not 0, weighted to the share of
    the combinations. Rows with a null label are not learned from."""
    prepare(docs.sparkSession)
    yes = [F.when(F.col(column) == value, 1 << k).otherwise(0) for k, (_, column, value) in enumerate(CHAIN)]
    known = labels.where(fold(F.col("doc_id"), 5) != 0)
    for _, column, _ in CHAIN:
        known = known.where(F.col(column).isNotNull())
    known = known.select("doc_id", sum(yes[1:], yes[0]).alias("combination"))
    sample, totals = labelled_sample(docs, known, "combination", per_class)
    sample = sample.select("doc_id", "text", "n_chars", "label")
    row, bucket, stats, ids = collect_sample(sample)
    label = {r["doc_id"]: r["label"] for r in sample.select("doc_id", "label").collect()}
    combination = np.array([label[i] for i in ids.tolist()], dtype=np.int64)
    weight = np.ones(len(ids))
    for value in np.unique(combination):
        weight[combination == value] = totals[int(value)] / (combination == value).sum()
    targets = {name: (combination >> k & 1).astype(np.float64) for k, (name, _, _) in enumerate(CHAIN)}
    return fit_chain(row, bucket, stats, targets, weight)


def score(docs: DataFrame, links: list[Link], threshold: float = 0.5) -> DataFrame:
    """doc_id, p_<category> for each link, toxic (the last link's probability
    is at least ``threshold``).

    Null and empty texts are scored from their statistics alone; repeated rows
    get equal scores; an empty table gives no rows; columns other than doc_id,
    text and n_chars are ignored.
    """
    prepare(docs.sparkSession)
    names = [f"p_{link.category}" for link in links]
    telling = np.any([link.words != 0 for link in links], axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_chars = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False)
            out = np.zeros((len(links), batch.num_rows))
            for lo, hi, of, bucket, stats in text_blocks(batch.column(1), n_chars):
                use = telling[bucket]
                of, bucket, rest = of[use], bucket[use], stats.astype(np.float64)
                for k, link in enumerate(links):
                    total = np.bincount(of, weights=link.words[bucket], minlength=hi - lo)
                    out[k, lo:hi] = sigmoid(link.margin(total, rest))
                    rest = np.column_stack((rest, out[k, lo:hi]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)], names=["doc_id", *names])

    scored = inputs(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{n} double" for n in names))
    return scored.withColumn("toxic", F.col(names[-1]) >= threshold)
