"""Mixing documents to target domain weights with soft membership.

A classifier fitted on the labelled table gives every document posteriors over
the domains. Nonnegative rates r_i (how often a document is used) are fitted so
that the expected tokens of domain d, sum_i r_i n_i p_id, match its target: least
squares by projected gradient from r = 1. Domains are weighted by their present
tokens and documents scaled by theirs, so a full step of 1 never overshoots.

A document's rate follows from its posteriors and the steps so far. So one
distributed sum over cells of like posteriors is all that the steps read; they
go on until the targets are met or no longer come nearer, and a second sum over
all documents says how far they were missed, which the result reports.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knnrec.llm.common import Words, passes, prepare, repeat_rows, stage
from knnrec.llm.features import blocks, collect_features, feature_columns, inputs, labelled_sample

#: Domains of labelled documents and their target share of the tokens.
DOMAINS = ("clean", "toxic", "poor")
TARGETS = {"clean": 0.97, "toxic": 0.03, "poor": 0.0}
WIDTH = 256
#: Cells of the posteriors: steps per domain.
GRID = 256
#: The steps end when so many rounds gain less than this share of the miss.
PATIENCE, PROGRESS = 50, 0.05
#: Passes over all documents that compare them with their cells.
CORRECTIONS = 3


@dataclass
class DomainModel:
    weights: np.ndarray
    shift: np.ndarray
    scale: np.ndarray

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.shift) * self.scale, -8, 8)
        m = np.column_stack((z, np.ones(len(z)))) @ self.weights
        e = np.exp(m - m.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, classes: int, rounds: int = 400) -> DomainModel:
    """Weighted multinomial logistic regression by accelerated gradient. A
    class without samples keeps a posterior near 0."""
    d = x.shape[1]
    shift, scale = np.zeros(d, np.float32), np.ones(d, np.float32)
    w = np.zeros((d + 1, classes))
    missing = np.bincount(y, minlength=classes) == 0
    if len(x):
        shift = x.mean(axis=0)
        scale = 1 / np.maximum(x.std(axis=0), 1e-3)
        z = np.column_stack((np.clip((x - shift) * scale, -8, 8), np.ones(len(x))))
        weight = weight / weight.sum()
        target = np.eye(classes)[y]
        step = 2.0 / np.linalg.eigvalsh((z * weight[:, None]).T @ z)[-1]
        at, t = w, 1.0
        for _ in range(rounds):
            m = z @ at
            p = np.exp(m - m.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            new = at - step * (z.T @ (weight[:, None] * (p - target)) + 1e-4 * at)
            t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
            at, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    w = w.copy()
    w[:, missing] = 0
    w[-1, missing] = -40.0 if len(x) else 0.0
    return DomainModel(w, shift, scale)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 3000) -> DomainModel:
    """Fit on at most ``per_class`` labelled documents per domain: poor
    (quality 0), else toxic (toxic 1), else clean; weighted to their shares.
    Null labels are not learned from."""
    prepare(docs.sparkSession)
    known = labels.where("quality IS NOT NULL AND toxic IS NOT NULL")
    domain = F.when(F.col("quality") == 0, 2).when(F.col("toxic") == 1, 1).otherwise(0)
    sample, totals = labelled_sample(docs, known.select("doc_id", domain.alias("domain")), "domain", per_class)
    x, y = collect_features(sample, WIDTH)
    weight = np.ones(len(y))
    for value in np.unique(y):
        weight[y == value] = totals[int(value)] / (y == value).sum()
    return fit(x, y, weight, len(DOMAINS))


def memberships(docs: DataFrame, model: DomainModel) -> DataFrame:
    """doc_id, n_tokens (words) and p_<domain> of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, n = np.empty((batch.num_rows, len(DOMAINS))), np.empty(batch.num_rows, np.int64)
            for lo, hi, x in blocks(batch.column(1), batch.column(2), WIDTH):
                p[lo:hi] = model.posteriors(x)
            for lo, hi, buf, offs in passes(batch.column(1)):
                n[lo:hi] = Words(buf, offs).counts
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), *(pa.array(p[:, k].copy()) for k in range(len(DOMAINS)))],
                names=["doc_id", "n_tokens", *(f"p_{d}" for d in DOMAINS)],
            )

    return inputs(docs).mapInArrow(
        run, "doc_id long, n_tokens long, " + ", ".join(f"p_{d} double" for d in DOMAINS)
    )


@dataclass
class Rates:
    """A rate as a function of the posteriors: the projected steps taken.
    ``miss`` is the distance left to the targets (shares of tokens, summed)."""

    momentum: list[float]
    gradients: list[np.ndarray]
    miss: float = 0.0

    def of(self, p: np.ndarray) -> np.ndarray:
        r = before = np.ones(len(p))
        for beta, g in zip(self.momentum, self.gradients, strict=True):
            before, r = r, np.maximum(0.0, r + beta * (r - before) - p @ g)
        return r


def posterior_cells(member: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, mean posteriors) of the documents of each cell of a grid over
    the posteriors: one distributed sum, of at most GRID^2 / 2 cells."""
    at = [F.floor(F.col(f"p_{d}") * GRID).cast("int").alias(f"g_{d}") for d in DOMAINS[:-1]]
    held = member.where("n_tokens > 0").groupBy(*at).agg(
        F.sum("n_tokens").alias("n"), *(F.sum(F.col("n_tokens") * F.col(f"p_{d}")).alias(d) for d in DOMAINS)
    )
    t = held.orderBy(*(f"g_{d}" for d in DOMAINS[:-1])).toArrow()  # ordered: sums in a fixed order
    n = t["n"].to_numpy().astype(float)
    return n, np.stack([t[d].to_numpy() for d in DOMAINS], axis=1) / np.maximum(n, 1)[:, None]


def settle(n: np.ndarray, p: np.ndarray, goal: np.ndarray, share: np.ndarray, tolerance: float) -> Rates:
    """Accelerated projected gradient from r = 1 until the targets are met
    within ``tolerance``, or until ``PATIENCE`` rounds have lowered the miss by
    less than ``PROGRESS`` of it. The second end keeps targets that cannot be
    met from piling all tokens on the few documents nearest to them."""
    total, has = n.sum(), share > 0
    weight = np.divide(1.0, share, out=np.zeros_like(share), where=has)
    shares = lambda r: (r * n) @ p / total
    out, t, misses = Rates([], []), 1.0, []
    r = before = np.ones(len(n))
    while True:
        misses.append(float(np.abs(shares(r) - goal).sum()))
        if misses[-1] < tolerance:
            return out
        if len(misses) > PATIENCE and min(misses[-PATIENCE:]) > (1 - PROGRESS) * min(misses[:-PATIENCE]):
            return out
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        beta = (t - 1) / t_next
        y = r + beta * (r - before)
        g = (shares(y) - goal) * weight
        new = np.maximum(0.0, y - p @ g)
        if ((y - new) * n) @ (new - r) > 0:  # the momentum leads astray: start it anew
            t_next = 1.0
        out.momentum.append(beta)
        out.gradients.append(g)
        before, r, t = r, new, t_next


def token_shares(member: DataFrame, rates: Rates) -> np.ndarray:
    """Expected tokens of each domain at these rates, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(DOMAINS))
        for batch in batches:
            p = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1)
            sums += (rates.of(p) * batch.column(0).to_numpy()) @ p
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in sums], names=list(DOMAINS))

    parts = member.select("n_tokens", *(f"p_{d}" for d in DOMAINS)).mapInArrow(run, ", ".join(f"{d} double" for d in DOMAINS))
    sums = parts.agg(*(F.sum(d).alias(d) for d in DOMAINS)).first()
    return np.array([sums[d] or 0.0 for d in DOMAINS])


def fit_rates(member: DataFrame, targets: dict[str, float], tolerance: float = 1e-4) -> Rates:
    """Rates that bring the expected tokens to ``targets`` (shares of the
    present tokens; those of domains that have none are dropped and the others
    scaled up). Documents enter by cells of like posteriors; the miss is then
    taken over all documents and returned; it is above ``tolerance`` where the
    targets cannot be met, or only by a few documents."""
    n, p = posterior_cells(member)
    total = n.sum()
    if not total:
        return Rates([], [])
    share = n @ p / total
    has = share > 1e-9
    wanted = np.where(has, [targets[d] for d in DOMAINS], 0.0)
    if not wanted.sum():
        raise ValueError("no domain with tokens has a target")
    goal = wanted / wanted.sum()
    best, offset = None, np.zeros(len(goal))
    for _ in range(CORRECTIONS):  # cells stand for their documents but for those at a rate of 0
        rates = settle(n, p, goal - offset, np.where(has, share, 0.0), tolerance / 2)
        reached = token_shares(member, rates) / total
        rates.miss = float(np.abs(reached - goal).sum())
        best = rates if best is None or rates.miss < best.miss else best
        if best.miss < tolerance:
            break
        offset = reached - (rates.of(p) * n) @ p / total
    return best


def draw() -> Column:
    """A number in [0, 1) from the id."""
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(97)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """doc_id, n_tokens, p_<domain>, rate and copies of every document, and
    target_miss, the same in every row: how far the expected shares stay from
    the targets, in sum.

    copies: the rate rounded down, plus one with the probability of the rest,
    decided by a hash of the id (repeated rows of an id are decided alike).
    Null and empty texts have no tokens and a rate from their statistics alone.
    Without labels all documents have equal posteriors. An empty table gives
    no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    member = stage(memberships(docs, learn(docs, labels)), "mix-members")
    rates = fit_rates(member, targets or TARGETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.stack([c.to_numpy() for c in batch.columns[2:]], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates.of(p))], names=[*batch.schema.names, "rate"])

    rated = member.mapInArrow(run, member.schema.simpleString()[7:-1].replace(":", " ") + ", rate double")
    whole = F.floor("rate")
    copies = (whole + (draw() < F.col("rate") - whole).cast("int")).cast("long")
    return rated.select("*", copies.alias("copies"), F.lit(rates.miss).alias("target_miss"))


def apply_mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` gives it copies. The
    posteriors are made again on the way, so texts are not joined."""
    prepare(docs.sparkSession)
    model = learn(docs, labels)
    member = stage(memberships(docs, model), "mix-members")
    rates = fit_rates(member, targets or TARGETS)

    def times(columns: list[pa.Array]) -> np.ndarray:
        r, u = np.ones(len(columns[0])), columns[2].to_numpy()
        for lo, hi, x in blocks(columns[0], columns[1], WIDTH):
            r[lo:hi] = rates.of(model.posteriors(x))
        return (np.floor(r) + (u < r - np.floor(r))).astype(np.int64)

    return repeat_rows(docs, [*feature_columns(docs), draw().alias("u")], times)
