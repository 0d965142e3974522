"""Hierarchical Pitman-Yor language model.

Every text is its lower-cased words and one end. Every word before a token (or
the start) is a context restaurant of its own. The tables of a context are
customers of a class restaurant (contexts fall into ``CONTEXTS`` hashed
classes), whose tables are the customers of one shared parent, whose base is
uniform over the known words and one unknown. A sweep seats all customers of
every (context, word) anew, given the class probabilities (``draw_tables``), and
then samples the restaurants below from the tables. Given the restaurants'
totals the words are independent, so Spark deals pairs and words to tasks;
totals are held at their estimates while sampling and summed exactly afterwards.

Texts are read once, into chunks with a dictionary and a list of pairs each.
Only these are shuffled, to be counted and to fetch the facts of their words and
pairs; then a chunk's texts meet them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knnrec.llm.common import Words, fold, mix64, passes, prepare, stage, task_id, unstage

CONTEXTS = 8
BURN_IN, SAMPLES = 3, 3
SWEEPS = 2
STRENGTH = 1.0
CHUNK_BYTES = 16 << 20
START, END = np.uint64(0x5EED0F57A127B0B5), np.uint64(0xE0D0FD0C5A11D0E5)
COUNTS = [f"c{u}" for u in range(CONTEXTS)]
TABLES = [[f"t{s}_{u}" for u in range(CONTEXTS)] for s in range(SAMPLES)]
PARENT = [f"r{s}" for s in range(SAMPLES)]


# ------------------------------------------------------------- reading texts


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes with an end after each text, text offsets."""
    words = Words(buf, offs)
    token = np.empty(len(words.hash) + words.texts, dtype=np.uint64)
    at = words.first + np.arange(words.texts + 1)
    token[np.arange(len(words.hash)) + words.of] = words.hash
    token[at[1:] - 1] = END
    return token, at


def pair_keys(code: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Numbers of (place before, place) of a chunk's tokens; ``size`` - 1 is
    the place of the start."""
    before = np.empty_like(code)
    before[1:] = code[:-1]
    before[starts] = size - 1
    return before * size + code


def context_of(token: np.ndarray) -> np.ndarray:
    return (mix64(token) % np.uint64(CONTEXTS)).astype(np.int64)


def pack_numbers(numbers: np.ndarray, compressor) -> bytes:
    """Whole numbers below 2^32, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return compressor.compress(planes.tobytes())


def unpack_numbers(blob: bytes, decompressor) -> np.ndarray:
    planes = np.frombuffer(decompressor.decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


SCAN = "kind int, chunk long, id long, held_out boolean, n long, codes binary, word long, times int"


def read_chunks(docs: DataFrame) -> DataFrame:
    """kind 0: a text (id, held_out, n tokens, packed codes: places of its
    tokens in the chunk's dictionary). kind 1: a dictionary entry (id: word
    hash, n: place; the start comes last). kind 2: a pair (id: hash of the word
    before, n: place among the chunk's pairs, word: hash, times in training)."""
    names = [x.split()[0] for x in SCAN.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor, number = zstandard.ZstdCompressor(level=1), 0
        parts: list[tuple] = []
        size = 0

        def flush():
            token = np.concatenate([p[0] for p in parts])
            lengths = np.concatenate([np.diff(p[1]) for p in parts])
            ids = pa.concat_arrays([p[2] for p in parts])
            held = np.concatenate([p[3] for p in parts])
            parts.clear()
            word, place, times = np.unique(token, return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")  # small codes for common words
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            code = rank[place]
            word = np.append(word[order], START).astype(np.int64)
            ends = ragged(lengths)
            pair, of = np.unique(pair_keys(code, ends[:-1], len(word)), return_inverse=True)
            trained = np.bincount(of[np.repeat(~held, lengths)], minlength=len(pair)).astype(np.int32)
            chunk = (task_id() << 24) + number
            blobs = [pack_numbers(code[a:b], compressor) for a, b in zip(ends, ends[1:], strict=False)]

            def rows(kind, n, id_, held_out=None, length=None, codes=None, other=None, count=None):
                columns = [np.full(n, kind, np.int32), np.full(n, chunk), id_, held_out, length, codes, other, count]
                return pa.RecordBatch.from_arrays(
                    [pa.nulls(n, t) if c is None else pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )

            yield rows(0, len(blobs), ids, held, lengths, blobs)
            for a in range(0, len(word), 50_000):
                own = word[a : a + 50_000]
                yield rows(1, len(own), own, length=np.arange(a, a + len(own)))
            for a in range(0, len(pair), 50_000):
                before, after = np.divmod(pair[a : a + 50_000], len(word))
                at = np.arange(a, a + len(before))
                yield rows(2, len(at), word[before], length=at, other=word[after], count=trained[a : a + len(at)])

        for batch in batches:
            held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, buf, offs in passes(batch.column(1)):
                token, at = tokens(buf, offs)
                parts.append((token, at, batch.column(0)[lo:hi], held[lo:hi]))
                size += len(buf)
                if size >= CHUNK_BYTES:
                    yield from flush()
                    size, number = 0, number + 1
        if parts:
            yield from flush()

    held_out = fold(F.col("doc_id"), 7) == 2
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out.alias("held_out"))
    return rows.mapInArrow(run, SCAN)


# ----------------------------------------------------------------- sampling


class RowRandom:
    """Random numbers that follow from each row's own key, and from how often
    the stream was asked; not from the rows beside it. A task that is run again,
    or is dealt other rows, draws the same. Stands for a numpy Generator whose
    results have one number per row."""

    def __init__(self, key: np.ndarray, seed: int):
        self.key = mix64(key ^ mix64(np.full(1, seed & (2**64 - 1), np.uint64)))
        self.asked = 0

    def _bits(self, part: int = 0) -> np.ndarray:
        turn = np.array([((self.asked << 20) + part + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)], np.uint64)
        return mix64(self.key + turn)

    def _uniform(self, part: int = 0) -> np.ndarray:
        return ((self._bits(part) >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53

    def take(self, rows: np.ndarray) -> RowRandom:
        """The stream of some of the rows."""
        self.asked += 1
        out = RowRandom.__new__(RowRandom)
        out.key, out.asked = mix64(self.key[rows] + np.uint64(self.asked)), 0
        return out

    def random(self, n: int) -> np.ndarray:
        self.asked += 1
        return self._uniform()

    def gamma(self, shape: np.ndarray) -> np.ndarray:
        """Marsaglia and Tsang's rejection for shape + 1, brought down."""
        self.asked += 1
        d = shape + 2.0 / 3.0
        c, out, open_, part = 1 / np.sqrt(9 * d), np.zeros(len(shape)), np.arange(len(shape)), 1
        lift = self._uniform() ** (1 / shape)
        while len(open_):
            u, a, b = (self._uniform(part + j)[open_] for j in range(3))
            x = np.sqrt(-2 * np.log(a)) * np.cos(2 * np.pi * b)
            v = (1 + c[open_] * x) ** 3
            good = v > 0
            good[good] = np.log(u[good]) < x[good] ** 2 / 2 + d[open_][good] * (1 - v[good] + np.log(v[good]))
            out[open_[good]] = (d[open_] * v)[good]
            open_, part = open_[~good], part + 3
        return out * lift

    def _each(self, draw) -> np.ndarray:
        """One generator a row: for the few rows that need a rare draw."""
        self.asked += 1
        keys = self._bits()
        return np.array([draw(np.random.Generator(np.random.Philox(key=int(k))), i) for i, k in enumerate(keys)], dtype=np.int64)

    def binomial(self, n: np.ndarray, p: np.ndarray) -> np.ndarray:
        return self._each(lambda g, i: g.binomial(n[i], p[i]))

    def poisson(self, mean: np.ndarray) -> np.ndarray:
        return self._each(lambda g, i: g.poisson(mean[i]))


def some(rng, rows: np.ndarray):
    return rng.take(rows) if isinstance(rng, RowRandom) else rng


class Seating:
    """Table sizes of many dishes: ``size[i, k]`` occurs ``many[i, k]`` times.
    Tables of equal size are exchangeable, so this is all a restaurant needs.
    Customers move one by one: the measure that ``draw_tables`` is held to."""

    def __init__(self, customers: np.ndarray, tables: np.ndarray, slots: int):
        n = len(customers)
        self.size, self.many = np.zeros((n, slots), np.int64), np.zeros((n, slots), np.int64)
        large = customers - tables + 1
        self.size[:, 0], self.many[:, 0] = large, 1
        self.size[:, 1], self.many[:, 1] = 1, tables - 1
        one = large == 1  # all tables have one customer
        self.many[one, 0], self.many[one, 1] = tables[one], 0
        self.tables, self.customers = tables.astype(np.int64), customers.astype(np.int64)

    def _pick(self, rows: np.ndarray, weight: np.ndarray, rng) -> np.ndarray:
        upto = np.cumsum(weight, axis=1)
        drawn = rng.random(len(rows)) * upto[:, -1]
        return np.minimum((upto <= drawn[:, None]).sum(axis=1), weight.shape[1] - 1)

    def _change(self, rows: np.ndarray, size: np.ndarray, by: int) -> None:
        same = (self.size[rows] == size[:, None]) & (self.many[rows] > 0)
        at = np.where(same.any(axis=1), same.argmax(axis=1), (self.many[rows] == 0).argmax(axis=1))
        self.size[rows, at] = size
        self.many[rows, at] += by

    def leave(self, rows: np.ndarray, rng) -> np.ndarray:
        """A random customer of each dish leaves; whether its table closed."""
        at = self._pick(rows, self.size[rows] * self.many[rows], rng)
        size = self.size[rows, at]
        self.many[rows, at] -= 1
        stays = size > 1
        self._change(rows[stays], size[stays] - 1, 1)
        self.customers[rows] -= 1
        self.tables[rows] -= ~stays
        return ~stays

    def enter(self, rows: np.ndarray, new_weight: np.ndarray, discount: float, rng) -> np.ndarray:
        """A customer sits down: at a table by its size less the discount, at a
        new one by ``new_weight``; whether the table is new."""
        weight = (self.size[rows] - discount) * self.many[rows]
        old = weight.sum(axis=1)
        new = rng.random(len(rows)) * (old + new_weight) >= old
        self._change(rows[new], np.ones(int(new.sum()), np.int64), 1)
        rest = rows[~new]
        at = self._pick(rest, weight[~new], rng)
        size = self.size[rest, at]
        self.many[rest, at] -= 1
        self._change(rest, size + 1, 1)
        self.customers[rows] += 1
        self.tables[rows] += new
        return new


def expected_tables(customers: np.ndarray, weight: np.ndarray, discount: float) -> np.ndarray:
    """Tables that ``customers`` of a dish are expected to open one after the
    other, ``weight`` being the weight of a new one."""
    t, n = np.ones(len(customers)), 1.0
    most = customers.max(initial=1)
    while n < most:
        step = 1.0 if n < 32 else n / 4
        take = np.clip(customers - n, 0, step)
        t += take * weight / (np.maximum(n - discount * t, 1e-9) + weight)
        n += step
    return np.clip(np.rint(t), 1, customers).astype(np.int64)


#: Up to here table counts are drawn from their exact distribution, beyond it
#: from one of the same mean and variance but for saddle point errors.
EXACT = 256


@lru_cache(maxsize=8)
def log_seatings(discount: float) -> np.ndarray:
    """log of the summed weights of all seatings of c customers at t tables,
    by [c, t] (generalised Stirling numbers)."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(EXACT + 1)
    with np.errstate(divide="ignore"):
        for c in range(1, EXACT):
            joins = out[c] + np.log(np.maximum(c - discount * t, 0))
            out[c + 1] = np.logaddexp(joins, np.concatenate(([-np.inf], out[c, :-1])))
    return out


def draw_tables(customers: np.ndarray, weight: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables of dishes after all their customers sat down anew, ``weight``
    being the weight of a new table."""
    tables = np.ones(len(customers), np.int64)
    stirling, below, log_weight = log_seatings(discount), 1, np.log(weight)
    drawn = rng.random(len(customers))
    for upto in (4, 16, 64, EXACT):
        t = np.arange(1, upto + 1)
        group = np.flatnonzero((customers > below) & (customers <= upto))
        for a in range(0, len(group), (1 << 20) // upto):
            rows = group[a : a + (1 << 20) // upto]
            tables[rows] = _pick_tables(stirling[customers[rows], 1 : upto + 1] + t * log_weight[rows, None], drawn[rows, None])
        below = upto
    rows = np.flatnonzero(customers > EXACT)
    tables[rows] = _draw_many(customers[rows].astype(float), weight[rows].astype(float), discount, some(rng, rows))
    return tables


def _draw_many(c: np.ndarray, a: np.ndarray, d: float, rng) -> np.ndarray:
    """Sizes of tables are Poisson numbers given their sum: one customer's
    table has the generating function (1-x)^(d-1), the others together
    exp(a (1-(1-x)^d) / d). x is where their means add up to c; the others are
    drawn from the binomial distribution of their mean and variance there."""
    low, high = np.log(1e-3 / c) / (1 - d) - 40, np.zeros(len(c))  # log(1 - x)
    low = np.minimum(low, np.log(np.minimum(a / c, 1)) / (1 - d) - 1)
    for _ in range(80):
        at = (low + high) / 2
        x = -np.expm1(at)
        over = x * ((1 - d) * np.exp(-at) + a * np.exp((d - 1) * at)) > c - 1
        low, high = np.where(over, at, low), np.where(over, high, at)
    x, mean = -np.expm1(at), -a * np.expm1(d * at) / d
    among = a * x * np.exp((d - 1) * at)
    var = mean - among / ((1 - d) * x * np.exp(-2 * at) / among + (1 - d * x) * np.exp(-at))
    share = np.clip(1 - var / mean, 1e-9, 1)
    drawn = 1 + rng.binomial(np.rint(mean / share).astype(np.int64), np.minimum(mean / np.maximum(np.rint(mean / share), 1), 1))
    drawn = np.where(share < 1e-3, 1 + rng.poisson(mean), drawn)
    return np.clip(drawn, 1, c).astype(np.int64)


def _pick_tables(log_p: np.ndarray, drawn: np.ndarray) -> np.ndarray:
    upto = np.cumsum(np.exp(log_p - log_p.max(axis=1, keepdims=True)), axis=1)
    return np.minimum((upto <= drawn * upto[:, -1:]).sum(axis=1) + 1, np.isfinite(log_p).sum(axis=1))


def sample_seatings(counts: np.ndarray, totals: dict, rng) -> tuple[np.ndarray, np.ndarray]:
    """Tables of each context [samples, words, contexts] and of the parent
    [samples, words] for the words of ``counts``. A round seats all customers
    anew: those of the contexts given the word's probability in the parent,
    the parent's given their tables, and then draws that probability."""
    n = len(counts)
    d1, d0 = totals["d1"], totals["d0"]
    new_parent = (STRENGTH + d0 * totals["parent_tables"]) * totals["base"]
    seats = STRENGTH + totals["parent_customers"]
    open_ = STRENGTH + d1 * totals["tables"]
    guess = np.where(counts > 0, counts.astype(float) ** d1, 0).sum(axis=1)
    p0 = (np.maximum(guess - d0, 0) + new_parent) / seats
    tables, parent = np.zeros((n, CONTEXTS), np.int64), np.zeros(n, np.int64)
    kept_t, kept_r = np.empty((SAMPLES, n, CONTEXTS), np.int64), np.empty((SAMPLES, n), np.int64)
    for r in range(BURN_IN + SAMPLES):
        for u in range(CONTEXTS):
            rows = np.flatnonzero(counts[:, u])
            tables[rows, u] = draw_tables(counts[rows, u], open_[u] * p0[rows], d1, some(rng, rows))
        customers = tables.sum(axis=1)
        rows = np.flatnonzero(customers)
        parent[rows] = draw_tables(customers[rows], np.full(len(rows), new_parent), d0, some(rng, rows))
        p0 = np.maximum(rng.gamma(customers - d0 * parent + new_parent), 1e-200) / seats
        if r >= BURN_IN:
            kept_t[r - BURN_IN], kept_r[r - BURN_IN] = tables, parent
    return kept_t, kept_r


def large_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def seat_words(vocabulary: DataFrame, totals: dict, seed: int) -> DataFrame:
    """``vocabulary`` with the sampled tables of every word, whose random numbers
    are its own."""
    added = [c for cols in TABLES for c in cols] + PARENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in large_batches(batches, 40_000):
            counts = np.stack([t[c].to_numpy() for c in COUNTS], axis=1)
            word = t["word"].to_numpy()
            rng = RowRandom(word.view(np.uint64), seed)
            kept_t, kept_r = sample_seatings(counts, totals, rng)
            columns = [t["word"].combine_chunks(), *(t[c].combine_chunks() for c in COUNTS)]
            columns += [pa.array(kept_t[s, :, u].copy()) for s in range(SAMPLES) for u in range(CONTEXTS)]
            columns += [pa.array(kept_r[s]) for s in range(SAMPLES)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", *COUNTS, *added])

    return vocabulary.mapInArrow(run, ", ".join(f"{c} long" for c in ["word", *COUNTS, *added]))


CLASS_P = [f"p{u}" for u in range(CONTEXTS)]
PAIR_SEATS = "context long, word long, class int, tables long, drawn long, seen float"


def seat_pairs(pairs: DataFrame, contexts: DataFrame, words: DataFrame, discount: float, seed: int) -> DataFrame:
    """All customers of every pair (context, word, c) seated anew, ``SAMPLES``
    times, given the contexts' (served, open: tables) and the words' class
    probabilities. tables: of the first time, drawn: of all; seen: what the
    context adds to its backoff."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in large_batches(batches, 100_000):
            context, word, c = (t[k].to_numpy() for k in ("context", "word", "c"))
            of = context_of(context.view(np.uint64))
            p = np.stack([t[k].to_numpy() for k in CLASS_P], axis=1)[np.arange(len(c)), of]
            rng = RowRandom(mix64(context.view(np.uint64)) + word.view(np.uint64), seed)
            weight = (STRENGTH + discount * t["open"].to_numpy()) * p
            tables = np.stack([draw_tables(c, weight, discount, rng) for _ in range(SAMPLES)])
            drawn = tables.sum(axis=0)
            seen = (c - discount * drawn / SAMPLES) / (STRENGTH + t["served"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(context), pa.array(word), pa.array(of.astype(np.int32)), pa.array(tables[0]), pa.array(drawn), pa.array(seen.astype(np.float32))],
                names=[x.split()[0] for x in PAIR_SEATS.split(", ")],
            )

    return pairs.join(words, "word").join(contexts, "context").mapInArrow(run, PAIR_SEATS)


# --------------------------------------------------------------- probabilities


class Predictive:
    """Averaged predictive probabilities, given the totals of each sample."""

    def __init__(self, totals: dict, sampled: dict):
        d1, d0 = totals["d1"], totals["d0"]
        self.d1, self.d0 = d1, d0
        self.served = STRENGTH + totals["served"]  # by context
        tables = np.array([[sampled[c] for c in cols] for cols in TABLES], float)  # samples x contexts
        parent = np.array([sampled[c] for c in PARENT], float)
        self.backoff = (STRENGTH + d1 * tables) / self.served
        self.seats = STRENGTH + tables.sum(axis=1)
        self.fresh = (STRENGTH + d0 * parent) * totals["base"] / self.seats
        self.unknown = (self.backoff * self.fresh[:, None]).mean(axis=0)

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """P of the parent [samples, words]."""
        return (customers - self.d0 * tables) / self.seats[:, None] + self.fresh[:, None]

    def seen(self, counts: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """What a context adds to backoff [words, contexts]."""
        return (counts - self.d1 * tables.mean(axis=0)) / self.served

    def words(self, counts: np.ndarray, tables: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """P of words after each class [words, contexts]; no counts: unknown."""
        base = self.parent(tables.sum(axis=2), parent).T @ self.backoff / SAMPLES
        known = counts.any(axis=1)[:, None]
        return np.where(known, base + np.where(counts > 0, self.seen(counts, tables), 0), self.unknown)


#: Numbers of a word's facts with k contexts: counts, tables, parent's tables.
SIZES = [k + SAMPLES * k + SAMPLES for k in range(CONTEXTS + 1)]
WIDTHS = (1, 2, 4, 8)


def ragged(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


def encode_facts(counts: np.ndarray, tables: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of each word's facts. A word that occurs once: its
    context. Others: bytes per number, a bit for each context, the numbers."""
    once = counts.sum(axis=1) == 1
    seen = counts > 0
    k = seen.sum(axis=1)
    width = np.searchsorted([1 << 8, 1 << 16, 1 << 32], counts.sum(axis=1), "right")
    lengths = np.where(once, 1, 2 + np.array(SIZES)[k] * np.array(WIDTHS)[width])
    offs = ragged(lengths)
    data = np.zeros(offs[-1], np.uint8)
    data[offs[:-1][once]] = seen[once].argmax(axis=1)
    bits = np.packbits(seen, axis=1, bitorder="little")[:, 0]
    for w, bytes_each in enumerate(WIDTHS):
        for m in range(1, CONTEXTS + 1):
            rows = np.flatnonzero(~once & (width == w) & (k == m))
            if not len(rows):
                continue
            at = seen[rows]
            numbers = np.concatenate(
                [counts[rows][at].reshape(-1, m), *(t[rows][at].reshape(-1, m) for t in tables), parent[rows]], axis=1
            )
            raw = numbers.astype(f"<u{bytes_each}").view(np.uint8).reshape(len(rows), -1)
            raw = np.concatenate((np.full((len(rows), 1), w, np.uint8), bits[rows][:, None], raw), axis=1)
            data[offs[:-1][rows][:, None] + np.arange(raw.shape[1])] = raw
    return data, offs


def decode_facts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, tables and parent's tables of each word; no bytes: all 0."""
    n, lengths = len(offs) - 1, np.diff(offs)
    counts, tables = np.zeros((n, CONTEXTS), np.int64), np.zeros((SAMPLES, n, CONTEXTS), np.int64)
    parent = np.zeros((n, SAMPLES), np.int64)
    once = np.flatnonzero(lengths == 1)
    context = data[offs[once]].astype(np.int64)
    counts[once, context], tables[:, once, context], parent[once] = 1, 1, 1
    many = np.flatnonzero(lengths > 1)
    width, bits = data[offs[many]], data[offs[many] + 1]
    seen = np.unpackbits(bits[:, None], axis=1, bitorder="little").astype(bool)[:, :CONTEXTS]
    k = seen.sum(axis=1)
    for w, bytes_each in enumerate(WIDTHS):
        for m in range(1, CONTEXTS + 1):
            own = np.flatnonzero((width == w) & (k == m))
            if not len(own):
                continue
            rows, at = many[own], seen[own]
            raw = data[(offs[rows] + 2)[:, None] + np.arange(SIZES[m] * bytes_each)]
            numbers = raw.view(f"<u{bytes_each}").astype(np.int64)
            row, u = np.nonzero(at)
            counts[rows[row], u] = numbers[:, :m].ravel()
            for s in range(SAMPLES):
                tables[s, rows[row], u] = numbers[:, m * (s + 1) : m * (s + 2)].ravel()
            parent[rows] = numbers[:, -SAMPLES:]
    return counts, tables, parent


def binary_column(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    array = column.combine_chunks().fill_null(b"").cast(pa.large_binary())
    _, offsets, data = array.buffers()
    offs = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offs


def class_probabilities(seated: DataFrame, model: Predictive) -> DataFrame:
    """word, P after each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in large_batches(batches, 40_000):
            stack = lambda cols: np.stack([t[c].to_numpy() for c in cols], axis=1)
            p = model.words(stack(COUNTS), np.stack([stack(cols) for cols in TABLES]), stack(PARENT).T)
            yield pa.RecordBatch.from_arrays([t["word"].combine_chunks(), *map(pa.array, p.T.copy())], names=["word", *CLASS_P])

    return seated.mapInArrow(run, "word long, " + ", ".join(f"{c} double" for c in CLASS_P))


def word_facts(seated: DataFrame) -> DataFrame:
    """word, facts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in large_batches(batches, 40_000):
            stack = lambda cols: np.stack([t[c].to_numpy() for c in cols], axis=1)
            data, offs = encode_facts(stack(COUNTS), np.stack([stack(cols) for cols in TABLES]), stack(PARENT))
            facts = pa.Array.from_buffers(pa.large_binary(), t.num_rows, [None, pa.py_buffer(offs), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([t["word"].combine_chunks(), facts.cast(pa.binary())], names=["word", "facts"])

    return seated.mapInArrow(run, "word long, facts binary")


BUNDLE = "of_chunk long, kind int, blob binary"


def by_chunk(t: pa.Table, kind: int, make) -> pa.RecordBatch:
    """A row (of_chunk, kind, ``make`` of its row numbers) per chunk of ``t``."""
    chunk = t["chunk"].to_numpy()
    order = np.argsort(chunk, kind="stable")
    cuts = [*np.flatnonzero(np.diff(chunk[order], prepend=chunk[order][:1] - 1)).tolist(), len(order)]
    rows = [order[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    columns = [pa.array([int(chunk[r[0]]) for r in rows], pa.int64()), pa.array([kind] * len(rows), pa.int32())]
    return pa.RecordBatch.from_arrays([*columns, pa.array([make(r) for r in rows], pa.binary())], names=["of_chunk", "kind", "blob"])


def pack(arrays: list[np.ndarray], compressor) -> bytes:
    blobs = [compressor.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()) for a in arrays]
    return np.array([len(b) for b in blobs], "<i8").tobytes() + b"".join(blobs)


def unpack(blob: bytes, types: list[str], decompressor) -> list[np.ndarray]:
    ends = ragged(np.frombuffer(blob[: 8 * len(types)], "<i8")) + 8 * len(types)
    out = []
    for a, b, kind in zip(ends, ends[1:], types, strict=False):
        planes = np.frombuffer(decompressor.decompress(blob[a:b]), np.uint8).reshape(np.dtype(kind).itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
    return out


ENTRY = ["<u4", "<i8", "<i8", "<f8", "<u4", "u1"]


def bundle(fetched: DataFrame) -> DataFrame:
    """Dictionary entries (chunk, word, place, total, backoff, facts) of a
    chunk, many to a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=3)
        for t in large_batches(batches, 500_000):
            data, offs = binary_column(t["facts"])
            of = context_of(t["word"].to_numpy().view(np.uint64))
            place, total, backoff = t["place"].to_numpy().astype("<u4"), t["total"].to_numpy(), t["backoff"].to_numpy()

            def make(rows):
                length = offs[rows + 1] - offs[rows]
                ends = ragged(length)
                own = data[np.repeat(offs[rows] - ends[:-1], length) + np.arange(ends[-1])]
                return pack([place[rows], of[rows], total[rows], backoff[rows], length.astype("<u4"), own], compressor)

            yield by_chunk(t, 1, make)

    return fetched.mapInArrow(run, BUNDLE)


def bundle_pairs(fetched: DataFrame) -> DataFrame:
    """Pairs (chunk, place, seen) of a chunk, many to a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=1)
        for t in large_batches(batches, 500_000):
            place, seen = t["place"].to_numpy().astype("<u4"), t["seen"].to_numpy()

            def make(rows):
                rows = rows[np.argsort(place[rows])]
                return pack([np.diff(place[rows], prepend=np.uint32(0)), seen[rows]], compressor)

            yield by_chunk(t, 2, make)

    return fetched.mapInArrow(run, BUNDLE)


def chunk_tables(rows: pa.Table, model: Predictive, decompressor) -> tuple[np.ndarray, ...]:
    """Of a chunk: P of the words after each class, training counts, classes
    and backoffs that the words make for the next token (by place); places of
    pairs and what they add."""
    blobs = {k: [b.as_py() for b, kind in zip(rows["blob"], rows["kind"], strict=True) if kind.as_py() == k] for k in (1, 2)}
    parts = [unpack(b, ENTRY, decompressor) for b in blobs[1]]
    size = sum(len(x[0]) for x in parts)
    p, total, makes, back = np.empty((size, CONTEXTS)), np.empty(size, np.int64), np.empty(size, np.int64), np.empty(size)
    for place, of, count, backoff, length, facts in parts:
        counts, tables, parent = decode_facts(facts, ragged(length))
        p[place] = model.words(counts, tables, parent.T)
        total[place], makes[place], back[place] = count, of, backoff
    pairs = [unpack(b, ["<u4", "<f4"], decompressor) for b in blobs[2]]
    at = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(x.astype(np.int64)) for x, _ in pairs)])
    return p, total, makes, back, at, np.concatenate([np.zeros(0, np.float32), *(x for _, x in pairs)])


def discount_of(once: int | None, twice: int | None) -> float:
    return min(max(once / (once + 2 * twice), 0.05), 0.95) if once and twice else 0.5


def seat_classes(vocabulary: DataFrame, words: int, seed: int) -> tuple[DataFrame, Predictive]:
    """The class restaurants and their parent sampled from ``vocabulary``
    (word, customers of each class); their predictive probabilities."""
    one, two = (sum(((F.col(c) == k).cast("int") for c in COUNTS), F.lit(0)) for k in (1, 2))
    kinds = sum(((F.col(c) > 0).cast("int") for c in COUNTS), F.lit(0))
    facts = vocabulary.agg(
        *(F.sum(c).alias(c) for c in COUNTS), F.sum(one).alias("n1"), F.sum(two).alias("n2"),
        F.sum((kinds == 1).cast("int")).alias("k1"), F.sum((kinds == 2).cast("int")).alias("k2"),
    ).first()
    totals = {
        "d1": discount_of(facts["n1"], facts["n2"]), "d0": discount_of(facts["k1"], facts["k2"]),
        "base": 1.0 / (words + 1), "served": np.array([facts[c] or 0 for c in COUNTS], float),
    }
    opened = [power(F.col(c), totals["d1"]) for c in COUNTS]
    guess = vocabulary.agg(
        *(F.sum(o).alias(c) for o, c in zip(opened, COUNTS, strict=True)),
        F.sum(power(sum(opened[1:], opened[0]), totals["d0"])).alias("parent"),
    ).first()
    totals["tables"] = np.array([guess[c] or 0.0 for c in COUNTS])
    totals["parent_customers"], totals["parent_tables"] = totals["tables"].sum(), guess["parent"] or 0.0
    seated = stage(seat_words(vocabulary, totals, seed), "lm-seated")
    sampled = seated.agg(*(F.sum(c).alias(c) for cols in [*TABLES, PARENT] for c in cols)).first()
    return seated, Predictive(totals, {k: v or 0 for k, v in sampled.asDict().items()})


def power(x: Column, d: float) -> Column:
    return F.when(x > 0, F.pow(x, F.lit(d))).otherwise(0.0)


def score(docs: DataFrame, seed: int = 5) -> DataFrame:
    """Learn from the documents with crc32(doc_id) mod 7 not 2 and score all.

    Returns doc_id, held_out, n_tokens (words and one end), n_known (training
    count above 0), train_tokens, base_score (add-one unigram), score (log10 of
    the averaged predictive probability of the text), perplexity (10^(-score /
    n_tokens)). A null or empty text is the end alone. Repeated rows count and
    are scored each for itself. Without training tokens every probability
    is the base's. An empty table gives no rows; other columns are ignored.
    Words are known by a 64-bit hash.
    """
    prepare(docs.sparkSession)
    chunks = stage(read_chunks(docs), "lm-chunks")
    entries, uses = chunks.where("kind = 1"), chunks.where("kind = 2")
    pairs = uses.where("times > 0").groupBy(F.col("id").alias("context"), "word").agg(F.sum("times").cast("long").alias("c"))
    pairs = stage(pairs, "lm-pairs")
    found = pairs.agg(F.sum((F.col("c") == 1).cast("int")).alias("n1"), F.sum((F.col("c") == 2).cast("int")).alias("n2")).first()
    d2 = discount_of(found["n1"], found["n2"])
    opened = F.sum(power(F.col("c"), d2))
    contexts = stage(pairs.groupBy("context").agg(F.sum("c").alias("served"), opened.alias("open")), "lm-contexts")
    words = stage(pairs.groupBy("word").agg(F.sum("c").alias("total"), opened.alias("guess")), "lm-words")
    facts = words.agg(F.count(F.lit(1)).alias("words"), F.sum("total").alias("tokens"), F.sum("guess").alias("guess")).first()
    n_train, n_words = facts["tokens"] or 0, facts["words"]
    probabilities = words.select("word", *((F.col("guess") / F.lit(facts["guess"] or 1.0)).alias(c) for c in CLASS_P))
    superseded: list[DataFrame] = []
    for sweep in range(SWEEPS):
        seats = stage(seat_pairs(pairs, contexts, probabilities, d2, 1000 * seed + 2 * sweep), "lm-pair-seats")
        tables = seats.groupBy("context").agg(F.sum("tables").cast("double").alias("open"), F.sum("drawn").alias("drawn"))
        earlier, contexts = contexts, stage(contexts.select("context", "served").join(tables, "context"), "lm-contexts")
        own = (F.sum(F.when(F.col("class") == u, F.col("tables")).otherwise(0)).alias(c) for u, c in enumerate(COUNTS))
        vocabulary = stage(seats.groupBy("word").agg(*own), "lm-vocabulary")
        seated, model = seat_classes(vocabulary, n_words, 1000 * seed + 2 * sweep + 1)
        unstage(earlier, vocabulary, *superseded)  # written anew above
        superseded = [seats, seated]
        probabilities = class_probabilities(seated, model)
    unstage(pairs)
    backoff = (F.lit(STRENGTH) + F.lit(d2) * F.col("drawn") / SAMPLES) / (F.lit(STRENGTH) + F.col("served"))
    facts_of = entries.select("chunk", F.col("id").alias("word"), F.col("n").alias("place"))
    facts_of = facts_of.join(word_facts(seated).join(words.select("word", "total"), "word"), "word", "left")
    facts_of = facts_of.join(contexts.select(F.col("context").alias("word"), backoff.alias("backoff")), "word", "left")
    facts_of = facts_of.select("chunk", "word", "place", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("backoff", F.lit(1.0)).alias("backoff"), "facts")
    added = uses.select("chunk", F.col("id").alias("context"), "word", F.col("n").alias("place"))
    added = added.join(seats.select("context", "word", "seen"), ["context", "word"]).select("chunk", "place", "seen")

    def run(texts: pa.Table, fetched: pa.Table) -> pa.Table:
        import zstandard

        decompressor = zstandard.ZstdDecompressor()
        p, counts, makes, back, at, seen = chunk_tables(fetched, model, decompressor)
        n = texts["n"].to_numpy()
        starts = ragged(n)[:-1]
        place = np.concatenate([np.zeros(0, np.int64), *(unpack_numbers(x.as_py(), decompressor) for x in texts["codes"])])
        key, of = np.unique(pair_keys(place, starts, len(p)), return_inverse=True)
        before, word = np.divmod(key, len(p))
        own = back[before] * p[word, makes[before]]
        own[at] += seen
        total = lambda x: np.add.reduceat(x, starts) if len(starts) else x[:0]
        base = np.log10((counts + 1) / (n_train + n_words + 1))
        score = total(np.log10(own)[of])
        return pa.table({
            "doc_id": texts["id"], "held_out": texts["held_out"], "n_tokens": texts["n"], "n_known": total((counts > 0).astype(np.int64)[place]),
            "train_tokens": np.full(len(n), n_train), "base_score": total(base[place]), "score": score,
            "perplexity": np.power(10.0, np.minimum(-score / np.maximum(n, 1), 300)),
        })

    texts = chunks.where("kind = 0").select("chunk", "id", "held_out", "n", "codes")
    return (
        texts.groupBy("chunk")
        .cogroup(bundle(facts_of).unionByName(bundle_pairs(added)).groupBy("of_chunk"))
        .applyInArrow(
            run,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
            "score double, perplexity double",
        )
    )
