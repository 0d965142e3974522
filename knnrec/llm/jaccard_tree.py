"""Jaccard similarity join of word shingles with signature trees.

Documents with equal shingle sets are one class. Two sets of similarity t
share k tokens among their first n - ceil(t n) + k tokens in any common order
(the smaller one among still fewer), so classes meet in the groups of these
prefix tokens, and a class that shares fewer tokens than that is out. Tokens
seen often come last in the order, which keeps common passages out of the
prefixes.

A group's sets hang in signature trees: a node holds the OR of the token
bitmaps below it, the range of sizes and the largest excess of tokens over
bits. Two trees are walked together from the top, and a pair of nodes is left
when no pair below can overlap enough. The pairs of sets that remain are
compared exactly.

The result needs components, not pairs, so links inside a known component are
not looked for: a first round compares a likeliest spanning forest in a few
groups of each class (large groups in blocks that share two pivots: linear
work); a second one compares, in every group, all that is left between
different components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knnrec.llm.common import Words, grouped, mix64, passes, prepare, shingles, stage
from knnrec.llm.components import components

#: A set of 64-bit values as a bitmap of fixed size: 1 MB, on the driver and
#: in every task. Used only where a false hit changes cost, not results.
FILTER_BITS = 23
#: Counts from which a token goes to the end of the order.
COMMON = 8
#: Rows of a cell side.
BLOCK = 256
#: Groups of each class in the first round.
FIRST_GROUPS = 3
FANOUT = 8
#: Ids of dropped documents that are broadcast, at most (8 MB of numbers);
#: more are joined with a shuffle of the documents.
BROADCAST_IDS = 1_000_000


def text_sets(array: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """(first row, sorted distinct shingle hashes, set keys) in passes."""
    for lo, hi, buf, offs in passes(array):
        values, at = shingles(Words(buf, offs), size)
        sets = []
        for i in range(hi - lo):
            v = np.sort(values[at[i] : at[i + 1]])
            sets.append(v[np.concatenate(([True], v[1:] != v[:-1]))] if len(v) else v)
        keys = np.array([(mix64(s).sum() if len(s) else 0) + len(s) for s in sets], dtype=np.uint64)
        yield lo, sets, mix64(keys).astype(np.int64)


def bit_of(values: np.ndarray) -> np.ndarray:
    return (mix64(values.astype(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def bit_filter(values: DataFrame) -> np.ndarray:
    """The 2^FILTER_BITS-bit bitmap of a column of 64-bit values, built by a
    partial OR: at most 2^FILTER_BITS / 32 rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.unique(bit_of(batch.column(0).to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(bit >> 5), pa.array(np.int64(1) << (bit & 31))], names=["i", "w"])

    found = values.mapInArrow(run, "i long, w long").groupBy("i").agg(F.bit_or("w").alias("w")).toArrow()
    words = np.zeros(1 << (FILTER_BITS - 5), dtype=np.int64)
    words[found["i"].to_numpy()] = found["w"].to_numpy()
    return words.astype(np.uint32)


def hits(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = bit_of(values)
    return (bits[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) > 0


def profile(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n, key of every document (kind 0); tokens that several sets of
    one pass of text share, with their number of sets (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, seen = ["kind", "id", "n", "key"], set()
        for batch in batches:
            for lo, sets, keys in text_sets(batch.column(1), size):
                n = np.array([len(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(n), np.int32)), batch.column(0)[lo : lo + len(n)], pa.array(n), pa.array(keys)],
                    names=names,
                )
                fresh = [s for s, k in zip(sets, keys.tolist(), strict=True) if not (k in seen or seen.add(k))]
                if len(fresh) > 1:
                    token, count = np.unique(np.concatenate(fresh), return_counts=True)
                    many = count > 1
                    if many.any():
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.ones(int(many.sum()), np.int32)), pa.nulls(int(many.sum()), pa.int64()),
                                pa.array(count[many]), pa.array(token[many].astype(np.int64)),
                            ],
                            names=names,
                        )

    return docs.mapInArrow(run, "kind int, id long, n long, key long")


def prefix_tokens(s: np.ndarray, common: np.ndarray, num: int, den: int) -> tuple[np.ndarray, int]:
    """The prefix of a set, and how much of it counts towards sets of its own
    size or larger. Two sets that share o tokens share k of those in the first
    n - o + k of each; o is at least t times the larger size, and 2 t / (1 + t)
    times the smaller one. So similar sets share k (of the smaller one's size)
    tokens of the larger one's prefix and this first part of the smaller's."""
    n = len(s)
    late, k = hits(common, s), required(n)
    prefix = np.concatenate((s[~late], s[late]))[: n - (num * n + den - 1) // den + k]
    return prefix, n - (2 * num * n + num + den - 1) // (num + den) + k


#: One token more to be shared for so many tokens of a set: with longer
#: prefixes, documents that share a passage only are told from near copies.
STRIDE = 32


def required(n: int) -> int:
    return 1 + n // STRIDE


def postings(docs: DataFrame, size: int, common, num: int, den: int) -> DataFrame:
    """(token, key, s) of each class's prefix, once per task; s is twice the
    size, plus one in the first part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = common.value, set()
        for batch in batches:
            for _, sets, keys in text_sets(batch.column(0), size):
                fresh = [(s, k) for s, k in zip(sets, keys.tolist(), strict=True) if len(s) and not (k in seen or seen.add(k))]
                if fresh:
                    tokens, first = zip(*(prefix_tokens(s, bits, num, den) for s, _ in fresh), strict=True)
                    times = [len(t) for t in tokens]
                    place = np.arange(sum(times)) - np.repeat(np.cumsum(times) - times, times)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(tokens).astype(np.int64)),
                            pa.array(np.repeat([k for _, k in fresh], times)),
                            pa.array((np.repeat([2 * len(s) for s, _ in fresh], times) + (place < np.repeat(first, times))).astype(np.int32)),
                        ],
                        names=["token", "key", "s"],
                    )

    return docs.mapInArrow(run, "token long, key long, s int")


def with_partner(token: np.ndarray, key: np.ndarray, s: np.ndarray, comp: np.ndarray, num: int, den: int) -> np.ndarray:
    """Rows (a class once a group) of whole groups that a class of another
    component can be similar to: sizes within the ratio, the smaller one in
    its first part."""
    rows = np.lexsort((key, s >> 1, token))
    rows = rows[np.concatenate(([True], (token[rows][1:] != token[rows][:-1]) | (key[rows][1:] != key[rows][:-1])))]
    of_group = partners(token[rows], s[rows], num, den)
    order = np.lexsort((s[rows] >> 1, comp[rows], token[rows]))
    part = np.cumsum(np.concatenate(([0], (token[rows][order][1:] != token[rows][order][:-1]) | (comp[rows][order][1:] != comp[rows][order][:-1]))))
    of_comp = np.empty_like(of_group)
    of_comp[:, order] = partners(part, s[rows][order], num, den)
    return rows[(of_group > of_comp).any(axis=0)]


def partners(group: np.ndarray, s: np.ndarray, num: int, den: int) -> np.ndarray:
    """For rows in order of group and size: how many rows of the group (itself
    too) can be the smaller one of a similar pair with it, and the larger."""
    n, first = s.astype(np.int64) >> 1, s & 1
    group = np.cumsum(np.concatenate(([0], group[1:] != group[:-1]))) << 32
    at = group + n
    begin, end = np.searchsorted(at, at, "left"), np.searchsorted(at, at, "right")
    least = np.searchsorted(at, group + (num * n + den - 1) // den, "left")
    most = np.searchsorted(at, group + den * n // num, "right")
    firsts = np.concatenate(([0], np.cumsum(first)))
    return np.stack((firsts[end] - firsts[least], np.where(first > 0, most - begin, 0)))


#: Rows of a group from which it is passed on whole, without that test.
TESTED_ROWS = 2_000_000


def group_ids(token: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For rows in order of token: a hash of the keys of the row's group, equal
    for groups of the same classes."""
    cuts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    sizes = np.diff(np.append(cuts, len(token)))
    sums = np.add.reduceat(mix64(key.view(np.uint64)), cuts)
    return np.repeat(mix64(sums + mix64(sizes.astype(np.uint64))), sizes).astype(np.int64)


def shared_only(rows: DataFrame, num: int, den: int, merge: bool = False) -> DataFrame:
    """Postings (token, key, s, comp) of classes with a possible partner of
    another component in the token's group. ``merge``: the token becomes the
    group's id, so that groups of the same classes can be made one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tested(t: pa.Table) -> pa.RecordBatch:
            columns = [t[c].to_numpy() for c in ("token", "key", "s", "comp")]
            columns = [x[rows] for rows in [with_partner(*columns, num, den)] for x in columns]
            if merge and len(columns[0]):
                columns[0] = group_ids(columns[0], columns[1])
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["token", "key", "s", "comp"])

        held: list[pa.RecordBatch] = []
        n, whole = 0, None  # whole: the group that is being passed on
        for batch in batches:
            token = batch.column(0).to_numpy()
            if whole is not None and len(token):
                same = int(np.searchsorted(token != whole, True))
                if same:
                    yield batch.slice(0, same)
                batch, token = batch.slice(same), token[same:]
                if len(token):
                    whole = None
            if not len(token):
                continue
            held.append(batch)
            n += len(token)
            if n < 200_000:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            token = t["token"].to_numpy()
            cut = int(np.searchsorted(token == token[-1], True)) if token[0] != token[-1] else 0
            if cut:
                yield tested(t.slice(0, cut))
            held, n = t.slice(cut).to_batches(), len(token) - cut
            if n >= TESTED_ROWS:
                yield from held
                held, n, whole = [], 0, token[-1]
        if n:
            yield tested(pa.Table.from_batches(held).combine_chunks())

    ordered = rows.repartition("token").sortWithinPartitions("token").select("token", "key", "s", "comp")
    return ordered.mapInArrow(run, "token long, key long, s int, comp long")


def class_sets(docs: DataFrame, size: int, wanted) -> DataFrame:
    """(key, tokens as bytes) of the classes that ``wanted`` may hold, once
    per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = wanted.value, set()
        for batch in batches:
            for _, sets, keys in text_sets(batch.column(0), size):
                hit = hits(bits, keys)
                out = [(k, s.tobytes()) for s, k, h in zip(sets, keys.tolist(), hit, strict=True) if h and len(s) and not (k in seen or seen.add(k))]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k for k, _ in out], pa.int64()), pa.array([s for _, s in out], pa.binary())], names=["key", "tokens"]
                    )

    return docs.mapInArrow(run, "key long, tokens binary")


def bitmaps(sets: DataFrame) -> DataFrame:
    """(key, n, bits): 4 to 8 bits a token, a power of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, bits = [], []
            for value in batch.column(1):
                tokens = np.frombuffer(value.as_buffer(), np.uint64)
                marks = np.zeros(max(64, 1 << (4 * len(tokens) - 1).bit_length()), dtype=bool)
                marks[(tokens & np.uint64(len(marks) - 1)).astype(np.int64)] = True
                n.append(len(tokens))
                bits.append(np.packbits(marks).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(bits, pa.binary())], names=["key", "n", "bits"])

    return sets.mapInArrow(run, "key long, n long, bits binary").dropDuplicates(["key"])


class SignatureTree:
    """Levels of nodes over bitmaps of one width, sizes ascending; level 0 has
    the sets themselves. A node: bits, smallest and largest size, excess."""

    def __init__(self, bits: np.ndarray, n: np.ndarray):
        bits = np.ascontiguousarray(bits).view(np.uint64)
        excess = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, n, n, excess)]
        while len(self.levels[-1][1]) > FANOUT:
            bits, low, high, excess = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append((
                np.bitwise_or.reduceat(bits, at, axis=0), np.minimum.reduceat(low, at),
                np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at),
            ))


def may_link(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of nodes i of level ``a`` and j of ``b`` can have similar
    sets below, and the most that such can share: sizes within the ratio, and
    room for the overlap in the shared bits plus the smaller excess (tokens of
    a set beyond one a bit)."""
    (bits_a, low_a, high_a, over_a), (bits_b, low_b, high_b, over_b) = a, b
    ok = np.flatnonzero((den * high_a[i] >= num * low_b[j]) & (den * high_b[j] >= num * low_a[i]))
    i, j = i[ok], j[ok]
    most = np.empty(len(i), dtype=np.int64)
    step = max(1, (1 << 20) // bits_a.shape[1])
    for at in range(0, len(i), step):
        x, y = i[at : at + step], j[at : at + step]
        most[at : at + step] = np.bitwise_count(bits_a[x] & bits_b[y]).sum(axis=1, dtype=np.int64)
    most += np.minimum(over_a[i], over_b[j])
    most = np.minimum(most, np.minimum(high_a[i], high_b[j]))
    room = (num + den) * most >= num * (low_a[i] + low_b[j])
    return ok[room], most[room]


def walk(a: SignatureTree, b: SignatureTree, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of sets that no node pair above rules out, and the most that
    each can share."""
    la, lb = len(a.levels) - 1, len(b.levels) - 1
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(a.levels[la][1])), np.arange(len(b.levels[lb][1]))))

    def below(nodes: np.ndarray, other: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        child = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        inside = child < count
        return child[inside], np.repeat(other, FANOUT)[inside]

    while True:
        ok, most = may_link(a.levels[la], b.levels[lb], i, j, num, den)
        i, j = i[ok], j[ok]
        if not la and not lb:
            return i, j, most
        down_a, down_b = la >= lb, lb >= la
        if down_a:
            la -= 1
            i, j = below(i, j, len(a.levels[la][1]))
        if down_b:
            lb -= 1
            j, i = below(j, i, len(b.levels[lb][1]))


def possible(bits: list[np.ndarray], n: np.ndarray, num: int, den: int) -> np.ndarray:
    """For every pair of sets (ascending in size) the most that they can
    share, 0 if trees rule the pair out. There is one tree for each bitmap
    width; neighbouring widths are compared at the smaller one, and similar
    sets are never two widths apart."""
    out = np.zeros((len(n), len(n)), dtype=np.int64)
    widths = np.array([len(b) for b in bits])
    trees = {int(w): np.flatnonzero(widths == w) for w in np.unique(widths)}
    for w, own in trees.items():
        tree = SignatureTree(np.stack([bits[k] for k in own]), n[own])
        i, j, most = walk(tree, tree, num, den)
        out[own[i], own[j]] = most
        if 2 * w in trees:
            wide = trees[2 * w]
            folded = np.stack([bits[k][:w] | bits[k][w:] for k in wide])
            i, j, most = walk(tree, SignatureTree(folded, n[wide]), num, den)
            out[own[i], wide[j]] = out[wide[j], own[i]] = most
    np.fill_diagonal(out, 0)
    return out


def spanning_forest(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a maximum spanning forest over the positive weights."""
    n = len(weight)
    best, source = np.zeros(n), np.full(n, -1)
    todo, edges = np.ones(n, dtype=bool), []
    for _ in range(n):
        at = int(np.argmax(np.where(todo, best, -1)))
        if best[at] > 0:
            edges.append((int(source[at]), at))
        todo[at] = False
        closer = weight[at] > best
        best[closer], source[closer] = weight[at][closer], at
    i, j = zip(*edges, strict=True) if edges else ((), ())
    return np.array(i, np.int64), np.array(j, np.int64)


def candidate_pairs(cells: DataFrame, num: int, den: int, forest: bool) -> DataFrame:
    """(a, b) of classes that meet in a cell and may be similar: all pairs, or
    the likeliest spanning forest of them. Columns: token, x, y (the cell),
    key, comp, side, first, n, bits. In a cell x = y all sets are compared, in
    one x < y those of different sides; equal components never."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["token", "x", "y"]):
            n = t["n"].to_numpy()
            order = np.argsort(n, kind="stable")
            n, key, comp, side, first = n[order], *(t[c].to_numpy()[order] for c in ("key", "comp", "side", "first"))
            apart = comp[:, None] != comp[None, :]
            if t["x"][0].as_py() != t["y"][0].as_py():
                apart &= side[:, None] != side[None, :]
            # the smaller of two sets (either, if equal) has the token in its first part
            of_smaller = np.where(n[:, None] < n[None, :], first[:, None], first[None, :])
            apart &= np.where(n[:, None] == n[None, :], first[:, None] | first[None, :], of_smaller) > 0
            if not apart.any():
                continue
            bits = [np.frombuffer(t["bits"][int(k)].as_buffer(), np.uint8) for k in order]
            most = np.where(apart, possible(bits, n, num, den), 0)
            if forest:
                i, j = spanning_forest(most / (n[:, None] + n[None, :]))
            else:
                i, j = np.nonzero(np.triu(most))
            if len(i):
                a, b = key[i], key[j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    ordered = cells.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y")
    return ordered.select("token", "x", "y", "key", "comp", "side", "first", "n", "bits").mapInArrow(run, "a long, b long").distinct()


def exact_links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose whole sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                keep.append(den * both >= num * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    needed = sets.join(keys, "key", "left_semi").dropDuplicates(["key"])
    one = needed.toDF("a", "x")
    other = needed.toDF("b", "y")
    return pairs.join(one, "a").join(other, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def often_enough(post: DataFrame, num: int, den: int) -> DataFrame:
    """Rows of classes that share as many tokens as the smallest set similar
    to them must."""
    n = F.floor(F.col("s") / 2)
    least = F.lit(1) + F.floor(F.ceil(n * num / den) / STRIDE)
    enough = post.groupBy("key").agg(F.count(F.lit(1)).alias("shared"), F.max("s").alias("s")).where(F.col("shared") >= least)
    return post.join(enough.select("key"), "key", "left_semi")


def distinct_groups(post: DataFrame, num: int, den: int) -> DataFrame:
    """(token, key, s): groups of exactly the same classes become one (the
    tokens that near copies share number hundreds). A class is in its first
    part there if it is so for any of the tokens."""
    return shared_only(post, num, den, merge=True).groupBy("token", "key").agg(F.max("s").alias("s"))


def first_cells(post: DataFrame) -> DataFrame:
    """A few groups of each class, large groups in blocks with two pivots."""
    few = post.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("token"))).where(F.col("r") <= FIRST_GROUPS)
    size = few.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    size = size.where("m > 1").select("token", "lo", "hi", F.ceil(F.col("m") / F.lit(BLOCK)).cast("long").alias("blocks"))
    rows = few.join(size, "token")
    block = F.pmod(F.xxhash64("key", F.lit(5)), F.col("blocks"))
    pivot = (F.col("key") == F.col("lo")) | (F.col("key") == F.col("hi"))
    own = F.when(pivot, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(block))
    rows = rows.select("token", "key", (F.col("s") % 2).alias("first"), F.explode(own).alias("x"))
    return rows.withColumns({"y": F.col("x"), "side": F.lit(0).cast("long"), "comp": F.col("key")})


def all_cells(post: DataFrame) -> DataFrame:
    """Every group with classes of several components (``comp``). A group of
    more than BLOCK rows is dealt to cells: its largest component meets the
    rest, and the rest meet each other, block by block."""
    of_comp = post.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("m"))
    size = of_comp.groupBy("token").agg(
        F.max(F.struct("m", "comp")).alias("top"), F.sum("m").alias("all"), F.count(F.lit(1)).alias("comps")
    )
    major = F.when(F.col("all") > BLOCK, F.col("top.m")).otherwise(0)
    size = size.where("comps > 1").select(
        "token", F.when(F.col("all") > BLOCK, F.col("top.comp")).alias("major"),
        F.ceil(major / F.lit(BLOCK)).cast("long").alias("majors"),
        F.ceil((F.col("all") - major) / F.lit(BLOCK)).cast("long").alias("minors"),
    )
    rows = post.join(size, "token").withColumn("is_major", F.col("comp").eqNullSafe(F.col("major")))
    deal = F.xxhash64("key", F.lit(5))
    rows = rows.withColumn(
        "side", F.when(F.col("is_major"), F.col("minors") + F.pmod(deal, F.col("majors"))).otherwise(F.pmod(deal, F.col("minors")))
    )
    last = F.when(F.col("is_major"), F.col("minors")).otherwise(F.col("minors") + F.col("majors")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return rows.select(
        "token", "key", "comp", (F.col("s") % 2).alias("first"), "side",
        F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"),
    )


def join(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id. Documents link
    when den * |intersection| >= num * |union| of their sets of ``size``-word
    shingles (A-Z lower-cased; fewer words: the whole sequence; no words: an
    empty set, linked with nothing).

    Sets are of 64-bit hashes and classes have 64-bit keys, so an error is
    expected once in 2^65 / (number of classes)^2 runs. Rows of a repeated
    doc_id are documents of their own with that id; the component of one id is
    the smallest over its rows. A null doc_id links like any other but names no
    component unless alone (null). An empty table gives no rows; other columns
    are ignored.
    """
    return linked(docs, size, num, den).select("doc_id", "n_shingles", "component_id")


def linked(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """``join`` with the class key of each row and the component's own key."""
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seen = stage(profile(source, size), "jac-profile")
    members = seen.where("kind = 0").select(F.col("id").alias("doc_id"), "n", "key")
    often = seen.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON).select("key")
    common = spark.sparkContext.broadcast(bit_filter(often))
    texts = source.where("text IS NOT NULL").select("text")
    found = postings(texts, size, common, num, den).withColumn("comp", F.col("key"))
    post = stage(shared_only(found, num, den), "jac-postings")
    post = stage(distinct_groups(often_enough(post, num, den), num, den), "jac-groups")
    wanted = spark.sparkContext.broadcast(bit_filter(post.select("key").distinct()))
    sets = stage(class_sets(texts, size, wanted), "jac-sets")
    bits = stage(bitmaps(sets), "jac-bits")
    pairs = stage(candidate_pairs(first_cells(post).join(bits, "key"), num, den, forest=True), "jac-forest")
    links = stage(exact_links(pairs, sets, num, den), "jac-links")
    label = components(links).select(F.col("node").alias("key"), "component")
    post = post.join(label, "key", "left").withColumn("comp", F.coalesce("component", "key")).drop("component")
    post = stage(shared_only(post, num, den), "jac-labelled")
    cells = all_cells(post).join(bits, "key")
    pairs = stage(candidate_pairs(cells, num, den, forest=False), "jac-pairs")
    more = stage(exact_links(pairs, sets, num, den), "jac-more")
    final = components(links.union(more)).select(F.col("node").alias("key"), "component")
    of_class = members.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"))
    of_class = of_class.join(final, "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = of_class.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = of_class.join(least, "component").select("key", "component", "component_id")
    return members.join(of_class, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "key", "component",
    )


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the smallest
    doc_id; of several rows with that id in the component one stays. Rows of a
    repeated id are judged each by its own text. Rows with a null id and
    documents without words stay."""
    found = stage(linked(docs, size, num, den), "jac-joined")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    if gone.count() <= BROADCAST_IDS:  # texts are not shuffled
        gone = F.broadcast(gone)
    kept = docs.join(gone, F.col("doc_id").cast("long") == F.col("gone_id"), "left_anti")
    repeated = found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("twice_id")).agg(F.count(F.lit(1)).alias("rows"))
    repeated = stage(repeated.where("rows > 1").select("twice_id"), "jac-repeated")
    if repeated.isEmpty():
        return kept
    same = F.col("doc_id").cast("long") == F.col("twice_id")
    return kept.join(repeated, same, "left_anti").unionByName(keep_rows(docs.join(repeated, same, "left_semi"), found, size))


def keep_rows(docs: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """``keep_one`` for the rows ``docs`` of repeated ids, by (doc_id, key)."""
    names, k = docs.columns, len(docs.columns)
    wide = docs.select("*", F.col("text").cast("string"), F.lit(0).cast("long"))
    wide = wide.toDF(*(f"c{i}" for i in range(k)), "text_of", "key")
    fields = wide.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [np.zeros(0, np.int64), *(x for _, _, x in text_sets(batch.column(k), size))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: k + 1], pa.array(np.concatenate(keys))], names=fields)

    stays = found.where("n_shingles = 0 OR doc_id = component_id").select("doc_id", F.col("key").alias("stay_key"), "n_shingles", "component").distinct()
    of = fields[names.index("doc_id")]
    rows = wide.mapInArrow(run, wide.schema).join(stays, [F.col(of).cast("long") == F.col("doc_id"), F.col("key") == F.col("stay_key")])
    words = rows.where("n_shingles > 0").dropDuplicates([of, "component"])
    return rows.where("n_shingles = 0").unionByName(words).select(*fields[:k]).toDF(*names)
