"""Top k of the cosine similarities of all co-rating pairs without a shuffle of the pairs.

A user's similarities are sums over its items, and the pairs are many more than
the ratings. Here users are dealt to blocks, and what travels is, for each block
that rated an item, the item's list of raters (16 bytes a rater). All products of a
user are then made in its block: sums by pair and the best of each user end in
the same task, and neither is shuffled or written. A block holds about
``BLOCK_PRODUCTS`` products, so the number of blocks grows with the work and the
memory of a task does not.

The list of an item of more than ``CELL_ROWS`` raters is cut into slices, each
built and dealt by a task of its own.

``coarse_topk`` sends weights in lists as one byte. A pair's sum is then known within
an error that is known too; the pairs that may be among a user's best ``k`` are
few, and their exact weights are looked up."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knnrec.functions.columns import SIM_DIGITS, snap
from knnrec.operators.item_profile import item_counts, item_profile
from knnrec.operators.similarity import BROADCAST_KEYS, CELL_ROWS, hot_key_blocks
from knnrec.session import materialize

#: Products made in one block, on the average.
BLOCK_PRODUCTS = 500_000
#: Blocks dealt to one task, on the average.
BLOCKS_A_TASK = 4
#: Products a task adds up at once.
HELD_PRODUCTS = 2_000_000
#: Entries of lists that a task makes, on the average. What it reads is a small part of
#: that, so their number is not left to the size of the ratings.
LISTED_ENTRIES = 4_000_000
#: Steps of a weight (within -1 and 1) in coarse lists.
COARSE_STEPS = 127


def block_count(products: int) -> int:
    """Blocks for that many unordered pairs of ratings (each is made from both sides)."""
    return max(1, -(-2 * products // BLOCK_PRODUCTS))


def list_tasks(unit: DataFrame, products: int) -> int:
    """Tasks that make the lists for that many unordered pairs of ratings."""
    return max(unit.sparkSession.sparkContext.defaultParallelism, -(-2 * products // LISTED_ENTRIES))


def sliced(unit: DataFrame, keys: Sequence[str], largest: int | None, block_rows: int) -> DataFrame:
    """``unit`` with ``_nb``, the number of slices of its key."""
    if largest is not None and largest <= block_rows:
        return unit.withColumn("_nb", F.lit(1))
    hot = materialize(hot_key_blocks([unit], keys, block_rows))
    n_hot = hot.count()
    if not n_hot:
        return unit.withColumn("_nb", F.lit(1))
    hot = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
    return unit.join(hot, list(keys), "left").withColumn("_nb", F.coalesce("_nb", F.lit(1)))


def id_type(unit: DataFrame) -> str:
    """Lists hold ids as INT where all of them fit."""
    least, most = unit.agg(F.min("u"), F.max("u")).first()
    return "int" if least is None or (least >= -(2 ** 31) and most < 2 ** 31) else "long"


def id_bytes(unit: DataFrame) -> dict[str, Column]:
    """``byte0, ...``: the bytes of an id (less 128 each), as many as the ids need."""
    least, most = unit.agg(F.min("u"), F.max("u")).first()
    count = 8 if least is not None and least < 0 else max(1, -(-(most or 0).bit_length() // 8))
    return {f"byte{j}": (F.shiftright("u", 8 * j).bitwiseAND(F.lit(255)) - 128).cast("byte") for j in range(count)}


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    """The ids of lists that hold their bytes."""
    names = [c for c in batch.schema.names if c.startswith("byte")]
    ids = np.zeros(len(batch.column(names[0]).flatten()), np.uint64)
    for c in names:
        ids |= (batch.column(c).flatten().to_numpy().astype(np.int64) + 128).astype(np.uint64) << np.uint64(8 * int(c[4:-3]))
    return ids.view(np.int64)


def rater_lists(unit: DataFrame, products: int, largest: int | None = None, block_rows: int = CELL_ROWS,
                blocks: int | None = None, keys: Sequence[str] = ("i",), carry: Sequence[str] = (),
                half: bool = False, ids: str | None = None, own: Sequence[str] = (), asked: str | None = None,
                coarse: bool = False) -> DataFrame:
    """``(keys but i..., u, w, carry..., own..., vs, w_vs, carry_vs...)``: every rating with
    the raters of its key (one row a slice), all rows of a user in one task, in the
    order of users. ``half``: raters that no user of the row precedes are left out.
    ``ids``: the type of ids in lists where that is known (see ``id_type``). ``own``
    columns are not listed of raters. ``asked``: a BOOLEAN column; other ratings are
    listed but get no row. ``coarse``: instead of ``vs`` and ``w_vs`` the lists are those of
    ``id_bytes`` and ``step_vs``, the nearest of ``COARSE_STEPS`` steps; rows have ``i``."""
    blocks = block_count(products) if blocks is None else blocks
    others = [k for k in keys if coarse or k != "i"]
    facts, own = ["u", "w", *carry], list(own)
    flag = [asked] if asked else []
    known = unit.select(*keys, *facts, *own, *flag).where("i IS NOT NULL AND u IS NOT NULL AND w IS NOT NULL")  # others add to no sum
    tasks = list_tasks(unit, products)
    ids = "long" if coarse else id_type(known) if ids is None else ids
    if coarse:
        steps = {**id_bytes(known), "step": F.round(F.col("w") * COARSE_STEPS).cast("byte")}
        listed = {**{f"{c}_vs": c for c in steps}, **{f"{c}_vs": c for c in carry}}
    else:
        steps, listed = {}, {"vs": "u", **{f"{c}_vs": c for c in facts[1:]}}
    lists = [F.col(f"r.{c}").alias(name) for name, c in listed.items()]
    block = F.pmod(F.hash("u"), F.lit(blocks)).alias("block")
    if largest is not None and largest <= block_rows:
        # no slices: both lists of a key come from one shuffle of the ratings
        rows = known.select(*keys, F.col("u").cast(ids).alias("u"), "w", *carry, *own, *flag).repartition(tasks, *keys)
        rows = rows.select("*", block, *(c.alias(name) for name, c in steps.items())).groupBy(*keys, "block").agg(
            F.collect_list(F.struct(*facts, *steps, *own, *flag)).alias("mine"))
        whole = F.flatten(F.collect_list("mine").over(Window.partitionBy(*keys)))
        rows = rows.withColumn("r", whole)
        if asked:
            rows = rows.withColumn("mine", F.filter("mine", lambda x: x[asked])).where(F.size("mine") > 0)
        if steps:
            rows = rows.withColumn("mine", F.transform("mine", lambda x: F.struct(*(x[c].alias(c) for c in (*facts, *own)))))
        return _dealt(rows, others, [*facts, *own], list(listed), lists, blocks, half)
    rated, cell = sliced(known, keys, largest, block_rows), [*keys, "slice"]
    raters = rated.select(*keys, F.pmod(F.xxhash64("u"), F.col("_nb")).cast("int").alias("slice"),
                          F.col("u").cast(ids).alias("u"), "w", *carry).repartition(tasks, *cell)
    raters = raters.select("*", *(c.alias(name) for name, c in steps.items())).groupBy(*cell).agg(
        F.collect_list(F.struct(*facts, *steps)).alias("r"))
    mine = rated.where(asked) if asked else rated
    mine = mine.select(*keys, F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("slice"), block, *facts, *own)
    mine = mine.repartition(tasks, *cell).groupBy(*cell, "block").agg(F.collect_list(F.struct(*facts, *own)).alias("mine"))
    return _dealt(mine.join(raters, cell), others, [*facts, *own], list(listed), lists, blocks, half)


def _dealt(met: DataFrame, others: Sequence[str], facts: Sequence[str], listed: Sequence[str], lists: Sequence[Column],
           blocks: int, half: bool) -> DataFrame:
    """Rows ``(block, mine, r)`` where their blocks are summed, one row a rating."""
    if half:
        met = met.withColumn("least", F.array_min("mine.u")).withColumn(
            "r", F.filter("r", lambda x: x["u"] > F.col("least"))).where(F.size("r") > 0)
    met = met.select("block", *others, "mine", *lists)
    dealt = met.repartition(max(1, blocks // BLOCKS_A_TASK), "block")
    rows = dealt.select(F.explode("mine").alias("m"), *others, *listed)
    mine = [F.col("m.u").cast("long").alias("u"), *(f"m.{c}" for c in facts[1:])]
    return rows.select(*others, *mine, *listed).sortWithinPartitions("u")


def _changes(*columns) -> np.ndarray:
    """Places where one of the sorted ``columns`` is another than before."""
    n = len(columns[0])
    new = reduce(np.logical_or, (c[1:] != c[:-1] for c in columns))
    return np.flatnonzero(np.concatenate([[True], new])) if n else np.zeros(0, np.int64)


def _sums(u, v, x, part=None, *more):
    """Sums of ``x`` by (u, v, part), in that order; ``more`` follows from u and v."""
    order = np.lexsort((v, u) if part is None else (part, v, u))
    u, v, x, part = u[order], v[order], x[order], None if part is None else part[order]
    first = _changes(u, v) if part is None else _changes(u, v, part)
    x = np.add.reduceat(x, first) if len(u) else x
    return u[first], v[first], x, None if part is None else part[first], *(c[order[first]] for c in more)


def _once(u, v, x, part=None, *more):
    """Of pairs that met in several parts, the sum of the lowest."""
    if part is None:
        return u, v, x, *more
    first = _changes(u, v)
    return u[first], v[first], x[first], *(c[first] for c in more)


def _user_sums(batches: Iterable[pa.RecordBatch], carry: Sequence[str] = (), half: bool = False,
               once: bool = True, own: Sequence[str] = ()) -> Iterator[tuple]:
    """``(u, v, sum, carry..., carry of v..., own...)`` arrays of whole users. Rows come by
    user, so what is held is some ``HELD_PRODUCTS`` products, or the partners of
    one user. With a column ``part`` a pair's sum is that of the lowest part it met in;
    not ``once``: ``(u, v, sum, part, ...)`` of every part it met in."""
    held, size = [], 0
    whole = _once if once else lambda *sums: sums

    def joined():
        return _sums(*(None if held[0][c] is None else np.concatenate([part[c] for part in held]) for c in range(len(held[0]))))

    for batch in batches:
        us, ws = batch.column("u").to_numpy(), batch.column("w").to_numpy()
        lengths = batch.column("vs").value_lengths().to_numpy()
        vs, w_vs = batch.column("vs").flatten().to_numpy().astype(np.int64), batch.column("w_vs").flatten().to_numpy()
        parts = batch.column("part").to_numpy() if "part" in batch.schema.names else None
        mine = [batch.column(c).to_numpy() for c in carry]
        theirs = [batch.column(f"{c}_vs").flatten().to_numpy() for c in carry]
        alone = [batch.column(c).to_numpy() for c in own]
        ends = np.cumsum(lengths)
        at = 0
        while at < len(us):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + HELD_PRODUCTS, "right")))
            spread = lambda c: np.repeat(c[at:to], lengths[at:to])  # noqa: B023, E731
            u, v = spread(us), vs[done:ends[to - 1]]
            other = u < v if half else u != v
            held.append((u[other], v[other], (spread(ws) * w_vs[done:ends[to - 1]])[other],
                         None if parts is None else spread(parts)[other],
                         *(spread(c)[other] for c in mine), *(c[done:ends[to - 1]][other] for c in theirs),
                         *(spread(c)[other] for c in alone)))
            size += len(held[-1][0])
            if size > HELD_PRODUCTS:
                sums = joined()
                cut = int(np.searchsorted(sums[0], us[to - 1]))  # the last user may go on
                if cut:
                    yield whole(*(None if c is None else c[:cut] for c in sums))
                held, size = [tuple(None if c is None else c[cut:] for c in sums)], 0
            at = to
    if held:
        yield whole(*joined())


def _snapped(x, digits: int):
    """``functions.columns.snap`` of an array."""
    scale = float(10 ** digits)
    scaled = np.abs(x) * scale
    return np.where(scaled < 2.0 ** 53, np.sign(x) * np.floor(scaled + 0.5) / scale, x)


def _places(u, part, v, sim):
    """The order by user, part, falling similarity (NaN is the largest in Spark) and
    partner; in that order, each row's place in its (user, part) and the rows of that."""
    order = np.lexsort((v, np.where(np.isnan(sim), -np.inf, -sim), part, u))
    first = _changes(u[order], part[order])
    count = np.diff(np.append(first, len(u)))
    return order, np.arange(1, len(u) + 1) - np.repeat(first, count), np.repeat(count, count)


def _coarse_best(digits: int, k: int):
    """Per task, from coarse lists: ``(u, v, i, w)`` of every rating (i, w) that u shares
    with a partner v whose sum may be a positive one of u's best ``k``."""
    def chosen(u, v, x, w, i, row):
        order = np.lexsort((v, u))
        u, v, x, w, i, row = (c[order] for c in (u, v, x, w, i, row))
        first = _changes(u, v)
        count = np.diff(np.append(first, len(u)))
        sums, off = np.add.reduceat(x, first), np.add.reduceat(np.abs(w), first) * (0.5 + 1e-6) / COARSE_STEPS
        users, least, most = u[first], sums - off, sums + off
        by, place, n = _places(users, np.zeros(len(users), np.int64), v[first], least)
        threshold = np.full(len(users), -np.inf)
        kth = place == k
        threshold[np.flatnonzero(kth)] = least[by][kth]
        starts = _changes(users)
        threshold = np.repeat(np.maximum.reduceat(threshold, starts), np.diff(np.append(starts, len(users))))
        may = (most > 0) & (most >= threshold - 2.0 / 10 ** digits)  # they are ranked as rounded sums
        kept = np.repeat(may, count)
        once = np.concatenate([[True], (row[1:] != row[:-1]) | (v[1:] != v[:-1])])  # a partner listed twice
        kept &= once
        return pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (u, v, i, w)], ["u", "v", "i", "w"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, rows = [], 0, 0
        for batch in batches:
            us, ws, items = (batch.column(c).to_numpy() for c in ("u", "w", "i"))
            lengths = batch.column("step_vs").value_lengths().to_numpy()
            vs, steps = _ids(batch), batch.column("step_vs").flatten().to_numpy()
            ends, at = np.cumsum(lengths), 0
            while at < len(us):
                done = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + HELD_PRODUCTS, "right")))
                spread = lambda c: np.repeat(c[at:to], lengths[at:to])  # noqa: B023, E731
                u, v, w = spread(us), vs[done:ends[to - 1]], spread(ws)
                other = u != v
                part = (u, v, w * steps[done:ends[to - 1]] / COARSE_STEPS, w, spread(items), spread(np.arange(rows, rows + len(us))))
                held.append(tuple(c[other] for c in part))
                size += len(held[-1][0])
                if size > HELD_PRODUCTS:
                    whole = [np.concatenate(c) for c in zip(*held)]
                    cut = int(np.searchsorted(whole[0], us[to - 1]))  # the last user may go on
                    if cut:
                        yield chosen(*(c[:cut] for c in whole))
                    held, size = [tuple(c[cut:] for c in whole)], 0
                at = to
            rows += len(us)
        whole = [np.concatenate(c) for c in zip(*held)] if held else [[]]
        if len(whole[0]):
            yield chosen(*whole)
    return run


def _best(digits: int, k: int, group: Sequence[str] = ("u",)):
    """Per task: the ``k`` best nonzero similarities of each user (``group``: in each
    part), their places and the number of all."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u, v, x, part in _user_sums(batches, once=False):
            sim = _snapped(x, digits)
            some = sim != 0
            u, v, sim = u[some], v[some], sim[some]
            part = np.zeros(len(u), np.int64) if part is None else part[some]
            order, place, count = _places(u, part, v, sim)
            best = place <= k
            columns = {"u": u[order], "part": part[order], "v": v[order], "sim": sim[order], "place": place, "cnt": count}
            names = [*group, "v", "sim", "place", "cnt"]
            yield pa.RecordBatch.from_arrays([pa.array(columns[c][best]) for c in names], names)
    return run


def _near(digits: int, k: int, every: bool):
    """Per task, by the column ``least`` of a user: where it is minus infinity as ``_best``
    (``every``: all nonzero ones), else all sums that are not below it, as they are, at
    place 0."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u, v, x, _, least in _user_sums(batches, once=False, own=("least",)):
            whole = np.isneginf(least)
            sim = np.where(whole, _snapped(x, digits), x)
            some = np.where(whole, sim != 0, ~(x < least))
            u, v, sim, whole = u[some], v[some], sim[some], whole[some]
            order, place, count = _places(u, np.zeros(len(u), np.int64), v, sim)
            u, v, sim, whole = u[order], v[order], sim[order], whole[order]
            kept = ~whole | (place <= k) | every
            columns = [u, v, sim, np.where(whole, place, 0), count]
            yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in columns], ["u", "v", "sim", "place", "cnt"])
    return run


def slots(best: DataFrame, k: int, n_users: Column | int, group: Sequence[str] = ("u",)) -> DataFrame:
    """``(group..., v, sim, rank)`` from places and the number of all nonzero ones: a
    positive's slot is its place; before a negative come all zeros of the dense row."""
    n = n_users if isinstance(n_users, Column) else F.lit(n_users)
    slot = F.when(F.col("sim") > 0, F.col("place")).otherwise(F.col("place") + n - 1 - F.col("cnt"))
    return best.select(*group, "v", "sim", slot.cast("long").alias("rank")).where(F.col("rank") <= k)


def best_partners(unit: DataFrame, k: int, products: int, largest: int | None = None, digits: int = SIM_DIGITS,
                  keys: Sequence[str] = ("i",), **blocking) -> DataFrame:
    """``(u, v, sim, place, cnt)``: the ``k`` best nonzero similarities of every user,
    their places and the number of all, in the tasks that make them. With keys
    ``(part, i)`` of each user in each of its parts."""
    group = [*(c for c in keys if c != "i"), "u"]
    return rater_lists(unit, products, largest, keys=keys, **blocking).mapInArrow(
        _best(digits, k, group), ", ".join([*(f"{c} long" for c in group), "v long, sim double, place long, cnt long"]))


def near_partners(unit: DataFrame, k: int, products: int, largest: int | None = None, digits: int = SIM_DIGITS,
                  every: bool = False, **blocking) -> DataFrame:
    """``(u, v, sim, place, cnt)`` of the products of ratings that are ``asked`` for: as
    ``best_partners`` where the user's ``least`` is minus infinity (``every``: all nonzero
    similarities), else the sums that are not below it, at place 0."""
    return rater_lists(unit, products, largest, own=("least",), asked="asked", **blocking).mapInArrow(
        _near(digits, k, every), "u long, v long, sim double, place long, cnt long")


def block_topk(unit: DataFrame, k: int, n_users: Column | int, products: int, largest: int | None = None,
               digits: int = SIM_DIGITS, keys: Sequence[str] = ("i",), **blocking) -> DataFrame:
    """``(u, v, sim, rank)``: ``neighbors.slot_topk`` of the similarities of every
    user to everyone, in the tasks that make them. ``products`` is the number of
    products of unordered pairs, ``largest`` the most raters of an item if known. With keys ``(part, i)``: ``(part, u, v, sim, rank)``,
    each user's list in each of its parts."""
    if k < 1:
        raise ValueError("k must be >= 1")
    group = [*(c for c in keys if c != "i"), "u"]
    return slots(best_partners(unit, k, products, largest, digits, keys, **blocking), k, n_users, group)


def coarse_fits(unit: DataFrame, k: int, n_users: int, most_ratings: int, largest: int) -> bool:
    """Whether ``coarse_topk`` gives the lists of ``block_topk``: every user leaves at
    least ``k`` others that it shares no item with, so that no negative similarity has a
    slot, and no weight is beyond 1."""
    if most_ratings * max(0, largest - 1) >= n_users - k:
        return False
    most = unit.agg(F.max(F.abs("w"))).first()[0]
    return most is None or most <= 1 + 1e-9  # NaN is not


def coarse_topk(unit: DataFrame, k: int, products: int, largest: int | None = None, digits: int = SIM_DIGITS,
                **blocking) -> DataFrame:
    """``(u, v, sim, rank)``: ``block_topk`` where ``coarse_fits``. The pairs that may be
    among the best come with the ratings they share; only these meet the weights
    again, and a user's sums end in one task."""
    if k < 1:
        raise ValueError("k must be >= 1")
    lists = rater_lists(unit, products, largest, coarse=True, **blocking)
    may = lists.mapInArrow(_coarse_best(digits, k), "u long, v long, i long, w double")
    weights = unit.groupBy(F.col("u").alias("v"), "i").agg(F.sum("w").alias("w_v"))
    met = may.join(weights, ["v", "i"]).select("u", "v", (F.col("w") * F.col("w_v")).alias("x")).repartition("u")
    sims = met.groupBy("u", "v").agg(snap(F.sum("x"), digits).alias("sim")).where("sim > 0")
    order = Window.partitionBy("u").orderBy(F.col("sim").desc(), "v")
    return sims.select("u", "v", "sim", F.row_number().over(order).cast("long").alias("rank")).where(F.col("rank") <= k)


#: Rows handed on at once.
BATCH_ROWS = 200_000


def block_similarities(unit: DataFrame, products: int, largest: int | None = None, digits: int = SIM_DIGITS,
                       keys: Sequence[str] = ("i",), carry: Sequence[str] = (),
                       add: tuple[str, Callable] | None = None, half: bool = False, **blocking) -> DataFrame:
    """``(u, v, sim, carry..., carry_v...)``: every nonzero similarity in both
    directions, each user's in the task that makes them; ``half``: those with
    u < v alone, which needs half the lists. ``carry`` columns are LONG
    functions of the user. With keys ``(part, i)`` pairs meet in parts; a sum is
    taken in the lowest. ``add``: name and maker of a LONG column from the carried
    ones (two lists of arrays); rows where it is 0 are left out."""
    both = [*carry, *(f"{c}_v" for c in carry)]
    names = ["u", "v", "sim", *both, *([add[0]] if add else [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u, v, x, *more in _user_sums(batches, carry, half):
            for at in range(0, len(u), BATCH_ROWS):
                own = slice(at, at + BATCH_ROWS)
                columns = [u[own], v[own], _snapped(x[own], digits), *(c[own] for c in more)]
                some = columns[2] != 0
                if add:
                    columns.append(add[1](columns[3:3 + len(carry)], columns[3 + len(carry):]))
                    some &= columns[-1] != 0
                yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in columns], names)

    schema = ", ".join(f"{c} {'double' if c == 'sim' else 'long'}" for c in names)
    return rater_lists(unit, products, largest, keys=keys, carry=carry, half=half, **blocking).mapInArrow(run, schema)


def all_similarities(unit: DataFrame, half: bool = False, digits: int = SIM_DIGITS, **blocking) -> DataFrame:
    """``similarity.mirror(similarity_half(unit))`` (``half``: ``similarity_half(unit)``)
    without a shuffle of the pairs."""
    profile = item_profile(item_counts(unit))
    return block_similarities(unit, profile.total, profile.largest, digits, half=half, **blocking)


def turned(half: DataFrame) -> DataFrame:
    """Both directions of each row ``(u, v, sim)``, made where the row is: ``half`` is
    made once, not once for each direction."""
    ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    return half.select(F.explode(ways).alias("x"), "sim").select("x.u", "x.v", "sim")
