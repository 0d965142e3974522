"""Subtree totals of a forest by centroid decomposition.

A component is a connected piece of the forest; its top is the node nearest the
root. Its centroid is the deepest node whose subtree holds more than half of
its weight, so without it no piece has more than half. The centroid's total in
its component is final there, and is added to every node on the path from the
centroid to the top; then the piece above and the subtrees of the centroid's
children are components of their own. Every node becomes a centroid once, and
its subtree total is that total plus all that was added to it. A path of any
length is settled in about log2(weight) rounds.

``split_large`` does this in Spark for components above ``local`` weight, all of
them at once per round; ``split_small`` finishes each smaller component in the
task that holds it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knnrec.llm.common import hot_join, stage

NODE, PARENT, COMP = ["a", "b"], ["pa", "pb"], ["ca", "cb"]
#: Rows handed to a task's Python code at once, whole components.
CHUNK = 50_000


def segment(depth: Column) -> Column:
    """Paths are met in segments, so no route is one join key."""
    return F.shiftright(depth, 10)


def split_component(nodes: list[int], parent: list[int], values: list[list[int]], out: list[list[int]]) -> None:
    """Adds the subtree totals of ``values`` (one list per measure) to ``out``.
    ``nodes`` are indexes sorted by depth, the top first; ``parent`` of a node
    other than the top is in ``nodes``."""
    measures = range(len(values))
    size, below = {}, {}
    todo = [nodes]
    while todo:
        part = todo.pop()
        if len(part) == 1:
            for m in measures:
                out[m][part[0]] += values[m][part[0]]
            continue
        for i in part:
            size[i] = 1
        for i in reversed(part[1:]):
            size[parent[i]] += size[i]
        centroid = part[0]
        for i in part:  # the heavy nodes are one path: the last is the deepest
            if 2 * size[i] > len(part):
                centroid = i
        above, pieces, total = [], {}, [values[m][centroid] for m in measures]
        for i in part:
            if i == centroid:
                below[i] = None
                continue
            up = parent[i]
            if i != part[0] and up == centroid:
                below[i] = i
            else:
                below[i] = below[up] if i != part[0] else None
            if below[i] is None:
                above.append(i)
            else:
                pieces.setdefault(below[i], []).append(i)
                for m in measures:
                    total[m] += values[m][i]
        at = centroid
        while True:  # the centroid, then its path to the top
            for m in measures:
                out[m][at] += total[m]
            if at == part[0]:
                break
            at = parent[at]
        todo += [above] if above else []
        todo += pieces.values()


def split_small(nodes: DataFrame, measures: list[str]) -> DataFrame:
    """(a, b, measures): totals of the small components, one task each."""
    ordered = nodes.select(*COMP, "d", *NODE, *PARENT, *measures).repartition(*COMP).sortWithinPartitions(*COMP, "d")

    def solve(t: pa.Table) -> pa.RecordBatch:
        col = {c: t[c].to_pylist() for c in t.column_names}
        names = list(zip(col["a"], col["b"], strict=True))
        index = {name: i for i, name in enumerate(names)}
        parent = [index.get(p, -1) for p in zip(col["pa"], col["pb"], strict=True)]
        values = [col[m] for m in measures]
        out = [[0] * len(names) for _ in measures]
        comps = list(zip(col["ca"], col["cb"], strict=True))
        lo = 0
        for hi in range(1, len(comps) + 1):
            if hi == len(comps) or comps[hi] != comps[lo]:
                split_component(list(range(lo, hi)), parent, values, out)
                lo = hi
        made = {"a": col["a"], "b": col["b"], **dict(zip(measures, out, strict=True))}
        return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in made.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows < CHUNK:
                continue
            ca, cb = held["ca"].to_pylist(), held["cb"].to_pylist()
            cut = len(ca) - 1
            while cut and (ca[cut - 1], cb[cut - 1]) == (ca[-1], cb[-1]):
                cut -= 1
            if cut:  # the last component may go on
                yield solve(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None:
            yield solve(held)

    return ordered.mapInArrow(run, "a long, b long, " + ", ".join(f"{m} long" for m in measures))


def split_large(nodes: DataFrame, routes: DataFrame, measures: list[str], local: int) -> tuple[DataFrame, list[DataFrame]]:
    """(nodes of the small components, totals to add): rounds until no
    component has more than ``local`` weight. ``routes`` (conv, d, a, b, pa, pb)
    holds for every node its whole path from the root, as the rows of route
    ``u`` up to its depth ``d``; ``wt`` is the weight of a node's subtree."""
    here = stage(nodes, "forest-0")
    ways = routes.withColumn("seg", segment(F.col("d")))
    small: list[DataFrame] = []
    adds: list[DataFrame] = []
    while True:
        totals = here.groupBy(*COMP).agg(F.max("wt").alias("total")).where(F.col("total") > local)
        totals = stage(totals, "forest-large")
        if totals.isEmpty():
            return reduce(DataFrame.unionByName, small, here), adds
        marked = stage(hot_join(here, totals, COMP, "left"), "forest-marked")
        small.append(marked.where("total IS NULL").drop("total"))
        large = marked.where("total IS NOT NULL")
        heaviest = F.min_by(F.struct(*NODE, "u", "d", "wt"), F.when(F.expr("2 * wt > total"), F.col("wt")))
        top_depth = F.min("d")
        cuts = large.groupBy(*COMP).agg(heaviest.alias("c"), top_depth.alias("top_d"))
        cuts = cuts.select(
            *COMP, "top_d", F.col("c.u").alias("cu"), F.col("c.d").alias("cd"), F.col("c.a").alias("xa"),
            F.col("c.b").alias("xb"), F.col("c.wt").alias("less"),
        )
        cuts = stage(cuts, "forest-centroids")
        # for each route of a component, the child of the centroid it goes through
        met = hot_join(stage(large.select("u", *COMP).distinct(), "forest-routes"), cuts.drop("top_d", "less"), COMP)
        child = routes.select(
            F.col("conv").alias("u"), (F.col("d") - 1).alias("cd"), F.col("pa").alias("xa"), F.col("pb").alias("xb"),
            F.col("a").alias("ra"), F.col("b").alias("rb"),
        )
        steps = stage(met.drop("cu").join(child, ["u", "cd", "xa", "xb"], "left"), "forest-steps")
        moved = hot_join(large, steps, ["u", *COMP])
        moved = moved.withColumn("is_cut", (F.col("a") == F.col("xa")) & (F.col("b") == F.col("xb")))
        moved = stage(moved.withColumn("under", F.col("ra").isNotNull() & (F.col("d") > F.col("cd"))), "forest-moved")
        # totals of the centroids in their components go up to the tops
        gained = moved.where("under OR is_cut").groupBy(*COMP).agg(*(F.sum(m).alias(m) for m in measures))
        paths = cuts.join(gained, COMP).withColumnRenamed("cu", "conv")
        paths = paths.withColumn("seg", F.explode(F.sequence(segment(F.col("top_d")), segment(F.col("cd")))))
        up = ways.join(paths.drop("xa", "xb", *COMP), ["conv", "seg"]).where("d <= cd AND d >= top_d")
        up = stage(up.select(*NODE, "less", *measures), "forest-adds")
        adds.append(up.drop("less"))
        kept = moved.where("NOT is_cut").join(up.select(*NODE, "less"), NODE, "left")
        here = kept.select(
            *NODE, *PARENT, "u", "d", (F.col("wt") - F.coalesce("less", F.lit(0))).alias("wt"), *measures,
            *(F.when(F.col("under"), F.col("r" + x)).otherwise(F.col("c" + x)).alias("c" + x) for x in "ab"),
        )
        here = stage(here, "forest-next")


def subtree_totals(nodes: DataFrame, routes: DataFrame, measures: list[str], local: int) -> DataFrame:
    """(a, b, measures): sums of ``measures`` over the subtree of every node."""
    small, adds = split_large(nodes, routes, measures, local)
    parts = reduce(DataFrame.unionByName, adds, split_small(small, measures))
    return parts.groupBy(*NODE).agg(*(F.sum(m).alias(m) for m in measures))
