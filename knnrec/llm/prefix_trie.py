"""Prefix trie of conversations, rolled up by centroid decomposition.

Every conversation c is rebuilt: the first h turns of the conversation that
opens its block of ``FAMILY`` ids, then its own turns after its first h. A node
of the trie is a distinct sequence of first turns. Its name is the exclusive or
of 128-bit hashes of (position, turn), so a conversation's nodes are running
sums, made in blocks of turns and put together afterwards: a conversation of
any length is spread over tasks. Turns are ranked by a range-partitioned sort
for the same reason. Texts stay in the first scan; only digests are shuffled.

``forest.subtree_totals`` sums leaves and saved tokens over subtrees; the rows
of a conversation are the paths it needs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knnrec.llm.common import hot_join, prepare, stage, task_id
from knnrec.llm.forest import NODE, PARENT, subtree_totals

FAMILY = 20
#: Components of at most this weight (turns of all members) end in one task.
LOCAL = 50_000
#: Turns of a conversation that one window holds; ids joined in one string.
BLOCK_BITS, ID_BITS = 10, 12


def borrowed(conv: Column) -> Column:
    """h: how many first turns come from the block's first conversation."""
    return (F.crc32(conv.cast("string").cast("binary")) % F.lit(4)).cast("long")


def ranked_turns(conversations: DataFrame) -> DataFrame:
    """conv, part, at (place among the conversation's turns in its part),
    digest, words: parts are runs of the order by conversation, turn, digest."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = ["conv", "turn", "digest", "tie"]
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen, part = None, 0, task_id()
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            starts = np.concatenate(([0], np.flatnonzero(conv[1:] != conv[:-1]) + 1))
            sizes = np.diff(np.append(starts, len(conv)))
            at = np.arange(len(conv)) - np.repeat(starts, sizes)
            if conv[0] == last:
                at[: sizes[0]] += seen
            last, seen = conv[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(conv), part)), pa.array(at), batch.column(1), batch.column(2)],
                names=["conv", "part", "at", "digest", "words"],
            )

    made = ordered.select("conv", "digest", "words").mapInArrow(run, "conv long, part long, at long, digest binary, words long")
    return stage(made, "trie-turns")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths): conv, i (from 0), digest, words of the rebuilt
    conversations; conv, len of all of them, turnless ones included."""
    turns = ranked_turns(conversations)
    spans = stage(turns.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n")), "trie-spans")
    own = Window.partitionBy("conv")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(own).alias("n")
    )
    sizes = stage(spans, "trie-offsets")
    lens = sizes.groupBy("conv").agg(F.max("n").alias("n"))
    convs = lens.select("conv", "n", borrowed(F.col("conv")).alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    bases = lens.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    m = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = stage(convs.join(bases, "base", "left").select("conv", "base", "n", "h", m.alias("m")), "trie-convs")
    placed = turns.join(sizes.drop("n"), ["conv", "part"]).withColumn("p", F.col("first") + F.col("at"))
    placed = stage(placed.select("conv", "p", "digest", "words"), "trie-placed")
    heads = placed.where("p < 3").withColumnRenamed("conv", "base")
    lent = convs.join(heads, "base").where("p < m").select("conv", F.col("p").alias("i"), "digest", "words")
    kept = hot_join(placed, convs.select("conv", "h", "m"), ["conv"]).where("p >= h")
    kept = kept.select("conv", (F.col("p") - F.col("h") + F.col("m")).alias("i"), "digest", "words")
    lengths = convs.select("conv", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"))
    return lent.unionByName(kept), lengths


def member_rows(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(routes, lengths). routes: conv, d, node (a, b), parent (pa, pb), words
    of the last turn; one row per rebuilt conversation and depth, 0 included."""
    turns, lengths = rebuilt(conversations)
    lengths = stage(lengths, "trie-lengths")
    turns = turns.withColumn("block", F.shiftright("i", BLOCK_BITS))
    hashed = turns.select("conv", "block", "i", "words", *(F.xxhash64("digest", "i", F.lit(k)).alias(x) for k, x in enumerate(NODE)))
    order = Window.partitionBy("conv", "block").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = stage(hashed.select("*", *(F.bit_xor(x).over(order).alias("r" + x) for x in NODE)), "trie-running")
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = running.groupBy("conv", "block").agg(*(F.bit_xor(x).alias(x) for x in NODE))
    offsets = ends.select("conv", "block", *(F.bit_xor(x).over(earlier).alias("o" + x) for x in NODE)).where("block > 0")
    full = running.join(offsets, ["conv", "block"], "left")
    names = [F.col("r" + x).bitwiseXOR(F.coalesce("o" + x, F.lit(0))).alias(x) for x in NODE]
    parents = [F.col("r" + x).bitwiseXOR(F.coalesce("o" + x, F.lit(0))).bitwiseXOR(F.col(x)).alias("p" + x) for x in NODE]
    rows = full.select("conv", (F.col("i") + 1).alias("d"), *names, *parents, "words")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = lengths.select("conv", zero.alias("d"), zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), zero.alias("words"))
    return stage(rows.unionByName(roots), "trie-routes"), lengths


def digest_ids(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of ``ends`` (a, b, conv). Ids are joined in blocks of
    at most 2^ID_BITS anywhere; a task only streams these strings, in order,
    through the digest, which no two tasks could share."""
    blocks = ends.groupBy(*NODE, F.shiftright("conv", ID_BITS).alias("block")).agg(F.array_sort(F.collect_list("conv")).alias("ids"))
    text = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    ordered = blocks.select(*NODE, "block", text.alias("ids")).repartition(*NODE).sortWithinPartitions(*NODE, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out: list[tuple] = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids")), strict=True):
                if (a, b) != node:
                    if state:
                        out.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["a", "b", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_pydict({"a": [node[0]], "b": [node[1]], "ends_sha256": [state.hexdigest()]})

    return ordered.mapInArrow(run, "a long, b long, ends_sha256 string")


def trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id (the
    parent's conv_id; root: null), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    Turns are ordered by turn (null first), ties by a digest of role and text,
    so repeated rows are turns of their own. Null roles and texts count as ''.
    Rows without conv_id belong to no conversation. The remainder of a negative
    id has its sign, so the block of -7 opens with 0. An empty table gives no
    rows; other columns are ignored. Two different sequences share a name with
    probability 2^-128.
    """
    prepare(conversations.sparkSession)
    routes, lengths = member_rows(conversations)
    weighed = hot_join(routes, lengths, ["conv"])
    nodes = weighed.groupBy(*NODE).agg(
        F.min("conv").alias("u"), F.min("d").alias("d"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
        F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.sum(F.col("len") - F.col("d") + 1).alias("wt"),
    )
    nodes = stage(nodes, "trie-nodes")
    children = nodes.where("pa IS NOT NULL").groupBy(*PARENT).agg(F.count(F.lit(1)).alias("n_children"))
    children = children.select(F.col("pa").alias("a"), F.col("pb").alias("b"), "n_children")
    nodes = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stage(
        nodes.select(
            "*", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        ),
        "trie-full",
    )
    measures = ["n_leaves", "saved_tokens"]
    zero = F.lit(0).cast("long")
    start = nodes.select(*NODE, *PARENT, "u", "d", "wt", *measures, zero.alias("ca"), zero.alias("cb"))
    totals = subtree_totals(start, routes.drop("words"), measures, local)
    last = lengths.select("conv", F.col("len").alias("d"))
    ends = digest_ids(routes.join(last, ["conv", "d"]).select(*NODE, "conv"))
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("u").alias("parent_conv_id"))
    whole = hot_join(nodes.drop(*measures), parents, PARENT, "left").join(totals, NODE).join(ends, NODE, "left")
    return whole.select(
        F.col("u").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", *measures,
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
