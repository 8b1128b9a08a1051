"""Prefix trie of conversations with subtree totals (operator 11).

Conversations are sequences of turns; every distinct prefix is a node.  A
prefix is named by 128 bits, the XOR of a hash of each turn with its place, so
names come from running sums and a very long conversation is cut into blocks;
that rows of one name have the same parent and the same last turn is checked.

Totals over subtrees come from a centroid decomposition of the parent edges.
A component's centroid is the lowest node through which more than half of the
component's weight runs; the nodes above it are then just those with more than
half as well.  The subtree total of the centroid inside the component is added
to the nodes on the way from the centroid to the component's top, the weight
leaves them, and the component falls apart into the centroid's child subtrees
and the rest above, each with at most half of the weight.  The weight of a node
is the number of conversations that run through it, summed over its subtree:
known from the rows without any rollup.  Spark splits components until they
hold at most ``BLOCK`` nodes; the rest of the recursion runs inside tasks, many
components at a time.

A node's place in a component is known without walking the tree: a node lies
below the centroid if its smallest conversation passes the centroid, which is
one lookup by (conversation, depth).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlens.llm.common import drop_written, ranked, written
from roadlens.plans import bounded_broadcast

#: Nodes of a component that one task may split further; rows of a conversation handled together (a power of two).
BLOCK, TURN_BLOCK_BITS = 4096, 12
#: Turns of the shared opening: below this number, by the conversation's checksum.
SHARED_BELOW = 9
#: Groups that the children of one parent are dealt to in lookups.
SLOTS = 64
ROOT = "0-0"


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its five."""
    return F.crc32(conv_id.cast("string")) % SHARED_BELOW


def _digest(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)


def _block(place: Column) -> Column:
    return F.shiftright(place - 1, TURN_BLOCK_BITS)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, convs)``: ``rows (c, p, t, bytes)`` of the rebuilt
    conversations, ``p`` from 1, and ``convs (c, n)`` with their numbers of
    turns.  ``turns`` is ``(c, turn, t, bytes)``."""
    own = ranked(turns, ["c"], ["turn", "t"], "place").select("c", (F.col("place") + 1).alias("j"), "t", "bytes")
    sizes = own.groupBy("c").agg(F.count(F.lit(1)).alias("len"))
    base = sizes.select(F.col("c").alias("base"), F.col("len").alias("base_len"))
    convs = (sizes.select("c", "len", shared_turns(F.col("c")).alias("h"), (F.col("c") - F.col("c") % 5).alias("base"))
             .join(base, "base", "left")
             .select("c", "len", "h", "base", F.least("h", F.coalesce("base_len", F.lit(0))).alias("m")))
    convs = written(convs.withColumn("n", F.col("m") + F.greatest(F.col("len") - F.col("h"), F.lit(0))), "convs")
    # a long conversation meets its one row of convs in blocks
    blocks = convs.where("len > h").select("c", "h", "m", F.explode(F.sequence(F.lit(0).cast("bigint"), _block(F.col("len")))).alias("b"))
    kept = (own.withColumn("b", _block(F.col("j"))).join(blocks, ["c", "b"]).where("j > h")
            .select("c", (F.col("m") + F.col("j") - F.col("h")).alias("p"), "t", "bytes"))
    opening = own.where(F.col("j") < SHARED_BELOW).select(F.col("c").alias("base"), "j", "t", "bytes")
    taken = convs.where("m > 0").select("c", "base", "m").join(opening, "base").where("j <= m").select("c", F.col("j").alias("p"), "t", "bytes")
    return kept.unionByName(taken), convs


def _named(rows: DataFrame) -> DataFrame:
    """``rows`` with the names ``k`` and ``up`` of the prefix that ends in the
    row and of the one before: running XOR, inside blocks and over them."""
    rows = rows.select("c", "p", "t", "bytes", _block(F.col("p")).alias("b"),
                       *[F.xxhash64(F.lit(i), "p", "t").alias(f"x{i}") for i in (1, 2)])
    inside = Window.partitionBy("c", "b").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"y{i}": F.bit_xor(f"x{i}").over(inside) for i in (1, 2)})
    before = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("c", "b").agg(*[F.bit_xor(f"x{i}").alias(f"s{i}") for i in (1, 2)])
    sums = sums.select("c", "b", *[F.coalesce(F.bit_xor(f"s{i}").over(before), F.lit(0)).alias(f"z{i}") for i in (1, 2)])
    rows = rows.join(sums, ["c", "b"])
    own = [F.col(f"y{i}").bitwiseXOR(F.col(f"z{i}")) for i in (1, 2)]
    name = lambda a, b: F.concat_ws("-", F.hex(a), F.hex(b))
    return rows.select("c", "p", "t", "bytes", name(*own).alias("k"),
                       name(*[own[i].bitwiseXOR(F.col(f"x{i + 1}")) for i in (0, 1)]).alias("up"))


def _ends(rows: DataFrame) -> DataFrame:
    """``(k, ends_sha256)`` of ``rows (c, k)``, the conversations that end in
    a node: their ids in order, joined with commas.  Ids are joined in blocks
    of neighbouring numbers (at most 4096 ids each); a digest is one pass over
    a node's blocks in order, held as a running hash and never as a whole."""
    blocks = (rows.groupBy("k", F.shiftright("c", 12).alias("b")).agg(F.sort_array(F.collect_list("c")).alias("ids"))
              .select("k", "b", F.concat_ws(",", F.transform("ids", lambda x: x.cast("string"))).alias("ids")))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            names, values = [], []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if key is not None:
                        names.append(key), values.append(state.hexdigest())
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.string())], ["k", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["k", "ends_sha256"])

    return (blocks.repartition("k").sortWithinPartitions("k", "b").select("k", "ids")
            .mapInArrow(digests, "k string, ends_sha256 string"))


def split_in_task(comp: np.ndarray, parent: np.ndarray, depth: np.ndarray, weight: np.ndarray,
                  values: np.ndarray) -> np.ndarray:
    """The subtree totals of ``values (node, value)`` inside components, by
    centroid decomposition of all components side by side.  ``parent``: index
    of the parent, or -1 at a component's top; ``weight``: total weight of a
    node's subtree in its component, strictly falling downwards."""
    n = len(comp)
    total, weight, live = np.zeros_like(values), weight.copy(), np.arange(n)
    comp = np.unique(comp, return_inverse=True)[1].astype(np.int64)
    gone = np.zeros(n, np.bool_)
    while len(live):
        c = comp[live]
        whole = np.zeros(n + 1, np.int64)
        np.maximum.at(whole, c, weight[live])
        heavy = live[2 * weight[live] > whole[c]]
        deepest = np.full(n + 1, -1, np.int64)
        order = np.argsort(depth[heavy], kind="stable")
        deepest[comp[heavy][order]] = heavy[order]      # the lowest comes last
        centre = deepest[c]                             # every live node's centroid
        is_centre = np.zeros(n, np.bool_)
        is_centre[centre] = True
        # the top of the part in which a node is left: the centroid, its child, or the old top
        up = parent[live]
        jump = np.arange(n)
        stays = (up >= 0) & ~is_centre[live] & ~is_centre[up] & ~gone[up]
        jump[live] = np.where(stays, up, live)
        while True:
            far = jump[jump]
            if (far == jump).all():
                break
            jump = far
        top = jump[live]
        below = (parent[top] >= 0) & is_centre[parent[top]] & (parent[top] == centre) & (live != centre)
        inner = below | (live == centre)
        part = np.zeros_like(total)
        np.add.at(part, centre[inner], values[live[inner]])
        total[heavy] += part[deepest[comp[heavy]]]
        above = heavy[heavy != deepest[comp[heavy]]]
        weight[above] -= weight[deepest[comp[above]]]
        gone[centre] = True
        comp = comp.copy()
        comp[live] = top
        live = live[live != centre]
    return total


def _split_tasks(pdf: pd.DataFrame) -> pd.DataFrame:
    at = pd.Series(np.arange(len(pdf)), index=pdf["k"])
    comp, _ = pd.factorize(pdf["comp"])
    parent = at.reindex(pdf["up"]).fillna(-1).to_numpy().astype(np.int64)
    parent[(parent >= 0) & (comp[parent] != comp)] = -1
    out = split_in_task(comp, parent, pdf["depth"].to_numpy(), pdf["weight"].to_numpy(np.int64),
                        pdf[["leaf", "saved"]].to_numpy(np.int64))
    return pd.DataFrame({"k": pdf["k"], "n_leaves": out[:, 0] + pdf["leaves_sum"], "saved_sum": out[:, 1] + pdf["saved_sum"]})


def subtree_totals(nodes: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(k, n_leaves, saved_sum)``: sums of ``leaf`` and ``saved`` over the
    subtree of every node of ``nodes (k, up, c, depth, weight, leaf, saved)``.
    ``c`` is a conversation through the node, ``rows (c, p, k)`` are the nodes
    of the conversations by depth, ``weight`` is a subtree's total weight."""
    n_nodes = nodes.count()
    live = nodes.withColumns({"comp": F.lit(ROOT), "leaves_sum": F.lit(0).cast("bigint"), "saved_sum": F.lit(0).cast("bigint")})
    cols, settled, done = live.columns, [], []
    path = rows.select(F.col("c").alias("pc"), F.col("p").alias("pp"), F.col("k").alias("pk"))
    while True:
        big = live.groupBy("comp").agg(F.max("weight").alias("whole"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block)
        big = written(big.select("comp", "whole"), "big")
        n_big = big.count()
        if not n_big:
            settled.append(live)
            break
        big = bounded_broadcast(big, n_big)
        settled.append(live.join(big, "comp", "left_anti"))
        mine = written(live.join(big, "comp"), "component")
        heavy = mine.where(2 * F.col("weight") > F.col("whole"))
        centre = written(heavy.groupBy("comp").agg(F.max(F.struct("depth", "k", "weight")).alias("v"))
                         .select("comp", F.col("v.k").alias("vk"), F.col("v.depth").alias("vd"), F.col("v.weight").alias("vw")), "centroids")
        centre = bounded_broadcast(centre, n_big)
        # which child subtree of the centroid a conversation passes
        slot = _block(F.col("depth") + 1)
        pieces = mine.join(centre, "comp").where("depth > vd").select("comp", "c", slot.alias("slot"), "vk", "vd").distinct()
        here = pieces.join(path, (F.col("c") == F.col("pc")) & (F.col("vd") == F.col("pp"))).where("pk = vk").select("comp", "c", "slot", "vd")
        child = here.join(path, (F.col("c") == F.col("pc")) & (F.col("vd") + 1 == F.col("pp"))).select("comp", "c", "slot", F.col("pk").alias("child"))
        marked = (mine.withColumn("slot", slot).join(centre, "comp").join(child, ["comp", "c", "slot"], "left")
                  .withColumn("child", F.when(F.col("depth") > F.col("vd"), F.col("child"))))
        marked = written(marked.select(*cols, "whole", "vk", "vw", "child"), "marked")
        is_centre = F.col("k") == F.col("vk")
        part = marked.where(F.col("child").isNotNull() | is_centre).groupBy("comp").agg(
            F.sum("leaf").alias("_leaves"), F.sum("saved").alias("_saved"))
        on_path = 2 * F.col("weight") > F.col("whole")
        new = (marked.join(bounded_broadcast(part, n_big), "comp")
               .withColumn("leaves_sum", F.col("leaves_sum") + F.when(on_path, F.col("_leaves")).otherwise(0))
               .withColumn("saved_sum", F.col("saved_sum") + F.when(on_path, F.col("_saved")).otherwise(0))
               .withColumn("weight", F.col("weight") - F.when(on_path & ~is_centre, F.col("vw")).otherwise(0))
               .withColumn("comp", F.coalesce("child", "comp")))
        new = written(new.select(*cols, is_centre.alias("out")), "parts")
        for table in (mine, marked):
            drop_written(table)
        done.append(new.where("out").select("k", F.col("leaves_sum").alias("n_leaves"), "saved_sum"))
        live = new.where("NOT out").drop("out")
    groups = max(1, -(-n_nodes // block))
    rest = settled[0]
    for x in settled[1:]:
        rest = rest.unionByName(x)
    rest = rest.select("k", "up", "depth", "weight", "leaf", "saved", "comp", "leaves_sum", "saved_sum",
                       F.pmod(F.xxhash64("comp"), F.lit(groups)).alias("_group"))
    out = rest.groupBy("_group").applyInPandas(lambda pdf: _split_tasks(pdf), "k string, n_leaves bigint, saved_sum bigint")
    for x in done:
        out = out.unionByName(x)
    return out


def prefix_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``(conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)``, and the node's name ``k``.

    Turns are ordered by ``turn``, null first, equal turns by the digest of
    role and text; null role and text are empty.  Rows without a conversation
    id belong to none and are left out.  Repeated rows are turns of their own;
    texts of any length are read whole; other columns are ignored; an empty
    table has no node."""
    src = conversations.select(F.col(f"`{conv_id}`").cast("bigint").alias("c"), F.col(f"`{turn}`").alias("turn"),
                               *[F.coalesce(F.col(f"`{x}`").cast("string"), F.lit("")).alias(y) for x, y in ((role, "role"), (text, "text"))])
    turns = src.where("c IS NOT NULL").select("c", "turn", _digest(F.col("role"), F.col("text")).alias("t"),
                                              F.octet_length("text").cast("bigint").alias("bytes"))
    rows, convs = rebuilt(turns)
    top = convs.select("c", F.lit(0).cast("bigint").alias("p"), F.lit(None).cast("string").alias("t"), F.lit(0).cast("bigint").alias("bytes"),
                       F.lit(ROOT).alias("k"), F.lit(None).cast("string").alias("up"))
    blocks = convs.select("c", "n", F.explode(F.sequence(F.lit(-1).cast("bigint"), _block(F.col("n")))).alias("b"))
    rows = _named(rows).unionByName(top).withColumn("b", _block(F.col("p")))
    rows = written(rows.join(blocks, ["c", "b"]).select("c", "p", "t", "bytes", "k", "up", "n"), "prefixes")
    # one node a name; a name that stands for two prefixes is an error, not a wrong answer
    same = F.struct("up", "t", "p")
    nodes = rows.groupBy("k").agg(
        F.min("c").alias("c"), F.min(same).alias("lo"), F.max(same).alias("hi"), F.count(F.lit(1)).alias("n_convs"),
        F.max("bytes").alias("bytes"), F.sum(F.col("n") - F.col("p") + 1).alias("weight"))
    clash = F.when(F.col("lo").eqNullSafe(F.col("hi")), F.col("lo.p")).otherwise(F.raise_error(F.lit("two prefixes have one name")).cast("bigint"))
    nodes = written(nodes.select("k", "c", clash.alias("depth"), F.col("lo.up").alias("up"), "n_convs", "weight",
                                 ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
                                 F.pmod(F.xxhash64("k"), F.lit(SLOTS)).alias("slot")), "nodes")
    children = nodes.where("up IS NOT NULL").groupBy(F.col("up").alias("k")).agg(F.count(F.lit(1)).alias("n_children"))
    # a parent with very many children is looked up in SLOTS places
    asked = nodes.where("up IS NOT NULL").select("up", "slot").distinct()
    parents = asked.join(nodes.select(F.col("k").alias("up"), F.col("c").alias("parent_conv_id")), "up")
    nodes = nodes.join(children, "k", "left").join(parents, ["up", "slot"], "left")
    nodes = written(nodes.select("k", "up", "c", "depth", "weight", "saved", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                                 F.col("n_children").isNull().cast("bigint").alias("leaf"), "parent_conv_id"), "tree")
    totals = subtree_totals(nodes.select("k", "up", "c", "depth", "weight", "leaf", "saved"), rows.select("c", "p", "k"), block)
    ends = _ends(rows.where("n = p").select("c", "k"))
    return (nodes.join(totals, "k").join(ends, "k", "left")
            .select(F.col("c").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                    F.col("saved_sum").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "k"))
