"""Strongly connected components: nodes that lead to each other by edges of any number.

Nodes without a way in or out are trimmed, and chains of nodes with one way in and one way out become a single edge, as often as that takes off a share of the
edges: what is like a tree or a chain goes in rounds that halve it, however long it is. In what is left every node learns the least label of all that lead to it (its forward colour) and of all it leads to
(its backward colour). Labels are ordered by hash, and a node also takes what the node of its label has learnt, so ways double in length from round to
round instead of growing by one. Where both colours agree, their node is on a circle with all that have it: a component. An edge between other
colours joins no component and is dropped; the rest goes on in a further round. No path is ever listed: a node is one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stored import Rounds

#: Times that nodes without a way in or out are taken off in each round; those that are left are told by their colours.
TRIMS = 2
#: Chains are drawn together again if that and trimming have left no more than this share of the edges.
DRAWN = 0.9


def _label(node: str) -> Column:
    return F.struct(F.xxhash64(node).alias("h"), F.col(node).alias("id"))


def _trimmed(live: DataFrame) -> DataFrame:
    for _ in range(TRIMS):
        entered, left = live.select(F.col("dst").alias("src")).distinct(), live.select(F.col("src").alias("dst")).distinct()
        live = live.join(entered, "src", "left_semi").join(left, "dst", "left_semi").select("src", "dst")
    return live


def _chains(rounds: Rounds, edges: DataFrame) -> DataFrame | None:
    """node, before, after, first, least, ring of the nodes with one way in and one way out: the nodes at which their chain begins and ends, which aren't among
    them, and whether the node is the chain's first one; a ring is all such nodes, and least the one that stands for it. None if there are no such nodes.

    Every node asks the farthest nodes it knows in both directions for the farthest they know, so a chain takes as many rounds as its length has binary digits.
    """
    out = edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("n_out"), F.min("dst").alias("after"))
    in_ = edges.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("n_in"), F.min("src").alias("before"))
    inner = out.where("n_out = 1").join(in_.where("n_in = 1"), "node")
    now, asked = rounds.put_told(inner.select("node", "before", "after", F.lit(None).cast("boolean").alias("first"), _label("node").alias("least")), F.count(F.lit(1)).alias("n"))
    if not asked or not asked["n"]:
        return None
    while True:
        far = lambda c, *more: now.select(F.col("node").alias(f"_{c}"), F.col(c).alias(f"far_{c}"), *more)
        met = now.join(far("after", F.col("least").alias("far_least")), F.col("after") == F.col("_after"), "left").join(far("before"), F.col("before") == F.col("_before"), "left")
        asks = F.col("_after").isNotNull().cast("int") + F.col("_before").isNotNull().cast("int")
        told = met.select("node", F.coalesce("far_before", "before").alias("before"), F.coalesce("far_after", "after").alias("after"), F.coalesce("first", F.col("_before").isNull()).alias("first"), F.least("least", F.coalesce("far_least", "least")).alias("least"), (asks == 2).alias("ring"), asks.alias("asks"))
        seen = asked
        now, asked = rounds.put_told(told, F.sum("asks").alias("n"), F.sum(F.col("least.h").cast("decimal(38,0)")).alias("least"))
        if not asked["n"] or asked == seen:  # chains come to their ends one after the other: what asks as before has none
            return now.drop("asks")


def _colours(rounds: Rounds, edges: DataFrame) -> DataFrame:
    """node, f, b: of all nodes that lead to it, and of all it leads to, itself included, the one with the least label."""
    now = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct().select("node", _label("node").alias("f"), _label("node").alias("b"))
    none, seen = F.lit(None).cast(now.schema["f"].dataType), None
    now = rounds.put(now)
    while True:
        said = lambda at, to, f, b: edges.join(now.select(F.col("node").alias(at), "f", "b"), at).select(F.col(to).alias("node"), f.alias("f"), b.alias("b"))
        told = said("src", "dst", F.col("f"), none).unionByName(said("dst", "src", none, F.col("b"))).groupBy("node").agg(F.min("f").alias("tf"), F.min("b").alias("tb"))
        hop = now.join(told, "node", "left").select("node", F.least("f", F.coalesce("tf", "f")).alias("f"), F.least("b", F.coalesce("tb", "b")).alias("b"))
        # what a node's label has learnt in the round before holds for the node as well
        far = lambda c: now.select(F.col("node").alias(f"_{c}"), F.col(c).alias(f"far_{c}"))
        met = hop.join(far("f"), F.col("f.id") == F.col("_f")).join(far("b"), F.col("b.id") == F.col("_b"))
        sums = [F.sum(F.col(f"{c}.h").cast("decimal(38,0)")).alias(c) for c in ("f", "b")]
        now, state = rounds.put_told(met.select("node", F.least("f", "far_f").alias("f"), F.least("b", "far_b").alias("b")), *sums)
        if state == seen:  # labels only fall: equal sums are equal labels
            return now.select("node", F.col("f.id").alias("f"), F.col("b.id").alias("b"))
        seen = state


def _between(chains: DataFrame, members: DataFrame) -> DataFrame:
    """node, root of the chains' nodes whose ends are of one component."""
    end = lambda c: members.select(F.col("node").alias(c), F.col("root").alias(f"_{c}"))
    met = chains.join(end("before"), "before", "left").join(end("after"), "after", "left").select("node", F.coalesce("_before", "before").alias("_before"), F.coalesce("_after", "after").alias("_after"))
    return met.where("_before = _after").select("node", F.col("_before").alias("root"))


def strong_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes (node) with component, the least node of its component, size, and circular: a way leads from the node back to it.

    An edge whose end isn't among nodes, or is null, still joins components; only nodes are told.
    """
    with Rounds(edges.sparkSession) as rounds:
        all_ = rounds.put(edges.where("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst").distinct())
        live, found, drawn, n = all_.where("src <> dst"), [], [], None
        while True:
            live, told = rounds.put_told(_trimmed(live), F.count(F.lit(1)).alias("n"))
            if not told or not told["n"]:
                break
            if n is None or told["n"] <= DRAWN * n:
                n = told["n"]
                if chains := _chains(rounds, live):
                    found.append(chains.where("ring").select("node", F.col("least.id").alias("root")))
                    drawn.append(chains.where("NOT ring").select("node", "before", "after"))
                    inner = chains.select("node")
                    rest = live.join(inner.toDF("src"), "src", "left_anti").join(inner.toDF("dst"), "dst", "left_anti").select("src", "dst")
                    live = rest.unionByName(chains.where("first AND NOT ring AND before <> after").select(F.col("before").alias("src"), F.col("after").alias("dst"))).distinct()
                    continue
            n = None
            colours = _colours(rounds, live)
            found.append(colours.where("f = b").select("node", F.col("f").alias("root")))
            open_ = colours.where("f <> b")
            end = lambda c: open_.select(F.col("node").alias(c), F.struct("f", "b").alias(f"_{c}"))
            live = live.join(end("src"), "src").join(end("dst"), "dst").where("_src = _dst").select("src", "dst")
        # the last chains first: a chain is part of a component if both its ends are
        members = reduce(DataFrame.unionByName, found) if found else None
        for chains in reversed(drawn):
            roots = chains.select("node", F.col("before").alias("root")).where("before = after") if members is None else _between(chains, members)
            members = rounds.put(roots if members is None else members.unionByName(roots))
        loops = all_.where("src = dst").select(F.col("src").alias("node"), F.lit(True).alias("loop"))
        told = nodes.select("node").distinct().join(loops, "node", "left")
        if members is not None:
            members = members.unionByName(members.select(F.col("root").alias("node"), "root")).distinct()  # ends that only their chain leads back to
            sizes = members.groupBy("root").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("size"))
            told = told.join(members.join(sizes, "root").drop("root"), "node", "left")
        else:
            told = told.withColumns({"component": F.lit(None).cast(nodes.schema["node"].dataType), "size": F.lit(None).cast("long")})
        size = F.coalesce("size", F.lit(1)).cast("long")
        return rounds.keep(told.select("node", F.coalesce("component", "node").alias("component"), size.alias("size"), ((size > 1) | F.coalesce("loop", F.lit(False))).alias("circular")))
