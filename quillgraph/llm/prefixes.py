"""Conversation prefix trie: every distinct sequence of first turns once, with who shares it and what sharing it saves.

Conversations are told by digests of their turns. Equal ones are one row with a count before anything else, so a group of copies weighs
as much as one. The rest is dealt by the digest of the first turn; a group of at most GROUP different conversations becomes a trie of pointer dictionaries
in one task, and its figures come from an iterative postorder. A larger group isn't built: its least and greatest conversation tell how many turns all
of it shares, these are nodes of its own, and its conversations are dealt anew by the turn after them. Figures of such nodes are summed
from the nodes below, round by round.

Nulls and ties: a null role or text counts as empty, a null turn comes first, turns of one number follow the order of their digests, and rows that
repeat are turns that repeat. Rows without conv_id belong to no conversation and give none. A conversation without turns left is a member of
the root alone. An empty table has no nodes. Texts count whole; a conversation's turns stand together in one row with about 30 bytes
each, whatever their texts' lengths. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, word_count

#: Different conversations of a group that one task builds; groups dealt to one task at a time have about BUCKET together. Bytes of a digest.
GROUP, BUCKET, DIGEST = 128, 256, 16
#: Conversation ids of one piece of a list.
PIECE = 2048
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NONE = hashlib.sha256(b"").hexdigest()


def _digest(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, DIGEST)


def turns(rows: DataFrame) -> DataFrame:
    """conv_id, turns: (digest, words) of each turn in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = rows.where("conv_id IS NOT NULL").select("conv_id", F.struct("turn", _digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("digest"), word_count(text).alias("words")).alias("t"))
    listed = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return told.groupBy("conv_id").agg(listed.alias("turns"))


def rebuilt(convs: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """Each conversation begins with the first h turns of its family's first one, conv_id - conv_id % family, in place of its own first h; h: its id's checksum mod heads."""
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    first = convs.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("first"), F.slice("turns", 1, heads - 1).alias("head"))
    met = convs.join(first, F.col("conv_id") - F.col("conv_id") % family == F.col("first"), "left")
    none = F.array().cast("array<struct<digest:binary,words:bigint>>")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return met.select("conv_id", F.concat(F.coalesce(F.slice("head", 1, h), none), own).alias("turns"))


def _pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one sequence, as they lie, to joined texts of at most PIECE ids."""
    for b in parts:
        keys, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
        out: list[tuple] = []
        start = 0
        for i in range(1, len(ids) + 1):
            if i == len(ids) or keys[i] != keys[start] or i - start == PIECE:
                out.append((keys[start], ids[start], i - start, ",".join(map(str, ids[start:i]))))
                start = i
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)] if out else [pa.array([], t) for t in (pa.binary(), pa.int64(), pa.int64(), pa.string())], names=["seq", "least", "n", "ids"])


def _hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to one row for each sequence: a digest takes in the pieces one by one, none is kept."""
    types = (pa.binary(), pa.int64(), pa.int64(), pa.string())
    now: list | None = None

    def told(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] if k < 3 else r[3].hexdigest() for r in rows], t) for k, t in enumerate(types)], names=["seq", "least", "n", "ends"])

    for b in parts:
        done = []
        for seq, least, n, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now and now[0] == seq:
                now[2] += n
                now[3].update(b"," + ids.encode())
            else:
                if now:
                    done.append(now)
                now = [seq, least, n, hashlib.sha256(ids.encode())]
        if done:
            yield told(done)
    if now:
        yield told([now])


def classes(convs: DataFrame) -> DataFrame:
    """Different sequences: digests and words from depth 0 on (the root, textless), n conversations, the least of them, and the digest of their ids in order."""
    held = durable(convs.select("conv_id", F.transform("turns", lambda t: t["digest"]).alias("digests"), F.transform("turns", lambda t: t["words"]).alias("words")).withColumn("seq", _digest(F.lit("seq").cast("binary"), F.array_join(F.transform("digests", F.hex), "").cast("binary"))))
    lists = held.select("seq", "conv_id").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id").mapInArrow(_pieces, "seq binary, least long, n long, ids string")
    ends = lists.repartition("seq").sortWithinPartitions("seq", "least").mapInArrow(_hashed, "seq binary, least long, n long, ends string")
    # one conversation of each sequence brings its turns, so copies of long ones aren't shuffled
    one = ends.join(held.select(F.col("conv_id").alias("least"), "digests", "words"), "least")
    root = lambda c, zero: F.concat(F.array(zero), c)
    return one.select("n", "least", "ends", root("digests", F.lit("root").cast("binary")).alias("digests"), root("words", F.lit(0).cast("long")).alias("words"))


# -- groups that one task builds -------------------------------------------------------------------------------------------------


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    """Tries of a bucket: key (a group's), over (the node above), depth (of the group's first node) and the classes to nodes, with top: the group's first node."""
    out = []
    for key, group in rows.groupby("key", sort=False):
        depth = int(group["depth"].iloc[0])
        below: list[dict[bytes, int]] = []
        least, count, words, end, level, kids = [], [], [], [], [], []

        def make(up: int | None, at: int, w: int) -> int:
            below.append({})
            kids.append([])
            least.append(None)
            count.append(0)
            words.append(w)
            end.append(_NONE)
            level.append(at)
            if up is not None:
                kids[up].append(len(below) - 1)
            return len(below) - 1

        top = None
        for n, low, ends, digests, said in zip(group["n"], group["least"], group["ends"], group["digests"], group["words"], strict=True):
            here = None
            for at in range(depth, len(digests)):
                if here is None:
                    to = top = make(None, at, said[at]) if top is None else top
                elif (to := below[here].get(digests[at])) is None:
                    to = below[here][digests[at]] = make(here, at, said[at])
                here = to
                count[here] += n
                least[here] = low if least[here] is None else min(least[here], low)
            end[here] = ends
        leaves, saved = [0] * len(below), [0] * len(below)
        stack, over = [(top, False)], group["over"].iloc[0]
        parent = {top: over}
        while stack:  # a node comes twice: before the nodes below it and after them
            here, seen = stack.pop()
            if not seen:
                stack.append((here, True))
                for k in kids[here]:
                    parent[k] = least[here]
                    stack.append((k, False))
                continue
            leaves[here] = sum(leaves[k] for k in kids[here]) if kids[here] else 1
            saved[here] = (count[here] - 1) * words[here] + sum(saved[k] for k in kids[here])
            out.append((least[here], level[here], parent[here], count[here], len(kids[here]), leaves[here], saved[here], end[here], here == top, group["above"].iloc[0]))
    return pd.DataFrame(out, columns=["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "top", "above"])


# -- rounds ----------------------------------------------------------------------------------------------------------------------


def _next(key: Column, depth: Column) -> Column:
    """The group that a conversation falls into: its way so far and its turn at this depth."""
    return _digest(key, F.element_at("digests", depth + 1))


def trie(convs: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations (conv_id, turns): a row for each, its least member first."""
    told = durable(classes(convs))
    zero = F.lit(0).cast("long")
    # the root is split always: its groups are the first turns
    first = told.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max(F.when(F.size("digests") == 1, F.col("ends"))).alias("ends")).where("rows > 0")
    large = durable(first.select(F.lit(b"").alias("key"), F.lit(None).cast("binary").alias("above"), F.lit(None).cast("long").alias("over"), zero.alias("depth"), zero.alias("last"), "n", "least", "ends", F.array(zero).alias("chain")))
    if (root := large.select("least").first()) is None:
        return told.sparkSession.createDataFrame([], _NODE)
    uppers, built = [large], []
    open_ = told.where(F.size("digests") > 1).select(_next(F.lit(b""), F.lit(1)).alias("key"), F.lit(b"").alias("above"), F.lit(root.least).cast("long").alias("over"), F.lit(1).cast("long").alias("depth"), "n", "least", "ends", "digests", "words")
    while True:
        groups = open_.groupBy("key").agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("n").alias("n"),
            F.min("least").alias("least"),
            F.min(F.struct("digests", "words", "ends")).alias("low"),
            F.max("digests").alias("high"),
            F.first("above").alias("above"),
            F.first("over").alias("over"),
            F.first("depth").alias("depth"),
        )
        # what the first and the last of a group share, all of it does; one that ends where they part is the first
        low, size = F.col("low.digests"), F.size("low.digests")
        parts = F.array_position(F.zip_with(low, F.col("high"), lambda a, b: ~a.eqNullSafe(b)), True)
        last = (F.when(parts > 0, parts - 1).otherwise(size) - 1).cast("long")
        large = durable(
            groups.where(F.col("rows") > GROUP)
            .withColumn("last", last)
            .select("key", "above", "over", "depth", "last", "n", "least", F.when(size == F.col("last") + 1, F.col("low.ends")).alias("ends"), F.slice("low.words", F.col("depth").cast("int") + 1, (F.col("last") - F.col("depth") + 1).cast("int")).alias("chain"))
        )
        some = not large.isEmpty()
        split = large.select(F.col("key").alias("_key"), "last", F.col("least").alias("_least"))
        met = durable(open_.join(split, F.col("key") == F.col("_key"), "left")) if some else open_.withColumn("_key", F.lit(None).cast("binary"))
        small = met.where("_key IS NULL")
        dealt = small.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(max(1, small.count() // BUCKET))))
        nodes = dealt.select("bucket", "key", "above", "over", "depth", "n", "least", "ends", "digests", "words").groupBy("bucket").applyInPandas(_build, f"{_NODE}, top boolean, above binary")
        built.append(durable(nodes))
        if not some:
            break
        uppers.append(large)
        on = met.where(F.col("_key").isNotNull() & (F.size("digests") > F.col("last") + 1))
        at = (F.col("last") + 1).cast("int")
        open_ = on.select(_next(F.col("key"), at).alias("key"), F.col("_key").alias("above"), F.col("_least").alias("over"), (F.col("last") + 1).alias("depth"), "n", "least", "ends", "digests", "words")
    return reduce(DataFrame.unionByName, [b.drop("top", "above") for b in built] + _upper_nodes(uppers, built))


def _upper_nodes(uppers: list[DataFrame], built: list[DataFrame]) -> list[DataFrame]:
    """Nodes of the groups that were split, from the last round up: what is below is summed by the group above."""
    out: list[DataFrame] = []
    tops = None
    figures = lambda df: df.where("top").select("above", "n_leaves", "saved_tokens")
    for upper, groups in zip(reversed(uppers), reversed(built), strict=True):
        below = figures(groups) if tops is None else figures(groups).unionByName(tops)
        sums = below.groupBy(F.col("above").alias("_key")).agg(F.count(F.lit(1)).alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        met = upper.join(sums, F.col("key") == F.col("_key"), "left").withColumns({"kids": F.coalesce("kids", F.lit(0)), "leaves": F.coalesce("leaves", F.lit(1)), "saved": F.coalesce("saved", F.lit(0))})
        each = met.select("*", F.posexplode("chain").alias("i", "own"))
        below_here = F.aggregate(F.slice("chain", F.col("i") + 1, F.size("chain")), F.lit(0).cast("long"), lambda s, w: s + w)
        at_last = F.col("depth") + F.col("i") == F.col("last")
        nodes = durable(
            each.select(
                F.col("least").alias("conv_id"),
                (F.col("depth") + F.col("i")).alias("depth"),
                F.when(F.col("i") == 0, F.col("over")).otherwise(F.col("least")).alias("parent_conv_id"),
                F.col("n").alias("n_convs"),
                F.when(at_last, F.col("kids")).otherwise(1).cast("long").alias("n_children"),
                F.col("leaves").alias("n_leaves"),
                ((F.col("n") - 1) * below_here + F.col("saved")).alias("saved_tokens"),
                F.when(at_last, F.coalesce("ends", F.lit(_NONE))).otherwise(F.lit(_NONE)).alias("ends_sha256"),
                (F.col("i") == 0).alias("top"),
                "above",
            )
        )
        tops = figures(nodes)
        out.append(nodes.drop("top", "above"))
    return out
