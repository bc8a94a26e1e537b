"""Mixing sources to target weights by hash-random order and exact token budgets.

Every document gets a hash-random key. A source's documents stand in key order; a budget takes whole passes over the source
(epochs) and then the prefix that fills the rest, cut at the exact word. Keys are uniform, so their leading bits are
range partitions of equal size: word counts are summed by (source, range), prefix sums over those few rows find the one
range where the cut falls, and only that range of each source is put in order. No source is ever sorted or gathered whole.

Nulls, empties: a null text has size 0; null is a source of its own, after the others. Rows with one doc_id and size share a
key and rank among themselves in any order, which leaves the result the same up to which of the equal rows is cut. An
empty table, or one without words, has targets of 0. Of a text, of any length, only the number of words counts. Reruns agree: keys depend on doc_id and the seed alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, free, word_count

#: Rows of one (source, range) cell aimed at; only a cell at a cut is sorted.
CELL_ROWS = 2000


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target) for each source.

    Sources in order of code points, null last, weigh `weights` in turn and share all words. A target stops at `most` times
    its source's size; the excess is shared again by weight until none is above: sources that fill up are those with the
    least size for their weight, so one pass in that order finds the share at which the rest holds. Only the table of
    sources is put in order here.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.encode("source", "UTF-8").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    ranked = by.select("source", "source_size", w.alias("w")).withColumn("cap", most * F.col("source_size"))
    fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.encode("source", "UTF-8").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    told = ranked.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("left_w"),
    ).withColumn("full", F.col("cap") * F.col("left_w") <= F.col("left") * F.col("w"))
    # the first source in this order that does not fill up sets the share for it and all after it
    share = F.first(F.when(~F.col("full"), F.col("left").cast("double") / F.col("left_w")), ignorenulls=True).over(everything)
    return told.select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share * F.col("w")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 1) -> DataFrame:
    """(doc_id, size, source_size, target, taken): taken is the words of the document in the mix, repeats counted."""
    sized = durable(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")).alias("key")))
    n = sized.count()
    bits = max(0, min(30, (n // CELL_ROWS).bit_length()))
    keyed = sized.withColumn("cell", F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("bigint"))
    unsigned = F.col("key").bitwiseXOR(F.lit(-(2**63)))  # signed order of this is the unsigned order of key
    goals = targets(sized, weights, most)
    budget = goals.select(F.col("source").alias("s"), "source_size", "target", F.floor(F.col("target") + 0.5).alias("budget")).select(
        "*", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint").alias("epochs")
    ).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
    cells = keyed.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    run = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    upto = cells.withColumn("upto", F.sum("cell_size").over(run))
    met = upto.join(budget, upto["source"].eqNullSafe(budget["s"])).where(F.col("upto") > F.col("rest"))
    cut = met.groupBy("s").agg(F.min("cell").alias("cut"), F.min(F.col("upto") - F.when(F.col("upto") > F.col("rest"), F.col("cell_size"))).alias("before"))
    plan = durable(budget.join(cut.withColumnRenamed("s", "s2"), F.col("s").eqNullSafe(F.col("s2")), "left").select("s", "source_size", "target", "epochs", "rest", F.coalesce("cut", F.lit(2**62)).alias("cut"), F.coalesce("before", F.lit(0)).cast("bigint").alias("before")))
    few = plan.count() <= 10_000
    rows = keyed.join(F.broadcast(plan) if few else plan, keyed["source"].eqNullSafe(plan["s"]))
    full = lambda more: (F.col("epochs") * F.col("size") + more).alias("taken")
    out = lambda df, more: df.select("doc_id", "source", "size", "source_size", "target", full(more))
    away = rows.where(F.col("cell") != F.col("cut"))
    at = rows.where(F.col("cell") == F.col("cut"))
    line = Window.partitionBy("source", "cell").orderBy(unsigned, F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, 0)
    at = at.withColumn("upto", F.col("before") + F.sum("size").over(line))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("upto") + F.col("size")))
    return out(away, F.when(F.col("cell") < F.col("cut"), F.col("size")).otherwise(F.lit(0))).unionByName(out(at, part))


def materialise(docs: DataFrame, taken: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, the one at its source's cut with its first words only.

    taken: doc_id, size, taken of mix(). Rows of docs that share a doc_id and a size share the words that mix() gave them, each as many, but for a
    remainder of less than a word each. A document without words is in the mix once, as it costs nothing. Columns may have any names.
    """
    own, told, size, took, cut = free(docs, "own", "told", "size", "took", "cut")
    by = taken.groupBy("doc_id", "size").agg(F.floor(F.sum("taken") / F.count(F.lit(1))).cast("bigint").alias("taken"))
    # a table by itself, so that the join can split an id that very many rows have
    t = durable(by.groupBy(F.col("doc_id").alias(own)).agg(F.map_from_entries(F.collect_list(F.struct("size", "taken"))).alias(told)))
    met = docs.join(t, docs["doc_id"].eqNullSafe(t[own]))
    # a row's size is counted anew only where rows with its id have several
    met = met.withColumn(size, F.when(F.size(told) == 1, F.get(F.map_keys(told), F.lit(0))).otherwise(word_count(F.col("text"))))
    met = met.withColumn(took, F.element_at(told, F.col(size)))
    whole = F.when(F.col(size) > 0, F.floor(F.col(took) / F.col(size))).otherwise(F.lit(1)).cast("int")
    rest = F.when(F.col(size) > 0, F.col(took) % F.col(size)).otherwise(F.lit(0)).cast("int")
    copies = F.concat(F.when(whole > 0, F.array_repeat(F.lit(-1), whole)).otherwise(F.array().cast("array<int>")), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    rows = met.withColumn(cut, F.explode(copies))
    words = F.array_join(F.slice(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""), 1, F.greatest(F.col(cut), F.lit(1))), " ")
    text = F.when(F.col(cut) < 0, F.col("text")).otherwise(words)
    chars = F.when(F.col(cut) < 0, F.col("n_chars")).otherwise(F.length(text)) if "n_chars" in docs.columns else None
    return rows.select(*[text.alias(c) if c == "text" else chars.cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])
