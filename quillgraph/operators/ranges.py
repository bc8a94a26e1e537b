"""Which of many ranges holds a number first: by a sweep of range ends to disjoint segments, and a look-up that is one sort.

The different ends of ranges, numbered in order, cut the numbers into segments: each end itself, and what lies between it and the next. A range is a run
of segments. Any run is put together from at most two aligned blocks of 1, 2, 4, ... segments each, so a range is told to few blocks however wide it
is, a block keeps the first range told to it, and a segment takes the first of the blocks that it lies in. Then numbers and segments are sorted as one, and each
number takes the last segment at or before it. No range meets a number in between, and no join has anything but equal keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stored import Rounds

_EARLIER = (Window.unboundedPreceding, -1)


def _sorted(rounds: Rounds, df: DataFrame, *order: str) -> DataFrame:
    """df in range partitions with _id, which rises in this order, and _part, the partition."""
    held = rounds.put(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    return held.withColumn("_part", F.shiftright("_id", 33))


def numbered(rounds: Rounds, df: DataFrame, *order: str) -> DataFrame:
    """df with pos: 0, 1, 2, ... in this order. Only a row for each partition meets in one task."""
    held = _sorted(rounds, df, *order)
    sizes = held.groupBy("_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("m"))
    before = sizes.select("_part", "_first", F.coalesce(F.sum("m").over(Window.orderBy("_part").rowsBetween(*_EARLIER)), F.lit(0)).alias("_before"))
    return held.join(before, "_part").select(*df.columns, (F.col("_before") + F.col("_id") - F.col("_first")).alias("pos"))


def last_mark(rounds: Rounds, df: DataFrame, mark: str, *order: str) -> DataFrame:
    """df with `mark` of the last row at or before each in this order that has one; of a partition without any before, the last of those before it."""
    held = _sorted(rounds, df, *order)
    ends = held.groupBy("_part").agg(F.max_by(mark, F.when(F.col(mark).isNotNull(), F.col("_id"))).alias("_last"))
    carried = ends.select("_part", F.last("_last", ignorenulls=True).over(Window.orderBy("_part").rowsBetween(*_EARLIER)).alias("_carried"))
    own = F.last(mark, ignorenulls=True).over(Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0))
    return held.withColumn(mark, own).join(carried, "_part").select(*[F.coalesce(mark, "_carried").alias(mark) if c == mark else F.col(c) for c in df.columns])


def segments(rounds: Rounds, spans: DataFrame) -> DataFrame:
    """spans (low, high, place, name; both ends belong to a range) to v, after, name: from the number v on, itself with after = 0 or what follows it with after =
    2, `name` is that of the range with the least place, null where there is none."""
    plain = lambda c: (F.col(c).cast("double") + F.lit(0.0)).alias(c)  # noqa: E731  one zero
    some = rounds.put(spans.select(plain("low"), plain("high"), "place", "name").where("NOT isnan(low) AND NOT isnan(high) AND low <= high"))
    ends = numbered(rounds, some.select(F.explode(F.array("low", "high")).alias("v")).distinct(), "v")
    ends = rounds.put(ends)
    end = lambda c: ends.select(F.col("v").alias(c), (2 * F.col("pos")).alias(f"at_{c}"))
    runs = some.join(end("low"), "low").join(end("high"), "high")
    top = max(1, (2 * (ends.agg(F.max("pos")).first()[0] or 0) + 2).bit_length())
    block = runs.select("place", "name", "at_low", "at_high", F.explode(F.sequence(F.lit(0), F.lit(top))).alias("k"))
    first, stop = F.expr("shiftright(at_low + shiftleft(1L, k) - 1, k)"), F.expr("shiftright(at_high + 1, k)")
    block = block.select("place", "name", "k", first.alias("l"), stop.alias("r")).where("l < r")
    block = block.select("k", F.explode(F.array(F.when(F.col("l") % 2 == 1, F.col("l")), F.when(F.col("r") % 2 == 1, F.col("r") - 1))).alias("b"), "place", "name").where("b IS NOT NULL")
    best = block.groupBy("k", "b").agg(F.min(F.struct("place", "name")).alias("w"))
    cuts = ends.select("v", F.explode(F.array(F.lit(0), F.lit(1))).alias("half"), "pos").select("v", "half", (2 * F.col("pos") + F.col("half")).alias("at"))
    asks = cuts.select("v", "half", F.explode(F.sequence(F.lit(0), F.lit(top))).alias("k"), "at").withColumn("b", F.expr("shiftright(at, k)"))
    told = asks.join(best, ["k", "b"], "left").groupBy("v", "half").agg(F.min("w").alias("w"))
    return told.select("v", (2 * F.col("half")).alias("after"), "w.name")


def first_range(numbers: DataFrame, spans: DataFrame) -> DataFrame:
    """numbers (key, n) with name: that of the range with the least place that holds n, null where none does. Keys whose n is null or isn't a number are left out."""
    with Rounds(numbers.sparkSession) as rounds:
        cuts = rounds.put(segments(rounds, spans)).select(F.lit(None).cast(numbers.schema["key"].dataType).alias("key"), "v", "after", F.struct("name").alias("mark"))
        asked = numbers.where("n IS NOT NULL AND NOT isnan(n)").select("key", (F.col("n") + F.lit(0.0)).alias("v"), F.lit(1).alias("after"), F.lit(None).cast(cuts.schema["mark"].dataType).alias("mark"))
        both = cuts.withColumn("ask", F.lit(False)).unionByName(asked.withColumn("ask", F.lit(True)))
        met = last_mark(rounds, both, "mark", "v", "after", "key").where("ask").select("key", F.col("mark.name").alias("name"))
        return rounds.keep(met)
