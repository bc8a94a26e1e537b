"""Writes by key: append, insert or replace, and removal of duplicates."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def last_by_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last in this order: an ordered aggregate, summed before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*[c if c in key else F.col(f"r.{c}") for c in df.columns])


def first_by_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*[c if c in key else F.col(f"r.{c}") for c in df.columns])


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """old with the rows of new in place of those with their key; of new rows with one key the last in this order counts. A table that stays is better off as
    operators.keyed: this makes all of it anew."""
    rows = last_by_key(new, key, order)
    return old.join(rows, key, "left_anti").unionByName(rows.select(*old.columns))


def upsert_columns(old: DataFrame, new: DataFrame, key: list[str], update: list[str], order: list[str]) -> DataFrame:
    """As upsert, but of a row that is there already only `update` changes."""
    was = old.withColumn("_old", F.lit(True))
    n = last_by_key(new, key, order)
    both = was.alias("o").join(n.alias("n"), key, "full_outer")
    pick = lambda c: c if c in key else (F.when(F.col("o._old") & (F.lit(c not in update) | F.col(f"n.{c}").isNull()), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))).alias(c)
    return both.select(*[pick(c) for c in old.columns])


def merge_edges(df: DataFrame, order: list[str]) -> DataFrame:
    """One edge for each pair of ends, the last in this order."""
    return last_by_key(df, ["src", "dst"], order)


def drop_repeats(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The head of each group of equal keys; the order says which it is."""
    return first_by_key(df, key, order)


def repeat_groups(df: DataFrame, key: list[str]) -> DataFrame:
    """key, count of the keys that stand more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("count")).where("count > 1")


def batches(df: DataFrame, size: int, order: list[str]) -> DataFrame:
    """df with batch, a number for each `size` rows in this order. For exports that want batches; a load needs none."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.orderBy(*order)) - 1) / size))


def append(df: DataFrame, path: str) -> int:
    """Append and tell how many rows were written."""
    watch = Observation()
    df.observe(watch, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    try:
        return int(watch.get["n"])
    except Py4JError:  # Spark found the frame to be empty while it ran, and dropped what counts
        return 0


def clear(spark: SparkSession, path: str) -> bool:
    """Delete a graph's directory, wherever it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True))
