"""Tables that a computation in rounds writes on its way, in the folder that driver and executors share: each round is computed once and starts from files, so
a lost executor costs no more than the tasks at hand."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from ..sources.settings import shared_dir
from .upsert import clear


#: Spark's settings: tasks of a shuffle that names no number, up to which size adaptive reads join shares of a shuffle, and how much of a file a task reads.
TASKS, JOINED, READ = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
#: Whether tables in buckets are read by splits where no join asks for the buckets; from which size of a table on a join with few rows tells it by a Bloom filter
#: which of its rows to deal, and up to which size of these rows' table.
BY_SPLITS = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
FILTERED, TOLD_BY, ITEMS, BITS = (f"spark.sql.optimizer.runtime.bloomFilter.{c}" for c in ("applicationSideScanSizeThreshold", "creationSideThreshold", "expectedNumItems", "numBits"))
#: Bytes, as compressed, that a task takes of joined shares: in memory they are many times as large.
SHARE = 16 << 20
#: Bytes of a file that a task reads: a shuffle to more than 200 tasks holds a task's rows in memory until they are dealt, many times as large as in the file.
SPLIT = 8 << 20
#: Bytes of a table whose rows are asked for by a filter before they are dealt.
LARGE = 64 << 20
#: Keys and bits of such a filter, Spark's limits: 8 MB, of which a session makes 1 MB by default, full at some million keys.
KEYS, WIDE = 4_000_000, 1 << 26


@contextmanager
def dealt_to(spark: SparkSession, tasks: int) -> Iterator[None]:
    """What is written meanwhile has so many tasks in its shuffles, if the session has fewer; shares are joined up to SHARE and files read in splits of SPLIT, if
    the session goes further. Saved frames are read by buckets, so what lies as it is to be written is written by a task for each bucket, and rows of a
    large table that a join drops are not dealt, but for those that a Bloom filter lets through."""
    size = lambda c, most: f"{min(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before[c]), most)}b"
    before = {c: spark.conf.get(c) for c in (TASKS, JOINED, READ, BY_SPLITS, FILTERED, TOLD_BY, ITEMS, BITS)}
    meanwhile = {TASKS: str(max(int(before[TASKS]), tasks)), JOINED: size(JOINED, SHARE), READ: size(READ, SPLIT), BY_SPLITS: "false", FILTERED: size(FILTERED, LARGE), TOLD_BY: "1t", ITEMS: str(KEYS), BITS: str(WIDE)}
    for c, now in meanwhile.items():
        spark.conf.set(c, now)
    try:
        yield
    finally:
        for c, was in before.items():
            spark.conf.set(c, was)


class Rounds:
    """What put() has written is deleted at the end, but for what keep() names: results that a caller reads later."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self) -> Rounds:
        return self

    def put(self, df: DataFrame) -> DataFrame:
        return self.put_told(df)[0]

    def put_told(self, df: DataFrame, *figures: Column) -> tuple[DataFrame, dict | None]:
        """df as written, and figures of it (named aggregates) that the write itself tells; None if Spark found df to be empty."""
        path = f"{shared_dir(self.spark)}/quillgraph-round-{uuid.uuid4().hex}"
        watch = Observation()
        (df.observe(watch, *figures) if figures else df).write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        try:
            return out, watch.get if figures else None
        except Py4JError:
            return out, None

    def keep(self, df: DataFrame) -> DataFrame:
        """df stays; one that put() has not written is written first."""
        out = df if id(df) in self.paths else self.put(df)
        del self.paths[id(out)]
        return out

    def __exit__(self, *_: object) -> None:
        for path, _df in self.paths.values():
            clear(self.spark, path)
