"""Folders that change as a whole: data goes to folders of its own, then one small file, which appears at once or not at all, tells what is current.

A reader follows the last such file. A write that fails before it leaves what was there as it was; of two writers that begin at the same state the second
one fails. Whatever file system Spark reads is used through Spark.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_commits"


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fresh() -> str:
    """A name that no version has."""
    return uuid.uuid4().hex


def _last(spark: SparkSession, path: str) -> int:
    where, fs = _path(spark, f"{path}/{FOLDER}")
    if not fs.exists(where):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return max([int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()], default=0)


def current(spark: SparkSession, path: str) -> dict | None:
    """What the last commit tells, with its number; None if there is none."""
    if not (n := _last(spark, path)):
        return None
    where, fs = _path(spark, f"{path}/{FOLDER}/{n:012d}.json")
    stream = fs.open(where)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) | {"number": n}


def commit(spark: SparkSession, path: str, told: dict, after: int) -> int:
    """Make `told` current, if the last commit is number `after` still; the new one's number."""
    temporary, fs = _path(spark, f"{path}/{FOLDER}/.{fresh()}")
    target, _ = _path(spark, f"{path}/{FOLDER}/{after + 1:012d}.json")
    stream = fs.create(temporary, True)
    stream.write(bytearray(json.dumps(told), "utf-8"))
    stream.close()
    if _last(spark, path) != after or not fs.rename(temporary, target):
        fs.delete(temporary, False)
        raise RuntimeError(f"{path} has changed meanwhile")
    return after + 1


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, without the commits; nothing if it isn't there."""
    where, fs = _path(spark, path)
    return sorted(n for s in fs.listStatus(where) if (n := s.getPath().getName()) != FOLDER) if fs.exists(where) else []


def vacuum(spark: SparkSession, path: str, used: set[str]) -> int:
    """Delete the folders beside the commits that `used` doesn't name, and the commits before the last; how many folders went."""
    gone = 0
    for name in names(spark, path):
        if name not in used:
            where, fs = _path(spark, f"{path}/{name}")
            gone += bool(fs.delete(where, True))
    last = _last(spark, path)
    for n in range(last - 1, 0, -1):
        old, fs = _path(spark, f"{path}/{FOLDER}/{n:012d}.json")
        if not fs.delete(old, False):
            break
    return gone
