"""Helpers that several operators share: durable intermediate tables, byte-level text kernels, components of a graph."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.settings import shared_dir

#: One character class, in Java's, Python's and RE2's syntax alike: what separates words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


#: With this setting Spark drops the shuffle files of a query at its end; durable() asks for it while it writes.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_INSIDE: ContextVar[list[DataFrame] | None] = ContextVar("tables of the innermost passing()", default=None)


def durable(df: DataFrame, *by: str) -> DataFrame:
    """Write df to the shared folder, in a folder for each value of the columns `by`, and read it back: its lineage ends here, so a lost executor costs
    nothing before it, and the shuffles behind it go."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillgraph-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before else spark.conf.unset(CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out._durable_path = path
    if (inside := _INSIDE.get()) is not None:
        inside.append(out)
    return out


@contextmanager
def passing() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that durable() writes inside are deleted at the end, but for those handed to the function that this gives: the next passing() out has them."""
    outer, mine = _INSIDE.get(), []
    token = _INSIDE.set(mine)

    def keep(df: DataFrame) -> DataFrame:
        mine.remove(df)
        if outer is not None:
            outer.append(df)
        return df

    try:
        yield keep
    finally:
        _INSIDE.reset(token)
        for df in mine:
            drop(df)


def drop(df: DataFrame) -> None:
    """Delete a table of durable() that nothing will read again."""
    context = df.sparkSession.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(df._durable_path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def slices(parts: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of so many rows at most: whole texts are long, and what is made of a batch stands beside it."""
    for b in parts:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each made one that no column of df has."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def lower_ascii(c: Column) -> Column:
    """A-Z only, unlike lower()."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_list(c: Column) -> Column:
    """array<string> of the words of a text; null gives an empty array."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACE + "+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    """bigint: number of words, without a lambda call for each."""
    parts = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), f"^{SPACE}+", ""), SPACE + "+")
    return (F.size(parts) - (F.element_at(parts, -1) == "").cast("int")).cast("bigint")


# -- text as bytes -------------------------------------------------------------------------------------------------

_R = np.random.default_rng(20240607)
_BYTE = _R.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(1 << 20, 1 << int(n).bit_length())
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray, values: np.ndarray = _BYTE) -> np.ndarray:
    """h with h[j] - h[i] = sum of a random value of each byte (or other small number) of data[i:j] times base ** position, in 64-bit arithmetic."""
    up, _ = _powers(len(data) + 1)
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=h[1:])
    return h


def lower_bytes(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def range_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each range, alike wherever the range stands."""
    _, down = _powers(len(h))
    return mix((h[end] - h[start]) * down[start])


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary or string Arrow column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return body, at - at[0]


def pieces(column: pa.Array, most: int = 2_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of rows of about `most` bytes (one row at least): (first row, row after, bytes, offsets)."""
    data, at = raw(column)
    i = 0
    while i < len(at) - 1:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def word_ranges(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of each word, and for each row the index of its first word (rows + 1 entries). Words end with their row."""
    solid = ~_IS_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = solid
    before[cut] = False
    start = np.flatnonzero(solid & ~before[: len(data)])
    after = np.zeros(len(data) + 1, bool)
    after[: len(data)] = solid
    after[cut] = False
    end = np.flatnonzero(solid & ~after[1:]) + 1
    return start, end, np.searchsorted(start, at)


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lower-cased, and for each row the index of its first word."""
    low = _LOWER[data]
    start, end, first = word_ranges(low, at)
    return range_hash(prefix_hash(low), start, end), first


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


# -- components ----------------------------------------------------------------------------------------------------


def _stars(edges: DataFrame, rounds: int) -> DataFrame:
    """(u, v): every node but the least of its component, and that."""
    e = durable(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    seen = None
    for _ in range(rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = durable(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))  # a table by itself: the join below can split a hub
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        e = durable(small)
        # two sums of the edges tell whether a step changed them: a star forest stays as it is
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e
        seen = now
    raise RuntimeError("components did not settle")


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node reachable.

    Alternating large-star and small-star steps: each lets every node tell its neighbours the least of them, so chains
    shorten by half and a hub's rows are summed before they are shuffled. Every step ends in a durable table; the last one stays.
    """
    with passing() as keep:
        e = keep(_stars(edges, rounds))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


# -- groups in sorted partitions -----------------------------------------------------------------------------------


def runs(parts: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Split batches that come sorted by key into one table for each key; a run may go over several batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in parts:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1), len(k)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if held and k[i] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(i, j - i))
            last = k[i]
    if held:
        yield pa.Table.from_batches(held)


def in_runs(df: DataFrame, key: str) -> DataFrame:
    """All rows of a key in one partition, side by side, for runs()."""
    return df.repartition(key).sortWithinPartitions(key)


class Encoded:
    """Ids of every different segment seen, a bounded number; texts are then a gather. encode: list of segments to (ids of all, how many of each)."""

    def __init__(self, encode, most: int = 500_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.row: dict[bytes, int] = {}
        self.flat, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __call__(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all the segments in a row, how many of each)."""
        if len(self.row) > self.most:
            self._clear()
        rows = np.array([*map(self.row.get, segments)], np.float64)  # None becomes nan
        if (none := np.isnan(rows)).any():
            new = list(dict.fromkeys(segments[i] for i in np.flatnonzero(none)))
            flat, size = self.encode(new)
            self.row.update(zip(new, range(len(self.row), len(self.row) + len(new)), strict=True))
            self.at = np.append(self.at, self.at[-1] + np.cumsum(size))
            self.flat = np.append(self.flat, flat.astype(np.int32))
            rows = np.array([*map(self.row.get, segments)])
        return gather(self.flat, self.at, rows.astype(np.int64))


def gather(flat: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """flat[at[r]:at[r + 1]] for each r of rows, in a row, and their lengths."""
    size = at[rows + 1] - at[rows]
    end = size.cumsum()
    return flat[np.arange(end[-1] if len(end) else 0) + np.repeat(at[rows] - (end - size), size)], size
