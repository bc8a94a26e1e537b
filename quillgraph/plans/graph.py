"""The property graph: a DataFrame for each label and each edge type, and the questions that need no more than these."""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import clear
from ..schemas import EDGE_TYPES, LABELS, edge_type, label
from ..sources import commits

#: Frames of a graph that are written at the same time.
WRITES_AT_ONCE = 6


def _name(name: str) -> str:
    """The column that is the key of a node: its edges' src or dst."""
    return "field_id" if name == "Field" else LABELS[name].key[0]


def _key(name: str):
    return F.col(_name(name))


class Frames(dict):
    """Frames by name; one that is given as a function is made when it is asked for first."""

    def __getitem__(self, name: str) -> DataFrame:
        df = dict.__getitem__(self, name)
        if callable(df):
            df = self[name] = df()
        return df

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(n, self[n]) for n in self]


@dataclass
class Graph:
    """nodes by label; edges by type, each with src and dst. Frames may be functions that make them."""

    spark: SparkSession
    node_frames: dict[str, DataFrame] = field(default_factory=dict)
    edge_frames: dict[str, DataFrame] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.node_frames, self.edge_frames = Frames(self.node_frames), Frames(self.edge_frames)

    def nodes(self, name: str) -> DataFrame:
        label(name)
        return self.node_frames[name]

    def edges(self, name: str) -> DataFrame:
        edge_type(name)
        if name not in self.edge_frames:
            return self.spark.createDataFrame([], "src string, dst string, confidence double")
        return self.edge_frames[name]

    def all_nodes(self) -> DataFrame:
        """label, key of every node."""
        return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("label"), _key(n).alias("key")) for n, df in self.node_frames.items()])

    def all_edges(self) -> DataFrame:
        """type, src, dst of every edge."""
        return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("type"), "src", "dst") for n, df in self.edge_frames.items()])

    def views(self) -> None:
        """Register every frame as a view, Label or TYPE, for SQL."""
        for n, df in (self.node_frames | self.edge_frames).items():
            df.createOrReplaceTempView(n)

    # counts -------------------------------------------------------------------------------------------------------

    def _counts(self, frames: dict[str, DataFrame], name: str) -> DataFrame:
        """One row of each frame: each is counted by itself, from the columns that a count needs, and only the counts are put together."""
        return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(n).alias(name), "count") for n, df in frames.items()]).where("count > 0")

    def count_by_label(self) -> DataFrame:
        return self._counts(self.node_frames, "label")

    def count_by_type(self) -> DataFrame:
        return self._counts(self.edge_frames, "type")

    def node_count(self, name: str | None = None) -> DataFrame:
        return self.nodes(name).agg(F.count(F.lit(1)).alias("count")) if name else self.count_by_label().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"))

    def edge_count(self, name: str | None = None) -> DataFrame:
        return self.edges(name).agg(F.count(F.lit(1)).alias("count")) if name else self.count_by_type().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"))

    def statistics(self) -> DataFrame:
        """One row: nodes and edges as lists of (name, count), and their totals folded from the lists."""
        listed = lambda df, k, out: df.agg(F.sort_array(F.collect_list(F.struct(F.col(k).alias("name"), "count"))).alias(out))
        both = listed(self.count_by_label(), "label", "nodes").crossJoin(listed(self.count_by_type(), "type", "edges"))  # one row each
        total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda s, x: s + x["count"])
        return both.select("nodes", "edges", total("nodes").alias("total_nodes"), total("edges").alias("total_edges"))

    def info(self) -> DataFrame:
        """kind, name, count of all labels and types, and a total for each kind."""
        n = self.count_by_label().select(F.lit("node").alias("kind"), F.col("label").alias("name"), "count")
        e = self.count_by_type().select(F.lit("edge").alias("kind"), F.col("type").alias("name"), "count")
        both = n.unionByName(e)
        return both.unionByName(both.groupBy("kind").agg(F.sum("count").alias("count")).select("kind", F.lit("total").alias("name"), "count"))

    # schema -------------------------------------------------------------------------------------------------------

    def schema(self) -> DataFrame:
        """kind, name, column, dtype of everything in the graph."""
        rows = [(k, n, c, t) for k, frames in (("node", self.node_frames), ("edge", self.edge_frames)) for n, df in frames.items() for c, t in df.dtypes]
        return self.spark.createDataFrame(rows, "kind string, name string, column string, dtype string")

    def connections(self) -> DataFrame:
        """from_label, type, to_label of the types that have edges."""
        ends = self.spark.createDataFrame([(n, t.source, t.target) for n, t in EDGE_TYPES.items()], "type string, from_label string, to_label string")
        return self.count_by_type().join(F.broadcast(ends), "type").select("from_label", "type", "to_label")

    def key_repeats(self) -> DataFrame:
        """label, repeats: keys that more than one node has; all are 0 where the uniqueness constraints hold."""
        keyed = self.all_nodes().groupBy("label", "key").agg(F.count(F.lit(1)).alias("n"))
        return keyed.groupBy("label").agg(F.count_if(F.col("n") > 1).alias("repeats"))

    def bad_confidence(self) -> DataFrame:
        """type, bad: edges with a confidence outside 0 to 1."""
        return reduce(DataFrame.unionByName, [df.agg(F.count_if((F.col("confidence") < 0) | (F.col("confidence") > 1)).alias("bad")).select(F.lit(n).alias("type"), "bad") for n, df in self.edge_frames.items()])

    # storage ------------------------------------------------------------------------------------------------------

    def save(self, path: str, buckets: int | None = None) -> dict[str, int]:
        """Make this the graph at path, whole or not at all; rows written, by label and type. What was there stays readable until vacuum()."""
        with Saving(self.spark, path, buckets) as saving:
            saving.write(self)
        return saving.rows

    @classmethod
    def load(cls, spark: SparkSession, path: str, labels: list[str] | None = None, types: list[str] | None = None) -> Graph:
        """The graph that was saved last at path, or these labels and types of it; ValueError if there is none, or if it lacks one of them."""
        told = commits.current(spark, path)
        if told is None:
            raise ValueError(f"no graph at {path}")
        pick = lambda kind, names: [n for n, f in told["frames"].items() if f["kind"] == kind] if names is None else names
        if lacking := {*(labels or []), *(types or [])} - {*told["frames"]}:
            raise ValueError(f"the graph at {path} lacks {', '.join(sorted(lacking))}")
        return cls(spark, *({n: _opened(spark, path, told["frames"][n]) for n in pick(*k)} for k in (("nodes", labels), ("edges", types))))

    @staticmethod
    def vacuum(spark: SparkSession, path: str) -> int:
        """Delete what no longer belongs to the graph at path; readers that began before lose it."""
        if not (told := commits.current(spark, path)):
            return 0
        used = {f["at"].split("/")[0] for f in told["frames"].values()}
        for version in commits.names(spark, path):
            if version not in used:
                _forget(spark, path, version)
        return commits.vacuum(spark, path, used)


#: The columns by which frames lie that don't by their key or src, those that joins look them up by: fields and what hangs on them lie alike, cross-references by the
#: field that they name, so that phase 2 finds their fields without dealing them again.
LIES_BY = {"CrossReference": "file_number, field_number", "CONTAINS_FILE": "dst", "CONTAINS_FIELD": "dst", "CONTAINS_LABEL": "dst", "OWNS_ROUTINE": "dst"}


def _table(path: str, at: str) -> str:
    """The name under which the session's catalog knows a saved frame."""
    return f"quillgraph_{hashlib.md5(f'{path}/{at}'.encode()).hexdigest()}"


def _forget(spark: SparkSession, path: str, version: str) -> None:
    """Take the frames of a version out of the catalog."""
    for kind in ("nodes", "edges"):
        for n in commits.names(spark, f"{path}/{version}/{kind}"):
            spark.sql(f"DROP TABLE IF EXISTS {_table(path, f'{version}/{kind}/{n}')}")


def _opened(spark: SparkSession, path: str, frame: dict) -> DataFrame:
    """A saved frame as a table in buckets of its key, so that a join on it needs no exchange and a look-up reads one bucket."""
    at, name = f"{path}/{frame['at']}", _table(path, frame["at"])
    if not spark.catalog.tableExists(name):
        quoted = at.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({frame['columns']}) USING parquet CLUSTERED BY ({frame['key']}) SORTED BY ({frame['key']}) INTO {frame['buckets']} BUCKETS LOCATION '{quoted}'")
    return spark.table(name)


class Saving:
    """A save in parts: frames are written one after the other and can be read again at once; at the end, if nothing has failed, they become the graph at path.

    base: begin with the frames of the graph that is there, and only add to them or replace some.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, base: bool = False):
        self.spark, self.path, self.version = spark, path, f"v-{commits.fresh()}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        told = commits.current(spark, path)
        self.before = told["number"] if told else 0
        self.frames: dict[str, dict] = dict(told["frames"]) if told and base else {}
        self.rows: dict[str, int] = {}

    def __enter__(self) -> Saving:
        return self

    def write(self, graph: Graph) -> None:
        frames = [("nodes", n, df, LIES_BY.get(n, _name(n))) for n, df in graph.node_frames.items()] + [("edges", n, df, LIES_BY.get(n, "src")) for n, df in dict.items(graph.edge_frames)]

        def put(frame: tuple) -> tuple[str, dict]:
            kind, n, df, key = frame
            df = df() if callable(df) else df  # what has rounds of its own runs beside the other writes
            at = f"{self.version}/{kind}/{n}"
            name = _table(self.path, at)
            # a task writes a bucket; keys that are many times there are of one node or of one field, and nodes' own keys are single
            df.repartition(self.buckets, *key.split(", ")).write.bucketBy(self.buckets, *key.split(", ")).sortBy(*key.split(", ")).option("path", f"{self.path}/{at}").option("compression", "zstd").format("parquet").saveAsTable(name)
            columns = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
            return n, {"kind": kind, "at": at, "key": key, "buckets": self.buckets, "columns": columns, "rows": self.spark.table(name).count()}  # told by the files' footers

        with ThreadPoolExecutor(WRITES_AT_ONCE) as pool:  # the last tasks of one write leave room for the first of the next
            made = dict(pool.map(put, frames))
        self.frames |= made
        self.rows |= {n: f["rows"] for n, f in made.items()}

    def written(self) -> Graph:
        """What will be the graph, as it is written so far."""
        return Graph(self.spark, *({n: _opened(self.spark, self.path, f) for n, f in self.frames.items() if f["kind"] == k} for k in ("nodes", "edges")))

    def __exit__(self, failed: object, *_: object) -> None:
        if not failed:
            commits.commit(self.spark, self.path, {"frames": self.frames}, self.before)
        else:
            _forget(self.spark, self.path, self.version)
            clear(self.spark, f"{self.path}/{self.version}")


def saved_rows(spark: SparkSession, path: str) -> dict[str, int]:
    """Rows of each label and type of the graph at path; empty if there is none."""
    told = commits.current(spark, path)
    return {n: f["rows"] for n, f in told["frames"].items()} if told else {}
