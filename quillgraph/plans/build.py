"""From records to a graph, and from exports to records: the two phases of a load."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import edges as E
from ..operators import records as R
from ..operators import routines as M
from ..operators.stored import Rounds, dealt_to
from ..sources.exports import parse_lines, read_lines, read_packages
from .graph import Graph, Saving

#: Edge types that phase 2 adds.
PHASE_2 = ("INDEXED_BY", "SUBFILE_OF", "VARIABLE_POINTER")


def structure(spark: SparkSession, packages: DataFrame, files: DataFrame, fields: DataFrame) -> Graph:
    """Phase 1: packages, files and fields, with containment and pointers."""
    return Graph(spark, {"Package": packages, "File": files, "Field": fields}, _phase_1(packages, files, fields))


def _phase_1(packages: DataFrame, files: DataFrame, fields: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    return {"CONTAINS_FILE": lambda: E.contains_file(files, packages), "CONTAINS_FIELD": lambda: E.contains_field(files, fields), "POINTS_TO": lambda: E.points_to(files, fields)}


def enrich(graph: Graph, xrefs: DataFrame, targets: DataFrame) -> Graph:
    """Phase 2: cross-references, sub-files and variable pointers on a graph of phase 1; an empty one is refused."""
    files, fields = graph.nodes("File"), graph.nodes("Field")
    if files.isEmpty():
        raise ValueError("phase 2 needs the nodes of phase 1")
    more = {"INDEXED_BY": E.indexed_by(fields, xrefs), "SUBFILE_OF": E.subfile_of(files, R.subfiles(files)), "VARIABLE_POINTER": E.variable_pointer(files, fields, targets)}
    return Graph(graph.spark, graph.node_frames | {"CrossReference": xrefs}, graph.edge_frames | more)


#: Confidence of what leads to a stand-in.
STAND_IN = 0.5


def with_placeholders(graph: Graph, targets: DataFrame) -> Graph:
    """The graph with a stand-in for each file that sub-files or variable pointers name and that isn't there, and edges of these types to them.

    Targets are the variable pointers' (variable_targets), also those whose text is no file number: it is kept as it is. Only what names
    such a file leads to it, so the edges that were there stay as they are; a stand-in has a name of its own and nothing else.
    """
    files, fields = graph.nodes("File"), graph.nodes("Field")
    subs = R.subfiles(files)
    asked = targets.where("coalesce(target_file, '') <> ''")
    named = subs.select(F.col("parent_file_number").alias("number")).unionByName(asked.select(F.col("target_file").alias("number"))).distinct()
    missing = named.where("number <> ''").join(files.select("number"), "number", "left_anti")
    stub = {"name": F.concat(F.lit("FILE_"), "number"), "is_subfile": F.lit(False)}
    stand_ins = missing.select("number", *[stub.get(c, F.lit(None)).cast(t).alias(c) for c, t in files.dtypes if c != "number"])
    guessed = lambda df: df.withColumn("confidence", F.lit(STAND_IN))
    more = {"SUBFILE_OF": guessed(E.subfile_of(stand_ins, subs)), "VARIABLE_POINTER": guessed(E.variable_pointer(stand_ins, fields, asked))}
    return Graph(graph.spark, graph.node_frames | {"File": files.unionByName(stand_ins.select(*files.columns))}, graph.edge_frames | {n: graph.edges(n).unionByName(df) if n in graph.edge_frames else df for n, df in more.items()})


def with_routines(graph: Graph, lines: DataFrame) -> Graph:
    """Phase 3 on a graph of packages: routines and labels of sources (routine, line_no, line), who owns them and what they call."""
    labels, prefixes = M.labels(lines), package_by_prefix(graph.nodes("Package"))
    routines, nodes = M.routine_nodes(lines, prefixes), M.label_nodes(labels)
    key = lambda r, n, at: F.concat_ws(":", r, n, at)
    called = M.resolved(M.calls(lines).where("label IS NOT NULL"), labels)
    ends = called.select(key("routine", "label", "label_line").alias("src"), key("found_routine", "found_label", "found_line").alias("dst"), M.confidence(F.col("how")).alias("sure"))
    calls = E.edges("CALLS", ends, sure="sure").withColumn("confidence", F.col("sure")).drop("sure")
    return Graph(graph.spark, graph.node_frames | {"Routine": routines, "Label": nodes}, graph.edge_frames | {"CONTAINS_LABEL": M.contains_label(routines, nodes), "OWNS_ROUTINE": M.owns_routine(routines), "CALLS": calls})


def store(path: str, packages: DataFrame, files: DataFrame, fields: DataFrame, xrefs: DataFrame | None = None, targets: DataFrame | None = None, buckets: int | None = None) -> dict[str, int]:
    """Save the graph of these records, of phase 2 too if there are cross-references; rows written by label and type. Nodes are written first and edges derived
    from the nodes as written, so that no record is made twice; all of it becomes the graph at path at the end, or none of it. buckets: of each frame, and
    tasks of the shuffles of the load, at least: a number that grows with the records keeps a task's share."""
    spark = packages.sparkSession
    frames = {"Package": packages, "File": files, "Field": fields} | ({} if xrefs is None else {"CrossReference": xrefs})
    with dealt_to(spark, buckets or 1), Saving(spark, path, buckets) as saving:
        saving.write(Graph(spark, frames))
        held = saving.written()
        made = _phase_1(*(held.nodes(n) for n in ("Package", "File", "Field")))
        if xrefs is not None:
            later = enrich(held, held.nodes("CrossReference"), targets)
            made |= {n: later.edges(n) for n in PHASE_2}
        saving.write(Graph(spark, {}, made))
    return saving.rows


def add_phase_2(spark: SparkSession, path: str, xrefs: DataFrame, targets: DataFrame) -> dict[str, int]:
    """Phase 2 on the graph of phase 1 that is saved at path: its nodes and edges stay as they are, what phase 2 has is added or replaced; rows written."""
    with Saving(spark, path, base=True) as saving:
        if "File" not in saving.frames:
            raise ValueError("phase 2 needs the nodes of phase 1")
        saving.write(Graph(spark, {"CrossReference": xrefs}))
        held = saving.written()
        graph = enrich(held, held.nodes("CrossReference"), targets)
        saving.write(Graph(spark, {}, {n: graph.edges(n) for n in PHASE_2}))
    return saving.rows


@contextmanager
def reading(spark: SparkSession, dictionary: str) -> Iterator[DataFrame]:
    """The entries of an export, parsed once and stored in the folder of spark.checkpoint.dir; they are deleted at the end, when the graph is saved."""
    with Rounds(spark) as rounds:
        yield rounds.put(parse_lines(read_lines(spark, dictionary)))


def records(spark: SparkSession, entries: DataFrame, packages: str, roots: str | None = None) -> tuple[DataFrame, ...]:
    """Packages, files, fields, cross-references and variable targets of an export's entries, a package table and an export of global roots."""
    rooted = parse_lines(read_lines(spark, roots)) if roots else None
    return R.packages(read_packages(spark, packages)), R.files(entries, rooted), R.fields(entries), R.cross_references(entries), R.variable_targets(entries)


def load(spark: SparkSession, dictionary: str, packages: str, roots: str | None = None) -> Graph:
    """The graph of both phases, to be asked at once, from the lines themselves; reading() and store() save it."""
    p, files, fields, xrefs, targets = records(spark, parse_lines(read_lines(spark, dictionary)), packages, roots)
    return enrich(structure(spark, p, files, fields), xrefs, targets)


def parser_statistics(files: DataFrame, fields: DataFrame) -> DataFrame:
    """One row of totals and of conditional counts."""
    f = files.agg(F.count(F.lit(1)).alias("total_files"), F.count_if("is_subfile").alias("subfiles_count"))
    d = fields.agg(F.count(F.lit(1)).alias("total_fields"), F.count_if("is_pointer").alias("pointer_fields"), F.count_if("is_computed").alias("computed_fields"), F.count_if("required").alias("required_fields"))
    return f.crossJoin(d)  # one row each


def package_statistics(packages: DataFrame) -> DataFrame:
    own = packages.select(F.explode("first_prefixes").alias("p")).agg(F.countDistinct("p").alias("unique_prefixes"))
    told = packages.agg(
        F.count(F.lit(1)).alias("total_packages"),
        F.coalesce(F.sum(F.size("prefixes")), F.lit(0)).alias("total_prefixes"),
        F.count_if(F.col("files_low").isNotNull() & F.col("files_high").isNotNull()).alias("packages_with_file_ranges"),
        F.count_if(F.col("vdl_id").isNotNull()).alias("packages_with_vdl_id"),
    )
    return told.crossJoin(own)  # one row each


def package_by_prefix(packages: DataFrame) -> DataFrame:
    """prefix, name: the last package whose own row lists the prefix."""
    return packages.select("file_no", "name", F.explode("first_prefixes").alias("prefix")).groupBy("prefix").agg(F.max_by("name", "file_no").alias("name"))


def all_prefixes(packages: DataFrame) -> DataFrame:
    return package_by_prefix(packages).select("prefix").orderBy("prefix")
