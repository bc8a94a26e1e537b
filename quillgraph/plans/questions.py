"""Questions to a graph. Nulls sort last in rising and first in falling order; ties are broken by the key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import strong_components
from ..operators.paths import neighbourhood as nearby
from ..operators.paths import path_counts, walk
from ..schemas import EDGE_TYPES
from .graph import Graph

_up = lambda c: F.col(c).asc_nulls_last()
_down = lambda c: F.col(c).desc_nulls_first()


def find(graph: Graph, label: str, column: str, value: object) -> DataFrame:
    """Nodes of a label with this property."""
    nodes = graph.nodes(label)
    if column not in nodes.columns:
        raise ValueError(f"{label} has no {column}")
    return nodes.where(F.col(column) == F.lit(value)).orderBy(_up(column))


def orphan_files(graph: Graph) -> DataFrame:
    """Files that no package contains."""
    return graph.nodes("File").join(graph.edges("CONTAINS_FILE"), F.col("number") == F.col("dst"), "left_anti").select("number", "name").orderBy(_up("number"))


def dangling_pointers(graph: Graph) -> DataFrame:
    """Pointer fields that point to no file."""
    asks = graph.nodes("Field").where("is_pointer")
    return asks.join(graph.edges("POINTS_TO"), F.col("field_id") == F.col("src"), "left_anti").select("file_number", "number", "name", "target_file").orderBy(_up("file_number"), _up("number"), "name")


def _of(df: DataFrame, columns: list[str], present: str) -> F.Column:
    return F.sort_array(F.collect_list(F.when(F.col(present).isNotNull(), F.struct(*columns))))


def file_with_fields(graph: Graph, number: str | None = None) -> DataFrame:
    """number, name, fields: the fields that a file contains, none is an empty list."""
    files = graph.nodes("File") if number is None else graph.nodes("File").where(F.col("number") == number)
    held = graph.edges("CONTAINS_FIELD").select("src", F.col("dst").alias("field_id")).join(graph.nodes("Field").select("field_id", F.col("number").alias("f_number"), F.col("name").alias("f_name"), "data_type"), "field_id")
    rows = files.select("number", "name").join(held, F.col("number") == F.col("src"), "left")
    return rows.groupBy("number", "name").agg(_of(rows, ["f_number", "f_name", "data_type"], "field_id").alias("fields"))


def package_with_files(graph: Graph, name: str | None = None) -> DataFrame:
    packages = graph.nodes("Package") if name is None else graph.nodes("Package").where(F.col("name") == name)
    held = graph.edges("CONTAINS_FILE").select("src", F.col("dst").alias("number")).join(graph.nodes("File").select("number", F.col("name").alias("file_name")), "number")
    rows = packages.select("name").join(held, F.col("name") == F.col("src"), "left")
    return rows.groupBy("name").agg(_of(rows, ["number", "file_name"], "number").alias("files"))


def file_dependencies(graph: Graph, number: str | None = None) -> DataFrame:
    """file_number, target, target_name, reference_count: how many pointer fields of a file point to each file."""
    fields = graph.nodes("Field").where("is_pointer")
    fields = fields if number is None else fields.where(F.col("file_number") == number)
    held = graph.edges("CONTAINS_FIELD").select(F.col("src").alias("file_number"), F.col("dst").alias("field_id"))
    asks = fields.select("field_id").join(held, "field_id")
    return _counted(asks, graph, "file_number", "dst").select("file_number", F.col("other").alias("target"), F.col("name").alias("target_name"), "reference_count").orderBy(_down("reference_count"), "file_number", "target")


def file_dependents(graph: Graph, number: str | None = None) -> DataFrame:
    """target, file_number, file_name, reference_count: how many fields of each file point to a file."""
    held = graph.edges("CONTAINS_FIELD").select(F.col("src").alias("file_number"), F.col("dst").alias("field_id"))
    points = graph.edges("POINTS_TO").select(F.col("src").alias("field_id"), F.col("dst").alias("target"))
    points = points if number is None else points.where(F.col("target") == number)
    counts = points.join(held, "field_id").groupBy("target", "file_number").agg(F.count(F.lit(1)).alias("reference_count"))
    names = graph.nodes("File").select(F.col("number").alias("file_number"), F.col("name").alias("file_name"))
    return counts.join(names, "file_number").select("target", "file_number", "file_name", "reference_count").orderBy(_down("reference_count"), "target", "file_number")


def _counted(asks: DataFrame, graph: Graph, file: str, end: str) -> DataFrame:
    """Counts by (file, other end) first, then the names of the few pairs that are left."""
    points = graph.edges("POINTS_TO").select(F.col("src").alias("field_id"), F.col(end).alias("other"))
    counts = asks.join(points, "field_id").groupBy(file, "other").agg(F.count(F.lit(1)).alias("reference_count"))
    return counts.join(graph.nodes("File").select(F.col("number").alias("other"), "name"), "other")


def field_cross_references(graph: Graph, file: str | None = None, number: str | None = None) -> DataFrame:
    """A field's cross-references; a field without any gets one whose values are all null."""
    fields = graph.nodes("Field")
    if file is not None:
        fields = fields.where((F.col("file_number") == file) & (F.col("number") == number))
    x = graph.nodes("CrossReference").select("xref_id", F.col("name").alias("x_name"), F.col("xref_type").alias("x_type"), "set_logic", "kill_logic")
    held = graph.edges("INDEXED_BY").select("src", F.col("dst").alias("xref_id")).join(x, "xref_id")
    rows = fields.select("field_id", "name").join(held, F.col("field_id") == F.col("src"), "left")
    return rows.groupBy("field_id", "name").agg(F.sort_array(F.collect_list(F.struct("x_name", "x_type", "set_logic", "kill_logic"))).alias("cross_references"))


def variable_pointer_targets(graph: Graph, field_id: str | None = None) -> DataFrame:
    """field_name, targets of variable-pointer fields, by name."""
    fields = graph.nodes("Field").where("data_type = 'V'")
    fields = fields if field_id is None else fields.where(F.col("field_id") == field_id)
    files = graph.nodes("File").select(F.col("number").alias("dst"), F.col("name").alias("file_name"))
    rows = fields.select("field_id", F.col("name").alias("field_name")).join(graph.edges("VARIABLE_POINTER").withColumnRenamed("src", "field_id"), "field_id").join(files, "dst")
    return rows.groupBy("field_name").agg(F.sort_array(F.collect_list(F.struct(F.col("dst").alias("file"), F.col("file_name").alias("name"), F.col("target_global").alias("global"), F.col("target_description").alias("description")))).alias("targets"))


def xrefs_by_file(graph: Graph) -> DataFrame:
    return graph.nodes("CrossReference").groupBy("file_number").agg(F.count(F.lit(1)).alias("xref_count")).orderBy(_down("xref_count"), "file_number")


def most_indexed_fields(graph: Graph, most: int = 20) -> DataFrame:
    counts = graph.edges("INDEXED_BY").groupBy("src").agg(F.count(F.lit(1)).alias("xref_count"))
    named = counts.join(graph.nodes("Field"), F.col("src") == F.col("field_id")).select("file_number", F.col("number").alias("field_number"), F.col("name").alias("field_name"), "xref_count")
    return named.orderBy(_down("xref_count"), "file_number", "field_number", "field_name").limit(most)


def files_with_most_fields(graph: Graph, most: int = 10) -> DataFrame:
    counts = graph.edges("CONTAINS_FIELD").groupBy("src").agg(F.count(F.lit(1)).alias("field_count"))
    return counts.join(graph.nodes("File"), F.col("src") == F.col("number")).select("number", "name", "field_count").orderBy(_down("field_count"), "number").limit(most)


def most_referenced_files(graph: Graph, most: int = 10) -> DataFrame:
    counts = graph.edges("POINTS_TO").groupBy("dst").agg(F.count(F.lit(1)).alias("reference_count"))
    return counts.join(graph.nodes("File"), F.col("dst") == F.col("number")).select("number", "name", "reference_count").orderBy(_down("reference_count"), "number").limit(most)


def find_subfiles(graph: Graph, parent: str | None = None) -> DataFrame:
    """parent_number, child_number, child_name, level of the direct sub-files of a file, or of all."""
    own = graph.edges("SUBFILE_OF")
    own = own if parent is None else own.where(F.col("dst") == parent)
    child = graph.nodes("File").select(F.col("number").alias("src"), F.col("name").alias("child_name"))
    return own.join(child, "src").select(F.col("dst").alias("parent_number"), F.col("src").alias("child_number"), "child_name", "level").orderBy(_up("parent_number"), _up("child_number"))


def _numbered(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.concat_ws(">", F.lit(name), "src", "dst").alias("edge_id"), "src", "dst")


def pointer_chain(graph: Graph, field_id: str | None = None, most: int = 5) -> DataFrame:
    """Paths of POINTS_TO from a field, 1 to `most` hops: on a loaded graph files don't point on, so each has one."""
    fields = graph.nodes("Field").where("is_pointer") if field_id is None else graph.nodes("Field").where(F.col("field_id") == field_id)
    return walk(fields.select(F.col("field_id").alias("node")), _numbered(graph.edges("POINTS_TO"), "POINTS_TO"), most)


def file_flow(graph: Graph, starts: DataFrame, hops: int) -> DataFrame:
    """Paths from file to file through the fields between them: each hop is a contained field and its pointer."""
    held = graph.edges("CONTAINS_FIELD").select("src", F.col("dst").alias("field_id"))
    points = graph.edges("POINTS_TO").select(F.col("src").alias("field_id"), "dst")
    return walk(starts, held.join(points, "field_id").select(F.col("field_id").alias("edge_id"), "src", "dst"), hops)


def subfile_paths(graph: Graph, root: str | None = None) -> DataFrame:
    """start, node, hops, nodes: every path from a file down to its sub-files and theirs."""
    starts = graph.nodes("File").where(F.col("number") == root) if root else graph.edges("SUBFILE_OF").select(F.col("dst").alias("number")).distinct()
    return walk(starts.select(F.col("number").alias("node")), _numbered(graph.edges("SUBFILE_OF"), "SUBFILE_OF"), backward=True).orderBy("hops", "start", "node")


def ancestors(graph: Graph, number: str | None = None) -> DataFrame:
    starts = graph.nodes("File").where(F.col("number") == number) if number else graph.edges("SUBFILE_OF").select(F.col("src").alias("number")).distinct()
    return walk(starts.select(F.col("number").alias("node")), _numbered(graph.edges("SUBFILE_OF"), "SUBFILE_OF")).orderBy("hops", "start", "node")


def subfile_counts(graph: Graph) -> DataFrame:
    """root_file, root_name, subfile_count of every file that is no sub-file; 0 where it has none."""
    roots = graph.nodes("File").join(graph.edges("SUBFILE_OF"), F.col("number") == F.col("src"), "left_anti").select("number", "name")
    counts = path_counts(roots.select(F.col("number").alias("node")), graph.edges("SUBFILE_OF"), backward=True).groupBy("start").agg(F.sum("n").alias("n"))
    return roots.join(counts, F.col("number") == F.col("start"), "left").select(F.col("number").alias("root_file"), F.col("name").alias("root_name"), F.coalesce("n", F.lit(0)).alias("subfile_count")).orderBy(_down("subfile_count"), "root_file")


def descendant_counts(graph: Graph) -> DataFrame:
    """number, descendants, deepest of every file with sub-files: how many there are below it, theirs included, and how far down."""
    starts = graph.edges("SUBFILE_OF").select(F.col("dst").alias("node")).distinct()
    return path_counts(starts, graph.edges("SUBFILE_OF"), backward=True).groupBy(F.col("start").alias("number")).agg(F.sum("n").alias("descendants"), F.max("hops").alias("deepest"))


def ancestor_counts(graph: Graph) -> DataFrame:
    """number, ancestors of every sub-file."""
    starts = graph.edges("SUBFILE_OF").select(F.col("src").alias("node")).distinct()
    return path_counts(starts, graph.edges("SUBFILE_OF")).groupBy(F.col("start").alias("number")).agg(F.sum("n").alias("ancestors"))


def file_pointers(graph: Graph) -> DataFrame:
    """src, dst: each pair of files with a field of the one that points to the other, once."""
    held = graph.edges("CONTAINS_FIELD").select("src", F.col("dst").alias("field_id"))
    return held.join(graph.edges("POINTS_TO").select(F.col("src").alias("field_id"), "dst"), "field_id").select("src", "dst").distinct()


def pointer_components(graph: Graph) -> DataFrame:
    """number, component, size, circular: files that point to each other, over any number of files between; component is the least of them."""
    told = strong_components(graph.nodes("File").select(F.col("number").alias("node")), file_pointers(graph))
    return told.withColumnRenamed("node", "number")


def circular_dependencies(graph: Graph) -> DataFrame:
    """component, size, files: each group of files that depend on each other, files in order."""
    return pointer_components(graph).where("circular").groupBy("component", "size").agg(F.array_join(F.sort_array(F.collect_list("number")), ",").alias("files")).orderBy(_down("size"), "component")


def neighbourhood(graph: Graph, label: str, key: str, hops: int, types: list[str] | None = None) -> DataFrame:
    """label, key, hops: all nodes within so many hops of one, over edges of these types (all, if none are named) in both directions."""
    parts = []
    for name in types or [*graph.edge_frames]:
        kind = EDGE_TYPES[name]
        end = lambda n, c: F.struct(F.lit(n).alias("label"), F.col(c).alias("key"))
        parts.append(graph.edges(name).select(end(kind.source, "src").alias("src"), end(kind.target, "dst").alias("dst")))
    start = graph.spark.createDataFrame([((label, key),)], "node struct<label:string,key:string>")
    return nearby(start, reduce(DataFrame.unionByName, parts), hops).select("node.label", "node.key", "hops").orderBy("hops", "label", "key")


#: Edge types of phase 2 and how many a whole dictionary has at least; fixed values.
MINIMA = {"INDEXED_BY": 100, "SUBFILE_OF": 10, "VARIABLE_POINTER": 1}


def check_minima(graph: Graph, minima: dict[str, int] | None = None) -> DataFrame:
    """type, expected, actual, status; a type without edges is there, with 0."""
    wanted = graph.spark.createDataFrame([*(minima or MINIMA).items()], "type string, expected bigint")
    told = wanted.join(graph.count_by_type(), "type", "left").select("type", "expected", F.coalesce("count", F.lit(0)).alias("actual"))
    return told.withColumn("status", F.when(F.col("actual") >= F.col("expected"), "PASS").otherwise("FAIL"))


def validate(graph: Graph) -> DataFrame:
    """measure, value: counts of the graph, of orphan files and of dangling pointers."""
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("measure"), "value")
    info = graph.info().select(F.concat_ws(":", "kind", "name").alias("measure"), F.col("count").alias("value"))
    return reduce(DataFrame.unionByName, [info, one(orphan_files(graph), "orphan_files"), one(dangling_pointers(graph), "dangling_pointers")])


# -- further reports -----------------------------------------------------------------------------------------------


def file_structure(graph: Graph, number: str | None = None) -> DataFrame:
    """Fields of a file in order, with the name of the file that each points to."""
    fields = graph.nodes("Field") if number is None else graph.nodes("Field").where(F.col("file_number") == number)
    held = fields.join(graph.edges("CONTAINS_FIELD").select(F.col("dst").alias("field_id")), "field_id")
    names = graph.edges("POINTS_TO").select(F.col("src").alias("field_id"), "dst").join(graph.nodes("File").select(F.col("number").alias("dst"), F.col("name").alias("target_name")), "dst")
    return held.join(names, "field_id", "left").select("file_number", "number", "name", "data_type", "target_name").orderBy("file_number", "number", "name")


def required_or_linked(graph: Graph) -> DataFrame:
    f = graph.nodes("Field")
    return f.where(F.col("required") | F.col("data_type").isin("P", "V")).select("file_number", "number", "name", "data_type")


def impact(graph: Graph) -> DataFrame:
    """For each file: fields it has, fields that point to it, files these are in, sub-files. Each is counted before the join."""
    per = lambda df, key, out, c=F.lit(1), d=False: df.groupBy(F.col(key).alias("number")).agg((F.countDistinct(c) if d else F.count(c)).alias(out))
    held, points = graph.edges("CONTAINS_FIELD"), graph.edges("POINTS_TO")
    froms = points.select(F.col("src").alias("field_id"), F.col("dst").alias("target")).join(held.select(F.col("src").alias("file"), F.col("dst").alias("field_id")), "field_id")
    parts = [per(held, "src", "fields"), per(points, "dst", "pointing_fields"), per(froms, "target", "pointing_files", F.col("file"), True), per(graph.edges("SUBFILE_OF"), "dst", "subfiles")]
    out = graph.nodes("File").select("number", "name")
    for p in parts:
        out = out.join(p, "number", "left")
    return out.select("number", "name", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("fields", "pointing_fields", "pointing_files", "subfiles")])


def degree(graph: Graph, types: list[str] | None = None) -> DataFrame:
    """key, fan_out, fan_in over the edges of these types."""
    edges = graph.all_edges()
    edges = edges if types is None else edges.where(F.col("type").isin(types))
    sides = edges.select(F.explode(F.array(F.struct(F.col("src").alias("key"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("dst").alias("key"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("x")).select("x.*")
    return sides.groupBy("key").agg(F.sum("o").alias("fan_out"), F.sum("i").alias("fan_in"))


def subfiles_by_parent(graph: Graph) -> DataFrame:
    """parent, n, children straight from the numbers, sorted, in one text."""
    n = F.col("number")
    own = graph.nodes("File").where(n.contains(".")).select(F.substring_index(n, ".", 1).alias("parent"), n.alias("child"))
    known = graph.nodes("File").select(n.alias("parent"))
    return own.join(known, "parent").groupBy("parent").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_list("child")), ",").alias("children"))


def missing_parents(graph: Graph, confidence: float = 0.5) -> DataFrame:
    """Stand-ins for the parents that sub-files name and no file is."""
    n = F.col("number")
    asked = graph.nodes("File").where(n.contains(".")).select(F.substring_index(n, ".", 1).alias("number")).distinct()
    return asked.join(graph.nodes("File").select("number"), "number", "left_anti").select("number", F.concat(F.lit("FILE_"), "number").alias("name"), F.lit(confidence).alias("confidence"))


def migration(graph: Graph) -> DataFrame:
    """For each package: different files, fields and cross-references, and how many of its files no other package's field points to."""
    own = graph.edges("CONTAINS_FILE").select(F.col("src").alias("package"), F.col("dst").alias("file"))
    held = graph.edges("CONTAINS_FIELD").select(F.col("src").alias("file"), F.col("dst").alias("field"))
    xref = graph.edges("INDEXED_BY").select(F.col("src").alias("field"), F.col("dst").alias("xref"))
    files = own.groupBy("package").agg(F.countDistinct("file").alias("files"))
    fields = own.join(held, "file").groupBy("package").agg(F.countDistinct("field").alias("fields"))
    xrefs = own.join(held, "file").join(xref, "field").groupBy("package").agg(F.countDistinct("xref").alias("xrefs"))
    points = graph.edges("POINTS_TO").select(F.col("src").alias("field"), F.col("dst").alias("file"))
    from_ = held.join(own, "file").select("field", F.col("package").alias("from_package"))
    outer = points.join(from_, "field").join(own, "file").where("from_package <> package").select("file").distinct()
    free = own.join(outer, "file", "left_anti").groupBy("package").agg(F.countDistinct("file").alias("free_files"))
    out = files
    for p in (fields, xrefs, free):
        out = out.join(p, "package", "left")
    return out.select("package", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("files", "fields", "xrefs", "free_files")])
