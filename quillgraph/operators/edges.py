"""Edges between records: equi joins on the keys of nodes, and one look-up of ranges.

Every edge has src, dst (keys of its ends), its properties and a confidence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import edge_type
from .ranges import first_range


def edges(name: str, df: DataFrame, **properties: str) -> DataFrame:
    """df (src, dst and columns) to edges of this type; properties map names to columns, an empty text counts as none."""
    kind = edge_type(name)
    props = [F.nullif(F.col(c), F.lit("")).alias(p) if dict(df.dtypes)[c] == "string" else F.col(c).alias(p) for p, c in properties.items()]
    return df.select("src", "dst", *props, F.lit(kind.confidence).alias("confidence"))


def contains_field(files: DataFrame, fields: DataFrame) -> DataFrame:
    held = fields.join(files.select(F.col("number").alias("src")), F.col("file_number") == F.col("src"))
    return edges("CONTAINS_FIELD", held.select("src", F.col("field_id").alias("dst"), F.col("number").alias("n")), field_number="n")


def points_to(files: DataFrame, fields: DataFrame) -> DataFrame:
    asks = fields.where("is_pointer AND coalesce(target_file, '') <> ''")
    return edges("POINTS_TO", asks.join(files.select(F.col("number").alias("dst")), F.col("target_file") == F.col("dst")).select(F.col("field_id").alias("src"), "dst"))


def ranges(packages: DataFrame) -> DataFrame:
    """low, high, name, place: each different range once, named by its last package, placed where it came first."""
    rows = packages.select("file_no", "name", F.col("files_low").try_cast("double").alias("low"), F.col("files_high").try_cast("double").alias("high"))
    return rows.where("low IS NOT NULL AND high IS NOT NULL").groupBy("low", "high").agg(F.max_by("name", "file_no").alias("name"), F.min("file_no").alias("place"))


def package_of(files: DataFrame, packages: DataFrame) -> DataFrame:
    """number, package: by direct assignment (the last that lists the number), else the first range that holds it."""
    direct = packages.select("file_no", "name", F.explode("file_numbers").alias("number")).groupBy("number").agg(F.max_by("name", "file_no").alias("direct"))
    numbers = files.select("number", F.col("number").try_cast("double").alias("n"))
    ranged = first_range(numbers.select(F.col("number").alias("key"), "n").distinct(), ranges(packages)).select(F.col("key").alias("number"), F.col("name").alias("ranged"))
    return numbers.join(direct, "number", "left").join(ranged, "number", "left").select("number", F.coalesce("direct", "ranged").alias("package"))


def contains_file(files: DataFrame, packages: DataFrame) -> DataFrame:
    names = packages.select(F.col("name").alias("src")).distinct()
    held = package_of(files, packages).join(names, F.col("package") == F.col("src"))
    return edges("CONTAINS_FILE", held.select("src", F.col("number").alias("dst")))


def subfile_of(files: DataFrame, subfiles: DataFrame) -> DataFrame:
    parents = files.select(F.col("number").alias("dst"))
    held = subfiles.join(parents, F.col("parent_file_number") == F.col("dst")).select(F.col("number").alias("src"), "dst", F.col("parent_field_number").alias("field"), "nesting_level")
    return edges("SUBFILE_OF", held.dropDuplicates(["src", "dst"]), parent_field="field", level="nesting_level")


def indexed_by(fields: DataFrame, xrefs: DataFrame) -> DataFrame:
    """A field that is defined twice gets an edge from each definition."""
    x = xrefs.select(F.col("xref_id").alias("dst"), "file_number", F.col("field_number").alias("number"), F.col("name").alias("x_name"), "xref_type", "set_logic", "kill_logic")
    held = fields.select(F.col("field_id").alias("src"), "file_number", "number").join(x, ["file_number", "number"])
    # a field's id tells its file and number, so repeats are dropped where the join has left them: no second exchange
    return edges("INDEXED_BY", held.dropDuplicates(["file_number", "number", "src", "dst"]), xref_name="x_name", xref_type="xref_type", set_condition="set_logic", kill_condition="kill_logic")


def variable_pointer(files: DataFrame, fields: DataFrame, targets: DataFrame) -> DataFrame:
    """From the first definition of the field to each target that is a file."""
    first = fields.groupBy("file_number", F.col("number").alias("field_number")).agg(F.min_by("field_id", "line_no").alias("src"))
    known = files.select(F.col("number").alias("dst"))
    held = targets.join(first, ["file_number", "field_number"]).join(known, F.col("target_file") == F.col("dst"))
    return edges("VARIABLE_POINTER", held, target_file="target_file", target_global="target_global", target_description="target_description", v_number="v_number")
