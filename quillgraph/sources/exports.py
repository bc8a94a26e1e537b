"""Exports and package tables as DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lines as L

#: Columns of a package table, fixed values; both ways to name its files are read.
PACKAGE_COLUMNS = ("Directory Name", "Package Name", "Prefixes", "VDL ID", "File Numbers", "File Numbers Low", "File Numbers High")


def clean_bytes(c: Column) -> Column:
    """Text without the bytes that aren't UTF-8."""
    return F.replace(F.make_valid_utf8(c), F.lit("\ufffd"), F.lit(""))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no, raw. Numbers rise in the order of lines within a file and from file to file by name, and aren't dense; bytes that aren't UTF-8
    are dropped.

    A line is told by its file's place among the names, then where its split begins, then its place in the split: no shuffle, no one task.
    """
    text = spark.read.text(path)
    # the two ways in which Spark tells a file differ in slashes after the scheme
    names = sorted(re.sub(":/+", ":/", n, count=1) for n in text.inputFiles())
    at = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    lines = text.select(F.regexp_replace("_metadata.file_path", "^([^:/]*):/+", "$1:/").alias("file"), at.alias("at"), clean_bytes(F.col("value")).alias("raw"))
    if len(names) <= 1:
        return lines.select(F.col("at").alias("line_no"), "raw")
    places = spark.createDataFrame([*enumerate(names)], "place long, file string")
    return lines.join(places, "file").select((F.shiftleft("place", 44) + F.col("at")).alias("line_no"), "raw")


def line_place() -> Column:
    """A text that orders lines (file, block) by their file's name, then by place: where their split begins and where in the split they stand."""
    at = F.col("block") + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return F.concat_ws(" ", F.regexp_replace("file", "^([^:/]*):/+", "$1:/"), F.lpad(at.cast("string"), 19, "0"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """line_no, global_name, subscripts, value, raw_line of the lines that are entries. One scan, no shuffle, no Python.

    The parts of a line are found once, by position, and come out of a generator: what is asked of them later is asked of columns and
    isn't put in the place of each mention.
    """
    s = F.col("raw_line")
    rows = lines.select("line_no", L.strip(F.col("raw")).alias("raw_line"))
    rows = rows.select("*", F.instr(s, L.OPENS).alias("opens"), F.length(s).alias("size"))
    rows = rows.select("*", F.position(F.lit(L.CLOSES), s, F.col("opens") + 1).alias("closes"))
    between = lambda a, b: F.substring(s, a, b - a)
    name = between(F.lit(2), F.col("opens"))
    entry = s.startswith(L.CARET) & (F.col("opens") > 2) & (F.col("closes") > 0) & s.endswith('"') & (F.col("size") >= F.col("closes") + 3) & name.rlike(r"(?U)^\w+$")
    parts = F.struct(name.alias("global_name"), L.subscripts(between(F.col("opens") + 1, F.col("closes"))).alias("subscripts"), L.unescape(between(F.col("closes") + 3, F.col("size"))).alias("value"))
    rows = rows.select("line_no", F.explode(F.when(entry, F.array(parts))).alias("e"), "raw_line")
    return rows.select("line_no", "e.global_name", "e.subscripts", "e.value", "raw_line")


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """row_no and the package columns, all strings; columns that the file lacks are null. Rows of several files are numbered by file name, then in order."""
    table = spark.read.csv(path, header=True, inferSchema=False, escape='"', multiLine=True)
    names = sorted(re.sub(":/+", ":/", n, count=1) for n in table.inputFiles())
    at = F.monotonically_increasing_id()
    if len(names) <= 1:
        return package_rows(table.withColumn("row_no", at))
    # a file that may hold lines in quotes is read by one task, which may read several
    places = spark.createDataFrame([*enumerate(names)], "_place long, _file string")
    named = table.withColumns({"_file": F.regexp_replace("_metadata.file_path", "^([^:/]*):/+", "$1:/"), "_at": at.bitwiseAND((1 << 33) - 1)})
    return package_rows(named.join(places, "_file").withColumn("row_no", F.shiftleft("_place", 36) + F.col("_at")))


def package_rows(table: DataFrame) -> DataFrame:
    return table.select("row_no", *[table[f"`{c}`"] if c in table.columns else F.lit(None).cast(T.StringType()).alias(c) for c in PACKAGE_COLUMNS])
