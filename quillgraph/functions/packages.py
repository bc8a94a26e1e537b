"""Rows of a package table as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lines import strip


def cell(c: Column) -> Column:
    """Stripped; a missing cell, as in a short row, is empty."""
    return strip(F.coalesce(c, F.lit("")))


def or_null(c: Column) -> Column:
    return F.nullif(cell(c), F.lit(""))


def is_continuation(name: Column, directory: Column) -> Column:
    return (cell(name) == "") & (cell(directory) == "")


def prefixes(c: Column) -> Column:
    """Split at commas and white space, upper case, without quotes, N/A and empty ones; order and repeats stay."""
    parts = F.transform(F.split(cell(c), r"(?U)[,\s]+"), lambda x: F.upper(F.regexp_replace(x, "[\"']", "")))
    return F.filter(parts, lambda x: (x != "") & (x != "N/A"))
