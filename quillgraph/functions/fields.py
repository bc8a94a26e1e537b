"""Typing of files and fields: one expression for each property."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lines import piece

#: Names of the dictionary's type codes.
TYPE_NAMES = {
    "F": "Free Text",
    "N": "Numeric",
    "D": "Date/Time",
    "P": "Pointer",
    "S": "Set of Codes",
    "C": "Computed",
    "W": "Word Processing",
    "V": "Variable Pointer",
    "K": "MUMPS",
    "M": "Multiple",
}
_CODES = f"^[{''.join(TYPE_NAMES)}]$"


def type_name(code: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair]), code)


def _known(c: Column) -> Column:
    return c.rlike(_CODES)


def _rules(t: Column) -> dict[str, Column]:
    """The rules of the type piece; the first that holds decides."""
    return {
        "pointer": t.startswith("*P") | F.contains(F.substring(t, 1, 3), F.lit("P")),
        "required": t.startswith("R") & (F.length(t) > 1),
        "computed": t.startswith("C"),
        "multiple": t.startswith("M"),
    }


def typed(t: Column, third: Column) -> dict[str, Column]:
    """The properties that a field's type piece, and its third piece for required, tell; missing pieces are empty texts."""
    r, first, second = _rules(t), F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1)
    kind = (
        F.when(r["pointer"], "P")
        .when(r["required"], F.when(_known(second), second).otherwise("R"))
        .when(r["computed"], "C")
        .when(r["multiple"], "M")
        .when((t != "") & _known(first), first)
        .otherwise("F")
    )
    return {
        "data_type": kind,
        "required": t.startswith("R") | F.contains(F.upper(third), F.lit("R")),
        "is_pointer": r["pointer"],
        "is_computed": ~r["pointer"] & r["computed"],
        "is_multiple": ~r["pointer"] & r["multiple"],
        # digits after the first P
        "target_file": F.when(r["pointer"], F.nullif(F.regexp_extract(t, r"P(\d+)", 1), F.lit(""))),
    }


def of_value(value: Column) -> dict[str, Column]:
    """typed() of a field's whole value."""
    return typed(F.coalesce(piece(value, 2), F.lit("")), F.coalesce(piece(value, 3), F.lit("")))


def or_named(name: Column, prefix: str, number: Column) -> Column:
    """name, or prefix and number if it is empty or null."""
    return F.coalesce(F.nullif(name, F.lit("")), F.concat(F.lit(prefix), number))


def header_name(value: Column, number: Column) -> Column:
    first = F.substring_index(value, "^", 1)
    return F.when((first != "") & ~first.isin("FIELD", "SUB-FIELD"), first).otherwise(F.concat(F.lit("FILE_"), number))


def is_subfile_header(value: Column, number: Column) -> Column:
    """Says SUB-FILE, or has a fraction in its number; a number that isn't one has none."""
    return F.contains(F.upper(value), F.lit("SUB-FILE")) | F.coalesce(number.try_cast("double") % 1 != 0, F.lit(False))


def parent_number(number: Column) -> Column:
    return F.substring_index(number, ".", 1)


def nesting_level(number: Column) -> Column:
    return F.size(F.split(number, r"\."))


def with_caret(root: Column) -> Column:
    return F.when(root.startswith("^"), root).otherwise(F.concat(F.lit("^"), root))
