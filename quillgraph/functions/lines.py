"""Entries of a dictionary export, `^NAME(sub,sub,...)="value"`, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The marks of an entry. Banners and blank lines don't begin with a caret, so nothing tells them apart further.
CARET, OPENS, CLOSES = "^", "(", ')="'
#: Quotes in one list of subscripts that a pattern is tried on; beyond them characters are folded one by one.
QUOTES = 64


def strip(c: Column) -> Column:
    """Without any white space around; trim() takes off spaces only. Only a text with white space at an end is searched."""
    ends = F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1)))
    return F.when(ends.rlike(r"(?U)\s"), F.regexp_replace(c, r"(?U)^\s+|\s+$", "")).otherwise(c)


def clean_subscript(s: Column) -> Column:
    """Stripped, and without one pair of quotes around it; a quote alone becomes empty."""
    t = strip(s)
    quoted = t.startswith('"') & t.endswith('"')
    return F.when(quoted, F.substring(t, F.lit(2), F.greatest(F.length(t) - 2, F.lit(0)))).otherwise(t)


def subscripts(text: Column) -> Column:
    """array<string>: commas outside quotes split, a backslash takes the next character as it is, a trailing empty piece is dropped.

    Text without quotes, backslashes and white space, by far the most, is split at commas as it is; text with quotes in pairs by one
    pattern; only the rest is folded character by character.
    """
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("piece"), F.lit(False).alias("quoted"), F.lit(False).alias("escaped"))

    def step(s: Column, c: Column) -> Column:
        made = lambda done, piece, quoted, escaped: F.struct(done.alias("done"), piece.alias("piece"), quoted.alias("quoted"), escaped.alias("escaped"))
        grown = F.concat(s["piece"], c)
        off = F.lit(False)
        return (
            F.when(s["escaped"], made(s["done"], grown, s["quoted"], off))
            .when(c == "\\", made(s["done"], s["piece"], s["quoted"], F.lit(True)))
            .when(c == '"', made(s["done"], grown, ~s["quoted"], off))
            .when((c == ",") & ~s["quoted"], made(F.concat(s["done"], F.array(s["piece"])), F.lit(""), s["quoted"], off))
            .otherwise(made(s["done"], grown, s["quoted"], off))
        )

    none = F.array().cast("array<string>")
    plain = F.split(F.when(text.endswith(","), F.left(text, F.length(text) - 1)).otherwise(text), ",")
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    paired = ~text.contains("\\") & (quotes <= QUOTES) & (quotes % 2 == 0)
    # every piece ends with a comma here, and a comma at the end of the text, outside quotes as they are in pairs, ends the last one
    cut = F.regexp_extract_all(F.when(text.endswith(","), text).otherwise(F.concat(text, F.lit(","))), F.lit(r'((?:[^,"]+|"[^"]*")*+),'), F.lit(1))
    folded = F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), state, step, lambda s: F.when(s["piece"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["piece"]))))
    return F.when(text == "", none).when(~text.rlike(r'(?U)["\\\s]'), plain).otherwise(F.transform(F.when(paired, cut).otherwise(folded), clean_subscript))


def unescape(value: Column) -> Column:
    """Doubled quotes are one."""
    return F.replace(value, F.lit('""'), F.lit('"'))


def piece(value: Column, n: int) -> Column:
    """The n-th caret piece from 1; null beyond the last."""
    return F.try_element_at(F.split(value, r"\^"), F.lit(n))


# -- kinds of entries; sub(n) is the n-th subscript from 1 -------------------------------------------------------------


def sub(n: int) -> Column:
    return F.try_element_at(F.col("subscripts"), F.lit(n))


def _is(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_dictionary() -> Column:
    return F.col("global_name") == "DD"


def is_file_header() -> Column:
    return _is(is_dictionary() & (F.size("subscripts") == 2) & (sub(2) == "0"))


def is_field() -> Column:
    return _is(is_dictionary() & (F.size("subscripts") >= 3) & (sub(3) == "0"))


def is_file_name() -> Column:
    return _is(is_dictionary() & (F.size("subscripts") >= 4) & (sub(2) == "0") & (sub(3) == "NM"))


def is_xref_header() -> Column:
    return _is(is_dictionary() & (F.size("subscripts") == 4) & (sub(3) == "1") & (sub(4) == "0") & (F.col("value") == "^.1"))


def is_xref(part: str) -> Column:
    """part "0" is a definition, "1" set logic, "2" kill logic."""
    return _is(is_dictionary() & (F.size("subscripts") == 5) & (sub(3) == "1") & (sub(5) == part))


def is_variable_target() -> Column:
    return _is(is_dictionary() & (F.size("subscripts") == 5) & (sub(3) == "V") & (sub(5) == "0"))


def is_root() -> Column:
    return _is((F.col("global_name") == "DIC") & (F.size("subscripts") == 3) & (sub(2) == "0") & (sub(3) == "GL"))
