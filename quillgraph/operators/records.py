"""Records of the dictionary from parsed entries (line_no, global_name, subscripts, value).

Order matters in an export: later headers, names and roots replace earlier ones, and a cross-reference counts only after its field's header.
Each rule is an ordered aggregate (max_by, min) or a join on the key with a comparison of line numbers; nothing walks the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fields as D
from ..functions import lines as L
from ..functions import packages as P

#: Rows of a package table that look back together; a power of 2.
BLOCK = 4096


def files(entries: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """One file for each number: its last header, named by its last name entry (which may be empty) if there is one, with the last root that
    `roots`, the entries of a root export, has for it. Headers, names and roots are told in one aggregate, and if `roots` is `entries` in one scan."""
    rows = _kinds(entries, roots is entries)
    if roots is not None and roots is not entries:
        rows = rows.unionByName(_kinds(roots.where(L.is_root()), True))
    return files_of(_files_told(rows))


def files_told(entries: DataFrame) -> DataFrame:
    """What entries tell of each file number: its last header, name and root, each with its line. Such tables of several parts of an export add up (add_files)."""
    return _files_told(_kinds(entries, True))


def _kinds(entries: DataFrame, rooted: bool) -> DataFrame:
    """number, kind, told (a header's or root's value, or a name), line_no of what is said of files."""
    kind = F.when(L.is_file_header(), "file").when(L.is_file_name(), "name")
    rows = entries.withColumn("kind", kind.when(L.is_root(), "root") if rooted else kind).where("kind IS NOT NULL")
    return rows.select(L.sub(1).alias("number"), "kind", F.when(F.col("kind") == "name", L.sub(4)).otherwise(F.col("value")).alias("told"), "line_no")


def _files_told(rows: DataFrame) -> DataFrame:
    last = lambda kind: F.max(F.when(F.col("kind") == kind, F.struct("line_no", "told"))).alias(kind)
    return rows.groupBy("number").agg(*[last(k) for k in ("file", "name", "root")])


def add_files(told: DataFrame) -> DataFrame:
    return told.groupBy("number").agg(*[F.max(k).alias(k) for k in ("file", "name", "root")])


def files_of(told: DataFrame) -> DataFrame:
    """Files of what is told of their numbers; a number without a header is no file."""
    value = F.col("file.told")
    return told.where(value.isNotNull()).select(
        "number",
        F.coalesce("name.told", D.header_name(value, F.col("number"))).alias("name"),
        D.with_caret(F.col("root.told")).alias("global_root"),
        F.lit(None).cast("string").alias("parent_file"),
        D.is_subfile_header(value, F.col("number")).alias("is_subfile"),
    )


def fields(entries: DataFrame) -> DataFrame:
    """Every field definition, repeated ones too, but for number 0 and the B entries."""
    number, value = F.col("number"), F.col("value")
    rows = entries.where(L.is_field()).select(L.sub(1).alias("file_number"), L.sub(2).alias("number"), "line_no", "value")
    rows = rows.where((number != "0") & ~number.startswith("B"))
    return typed_fields(rows)


def typed_fields(rows: DataFrame) -> DataFrame:
    """file_number, number, line_no, value to fields. The value is split once."""
    rows = rows.select("file_number", "number", "line_no", F.split("value", r"\^").alias("p"))
    text = lambda n: F.coalesce(F.get("p", n), F.lit(""))
    rows = rows.select("file_number", "number", "line_no", F.get("p", 0).alias("first"), text(1).alias("t"), text(2).alias("third"))
    told = D.typed(F.col("t"), F.col("third"))
    return rows.select("file_number", "number", "line_no", D.or_named(F.col("first"), "FIELD_", F.col("number")).alias("name"), *[c.alias(n) for n, c in told.items()], field_id().alias("field_id"))


def field_id(file: str = "file_number", number: str = "number", line: str = "line_no"):
    return F.concat_ws(":", file, number, line)


def cross_references(entries: DataFrame) -> DataFrame:
    """The last definition of each cross-reference that follows its field's header, with the last set and kill logic after it.

    If the last definition does not follow the header, none does, and the same holds for logic, so each rule is an ordered aggregate by
    cross-reference. Rows are dealt by field once; the aggregate and the window that hands the header's line to the field's
    cross-references both stay in that partitioning: one scan, one parse, one exchange.
    """
    return cross_references_of(_xrefs_told(_xref_rows(entries).repartition("file_number", "field_number")))


def cross_references_told(entries: DataFrame) -> DataFrame:
    """What entries tell of each cross-reference, and of fields (xref_number null), each with its line; such tables add up (add_cross_references)."""
    return _xrefs_told(_xref_rows(entries))


def _xref_rows(entries: DataFrame) -> DataFrame:
    kind = F.when(L.is_xref_header(), "header").when(L.is_xref("0"), "definition").when(L.is_xref("1"), "set").when(L.is_xref("2"), "kill")
    rows = entries.select("subscripts", "line_no", "value", kind.alias("kind")).where("kind IS NOT NULL")
    return rows.select(L.sub(1).alias("file_number"), L.sub(2).alias("field_number"), F.when(F.col("kind") != "header", L.sub(4)).alias("xref_number"), "kind", "line_no", F.split("value", r"\^").alias("p"), "value")


def _xrefs_told(rows: DataFrame) -> DataFrame:
    defines = (F.col("kind") == "definition") & (F.size("p") >= 2)
    defined = F.struct("line_no", F.get("p", 1).alias("name"), F.coalesce(F.get("p", 2), F.lit("regular")).alias("xref_type"))
    logic = lambda k: F.max(F.when(F.col("kind") == k, F.struct("line_no", "value"))).alias(k)
    return rows.groupBy("file_number", "field_number", "xref_number").agg(F.min(F.when(F.col("kind") == "header", F.col("line_no"))).alias("header"), F.max(F.when(defines, defined)).alias("d"), logic("set"), logic("kill"))


def add_cross_references(told: DataFrame) -> DataFrame:
    return told.groupBy("file_number", "field_number", "xref_number").agg(F.min("header").alias("header"), *[F.max(c).alias(c) for c in ("d", "set", "kill")])


def cross_references_of(told: DataFrame) -> DataFrame:
    held = told.withColumn("since", F.min("header").over(Window.partitionBy("file_number", "field_number"))).where("d.line_no > since")
    logic = lambda k: F.when(F.col(f"{k}.line_no") > F.col("d.line_no"), F.col(f"{k}.value")).alias(f"{k}_logic")
    return held.select(F.concat_ws("_", "file_number", "field_number", "xref_number").alias("xref_id"), "d.name", "file_number", "field_number", "d.xref_type", "xref_number", logic("set"), logic("kill"), F.lit("field").alias("execution"))


def variable_targets(entries: DataFrame) -> DataFrame:
    """Every variable-pointer target, in the order of lines; missing pieces are empty."""
    rows = entries.where(L.is_variable_target()).select(L.sub(1).alias("file_number"), L.sub(2).alias("field_number"), L.sub(4).alias("v_number"), F.split("value", r"\^").alias("p"), "line_no")
    text = lambda n: F.coalesce(F.get("p", n), F.lit(""))
    return rows.select("file_number", "field_number", "v_number", text(0).alias("target_file"), text(1).alias("target_global"), text(2).alias("target_description"), "line_no")


def subfiles(files: DataFrame) -> DataFrame:
    """Files with a dot in their number, with the number before the first dot and how many parts there are."""
    n = F.col("number")
    return files.where(n.contains(".")).select("number", "name", D.parent_number(n).alias("parent_file_number"), F.lit("").alias("parent_field_number"), D.nesting_level(n).alias("nesting_level"))


def packages(rows: DataFrame) -> DataFrame:
    """Packages of a package table (row_no and its columns): rows with neither name nor directory go on with the package before them.

    file_no orders packages; first_prefixes are those of the package's own row, the only ones that a prefix is looked up by.
    """
    name, directory = F.col("Package Name"), F.col("Directory Name")
    own = P.cell(directory) != ""
    goes_on = P.is_continuation(name, directory)
    # rows look back within a block of the table; what the blocks before hold is told from one row of each
    rows = rows.withColumn("block", F.col("row_no").bitwiseAND(~(BLOCK - 1)))
    last = rows.groupBy("block").agg(F.max(F.when(own, F.col("row_no"))).alias("last"))
    carried = last.select("block", F.max("last").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    before = Window.partitionBy("block").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    at = F.coalesce(F.last(F.when(own, F.col("row_no")), ignorenulls=True).over(before), F.col("carried"))
    rows = rows.join(carried, "block").withColumn("file_no", at).where((own | goes_on) & F.col("file_no").isNotNull()).withColumn("own", own)
    mine = lambda c: F.max(F.when(F.col("own"), c))
    listed = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("row_no", c.alias("x")))), lambda s: s["x"]))
    numbers = F.filter(F.array(P.cell(F.col("File Numbers"))), lambda x: x != "")
    return rows.groupBy("file_no").agg(
        mine(F.coalesce(P.or_null(name), P.cell(directory))).alias("name"),
        mine(P.cell(directory)).alias("directory"),
        listed(P.prefixes(F.col("Prefixes"))).alias("prefixes"),
        mine(P.or_null(F.col("VDL ID"))).alias("vdl_id"),
        mine(P.or_null(F.col("File Numbers Low"))).alias("files_low"),
        mine(P.or_null(F.col("File Numbers High"))).alias("files_high"),
        listed(numbers).alias("file_numbers"),
        F.max(F.when(F.col("own"), P.prefixes(F.col("Prefixes")))).alias("first_prefixes"),
    )
