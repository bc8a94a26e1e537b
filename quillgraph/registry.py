"""Registered queries over the sample dictionary, and for each the SQL that gives the same rows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import fields as D
from .functions import lines as L
from .functions.packages import prefixes
from .operators import edges as E
from .operators import paths as W
from .operators import records as R
from .operators import routines as M
from .operators import upsert as U
from .operators.components import strong_components
from .operators.keyed import Keyed
from .operators.ranges import first_range
from .operators.stored import dealt_to
from .plans import build as B
from .plans import questions as Q
from .plans.graph import Graph
from .plans.sample import FILE_NUMBER, INPUTS, TARGET, cross_references, export_files, inputs, package_file, sample_graph, saved_graph, tasks, written_counts as counts_written
from .sources import commits
from .sources.exports import parse_lines, read_lines, read_packages
from .schemas import EDGE_TYPES
from .sources.settings import Settings, shared_dir
from .streaming.exports import keep_up, stream_entries
from .streaming.records import KeptRecords, stream_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_plain = {k: re.sub(r"\{(\w+)\}", r"\1", v).replace("`", '"') for k, v in INPUTS.items()}
#: What the derived records are, told in SQL from the tables.
_RECORDS = {
    **{k: _plain[k] for k in ("package_rows", "files", "field_rows", "xref_rows", "target_rows", "lines")},
    "packages": """SELECT n_nationkey AS k, n_name AS name, n_regionkey AS r, n_nationkey % 4 = 2 AND n_nationkey < 24 AS continued FROM nation WHERE n_nationkey % 4 <> 3""",
    "prefix_list": """SELECT k, name, 1 AS o, unnest(['N' || k, 'R' || r]) AS prefix FROM packages UNION ALL SELECT k, name, 2, unnest(['Z' || (k + 1), 'Q']) FROM packages WHERE continued""",
    "fields": f"""SELECT {FILE_NUMBER} AS file_number, CAST(o_orderkey AS STRING) AS number, o_orderkey AS line_no, 'F' || o_orderkey AS name,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'P' WHEN '2-HIGH' THEN 'F' WHEN '3-MEDIUM' THEN 'N' WHEN '5-LOW' THEN 'C' ELSE 'V' END AS data_type, o_orderpriority IN ('1-URGENT', '2-HIGH') AS required, o_orderpriority = '1-URGENT' AS is_pointer,
        o_orderpriority = '5-LOW' AS is_computed, false AS is_multiple, CASE WHEN o_orderpriority = '1-URGENT' THEN {TARGET} END AS target_file, {FILE_NUMBER} || ':' || o_orderkey || ':' || o_orderkey AS field_id FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey <> 0""",
    "xrefs": """SELECT xref_id, name, file_number, field_number, xref_type, xref_number, nullif(set_logic, '') AS set_logic, kill_logic FROM (SELECT *, row_number() OVER (PARTITION BY xref_id ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM xref_rows) WHERE rn = 1""",
    "direct": "SELECT CAST(40 * n_nationkey + 35 AS STRING) AS number, max(CASE WHEN n_nationkey % 4 = 3 THEN (SELECT n_name FROM nation m WHERE m.n_nationkey = nation.n_nationkey - 1) ELSE n_name END) AS name FROM nation WHERE n_nationkey % 5 = 0 GROUP BY 1",
    "ranged": "SELECT f.number, arg_min(p.name, p.k) AS name FROM files f JOIN packages p ON CAST(f.number AS DOUBLE) BETWEEN 40 * p.k AND 40 * p.k + CASE WHEN p.k = 4 THEN 75 ELSE 34 END GROUP BY f.number",
    "contains_file": "SELECT coalesce(d.name, r.name) AS src, f.number AS dst FROM files f LEFT JOIN direct d USING (number) LEFT JOIN ranged r USING (number) WHERE coalesce(d.name, r.name) IS NOT NULL",
    "contains_field": "SELECT d.file_number AS src, d.field_id AS dst FROM fields d JOIN files f ON d.file_number = f.number",
    "points_to": "SELECT d.field_id AS src, f.number AS dst FROM fields d JOIN files f ON d.target_file = f.number",
    "subfile_of": "SELECT c.number AS src, p.number AS dst FROM files c JOIN files p ON split_part(c.number, '.', 1) = p.number AND contains(c.number, '.')",
    "indexed_by": "SELECT d.field_id AS src, x.xref_id AS dst, x.name, x.xref_type, x.set_logic FROM xrefs x JOIN fields d ON x.file_number = d.file_number AND x.field_number = d.number",
    "variable_pointer": "SELECT d.field_id AS src, f.number AS dst, t.* FROM target_rows t JOIN fields d ON t.file_number = d.file_number AND t.field_number = d.number JOIN files f ON t.target_file = f.number",
    "all_nodes": "SELECT 'Package' AS label, name AS key FROM packages UNION ALL SELECT 'File', number FROM files UNION ALL SELECT 'Field', field_id FROM fields UNION ALL SELECT 'CrossReference', xref_id FROM xrefs",
    "all_edges": " UNION ALL ".join(f"SELECT '{t.upper()}' AS type, src, dst FROM {t}" for t in ("contains_file", "contains_field", "points_to", "subfile_of", "indexed_by", "variable_pointer")),
    "parsed": r"""SELECT line_no, regexp_extract(s, '^\^(\w+)\(', 1) AS g, regexp_extract(s, '^\^(\w+)\((.*?)\)="(.*)"$', 2) AS subs, replace(regexp_extract(s, '^\^(\w+)\((.*?)\)="(.*)"$', 3), '""', '"') AS value, s FROM (SELECT line_no, trim(raw) AS s FROM lines) WHERE regexp_matches(s, '^\^(\w+)\((.*?)\)="(.*)"$')""",
    "hops": "SELECT h.src, p.dst, h.dst AS field FROM contains_field h JOIN points_to p ON h.dst = p.src",
}


def _sql(body: str) -> str:
    """body with those of the records that it needs, directly or not."""
    need: list[str] = []

    def visit(text: str) -> None:
        for k in _RECORDS:
            if k not in need and re.search(rf"(?<![\w.']){k}\b(?!\s*\()", text):
                need.append(k)
                visit(_RECORDS[k])

    visit(body)
    parts = [f"{k} AS ({_RECORDS[k]})" for k in _RECORDS if k in need]
    own = body.removeprefix("WITH ")
    return f"WITH {', '.join(parts)}{', ' if own != body else ' '}{own}" if parts else body


def query(sql: str | None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = _sql(sql)
        return f

    return put


def _graph_query(name: str, f: Callable, sql: str) -> None:
    """A question to the sample graph, as saved."""
    QUERIES[name] = lambda spark, sf: f(saved_graph(spark, sf))
    SQL[name] = _sql(sql)


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    return parse_lines(inputs(spark, sf, "lines"))


# -- lines (S1-S3, P1-P12) -------------------------------------------------------------------------------------------


@query("SELECT line_no, g AS global_name, CAST(CASE WHEN contains(subs, '\"') THEN 4 - CASE WHEN contains(subs, 'GL') THEN 1 ELSE 0 END + CASE WHEN contains(subs, '\"V\"') THEN 1 ELSE 0 END ELSE len(string_split(subs, ',')) END AS INT) AS n_subscripts, split_part(subs, ',', 1) AS first, CASE WHEN contains(subs, 'NM') THEN regexp_extract(subs, '\"([^\"]*)\"$', 1) WHEN contains(subs, 'GL') THEN 'GL' ELSE regexp_extract(subs, '([^,]*)$', 1) END AS last, value FROM parsed")
def lines_parsed(spark: SparkSession, sf: str) -> DataFrame:
    return _entries(spark, sf).select("line_no", "global_name", F.size("subscripts").alias("n_subscripts"), L.sub(1).alias("first"), F.element_at("subscripts", -1).alias("last"), "value")


@query(r"""SELECT CASE WHEN g = 'DIC' THEN 'root' WHEN regexp_matches(subs, '^[\d.]+,0$') THEN 'file' WHEN contains(subs, '"NM"') THEN 'name' WHEN regexp_matches(subs, '^[\d.]+,\d+,0$') THEN 'field' WHEN regexp_matches(subs, '^[\d.]+,\d+,1,0$') THEN 'xref header' WHEN contains(subs, '"V"') THEN 'target' WHEN ends_with(subs, ',0') THEN 'xref' ELSE 'set' END AS kind, count(*) AS n FROM parsed GROUP BY 1""")
def lines_by_kind(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(L.is_root(), "root").when(L.is_file_header(), "file").when(L.is_file_name(), "name").when(L.is_field(), "field").when(L.is_xref_header(), "xref header").when(L.is_xref("0"), "xref").when(L.is_xref("1"), "set").when(L.is_xref("2"), "kill").when(L.is_variable_target(), "target").otherwise("other")
    return _entries(spark, sf).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


# -- records (P13-P28, J7, J8, J17, W1-W4) -----------------------------------------------------------------------------


@query(
    f"""SELECT {FILE_NUMBER} AS number, CASE WHEN c_custkey % 4 = 0 THEN 'LAST, ' || c_custkey WHEN c_custkey % 2 = 0 THEN 'NAME ' || c_custkey WHEN c_custkey % 11 = 0 THEN 'FILE_' || {FILE_NUMBER} WHEN c_custkey % 6 = 0 THEN c_name || ' Sub-File' ELSE c_name END AS name,
    CASE WHEN c_custkey % 5 = 0 THEN '^DAT(' || c_custkey || ',"A",' END AS global_root, c_custkey % 5 <> 0 OR (c_custkey % 6 = 0 AND c_custkey % 11 <> 0) AS is_subfile FROM customer"""
)
def files_from_lines(spark: SparkSession, sf: str) -> DataFrame:
    entries = _entries(spark, sf)
    return R.files(entries, entries).select("number", "name", "global_root", "is_subfile")


@query("SELECT file_number, number, name, data_type, required OR line_no % 4 = 0 AS required, is_pointer, is_computed, is_multiple, target_file FROM fields")
def fields_from_lines(spark: SparkSession, sf: str) -> DataFrame:
    return R.fields(_entries(spark, sf)).drop("line_no", "field_id")


_LAST_LINES = "(SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY l_orderkey, l_linenumber)"


@query(
    f"""SELECT {FILE_NUMBER} || '_' || l_orderkey || '_' || l_linenumber AS xref_id, 'X' || l_partkey AS name, {FILE_NUMBER} AS file_number, CAST(l_orderkey AS STRING) AS field_number, CASE WHEN l_partkey % 3 = 0 THEN 'regular' ELSE 'MUMPS' END AS xref_type,
    CAST(l_linenumber AS STRING) AS xref_number, CASE WHEN l_partkey % 2 = 0 AND l_partkey % 5 <> 0 THEN 'S ^X(' || l_partkey || ')=1' END AS set_logic, CAST(NULL AS STRING) AS kill_logic FROM {_LAST_LINES} l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    WHERE o_orderkey % 2 = 0 AND o_orderkey % 10 <> 0"""
)
def cross_references_from_lines(spark: SparkSession, sf: str) -> DataFrame:
    return R.cross_references(_entries(spark, sf)).drop("execution")


@query(
    f"""SELECT {FILE_NUMBER} AS file_number, CAST(l_orderkey AS STRING) AS field_number, count(*) AS n, string_agg(l_partkey || '|G|' || CASE WHEN l_partkey % 2 = 0 THEN 'desc' ELSE '' END, ',' ORDER BY l_linenumber) AS targets FROM {_LAST_LINES} l
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '4-NOT SPECIFIED' GROUP BY 1, 2"""
)
def variable_targets_from_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.variable_targets(_entries(spark, sf))
    listed = F.array_sort(F.collect_list(F.struct("line_no", F.concat_ws("|", "target_file", "target_global", "target_description").alias("t"))))
    return rows.groupBy("file_number", "field_number").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(listed, lambda x: x["t"]), ",").alias("targets"))


@query("SELECT number, name, split_part(number, '.', 1) AS parent_file_number, '' AS parent_field_number, CAST(len(string_split(number, '.')) AS INT) AS nesting_level FROM files WHERE contains(number, '.')")
def subfile_records(spark: SparkSession, sf: str) -> DataFrame:
    return R.subfiles(inputs(spark, sf, "files"))


@query("SELECT (SELECT count(*) FROM files) AS total_files, (SELECT count(*) FROM files WHERE is_subfile) AS subfiles_count, count(*) AS total_fields, count(*) FILTER (is_pointer) AS pointer_fields, count(*) FILTER (is_computed) AS computed_fields, count(*) FILTER (required) AS required_fields FROM fields")
def parser_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return B.parser_statistics(inputs(spark, sf, "files"), R.typed_fields(inputs(spark, sf, "field_rows")))


@query("SELECT data_type, CASE data_type WHEN 'P' THEN 'Pointer' WHEN 'F' THEN 'Free Text' WHEN 'N' THEN 'Numeric' WHEN 'C' THEN 'Computed' ELSE 'Variable Pointer' END AS type_name, count(*) AS n FROM fields GROUP BY 1")
def fields_by_type(spark: SparkSession, sf: str) -> DataFrame:
    counts = R.typed_fields(inputs(spark, sf, "field_rows")).groupBy("data_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("type_name", D.type_name(F.col("data_type")))


# -- the same from text files: lines over several files, and a stream of them (S1, S2, S4, W5) --------------------------------


def _from_text(name: str, f: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[f"{name}_from_text"] = lambda spark, sf: f(parse_lines(read_lines(spark, export_files(spark, sf))))
    SQL[f"{name}_from_text"] = SQL[f"{name}_from_lines"]


_from_text("files", lambda e: R.files(e, e).select("number", "name", "global_root", "is_subfile"))
_from_text("fields", lambda e: R.fields(e).drop("line_no", "field_id"))
_from_text("cross_references", lambda e: R.cross_references(e).drop("execution"))


@query("SELECT g AS global_name, count(*) AS n, min(len(value)) AS shortest, max(len(value)) AS longest FROM parsed GROUP BY 1")
def entries_from_stream(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/quillgraph-stream-{uuid.uuid4().hex}"
    export = export_files(spark, sf)
    keep_up(stream_entries(spark, export, _at_once(len(_files(spark, export)))), lambda df, n: df.select("global_name", "value").write.mode("append").parquet(f"{folder}/entries"), f"{folder}/progress").awaitTermination()
    size = F.length("value").cast("bigint")
    return spark.read.parquet(f"{folder}/entries").groupBy("global_name").agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("shortest"), F.max(size).alias("longest"))


def _files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the text files of an export, in order."""
    return [n for n in commits.names(spark, folder) if n.startswith("part-")]


def _at_once(files: int) -> int:
    """Files of a batch of the stream: batches grow with the export, not their number."""
    return max(2, files // 2)


def _dropped(spark: SparkSession, sf: str, kind: str) -> tuple[DataFrame, int]:
    """Records, and in how many parts they are kept, after three drops of files: the last ones first, the first one late, and one of them twice under another name (but for cross-references, whose
    second definition is rightly another than the first where a header comes late)."""
    folder = f"{shared_dir(spark)}/quillgraph-stream-{uuid.uuid4().hex}"
    export = export_files(spark, sf)
    names = _files(spark, export)
    kept = KeptRecords(spark, folder, (kind,), max(4, len(names)))  # a part is kept by one task: as many parts as there are files
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source, target = Path(export), Path(f"{folder}/in")
    fs = source.getFileSystem(conf)
    with dealt_to(spark, kept.parts):  # a stream's session is as this one when it starts
        for drop in (names[2:], [names[1], *([f"{names[2]}-again"] if kind != "cross_references" else [])], names[:1]):
            for n in drop:
                spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, Path(source, n.removesuffix("-again")), fs, Path(target, n), False, conf)
            kept.follow(stream_lines(spark, f"{folder}/in", _at_once(len(names)))).awaitTermination()
    return kept.records(kind), kept.parts


def _from_stream(kind: str, f: Callable[[DataFrame, int], DataFrame]) -> None:
    QUERIES[f"{kind}_from_stream"] = lambda spark, sf: f(*_dropped(spark, sf, kind))
    SQL[f"{kind}_from_stream"] = SQL[f"{kind}_from_lines"]


_from_stream("files", lambda r, n: r.select("number", "name", "global_root", "is_subfile"))
_from_stream("cross_references", lambda r, n: r.drop("execution"))
# fields are told as often as they stand: once here, whatever stands twice
_from_stream("fields", lambda r, n: r.drop("line_no", "field_id").repartition(n, "file_number", "number").distinct())


_TOLD = {"Package": "packages", "File": "files", "Field": "fields", "CrossReference": "x", "CONTAINS_FILE": "contains_file", "CONTAINS_FIELD": "contains_field", "POINTS_TO": "points_to", "SUBFILE_OF": "subfile_of", "INDEXED_BY": "x JOIN fields d ON x.file_number = d.file_number AND x.field_number = d.number", "VARIABLE_POINTER": "v JOIN fields d ON v.file_number = d.file_number AND v.field_number = d.number JOIN files f ON f.number = v.target"}


@query(
    f"""WITH x AS (SELECT * FROM ({SQL["cross_references_from_lines"]})), v AS (SELECT {FILE_NUMBER} AS file_number, CAST(l_orderkey AS STRING) AS field_number, CAST(l_partkey AS STRING) AS target FROM {_LAST_LINES} l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '4-NOT SPECIFIED')
    """
    + " UNION ALL ".join(f"SELECT '{'edge' if n in EDGE_TYPES else 'node'}:{n}' AS name, count(*) AS rows FROM {t}" for n, t in _TOLD.items())
)
def graph_from_text(spark: SparkSession, sf: str) -> DataFrame:
    """A load in one go: export and package table as text files, parsed, derived and saved as a graph; rows written."""
    folder = f"{shared_dir(spark)}/quillgraph-load-{uuid.uuid4().hex}"
    with B.reading(spark, export_files(spark, sf)) as entries:
        told = B.store(folder, *B.records(spark, entries, package_file(spark, sf), export_files(spark, sf)), buckets=tasks(spark, sf))
    rows = [(("edge:" if k in EDGE_TYPES else "node:") + k, n) for k, n in told.items()]
    return spark.createDataFrame(rows, "name string, rows bigint")


# -- packages (S5, P21-P23, W3, J3, J16, A20, A24) ---------------------------------------------------------------------


@query(
    """SELECT p.name, 'D ' || p.name AS directory, (SELECT string_agg(prefix, ',' ORDER BY o, prefix) FROM (SELECT * FROM prefix_list x WHERE x.k = p.k)) AS prefixes, CASE WHEN p.k % 3 = 0 THEN CAST(p.k AS STRING) END AS vdl_id, CAST(40 * p.k AS STRING) AS files_low, CAST(40 * p.k + CASE WHEN p.k = 4 THEN 75 ELSE 34 END AS STRING) AS files_high,
    CAST(CASE WHEN p.k % 5 = 0 THEN 1 ELSE 0 END + CASE WHEN p.continued AND (p.k + 1) % 5 = 0 THEN 1 ELSE 0 END AS INT) AS n_numbers FROM packages p"""
)
def packages_from_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _packages(R.packages(inputs(spark, sf, "package_rows")))


def _packages(p: DataFrame) -> DataFrame:
    own = F.array_sort("first_prefixes")
    more = F.array_sort(F.slice("prefixes", F.size("first_prefixes") + 1, F.size("prefixes")))
    return p.select("name", "directory", F.array_join(F.concat(own, F.reverse(more)), ",").alias("prefixes"), "vdl_id", "files_low", "files_high", F.size("file_numbers").alias("n_numbers"))


SQL["packages_from_rows"] = SQL["packages_from_rows"].replace("ORDER BY o, prefix", "ORDER BY o, CASE WHEN o = 1 THEN prefix END, prefix DESC")


def packages_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    return _packages(R.packages(read_packages(spark, package_file(spark, sf))))


QUERIES["packages_from_csv"], SQL["packages_from_csv"] = packages_from_csv, SQL["packages_from_rows"]


@query("SELECT prefix, arg_max(name, k) AS name FROM prefix_list WHERE o = 1 GROUP BY prefix")
def package_by_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return B.package_by_prefix(R.packages(inputs(spark, sf, "package_rows")))


@query("SELECT DISTINCT prefix FROM prefix_list WHERE o = 1 ORDER BY prefix")
def all_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    return B.all_prefixes(R.packages(inputs(spark, sf, "package_rows")))


@query("SELECT (SELECT count(*) FROM packages) AS total_packages, (SELECT count(*) FROM prefix_list) AS total_prefixes, (SELECT count(DISTINCT prefix) FROM prefix_list WHERE o = 1) AS unique_prefixes, (SELECT count(*) FROM packages) AS packages_with_file_ranges, (SELECT count(*) FROM packages WHERE k % 3 = 0) AS packages_with_vdl_id")
def package_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return B.package_statistics(R.packages(inputs(spark, sf, "package_rows")))


@query("SELECT f.number, coalesce(d.name, r.name) AS package FROM files f LEFT JOIN direct d USING (number) LEFT JOIN ranged r USING (number)")
def package_of_file(spark: SparkSession, sf: str) -> DataFrame:
    return E.package_of(inputs(spark, sf, "files"), R.packages(inputs(spark, sf, "package_rows")))


#: Ranges of each supplier: some wide and nested, some equal (the first counts), some without an end, some the wrong way round, one single number.
_SPANS = """SELECT CAST(s_suppkey AS BIGINT) AS place, 'S' || CAST(s_suppkey AS STRING) AS name,
    CAST(CASE WHEN s_suppkey % 10 = 0 THEN 7 * s_suppkey ELSE 11 * s_suppkey + 0.5 END AS DOUBLE) AS low,
    CAST(CASE WHEN s_suppkey % 17 = 3 THEN 'Infinity' WHEN s_suppkey % 10 = 0 THEN CAST(7 * s_suppkey AS STRING) WHEN s_suppkey % 4 = 1 THEN CAST(1000000000000 - s_suppkey AS STRING) WHEN s_suppkey % 9 = 4 THEN '0' ELSE CAST(11 * s_suppkey + 3 * (s_suppkey % 40) AS STRING) END AS DOUBLE) AS high FROM {supplier} WHERE s_suppkey >= 3
    UNION ALL SELECT 100000 + s_suppkey, 'E' || CAST(s_suppkey AS STRING), CAST(11 * s_suppkey + 0.5 AS DOUBLE), CAST(11 * s_suppkey + 30 AS DOUBLE) FROM {supplier} WHERE s_suppkey % 2 = 0"""
_ASKED = "SELECT DISTINCT CAST(o_orderkey AS STRING) AS key, CAST(o_orderkey AS DOUBLE) / 2 AS n FROM {orders}"


@query(f"WITH s AS ({_SPANS.format(supplier='supplier')}) SELECT a.key, arg_min(s.name, s.place) AS name FROM ({_ASKED.format(orders='orders')}) a LEFT JOIN s ON a.n BETWEEN s.low AND s.high GROUP BY a.key")
def first_ranges(spark: SparkSession, sf: str) -> DataFrame:
    spans = spark.sql(_SPANS, supplier=spark.read.parquet(f"{sf}/supplier.parquet"))
    return first_range(spark.sql(_ASKED, orders=spark.read.parquet(f"{sf}/orders.parquet")), spans)


@query("SELECT p_partkey, array_to_string(list_filter(list_transform(regexp_split_to_array(p_name || ', ' || p_brand || ' n/a', '[,\\s]+'), lambda x: upper(x)), lambda x: x <> '' AND x <> 'N/A'), ',') AS prefixes FROM part")
def prefixes_of_parts(spark: SparkSession, sf: str) -> DataFrame:
    part = spark.read.parquet(f"{sf}/part.parquet")
    return part.select("p_partkey", F.array_join(prefixes(F.concat("p_name", F.lit(", "), "p_brand", F.lit(" n/a"))), ",").alias("prefixes"))


# -- edges (J1-J6, K5-K7) ------------------------------------------------------------------------------------------------


def _edge_query(name: str, sql: str, columns: list[str]) -> None:
    """Edges as they are built, not as saved."""
    whole = name in ("SUBFILE_OF", "INDEXED_BY", "VARIABLE_POINTER")
    QUERIES[f"edges_{name.lower()}"] = lambda spark, sf: sample_graph(spark, sf, whole).edges(name).select(*columns, "confidence")
    SQL[f"edges_{name.lower()}"] = _sql(sql)


_edge_query("CONTAINS_FILE", "SELECT src, dst, CAST(0.8 AS DOUBLE) AS confidence FROM contains_file", ["src", "dst"])
_edge_query("CONTAINS_FIELD", "SELECT src, dst, split_part(dst, ':', 2) AS field_number, CAST(1 AS DOUBLE) AS confidence FROM contains_field", ["src", "dst", "field_number"])
_edge_query("POINTS_TO", "SELECT src, dst, CAST(1 AS DOUBLE) AS confidence FROM points_to", ["src", "dst"])
_edge_query("SUBFILE_OF", "SELECT src, dst, CAST(NULL AS STRING) AS parent_field, CAST(len(string_split(src, '.')) AS INT) AS level, CAST(1 AS DOUBLE) AS confidence FROM subfile_of", ["src", "dst", "parent_field", "level"])
_edge_query("INDEXED_BY", "SELECT src, dst, name AS xref_name, xref_type, set_logic AS set_condition, CAST(NULL AS STRING) AS kill_condition, CAST(1 AS DOUBLE) AS confidence FROM indexed_by", ["src", "dst", "xref_name", "xref_type", "set_condition", "kill_condition"])
_edge_query("VARIABLE_POINTER", "SELECT src, dst, target_file, target_global, nullif(target_description, '') AS target_description, v_number, CAST(1 AS DOUBLE) AS confidence FROM variable_pointer", ["src", "dst", "target_file", "target_global", "target_description", "v_number"])

# -- upserts (K2, K6, K10-K12, P39) --------------------------------------------------------------------------------------


@query("SELECT xref_id, name, file_number, field_number, xref_type, xref_number, set_logic, kill_logic FROM xrefs")
def cross_reference_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    return cross_references(spark, sf).drop("execution")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_name END AS name FROM customer UNION ALL SELECT -1 - c_custkey, 'new' FROM customer WHERE c_custkey % 7 = 0")
def upsert_nodes(spark: SparkSession, sf: str) -> DataFrame:
    c = spark.read.parquet(f"{sf}/customer.parquet")
    new = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"), F.lit("new").alias("name")).unionByName(c.where("c_custkey % 7 = 0").select((-1 - F.col("c_custkey")).alias("id"), F.lit("new").alias("name")))
    return U.upsert(c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), new, ["id"], ["name"])


@query("SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'seen' ELSE 'old' END AS state FROM customer UNION ALL SELECT -1 - c_custkey, 'made', 'seen' FROM customer WHERE c_custkey % 7 = 0")
def upsert_some_columns(spark: SparkSession, sf: str) -> DataFrame:
    c = spark.read.parquet(f"{sf}/customer.parquet")
    made = lambda w, i: c.where(w).select(i.alias("id"), F.lit("made").alias("name"), F.lit("seen").alias("state"))
    new = made("c_custkey % 3 = 0", F.col("c_custkey")).unionByName(made("c_custkey % 7 = 0", -1 - F.col("c_custkey")))
    return U.upsert_columns(c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("old").alias("state")), new, ["id"], ["state"], ["name"])


#: New rows fall into 2 of 16 parts.
_PARTED = "c_custkey % 16 IN (3, 7) AND c_custkey % 3 = 0"


@query(f"""SELECT CAST(c_custkey % 16 AS INT) AS part, count(*) + count(*) FILTER ({_PARTED}) AS n, count(*) FILTER ({_PARTED}) AS n_new, count(*) FILTER ({_PARTED}) AS n_added, c_custkey % 16 NOT IN (3, 7) AS as_it_was FROM customer GROUP BY 1, 5""")
def upsert_by_part(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each part of a table after an upsert, those of them that are new or changed, and whether its files stayed as they were (K2, K6)."""
    folder = f"{shared_dir(spark)}/quillgraph-keyed-{uuid.uuid4().hex}"
    table = Keyed(spark, folder, ("id",), 16, lambda: F.abs("id") % 16)
    c = spark.read.parquet(f"{sf}/customer.parquet")
    table.upsert(c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit(0).alias("seen")), ["seen"])
    before = table.part_numbers()
    some = c.where(_PARTED).select(F.col("c_custkey").alias("id"), F.lit("new").alias("name"), F.lit(1).alias("seen"))
    added = some.select((-F.col("id")).alias("id"), F.lit("added").alias("name"), "seen")
    table.upsert(some.unionByName(added).unionByName(some.withColumns({"name": F.lit("older"), "seen": F.lit(0)})), ["seen"])
    same = spark.createDataFrame([(p, before[p] == v) for p, v in table.part_numbers().items()], "part int, as_it_was boolean")
    told = table.read().groupBy((F.abs("id") % 16).cast("int").alias("part")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("name") == "new").alias("n_new"), F.count_if(F.col("name") == "added").alias("n_added"))
    return told.join(F.broadcast(same), "part")


@query("SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2")
def drop_repeats(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey")
    return U.drop_repeats(rows, ["l_orderkey", "l_linenumber"], ["l_partkey"])


@query("SELECT count(*) AS repeated_keys, (SELECT count(DISTINCT xref_id) FROM xref_rows) AS keys FROM (SELECT xref_id FROM xref_rows GROUP BY 1 HAVING count(*) > 1)")
def repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs(spark, sf, "xref_rows").select("xref_id")
    return rows.groupBy("xref_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("repeated_keys"), F.count(F.lit(1)).alias("keys"))


@query("SELECT src, dst, count(*) AS n FROM variable_pointer GROUP BY 1, 2 HAVING count(*) > 1")
def parallel_edges(spark: SparkSession, sf: str) -> DataFrame:
    return U.repeat_groups(sample_graph(spark, sf).edges("VARIABLE_POINTER"), ["src", "dst"]).withColumnRenamed("count", "n")


@query("SELECT DISTINCT src, dst FROM variable_pointer")
def merged_edges(spark: SparkSession, sf: str) -> DataFrame:
    return U.merge_edges(sample_graph(spark, sf).edges("VARIABLE_POINTER"), ["v_number"]).select("src", "dst")


@query("SELECT count(*) AS first, CAST(count(*) + count(*) FILTER (s_suppkey % 2 = 0) AS BIGINT) AS both, true AS cleared FROM supplier")
def append_and_clear(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends to a directory, told by what each has written and what is read then, and the directory cleared (K1, K9)."""
    folder = f"{shared_dir(spark)}/quillgraph-append-{uuid.uuid4().hex}"
    rows = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey")
    first, more = U.append(rows, folder), U.append(rows.where("s_suppkey % 2 = 0"), folder)
    both = spark.read.parquet(folder).count()
    return spark.createDataFrame([(first, both if both == first + more else -1, U.clear(spark, folder))], "first bigint, both bigint, cleared boolean")


@query("SELECT * FROM (VALUES ('an unknown edge type', true), ('an unknown label', true), ('phase 2 without files', true), ('a property that a label lacks', true), ('a path that is not there', true), ('a depth that is no number', true)) AS t(what, refused)")
def refusals(spark: SparkSession, sf: str) -> DataFrame:
    """What is refused before any row is read (K8, V3, V4, T1)."""
    g = saved_graph(spark, sf)
    empty = Graph(spark, {n: g.nodes(n).limit(0) for n in ("File", "Field")})

    def refuses(f: Callable[[], object]) -> bool:
        try:
            f()
        except ValueError:
            return True
        return False

    told = [
        ("an unknown edge type", refuses(lambda: g.edges("BELONGS_TO_PACKAGE"))),
        ("an unknown label", refuses(lambda: g.nodes("Nothing"))),
        ("phase 2 without files", refuses(lambda: B.enrich(empty, None, None))),
        ("a property that a label lacks", refuses(lambda: Q.find(g, "File", "nothing", 1))),
        ("a path that is not there", bool(Settings(dictionary=f"{sf}/none", packages=f"{sf}/customer.parquet").missing())),
        ("a depth that is no number", refuses(lambda: Q.pointer_chain(g, None, 0))),
    ]
    return spark.createDataFrame(told, "what string, refused boolean")


@query("SELECT CAST(s_suppkey // 10 AS BIGINT) AS batch, count(*) AS n FROM supplier GROUP BY 1")
def batches(spark: SparkSession, sf: str) -> DataFrame:
    return U.batches(spark.read.parquet(f"{sf}/supplier.parquet"), 10, ["s_suppkey"]).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


# -- counts and catalog (A1-A6, G2-G5, S6-S8) ------------------------------------------------------------------------------

_graph_query("count_nodes", lambda g: g.node_count(), "SELECT count(*) AS count FROM all_nodes")
_graph_query("count_fields", lambda g: g.node_count("Field"), "SELECT count(*) AS count FROM fields")
_graph_query("count_edges", lambda g: g.edge_count(), "SELECT count(*) AS count FROM all_edges")
_graph_query("count_points_to", lambda g: g.edge_count("POINTS_TO"), "SELECT count(*) AS count FROM points_to")
_graph_query("count_by_label", lambda g: g.count_by_label(), "SELECT label, count(*) AS count FROM all_nodes GROUP BY 1")
_graph_query("count_by_type", lambda g: g.count_by_type(), "SELECT type, count(*) AS count FROM all_edges GROUP BY 1")
_graph_query("all_node_keys", lambda g: g.all_nodes(), "SELECT label, key FROM all_nodes")
_graph_query("all_edge_ends", lambda g: g.all_edges(), "SELECT type, src, dst FROM all_edges")
_graph_query("key_repeats", lambda g: g.key_repeats(), "SELECT label, count(*) FILTER (n > 1) AS repeats FROM (SELECT label, key, count(*) AS n FROM all_nodes GROUP BY 1, 2) GROUP BY 1")
_graph_query("bad_confidence", lambda g: g.bad_confidence(), "SELECT type, CAST(0 AS BIGINT) AS bad FROM all_edges GROUP BY 1")
_graph_query("graph_info", lambda g: g.info(), "WITH i AS (SELECT 'node' AS kind, label AS name, count(*) AS count FROM all_nodes GROUP BY 2 UNION ALL SELECT 'edge', type, count(*) FROM all_edges GROUP BY 2) SELECT * FROM i UNION ALL SELECT kind, 'total', CAST(sum(count) AS BIGINT) FROM i GROUP BY 1".replace("WITH i AS (", "SELECT * FROM (WITH i AS (").replace("GROUP BY 1", "GROUP BY 1)"))
_graph_query(
    "graph_statistics",
    lambda g: g.statistics().select(*[F.array_join(F.transform(c, lambda x: F.concat_ws("=", x["name"], x["count"].cast("string"))), ",").alias(c) for c in ("nodes", "edges")], "total_nodes", "total_edges"),
    "SELECT (SELECT string_agg(label || '=' || n, ',' ORDER BY label) FROM (SELECT label, count(*) AS n FROM all_nodes GROUP BY 1)) AS nodes, (SELECT string_agg(type || '=' || n, ',' ORDER BY type) FROM (SELECT type, count(*) AS n FROM all_edges GROUP BY 1)) AS edges, (SELECT count(*) FROM all_nodes) AS total_nodes, (SELECT count(*) FROM all_edges) AS total_edges",
)
_graph_query("connections", lambda g: g.connections(), "SELECT * FROM (VALUES ('Package', 'CONTAINS_FILE', 'File'), ('File', 'CONTAINS_FIELD', 'Field'), ('Field', 'POINTS_TO', 'File'), ('File', 'SUBFILE_OF', 'File'), ('Field', 'INDEXED_BY', 'CrossReference'), ('Field', 'VARIABLE_POINTER', 'File')) AS t(from_label, type, to_label)")



@query("SELECT 'node:' || label AS name, count(*) AS rows FROM all_nodes GROUP BY 1 UNION ALL SELECT 'edge:' || type, count(*) FROM all_edges GROUP BY 1")
def written_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that the save of the graph has written (A21); the first question to the graph of some tables saves it."""
    rows = [(("edge:" if k in EDGE_TYPES else "node:") + k, n) for k, n in counts_written(spark, sf).items()]
    return spark.createDataFrame(rows, "name string, rows bigint")


_graph_query(
    "graph_schema",
    lambda g: g.schema().where("name IN ('File', 'Package', 'CONTAINS_FILE')").select("kind", "name", F.col("column").alias("attribute"), F.col("dtype").alias("kind_of_value")),
    """SELECT * FROM (VALUES ('node', 'File', 'number', 'string'), ('node', 'File', 'name', 'string'), ('node', 'File', 'global_root', 'string'), ('node', 'File', 'parent_file', 'string'), ('node', 'File', 'is_subfile', 'boolean'),
    ('node', 'Package', 'file_no', 'bigint'), ('node', 'Package', 'name', 'string'), ('node', 'Package', 'directory', 'string'), ('node', 'Package', 'prefixes', 'array<string>'), ('node', 'Package', 'vdl_id', 'string'), ('node', 'Package', 'files_low', 'string'),
    ('node', 'Package', 'files_high', 'string'), ('node', 'Package', 'file_numbers', 'array<string>'), ('node', 'Package', 'first_prefixes', 'array<string>'), ('edge', 'CONTAINS_FILE', 'src', 'string'), ('edge', 'CONTAINS_FILE', 'dst', 'string'), ('edge', 'CONTAINS_FILE', 'confidence', 'double')) AS t(kind, name, attribute, kind_of_value)""",
)


def _faulty(spark: SparkSession, sf: str) -> Graph:
    """Files that stand twice, and containment whose confidence is out of its range at times."""
    g, n = saved_graph(spark, sf), F.expr("CAST(split_part(number, '.', 1) AS BIGINT)")
    files = g.nodes("File")
    edges = g.edges("CONTAINS_FILE").withColumn("confidence", F.when(F.col("dst").endswith("5"), 1.5).when(F.col("dst").endswith("1"), -0.25).otherwise(F.col("confidence")))
    return Graph(spark, {"File": files.unionByName(files.where(n % 20 == 0))}, {"CONTAINS_FILE": edges, "POINTS_TO": g.edges("POINTS_TO")})


@query("SELECT 'File' AS label, count(*) AS repeats FROM files WHERE CAST(split_part(number, '.', 1) AS BIGINT) % 20 = 0")
def faulty_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _faulty(spark, sf).key_repeats()


@query("SELECT 'CONTAINS_FILE' AS type, count(*) FILTER (ends_with(dst, '5') OR ends_with(dst, '1')) AS bad FROM contains_file UNION ALL SELECT 'POINTS_TO', CAST(0 AS BIGINT)")
def faulty_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return _faulty(spark, sf).bad_confidence()


@query("SELECT CAST(1 AS BIGINT) AS test")
def ping(spark: SparkSession, sf: str) -> DataFrame:
    return spark.range(1).select((F.col("id") + 1).alias("test"))


# -- filters and lookups (F1-F6, F11) ------------------------------------------------------------------------------------------

_graph_query("find_file", lambda g: Q.find(g, "File", "number", "10").select("number", "name"), "SELECT number, name FROM files WHERE number = '10'")
_graph_query("find_fields", lambda g: Q.find(g, "Field", "data_type", "P").select("file_number", "number"), "SELECT file_number, number FROM fields WHERE data_type = 'P'")
_graph_query("subfile_numbers", lambda g: g.nodes("File").where(F.col("number").contains(".")).select("number", D.nesting_level(F.col("number")).alias("level")), "SELECT number, CAST(len(string_split(number, '.')) AS INT) AS level FROM files WHERE contains(number, '.')")

# -- questions (J9-J15, A7-A18, O1-O10) ----------------------------------------------------------------------------------------

_graph_query("orphan_files", Q.orphan_files, "SELECT number, name FROM files WHERE number NOT IN (SELECT dst FROM contains_file)")
_graph_query("dangling_pointers", Q.dangling_pointers, "SELECT file_number, number, name, target_file FROM fields WHERE is_pointer AND field_id NOT IN (SELECT src FROM points_to)")
_join = lambda c, *fs: F.array_join(F.transform(c, lambda x: F.concat_ws("|", *[x[f] for f in fs])), ",")
_graph_query(
    "file_with_fields",
    lambda g: Q.file_with_fields(g).select("number", "name", F.size("fields").alias("n"), _join("fields", "f_number", "f_name", "data_type").alias("fields")),
    "SELECT f.number, f.name, CAST(count(d.number) AS INT) AS n, coalesce(string_agg(d.number || '|' || d.name || '|' || d.data_type, ',' ORDER BY d.number), '') AS fields FROM files f LEFT JOIN fields d ON d.file_number = f.number GROUP BY 1, 2",
)
_graph_query(
    "package_with_files",
    lambda g: Q.package_with_files(g).select("name", F.size("files").alias("n"), _join("files", "number", "file_name").alias("files")),
    "SELECT p.name, CAST(count(c.dst) AS INT) AS n, coalesce(string_agg(f.number || '|' || f.name, ',' ORDER BY f.number), '') AS files FROM packages p LEFT JOIN contains_file c ON c.src = p.name LEFT JOIN files f ON f.number = c.dst GROUP BY 1",
)
_graph_query(
    "some_packages_with_files",
    lambda g: Q.package_with_files(g).select("name", F.size("files").alias("n")).orderBy("name").limit(5),
    "SELECT p.name, CAST(count(c.dst) AS INT) AS n FROM packages p LEFT JOIN contains_file c ON c.src = p.name GROUP BY 1 ORDER BY 1 LIMIT 5",
)
_graph_query("file_dependencies", Q.file_dependencies, "SELECT h.src AS file_number, h.dst AS target, f.name AS target_name, count(*) AS reference_count FROM hops h JOIN files f ON f.number = h.dst GROUP BY 1, 2, 3")
_graph_query("file_dependents", Q.file_dependents, "SELECT h.dst AS target, h.src AS file_number, f.name AS file_name, count(*) AS reference_count FROM hops h JOIN files f ON f.number = h.src GROUP BY 1, 2, 3")
_graph_query("dependents_of_one", lambda g: Q.file_dependents(g, "10"), "SELECT h.dst AS target, h.src AS file_number, f.name AS file_name, count(*) AS reference_count FROM hops h JOIN files f ON f.number = h.src WHERE h.dst = '10' GROUP BY 1, 2, 3")
_graph_query(
    "field_cross_references",
    lambda g: Q.field_cross_references(g).select("field_id", "name", F.size("cross_references").alias("n"), _join("cross_references", "x_name", "x_type", "set_logic").alias("xrefs")),
    "SELECT d.field_id, d.name, CAST(greatest(count(i.dst), 1) AS INT) AS n, coalesce(string_agg(i.name || '|' || i.xref_type || coalesce('|' || i.set_logic, ''), ',' ORDER BY i.name, i.xref_type, i.set_logic NULLS FIRST), '') AS xrefs FROM fields d LEFT JOIN indexed_by i ON i.src = d.field_id GROUP BY 1, 2",
)
_graph_query(
    "variable_pointer_targets",
    lambda g: Q.variable_pointer_targets(g).select("field_name", F.size("targets").alias("n"), _join("targets", "file", "name", "global", "description").alias("targets")),
    "SELECT d.name AS field_name, CAST(count(*) AS INT) AS n, string_agg(v.dst || '|' || f.name || '|' || v.target_global || coalesce('|' || nullif(v.target_description, ''), ''), ',' ORDER BY v.dst, f.name, v.target_global, nullif(v.target_description, '') NULLS FIRST) AS targets FROM variable_pointer v JOIN fields d ON d.field_id = v.src JOIN files f ON f.number = v.dst GROUP BY 1",
)
_graph_query("xrefs_by_file", Q.xrefs_by_file, "SELECT file_number, count(*) AS xref_count FROM xrefs GROUP BY 1")
_graph_query("most_indexed_fields", Q.most_indexed_fields, "SELECT d.file_number, d.number AS field_number, d.name AS field_name, count(*) AS xref_count FROM indexed_by i JOIN fields d ON d.field_id = i.src GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2 LIMIT 20")
_graph_query("files_with_most_fields", Q.files_with_most_fields, "SELECT f.number, f.name, count(*) AS field_count FROM contains_field c JOIN files f ON f.number = c.src GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10")
_graph_query("most_referenced_files", Q.most_referenced_files, "SELECT f.number, f.name, count(*) AS reference_count FROM points_to c JOIN files f ON f.number = c.dst GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10")
_graph_query("check_minima", Q.check_minima, "SELECT t.type, CAST(t.e AS BIGINT) AS expected, count(a.src) AS actual, CASE WHEN count(a.src) >= t.e THEN 'PASS' ELSE 'FAIL' END AS status FROM (VALUES ('INDEXED_BY', 100), ('SUBFILE_OF', 10), ('VARIABLE_POINTER', 1)) AS t(type, e) LEFT JOIN all_edges a ON a.type = t.type GROUP BY t.type, t.e")
_graph_query(
    "validation",
    Q.validate,
    """SELECT 'node:' || label AS measure, count(*) AS value FROM all_nodes GROUP BY 1 UNION ALL SELECT 'edge:' || type, count(*) FROM all_edges GROUP BY 1 UNION ALL SELECT 'node:total', count(*) FROM all_nodes UNION ALL SELECT 'edge:total', count(*) FROM all_edges
    UNION ALL SELECT 'orphan_files', count(*) FROM files WHERE number NOT IN (SELECT dst FROM contains_file) UNION ALL SELECT 'dangling_pointers', count(*) FROM fields WHERE is_pointer AND field_id NOT IN (SELECT src FROM points_to)""",
)

# -- traversals (T1-T6, D14, D18) ----------------------------------------------------------------------------------------------

_graph_query("find_subfiles", Q.find_subfiles, "SELECT s.dst AS parent_number, s.src AS child_number, f.name AS child_name, CAST(len(string_split(s.src, '.')) AS INT) AS level FROM subfile_of s JOIN files f ON f.number = s.src")
_graph_query("pointer_chain", lambda g: Q.pointer_chain(g).select("start", "node", "hops"), "SELECT src AS start, dst AS node, CAST(1 AS INT) AS hops FROM points_to")
_graph_query("subfile_paths", lambda g: Q.subfile_paths(g).select("start", "node", "hops", F.array_join("nodes", ">").alias("nodes")), "SELECT dst AS start, src AS node, CAST(1 AS INT) AS hops, dst || '>' || src AS nodes FROM subfile_of")
_graph_query("ancestors", lambda g: Q.ancestors(g).select("start", "node", "hops"), "SELECT src AS start, dst AS node, CAST(1 AS INT) AS hops FROM subfile_of")
_graph_query("subfile_counts", Q.subfile_counts, "SELECT f.number AS root_file, f.name AS root_name, count(s.src) AS subfile_count FROM files f LEFT JOIN subfile_of s ON s.dst = f.number WHERE f.number NOT IN (SELECT src FROM subfile_of) GROUP BY 1, 2")
_graph_query(
    "three_file_flow",
    lambda g: Q.file_flow(g, g.nodes("File").select(F.col("number").alias("node")), 2).groupBy("hops", "node").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("start").alias("starts")),
    "SELECT CAST(1 AS INT) AS hops, dst AS node, count(*) AS n, count(DISTINCT src) AS starts FROM hops GROUP BY dst UNION ALL SELECT 2, b.dst, count(*), count(DISTINCT a.src) FROM hops a JOIN hops b ON a.dst = b.src AND a.field <> b.field GROUP BY b.dst",
)
_graph_query(
    "pointer_cycles",
    lambda g: W.cycles(Q.file_flow(g, g.nodes("File").select(F.col("number").alias("node")), 1).select(F.get("edge_ids", 0).alias("edge_id"), F.col("start").alias("src"), F.col("node").alias("dst")), 2),
    "SELECT node, CAST(min(h) AS INT) AS hops FROM (SELECT src AS node, 1 AS h FROM hops WHERE src = dst UNION ALL SELECT a.src, 2 FROM hops a JOIN hops b ON a.dst = b.src AND b.dst = a.src AND a.field <> b.field) GROUP BY 1",
)

# -- traversals of any depth, on files whose parents have parents, and cycles of three (T1-T4, A15, D18) ------------------------

_DEEP = "SELECT CAST(c_custkey AS STRING) AS src, CAST(c_custkey // 3 AS STRING) AS dst FROM customer WHERE c_custkey >= 3"
_DOWN = f"WITH RECURSIVE e AS ({_DEEP}), w AS (SELECT dst AS start, src AS node, 1 AS hops, dst || '>' || src AS nodes FROM e UNION ALL SELECT w.start, e.src, w.hops + 1, w.nodes || '>' || e.src FROM w JOIN e ON e.dst = w.node)"


def _deep(spark: SparkSession, sf: str) -> Graph:
    c = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("k"), "c_name")
    edges = c.where("k >= 3").select(F.col("k").cast("string").alias("src"), F.floor(F.col("k") / 3).cast("string").alias("dst"), F.lit(1.0).alias("confidence"))
    return Graph(spark, {"File": c.select(F.col("k").cast("string").alias("number"), F.col("c_name").alias("name"))}, {"SUBFILE_OF": edges})


def deep_subfile_paths(spark: SparkSession, sf: str) -> DataFrame:
    return Q.subfile_paths(_deep(spark, sf)).select("start", "node", "hops", F.array_join("nodes", ">").alias("nodes"))


def deep_ancestors(spark: SparkSession, sf: str) -> DataFrame:
    return Q.ancestors(_deep(spark, sf)).select("start", "node", "hops")


def deep_subfile_counts(spark: SparkSession, sf: str) -> DataFrame:
    return Q.subfile_counts(_deep(spark, sf))


for _f, _body in (
    (deep_subfile_paths, f"{_DOWN} SELECT start, node, CAST(hops AS INT) AS hops, nodes FROM w"),
    (deep_ancestors, f"{_DOWN} SELECT node AS start, start AS node, CAST(hops AS INT) AS hops FROM w"),
    (deep_subfile_counts, f"{_DOWN} SELECT CAST(c_custkey AS STRING) AS root_file, c_name AS root_name, (SELECT count(*) FROM w WHERE start = CAST(c_custkey AS STRING)) AS subfile_count FROM customer WHERE c_custkey < 3"),
):
    QUERIES[_f.__name__], SQL[_f.__name__] = _f, _body


_RING = "SELECT CAST(s_suppkey AS STRING) AS src, CAST(CASE WHEN s_suppkey % 3 = 2 AND s_suppkey % 4 <> 0 THEN s_suppkey - 2 ELSE s_suppkey + 1 END AS STRING) AS dst FROM {supplier}"


@query(f"WITH e AS ({_RING.format(supplier='supplier')}) SELECT DISTINCT a.src AS node, CAST(3 AS INT) AS hops FROM e a JOIN e b ON a.dst = b.src JOIN e c ON b.dst = c.src AND c.dst = a.src")
def cycles_of_three(spark: SparkSession, sf: str) -> DataFrame:
    edges = spark.sql(_RING, supplier=spark.read.parquet(f"{sf}/supplier.parquet"))
    return W.cycles(edges.select(F.concat_ws(">", "src", "dst").alias("edge_id"), "src", "dst"), 3)


# -- circles of any length, counts without paths, neighbourhoods (D18, T2-T4, T6, A15) ----------------------------------------------

#: What leads to what over any number of hops, and the component of each node: those that lead to it and to which it leads.
_REACH = "SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM r JOIN e ON e.src = r.dst"
_COMPONENTS = "SELECT n.node, least(n.node, coalesce(min(a.dst), n.node)) AS component, greatest(count(DISTINCT a.dst), 1) AS size, count(a.dst) > 0 AS circular FROM n LEFT JOIN (SELECT a.src, a.dst FROM r a JOIN r b ON a.src = b.dst AND a.dst = b.src) a ON a.src = n.node GROUP BY n.node"

_graph_query(
    "pointer_components",
    Q.pointer_components,
    f"SELECT node AS number, component, size, circular FROM (WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM hops), n AS (SELECT number AS node FROM files), r AS ({_REACH}) {_COMPONENTS})",
)
_graph_query(
    "circular_dependencies",
    Q.circular_dependencies,
    f"SELECT component, size, string_agg(node, ',' ORDER BY node) AS files FROM (WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM hops), n AS (SELECT number AS node FROM files), r AS ({_REACH}) {_COMPONENTS}) WHERE circular GROUP BY 1, 2",
)
#: Suppliers in rings of 40, some with a chord, with tails that lead in and out and that belong to none.
_RINGS = "SELECT s_suppkey AS s, CASE WHEN s_suppkey % 40 = 39 THEN s_suppkey - 39 ELSE s_suppkey + 1 END AS t FROM {supplier} WHERE s_suppkey < 80 UNION ALL SELECT s_suppkey, s_suppkey - 5 FROM {supplier} WHERE s_suppkey % 40 = 20 UNION ALL SELECT s_suppkey, s_suppkey - 1 FROM {supplier} WHERE s_suppkey > 80 UNION ALL SELECT s_suppkey, s_suppkey FROM {supplier} WHERE s_suppkey % 10 = 7 UNION ALL SELECT 39, 40"
_TEXT_RINGS = f"SELECT CAST(s AS STRING) AS src, CAST(t AS STRING) AS dst FROM ({_RINGS})"


@query(f"WITH RECURSIVE e AS (SELECT DISTINCT * FROM ({_TEXT_RINGS.format(supplier='supplier')})), n AS (SELECT CAST(s_suppkey AS STRING) AS node FROM supplier), r AS ({_REACH}) {_COMPONENTS}")
def ring_components(spark: SparkSession, sf: str) -> DataFrame:
    supplier = spark.read.parquet(f"{sf}/supplier.parquet")
    return strong_components(supplier.select(F.col("s_suppkey").cast("string").alias("node")), spark.sql(_TEXT_RINGS, supplier=supplier))


def deep_descendant_counts(spark: SparkSession, sf: str) -> DataFrame:
    return Q.descendant_counts(_deep(spark, sf))


def deep_ancestor_counts(spark: SparkSession, sf: str) -> DataFrame:
    return Q.ancestor_counts(_deep(spark, sf))


for _f, _body in (
    (deep_descendant_counts, f"{_DOWN} SELECT start AS number, count(*) AS descendants, CAST(max(hops) AS INT) AS deepest FROM w GROUP BY 1"),
    (deep_ancestor_counts, f"{_DOWN} SELECT node AS number, count(*) AS ancestors FROM w GROUP BY 1"),
):
    QUERIES[_f.__name__], SQL[_f.__name__] = _f, _body

_WAYS = " UNION ALL ".join(f"SELECT '{t.source}' || chr(1) || src AS a, '{t.target}' || chr(1) || dst AS b FROM {n.lower()}" for n, t in EDGE_TYPES.items() if n.lower() in _RECORDS)


def _near(name: str, label: str, key: str, hops: int) -> None:
    start = f"'{label}' || chr(1) || '{key}'"
    _graph_query(
        name,
        lambda g: Q.neighbourhood(g, label, key, hops),
        f"SELECT split_part(node, chr(1), 1) AS label, split_part(node, chr(1), 2) AS key, CAST(hops AS INT) AS hops FROM (WITH RECURSIVE one AS ({_WAYS}), w AS (SELECT a, b FROM one UNION SELECT b, a FROM one), r AS (SELECT {start} AS node, 0 AS hops UNION SELECT w.b, r.hops + 1 FROM r JOIN w ON w.a = r.node WHERE r.hops < {hops}) SELECT node, min(hops) AS hops FROM r GROUP BY node)",
    )


_near("neighbourhood", "File", "10", 2)
_near("wide_neighbourhood", "Package", "NATION_1", 4)

# -- further reports (D10-D12, D15, D16, D19, D20) -------------------------------------------------------------------------------

_graph_query("file_structure", Q.file_structure, "SELECT d.file_number, d.number, d.name, d.data_type, f.name AS target_name FROM fields d JOIN files o ON o.number = d.file_number LEFT JOIN files f ON f.number = d.target_file")
_graph_query("required_or_linked", Q.required_or_linked, "SELECT file_number, number, name, data_type FROM fields WHERE required OR data_type IN ('P', 'V')")
_graph_query(
    "impact",
    Q.impact,
    "SELECT f.number, f.name, (SELECT count(*) FROM contains_field c WHERE c.src = f.number) AS fields, (SELECT count(*) FROM points_to p WHERE p.dst = f.number) AS pointing_fields, (SELECT count(DISTINCT h.src) FROM hops h WHERE h.dst = f.number) AS pointing_files, (SELECT count(*) FROM subfile_of s WHERE s.dst = f.number) AS subfiles FROM files f",
)
_graph_query("fan_in_out", lambda g: Q.degree(g, ["CONTAINS_FIELD", "POINTS_TO"]), "SELECT key, CAST(sum(o) AS BIGINT) AS fan_out, CAST(sum(i) AS BIGINT) AS fan_in FROM (SELECT src AS key, 1 AS o, 0 AS i FROM all_edges WHERE type IN ('CONTAINS_FIELD', 'POINTS_TO') UNION ALL SELECT dst, 0, 1 FROM all_edges WHERE type IN ('CONTAINS_FIELD', 'POINTS_TO')) GROUP BY 1")
_graph_query("subfiles_by_parent", Q.subfiles_by_parent, "SELECT dst AS parent, count(*) AS n, string_agg(src, ',' ORDER BY src) AS children FROM subfile_of GROUP BY 1")
_graph_query("missing_parents", lambda g: Q.missing_parents(_without_tens(g)), "SELECT DISTINCT split_part(number, '.', 1) AS number, 'FILE_' || split_part(number, '.', 1) AS name, CAST(0.5 AS DOUBLE) AS confidence FROM files WHERE contains(number, '.') AND split_part(number, '.', 1) LIKE '%0'")
#: Targets of variable pointers, some of them no numbers.
_ODD = "CASE WHEN CAST(v_number AS INT) = 3 THEN 'X' || target_file ELSE target_file END"


@query(
    f"""WITH f AS (SELECT * FROM files WHERE number NOT LIKE '%0' OR contains(number, '.')), t AS (SELECT file_number, field_number, {_ODD} AS target FROM target_rows)
    SELECT 'SUBFILE_OF' AS type, number AS src, split_part(number, '.', 1) AS dst, CAST(0.5 AS DOUBLE) AS confidence FROM f WHERE contains(number, '.') AND split_part(number, '.', 1) LIKE '%0'
    UNION ALL SELECT 'VARIABLE_POINTER', d.field_id, t.target, 0.5 FROM t JOIN fields d ON t.file_number = d.file_number AND t.field_number = d.number WHERE t.target NOT IN (SELECT number FROM f)"""
)
def edges_to_placeholders(spark: SparkSession, sf: str) -> DataFrame:
    """What leads to files that aren't there, after these have got stand-ins (D20)."""
    g = _without_tens(saved_graph(spark, sf))
    whole = B.with_placeholders(Graph(spark, g.node_frames), inputs(spark, sf, "target_rows").withColumn("target_file", F.expr(_ODD)).withColumn("line_no", F.lit(0)))
    ends = [whole.edges(n).select(F.lit(n).alias("type"), "src", "dst", "confidence") for n in ("SUBFILE_OF", "VARIABLE_POINTER")]
    stand_ins = whole.nodes("File").where(F.col("global_root").isNull() & (F.col("name") == F.concat(F.lit("FILE_"), "number"))).select(F.col("number").alias("dst"))
    return ends[0].unionByName(ends[1]).join(stand_ins, "dst", "left_semi")


_graph_query(
    "migration",
    Q.migration,
    """SELECT c.src AS package, count(DISTINCT c.dst) AS files, count(DISTINCT h.dst) AS fields, count(DISTINCT i.dst) AS xrefs, (SELECT count(*) FROM contains_file o WHERE o.src = c.src AND o.dst NOT IN (SELECT p.dst FROM hops p JOIN contains_file a ON a.dst = p.src JOIN contains_file b ON b.dst = p.dst WHERE a.src <> b.src)) AS free_files
    FROM contains_file c LEFT JOIN contains_field h ON h.src = c.dst LEFT JOIN indexed_by i ON i.src = h.dst GROUP BY 1""",
)


def _without_tens(graph: Graph) -> Graph:
    """The graph without the files whose number ends in 0."""
    return Graph(graph.spark, graph.node_frames | {"File": graph.nodes("File").where(~F.col("number").endswith("0") | F.col("number").contains("."))}, graph.edge_frames)


# -- routine sources (D1-D9, D13, D17), here over documents and rendered sources ------------------------------------------------

#: A source of each customer: a header, patches, an entry point that calls the routine of another customer or its own, and a second label.
_CALLED = "CASE WHEN c_custkey % 4 = 1 THEN c_custkey ELSE 7 * (c_custkey // 7) + 1 END"
_NAME = "CASE WHEN {k} % 3 = 0 THEN 'N' ELSE 'Y' END || CAST({k} AS STRING)"
_SOURCE = f"""'R' || CAST(c_custkey % 97 AS STRING) || 'X ;; header' || chr(10) || ' ;;' || CAST(c_custkey % 7 AS STRING) || '.0;KIT;' || CASE WHEN c_custkey % 5 = 0 THEN '**' || CAST(c_custkey AS STRING) || ',9**;' ELSE '' END || 'Aug' || chr(10)
    || 'EN' || CAST(c_custkey AS STRING) || '(A,B) ;start' || chr(10) || ' S X=' || CAST(c_custkey AS STRING) || ' D TAG^' || {_NAME.format(k=f'({_CALLED})')} || '(2,0) ;set [a] 20240131' || chr(10) || ' Q $$F("A") D EN' || CAST(c_custkey + 2 AS STRING) || '^NOWHERE' || chr(10) || CASE WHEN c_custkey % 2 = 0 THEN 'ZAG ; note' ELSE 'TAG' END || chr(10) || ' S ^DPT(1)="Ab",^DIC(2)=3 Q 1'"""
_SOURCES = f"SELECT c_custkey AS k, {_NAME.format(k='c_custkey')} AS routine, {_SOURCE} AS text FROM customer"
_OWNED = "SELECT s.routine, arg_max(p.name, length(p.prefix)) AS package, arg_max(p.prefix, length(p.prefix)) AS prefix FROM s JOIN (SELECT prefix, arg_max(name, k) AS name FROM prefix_list WHERE o = 1 GROUP BY prefix) p ON starts_with(s.routine, p.prefix) GROUP BY 1"


def _sources(spark: SparkSession, sf: str) -> DataFrame:
    # a few MB of the table make much work: rows are dealt to as many tasks as a shuffle has, where the splits of so small a file would be one or two
    customer = spark.read.parquet(f"{sf}/customer.parquet").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    texts = spark.sql(_SOURCES.replace("FROM customer", "FROM {customer}").replace("//", "div"), customer=customer)
    return M.lines_of(texts)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return M.lines_of(docs.select(F.col("doc_id").cast("string").alias("routine"), "text"))


@query(
    f"""WITH s AS ({_SOURCES}) SELECT routine, 'EN' || k AS label, CAST(3 AS INT) AS line_no, 'A|B' AS parameters, 'start' AS comment, true AS is_entry_point, true AS is_function FROM s
    UNION ALL SELECT routine, CASE WHEN k % 2 = 0 THEN 'ZAG' ELSE 'TAG' END, 6, '', CASE WHEN k % 2 = 0 THEN 'note' ELSE '' END, false, false FROM s"""
)
def routine_labels(spark: SparkSession, sf: str) -> DataFrame:
    return M.labels(_sources(spark, sf)).withColumn("parameters", F.array_join("parameters", "|"))


@query(f"WITH s AS ({_SOURCES}) {_OWNED}")
def routine_owners(spark: SparkSession, sf: str) -> DataFrame:
    return M.owners(_sources(spark, sf), B.package_by_prefix(R.packages(inputs(spark, sf, "package_rows"))))


@query(f"WITH s AS ({_SOURCES}) SELECT routine FROM s WHERE NOT EXISTS (SELECT 1 FROM prefix_list p WHERE o = 1 AND starts_with(s.routine, p.prefix))")
def orphan_routines(spark: SparkSession, sf: str) -> DataFrame:
    return M.orphan_routines(_sources(spark, sf), routine_owners(spark, sf))


@query("SELECT 'N' || c_nationkey AS routine, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) > 1")
def repeated_routines(spark: SparkSession, sf: str) -> DataFrame:
    names = spark.read.parquet(f"{sf}/customer.parquet").select(F.concat(F.lit("N"), "c_nationkey").alias("routine"))
    return M.repeated_routines(names).withColumnRenamed("count", "n")


def _routines(spark: SparkSession, sf: str) -> Graph:
    return B.with_routines(Graph(spark, {"Package": R.packages(inputs(spark, sf, "package_rows"))}), _sources(spark, sf))


@query(f"WITH s AS ({_SOURCES}), o AS ({_OWNED}) SELECT routine AS name, o.package AS package_name, o.prefix, CAST(7 AS BIGINT) AS lines_of_code, (k % 7) || '.0' AS version, CASE WHEN k % 5 = 0 THEN k || '|9' ELSE '' END AS patches, 'header' AS description FROM s LEFT JOIN o USING (routine)")
def routine_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return _routines(spark, sf).nodes("Routine").withColumn("patches", F.array_join("patches", "|"))


@query(f"WITH s AS ({_SOURCES}), n AS (SELECT routine, 3 AS line_number, 'EN' || k AS label FROM s UNION ALL SELECT routine, 6, CASE WHEN k % 2 = 0 THEN 'ZAG' ELSE 'TAG' END FROM s) SELECT routine AS src, routine || ':' || label || ':' || line_number AS dst, CAST(line_number AS INT) AS line_number, CAST(1 AS DOUBLE) AS confidence FROM n")
def edges_contains_label(spark: SparkSession, sf: str) -> DataFrame:
    return _routines(spark, sf).edges("CONTAINS_LABEL")


@query(f"WITH s AS ({_SOURCES}) SELECT package AS src, routine AS dst, prefix, CAST(1 AS DOUBLE) AS confidence FROM ({_OWNED})")
def edges_owns_routine(spark: SparkSession, sf: str) -> DataFrame:
    return _routines(spark, sf).edges("OWNS_ROUTINE")


#: Labels of the sources, their calls, and the label that each call means: by label and routine, else by the label if it stands in one routine alone, else a guess.
_CALLS = f"""s AS ({_SOURCES}), n AS (SELECT routine, 3 AS line, 'EN' || k AS label FROM s UNION ALL SELECT routine, 6, CASE WHEN k % 2 = 0 THEN 'ZAG' ELSE 'TAG' END FROM s),
    c AS (SELECT routine, 'EN' || k AS label, 'TAG' AS to_label, {_NAME.format(k=f'({_CALLED})').replace('c_custkey', 'k')} AS to_routine FROM s UNION ALL SELECT routine, 'EN' || k, 'EN' || (k + 2), 'NOWHERE' FROM s),
    l AS (SELECT label, min({{'r': routine, 'i': line, 'l': label}}) AS m, count(DISTINCT routine) AS n FROM n GROUP BY 1), f AS (SELECT routine, min({{'i': line, 'l': label}}) AS m FROM n GROUP BY 1),
    d AS (SELECT c.*, CASE WHEN x.routine IS NOT NULL THEN 1.0 WHEN l.n = 1 THEN 0.7 ELSE 0.5 END AS sure, CASE WHEN x.routine IS NOT NULL THEN x.routine WHEN l.n = 1 THEN l.m.r WHEN f.m IS NOT NULL THEN c.to_routine ELSE l.m.r END AS dep,
        CASE WHEN x.routine IS NOT NULL THEN x.label || ':' || x.line WHEN l.n = 1 THEN l.m.l || ':' || l.m.i WHEN f.m IS NOT NULL THEN f.m.l || ':' || f.m.i ELSE l.m.l || ':' || l.m.i END AS place
        FROM c LEFT JOIN n x ON x.routine = c.to_routine AND x.label = c.to_label LEFT JOIN l ON l.label = c.to_label LEFT JOIN f ON f.routine = c.to_routine WHERE coalesce(x.routine, l.label, f.routine) IS NOT NULL)"""


@query(f"WITH {_CALLS} SELECT routine || ':' || label || ':3' AS src, dep || ':' || place AS dst, CAST(sure AS DOUBLE) AS confidence FROM d")
def edges_calls(spark: SparkSession, sf: str) -> DataFrame:
    return _routines(spark, sf).edges("CALLS")


@query(f"WITH {_CALLS} SELECT routine, dep AS depends_on, CAST(sure AS DOUBLE) AS confidence, count(*) AS call_count FROM d WHERE routine <> dep GROUP BY 1, 2, 3")
def routine_dependencies(spark: SparkSession, sf: str) -> DataFrame:
    lines = _sources(spark, sf)
    return M.dependencies(M.calls(lines), M.labels(lines))


@query(f"WITH {_CALLS} SELECT CASE sure WHEN 1.0 THEN 'exact' WHEN 0.7 THEN 'label' ELSE 'guess' END AS how, CAST(sure AS DOUBLE) AS confidence, count(*) AS n FROM d GROUP BY 1, 2")
def confidence_tiers(spark: SparkSession, sf: str) -> DataFrame:
    lines = _sources(spark, sf)
    rows = M.resolved(M.calls(lines).where("label IS NOT NULL"), M.labels(lines))
    return rows.groupBy("how").agg(F.count(F.lit(1)).alias("n")).withColumn("confidence", M.confidence(F.col("how")))


_LINES_OF = "SELECT routine, CAST(i AS INT) AS line_no, l[i] AS line FROM (SELECT routine, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT routine, string_split(text, chr(10)) AS l FROM ({})))"
_COUNTS = ", ".join(f"CAST(len(regexp_extract_all(line, '{p}')) AS INT) AS {n}" for n, p in M.PATTERNS.items() if n != "symbols")


@query(
    f"""WITH s AS ({_LINES_OF.format(_SOURCES)}) SELECT routine, line_no, CAST(length(line) AS INT) AS length, CAST(length(line) - length(ltrim(line)) AS INT) AS indent, NOT starts_with(line, ' ') AS is_label, starts_with(line, ' ') AS is_code, starts_with(trim(line), ';') AS is_comment,
    nullif(regexp_extract(line, '^ *([A-Z]+) ', 1), '') AS command, {_COUNTS}, CAST(length(regexp_replace(line, '[A-Za-z0-9_ ]', '', 'g')) AS INT) AS symbols FROM s"""
)
def line_features(spark: SparkSession, sf: str) -> DataFrame:
    return M.features(_sources(spark, sf)).drop("global_names")


_WIDE = ", ".join(f"CAST(len(regexp_extract_all(line, '{p}')) AS INT) AS {n}" for n, p in M.WIDER.items())
_CHARS = ", ".join(f"CAST(len(regexp_replace(line, '{p.replace(chr(39), chr(39) * 2)}', '', 'g')) AS INT) AS {n}" for n, p in M.CLASSES.items())


@query(f"WITH s AS ({_LINES_OF.format(_SOURCES)}) SELECT routine, line_no, {_WIDE}, {_CHARS} FROM s")
def wider_line_features(spark: SparkSession, sf: str) -> DataFrame:
    return M.wider_features(_sources(spark, sf))


@query(
    f"""WITH s AS ({_LINES_OF.format(_SOURCES)}), t AS (SELECT routine, unnest(regexp_extract_all(line, '\\^[A-Z0-9$%]+')) AS g FROM s) SELECT routine, (SELECT string_agg(DISTINCT g, ',' ORDER BY g) FROM t WHERE t.routine = s.routine) AS unique_globals, string_agg(DISTINCT nullif(regexp_extract(line, '^ *([A-Z]+) ', 1), ''), ',' ORDER BY nullif(regexp_extract(line, '^ *([A-Z]+) ', 1), '')) AS commands FROM s GROUP BY routine"""
)
def routine_roll_up(spark: SparkSession, sf: str) -> DataFrame:
    return M.roll_up(M.features(_sources(spark, sf))).select("routine", "unique_globals", "commands")


@query("SELECT p_brand AS stratum, least(count(*), 5) AS n FROM part GROUP BY 1")
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    part = spark.read.parquet(f"{sf}/part.parquet")
    return M.stratified(part.select("p_partkey", "p_brand"), F.col("p_brand"), 5).groupBy(F.col("p_brand").alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


_SCHEMAS = "SELECT c_mktsegment AS schema, avg(c_nationkey) / 25.0 AS technical_score, avg(c_custkey % 10) / 10.0 AS stakeholder_fit, avg(c_custkey % 4) / 4.0 AS implementability, CAST(NULL AS DOUBLE) AS maintainability FROM {customer} GROUP BY c_mktsegment"


@query(f"SELECT schema, round(0.4 * technical_score + 0.3 * stakeholder_fit + 0.2 * implementability, 9) AS score FROM ({_SCHEMAS.format(customer='customer')}) ORDER BY 2 DESC LIMIT 1")
def best_schema(spark: SparkSession, sf: str) -> DataFrame:
    told = spark.sql(_SCHEMAS, customer=spark.read.parquet(f"{sf}/customer.parquet"))
    return M.best(M.scores(told)).withColumn("score", F.round("score", 9))


@query(
    f"""WITH s AS ({_LINES_OF.format(_SOURCES)}), c AS (SELECT DISTINCT routine, line_no, line, unnest(string_split(line, '')) AS c FROM s) SELECT routine, line_no, coalesce(string_agg(c || '=' || (length(line) - length(replace(line, c, ''))), '|' ORDER BY c), '') AS characters FROM c WHERE c <> '' GROUP BY 1, 2"""
)
def line_characters(spark: SparkSession, sf: str) -> DataFrame:
    """What each line of the sources is made of; the map as one text, in order."""
    told = M.character_counts(_sources(spark, sf)).where(F.size("characters") > 0)
    return told.withColumn("characters", F.array_join(F.transform(F.array_sort(F.map_entries("characters")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), "|"))


_UNITS = "SELECT doc_id AS unit, length(text) - length(replace(text, chr(10), '')) + 1 AS size, source AS package, n_chars % 17 AS labels FROM {documents} WHERE text IS NOT NULL"


@query(
    f"""WITH u AS ({_UNITS.format(documents='documents')}), e AS (SELECT unit, unnest(['size', 'package', 'complexity', 'random']) AS d, unnest([CASE WHEN size < 3 THEN 'small' WHEN size < 10 THEN 'middle' ELSE 'large' END, coalesce(package, ''), CASE WHEN labels < 3 THEN 'simple' WHEN labels < 10 THEN 'middle' ELSE 'complex' END, 'all']) AS name FROM u),
    r AS (SELECT *, row_number() OVER (PARTITION BY d, name ORDER BY md5('1:' || d || ':' || unit), unit) AS i FROM e)
    SELECT unit, string_agg(d || ':' || name, ',' ORDER BY d || ':' || name) AS strata FROM r WHERE i <= CASE d WHEN 'package' THEN 5 WHEN 'complexity' THEN 20 WHEN 'random' THEN 50 ELSE CASE name WHEN 'small' THEN 40 WHEN 'middle' THEN 100 ELSE 60 END END GROUP BY 1"""
)
def strategic_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as units, in a sample by size, package (their source) and complexity and at random (D8)."""
    return M.strategic_sample(spark.sql(_UNITS, documents=spark.read.parquet(f"{sf}/documents.parquet")), sizes=(3, 10))


@query(
    f"""WITH s AS ({_LINES_OF.format("SELECT CAST(doc_id AS STRING) AS routine, text FROM documents WHERE text IS NOT NULL")}) SELECT routine, count(*) AS lines, CAST(sum(len(regexp_extract_all(line, '"[^"]*"'))) AS BIGINT) AS quoted, CAST(sum(len(regexp_extract_all(line, '[A-Z0-9$%]+='))) AS BIGINT) AS assignments FROM s GROUP BY 1"""
)
def document_features(spark: SparkSession, sf: str) -> DataFrame:
    return M.roll_up(M.features(_documents(spark, sf))).select("routine", "lines", "quoted", "assignments")


@query(f"WITH s AS ({_LINES_OF.format(_SOURCES)}) SELECT avg(CASE WHEN regexp_matches(line, '^ *[A-Z]+ ') THEN 1.0 ELSE 0.0 END) AS coverage FROM s")
def command_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return M.coverage(M.features(_sources(spark, sf)), F.col("command").isNotNull())
