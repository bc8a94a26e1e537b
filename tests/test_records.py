import pytest

from quillgraph.operators import edges as E
from quillgraph.operators import paths, upsert
from quillgraph.operators import records as R
from quillgraph.plans import build
from quillgraph.plans import questions as Q
from quillgraph.plans.graph import Graph
from quillgraph.schemas import edge_type
from quillgraph.sources.exports import PACKAGE_COLUMNS, package_rows, parse_lines, read_lines
from quillgraph.sources.settings import Settings
from quillgraph.streaming.exports import keep_up, stream_entries

EXPORT = [
    '^DD(31,0)="DRAFT^^"',
    '^DD(31,0)="VESSEL^KEEL"',
    '^DD(31,0,"NM","VESSEL LOG")=""',
    '^DD(31,0,"DT")=3240105',
    '^DD(31,.01,0)="CALL SIGN^RF^^0;1"',
    '^DD(31,.02,0)="^P64\'"',
    '^DD(31,0,0)="left out"',
    '^DD(31,"B7",0)="left out"',
    '^DD(31,"GL",0,1,.01)=""',
    '^DD(31,48,1,1,0)="31^AHEAD^TRIGGER"',
    '^DD(31,48,1,0)="^.1"',
    '^DD(31,48,1,27,1)="before its definition"',
    '^DD(31,48,1,27,0)="31^TIDE^TRIGGER"',
    '^DD(31,48,1,27,1)="S M=4"',
    '^DD(31,48,1,27,2)="K M"',
    '^DD(31,48,1,5,0)="alone"',
    '^DD(31,48,1,6,0)="31^"',
    '^DD(31,77,"V",1,0)="850^HARBOR(850,^PORT"',
    '^DD(31,77,"V",2,0)="64"',
    '^DD(31,77,0)="MOORING^V"',
    '^DD(31.04,0)="CREW SUB-FIELD^^"',
    '^DD(64,0)="FIELD^^"',
    '^DD(850,0)="PORT SUB-FILE^"',
    '^DIC(31,0,"GL")="KEEL("',
]


@pytest.fixture
def entries(spark):
    return parse_lines(spark.createDataFrame([(i, r) for i, r in enumerate(EXPORT)], "line_no long, raw string"))


def test_files(entries):
    files = {r.number: (r.name, r.global_root, r.is_subfile) for r in R.files(entries, entries).collect()}
    assert files == {"31": ("VESSEL LOG", "^KEEL(", False), "31.04": ("CREW SUB-FIELD", None, True), "64": ("FILE_64", None, False), "850": ("PORT SUB-FILE", None, True)}


def test_fields(entries):
    rows = {(r.number, r.name, r.target_file) for r in R.fields(entries).collect()}
    assert rows == {(".01", "CALL SIGN", None), (".02", "FIELD_.02", "64"), ("GL", "FIELD_GL", None), ("77", "MOORING", None)}


def test_cross_references_follow_their_header(entries):
    rows = {r.xref_id: (r.name, r.xref_type, r.set_logic, r.kill_logic) for r in R.cross_references(entries).collect()}
    assert rows == {"31_48_27": ("TIDE", "TRIGGER", "S M=4", "K M"), "31_48_6": ("", "regular", None, None)}


def test_graph_of_an_export(spark, entries):
    packages = R.packages(package_rows(spark.createDataFrame([(0, "DIR A", "A", "AB CD", "", "", "30", "70"), (1, "", "", "EF", "", "850", "", ""), (2, "DIR B", "", "", "7", "", "2", "3")], "row_no long, " + ", ".join(f"`{c}` string" for c in PACKAGE_COLUMNS))))
    assert {r.name: (r.prefixes, r.file_numbers) for r in packages.collect()} == {"A": (["AB", "CD", "EF"], ["850"]), "DIR B": ([], [])}
    g = build.structure(spark, packages, R.files(entries), R.fields(entries))
    g = build.enrich(g, R.cross_references(entries), R.variable_targets(entries))
    ends = lambda t: {(r.src, r.dst) for r in g.edges(t).collect()}
    assert ends("CONTAINS_FILE") == {("A", "31"), ("A", "31.04"), ("A", "64"), ("A", "850")}
    assert ends("POINTS_TO") == {("31:.02:5", "64")}
    assert ends("SUBFILE_OF") == {("31.04", "31")}
    assert ends("VARIABLE_POINTER") == {("31:77:19", "850"), ("31:77:19", "64")}
    assert ends("COMPUTED_FROM") == set()
    assert Q.orphan_files(g).count() == 0
    with pytest.raises(ValueError):
        g.edges("BELONGS_TO_PACKAGE")
    with pytest.raises(ValueError):
        build.enrich(Graph(spark, {n: g.nodes(n).limit(0) for n in ("File", "Field")}), None, None)


def test_ranges_are_inclusive_and_first_wins(spark):
    packages = spark.createDataFrame([(1, "X", [], "430", "430.9"), (2, "Y", [], "400", "500"), (3, "Z", ["430"], "bad", "9")], "file_no long, name string, file_numbers array<string>, files_low string, files_high string")
    files = spark.createDataFrame([(n,) for n in ("430", "430.5", "430.9", "431", "1000", "-1", "ABC")], "number string")
    want = {"430": "Z", "430.5": "X", "430.9": "X", "431": "Y", "1000": None, "-1": None, "ABC": None}
    assert {r.number: r.package for r in E.package_of(files, packages).collect()} == want


def test_paths_take_no_edge_twice(spark):
    edges = spark.createDataFrame([("e1", "a", "b"), ("e2", "b", "a"), ("e3", "a", "b"), ("e4", "b", "c")], "edge_id string, src string, dst string")

    def brute(node, used):
        for e in edges_list:
            if e[1] == node and e[0] not in used:
                yield (*used, e[0])
                yield from brute(e[2], (*used, e[0]))

    edges_list = [tuple(r) for r in edges.collect()]
    got = sorted(tuple(r.edge_ids) for r in paths.walk(spark.createDataFrame([("a",)], "node string"), edges).collect())
    assert got == sorted(brute("a", ()))
    assert {(r.node, r.hops) for r in paths.cycles(edges, 4).collect()} == {("a", 2), ("b", 2)}
    with pytest.raises(ValueError):
        paths.walk(edges.select("src"), edges, 0)


def test_upserts(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, w int")
    new = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, None, 1)], "k int, v string, w int")
    assert {tuple(r) for r in upsert.upsert(old, new, ["k"], ["w"]).collect()} == {(1, "a", 1), (2, "y", 2), (3, None, 1)}
    assert {tuple(r) for r in upsert.drop_repeats(new, ["k"], ["w"]).collect()} == {(2, "x", 1), (3, None, 1)}
    path = str(tmp_path / "t")
    assert upsert.append(old, path) == 2
    assert upsert.append(new, path) == 3
    assert spark.read.parquet(path).count() == 5
    assert upsert.clear(spark, path)
    assert edge_type("CONTAINS_FILE").confidence == 0.8


def test_save_and_load(spark, tmp_path, entries):
    g = build.structure(spark, R.packages(package_rows(spark.createDataFrame([], "row_no long, `Package Name` string, `Directory Name` string"))), R.files(entries), R.fields(entries))
    g.save(str(tmp_path / "g"))
    h = Graph.load(spark, str(tmp_path / "g"), ["Package", "File", "Field"], ["CONTAINS_FIELD", "POINTS_TO"])
    assert h.node_count().first()[0] == 8
    assert h.schema().where("name = 'File'").count() == 5


def test_text_files_and_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.zwr").write_bytes("\n".join(EXPORT).encode() + b'\n^DD(7,0)="BAD\xff BYTE"\n')
    lines = read_lines(spark, str(tmp_path / "in"))
    assert parse_lines(lines).count() == len(EXPORT)
    # lines of a file whose name comes later are later, whatever its name looks like
    (tmp_path / "two parts").mkdir()
    for name, part in (("b é.zwr", ['^DD(7,0)="LAST"', '^DD(8,0)="ONE"']), ("a b.zwr", ['^DD(7,0)="FIRST"'] * 3)):
        (tmp_path / "two parts" / name).write_text("\n".join(part))
    assert {r.number: r.name for r in R.files(parse_lines(read_lines(spark, str(tmp_path / "two parts")))).collect()} == {"7": "LAST", "8": "ONE"}
    assert R.files(parse_lines(lines)).where("number = '7'").first().name == "BAD BYTE"
    seen = []
    q = keep_up(stream_entries(spark, str(tmp_path / "in")), lambda df, n: seen.append(df.count()), str(tmp_path / "cp"))
    q.awaitTermination()
    assert sum(seen) == len(EXPORT)


def test_csv_with_short_rows(spark, tmp_path):
    from quillgraph.sources.exports import read_packages

    (tmp_path / "p.csv").write_text('Directory Name,Package Name,Prefixes,VDL ID,File Numbers Low,File Numbers High\nD1,P1,"A, ""B""",12,1,2\n,,C\nD2\n,Lost,X\n')
    rows = R.packages(read_packages(spark, str(tmp_path / "p.csv")))
    assert {r.name: r.prefixes for r in rows.collect()} == {"P1": ["A", "B", "C"], "D2": []}
    told = build.package_statistics(rows).first()
    assert (told.total_packages, told.total_prefixes, told.unique_prefixes, told.packages_with_file_ranges, told.packages_with_vdl_id) == (2, 3, 2, 1, 1)


def test_settings(tmp_path, monkeypatch):
    monkeypatch.setenv("QUILLGRAPH_DICTIONARY", str(tmp_path / "none"))
    s = Settings.from_env()
    assert str(tmp_path / "none") in s.missing()


def test_export_and_kept_parts_grow_with_the_tables(spark, tmp_path, monkeypatch):
    """A task writes so many lines of the export, and keeps one part of so many: larger tables make more of them, in as many batches."""
    import shutil

    from quillgraph import registry
    from quillgraph.plans import sample

    tables = shutil.copytree("/root/testdata/sf0.001", tmp_path / "sf")
    monkeypatch.setattr(sample, "ROWS_A_FILE", 1000)
    parts = []
    keep = registry.KeptRecords
    monkeypatch.setattr(registry, "KeptRecords", lambda spark, folder, kinds, n: parts.append(n) or keep(spark, folder, kinds, n))
    told = registry.QUERIES["files_from_stream"](spark, str(tables))
    want = registry.QUERIES["files_from_lines"](spark, str(tables))
    assert sorted(map(repr, told.collect())) == sorted(map(repr, want.collect()))
    names = registry._files(spark, sample.export_files(spark, str(tables)))
    assert len(names) > 4 and parts == [len(names)]
