"""Graphs and keyed tables that change as a whole, and records that are kept from a stream."""

import os
import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

from quillgraph import registry
from quillgraph.operators import edges as E
from quillgraph.operators import records as R
from quillgraph.operators import stored
from quillgraph.operators.keyed import Keyed
from quillgraph.operators.stored import BITS, BY_SPLITS, FILTERED, ITEMS, JOINED, READ, SHARE, SPLIT, TASKS, TOLD_BY, WIDE, dealt_to
from quillgraph.operators.upsert import last_by_key
from quillgraph.plans import build, sample
from quillgraph.plans.graph import Graph, Saving, saved_rows
from quillgraph.plans.sample import sample_graph
from quillgraph.sources import commits
from quillgraph.sources.exports import line_place, parse_lines, read_packages
from quillgraph.streaming.records import KEYS, KeptRecords, stream_lines

from .conftest import same_rows
from .test_records import EXPORT

SF = "/root/testdata/sf0.001"


def files_under(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("graph") / "g")
    g = sample_graph(spark, SF)
    return path, g.save(path, 4)


def test_a_save_that_fails_leaves_the_old_graph(spark, saved):
    path, rows = saved
    before = commits.current(spark, path)
    g = Graph.load(spark, path)
    bad = Graph(spark, {"File": g.nodes("File").limit(1)}, {"POINTS_TO": g.edges("POINTS_TO").withColumn("dst", F.raise_error(F.lit("stop")).cast("string"))})
    with pytest.raises(Exception, match="stop"):
        bad.save(path, 4)
    assert commits.current(spark, path) == before and saved_rows(spark, path) == rows
    assert Graph.load(spark, path).node_count("File").first()[0] == rows["File"] > 1
    assert not [f for f in files_under(path) if before["frames"]["File"]["at"].split("/")[0] not in f]  # what it wrote is gone


def test_of_two_saves_one_lands(spark, tmp_path):
    path, one = str(tmp_path / "g"), spark.createDataFrame([("1", "a")], "number string, name string")
    with Saving(spark, path, 2) as first:
        first.write(Graph(spark, {"File": one}))
        Graph(spark, {"File": one.union(one)}).save(path, 2)
        with pytest.raises(RuntimeError, match="meanwhile"):
            first.__exit__(None)
        first.before += 1
    assert saved_rows(spark, path) == {"File": 1}
    tables = lambda: {t.name for t in spark.catalog.listTables()}
    before = tables()
    assert Graph.vacuum(spark, path) == 1 and Graph.load(spark, path).nodes("File").count() == 1
    assert len(before - tables()) == 1  # what is gone is gone from the catalog
    with pytest.raises(ValueError, match="no graph"):
        Graph.load(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError, match="lacks"):
        Graph.load(spark, path, ["Package"])


def test_joins_on_saved_frames_need_no_exchange(spark, saved):
    g = Graph.load(spark, saved[0])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held, points = g.edges("CONTAINS_FIELD").select("src", F.col("dst").alias("field_id")), g.edges("POINTS_TO").select(F.col("src").alias("field_id"), F.col("dst").alias("target"))
        joined = held.join(points, "field_id").join(g.nodes("Field").select("field_id", "name"), "field_id").join(g.edges("INDEXED_BY").select(F.col("src").alias("field_id"), "xref_name"), "field_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Join") >= 3
        assert joined.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    some = g.nodes("Field").first().field_id
    found = g.nodes("Field").where(F.col("field_id") == some)
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # the plan tells of buckets only so; they are pruned in any case
    try:
        told = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert re.search("SelectedBucketsCount: 1 out of 4", told)
    assert found.count() == 1


def test_phase_2_goes_on_from_phase_1(spark, tmp_path):
    path, g = str(tmp_path / "g"), sample_graph(spark, SF)
    build.store(path, g.nodes("Package"), g.nodes("File"), g.nodes("Field"), buckets=4)
    first = files_under(path)
    with pytest.raises(ValueError):
        build.add_phase_2(spark, str(tmp_path / "other"), g.nodes("CrossReference"), None)
    targets = spark.createDataFrame([("10", "1", "1", "20", "^X", "", 0)], "file_number string, field_number string, v_number string, target_file string, target_global string, target_description string, line_no int")
    build.add_phase_2(spark, path, g.nodes("CrossReference"), targets)
    assert set(first) <= set(files_under(path))
    told = saved_rows(spark, path)
    assert told["INDEXED_BY"] == g.edges("INDEXED_BY").count() and told["Field"] == g.nodes("Field").count()
    assert Graph.vacuum(spark, path) == 0  # both versions are in use


def test_upserts_touch_what_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    table = Keyed(spark, path, ("k", "l"), 8)
    assert table.read() is None and table.upsert(spark.createDataFrame([], "k long, l string, v string, at int"), ["at"]) == []
    rows = {(i, f"{i % 3}"): ("old", 0) for i in range(200)}
    frame = lambda d: spark.createDataFrame([(*k, *v) for k, v in d.items()], "k long, l string, v string, at int")
    assert len(table.upsert(frame(rows), ["at"])) == 8
    before, folders = files_under(path), table.part_numbers()
    new = {(5, "2"): ("new", 1), (5000, "x"): ("made", 1)}
    touched = table.upsert(frame(new).union(spark.createDataFrame([(5, "2", "less", 0)], "k long, l string, v string, at int")), ["at"])
    assert 1 <= len(touched) <= 2 and set(before) <= set(files_under(path))
    assert {p for p, v in table.part_numbers().items() if folders[p] != v} == {*touched}
    assert {(r.k, r.l): (r.v, r["at"]) for r in table.read().collect()} == rows | new
    assert table.read().columns == ["k", "l", "v", "at"]
    # a reader that began before sees what was
    was = Keyed(spark, path, ("k", "l"), 8)._read({"parts": {str(p): v for p, v in folders.items()}, "schema": "k long, l string, v string, at int"}, [str(p) for p in folders])
    assert was.count() == 200
    told = table._told()
    with pytest.raises(RuntimeError):
        commits.commit(spark, path, {}, told["number"] - 1)
    everything = table.upsert(frame(rows), ["at"])
    assert len(everything) == 8 and table.vacuum() == 2 and table.read().count() == 201
    assert commits.current(spark, path)["number"] == 3


def plain(kind, entries):
    return {"files": lambda: R.files(entries, entries), "fields": lambda: R.fields(entries), "cross_references": lambda: R.cross_references(entries), "variable_targets": lambda: R.variable_targets(entries)}[kind]()


def test_records_from_drops_are_those_of_one_batch(spark, tmp_path):
    r = random.Random(6)
    lines = [x for k in range(4) for x in (line.replace("(31", f"(3{k}1") for line in EXPORT)] + ['^DD(7,0)="LATER"', '^DD(31,.01,1,1,0)="31^B2"', '^DIC(31,0,"GL")="^NEW("']
    lines += [f'^DD({r.randrange(5)},{r.randrange(3)},1,{r.randrange(3)},{r.choice("012")})="{r.choice(["a^b^c", "a^q", "S X=1"])}"' for _ in range(150)] + [f'^DD({r.randrange(5)},{r.randrange(3)},1,0)="^.1"' for _ in range(20)]
    r.shuffle(lines)
    parts = [lines[i::5] for i in range(5)]
    (tmp_path / "in").mkdir()
    kept = KeptRecords(spark, str(tmp_path / "kept"), parts=3)
    for drop in ([3, 4], [1, "1 again"], [0, 2]):  # the first ones last, one of them twice
        for i in drop:
            (tmp_path / "in" / f"part {i}.zwr").write_text("\n".join(parts[int(str(i)[0])]))
        kept.follow(stream_lines(spark, str(tmp_path / "in"), 1)).awaitTermination()
    whole = spark.read.text(str(tmp_path / "in")).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("raw"))
    # each file by itself, as in the stream: places count from the beginning of a task
    entries = None
    for f in sorted(os.listdir(tmp_path / "in")):
        own = spark.read.text(str(tmp_path / "in" / f.replace(" ", "?"))).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("raw"))
        own = own.where(F.col("file").endswith(f.replace(" ", "%20")))
        own = parse_lines(own.select(line_place().alias("line_no"), "raw"))
        entries = own if entries is None else entries.union(own)
    assert entries.count() == parse_lines(whole.select(F.lit(0).alias("line_no"), "raw")).count()
    rows = lambda df: sorted(map(repr, map(tuple, df.collect())))
    seen = {}
    for kind in KEYS:
        seen[kind] = rows(kept.records(kind))
        want = plain(kind, entries)
        assert seen[kind] == rows(want.select(*kept.records(kind).columns)), kind
        assert seen[kind]
    kept.take(whole.where(F.col("file").contains("part%203")).select("file", "block", "raw"))  # a batch that is done twice
    kept.follow(stream_lines(spark, str(tmp_path / "in"), 1)).awaitTermination()  # and nothing new
    for kind in ("files", "cross_references"):
        assert rows(kept.records(kind)) == seen[kind]


def test_packages_of_several_files_follow_their_names(spark, tmp_path):
    (tmp_path / "p").mkdir()
    head = "Directory Name,Package Name,Prefixes,VDL ID,File Numbers Low,File Numbers High\n"
    (tmp_path / "p" / "a.csv").write_text(head + "D1,P1,A,1,1,2\n")
    (tmp_path / "p" / "b.csv").write_text(head + ",,B\n" + "".join(f"D{i},P{i},X{i},,,\n" for i in range(2, 400)))
    rows = R.packages(read_packages(spark, str(tmp_path / "p")))
    assert {r.name: r.prefixes for r in rows.collect()}["P1"] == ["A", "B"]
    assert [r.name for r in rows.orderBy("file_no").collect()] == [f"P{i}" for i in range(1, 400)]


def test_stand_ins(spark):
    files = spark.createDataFrame([("31", "A", None, None, False), ("9.01", "S", None, None, True), ("31.2", "T", None, None, True)], "number string, name string, global_root string, parent_file string, is_subfile boolean")
    fields = spark.createDataFrame([("31", "1", 4, "V", "31:1:4")], "file_number string, number string, line_no long, name string, field_id string")
    rows = [("31", "1", str(i), t, "^G", "", i) for i, t in enumerate(["31", "77", "X9", "", None, "9"])]
    targets = spark.createDataFrame(rows, "file_number string, field_number string, v_number string, target_file string, target_global string, target_description string, line_no int")
    g = build.with_placeholders(build.enrich(Graph(spark, {"File": files, "Field": fields}), spark.createDataFrame([], "xref_id string, file_number string, field_number string, name string, xref_type string, set_logic string, kill_logic string"), targets), targets)
    assert {(r.number, r.name) for r in g.nodes("File").collect()} == {("31", "A"), ("9.01", "S"), ("31.2", "T"), ("9", "FILE_9"), ("77", "FILE_77"), ("X9", "FILE_X9")}
    assert {(r.src, r.dst, r.confidence) for r in g.edges("SUBFILE_OF").collect()} == {("31.2", "31", 1.0), ("9.01", "9", 0.5)}
    assert {(r.dst, r.confidence) for r in g.edges("VARIABLE_POINTER").collect()} == {("31", 1.0), ("77", 0.5), ("X9", 0.5), ("9", 0.5)}


def test_loads_of_larger_tables_have_more_tasks(spark, tmp_path, monkeypatch):
    """A bucket of the saved graph and a task of its load have so many rows: larger tables make more of them, and the session's number is as before."""
    tables = str(shutil.copytree(SF, tmp_path / "sf"))
    monkeypatch.setattr(sample, "ROWS_A_TASK", 1000)
    seen, write = [], Saving.write
    monkeypatch.setattr(Saving, "write", lambda self, g: seen.append(spark.conf.get(TASKS)) or write(self, g))
    before, n = spark.conf.get(TASKS), sample.tasks(spark, tables)
    rows = {k: df.count() for k, df in sample.saved_graph(spark, tables).edge_frames.items()}
    told = commits.current(spark, sample._place(spark, tables, "graph"))
    assert n > int(before) and {f["buckets"] for f in told["frames"].values()} == {n} and seen == [str(n)] * 2 and spark.conf.get(TASKS) == before
    assert rows == {k: df.count() for k, df in sample.saved_graph(spark, SF).edge_frames.items()}


def test_cross_references_are_dealt_by_id_without_their_order(spark, tmp_path):
    """Of lines that repeat the last stays, also where an order stands twice or a line has no number; what is dealt by id has no column of the order."""
    tables = str(shutil.copytree(SF, tmp_path / "sf"))
    lines, orders = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("lineitem", "orders"))
    lines = lines.unionByName(lines.where("l_orderkey % 7 = 0").withColumn("l_linenumber", F.lit(None).cast(lines.schema["l_linenumber"].dataType)))
    for name, df in (("lineitem", lines), ("orders", orders.unionByName(orders.where("o_orderkey % 5 = 0")))):
        os.remove(f"{tables}/{name}.parquet")
        df.write.parquet(f"{tables}/{name}.parquet")
    got = sample.cross_references(spark, tables)
    want = last_by_key(sample.inputs(spark, tables, "xref_rows"), ["xref_id"], sample.XREF_ORDER).withColumn("set_logic", F.nullif("set_logic", F.lit(""))).select(*got.columns)
    rows = sorted(map(repr, got.collect()))
    assert rows == sorted(map(repr, want.collect())) and any("xref_id=None" in r for r in rows)
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    dealt = [b for b in plan.split("\n\n") if "hashpartitioning(xref_id" in b]
    assert dealt and not any(c in b for b in dealt for c in sample.XREF_ORDER)


def exchanges(spark, df):
    told = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [b for b in told.split("\n\n") if re.match(r"\s*\(\d+\) Exchange", b)]


def test_lines_are_dealt_by_order_only_and_cross_references_once(spark, saved):
    """Orders meet their customers before they meet lines, and saved cross-references lie by their field, so INDEXED_BY deals none of them again."""
    g = Graph.load(spark, saved[0])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (sample.cross_references(spark, SF), sample.inputs(spark, SF, "target_rows")):
            lines = [b for b in exchanges(spark, df) if "l_linenumber#" in b]
            assert lines and all("hashpartitioning(l_orderkey#" in b for b in lines)
        dealt = exchanges(spark, E.indexed_by(g.nodes("Field"), g.nodes("CrossReference")))
        assert dealt and not any(c in b for b in dealt for c in ("xref_id#", "dst#"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_each_part_is_written_by_a_task_of_its_own(spark, tmp_path):
    table = Keyed(spark, str(tmp_path / "t"), ("k",), 32)
    table.upsert(spark.range(2000).select(F.col("id").alias("k"), F.lit(0).alias("at")), ["at"])
    files = files_under(tmp_path / "t")
    assert len(files) == 32 == len({os.path.basename(f).split("-")[1] for f in files})


def test_shares_are_joined_up_to_a_size_only(spark, tmp_path, monkeypatch):
    """What is dealt to more tasks isn't joined again to large shares, in a stream's batches either; a session that joins less stays as it is."""
    before, seen, take = spark.conf.get(JOINED), [], KeptRecords.take
    monkeypatch.setattr(KeptRecords, "take", lambda self, batch, number=0: seen.append(batch.sparkSession.conf.get(JOINED)) or take(self, batch, number))
    registry.QUERIES["fields_from_stream"](spark, SF)
    assert {*seen} == {f"{SHARE}b"} and spark.conf.get(JOINED) == before
    spark.conf.set(JOINED, "16k")
    try:
        with dealt_to(spark, 8):
            assert spark.conf.get(JOINED) == f"{16 << 10}b" and spark.conf.get(TASKS) == "8"
        assert spark.conf.get(JOINED) == "16k"
    finally:
        spark.conf.set(JOINED, before)


def test_streams_of_larger_tables_have_more_tasks(spark, tmp_path, monkeypatch):
    """The export is laid out, and its records are kept and asked, by as many tasks as the tables are large."""
    tables = str(shutil.copytree(SF, tmp_path / "sf"))
    monkeypatch.setattr(sample, "ROWS_A_TASK", 1000)
    monkeypatch.setattr(sample, "ROWS_A_FILE", 1000)
    laid, kept, of, take = [], [], sample.inputs, KeptRecords.take
    monkeypatch.setattr(sample, "inputs", lambda s, d, name, **g: laid.append((name, s.conf.get(TASKS))) or of(s, d, name, **g))
    monkeypatch.setattr(KeptRecords, "take", lambda self, batch, number=0: kept.append(batch.sparkSession.conf.get(TASKS)) or take(self, batch, number))
    before, n = spark.conf.get(TASKS), str(sample.tasks(spark, tables))
    for kind in ("fields", "cross_references"):
        got = registry.QUERIES[f"{kind}_from_stream"](spark, tables)
        dealt = re.findall(r"hashpartitioning\(file_number#\d+, \w+#\d+, (\d+)\), REPARTITION_BY_NUM", spark.sparkContext._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple"))
        assert laid == [("lines", n)] and int(n) > int(before) and {*kept, *dealt} == {str(len(registry._files(spark, sample.export_files(spark, tables))))} and dealt
        assert sorted(map(repr, got.collect())) == sorted(map(repr, registry.QUERIES[f"{kind}_from_lines"](spark, tables).distinct().collect()))
    assert spark.conf.get(TASKS) == before


def test_a_load_reads_and_writes_by_bounded_shares(spark, saved):
    session = {c: spark.conf.get(c) for c in (READ, BY_SPLITS, FILTERED, TOLD_BY, ITEMS, BITS)}
    held = Graph.load(spark, saved[0])
    lies = E.contains_field(held.nodes("File"), held.nodes("Field")).repartition(4, "dst")  # as its fields do: no exchange, a task for each bucket
    told = lambda df: df.select("*")._jdf.queryExecution().executedPlan().toString()
    with dealt_to(spark, 4):
        assert spark.conf.get(READ) == f"{SPLIT}b" and "Bucketed: true" in told(lies) and "hashpartitioning(dst" not in told(lies)
    assert {c: spark.conf.get(c) for c in session} == session
    spark.conf.set(READ, "1m")
    try:
        with dealt_to(spark, 4):
            assert spark.conf.get(READ) == f"{1 << 20}b"
    finally:
        spark.conf.set(READ, session[READ])


def test_lines_that_a_join_drops_are_not_dealt(spark, monkeypatch):
    rows = lambda: sample.inputs(spark, SF, "target_rows")
    plain = rows().toPandas()
    monkeypatch.setattr(stored, "LARGE", 1)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        with dealt_to(spark, 4):
            asked = rows()
            told = asked._jdf.queryExecution().executedPlan().toString()
            assert "might_contain" in told and f", {WIDE}, " in told  # of 8 MB: one of 1 MB lets nearly all lines through once it holds some million orders
            assert len(plain) > 1000 and same_rows(asked.toPandas(), plain, [*plain.columns])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
