from pyspark.sql import functions as F

from quillgraph.operators import routines as M

SOURCE = 'XUS ;;8.0;HEADER\nEN(A, B) ; start\n S X=1,Y="a;b" D TAG^DIC(2,0)\nTAG\n Q $$F(X)\n ;only a comment\n\nlower\nA1 B'


def test_labels_and_features(spark, tmp_path):
    (tmp_path / "XUS.m").write_text(SOURCE)
    lines = M.read_routines(spark, str(tmp_path))
    assert [(r.routine, r.label, r.line_no, r.parameters, r.comment, r.is_entry_point) for r in M.labels(lines).orderBy("line_no").collect()] == [("XUS", "EN", 2, ["A", "B"], "start", True), ("XUS", "TAG", 4, [], "", False)]
    third = M.features(lines).where("line_no = 3").first()
    assert (third.indent, third.is_code, third.is_label, third.command, third.globals, third.subscripted_globals, third.quoted, third.assignments, third.numbers) == (1, True, False, "S", 1, 1, 1, 2, 3)
    told = M.roll_up(M.features(lines)).first()
    assert (told.lines, told.labels, told.comments, told.commands) == (9, 5, 1, "Q,S,XUS")


def test_owners_and_checks(spark):
    names = spark.createDataFrame([("XUS",), ("XU1",), ("ZZ",), ("ZZ",)], "routine string")
    prefixes = spark.createDataFrame([("X", "one"), ("XUS", "two")], "prefix string, name string")
    owned = M.owners(names, prefixes)
    assert {(r.routine, r.package) for r in owned.collect()} == {("XUS", "two"), ("XU1", "one")}
    assert [r.routine for r in M.orphan_routines(names, owned).collect()] == ["ZZ"]
    assert [(r.routine, r["count"]) for r in M.repeated_routines(names).collect()] == [("ZZ", 2)]


def test_samples_and_shares(spark):
    df = spark.range(100)
    picked = [r.id for r in M.stratified(df, F.col("id") % 4, 3).collect()]
    assert sorted(x % 4 for x in picked) == [0] * 3 + [1] * 3 + [2] * 3 + [3] * 3
    assert picked == [r.id for r in M.stratified(df, F.col("id") % 4, 3).collect()]
    assert M.coverage(df, F.col("id") < 25).first().coverage == 0.25
    how = spark.createDataFrame([("exact",), ("label",), (None,)], "how string")
    assert [r[0] for r in how.select(M.confidence(F.col("how"))).collect()] == [1.0, 0.7, 0.5]
    lines = M.lines_of(spark.createDataFrame([("r", "aab")], "routine string, text string"))
    assert M.character_counts(lines).first().characters == {"a": 2, "b": 1}
    odd = M.lines_of(spark.createDataFrame([("r", "é😀é\\.[("), ("s", "")], "routine string, text string"))
    assert {r.routine: r.characters for r in M.character_counts(odd).collect()} == {"r": {"é": 2, "😀": 1, "\\": 1, ".": 1, "[": 1, "(": 1}, "s": {}}
    plan = M.character_counts(lines)._jdf.queryExecution().toString()
    assert "Generate explode(split(line" not in plan and "Aggregate" not in plan.split("== Physical Plan ==")[1]


def test_calls_by_how_they_resolve(spark):
    labels = spark.createDataFrame([("A", "EN", 3), ("A", "X", 9), ("B", "EN", 2), ("B", "B0", 1), ("C", "ONE", 5), ("D", "EN", 1), ("D", "EN", 7)], "routine string, label string, line_no int")
    said = [("EN", "A"), ("ONE", "Q"), ("ONE", "B"), ("EN", "C"), ("EN", "Q"), ("NO", "B"), ("NO", "Q"), ("EN", "D")]
    calls = spark.createDataFrame([("A", "X", 9, *s) for s in said], "routine string, label string, label_line int, to_label string, to_routine string")
    got = sorted((r.to_label, r.to_routine, r.found_routine, r.found_label, r.found_line, r.how) for r in M.resolved(calls, labels).collect())
    assert got == sorted(
        [
            ("EN", "A", "A", "EN", 3, "exact"),
            ("ONE", "Q", "C", "ONE", 5, "label"),
            ("ONE", "B", "C", "ONE", 5, "label"),
            ("EN", "C", "C", "ONE", 5, "guess"),
            ("EN", "Q", "A", "EN", 3, "guess"),
            ("NO", "B", "B", "B0", 1, "guess"),
            ("EN", "D", "D", "EN", 1, "exact"),
            ("EN", "D", "D", "EN", 7, "exact"),
        ]
    )
    assert {(r.depends_on, r.confidence, r.call_count) for r in M.dependencies(calls, labels).collect()} == {("C", 0.7, 2), ("C", 0.5, 1), ("B", 0.5, 1), ("D", 1.0, 2)}


def test_sample_over_strata(spark):
    rows = [(i, [5, 200, 900][i % 3], "hot" if i % 2 else f"p{i % 40}", i % 25) for i in range(3000)] + [(9000 + i, 1, None, 0) for i in range(3)]
    units = spark.createDataFrame(rows, "unit long, size long, package string, labels long")
    got = {r.unit: r.strata.split(",") for r in M.strategic_sample(units).collect()}
    taken = [s for strata in got.values() for s in strata]
    assert {n: taken.count(f"size:{n}") for n in ("small", "middle", "large")} == {"small": 40, "middle": 100, "large": 60}
    assert taken.count("package:hot") == 5 and taken.count("package:") == 3 and taken.count("random:all") == 50
    assert all(taken.count(f"complexity:{n}") == 20 for n in ("simple", "middle", "complex"))
    assert got == {r.unit: r.strata.split(",") for r in M.strategic_sample(units.repartition(7)).collect()}
    assert got.keys() != {r.unit for r in M.strategic_sample(units, seed=2).collect()}
    plan = M.strategic_sample(units)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan  # no stratum meets whole


def test_sources_are_dealt_to_tasks(spark):
    """A small table whose rows make much work is not left to the one task that reads it."""
    from pyspark.sql import functions as F

    from quillgraph import registry

    assert registry._sources(spark, "/root/testdata/sf0.001").select(F.spark_partition_id().alias("p")).distinct().count() > 1
