"""Components, counts without paths, neighbourhoods and ranges against plain versions on small random inputs."""

import random

import pytest
from pyspark.sql import functions as F

from quillgraph.operators import paths
from quillgraph.operators.components import strong_components
from quillgraph.operators.ranges import first_range


def closure(edges):
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    far = {}
    for a in out:
        seen, todo = set(), [a]
        while todo:
            for b in out.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        far[a] = seen
    return far


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(f"{r.randrange(60)}", f"{r.randrange(60)}") for _ in range(70)] + [(f"r{i}", f"r{(i + 1) % 23}") for i in range(23)] + [("r5", "0"), ("t0", "r3"), ("self", "self"), ("self", "self")]
    edges += [(f"c{i}", f"c{i + 1}") for i in range(9)] + [(None, "1"), ("1", None)]
    nodes = sorted({n for e in edges for n in e if n}) + ["alone"]
    far = closure([e for e in edges if None not in e])
    want = set()
    for n in nodes:
        own = {m for m in far.get(n, ()) if n in far.get(m, ())}
        want.add((n, min(own | {n}), len(own | {n}), bool(own)))
    told = strong_components(spark.createDataFrame([(n,) for n in nodes * 2], "node string"), spark.createDataFrame(edges * 2, "src string, dst string"))
    assert {tuple(x) for x in told.collect()} == want and told.count() == len(want)


def test_no_edges_no_circles(spark):
    nodes, none = spark.createDataFrame([("a",)], "node string"), spark.createDataFrame([], "src string, dst string")
    assert [tuple(r) for r in strong_components(nodes, none).collect()] == [("a", "a", 1, False)]
    assert strong_components(nodes.limit(0), none).count() == 0


def test_counts_are_those_of_paths(spark):
    r = random.Random(3)
    edges = [(f"{a}", f"{b}") for a in range(20) for b in range(a + 1, 20) if r.random() < 0.2]
    df = spark.createDataFrame([(f"{a}>{b}", a, b) for a, b in edges], "edge_id string, src string, dst string")
    starts = df.select(F.col("src").alias("node")).distinct()
    walked = paths.walk(starts, df).groupBy("start", "node", "hops").agg(F.count(F.lit(1)).alias("n"))
    assert {tuple(x) for x in paths.path_counts(starts, df).collect()} == {tuple(x) for x in walked.collect()}
    assert paths.path_counts(starts, df.limit(0)).count() == 0
    ladder = spark.createDataFrame([(f"{i}", f"{i + 1}") for i in range(50) for _ in range(2)], "src string, dst string")
    one = spark.createDataFrame([("0",)], "node string")
    assert paths.path_counts(one, ladder).where("node = '50'").first().n == 2**50  # paths beyond any list
    with pytest.raises(ValueError):
        paths.path_counts(one, ladder.union(spark.createDataFrame([("50", "49")], "src string, dst string")))


def test_neighbourhood(spark):
    r = random.Random(4)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(90)] + [(0, i) for i in range(1, 8)]
    df = spark.createDataFrame(edges, "src long, dst long")
    both = {}
    for a, b in edges:
        both.setdefault(a, set()).add(b)
        both.setdefault(b, set()).add(a)
    for start in (0, 5):
        hops, front = {start: 0}, {start}
        for k in range(1, 4):
            front = {b for a in front for b in both.get(a, ()) if b not in hops}
            hops |= dict.fromkeys(front, k)
        got = paths.neighbourhood(spark.createDataFrame([(start,)], "node long"), df, 3)
        assert {(x.start, x.node): x.hops for x in got.collect()} == {(start, n): k for n, k in hops.items()}
        assert got.count() == len(hops)
    assert paths.neighbourhood(spark.createDataFrame([(999,)], "node long"), df, 3).count() == 1
    with pytest.raises(ValueError):
        paths.neighbourhood(df.select(F.col("src").alias("node")), df, -1)


def test_first_ranges(spark):
    r = random.Random(5)
    inf, nan = float("inf"), float("nan")
    spans = [(r.randrange(50) / 2, r.randrange(90) / 2, i, f"n{i}") for i in range(60)] + [(3.0, 1e12, 70, "wide"), (-inf, 2.0, 71, "low"), (40.0, inf, 72, "high"), (nan, 5.0, 0, "bad"), (5.0, nan, 0, "bad"), (-0.0, 0.0, -1, "zero"), (7.25, 7.25, -2, "point"), (7.25, 7.25, -1, "later")]
    asked = [(f"k{i}", r.randrange(-20, 200) / 4) for i in range(400)] + [("z", 0.0), ("mz", -0.0), ("inf", inf), ("far", 1e13), ("nan", nan), ("none", None), ("p", 7.25)]
    r.shuffle(spans)
    want = {}
    for k, n in asked:
        if n is not None and n == n:
            held = [(p, name) for low, high, p, name in spans if low <= n <= high]
            want[k] = min(held)[1] if held else None
    got = first_range(spark.createDataFrame(asked, "key string, n double").repartition(3), spark.createDataFrame(spans, "low double, high double, place long, name string"))
    assert {x.key: x.name for x in got.collect()} == want
    none = first_range(spark.createDataFrame(asked, "key string, n double"), spark.createDataFrame([], "low double, high double, place long, name string"))
    assert {x.name for x in none.collect()} == {None} and none.count() == len(want)


def test_long_chains_take_few_rounds(spark, monkeypatch):
    from quillgraph.operators.stored import Rounds

    n, written = 400, []
    put = Rounds.put_told
    monkeypatch.setattr(Rounds, "put_told", lambda self, *a: written.append(1) or put(self, *a))
    edges = [(f"c{i}", f"c{i + 1}") for i in range(n)] + [(f"c{i}", f"c{i + 5}") for i in range(0, n, 20)]  # a chain with short cuts
    edges += [(f"r{i}", f"r{(i + 1) % n}") for i in range(n)] + [("c9", "r0")]  # a ring
    edges += [(f"l{i}", f"l{(i + 1) % n}") for i in range(n)] + [("l7", "l50"), ("l3", "x0"), *((f"x{i}", f"x{i + 1}") for i in range(n)), (f"x{n}", "l90"), ("l8", "y0"), ("y0", "c3")]  # a ring with a handle, and what leaves it
    edges += [("p0", "p1"), ("p1", "p2"), ("p2", "p0"), ("q", "p0"), ("p0", "c0")]  # a ring that one node alone is the end of
    nodes = sorted({m for e in edges for m in e})
    told = {r.node: (r.component, r.size, r.circular) for r in strong_components(spark.createDataFrame([(m,) for m in nodes], "node string"), spark.createDataFrame(edges, "src string, dst string")).collect()}
    handle = sorted(m for m in nodes if m[0] in "lx")
    want = {m: (m, 1, False) for m in nodes} | {f"r{i}": ("r0", n, True) for i in range(n)} | {m: (handle[0], len(handle), True) for m in handle} | {f"p{i}": ("p0", 3, True) for i in range(3)}
    assert told == want
    assert len(written) <= 50, len(written)
