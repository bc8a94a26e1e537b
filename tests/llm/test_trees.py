"""Manifest, prefix trie and quality classifier: small tables with nulls, ties, repeated rows and extra columns against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillgraph.llm import goodness, manifest, prefixes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, pos long, n long, tree string, digest string, root string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def crc(x):
    return zlib.crc32(str(x).encode())


def tree(leaves):
    """Root, and for each leaf the (left, right) siblings of every level."""
    paths = [[] for _ in leaves]
    now = [(d, [i]) for i, d in enumerate(leaves)]
    while len(now) > 1:
        up = []
        for i in range(0, len(now), 3):
            run = now[i : i + 3]
            for k, (_, held) in enumerate(run):
                for x in held:
                    paths[x].append(("".join(r[0] for r in run[:k]), "".join(r[0] for r in run[k + 1 :])))
            up.append((H(*[r[0] for r in run]), [x for r in run for x in r[1]]))
        now = up
    return now[0][0], paths


def plain_manifest(rows):
    told = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: H(*map(told, (r[0], r[3], r[2], r[4], t)))
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((own, *tree([leaf(r, r[1]) for r in own])))
    root, tops = tree([t[1] for t in trees]) if trees else ("", [])
    out = []
    for (own, sub, paths), top in zip(trees, tops, strict=True):
        for r, path in zip(own, paths, strict=True):
            found = r[1].replace("\n", "") if r[1] is not None and r[0] is not None and crc(r[0]) % 2 == 0 else r[1]
            f = leaf(r, found)
            for a, b in path + top:
                f = H(a, f, b)
            out.append((r[0], leaf(r, r[1]), sub, root, H(*[a + b for a, b in path + top]), f, f == root))
    return sorted(out, key=repr)


def audit(docs):
    return sorted((tuple(r)[:7] for r in manifest.verify(manifest.manifest(docs, manifest.without_line_breaks(docs))).collect()), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10, 27, 28, 81, 82, 250, 728, 729])
def test_fractal_traversal(n):
    leaves = [H(str(i)).encode() for i in range(n)]
    if not n:
        return
    root, paths = manifest.traverse(leaves, manifest._levels(n))
    want, told = tree([x.decode() for x in leaves])
    assert root.decode() == want
    assert [[(a.decode(), b.decode()) for a, b in p] for p in paths] == told


def test_traversal_holds_few_nodes(monkeypatch):
    """What stands at a time is the stacked subtrees, not the block's tree."""
    made, at = [], []
    real = manifest.Subtree.step

    def step(self):
        real(self)
        made.append(sum(map(len, self.rows)) + sum(map(len, self.open)))

    monkeypatch.setattr(manifest.Subtree, "step", step)
    _, paths = manifest.traverse([H(str(i)).encode() for i in range(729)], 6)
    at = list(paths)
    assert len(at) == 729 and max(made) <= 12 + 2 * 7


def test_manifest(spark):
    r = random.Random(2)
    rows = [(i, f"line {i}\nnext é" if i % 3 else [None, "", "\n"][i % 9 // 3], "en" if i % 5 else None, [None, "", "a", "é", "Z", "hot", "hot"][i % 7], len(str(i)) if i % 4 else None) for i in range(300)]
    rows += [(1000 + i, "x\n", "en", "hot", i) for i in range(1600)]  # three rounds of blocks are two here
    rows += [(5000, "x", "en", f"s{i}", 1) for i in range(40)]
    rows += [(7, "again", "en", "hot", 1)] * 30 + [(None, t, None, "hot", None) for t in ("b", "a", None)] * 3 + [(-4, "neg\n", "en", "a", 2)]
    r.shuffle(rows)
    docs = spark.createDataFrame([(*x, 1, 2, "t", "d", "r") for x in rows], DOCS).repartition(5)
    assert audit(docs) == plain_manifest(rows)
    assert audit(docs.limit(0)) == []
    one = spark.createDataFrame([(3, "only", "en", None, 4, 1, 2, "t", "d", "r")], DOCS)
    assert audit(one) == plain_manifest([(3, "only", "en", None, 4)])
    told = manifest.manifest(docs)
    assert told.where(manifest.fold(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0


# -- trie ------------------------------------------------------------------------------------------------------------------------


def plain_trie(rows):
    said = {}
    for c, t, role, text in rows:
        if c is not None:
            said.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in said.items()}
    made = {c: own.get(c - int(math.fmod(c, 20)), [])[: crc(c) % 4] + own[c][crc(c) % 4 :] for c in own}
    nodes = {}
    for c, v in made.items():
        for d in range(len(v) + 1):
            nodes.setdefault(tuple(v[:d]), []).append(c)
    below = {}
    for k in nodes:
        if k:
            below.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in below.get(k, [])) or 1
        own_words = len(re.findall("[^\x20\x09-\x0d]+", k[-1][1])) if k else 0
        saved[k] = (len(nodes[k]) - 1) * own_words + sum(saved[x] for x in below.get(k, []))
    ends = lambda k: H(",".join(str(c) for c in sorted(nodes[k]) if len(made[c]) == len(k)))
    return sorted(((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(below.get(k, [])), leaves[k], saved[k], ends(k)) for k, m in nodes.items()), key=repr)


TURNS = "conv_id long, turn long, role string, text string, key string, n long, least long, depth long"


def grown(spark, rows):
    table = spark.createDataFrame([(*x, "k", 1, 2, 3) for x in rows], TURNS).repartition(4)
    return sorted((tuple(r) for r in prefixes.trie(prefixes.rebuilt(prefixes.turns(table))).collect()), key=repr)


def conversations():
    r = random.Random(4)
    rows = []
    for c in range(0, 260):
        if c == 40:
            continue  # a family without its first
        shared = [("system", "be kind to all"), ("user", "hello  there\tyou"), ("assistant", "hi")][: r.choice([0, 1, 2, 3])]
        turns = shared + [(r.choice(["user", None]), r.choice(["a b", "c", "", None, "dé f g"])) for _ in range(r.randint(0, 4))]
        rows += [(c, i if i or c % 3 else None, *t) for i, t in enumerate(turns or [("user", "x")])]
    rows += [(1000 + 20 * c, i, "user", f"same {i}") for c in range(60) for i in range(5)]  # copies
    rows += [(3000 + c, i, "user", f"long {i}") for c in range(0, 800, 20) for i in range(1 + c // 20)]  # each goes on where the last one ended
    return rows + [(None, 0, "user", "nobody's"), (-7, 1, "user", "minus"), (-20, 1, "user", "less")]


def test_trie(spark, monkeypatch):
    rows = conversations()
    want = plain_trie(rows)
    assert grown(spark, rows) == want
    monkeypatch.setattr(prefixes, "GROUP", 3)  # most groups are split, over several rounds
    monkeypatch.setattr(prefixes, "PIECE", 7)
    assert grown(spark, rows) == want
    assert grown(spark, []) == []
    assert grown(spark, [(1, 0, "user", "x")]) == plain_trie([(1, 0, "user", "x")])


def test_repeated_turns_stay(spark):
    rows = [(2, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "user", "w " * 5000)]
    assert grown(spark, rows) == plain_trie(rows)


# -- quality ---------------------------------------------------------------------------------------------------------------------


def plain_words(text):
    """(kind, word) of runs of letters and digits, and of runs of marks."""
    out = []
    for w in re.findall(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0d]+", (text or "").encode()):
        upper = lambda b: 65 <= b <= 90
        lower = lambda b: 97 <= b <= 122 or b >= 128
        kind = (2 if upper(w[-1]) and len(w) > 1 else 1) if upper(w[0]) else 0 if lower(w[0]) else 3
        out.append((kind, w))
    return out


TEXTS = ["The cat's 12 ÉTÉ été $$$ --x", "", None, "A", "  b\n", "AB Ab aB a.b", "one two three one two three " * 30, "x" * 700 + " y"]


def test_words(monkeypatch):
    column = pa.array([t.encode() if t is not None else None for t in TEXTS], pa.binary())
    for size in (1 << 18, 40):  # whole texts, and texts in blocks
        monkeypatch.setattr(goodness, "BYTES", size)
        place, row = (np.concatenate(x) for x in zip(*goodness._blocks(column), strict=True))
        seen = {}
        at = 0
        for i, t in enumerate(TEXTS):
            own = plain_words(t)
            assert (row[at : at + len(own)] == i).all()
            for p, w in zip(place[at : at + len(own)], own, strict=True):
                assert p // (goodness.PLACES // 4) == w[0]
                assert seen.setdefault(w, p) == p
            at += len(own)
        assert at == len(place)


def test_pooling_and_contexts(monkeypatch):
    column = pa.array([t.encode() if t is not None else None for t in TEXTS], pa.binary())
    place, row = (np.concatenate(x) for x in zip(*goodness._blocks(column), strict=True))
    want = np.zeros((goodness.PLACES, goodness.DIMS))
    index = np.zeros((goodness.PLACES, goodness.DIMS))
    np.put_along_axis(index, goodness._AT, goodness._SIGN, 1)
    for i in range(len(place)):
        for j in range(max(0, i - goodness.WINDOW), min(len(place), i + goodness.WINDOW + 1)):
            if i != j and row[i] == row[j]:
                want[place[i]] += index[place[j]]
    vectors = np.random.default_rng(1).normal(size=(goodness.PLACES, goodness.DIMS)).astype(np.float32)
    for size in (1 << 18, 40):
        monkeypatch.setattr(goodness, "BYTES", size)
        sums = np.zeros(goodness.PLACES * goodness.DIMS, np.int64)
        goodness._contexts(column, sums)
        assert (sums.reshape(want.shape) == want).all()
        x = goodness.pool(column, vectors)
        for i in range(len(TEXTS)):
            v = vectors[place[row == i]].astype(float)
            parts = [v.mean(0), v.std(0), (v[:-1] * v[1:]).sum(0) / max(len(v) - 1, 1), [np.log1p(len(v))]] if len(v) else [np.zeros(3 * goodness.DIMS + 1)]
            assert np.allclose(x[i], np.concatenate(parts), atol=2e-3)


def test_network():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(40, 5)), (rng.random(40) < 0.6).astype(float)
    w = [rng.normal(size=s) for s in ((5, 4), (4,), (4,), (1,))]

    def loss():
        z = goodness._forward(tuple(w), x)[1]
        return np.logaddexp(0, np.where(y > 0, -z, z)).mean() + goodness.DECAY / 2 * ((w[0] ** 2).sum() + (w[2] ** 2).sum())

    for p, g in zip(w, goodness.gradient(tuple(w), x, y), strict=True):
        for k in np.ndindex(p.shape):
            p[k] += 1e-6
            up = loss()
            p[k] -= 2e-6
            down = loss()
            p[k] += 1e-6
            assert abs((up - down) / 2e-6 - g[k]) < 1e-6
    z = rng.normal(size=20_000) * 2
    label = (rng.random(20_000) < 1 / (1 + np.exp(-z))).astype(float)
    assert abs(goodness.temperature(3 * z, label) - 3) < 0.3


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = goodness.fit(docs, labels)
    told = goodness.score(docs, model).toPandas()
    assert len(told) == docs.count() and told["score"].between(0, 1).all()
    assert (told["predicted"] == (told["score"] >= 0.7)).all()
    assert (told["held_out"] == [crc(i) % 4 == 2 for i in told["doc_id"]]).all()
    held = told[told["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert (held["predicted"] == held["quality"]).mean() > 0.98
    loss = -np.log(np.clip(np.where(held["quality"] > 0, held["score"], 1 - held["score"]), 1e-9, 1)).mean()
    assert loss < 0.08  # probabilities, not just an order
    odd = spark.createDataFrame([(i, t, 1, "a") for i, t in enumerate([None, "", "a", "b c " * 20_000])] * 2 + [(None, "x", 1, "a")], "doc_id long, text string, x long, chunk string")
    rows = goodness.score(odd, model).collect()
    assert len(rows) == 9 and len({(r.doc_id, r.score) for r in rows}) == 5 and not any(r.held_out for r in rows if r.doc_id is None)
    none = goodness.fit(odd, labels.limit(0))
    assert {r.score for r in goodness.score(odd, none).collect()} == {0.5}
    assert {r.score for r in goodness.score(odd, goodness.fit(odd, spark.createDataFrame([(0, 1), (1, 1), (3, None)], "doc_id long, quality int"))).collect()} <= {0.5, 1.0}
    assert goodness.score(odd.limit(0), goodness.fit(odd.limit(0), labels)).count() == 0
