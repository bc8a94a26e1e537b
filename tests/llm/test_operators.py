"""Each operator on a small table with nulls, empty and long texts, ties, repeated rows and extra columns, against a plain version."""

import collections
import hashlib
import math
import os
import random
import re
import time
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from quillgraph.llm import extract, mixing, neardup, quality, repeats, scoring, subwords, toxicity, urls, vectors
from quillgraph.llm.common import CLEANUP, components, durable, passing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, value long, key string, rep long, n long"


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def words(s):
    return re.findall("[^\x20\x09-\x0d]+", low(s))


def texts(seed=3, size=60):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("aeiourstlnmdé") for _ in range(r.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage = prose(60)
    out = [None, "", " \n\t ", "one", "one", "two words", "a b c d", "a b c d e", prose(6000), prose(80), "x" * 900, "ab" * 500, "É" * 300]
    for _ in range(size):
        base = prose(r.randint(5, 120))
        out += [base]
        if r.random() < 0.4:
            out += [base, base.upper()]
        if r.random() < 0.5:
            w = base.split()
            for _ in range(r.randint(1, 3)):
                w[r.randrange(len(w))] = "edit"
            out += [" ".join(w), "\n".join(w)]
        if r.random() < 0.3:
            out += [prose(3) + passage + prose(r.randint(1, 30))]
    line = prose(9)
    return out + ["\n".join([line, line, "", prose(5), line])]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, "en", [None, "a", "b", "hot", "hot", "hot", "Z"][i % 7], len(t or ""), 1, "k", 2, 3) for i, t in enumerate(texts())]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


class Sets:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def test_components(spark):
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(80)] + [(7, 7)]
    s = Sets(range(400))
    for a, b in edges:
        s.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: s.find(n) for e in edges for n in e if e[0] != e[1] or s.find(n) != n or any(n in x and x[0] != x[1] for x in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [64, 2])
def test_near_duplicates(table, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows, df = table
    sets = {}
    for i, t, *_ in rows:
        w = words(t)
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    s = Sets(sets)
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                s.join(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()}
    assert got == {i: (len(sets[i]), s.find(i), s.find(i) == i) for i in sets}
    assert sum(not k for _, _, k in got.values()) > 20


def test_deduplicate_rows_without_an_id_of_their_own(spark):
    """Repeated rows and rows with a null id are documents like others: one of each group stays."""
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(40)) for k in "abcd")
    rows = [(1, a), (1, a), (2, b), (2, c), (None, a), (None, d), (None, d), (None, d + " end"), (None, None), (3, c.upper()), (4, "alone"), (None, "other")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "k", 2, 3) for i, t in rows], SCHEMA).repartition(3)
    got = neardup.deduplicate(df)
    assert got.columns == df.columns
    texts_left = sorted((r.text or "").lower().removesuffix(" end") for r in got.collect())
    assert texts_left == sorted([a, b, c, d, "alone", "other", ""])


def test_union_sketch_estimates():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(1, 2**60, 400))
    b = np.unique(np.append(a[:300], r.integers(1, 2**60, 60)))
    both = np.array([a[:32], b[:32]])
    union = np.union1d(a, b)[:32]
    assert neardup.union_shared(both[:1], both[1:])[0] == len(np.intersect1d(np.intersect1d(a, b), union))


def test_candidates_and_links_of_a_task(monkeypatch):
    """Inverted lists, sketch filter and exact Jaccard against all pairs by brute force, whether pairs are verified one by one or at once."""
    r = np.random.default_rng(14)
    sets = []
    for n in [3, 5, 24, 25, 60, 400] * 4:
        s = np.unique(r.integers(1, 2**62, n).astype(np.uint64))
        sets += [s] + [np.unique(np.append(r.permutation(s)[: max(1, int(n * x))], r.integers(1, 2**62, max(0, n // 12)).astype(np.uint64))) for x in (0.95, 0.85, 0.6)]
    ids = np.arange(len(sets)) * 7
    union = Sets(ids.tolist())
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                union.join(int(ids[a]), int(ids[b]))
    for most in (1000, 0):
        monkeypatch.setattr(neardup, "PAIRWISE", most)
        found = Sets(ids.tolist())
        for a, b in neardup.forest(ids, sets, neardup.candidates(sets)):
            found.join(a, b)
        assert all(found.find(int(i)) == union.find(int(i)) for i in ids)


def brute_repeats(rows, length):
    raw = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = collections.Counter(b[s : s + length] for _, b in raw for s in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        cover = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                cover[s : s + length] = b"\1" * length
        kept = bytes(c for c, m in zip(b, cover, strict=True) if not m)
        spans = sum(1 for k in range(len(b)) if cover[k] and (k == 0 or not cover[k - 1]))
        out.append((i, len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("bucket", [256, 2])
def test_repeats(spark, table, monkeypatch, bucket):
    monkeypatch.setattr(repeats, "BUCKET", bucket)
    rows, _ = table
    rows = [*rows, rows[20], rows[8]]  # repeated rows
    got = repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA)).drop("kept")
    assert sorted(tuple(r) for r in got.collect()) == brute_repeats(rows, repeats.LENGTH)


def test_formulas_stay(spark):
    page = "<html><body><article><h1>Energy</h1><p>" + "Long enough a text to be an article. " * 8 + "</p><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>E=m</annotation></math> here.</p></article></body></html>"
    got = extract.extract(spark.createDataFrame([(1, "http://a.org/", page)], "page_id long, url string, html string")).first()
    assert got.text.split("\n")[-1] == "Energy is E=m here."


def test_ordinal_fit_is_the_least():
    """Against the penalised likelihood as it is told, by itself: no step in any direction makes it less."""
    rng = np.random.default_rng(5)
    hits = rng.random((120, 6)) < 0.4
    grade = np.clip((hits @ np.array([2.0, 1, 0, -1, 0.5, 0]) + rng.normal(size=120)).astype(int), 0, toxicity.GRADES - 1)
    row, at = np.nonzero(hits)
    w, theta = toxicity._solve(row, at, grade, 6, steps=3000)

    def loss(w, theta):
        x = hits @ w
        over = np.column_stack([np.ones(120), *(1 / (1 + np.exp(t - x)) for t in theta), np.zeros(120)])
        return -np.log(over[np.arange(120), grade] - over[np.arange(120), grade + 1]).sum() + 0.02 / 2 * (w**2).sum()

    assert (np.diff(theta) > 0).all()
    least = loss(w, theta)
    for _ in range(300):
        step = rng.normal(size=9)
        step *= rng.choice([1e-3, 1e-2, 1e-1]) / np.linalg.norm(step)
        assert loss(w + step[:6], theta + step[6:]) > least - 1e-4
    flat = loss(np.zeros(6), np.array([0.1, 0.2, 0.3]))
    assert least < flat - 20


def test_toxicity_scores_are_those_of_its_features(spark):
    """Whole texts scored word by word, with a set of features."""
    r = random.Random(3)
    vocabulary = ["".join(r.choice("abcdé") for _ in range(r.randint(2, 9))) for _ in range(40)]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60))).replace("a", "A", i % 5), i) for i in range(50)] + [(90, None, 1), (91, "", 1), (92, "x" * 20_000, 1)]

    def marks(word):
        return set(toxicity._marks(np.frombuffer(word, np.uint8), np.array([0, len(word)]))[1].tolist())

    features = np.array(sorted({h for w in vocabulary[:12] for h in marks(w.encode())}), np.uint64)
    model = toxicity.Ordinal(features, np.linspace(-1, 1, len(features)), np.array([0.5, 1.0, 2.5]))
    weight = dict(zip(features.tolist(), model.weights, strict=True))
    for x in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, grade long"), model).collect():
        seen = {h for w in words(dict((i, t) for i, t, _ in rows)[x.doc_id]) for h in marks(w.encode())}
        over = [1 / (1 + math.exp(t - sum(weight.get(h, 0) for h in seen))) for t in model.thresholds]
        assert abs(x.severity - sum(over)) < 1e-9 and abs(x.p_toxic - over[0]) < 1e-9 and x.rejected == (over[0] >= 0.5)


def test_a_shared_passage_sends_no_sets(spark, monkeypatch):
    """Documents that share a passage and are else their own hang together by it, but aren't compared by their sets; links among them are still found."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(8))
    notice = " ".join(word() for _ in range(90))
    own = [" ".join(word() for _ in range(110)) for _ in range(400)]
    rows = [(i, f"{t} {notice}") for i, t in enumerate(own)] + [(1000 + i, f"{own[i]} end {notice}") for i in range(0, 400, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen = neardup.sketches(df)
    reps = seen.select(F.col("doc_id").alias("rep"), "n", "sketch")
    clusters = durable(neardup._clusters(reps))
    assert clusters.groupBy("cluster").count().agg(F.max("count")).first()[0] > 64
    for wide in (512, 50):
        monkeypatch.setattr(neardup, "WIDE", wide)
        left = neardup._with_partners(df, clusters)
        assert 20 <= left.count() < 60
        got = {x.doc_id: x.component_id for x in neardup.near_duplicates(df).collect()}
        assert got == {i: i - 1000 if i >= 1000 else i for i, _ in rows}


def test_rows_that_repeat_are_one(spark):
    r = random.Random(12)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    long, short, other = text(2000), text(150), text(900)
    def table(copies):
        return spark.createDataFrame([(1, long)] * copies + [(None, other)] * copies + [(2, short)] * copies + [(3, text(50) + long[100:400]), (4, "x" + other), (None, None), (None, None)], "doc_id long, text string").repartition(3)
    def contexts(df):
        told, many = repeats.counted(df, "doc")
        return repeats.repeated_spans(repeats.once(told, many)[0])[0].where("anchor IS NOT NULL").count()
    r.seed(1)
    few = table(2)
    r.seed(1)
    lots = table(1000)
    assert contexts(few) == contexts(lots)
    got = repeats.remove_repeats(lots).toPandas()
    assert len(got) == 3004
    tell = lambda d: {(int(x.n_bytes), int(x.n_removed), int(x.n_spans)) for x in got[d].itertuples()}
    assert tell(got.doc_id == 1) == {(2000, 2000, 1)} and tell(got.doc_id == 2) == {(150, 0, 0)} and (got.doc_id == 1).sum() == 1000
    assert tell(got.doc_id == 3) == {(350, 300, 1)} and tell(got.doc_id == 4) == {(901, 900, 1)} and tell(got.doc_id.isna()) == {(900, 900, 1), (0, 0, 0)}
    left = repeats.rewrite(lots).groupBy("doc_id", "text").count().collect()
    assert {(x.doc_id, x.text if x.text is None else len(x.text)): x["count"] for x in left} == {(1, 0): 1000, (None, 0): 1000, (2, 150): 1000, (3, 50): 1, (4, 1): 1, (None, None): 2}


def test_texts_whose_keys_clash(spark, table, monkeypatch):
    """Keys of 4 bits clash at once; the rows that share one get another, so each text keeps its own spans and every row its columns."""
    key = repeats._key
    monkeypatch.setattr(repeats, "_key", lambda seed: F.pmod(key(seed), F.lit(16)) if seed == 1 else key(seed))
    rows = [*table[0], table[0][20]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert repeats.keyed(df, "k").select("k").distinct().count() > 16
    got = repeats.remove_repeats(df).drop("kept")
    assert sorted(tuple(r) for r in got.collect()) == brute_repeats(rows, repeats.LENGTH)
    assert repeats.rewrite(df).count() == len(rows)


def test_passing_tables(spark):
    """Tables written inside go, those kept are the next one's out, and what fails inside leaves nothing behind."""
    there = lambda df: os.path.exists(df._durable_path)
    with passing() as outer:
        a = outer(durable(spark.range(3)))
        with passing() as inner:
            b, c = durable(spark.range(4)), inner(durable(spark.range(5)))
        assert there(a) and not there(b) and there(c) and c.count() == 5
    assert there(a) and not there(c)
    with pytest.raises(ZeroDivisionError), passing():
        d = durable(spark.range(2))
        assert there(d)
        1 // 0
    assert not there(d)
    e = durable(spark.range(6))
    assert there(e)
    assert spark.conf.get(CLEANUP) == "false"


def test_rewrite(spark, table):
    rows, df = table
    want = {i: removed for i, _, removed, _, _ in brute_repeats(rows, repeats.LENGTH)}
    got = repeats.rewrite(df).collect()
    assert len(got) == len(rows)
    assert all(want[r.doc_id] or r.text == rows[r.doc_id][1] for r in got)
    assert all(not want[r.doc_id] or r.n_chars == len(r.text) for r in got)


def test_maximal_repeats():
    r = random.Random(2)
    for _ in range(30):
        ts = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 40))) for _ in range(3)]
        want = {}
        for n in range(3, 41):
            at = collections.defaultdict(list)
            for k, t in enumerate(ts):
                for i in range(len(t) - n + 1):
                    at[t[i : i + n]].append((k, i))
            for w, places in at.items():
                side = lambda d: {ts[k][i + d] if 0 <= i + d < len(ts[k]) else (k, i, d) for k, i in places}  # noqa: B023, E731
                if len(places) > 1 and len(side(-1)) > 1 and len(side(len(w))) > 1:
                    want[w] = (n, sorted(places))
        assert repeats.maximal_repeats(ts, 3) == sorted(want.values())


def test_quality(table):
    rows, df = table
    got = {r.doc_id: r for r in quality.verdicts(df).collect()}
    for i, t, *_ in rows:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        tri = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        marked = {p + k for p in range(len(w) - 2) if tri[tuple(w[p : p + 3])] > 1 for k in range(3)}
        ls = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(ls) - len(set(ls)), len(marked)), i
        assert got[i].base_failed == (len(w) < 50 or 100 * len(marked) > 50 * len(w))
        assert not (got[i].base_failed and got[i].kept)


def test_policies_and_ablation(table):
    entries = quality.ledger(table[1]).cache()
    failed = [r.failed for r in entries.collect()]
    told = {r.rule: r for r in quality.ablation(entries, quality.PROSE).collect()}
    for name, bit in quality.BIT.items():
        assert told[name].n_failed == sum(bool(f & bit) for f in failed)
        assert told[name].n_only == sum(f == bit for f in failed)
        assert told[name].n_kept_without == sum(not f & ~bit for f in failed)


def fill(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, out, open_ = sum(sizes.values()), {}, set(order)
    while open_:
        share = left / sum(w[s] for s in open_)
        over = [s for s in open_ if share * w[s] >= most * sizes[s]]
        if not over:
            return out | {s: share * w[s] for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


@pytest.mark.parametrize("cell", [2000, 2])
def test_mixing(spark, table, monkeypatch, cell):
    monkeypatch.setattr(mixing, "CELL_ROWS", cell)
    rows, df = table
    size = {i: len(words(t)) for i, t, *_ in rows}
    source = {i: s for i, _, _, s, *_ in rows}
    total = collections.Counter()
    for i in size:
        total[source[i]] += size[i]
    want = fill(total)
    got = mixing.mix(df).collect()
    key = {r.doc_id: r.k & (2**64 - 1) for r in df.select("doc_id", F.xxhash64(F.lit(1), F.col("doc_id").cast("string")).alias("k")).collect()}
    plain = {}
    for s in total:
        budget = math.floor(want[s] + 0.5)
        times, rest = divmod(budget, total[s]) if total[s] else (0, 0)
        for i in sorted((i for i in size if source[i] == s), key=lambda i: (key[i], i)):
            part = min(rest, size[i])
            plain[i] = times * size[i] + part
            rest -= part
    assert {r.doc_id: r.taken for r in got} == plain
    assert all(r.size == size[r.doc_id] and r.source_size == total[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]]) and r.taken <= 3 * r.size for r in got)
    laid = mixing.materialise(df, mixing.mix(df))
    assert laid.columns == df.columns
    assert sum(len(words(r.text)) for r in laid.collect()) == sum(plain.values())


def test_urls(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    r = random.Random(4)
    pages = [(0, None), (1, ""), (2, "no scheme"), (3, "http://"), (4, "HTTP://A.Example.ORG/es/x"), (5, "http://example.org/en/12?q#f"), (6, "http://notexample.org/es/"), (7, "http://org?x"), (8, "http://com/FR/"), (9, "http://x.com/fr"), (9, "http://x.com/fr/")]
    pages += [(i, f"https://{r.choice(['a.', '', 'b.c.'])}{r.choice(['example.org', 'x.com', 'com', 'y.net', 'example.org.'])}{r.choice(['/', '/es/1', '/en/1', '/en/2', '/fr/', '/de/z', ''])}{r.choice(['', '?a=/es/', '#x'])}") for i in range(10, 300)]

    def judge(url):
        if not url or "://" not in url:
            return "", "", None, "allow"
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = low(m[1]), m[2]
        best = max(((len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
        return host, path, best and best[1], best[2] if best else "allow"

    df = spark.createDataFrame([(i, u, "k") for i, u in pages], "page_id long, url string, key string")
    got = sorted((tuple(r) for r in urls.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()), key=repr)
    assert got == sorted(((i, *judge(u)) for i, u in pages), key=repr)
    many = spark.range(5000).select(F.concat(F.lit("h"), "id", F.lit(".example")).alias("host"), F.lit("/").alias("path"), F.lit("block").alias("verdict"))
    asked = spark.range(4000, 6000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://w.h"), "id", F.lit(".example/p")).alias("url"))
    assert urls.judge(asked, many).where("verdict = 'block'").count() == 1000
    assert urls.judge(asked.limit(0), many.limit(0)).count() == 0


def test_scoring(spark, table):
    rows, df = table
    tokens = {i: [*words(t), None] for i, t, *_ in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for head in (1 << 17, 5):
        scoring_head, scoring.HEAD = scoring.HEAD, head
        try:
            got = {r.doc_id: r for r in scoring.score(df).collect()}
        finally:
            scoring.HEAD = scoring_head
        for i, ws in tokens.items():
            assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
            assert got[i].base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
            assert got[i].score < 0


def test_scores_beat_a_unigram_of_subwords(spark):
    """On held-out documents of the sample tables, by half a decade a word at least."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = scoring.score(docs).collect()
    texts, ranks = dict(docs.select("doc_id", "text").collect()), scoring.ranks_of(scoring.VOCABULARY)
    cutter, counts, cut = scoring.Words(ranks), np.zeros(1 << 16), {}
    for r in got:
        data = np.frombuffer((texts[r.doc_id] or "").encode(), np.uint8)
        cut[r.doc_id] = np.append(cutter(data, np.array([0, len(data)]))[0].astype(np.int64), len(scoring.begins_of(ranks)) - 1)
        counts += 0 if r.held_out else np.bincount(cut[r.doc_id], minlength=1 << 16)
    log = np.log10((counts + 1) / (counts.sum() + len(scoring.begins_of(ranks))))
    held = [r for r in got if r.held_out]
    n = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / n > sum(log[cut[r.doc_id]].sum() for r in held) / n + 0.5


def _toy(seed=2, spread=1.0):
    r = np.random.default_rng(seed)
    n = scoring.GROUPS * scoring.GROUP + 300
    kinds = scoring.classes(r.integers(0, 50, n).astype(float), r.random(n) < 0.4)
    model = scoring.Attention(kinds)
    for k in ("one", "two", "near"):
        model.w[k] = (model.w[k] + r.normal(0, spread, model.w[k].shape)).astype(np.float32)
    return r, n, kinds, model


def plain_log(model, kinds, ids, t):
    """log-probability of every id after the first t of a text, for the window that scores place t: one query, explicit sums."""
    w = {k: v.astype(np.float64) for k, v in model.w.items()}
    lo = t // scoring.STRIDE * scoring.STRIDE - scoring.STRIDE
    rows = [kinds.START if p == 0 else kinds.inputs[ids[p - 1]] for p in range(max(lo, 0), t + 1)]
    x = w["emb"][rows]
    q = x[-1] @ w["q"] / math.sqrt(scoring.WIDTH)
    e = np.exp([q @ (x[j] @ w["k"]) + w["near"][len(rows) - 1 - j] for j in range(len(rows))])
    z = x[-1] + (e / e.sum()) @ (x @ w["v"])
    u = z + np.maximum(z @ w["a"] + w["ab"], 0) @ w["b"]
    one = u @ w["one"] + w["one_b"]
    one -= np.log(np.exp(one).sum())
    out = one[kinds.of] + kinds.share
    for g in range(scoring.GROUPS):
        two = u @ w["two"][g] + w["two_b"][g]
        two -= np.log(np.exp(two).sum())
        mine = kinds.of == g
        out[mine] += two[kinds.place[mine]]
    return out


def test_scores_are_probabilities():
    """Batched, overlapping scoring gives each token once what a plain pass over its window gives, and all ids sum to 1."""
    r, n, kinds, model = _toy(spread=0.3)
    size = np.array([1, 40, 34, 16, 17])
    ids = r.integers(0, n, size.sum())
    got = scoring.score_of(model.ready(), kinds, ids, size)
    for k, (i, s) in enumerate(zip(np.append(0, size.cumsum()), size, strict=False)):
        text = ids[i : i + s]
        logs = [plain_log(model, kinds, text, t) for t in range(s)]
        assert all(np.exp(x).sum() == pytest.approx(1, abs=1e-4) for x in logs)
        assert got[k] == pytest.approx(sum(x[text[t]] for t, x in enumerate(logs)) / math.log(10), rel=1e-4)
    changed = ids.copy()
    changed[-1] = (ids[-1] + 1) % n  # what comes later tells on nothing before
    logs = [plain_log(model, kinds, x[-17:], 16) for x in (ids, changed)]
    assert np.allclose(*logs)


def test_gradient():
    r, n, kinds, model = _toy(3, 0.2)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    size = np.array([30, 70])
    rows, target, _, opens = scoring.blocks(kinds, r.integers(0, n, 100), size)
    rows, target, opens = rows[: len(rows) // 2 * 2], target[: len(rows) // 2 * 2], opens[: len(rows) // 2 * 2]
    some, at = np.maximum(target, 0), np.array([3, 9])
    cls, place, real = kinds.of[some][1::2], kinds.place[some][1::2], (target >= 0)[1::2]

    def loss():
        w = model.w
        kv = np.concatenate([w["emb"] @ w["k"], w["emb"] @ w["v"]], 1)[rows]
        late = rows[1::2][:, at]
        q = w["emb"][late] @ w["q"] * np.float32(scoring.WIDTH**-0.5)
        e, total, _, value = model.attend(q, kv, model.near(at)[0], opens[1::2], 2)
        _, u = model.up((e @ value / total[:, :, None] + w["emb"][late]).reshape(-1, scoring.WIDTH))
        c, p, ok = cls[:, at].ravel(), place[:, at].ravel(), real[:, at].ravel()
        one = u @ w["one"] + w["one_b"]
        log = one[np.arange(len(u)), c] - np.log(np.exp(one).sum(1))
        for k in np.flatnonzero(c < scoring.GROUPS):
            two = u[k] @ w["two"][c[k]] + w["two_b"][c[k]]
            log[k] += two[p[k]] - np.log(np.exp(two).sum())
        return -(log * ok).sum() / ok.sum()

    grads = model.gradient(rows, opens[1::2], real, cls, place, at)
    for name, w in model.w.items():
        moved = np.argwhere(np.abs(grads[name]) > 1e-4)
        for where in map(tuple, moved[r.integers(0, len(moved), 3)]):
            kept = w[where]
            w[where] = kept + 1e-5
            up = loss()
            w[where] = kept - 1e-5
            slope = (up - loss()) / 2e-5
            w[where] = kept
            assert grads[name][where] == pytest.approx(slope, rel=2e-3, abs=1e-5), name


def test_a_step_sums_each_input_row_once(monkeypatch):
    """What goes back to the input table is one row of WIDTH numbers for each input, not one for each of query, row, key and value."""
    r, n, kinds, model = _toy(4, 0.2)
    rows, target, _, opens = scoring.blocks(kinds, r.integers(0, n, 400), np.array([150, 250]))
    rows, target, opens = rows[: len(rows) // 2 * 2], target[: len(rows) // 2 * 2], opens[: len(rows) // 2 * 2]
    some, summed, scatter = np.maximum(target, 0), [], scoring.scatter

    def counted(at, values, size):
        summed.append(values.size)
        return scatter(at, values, size)

    monkeypatch.setattr(scoring, "scatter", counted)
    model.gradient(rows, opens[1::2], (target >= 0)[1::2], kinds.of[some][1::2], kinds.place[some][1::2], np.arange(scoring.STRIDE))
    assert sum(summed) == rows.size * scoring.WIDTH


def test_logits_are_levelled_only_where_exp_needs_it():
    """Exp is taken of logits as they are, without a pass for each row's largest, and of large or vanishing ones less that; scores are the same."""
    r, n, kinds, model = _toy(5, 0.3)
    q, kv, opens = (r.normal(0, 1, s).astype(np.float32) for s in ((2, 3, scoring.WIDTH), (4, scoring.STRIDE, 2 * scoring.WIDTH), (2,)))
    bias = model.near(np.array([1, 5, 15]))[0]
    win = kv.reshape(2, scoring.WINDOW, -1)
    for size, levelled in ((1, False), (100, True), (-100, True)):
        logits = np.einsum("ntd,nsd->nts", q * np.float32(abs(size)), win[:, :, : scoring.WIDTH].astype(np.float64)) + bias + min(size, 0) * 10
        e, total, _, _ = model.attend(q * np.float32(abs(size)), kv, bias + np.float32(min(size, 0) * 10), opens > 9, 2)
        assert np.isfinite(e).all() and (total > 0).all()
        assert np.allclose(e, np.exp(logits - levelled * logits.max(2, keepdims=True)), rtol=1e-2, atol=1e-5)
    for k, by in (("one", 60), ("two", 60), ("q", 20)):
        model.w[k] *= np.float32(by)
    for k in ("one_b", "two_b"):
        model.w[k] -= np.float32(200)
    ids = r.integers(0, n, 50)
    got = scoring.score_of(model.ready(), kinds, ids, np.array([50]))
    want = sum(plain_log(model, kinds, ids, t)[ids[t]] for t in range(50)) / math.log(10)
    assert got[0] == pytest.approx(want, rel=1e-3)


def test_training_learns_order():
    """A text that always goes on the same way is soon expected to."""
    n = scoring.GROUPS * scoring.GROUP + 10
    kinds = scoring.classes(np.ones(n), np.zeros(n, bool))
    model = scoring.Attention(kinds)
    adam, ids, size = scoring.Adam(model, 0.02), np.tile(np.arange(10), 600), np.full(60, 100)
    before = scoring.score_of(model.ready(), kinds, ids, size).sum()
    for _ in range(150):
        scoring.train_on(model, adam, kinds, ids, size)
    after = scoring.score_of(model.ready(), kinds, ids, size).sum() / len(ids)
    assert before / len(ids) < -3
    assert after > -0.3


def test_training_leaves_no_window_out(monkeypatch):
    """Each id of each text is an input once, in windows that begin at either block, and targets lie in the later half of each window."""
    size = np.append(np.arange(1, 80), 700)
    n = scoring.GROUPS * scoring.GROUP + 10
    ids = np.random.default_rng(1).integers(0, n, size.sum())
    kinds = scoring.classes(np.ones(n), np.zeros(n, bool))
    model, told, places = scoring.Attention(kinds), np.zeros(kinds.ROWS, int), set()

    class Steps:
        t = 0

        def step(self, g):
            self.t += 1

    def gradient(rows, opens, real, cls, place, at):
        np.add.at(told, rows.ravel(), 1)
        places.update(at.tolist())
        return {}

    monkeypatch.setattr(model, "gradient", gradient)
    monkeypatch.setattr(scoring, "BATCH", 3)
    seen = scoring.train_on(model, Steps(), kinds, ids, size)
    inputs = np.concatenate([kinds.inputs[t[:-1]] for t in np.split(ids, size.cumsum()[:-1])])
    want = np.bincount(inputs, minlength=kinds.ROWS)
    want[kinds.START] = len(size)
    want[kinds.NONE] = told[kinds.NONE]
    assert told.tolist() == want.tolist()
    assert places == set(range(scoring.STRIDE))
    assert seen > len(ids) / 40


def test_every_id_is_a_target_once(monkeypatch):
    """Of texts of all lengths every id, the end included, is told once, whatever windows a step has."""
    size = np.append(np.arange(1, 80), 700)
    n = scoring.GROUPS * scoring.GROUP + 10
    ids = np.random.default_rng(2).integers(0, n, size.sum())
    kinds = scoring.classes(np.ones(n), np.zeros(n, bool))
    told = np.zeros((scoring.GROUPS + 1, scoring.GROUP), int)

    def gradient(self, rows, opens, real, cls, place, at):
        some = real[:, at]
        np.add.at(told, (cls[:, at][some], place[:, at][some]), 1)
        return {}

    monkeypatch.setattr(scoring.Attention, "gradient", gradient)
    monkeypatch.setattr(scoring, "BATCH", 3)
    model = scoring.Attention(kinds)
    seen = scoring.train_whole(model, scoring.Adam(model, 0.01), kinds, ids, size)
    want = np.zeros_like(told)
    np.add.at(want, (kinds.of[ids], kinds.place[ids]), 1)
    assert seen == len(ids) and (told == want).all()


def test_words_are_cut_like_whole_texts(table):
    """Ids, and the keys of words, are those of each word alone, whatever was kept before."""
    rows, _ = table
    ranks = scoring.ranks_of(scoring.VOCABULARY)
    cutter, begins = scoring.Words(ranks), scoring.begins_of(ranks)
    for t in [(t or "") for _, t, *_ in rows][:60] + ["a\u00a0b \u2003 'tis  x\x0by 12,5", "\U0001f600 ok"]:
        data = np.frombuffer(t.encode(), np.uint8)
        ids, size, text, keys = cutter(data, np.array([0, len(data)]))
        want = [cutter.bpe.encode_ordinary(" " + w) for w in words(t)]
        assert ids.tolist() == [x for w in want for x in w]
        assert (size.tolist(), len(text), len(keys)) == ([len(ids)], len(want), len(want))
        assert np.flatnonzero(begins[ids.astype(int)]).tolist() == np.cumsum([0, *map(len, want)])[:-1].tolist()


def test_subwords(spark, table):
    rows, df = table
    sp = sentencepiece.SentencePieceProcessor(model_file=subwords.MODEL)
    encoded = subwords.encode(df)
    got = {r.doc_id: r for r in encoded.collect()}
    for i, t, *_ in rows:
        assert got[i].ids == sp.encode(t or ""), i
        assert got[i].n_pieces == len(got[i].ids)
        assert got[i].decoded_same
    assert {r.doc_id: r.text for r in subwords.decode(encoded).collect()} == {i: t or "" for i, t, *_ in rows}


def test_subwords_of_odd_texts():
    sp = sentencepiece.SentencePieceProcessor(model_file=subwords.MODEL)
    encoder, r = subwords.Encoder(subwords.read_model()), random.Random(1)
    odd = ["", " ", "  ", "\n", "\n\n a", "a\n", "a \n b", "  a  b ", "▁a▁b", "▁▁", "日本語 テスト", "\ta\tb", "a\0b", "x" * 1000, "<s> </s>", " " * 40 + "q", "😀😀 ok"]
    odd += ["".join(r.choice("ab \n▁é😀<s>\t") for _ in range(r.randint(1, 60))) for _ in range(400)]
    odd += ["".join(r.choice("theinraosd") for _ in range(r.randint(250, 900))) for _ in range(10)]
    ids, size = encoder([t.encode() for t in odd])
    at = np.append(0, size.cumsum())
    assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)] == sp.encode(odd)


def test_toxicity(spark, empty):
    r = random.Random(6)
    bad = ["idiot", "moron", "scum"]
    clean = ["".join(r.choice("aeiourstln") for _ in range(5)) for _ in range(400)]
    rows, labels = [], []
    for i in range(900):
        w = [r.choice(clean) for _ in range(r.randint(5, 200))]
        toxic = i % 5 == 0
        for _ in range(r.randint(1, 4) if toxic else 0):
            w[r.randrange(len(w))] = r.choice(bad)
        rows.append((i, " ".join(w), "en", "s", 1, 1, "k", 2, 3))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    rows += [(1000, None, None, None, None, 1, "k", 2, 3), (1001, "", None, None, None, 1, "k", 2, 3), (None, "idiot scum moron", None, None, None, 1, "k", 2, 3)]
    labels += [(None, 1, 1), (2000, 1, 1), (7, 1, None)]
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, known)
    assert (np.diff(model.thresholds) > 0).all()
    got = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    unseen = [i for i in range(900) if i % 2]
    assert np.mean([got[i].rejected == (i % 5 == 0) for i in unseen]) > 0.97
    assert not got[1000].rejected and not got[1001].rejected and got[None].rejected
    assert all(0 <= x.severity <= toxicity.GRADES - 1 for x in got.values())
    assert got[None].severity > 1
    kept = toxicity.keep(docs, model)
    assert kept.columns == docs.columns
    assert {x.doc_id for x in kept.collect()} == {i for i, x in got.items() if not x.rejected}
    none = toxicity.fit(docs, known.where("toxic = 0"))
    assert toxicity.score(docs, none).where("rejected").count() == 0
    assert toxicity.score(empty, toxicity.fit(empty, known.limit(0))).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/a">menu</a></li></ul></nav><div id="cookie-notice">We use cookies</div>
<ARTICLE class=post><h1>Head &amp; line</h1><p>First   <b>par</b>agraph<br>goes on &eacute;&#233; here.</p><script>var t="</p>";</script><div class="ad">Buy now!</div><p>Short.</p><p>Another, <a href="x">with a link</a> inside.<p>Not closed</article>
<form><label>Name</label><input></form><aside>Side</aside><section class="comments"><article><p>Great article!</p></article></section><footer>&copy; foot</footer></body></html>"""


def test_main_text(spark):
    want = "Head & line\nFirst paragraph goes on éé here.\nShort.\nAnother, with a link inside.\nNot closed"
    odd = {0: (None, ""), 1: ("", ""), 2: ("<", ""), 3: ("<p>a<b", "a"), 4: ("&lt;p&gt; x", "<p> x"), 5: (PAGE, want), 6: (PAGE[: PAGE.index("Another,") + 8], "Head & line\nFirst paragraph goes on éé here.\nShort.\nAnother,"), 7: (PAGE.replace("ARTICLE class=post", "div").replace("Not closed</article>", "Not closed</div>"), want), 8: ("<nav>only a menu</nav>", ""), 9: ("<p>" + "long words " * 50_000 + "</p>", ("long words " * 50_000).strip())}
    df = spark.createDataFrame([(i, f"u{i}", h, "extra") for i, (h, _) in odd.items()], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in extract.extract(df).collect()}
    for i, (_, text) in odd.items():
        assert got[i].text == text, i
        assert (got[i].n_chars, got[i].url) == (len(text), f"u{i}")


def test_main_text_without_marks():
    """A short headline, a closing paragraph and paragraphs of links belong to the text, however much noise lies between."""
    noise = '<div class="byline">By A</div><div class="share">Share</div><div class="tags">Tag one</div><div class="ad">Buy</div>'
    body = "".join(f"<p>{'Long paragraph of the body. ' * 20}{k}</p>" for k in range(5))
    texts = ["Headline"] + [f"{'Long paragraph of the body. ' * 20}{k}" for k in range(5)] + ["See a long report on the matter", "The end."]
    last = '<p>See <a href="r">a long report on the matter</a></p>'
    menu = '<div><a href="a">Home</a> | <a href="b">About</a></div>' * 5
    flat = f"<body>{menu}<div><h1>Headline</h1>{noise}{body}{noise}{last}{noise}<p>The end.</p></div>{menu}<div>Elsewhere.</div></body>"
    assert extract.main_text(flat) == "\n".join(texts)
    nested = f"<body>{menu}<div><h1>Headline</h1>{noise}<div>{body}{noise}{last}{noise}<p>The end.</p></div></div>{menu}<div>Elsewhere.</div></body>"
    assert extract.main_text(nested) == "\n".join(texts)


def test_main_text_beside_a_marked_teaser():
    body = [f"{'Long paragraph of the body. ' * 20}{k}" for k in range(5)]
    got = extract.main_text("<body><div><h1>Headline</h1>" + "".join(f"<p>{x}</p>" for x in body) + "</div><article><p>Read this next.</p></article></body>")
    assert got.split("\n") == ["Headline", *body, "Read this next."]


LONG = "Long paragraph of the body. " * 8


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>t</title><body><article><p>{LONG}</p></article>",
        f"<title>never ends<body><article><p>{LONG}</p></article>",
        f"<article><select><option>x<p>{LONG}</p></article>",
        f"<article><iframe src=x><p>{LONG}</p></article>",
        f"<article><object data=x><svg><p>{LONG}</p></article>",
        f'<article class="post share-enabled"><p>{LONG}</p></article>',
        f'<article><div class="side-by-side"><p>{LONG}</p></div></article>',
        f'<article><div class="post tag-news tags"><p>{LONG}</p></div></article>',
        f'<body><div class="sidebar-wrapper"><div><p>{LONG}</p><div class="ad">Buy</div></div></div>',
        f'<article><p title="never ends>{LONG}</p></article>',
        f'<article><p title=\'a > b\' data-x="<p>no</p>">{LONG}<script>if (a < b) "</p>"</script></article>',
        f"<body><div>About us</div><div>Shop</div><div>Cart</div><div><a>x</a></div><div><a>x</a></div><div><a>x</a></div><div><p>{LONG}</p></div></body>",
    ],
)
def test_odd_markup(page):
    assert extract.main_text(page) == LONG.strip()


def test_open_button():
    assert extract.main_text(f"<article><p>{LONG}</p><button>Share<p>More text</p></article>") == LONG.strip() + "\nMore text"


def test_surges_and_dives():
    """Against plain sums over every window."""
    r = random.Random(3)
    for _ in range(300):
        w = [r.choice([0, 0, 0, 5, 40]) for _ in range(r.randint(0, 30))]
        s = [sum(w[i : i + extract.WINDOW]) for i in range(len(w))]
        assert extract.sums(w) == s
        inside = {k for i, j, _ in extract.stretches(w) for k in range(i, j)}
        assert {k for k, x in enumerate(w) if x} <= inside
        assert all(s[k] > 0 for k in inside)
        for i, j, peak in extract.stretches(w):
            assert w[i] > 0 and (j == len(w) or s[j] == 0) and peak == max(s[max(0, i - extract.WINDOW + 1) : j])


@pytest.mark.parametrize("page", ['<p title="x>text ' * 100_000, "<p class='a>b " * 100_000, "<div>x" * 100_000, "<" * 500_000, "<!-- " * 200_000, "<div class=ad>x" * 60_000, "<p " + "a=b " * 300_000, "<div>x" * 30_000 + "</section>" * 100_000, "<p>" + "word " * 1_000_000], ids=range(9))
def test_time_follows_length(page):
    began = time.process_time()
    extract.main_text(page)
    assert time.process_time() - began < 20


def test_vectors(spark, monkeypatch):
    r = np.random.default_rng(8)
    base = r.normal(size=(40, 24))
    rows = [(i, v) for i, v in enumerate(np.concatenate([base, base[:5].repeat(30, 0) + r.normal(size=(150, 24)) * 0.25, base[5:8], base[9:10] * 1e200]).tolist())]
    rows += [(500, None), (501, []), (502, [0.0] * 24), (503, [1.0, None] * 12), (504, [float("nan")] * 24), (505, [float("inf")] * 24), (506, [1.0, 2.0]), (None, base[0].tolist())]
    rows += [(507, [2.0, 4.1]), (508, [-1.0, 1.0]), (509, [1.0] * 5)]  # other lengths link among themselves
    rows = [(i, v, 1, "k") for i, v in rows]
    fine = {i: np.array(v, float) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)}
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in fine.items()}
    s, links = Sets([i for i, *_ in rows if i is not None]), collections.Counter()
    for a in unit:
        for b in unit:
            if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9:
                s.join(a, b)
                links[a] += 1
                links[b] += 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, key string").repartition(3)
    for index, queries in ((256, 1024), (8, 16)):
        monkeypatch.setattr(vectors, "INDEX_BLOCK", index)
        monkeypatch.setattr(vectors, "QUERY_BLOCK", queries)
        got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in vectors.near_duplicates(df).collect()}
        assert got == {i: (links[i], s.find(i), s.find(i) == i) for i in s.up} | {None: (0, None, True)}
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_vectors_that_share_an_id(spark):
    """Each is a vector of its own: one finds its partner, the other has none."""
    rows = [(1, [1.0, 0.0, 0.1]), (2, [0.0, 1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [1.0, 0.05, 0.0])]
    got = sorted(tuple(r) for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    assert got == [(1, 2, 1, True), (2, 0, 2, True), (2, 2, 1, False), (3, 2, 1, False)]


@pytest.mark.parametrize("flat", [True, False])
def test_planted_pairs_at_the_threshold(spark, flat):
    """All of 20,000 vectors against brute force, many pairs just above the threshold."""
    r = np.random.default_rng(31)
    x = vectors.unit(r.normal(size=(14_000, 48)) / (1 if flat else np.arange(1, 49) ** 0.5))
    y = r.normal(size=(6_000, 48))
    y = vectors.unit(y - (y * x[:6_000]).sum(1, keepdims=True) * x[:6_000])
    t = r.uniform(0.895, 0.92, (6_000, 1))
    x = np.concatenate([x, t * x[:6_000] + np.sqrt(1 - t * t) * y])
    want = np.concatenate([(x[i : i + 2000] @ x.T >= 0.9).sum(1) - 1 for i in range(0, len(x), 2000)])
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(4)
    got = dict(vectors.near_duplicates(df).select("vec_id", "n_links").collect())
    wrong = [i for i, n in enumerate(want) if got[i] != n]
    assert [i for i in wrong if np.abs(x @ x[i] - 0.9).min() > 1e-12] == []


def test_recall_of_cells():
    """Pairs right at the threshold among unstructured vectors: nearly all lie in a cell that is asked."""
    r = np.random.default_rng(4)
    x = vectors.unit(r.normal(size=(3000, 64)))
    y = vectors.unit(0.9 * x + math.sqrt(1 - 0.81) * vectors.unit(r.normal(size=x.shape) - x * (r.normal(size=x.shape) * x).sum(1, keepdims=True)))
    cents = vectors.centroids(x, 14)
    _, ask = vectors.places(x, cents)
    home, _ = vectors.places(y, cents)
    assert ask[np.arange(3000), home].mean() >= 0.98


def test_links_of_vectors_in_few_directions(spark):
    """Every pair counts for both of its ends, whatever the spectrum of the vectors."""
    r = np.random.default_rng(12)
    spectrum = 1 / np.arange(1, 65)
    x = vectors.unit(r.normal(size=(1500, 64)) * spectrum)
    x = vectors.unit(np.concatenate([x, x[:700] + vectors.unit(r.normal(size=(700, 64)) * spectrum) * 0.45]))
    near = x @ x.T
    assert (np.abs(near - 0.9) > 1e-9).all()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(3)
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df).collect()}
    want = (near >= 0.9).sum(1) - 1
    assert [i for i, n in enumerate(want) if got[i] != n] == []


def test_estimates_are_unbiased_and_bounded():
    r = np.random.default_rng(5)
    x, q = vectors.unit(r.normal(size=(2000, 64))), vectors.unit(r.normal(size=(50, 64)))
    turn = vectors.rotation(64)
    bits, factor = vectors.codes(x, turn)
    about, bound = vectors.estimates(q @ turn, bits, factor, 64)
    miss = about - q @ x.T
    assert abs(miss.mean()) < 0.005
    assert (np.abs(miss) <= bound[None, :]).mean() > 0.999


@pytest.mark.parametrize("run", [neardup.near_duplicates, neardup.deduplicate, repeats.remove_repeats, repeats.rewrite, quality.verdicts, mixing.mix, lambda d: mixing.materialise(d, mixing.mix(d)), subwords.encode, lambda d: subwords.decode(subwords.encode(d)), scoring.score], ids=lambda f: f.__name__)
def test_empty_tables(empty, run):
    assert run(empty).count() == 0


def test_empty_pages(spark):
    assert extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


NAMES = ["doc_id", "text", "source", "n_chars", "_id", "_doc", "_size", "_taken", "_cut", "_spans", "_uid", "_row", "_kept", "own_id", "uid", "keep", "row", "key", "cuts", "own", "told", "size", "took", "cut", "doc", "a.b", "UID"]


@pytest.mark.parametrize("run", [neardup.deduplicate, repeats.rewrite, lambda d: mixing.materialise(d, mixing.mix(d)), lambda d: toxicity.keep(d, toxicity.Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.full(3, 50.0)))], ids=["deduplicate", "rewrite", "materialise", "keep"])
def test_any_column_names(spark, run):
    """Columns of the table come through as they were, whatever they are called."""
    rows = [(i, t, "s", len(t or ""), *(f"{n}{i}" for n in NAMES[4:])) for i, t in enumerate(texts(12, 8))]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = spark.createDataFrame(rows, ", ".join(f"`{n}` {k}" for n, k in zip(NAMES, ["long", "string", "string", "long"] + ["string"] * len(NAMES), strict=False)))
        got = run(df)
        assert got.columns == NAMES
        assert all(r[n] == f"{n}{r.doc_id}" for r in got.collect() for n in NAMES[4:])
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_mix_of_rows_that_share_an_id(spark):
    """The laid-out mix takes what was planned, though ids repeat."""
    r = random.Random(8)
    rows = [(i % 7 if i % 3 else None, " ".join(["w"] * r.randint(0, 30)), "abc"[i % 3], 0) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    plan = mixing.mix(df)
    planned = sum(r.taken for r in plan.collect())
    laid = sum(len(words(r.text)) for r in mixing.materialise(df, plan).collect())
    assert abs(laid - planned) <= len(rows)


def test_texts_of_one_byte(spark):
    """Long runs of one byte, and long texts without a space, through the operators that work on bytes, pieces and shingles."""
    rows = [(0, "x" * 60_000), (1, "x" * 300), (2, "y" * 1000 + "x" * 150), (3, "ab" * 40_000), (4, "\u00e9" * 20_000)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t), 1, "k", 2, 3) for i, t in rows], SCHEMA)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in repeats.remove_repeats(df).collect()}
    assert got == {0: (60_000, 60_000, 1), 1: (300, 300, 1), 2: (1150, 1000, 1), 3: (80_000, 80_000, 1), 4: (40_000, 40_000, 1)}
    assert all(r.decoded_same for r in subwords.encode(df).collect())
    assert all(r.n_shingles == 1 and r.kept for r in neardup.near_duplicates(df).collect())


def test_urls_with_many_labels_and_rules_that_disagree(spark):
    long = ".".join(["a"] * 10_000) + ".example.org"
    rules = spark.createDataFrame([("example.org", "/x", "allow"), ("EXAMPLE.org", "/x", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, f"http://{long}/x/y"), (2, "http://example.org/z")], "page_id long, url string")
    assert {r.page_id: (r.rule, r.verdict) for r in urls.judge(pages, rules).collect()} == {1: ("example.org/x", "block"), 2: (None, "allow")}
