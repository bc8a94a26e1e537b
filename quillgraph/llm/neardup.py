"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set is the 64-bit hashes of its distinct word shingles. Equal sets are one representative from the start. The k
least hashes of a set are its sketch; inverted lists of the retained values give the overlaps. Two sets with a Jaccard similarity
of at least t share, among the k least hashes of their union, a binomially distributed number with mean t*k; below `_least(n)` it
falls once in several billion pairs. So a sketch with fewer values that anyone else has is alone, and only its rarest values, all but
`_least(n) - 1`, need a list (any pair with enough overlap meets in one of them). Lists whose documents hang together are a cluster.

A passage that very many documents share hangs together what has no links. So clusters of more than BLOCK are looked at by sketches alone
first, longer ones of LONG values and in blocks of WIDE: full sets are sent only of documents with a partner whose union-sketch estimate leaves a link
possible.

Within a cluster, documents stand in bands of set size, so that only a band and the next can hold links, and in blocks of at most
about BLOCK; a task gets two blocks. There the inverted lists of the retained values give the overlaps of pairs, union sketches of the pairs that share enough
give estimates that rule most out, and what is left is verified on the full sets: exact Jaccard. It tells
only a spanning forest of the links it found. No pairs are listed, no group meets in one task, and no link is lost but with the odds above.

Nulls, empties: a null or wordless text has an empty set, links with nothing and is its own component; so is a row whose doc_id is
null. Fewer words than a shingle count as one shingle. Rows that repeat a doc_id are judged by it. Extra columns are not read.
Texts count whole; a very long one is worked on by itself, with some tens of bytes for each of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_long, components, durable, free, in_runs, mix, passing, pieces, runs, slices, word_hashes

SHINGLE, K, BLOCK, LONG, WIDE = 5, 32, 64, 128, 512
#: By length, values among the least of a union that a link shares but once in more than 10^9 pairs.
LEAST = {K: 8, LONG: 64}
_TURN = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_CHUNK = 1 << 14
#: Candidate pairs for each set of a task that are verified one by one.
PAIRWISE = 4


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each row its sorted distinct shingle hashes, in 63 bits."""
    words, first = word_hashes(data, at)
    n = len(words) - size + 1
    full = np.zeros(max(n, 0), np.uint64)
    for k in range(size):
        full += words[k : k + n] * _TURN[k] if n > 0 else np.zeros(0, np.uint64)
    full = mix(full) >> np.uint64(1)
    for i, j in zip(first[:-1], first[1:], strict=True):
        if j - i >= size:
            yield np.unique(full[i : j - size + 1])
        elif j > i:
            yield mix((words[i:j] * _TURN[: j - i]).sum(keepdims=True) + np.uint64(j - i)) >> np.uint64(1)
        else:
            yield np.zeros(0, np.uint64)


def sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n, f1 and f2 (a 128-bit fingerprint of the set), sketch (its k least hashes, in order)."""

    def run(parts):
        for b in slices(parts):
            ids = b.column(0)
            for i, j, data, at in pieces(b.column(1)):
                n, f1, f2, kept = [], [], [], []
                for s in shingle_sets(data, at):
                    n.append(len(s))
                    f1.append(mix(s).sum(dtype=np.uint64))
                    f2.append(mix(s ^ _TURN[9]).sum(dtype=np.uint64))
                    kept.append(s[:k])
                lens = np.array([0, *map(len, kept)]).cumsum()
                lists = pa.ListArray.from_arrays(pa.array(lens, pa.int32()), as_long(np.concatenate(kept) if kept else np.zeros(0, np.uint64)))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(n, pa.int64()), as_long(np.array(f1, np.uint64)), as_long(np.array(f2, np.uint64)), lists], names=["doc_id", "n", "f1", "f2", "sketch"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, n long, f1 long, f2 long, sketch array<long>")


def _least(n: Column) -> Column:
    """Values that a sketch of a set of n shares at least with that of any set with Jaccard 0.75 or more."""
    return F.when(n < 25, F.ceil(0.75 * n)).otherwise(F.lit(8)).cast("int")


def _clusters(reps: DataFrame) -> DataFrame:
    """(rep, n, cluster) of the representatives that may have a link."""
    postings = reps.select("rep", "n", F.explode("sketch").alias("value"))
    # lists' lengths are a table by itself, so that the join can split a list that is very long
    shared = durable(postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    met = postings.join(shared, "value")
    listed = met.groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"))
    enough = listed.where(F.size("v") >= _least(F.col("n")))
    rare = durable(enough.select("rep", "n", F.explode(F.slice("v", 1, F.size("v") - _least(F.col("n")) + 1)).alias("v")).select("rep", "n", "v.value"))
    hubs = durable(rare.groupBy("value").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m"))
    edges = rare.join(hubs, "value").select(F.col("rep").alias("a"), F.col("hub").alias("b")).where("a <> b").distinct()
    found = components(edges)
    return rare.select("rep", "n").distinct().join(found, F.col("rep") == F.col("node")).select("rep", "n", F.col("component").alias("cluster"))


def _with_partners(docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """clusters, the large ones without those whose union-sketch estimates rule out a link with any other in them."""
    sizes = durable(clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BLOCK).select("cluster"))
    if sizes.isEmpty():
        return clusters
    large = durable(clusters.join(sizes, "cluster").select("rep", "n", "cluster"))
    tasks = _tasks(large, WIDE)
    # by a shuffle at every size, as in links(): the ids grow with the documents
    texts = docs.select("doc_id", "text").join(large.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
    longer = sketches(texts, LONG).select(F.col("doc_id").alias("rep"), "n", "sketch")
    held = longer.join(tasks, "rep").select(F.explode("keys").alias("key"), "rep", "n", "sketch")

    def compare(parts):
        for t in runs(parts, "key"):
            ids, size = t.column("rep").to_numpy(), t.column("n").to_numpy()
            lists = t.column("sketch").combine_chunks()
            sketch = np.full((len(ids), LONG), -1, np.int64)
            width = lists.value_lengths().to_numpy(zero_copy_only=False)
            sketch[np.arange(LONG)[None, :] < width[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            if len(some := np.unique(np.concatenate(_candidates(size, sketch)))):
                yield pa.RecordBatch.from_arrays([pa.array(ids[some])], names=["rep"])

    found = in_runs(held, "key").mapInArrow(compare, "rep long").distinct()
    return clusters.join(sizes, "cluster", "left_anti").select("rep", "n", "cluster").unionByName(large.join(found, "rep", "left_semi").select("rep", "n", "cluster"))


def _tasks(clusters: DataFrame, block: int = BLOCK) -> DataFrame:
    """rep and keys: the tasks, each of two blocks, in which it is compared."""
    banded = durable(clusters.withColumn("band", F.floor(F.log(F.col("n")) / F.log(F.lit(4 / 3)) - 1e-9).cast("int")))
    blocks = banded.groupBy("cluster", "band").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    sides = [blocks.select("cluster", (F.col("band") + d).alias("band"), F.col("blocks").alias(name)) for d, name in ((1, "below"), (-1, "above"))]
    known = blocks
    for s in sides:
        known = known.join(s, ["cluster", "band"], "left")
    known = durable(known)  # a table by itself: the join can split a cluster that very many rows are in
    placed = banded.join(known, ["cluster", "band"]).withColumn("i", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    key = lambda lo, i, hi, j: F.xxhash64("cluster", lo, i, hi, j)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    own = F.transform(upto(F.col("blocks")), lambda j: key(F.col("band"), F.least(F.col("i"), j), F.col("band"), F.greatest(F.col("i"), j)))
    up = F.transform(upto(F.coalesce("above", F.lit(0))), lambda j: key(F.col("band"), F.col("i"), F.col("band") + 1, j))
    down = F.transform(upto(F.coalesce("below", F.lit(0))), lambda j: key(F.col("band") - 1, j, F.col("band"), F.col("i")))
    return placed.select("rep", F.concat(own, up, down).alias("keys"))


def inverted(flat: np.ndarray, owner: np.ndarray, m: int) -> np.ndarray:
    """m x m: how many values each two of m owners share, from the inverted list of every value that several have."""
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.append(True, flat[1:] != flat[:-1])[: len(flat)]
    run = np.diff(np.append(np.flatnonzero(new), len(flat)))
    keep = np.repeat(run > 1, run)
    column, owner = np.cumsum(new[keep]) - 1, owner[keep]
    common = np.zeros((m, m), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, _CHUNK):
        i, j = np.searchsorted(column, (lo, lo + _CHUNK))
        cells = np.zeros((m, min(_CHUNK, int(column[-1]) + 1 - lo)), np.float32)
        cells[owner[i:j], column[i:j] - lo] = 1
        common += cells @ cells.T
    return common


def union_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared values among the least of each pair's union, as many as a sketch has, for rows of sorted sketches padded with -1: the union-sketch estimate."""
    big = np.iinfo(np.int64).max
    both = np.sort(np.concatenate([np.where(a < 0, big, a), np.where(b < 0, big, b)], 1), 1)
    same = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != big)
    rank = np.arange(same.shape[1])[None, :] - (np.cumsum(same, 1) - same)
    return (same & (rank < a.shape[1])).sum(1)


def candidates(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets, by number, whose union-sketch estimate does not rule a link out: of those that the inverted lists of their sketches bring together."""
    sketch = np.full((len(sets), K), -1, np.int64)
    for i, s in enumerate(sets):
        sketch[i, : min(K, len(s))] = s[:K].view(np.int64)
    return _candidates(np.array([*map(len, sets)]), sketch)


def _candidates(size: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k = sketch.shape[1]
    at = np.flatnonzero(sketch.ravel() >= 0)
    # the union of a link with a set this small is all in the sketches
    need = np.where(size < 0.75 * k + 1, np.ceil(0.75 * size), LEAST[k])
    need = np.minimum(need[:, None], need[None, :])
    i, j = np.nonzero(np.triu(inverted(sketch.ravel()[at], at // k, len(size)) >= need, 1))
    near = np.zeros(len(i), bool)
    for c in range(0, len(i), _CHUNK):
        x, y = i[c : c + _CHUNK], j[c : c + _CHUNK]
        near[c : c + _CHUNK] = union_shared(sketch[x], sketch[y]) >= need[x, y]
    return i[near], j[near]


def _spanning(ids: np.ndarray, link: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span the components of a table of links."""
    root = np.arange(len(ids))
    while True:
        least = np.where(link, root[None, :], len(ids)).min(1)
        least = least[least]
        if (least == root).all():
            break
        root = least
    return [(int(ids[k]), int(ids[r])) for k, r in enumerate(root) if k != r]


def forest(ids: np.ndarray, sets: list[np.ndarray], pairs: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """Edges that span the components of the links (Jaccard 0.75 or more) among these pairs of sets."""
    m, (i, j) = len(ids), pairs
    if not len(i):
        return []
    size = np.array([*map(len, sets)])
    if len(i) <= PAIRWISE * m:
        common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist(), strict=True)])
    else:  # so many that all overlaps at once are less work
        common = inverted(np.concatenate(sets), np.repeat(np.arange(m), size), m)[i, j]
    ok = 100 * common >= 75 * (size[i] + size[j] - common)
    link = np.eye(m, dtype=bool)
    link[i[ok], j[ok]] = link[j[ok], i[ok]] = True
    return _spanning(ids, link)


def links(docs: DataFrame, tasks: DataFrame) -> DataFrame:
    """(a, b): spanning edges of the links of each task."""

    def spread(parts):
        for b in slices(parts):
            for i, j, data, at in pieces(b.column(1)):
                ids, keys = b.column(0).slice(i, j - i), b.column(2).slice(i, j - i)
                blobs = [s.tobytes() for s in shingle_sets(data, at)]
                sets = pa.array(blobs, pa.binary())
                of = keys.value_lengths().to_numpy(zero_copy_only=False)
                rows = np.repeat(np.arange(j - i), of)
                weight = np.cumsum(np.array([*map(len, blobs)])[rows] + 100)
                lo = 0
                while lo < len(rows):
                    hi = max(lo + 1, int(np.searchsorted(weight, weight[lo] + 8_000_000)))
                    pick = pa.array(rows[lo:hi])
                    yield pa.RecordBatch.from_arrays([keys.flatten().slice(lo, hi - lo), ids.take(pick), sets.take(pick)], names=["key", "rep", "shingles"])
                    lo = hi

    def compare(parts):
        for t in runs(parts, "key"):
            if t.num_rows > 1:
                ids = t.column("rep").to_numpy()
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("shingles")]
                if edges := forest(ids, sets, candidates(sets)):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges, strict=True)], names=["a", "b"])

    held = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")).join(tasks.hint("merge"), F.col("doc_id") == F.col("rep")).select("rep", "text", "keys")
    apart = held.mapInArrow(spread, "key long, rep long, shingles binary")
    return in_runs(apart, "key").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept (doc_id = component_id)."""
    seen = durable(sketches(docs))
    sets = seen.where("n > 0 AND doc_id IS NOT NULL")
    same = durable(sets.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("rep")))
    reps = sets.join(same.withColumnRenamed("rep", "doc_id"), ["n", "f1", "f2", "doc_id"], "left_semi").select(F.col("doc_id").alias("rep"), "n", "sketch")
    with passing() as keep:
        tasks = keep(durable(_tasks(_with_partners(docs, _clusters(reps)))))
    found = components(links(docs, tasks))
    of = same.join(found, F.col("rep") == F.col("node"), "left").select("n", "f1", "f2", F.coalesce("component", "rep").alias("component"))
    out = seen.join(of, ["n", "f1", "f2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents that are kept, all columns: one of each component. Rows without an id of their own, null or repeated, are one where id and text
    are the same, and take part under a hash of the two. Null and wordless texts link with nothing and stay. Columns may have any names."""
    own_id, uid, keep, row = free(docs, "own_id", "uid", "keep", "row")
    many = durable(docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(own_id)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(own_id))
    repeated = docs["doc_id"] == many[own_id]
    own = docs.where("doc_id IS NOT NULL").join(many, repeated, "left_anti").withColumn(uid, F.col("doc_id").cast("bigint"))
    rest = docs.where("doc_id IS NULL").unionByName(docs.where("doc_id IS NOT NULL").join(many, repeated, "left_semi"))
    told = F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id", F.col("text").isNull(), "text"), 1)
    rest = rest.withColumn(uid, told).groupBy(uid).agg(F.min_by(F.struct(*[f"`{c}`" for c in docs.columns]), F.xxhash64(*[f"`{c}`" for c in docs.columns])).alias(row)).select(f"{row}.*", uid)
    rows = own.unionByName(durable(rest))
    kept = near_duplicates(rows.select(F.col(uid).alias("doc_id"), "text")).where("kept").select(F.col("doc_id").alias(keep))
    return rows.join(kept, F.col(uid) == F.col(keep), "left_semi").select(*[f"`{c}`" for c in docs.columns])
