"""Repeated passages by suffix arrays: what a string of `length` bytes covers that also starts elsewhere is removed.

Anchors bring together what may repeat: of the K-byte strings of a text, those whose hash is the least of a window, placed
so that any `length` bytes hold one, the same one wherever they stand. Each window start belongs to one anchor; starts in a row
with one anchor are a stretch, and its context is all bytes that they cover. Only anchors seen twice matter. Equal
contexts are counted by a 128-bit key, and one is enough for the rest of the work.

A context that stands more than once as it is is a repeat with its copies as occurrences: its 128-bit key decides. Different contexts of one anchor meet in a bucket, where the suffix
array decides. There an enhanced suffix array (prefix doubling up to `length`, common prefixes of
neighbours) is scanned with a stack into its tree of common-prefix intervals; an interval of depth `length` or more, whose suffixes
differ in the byte before them, is a maximal repeat, with all its occurrences. An anchor with many different contexts
(a passage that many documents share, between other words) is dealt over several buckets, BUCKET contexts in each; then what each bucket
has found once or more is also counted over the buckets of that anchor, by the 128-bit key of each string, so nothing is lost.

Nulls, empties: a null text is empty; nothing is removed from texts of fewer than `length` bytes. Every row is a text of its own, so a
repeated row is a repeat; a null doc_id stays null. Rows that are equal in doc_id and text take part as one, however many they are: such a text is removed
whole if it has `length` bytes, and its row comes back as often as it stood. Extra columns are not read. A text is told by a 64-bit key of doc_id
and text; of 10^10 texts about three pairs would share one, so keys that different rows share are looked for first, and their rows get others.
A very long text is worked on by itself, with some tens of bytes for each of its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_long, durable, free, in_runs, mix, passing, pieces, prefix_hash, range_hash, raw, runs, slices

LENGTH, K, BUCKET = 200, 96, 256
#: Rows that are worked on together: some texts are long, and several arrays stand beside each.
ROWS = 400
#: Equal rows that come back at a time.
COPIES = 10_000
NOTHING = hashlib.sha256(b"").hexdigest()


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """For each i the least of x[i:i + w]."""
    n = len(x) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    pad = -len(x) % w
    big = np.iinfo(np.uint64).max
    blocks = np.append(x, np.full(pad, big, np.uint64)).reshape(-1, w)
    left = np.minimum.accumulate(blocks, 1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def stretches(data: np.ndarray, at: np.ndarray, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, ...]:
    """For each stretch: its row, the hash of its anchor, the first and last window start (positions in data).

    Window minima are taken over hashes; a new stretch begins where the minimum changes or slides to another place.
    """
    w = length - k + 1
    if len(data) < length:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    h = prefix_hash(data)
    grams = range_hash(h, np.arange(len(data) - k + 1), np.arange(k, len(data) + 1))
    least = _window_min(grams, w)
    # windows of one text only
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(least)]
    inside = np.arange(len(least)) + length <= at[1:][row]
    # an anchor is the leftmost place of the minimum; it leaves when the window passes it
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1]) | (row[1:] != row[:-1])
    new &= inside
    first = np.flatnonzero(new)
    if not len(first):
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), first, first)
    last_of_row = at[1:][row[first]] - length
    last = np.minimum(np.append(first[1:] - 1, len(least) - 1), last_of_row)
    return row[first], least[first], first, last


_FLIP = np.random.default_rng(11).permutation(256).astype(np.uint8)
_CTX = "doc long, doc_id long, anchor long, lo int, hi int, c1 long, c2 long, body binary, n_bytes long, sha string"


def _anchors(texts: DataFrame) -> DataFrame:
    """doc, anchor, place: stretches by position in the text, first window start * 256 + last - first (packed: rows are many)."""

    def run(parts):
        for b in slices(parts, ROWS):
            for i, j, data, at in pieces(b.column(1), 1_000_000):
                row, anchor, lo, hi = stretches(data, at)
                base = at[:-1][row]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i).take(pa.array(row)), as_long(anchor), pa.array((lo - base) * 256 + hi - lo)], names=["doc", "anchor", "place"])

    return texts.select("doc", "text").mapInArrow(run, "doc long, anchor long, place long")


def _packed(texts: DataFrame) -> DataFrame:
    """The texts compressed one by one, for a lighter shuffle."""

    def run(parts):
        pack = zstandard.ZstdCompressor(level=3)
        for b in slices(parts, ROWS):
            z = [pack.compress(x.as_buffer()) if x.is_valid else pack.compress(b"") for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(z, pa.binary())], names=["doc", "doc_id", "z"])

    return texts.select("doc", "doc_id", "text").mapInArrow(run, "doc long, doc_id long, z binary")


def _contexts(held: DataFrame, length: int = LENGTH) -> DataFrame:
    """held: doc, doc_id, z, some (its doubtful stretches; null for none).

    Gives a row for each stretch, with c1 and c2, the 128-bit key of its context, and the context's bytes with the first of equals
    in a piece; and, with anchor null, a row for each document: its compressed text, or if nothing is in doubt its size and digest.
    """

    def table(**columns):
        names = [x.split()[0] for x in _CTX.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
        rows = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([columns[x] if x in columns else pa.nulls(rows, kinds[k.split()[1]]) for x, k in zip(names, _CTX.split(", "), strict=True)], names=names)

    def run(parts):
        unpack = zstandard.ZstdDecompressor()
        for b in slices(parts, ROWS):
            doubt = b.column(3).is_valid()
            calm = b.filter(pa.compute.invert(doubt))
            if calm.num_rows:
                texts = [unpack.decompress(x.as_buffer()) for x in calm.column(2)]
                yield table(doc=calm.column(0), doc_id=calm.column(1), n_bytes=pa.array([*map(len, texts)], pa.int64()), sha=pa.array([hashlib.sha256(x).hexdigest() for x in texts]))
            b = b.filter(doubt)
            if not b.num_rows:
                continue
            yield table(doc=b.column(0), doc_id=b.column(1), body=b.column(2))
            text = pa.array([unpack.decompress(x.as_buffer()) for x in b.column(2)], pa.binary())
            for i, j, data, at in pieces(text, 1_000_000):
                doc, some = b.column(0).slice(i, j - i), b.column(3).slice(i, j - i)
                flat = some.flatten()
                of = np.repeat(np.arange(j - i), some.value_lengths().to_numpy(zero_copy_only=False))
                anchor, place = (flat.field(x).to_numpy(zero_copy_only=False) for x in range(2))
                lo, hi = (place // 256).astype(np.int32), (place // 256 + place % 256).astype(np.int32)
                start, end = at[:-1][of] + lo, at[:-1][of] + hi + length
                size = mix((end - start).astype(np.uint64))
                c1, c2 = range_hash(prefix_hash(data), start, end) ^ size, range_hash(prefix_hash(_FLIP[data]), start, end) + size
                _, first = np.unique(c1, return_index=True)
                lone = np.zeros(len(of), bool)
                lone[first] = True
                body = pa.array([data[s:e].tobytes() if y else None for s, e, y in zip(start, end, lone, strict=True)], pa.binary())
                yield table(doc=doc.take(pa.array(of)), anchor=pa.array(anchor), lo=pa.array(lo), hi=pa.array(hi), c1=as_long(c1), c2=as_long(c2), body=body)

    return held.mapInArrow(run, _CTX)


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    s = key[order]
    up = np.zeros(len(key), np.int64)
    up[1:] = np.cumsum(s[1:] != s[:-1])
    out = np.empty(len(key), np.int64)
    out[order] = up
    return out


def suffixes(text: np.ndarray, ends: np.ndarray, starts: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Enhanced suffix array of the given starts: (starts in order of their suffixes, common prefix with the one before).

    text holds several strings in a row; ends has for each byte the end of its string. Ranks for 7 bytes (an eighth holds how many
    there are, so an end sorts first) are doubled until they tell suffixes apart by `depth` bytes or more; the common prefix of
    neighbours, up to twice that, is read off the ranks on the way back.
    """
    n = len(text)
    inside = np.arange(n)
    left = ends - inside
    key = np.zeros(n, np.uint64)
    padded = np.append(text, np.zeros(8, np.uint8))
    for k in range(7):
        key = key << np.uint64(8) | np.where(k < left, padded[k : n + k], 0).astype(np.uint64)
    rank = _dense(key << np.uint64(8) | np.minimum(left, 7).astype(np.uint64))
    step = 7
    ranks = [(step, rank)]
    while step < depth:
        second = np.zeros(n, np.uint64)
        second[: max(n - step, 0)] = np.where(left[: max(n - step, 0)] > step, rank[step:] + 1, 0)
        rank = _dense(rank.astype(np.uint64) << np.uint64(32) | second)
        step *= 2
        ranks.append((step, rank))
    order = starts[np.argsort(rank[starts])]
    a, b, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(len(order), np.int64)
    over = np.zeros(len(a), bool)
    for step, r in reversed(ranks):
        over |= (a >= ends[order[:-1]]) | (b >= ends[order[1:]])
        x, y = np.minimum(a, n - 1), np.minimum(b, n - 1)
        gain = np.where(~over & (r[x] == r[y]), np.minimum(step, left[x]), 0)
        lcp[1:] += gain
        a, b = a + gain, b + gain
    on = ~over
    for _ in range(6):  # what is left is shorter than the first ranks tell
        on &= (a < ends[order[:-1]]) & (b < ends[order[1:]])
        on &= text[np.minimum(a, n - 1)] == text[np.minimum(b, n - 1)]
        lcp[1:] += on
        a, b = a + on, b + on
    return order, lcp


def intervals(lcp: np.ndarray, least: int) -> np.ndarray:
    """(left, right, depth) of every common-prefix interval of depth `least` or more, by one scan with a stack.

    Stretches of the array with shallower prefixes are passed over: no interval of that depth reaches across them.
    """
    deep = np.flatnonzero(lcp >= least)
    out: list[tuple[int, int, int]] = []
    lefts: list[int] = []
    depths: list[int] = []
    previous = -2
    for i, d in zip(deep.tolist(), lcp[deep].tolist(), strict=True):
        if i != previous + 1:
            while depths:
                out.append((lefts.pop(), previous, depths.pop()))
        at = i - 1
        while depths and depths[-1] > d:
            at = lefts.pop()
            out.append((at, i - 1, depths.pop()))
        if not depths or depths[-1] < d:
            lefts.append(at)
            depths.append(d)
        previous = i
    while depths:
        out.append((lefts.pop(), previous, depths.pop()))
    return np.array(out, np.int64).reshape(-1, 3)


def _maximal(data: np.ndarray, bounds: np.ndarray, owner: np.ndarray, order: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Those of the intervals whose suffixes differ in the byte before them; a string's start differs from all."""
    before = np.where(order > bounds[:-1][owner[order]], data[np.maximum(order - 1, 0)].astype(np.int64), -1 - order)
    turns = np.append(0, np.cumsum(before[1:] != before[:-1]))
    return found[turns[found[:, 1]] > turns[found[:, 0]]]


def maximal_repeats(texts: list[bytes], least: int = LENGTH) -> list[tuple[int, list[tuple[int, int]]]]:
    """(length, [(text, start), ...]) of every repeat of `least` bytes or more that can't be extended, with all its occurrences."""
    sizes = np.array([*map(len, texts)], np.int64)
    bounds = np.append(0, sizes.cumsum())
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return []
    owner = np.repeat(np.arange(len(texts)), sizes)
    order, lcp = suffixes(data, bounds[1:][owner], np.arange(len(data)), int(sizes.max()))
    kept = _maximal(data, bounds, owner, order, intervals(lcp, least))
    return sorted((int(d), sorted((int(owner[p]), int(p - bounds[owner[p]])) for p in order[i : j + 1])) for i, j, d in kept)


def _covered(bodies: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Suffix array of contexts: (context and offset of every window start, its group of equals, whether that has several, bytes
    that maximal repeats cover from there on)."""
    sizes = np.array([*map(len, bodies)], np.int64)
    bounds = np.append(0, sizes.cumsum())
    data = np.frombuffer(b"".join(bodies), np.uint8)
    owner = np.repeat(np.arange(len(bodies)), sizes)
    ends = bounds[1:][owner]
    # in full order: intervals deeper than the ranks tell would fall apart
    order, lcp = suffixes(data, ends, np.flatnonzero(np.arange(len(data)) + length <= ends), int(sizes.max()))
    kept = _maximal(data, bounds, owner, order, intervals(lcp, length))
    reach = np.zeros(len(order), np.int64)
    if len(kept):
        size = kept[:, 1] - kept[:, 0] + 1
        at = np.arange(size.sum()) - np.repeat(size.cumsum() - size, size) + np.repeat(kept[:, 0], size)
        np.maximum.at(reach, at, np.repeat(kept[:, 2], size))
    group = np.cumsum(lcp < length)
    several = np.bincount(group, minlength=int(group[-1]) + 1)[group] > 1
    return data, owner[order], order - bounds[owner[order]], group, several, reach


def _spans(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping or touching spans of a document made one; several rows of a document come out in order."""
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    if not len(doc):
        return doc, lo, hi
    # ends so far within a document: shift each document into its own range
    base = np.cumsum(np.append(0, doc[1:] != doc[:-1])) * (int(hi.max()) + 1)
    far = np.maximum.accumulate(hi + base)
    new = np.append(True, lo[1:] + base[1:] > far[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(doc) - 1)
    return doc[first], lo[first], far[last] - base[last]


def _bucket_spans(buckets: DataFrame, length: int = LENGTH, most: int = 600_000) -> DataFrame:
    """buckets: bucket, doc, lo, lone (its context has no copy), split (its anchor has other buckets), body.

    Gives doc, lo, hi for what repeats cover; and of split buckets, with body set, the contexts that hold the first of each different
    window: by window start in `state`, 1 if nothing here equals it, 2 if something does, 0 for those that another context holds.
    """
    names = ["doc", "lo", "hi", "body", "state"]

    def solve(tables):
        t = pa.concat_tables(tables)
        doc, base, lone, split = (t.column(x).to_numpy() for x in ("doc", "lo", "lone", "split"))
        bodies = [x.as_py() for x in t.column("body")]
        data, row, at, group, several, reach = _covered(bodies, length)
        hit = (reach > 0) & lone[row]
        d, lo, hi = _spans(doc[row[hit]], base[row[hit]] + at[hit], base[row[hit]] + at[hit] + reach[hit])
        yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.nulls(len(d), pa.binary()), pa.nulls(len(d), pa.binary())], names=names)
        first = np.append(True, group[1:] != group[:-1]) & split[row]
        if first.any():
            bounds = np.append(0, np.cumsum([*map(len, bodies)]))
            state = np.zeros(bounds[-1], np.uint8)
            state[bounds[row[first]] + at[first]] = np.where(several | ~lone[row], 2, 1)[first]
            some = np.flatnonzero(np.add.reduceat(state, bounds[:-1], dtype=np.int64))
            marks = [state[bounds[i] : bounds[i + 1]].tobytes() for i in some]
            none = pa.nulls(len(some), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(doc[some]), pa.array(base[some].astype(np.int32)), none, t.column("body").combine_chunks().take(pa.array(some)), pa.array(marks, pa.binary())], names=names)

    def run(parts):
        held, size = [], 0
        for t in runs(parts, "bucket"):
            held.append(t)
            size += t.column("body").nbytes
            if size > most:
                yield from solve(held)
                held, size = [], 0
        if held:
            yield from solve(held)

    return in_runs(buckets, "bucket").mapInArrow(run, "doc long, lo int, hi int, body binary, state binary")


def _windows(split: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc, lo, hi, k1, k2: the marked windows of contexts, with their 128-bit keys; doc is null where a repeat is known already."""

    def run(parts):
        for b in slices(parts, ROWS):
            for i, j, data, at in pieces(b.column(2)):
                state, _ = raw(b.column(3).slice(i, j - i))
                start = np.flatnonzero(state)
                row = np.searchsorted(at, start, "right") - 1
                lo = b.column(1).slice(i, j - i).to_numpy()[row] + start - at[row]
                doc = b.column(0).slice(i, j - i).to_numpy()[row]
                k1, k2 = range_hash(prefix_hash(data), start, start + length), range_hash(prefix_hash(_FLIP[data]), start, start + length)
                yield pa.RecordBatch.from_arrays([pa.array(doc, mask=state[start] == 2), pa.array(lo.astype(np.int32)), pa.array((lo + length).astype(np.int32)), as_long(k1), as_long(k2)], names=["doc", "lo", "hi", "k1", "k2"])

    return split.select("doc", "lo", "body", "state").repartition("doc", "lo").mapInArrow(run, "doc long, lo int, hi int, k1 long, k2 long")


def _cut(held: DataFrame) -> DataFrame:
    """held: doc_id, body, n_bytes, sha, spans, copies. Removes the spans of each document."""

    def run(parts):
        unpack = zstandard.ZstdDecompressor()
        for b in slices(parts, ROWS):
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for z, n, sha, spans in zip(*(b.column(k) for k in range(1, 5)), strict=True):
                if not z.is_valid and spans.is_valid:  # nothing in it was in doubt, but its row is many
                    row = (n.as_py(), n.as_py(), 1, NOTHING, b"")
                elif not z.is_valid:
                    row = (n.as_py(), 0, 0, sha.as_py(), None)
                else:
                    text = unpack.decompress(z.as_buffer())
                    at = spans.values if spans.is_valid else None
                    lo, hi = (at.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (0, 1)) if at is not None else (np.zeros(0, np.int64),) * 2
                    _, lo, hi = _spans(np.zeros(len(lo), np.int64), lo, hi)
                    kept = b"".join(text[i:j] for i, j in zip([0, *hi.tolist()], [*lo.tolist(), len(text)], strict=True))
                    row = (len(text), len(text) - len(kept), len(lo), hashlib.sha256(kept).hexdigest(), kept)
                for x, y in zip(out.values(), row, strict=True):
                    x.append(y)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, k) for x, k in zip(out.values(), kinds, strict=True)), b.column(5)], names=["doc_id", *out, "copies"])

    return held.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, copies long")


def _key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def keyed(docs: DataFrame, name: str) -> DataFrame:
    """docs with a column `name`: a key that only rows of one doc_id and text share."""
    return counted(docs, name)[0]


def counted(docs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """keyed(), and `name`, n of the keys that n rows share, n above 1."""
    (shared,) = free(docs.withColumn(name, F.lit(0)), "shared")
    told = docs.select(_key(1).alias(shared), _key(2).alias("other"))
    several = durable(told.groupBy(shared).agg(F.min("other").alias("least"), F.max("other").alias("most"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    clash = several.where("least <> most").select(shared)
    out = docs.withColumn(name, _key(1))
    if clash.isEmpty():
        return out, several.select(F.col(shared).alias(name), "n")
    out = out.join(clash, F.col(name) == F.col(shared), "left")
    out = out.withColumn(name, F.when(F.col(shared).isNull(), F.col(name)).otherwise(_key(2))).drop(shared)
    return out, durable(out.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def once(rows: DataFrame, many: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (doc, doc_id, text), those that are many as one; and doc, lo, hi of what is removed from them for that alone: all of a text that is long enough."""
    if many.isEmpty():
        return rows, rows.limit(0).select("doc", F.lit(0).alias("lo"), F.lit(0).alias("hi"))
    keys = many.select("doc")
    # each task hands on one copy
    single = durable(rows.join(keys, "doc", "left_semi").groupBy("doc").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text")))
    size = F.octet_length(F.col("text").cast("binary"))
    return rows.join(keys, "doc", "left_anti").unionByName(single), single.where(size >= LENGTH).select("doc", F.lit(0).alias("lo"), size.alias("hi"))


def repeated_spans(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows: doc (a key), doc_id, text. (contexts, spans): _contexts() of the rows, and doc, lo, hi of what is to be removed, perhaps overlapping."""
    texts = rows.select("doc", F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    with passing() as keep:
        anchors = durable(_anchors(texts))
        # a table by itself, so that the join can split an anchor that very many texts have
        twice = durable(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
        some = anchors.join(twice, "anchor").groupBy("doc").agg(F.collect_list(F.struct("anchor", "place")).alias("some"))
        held = _packed(texts).join(some, "doc", "left").select("doc", "doc_id", "z", "some")
        contexts = keep(durable(_contexts(held)))
    rows = contexts.where("anchor IS NOT NULL").select("doc", "anchor", "lo", "hi", "c1", "c2", "body")
    place = F.xxhash64("doc", "lo")
    copies = rows.groupBy("anchor", "c1", "c2").agg(F.count(F.lit(1)).alias("copies"), F.min(F.when(F.col("body").isNotNull(), place)).alias("pick"))
    copies = durable(copies)
    various = durable(copies.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    whole = rows.drop("body").join(copies.where("copies > 1"), ["anchor", "c1", "c2"]).select("doc", "lo", (F.col("hi") + LENGTH).alias("hi"))
    bodies = rows.where("body IS NOT NULL").join(copies.join(various, "anchor"), ["anchor", "c1", "c2"]).where(place == F.col("pick"))
    bucket = F.xxhash64("anchor", F.pmod("c1", F.ceil(F.col("m") / BUCKET)))
    found = durable(_bucket_spans(bodies.select(bucket.alias("bucket"), "doc", "lo", (F.col("copies") == 1).alias("lone"), (F.col("m") > BUCKET).alias("split"), "body")))
    windows = durable(_windows(found.where("body IS NOT NULL")))
    met = windows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    over = windows.where("doc IS NOT NULL").join(met, ["k1", "k2"]).select("doc", "lo", "hi")
    return contexts, whole.unionByName(found.where("body IS NULL").select("doc", "lo", "hi")).unionByName(over)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept: the bytes left (null: all of them)."""
    told, many = counted(docs.select("doc_id", "text"), "doc")
    rows, whole = once(told, many)
    contexts, spans = repeated_spans(rows)
    by = spans.unionByName(whole).groupBy("doc").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    rows = contexts.where("anchor IS NULL").select("doc", "doc_id", "body", "n_bytes", "sha").join(many.withColumnRenamed("n", "copies"), "doc", "left")
    cut = _cut(rows.join(by, "doc", "left").select("doc_id", "body", "n_bytes", "sha", "spans", F.coalesce("copies", F.lit(1)).alias("copies")))
    # rows that are many come back as many as they were
    left = F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {COPIES}")))
    each = cut.withColumn("lot", left).withColumn("one", F.explode(F.array_repeat(F.lit(0), F.least(F.lit(COPIES), F.col("copies") - COPIES * F.col("lot")).cast("int"))))
    return each.drop("lot", "one", "copies")


def rewrite(docs: DataFrame) -> DataFrame:
    """The documents, all columns, without their repeated bytes; what a cut leaves of a broken character goes too, and n_chars follows the text. Null
    and short texts stay as they are, every row stays, and columns may have any names."""
    key, cuts = free(docs, "key", "cuts")
    told, many = counted(docs, key)
    rows, whole = once(told.select(F.col(key).alias("doc"), "doc_id", "text"), many.select(F.col(key).alias("doc"), "n"))
    _, spans = repeated_spans(rows)
    by = spans.unionByName(whole).groupBy(F.col("doc").alias(key)).agg(F.collect_set(F.struct("lo", "hi")).alias(cuts))
    names = docs.columns
    where, count = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(parts):
        for b in slices(parts, ROWS):
            spans = b.column(b.num_columns - 1)
            hit = np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False))
            columns = b.columns[:-1]
            if len(hit):
                texts = columns[where].to_pylist()
                sizes = columns[count].to_pylist() if count is not None else None
                for i in hit.tolist():
                    at = spans[i].values
                    lo, hi = (at.field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (0, 1))
                    _, lo, hi = _spans(np.zeros(len(lo), np.int64), lo, hi)
                    text = texts[i].encode()
                    texts[i] = b"".join(text[x:y] for x, y in zip([0, *hi.tolist()], [*lo.tolist(), len(text)], strict=True)).decode("utf-8", "ignore")
                    if sizes is not None:
                        sizes[i] = len(texts[i])
                columns[where] = pa.array(texts, columns[where].type)
                if sizes is not None:
                    columns[count] = pa.array(sizes, columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    held = told.join(by, key, "left").select(*[f"`{c}`" for c in docs.columns], cuts)
    held = held.toDF(*[f"c{i}" for i in range(len(held.columns))])  # Python's side takes no dots in names
    return held.mapInArrow(run, docs.schema)
