"""Near-duplicate vectors by randomised-rotation binary codes.

Equal vectors are one with a weight. Centroids, fitted on a bounded sample, cut the rest into cells, more of them the more vectors there are: every
vector is indexed in the cell of its nearest centroid and asks in every cell where a partner may be at home. A partner y with cosine t has
<y, c> = t <x, c> plus a part that is at most sqrt(1 - t^2) times what of c is not along x, so a cell is left out only where no vector that near
to x can be at home, however the vectors are spread. As both ends of a pair would find each other, only the end in the cell of the lower number
asks, and a pair counts for both; in a cell each asks for itself.

The index holds for each vector the signs of its randomly rotated components, a bit each, and a correction factor, the inner product of the
unit vector with its code. Divided by it, the inner product of a rotated query with the code is an unbiased estimate of the cosine, and its
confidence bound follows from the factor too. Only pairs that the bound doesn't rule out are computed exactly, in double
precision. Cells are dealt to tasks in blocks of the index and blocks of queries, so no cell meets whole in one task; a vector goes there
in the precision that it has in the table, and tasks tell sums of links and a spanning forest of them, not pairs.

Nulls, empties: a vector that is null, empty or zero, or holds a null or a component that isn't finite, links with nothing. Vectors of different
lengths don't link; each length has cells of its own. A row without a vec_id has no component and is kept. Rows are counted each, repeated or not; rows that
share a vec_id but not the vector are vectors of their own. Extra columns, labels too, are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, durable, in_runs, runs

COSINE = 0.9
#: Floats of the sample that centroids are fitted on; rounds; spreads of the margin for estimates.
SAMPLE_FLOATS, ROUNDS, SURE = 1_200_000, 5, 4.0
INDEX_BLOCK, QUERY_BLOCK = 2048, 4096
#: Queries that are estimated at once.
AT_ONCE = 512


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1, whatever their size."""
    big = np.abs(rows).max(1, keepdims=True)
    rows = rows / np.where(big > 0, big, 1)
    return rows / np.maximum(np.sqrt((rows * rows).sum(1, keepdims=True)), 1e-300)


def rotation(width: int, seed: int = 17) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def codes(units: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sign bits of the rotated rows, packed; correction factor of each row)."""
    turned = units @ turn
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / math.sqrt(units.shape[1])


def scaled(bits: np.ndarray, factor: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes as columns, each divided by its factor: times a rotated query they are estimates; the bound of each one's error)."""
    signs = np.unpackbits(bits, axis=1, count=width).astype(np.float32) * 2 - 1
    signs /= (math.sqrt(width) * factor)[:, None].astype(np.float32)
    bound = SURE * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(width - 1, 1)) + 1e-5
    return np.ascontiguousarray(signs.T), bound.astype(np.float32)


def estimates(queries: np.ndarray, bits: np.ndarray, factor: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """queries: rotated unit rows. (estimated cosines, queries x rows of the index; the bound of each row's error)."""
    signs, bound = scaled(bits, factor, width)
    return queries.astype(np.float32) @ signs, bound


def centroids(sample: np.ndarray, count: int, seed: int = 23) -> np.ndarray:
    r = np.random.default_rng(seed)
    c = sample[r.permutation(len(sample))[:count]]
    for _ in range(ROUNDS):
        home = (sample @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, sample)
        c = unit(np.where(np.abs(sums).sum(1, keepdims=True) > 0, sums, c))
    return c


def places(units: np.ndarray, cents: np.ndarray, t: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """(home cell of each row; rows x cells: may a partner of the row be at home in this cell)."""
    near = units @ cents.T
    home = near.argmax(1)
    behind = near[np.arange(len(near)), home][:, None] - near
    apart = 2 - 2 * (cents @ cents.T)[home]  # squared distance of the two centroids, less what lies along x
    return home, behind * t <= math.sqrt(max(1 - t * t, 0)) * np.sqrt(np.maximum(apart - behind**2, 0)) + 1e-9


def asks(units: np.ndarray, cents: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """places(), each pair of cells asked from one side."""
    home, may = places(units, cents, t)
    return home, may & (np.arange(len(cents))[None, :] >= home[:, None])


def _of_width(batch: pa.RecordBatch, column: int):
    """(rows, their vectors as float64 rows) for each length of vector in a column of lists."""
    v = batch.column(column)
    size = v.value_lengths().to_numpy()
    for width in np.unique(size):
        rows = np.flatnonzero(size == width)
        yield int(width), rows, v.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _block(ids: np.ndarray, count: np.ndarray) -> np.ndarray:
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % count


def _links(index: tuple[np.ndarray, ...], queries: np.ndarray, width: int, t: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, row of the index) of the pairs with cosine t or more."""
    units, bits, factor = index
    turned = (queries @ rotation(width)).astype(np.float32)
    signs, bound = scaled(bits, factor, width)
    found = []
    for k in range(0, len(queries), AT_ONCE):
        q, i = np.nonzero(turned[k : k + AT_ONCE] @ signs >= (t - bound)[None, :])
        for j in range(0, len(q), 100_000):
            a, b = q[j : j + 100_000] + k, i[j : j + 100_000]
            ok = np.einsum("ij,ij->i", queries[a], units[b]) >= t
            found.append((a[ok], b[ok]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _roots(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The least node that each of n nodes reaches over edges x - y."""
    root = np.arange(n)
    while True:
        least = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(least, x, low)
        np.minimum.at(least, y, low)
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _fit(reps: DataFrame) -> dict[int, np.ndarray]:
    """Centroids of the cells for each length of vector; as many as the number of vectors asks for, on a sample of at most SAMPLE_FLOATS floats."""
    widths = {r.width: r.n for r in reps.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = lambda w, n: min(1.0, SAMPLE_FLOATS / len(widths) / w / n)
    wanted = F.create_map(*[F.lit(x) for w, n in widths.items() for x in (w, int((1 << 40) * share(w, n)))])
    some = reps.where(F.pmod(F.xxhash64(F.lit(9), "node"), F.lit(1 << 40)) <= F.element_at(wanted, F.size("v"))).orderBy("node").select("v").toPandas()["v"] if widths else []
    by = {w: [x for x in some if len(x) == w] for w in widths}
    count = lambda n: int(max(1, math.sqrt(n) // 4))
    return {w: centroids(unit(np.array(x, np.float64)), min(count(widths[w]), len(x))) if x else np.eye(1, w) for w, x in by.items()}


def near_duplicates(table: DataFrame, t: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    kind = dict(table.dtypes)["embedding"]
    v = F.col("embedding") if kind in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")
    big = float("inf")
    fine = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)) & F.exists("v", lambda x: x != 0)
    rows = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).withColumn("fine", F.coalesce(fine, F.lit(False)) & F.col("vec_id").isNotNull())
    rows = durable(rows.select("vec_id", *[F.when(F.col("fine"), F.xxhash64(F.lit(k), "v")).alias(h) for k, h in ((1, "h1"), (2, "h2"))], F.when(F.col("fine"), F.col("v")).alias("v")))
    same = durable(rows.where("v IS NOT NULL").groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v")).withColumn("node", F.xxhash64("h1", "h2")))
    reps = same.select("node", "weight", "v")
    cents = _fit(reps)
    first = dict(zip(cents, np.append(0, np.cumsum([len(c) for c in cents.values()]))[:-1].tolist(), strict=True))
    cells = sum(len(c) for c in cents.values())

    def count(parts):
        home_n, ask_n = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
        for b in parts:
            for width, _, x in _of_width(b, 2):
                c = slice(first[width], first[width] + len(cents[width]))
                home, ask = asks(unit(x), cents[width], t)
                home_n[c] += np.bincount(home, minlength=len(cents[width]))
                ask_n[c] += ask.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells)), pa.array(home_n), pa.array(ask_n)], names=["cell", "home", "ask"])

    sizes = reps.mapInArrow(count, "cell long, home long, ask long").groupBy("cell").agg(F.sum("home").alias("home"), F.sum("ask").alias("ask")).orderBy("cell").toPandas()
    index_blocks, query_blocks = -(-sizes["home"].to_numpy() // INDEX_BLOCK), -(-sizes["ask"].to_numpy() // QUERY_BLOCK)
    key_at = np.append(0, np.cumsum(index_blocks * query_blocks))
    names = ["key", "node", "weight", "v", "bits", "factor", "own"]

    def deal(parts):
        for b in parts:
            for width, rows, x in _of_width(b, 2):
                held = pa.RecordBatch.from_arrays([c.take(pa.array(rows)) for c in b.columns], names=["node", "weight", "v"])
                units, ids, start = unit(x), held.column(0).to_numpy(), first[width]
                home, ask = asks(units, cents[width], t)
                bits, factor = codes(units, rotation(width))
                bits = pa.array([r.tobytes() for r in bits], pa.binary())
                home = home + start
                # indexed once, in a block of the home cell, for each block of queries
                many = query_blocks[home]
                row = np.repeat(np.arange(len(ids)), many)
                q = np.arange(len(row)) - np.repeat(many.cumsum() - many, many)
                key = key_at[home[row]] + _block(ids, np.maximum(index_blocks[home], 1))[row] * query_blocks[home[row]] + q
                pick = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(key), *(held.column(k).take(pick) for k in range(3)), bits.take(pick), pa.array(factor).take(pick), pa.nulls(len(pick), pa.bool_())], names=names)
                # asks, in a block of queries, each block of the index
                row, cell = np.nonzero(ask & (index_blocks[start : start + len(cents[width])] > 0)[None, :])
                cell = cell + start
                mine = _block(ids[row] ^ 0x5BD1E995, np.maximum(query_blocks[cell], 1))
                many = index_blocks[cell]
                at = np.repeat(np.arange(len(row)), many)
                i = np.arange(len(at)) - np.repeat(many.cumsum() - many, many)
                key = key_at[cell[at]] + i * query_blocks[cell[at]] + mine[at]
                own = (home[row] == cell)[at]
                for lo in range(0, len(at), 10_000):
                    pick = pa.array(row[at[lo : lo + 10_000]])
                    none = (pa.nulls(len(pick), pa.binary()), pa.nulls(len(pick), pa.float64()))
                    yield pa.RecordBatch.from_arrays([pa.array(key[lo : lo + 10_000]), *(held.column(k).take(pick) for k in range(3)), *none, pa.array(own[lo : lo + 10_000])], names=names)

    def compare(parts):
        for table in runs(parts, "key"):
            b = table.combine_chunks().to_batches()[0]
            indexed = b.column(5).is_valid().to_numpy(zero_copy_only=False)
            if indexed.all() or not indexed.any():
                continue
            ((width, _, x),) = _of_width(b, 3)  # a cell holds one length
            units, ids, weight = unit(x), b.column(1).to_numpy(), b.column(2).to_numpy()
            bits = np.frombuffer(b"".join(y for y in b.column(4).to_pylist() if y is not None), np.uint8).reshape(int(indexed.sum()), -1)
            q, i = _links((units[indexed], bits, b.column(5).to_numpy(zero_copy_only=False)[indexed]), units[~indexed], width, t)
            far = ~b.column(6).to_numpy(zero_copy_only=False)[~indexed].astype(bool)[q]  # the indexed end doesn't ask for this one
            nodes, ends = np.unique(np.append(ids[~indexed][q], ids[indexed][i]), return_inverse=True)
            x, y = ends[: len(q)], ends[len(q) :]
            links = np.bincount(x, weight[indexed][i], len(nodes)) + np.bincount(y[far], weight[~indexed][q][far], len(nodes))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[_roots(x, y, len(nodes))]), pa.array(links.astype(np.int64))], names=["node", "root", "links"])

    dealt = reps.mapInArrow(deal, f"key long, node long, weight long, v {dict(reps.dtypes)['v']}, bits binary, factor double, own boolean")
    found = durable(in_runs(dealt, "key").mapInArrow(compare, "node long, root long, links long"))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("component", "top")
    known = same.drop("v").join(linked, "node", "left").join(joined, "node", "left").withColumn("top", F.coalesce("top", "node"))
    least = known.groupBy("top").agg(F.min("least").alias("component"))
    known = known.join(least, "top").select("h1", "h2", F.greatest(F.coalesce("links", "weight"), "weight").alias("links"), "component")
    out = rows.drop("v").join(known, ["h1", "h2"], "left")
    return out.select("vec_id", F.coalesce(F.col("links") - 1, F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
