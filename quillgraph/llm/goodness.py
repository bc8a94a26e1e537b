"""Quality of texts: random-indexing word vectors pooled by document, and a two-layer network over them with calibrated probabilities.

A word's vector is the sum of the index vectors (a few fixed signs in DIMS places) of the words within WINDOW of it, over all documents of the
table: sums of whole numbers, so they come out alike however the table is cut. Words are told by hash among PLACES places, apart by kind
(lower, capitalised and upper case, other), marks between words are words too. A document is pooled to mean and spread of its
words' vectors, to the mean product of neighbours, and to its number of words. Labels tell the network, in numpy, on at most about SAMPLE rows, those
with the least hashes (a documented bound); a fifth of them is kept to find the temperature that its scores are divided by.

Nulls, empties: a null text is empty, has no words and gets a score like any other; a label of null or for no document is not
learned from; without labels of both kinds every score is the share of label 1, or 0.5. A row without doc_id is never held out.
Whole texts count, however long: they are read in blocks of bytes. Repeated rows are judged each for itself, extra columns not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .common import _IS_SPACE, durable, prefix_hash, range_hash, raw, slices

SAMPLE, DIMS, PLACES, SIGNS, WINDOW = 8000, 64, 8192, 4, 2
HIDDEN, STEPS, RATE, DECAY = 32, 400, 0.01, 1e-3
#: Bytes that are read at a time; places in a row of the shuffled sums, and groups that first sum what tasks have.
BYTES, CHUNK, SALTS = 1 << 18, 128, 16

_KIND = np.full(256, 3, np.uint8)  # 0 lower case and letters beyond ASCII, 1 upper case, 2 digits, 3 marks
_KIND[97:123] = _KIND[128:] = 0
_KIND[65:91], _KIND[48:58] = 1, 2
_RNG = np.random.default_rng(7)
_AT = (_RNG.integers(0, DIMS // SIGNS, (PLACES, SIGNS)) + np.arange(SIGNS) * (DIMS // SIGNS)).astype(np.int64)
_SIGN = _RNG.choice([-1.0, 1.0], (PLACES, SIGNS))


# -- words -----------------------------------------------------------------------------------------------------------------------


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, row) of each word of the rows: runs of letters and digits, and runs of marks."""
    mark, solid = _KIND[data] == 3, ~_IS_SPACE[data]
    first = np.zeros(len(data), bool)
    first[at[:-1][at[:-1] < len(data)]] = True
    first[1:] |= (mark[1:] != mark[:-1]) | ~solid[:-1]
    first &= solid
    start = np.flatnonzero(first)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    stop = first.copy()
    stop |= ~solid
    # a word ends where the next one or white space begins, or with its row
    marks = np.append(np.flatnonzero(stop), len(data))
    end = np.minimum(marks[np.searchsorted(marks, start, "right")], at[np.searchsorted(at, start, "right")])
    h = range_hash(prefix_hash(data), start, end)
    upper, last = _KIND[data[start]] == 1, _KIND[data[end - 1]]
    kind = np.where(upper, np.where((last == 1) & (end - start > 1), 2, 1), np.where(_KIND[data[start]] >= 2, 3, 0))
    part = PLACES // 4
    return kind * part + (h % np.uint64(part)).astype(np.int64), np.searchsorted(at, start, "right") - 1


def _blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, row) of the words of a column, BYTES of text at a time: a long text goes on over several blocks, cut at white space."""
    data, at = raw(column)
    i = 0
    while i < len(at) - 1:
        j = max(i + 1, int(np.searchsorted(at, at[i] + BYTES, "right")) - 1)
        body = data[at[i] : at[j]]
        if len(body) <= BYTES:
            place, row = _words(body, at[i : j + 1] - at[i])
            yield place, row + i
        else:
            start = 0
            while start < len(body):
                stop = min(start + BYTES, len(body))
                while stop < len(body) and not _IS_SPACE[body[stop]]:
                    space = np.flatnonzero(_IS_SPACE[body[stop : stop + BYTES]])
                    stop = stop + int(space[0]) if len(space) else min(stop + BYTES, len(body))
                place, row = _words(body[start:stop], np.array([0, stop - start]))
                yield place, row + i
                start = stop
        i = j


def _joined(blocks: Iterator[tuple[np.ndarray, np.ndarray]], back: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Blocks with the last `back` words of the block before in front, and how many these are, so that neighbours over a seam are neighbours."""
    place, row = np.zeros(0, np.int64), np.full(0, -1)
    for p, r in blocks:
        keep = min(back, len(place))
        head, head_row = place[len(place) - keep :], row[len(row) - keep :]
        place, row = np.append(head, p), np.append(head_row, r)
        yield place, row, keep


# -- word vectors ----------------------------------------------------------------------------------------------------------------


def _contexts(column: pa.Array, sums: np.ndarray) -> None:
    """Add to each place's sums the index vectors of the neighbours of its words."""
    for place, row, old in _joined(_blocks(column), WINDOW):
        for off in range(1, WINDOW + 1):
            a, b = np.arange(max(0, old - off), len(place) - off), np.arange(max(0, old - off) + off, len(place))
            new = (row[a] == row[b]) & (b >= old)
            x, y = place[a[new]], place[b[new]]
            for k in range(SIGNS):
                for own, other in ((x, y), (y, x)):
                    sums += np.bincount(own * DIMS + _AT[other, k], _SIGN[other, k], PLACES * DIMS).astype(np.int64)


def _sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros(PLACES * DIMS, np.int64)
    for b in slices(parts):
        _contexts(b.column(0), sums)
    yield _packed(dict(enumerate(sums.reshape(-1, CHUNK * DIMS))), TaskContext.get().partitionId() % SALTS)


def _packed(chunks: dict[int, np.ndarray], salt: int) -> pa.RecordBatch:
    some = {k: v for k, v in chunks.items() if v.any()}
    return pa.RecordBatch.from_arrays([pa.array([*some], pa.int32()), pa.array([salt] * len(some), pa.int32()), pa.array([v.tobytes() for v in some.values()], pa.binary())], names=["chunk", "salt", "sums"])


def _added(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one chunk to their sum; at most all chunks, a bounded table, are held."""
    chunks: dict[int, np.ndarray] = {}
    for b in parts:
        for k, x in zip(b.column(0).to_pylist(), b.column(2), strict=True):
            chunks[k] = chunks.get(k, 0) + np.frombuffer(x.as_py(), np.int64)
    yield _packed(chunks, 0)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """PLACES vectors of unit length, or zero where no word falls: a place's mean neighbour, less what all places have in common."""
    kinds = "chunk int, salt int, sums binary"
    once = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(_sums, kinds)
    rows = once.repartition("chunk", "salt").mapInArrow(_added, kinds).repartition("chunk").mapInArrow(_added, kinds).collect()  # PLACES x DIMS numbers
    sums = np.zeros((PLACES // CHUNK, CHUNK * DIMS))
    for r in rows:
        sums[r.chunk] = np.frombuffer(r.sums, np.int64)
    sums = sums.reshape(PLACES, DIMS)
    # sums run over a few powers of ten: roots keep frequent neighbours from being all there is
    v = np.sign(sums) * np.sqrt(np.abs(sums))
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    v = np.divide(v, norm, where=norm > 0, out=np.zeros_like(v))
    some = norm[:, 0] > 0
    v[some] -= v[some].mean(0) if some.any() else 0
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, norm, where=norm > 0, out=np.zeros_like(v)).astype(np.float32)


def pool(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """A row for each text: mean and spread of its words' vectors, mean product of neighbours, log of the number of words."""
    n, width = len(column), vectors.shape[1]
    total, square, beside = (np.zeros((n, width)) for _ in range(3))
    count = np.zeros(n)
    for place, row, old in _joined(_blocks(column), 1):
        v = vectors[place]
        for out, x, r in ((total, v[old:], row[old:]), (square, v[old:] ** 2, row[old:]), (beside, v[:-1] * v[1:], np.where(row[:-1] == row[1:], row[1:], -1))):
            if len(r):
                first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
                sums, own = np.add.reduceat(x, first, axis=0), r[first]
                np.add.at(out, own[own >= 0], sums[own >= 0])
        count += np.bincount(row[old:], minlength=n)
    each = np.maximum(count, 1)[:, None]
    mean = total / each
    return np.concatenate([mean, np.sqrt(np.maximum(square / each - mean**2, 0)), beside / np.maximum(each - 1, 1), np.log1p(count)[:, None]], 1).astype(np.float32)


# -- network ---------------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Network:
    """Inputs are centred and scaled; tanh, then one output, whose score is divided by the temperature. Without weights the score is `share`."""

    vectors: np.ndarray
    share: float = 0.5
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: tuple[np.ndarray, ...] = ()
    temperature: float = 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for pooled rows."""
        if not self.weights:
            return np.full(len(x), self.share)
        return _sigmoid(_forward(self.weights, (x - self.centre) / self.scale)[1] / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _forward(w: tuple[np.ndarray, ...], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ w[0] + w[1])
    return hidden, hidden @ w[2] + w[3][0]


def gradient(w: tuple[np.ndarray, ...], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the mean negative log-likelihood plus DECAY times half the squared weights."""
    hidden, z = _forward(w, x)
    d = (_sigmoid(z) - y) / len(y)
    back = d[:, None] * w[2] * (1 - hidden**2)
    return x.T @ back + DECAY * w[0], back.sum(0), hidden.T @ d + DECAY * w[2], np.array([d.sum()])


def _train(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
    """All rows in every step, with momentum and scaling."""
    rng = np.random.default_rng(11)
    w = (rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1))
    mean, square = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    for t in range(1, STEPS + 1):
        for p, m, s, g in zip(w, mean, square, gradient(w, x, y), strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return w


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of scores with the least negative log-likelihood."""
    steps = np.exp(np.linspace(-2.5, 2.5, 201))
    loss = [np.logaddexp(0, np.where(y > 0, -z, z) / t).mean() for t in steps]
    return float(steps[int(np.argmin(loss))])


# -- operator --------------------------------------------------------------------------------------------------------------------


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4


def _pooled(texts: DataFrame, vectors: np.ndarray) -> DataFrame:
    """The columns of texts but the text, and x, the pooled row."""
    keep = [c for c in texts.columns if c != "text"]

    def run(parts):
        for b in slices(parts, 250):
            x = pool(b.column("text"), vectors)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), flat], names=[*keep, "x"])

    kinds = ", ".join(f"{n} {t}" for n, t in texts.dtypes if n != "text")
    return texts.mapInArrow(run, f"{kinds}, x array<float>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    """Word vectors of all documents, the network of labelled ones whose remainder is not 2."""
    vectors = word_vectors(docs)
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(remainder(F.col("doc_id")) != 2).select(F.col("doc_id").alias("_id"), (F.col("quality") > 0).cast("int").alias("y"))
    n = known.count()
    chosen = known.where(F.pmod(F.xxhash64(F.lit(13), "_id"), F.lit(1 << 40)) <= int((1 << 40) * min(1.0, sample / max(n, 1))))
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "y", "text")
    rows = durable(_pooled(texts, vectors)).orderBy("doc_id", "y", "x").toPandas()  # `sample` rows
    y = rows["y"].to_numpy(np.float64)
    if not len(y) or y.min() == y.max():
        return Network(vectors, float(y[0]) if len(y) else 0.5)
    x = np.stack(rows["x"].to_numpy()).astype(np.float64)
    kept = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[~kept])) < 2:
        kept[:] = False
    centre, scale = x[~kept].mean(0), x[~kept].std(0) + 1e-6
    x = (x - centre) / scale
    weights = _train(x[~kept], y[~kept])
    return Network(vectors, float(y.mean()), centre, scale, weights, temperature(_forward(weights, x[kept])[1], y[kept]) if kept.any() else 1.0)


def score(docs: DataFrame, model: Network, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""

    def run(parts):
        for b in slices(parts, 250):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(pool(b.column(1), model.vectors)), pa.float64())], names=["doc_id", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    scored = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    held = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
