"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(w . x - theta_k): the thresholds are ordered and share one weight vector; the expected severity of a text is the sum
over k of these. x marks which of the selected features a text has: whole words and word beginnings of 4 to 6 bytes, A-Z
lower-cased, by 64-bit hashes.

Labels say toxic or not; grades order the toxic ones: 0 for not toxic, and 1 to GRADES - 1 for thirds of the toxic rows by how many
different features they have that are found almost only in toxic rows. The model is fitted on at most about SAMPLE labelled rows, those with the
least hashes (a documented bound); every document is then scored, over its whole text.

Nulls, empties: a null or empty text has no features and the least severity; a label of null, or of a document that isn't there, is
not learned from; without toxic labels, or without labels, nothing is rejected and severity is 0. Rows are judged each
for itself, repeated or not. Extra columns are not read. Of features that tell equally much the ones with the least hash are taken; of thresholds that a
row meets equally the lower grade counts. A very long text is worked on by itself, with some tens of bytes for each of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _LOWER, as_long, durable, pieces, prefix_hash, range_hash, slices

SAMPLE, FEATURES, GRADES, STARTS = 12_000, 8192, 4, (4, 5, 6)
_LETTER = np.zeros(256, bool)
_LETTER[128:] = _LETTER[48:58] = _LETTER[97:123] = True


@dataclass(frozen=True)
class Ordinal:
    """features: sorted hashes; weights of them; thresholds, ascending."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def exceed(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) for scores x, a column for each k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - x[:, None], -50, 50)))


def _marks(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word and word beginning."""
    low = _LOWER[data]
    solid = np.append(_LETTER[low], False)
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.append(False, solid[:-1]) & ~edge
    start = np.flatnonzero(solid & ~before)
    after = np.append(solid[1:], False)
    cut = np.append(edge[1:], True)
    end = np.flatnonzero(solid & (~after | cut)) + 1
    row = np.searchsorted(at, start, "right") - 1
    h = prefix_hash(low)
    rows, keys = [row], [range_hash(h, start, end)]
    for n in STARTS:
        some = end - start >= n
        rows.append(row[some])
        keys.append(range_hash(h, start[some], start[some] + n) ^ np.uint64(n))
    return np.concatenate(rows), np.concatenate(keys)


def _features(texts: DataFrame) -> DataFrame:
    """toxic, keys (distinct features)."""

    def run(parts):
        for b in slices(parts):
            for i, j, data, at in pieces(b.column(1)):
                row, key = _marks(data, at)
                order = np.lexsort((key, row))
                row, key = row[order], key[order]
                first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (key[1:] != key[:-1]))) if len(row) else np.zeros(0, np.int64)
                cuts = pa.array(np.append(0, np.bincount(row[first], minlength=j - i).cumsum()), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.ListArray.from_arrays(cuts, as_long(key[first]))], names=["toxic", "keys"])

    return texts.mapInArrow(run, "toxic int, keys array<long>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Ordinal:
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    n = known.count()
    chosen = known.where(F.pmod(F.xxhash64(F.lit(5), "_id"), F.lit(1 << 40)) <= int((1 << 40) * min(1.0, sample / max(n, 1))))
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("toxic", "text")
    rows = durable(_features(texts))
    none = Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES - 1, 50.0))
    total, bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("toxic") > 0).cast("int")), F.lit(0))).first()
    if not bad or bad == total:
        return none
    base = bad / total
    seen = rows.select((F.col("toxic") > 0).cast("int").alias("y"), F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("bad"))
    z = (F.col("bad") - base * F.col("n")) / F.sqrt(F.col("n") * base * (1 - base))
    # rare words of a few copies tell nothing: a feature needs a share of the rows
    top = seen.where(F.col("n") >= max(3, total // 400)).withColumn("z", z).where((F.col("z") >= 4) & (F.col("bad") >= max(0.5, min(0.9, 3 * base)) * F.col("n"))).orderBy(F.col("z").desc(), "key").limit(features).toPandas()
    if not len(top):
        return none
    keys, order = np.unique(top["key"].to_numpy().view(np.uint64), return_index=True)
    pure = (top["bad"] >= 0.9 * top["n"]).to_numpy()[order]
    listed = docs.sparkSession.createDataFrame([(int(k), i) for i, k in enumerate(keys.view(np.int64).tolist())], "key long, at int")
    hits = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "toxic", F.explode_outer("keys").alias("key")).join(F.broadcast(listed), "key", "left")
    data = hits.groupBy("row").agg(F.first("toxic").alias("toxic"), F.collect_list("at").alias("at")).orderBy("row").toPandas()  # `sample` rows
    size = np.array([*map(len, data["at"])])
    at = np.concatenate([np.asarray(x, np.int64) for x in data["at"]] or [np.zeros(0, np.int64)])
    row = np.repeat(np.arange(len(data)), size)
    share = np.bincount(row, pure[at], len(data))
    toxic = data["toxic"].to_numpy() > 0
    cuts = np.quantile(share[toxic], np.arange(1, GRADES - 1) / (GRADES - 1))
    grade = np.where(toxic, 1 + np.searchsorted(cuts, share, "right"), 0)
    weights, thresholds = _solve(row, at, grade, len(keys))
    return Ordinal(keys, weights, thresholds)


def _solve(row: np.ndarray, at: np.ndarray, grade: np.ndarray, width: int, steps: int = 400, penalty: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of least penalised negative log-likelihood, by gradient steps with momentum and scaling.

    theta_k = theta_0 + sum of exp(gap): the order needs no constraint. A row of grade g adds, for each k, the log of P(grade > k) or of its
    complement among the two thresholds next to it: -log(P(>g-1) - P(>g)).
    """
    n = len(grade)
    w, free = np.zeros(width), np.append(3.0, np.zeros(GRADES - 2))
    m, s = np.zeros(width + GRADES - 1), np.zeros(width + GRADES - 1)
    for t in range(1, steps + 1):
        theta = np.append(free[0], free[0] + np.cumsum(np.exp(free[1:])))
        x = np.bincount(row, w[at], n)
        over = np.hstack([np.ones((n, 1)), 1 / (1 + np.exp(np.clip(theta[None, :] - x[:, None], -50, 50))), np.zeros((n, 1))])
        slope = over * (1 - over)
        up, down = over[np.arange(n), grade], over[np.arange(n), grade + 1]
        su, sd = slope[np.arange(n), grade], slope[np.arange(n), grade + 1]
        p = np.maximum(up - down, 1e-12)
        dx = -(su - sd) / p
        d_theta = np.bincount(grade, su / p, GRADES)[1:] - np.bincount(grade, sd / p, GRADES)[:-1]
        d_free = np.append(d_theta.sum(), [np.exp(free[k]) * d_theta[k:].sum() for k in range(1, GRADES - 1)])
        g = np.append(np.bincount(at, dx[row], width) + penalty * w, d_free)
        m += 0.1 * (g - m)
        s += 0.01 * (g * g - s)
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
        w -= step[:width]
        free -= step[width:]
    return w, np.append(free[0], free[0] + np.cumsum(np.exp(free[1:])))


def _signal(model: Ordinal, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """w . x for each row."""
    n, width = len(at) - 1, len(model.features)
    if not width:
        return np.zeros(n)
    row, key = _marks(data, at)
    place = np.minimum(np.searchsorted(model.features, key), width - 1)
    hit = model.features[place] == key
    pair = np.unique(row[hit].astype(np.int64) * width + place[hit])
    return np.bincount(pair // width, model.weights[pair % width], n)


def score(docs: DataFrame, model: Ordinal) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic (P(grade > 0)), grade (the likeliest), rejected (p_toxic >= 0.5)."""

    def run(parts):
        for b in slices(parts):
            for i, j, data, at in pieces(b.column(1)):
                over = model.exceed(_signal(model, data, at))
                steps = np.hstack([np.ones((j - i, 1)), over]) - np.hstack([over, np.zeros((j - i, 1))])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(over.sum(1)), pa.array(over[:, 0]), pa.array(steps.argmax(1).astype(np.int32)), pa.array(over[:, 0] >= 0.5)], names=["doc_id", "severity", "p_toxic", "grade", "rejected"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, severity double, p_toxic double, grade int, rejected boolean")


def keep(docs: DataFrame, model: Ordinal) -> DataFrame:
    """The documents, all columns, that are not rejected: judged row by row, without a join. Null and empty texts stay; columns may have any names."""
    names, where = docs.columns, docs.columns.index("text")

    def run(parts):
        for b in slices(parts):
            kept = [model.exceed(_signal(model, data, at))[:, 0] < 0.5 for _, _, data, at in pieces(b.column(where))]
            some = b.filter(pa.array(np.concatenate(kept) if kept else np.zeros(0, bool)))
            yield pa.RecordBatch.from_arrays(some.columns, names=names)

    return docs.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, docs.schema)  # Python's side takes no dots in names
