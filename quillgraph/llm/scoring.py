"""Language-model scores of documents by causal self-attention over subword ids, in numpy.

Words, A-Z lower-cased, are cut into ids of a public byte-level vocabulary; a text ends with one end id. The model tells the next id in two steps,
its class and its place in the class, for the GROUPS * GROUP most frequent ids; all others are one class, shared by their counts. Both
logits come from one attention layer with a feed-forward step over the last WINDOW ids at most. Before training it is the unigram
model of the corpus.

The first pass cuts every text into ids, counts words and ids of all training documents, and stores the ids. Training: the documents are dealt to
rounds, each about twice as large as the one before, more of them the more documents there are; in a round every task goes on from the weights of the
round before, and weights are averaged by the targets seen. Every text of a round is windows of WINDOW inputs, one after the other, so every id of
every training document is an input, and a target: the windows that begin at one block have the places of every other block as targets, and those that begin
at the next block all others, so each id is told once from the WINDOW / 2 ids before it at least, as in scoring. How tasks split the table decides which windows a step sees, so another split gives other
scores, within what training leaves to chance. Scoring: windows overlap by half; the later half of each is scored, so every id is scored once, with at
least WINDOW / 2 ids before it where the text has them, in batched masked attention.

The base score needs the count of every word in the training texts. The HEAD most frequent words, a table of bounded size, go to the
tasks; all other words of a document are joined with the counts. A word is told by the ids that it is cut into.

Nulls, empties: a null text is empty: one token, its end. A null doc_id counts as training. Every row is scored by itself,
repeated or not. Extra columns are not read. A text may be of any length; it is scored in chunks of CHUNK blocks.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from numpy.lib.stride_tricks import as_strided
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_long, drop, durable, lower_bytes, pieces, prefix_hash, range_hash, raw, word_ranges

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Pre-tokenisation pattern of that vocabulary, a fixed value.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WINDOW, STRIDE, WIDTH, HIDDEN = 32, 16, 24, 48
GROUPS, GROUP = 45, 45
#: Windows of a step; learning rate of the first round.
BATCH, RATE = 512, 0.01
HEAD, CHUNK = 1 << 17, 512
#: Documents of the first round of training; rounds double.
ROUND_DOCS = 20_000
#: Tasks that add up the weights of a round; words that a worker keeps.
ADDERS, KEPT = 16, 500_000
ONES = np.ones(64, np.float32)
#: Logits of less are told by exp as they are.
SAFE = 40
#: Key of the one end token among words.
END = np.uint64(0)
#: What the first pass tells: counts of words, counts of ids, held-out documents, and from there on the rounds of training documents.
WORDS, IDS, HELD, ROUNDS = 0, 1, 2, 3
_ID = np.random.default_rng(20250311).integers(1, 2**63, 1 << 16, dtype=np.uint64) | np.uint64(1)


@dataclass
class Classes:
    """Of each id: its class and its place there. The last class holds the ids that are not predicted one by one, by their share."""

    of: np.ndarray
    place: np.ndarray
    inputs: np.ndarray
    share: np.ndarray
    first: np.ndarray
    second: np.ndarray

    #: Rows of the input table besides those of ids: rare ids, the start of a text, nothing.
    RARE, START, NONE = GROUPS * GROUP, GROUPS * GROUP + 1, GROUPS * GROUP + 2
    ROWS = GROUPS * GROUP + 3


def classes(counts: np.ndarray, begins: np.ndarray) -> Classes:
    """counts of ids; begins: which ids begin a word. The most frequent ids stand one by one in classes of neighbours by begins and rank."""
    n = counts + 1.0
    top = np.argsort(-counts, kind="stable")[: GROUPS * GROUP]
    top = top[np.argsort(~begins[top], kind="stable")]
    of, place, inputs = np.full(len(n), GROUPS, np.int8), np.zeros(len(n), np.int8), np.full(len(n), Classes.RARE, np.int32)
    rank = np.arange(len(top))
    of[top], place[top], inputs[top] = rank // GROUP, rank % GROUP, rank
    mass = np.bincount(of, n, GROUPS + 1)
    rare = of == GROUPS
    share = np.where(rare, n / max(mass[GROUPS], 1), 1)
    return Classes(of, place, inputs, np.log(share).astype(np.float32), np.log(mass / mass.sum()).astype(np.float32), np.log(n[top] / mass[rank // GROUP]).reshape(GROUPS, GROUP).astype(np.float32))


class Attention:
    """One causal self-attention layer; weights are float32 arrays by name."""

    def __init__(self, kinds: Classes, seed: int = 5):
        r, d, h, rows = np.random.default_rng(seed), WIDTH, HIDDEN, Classes.ROWS
        normal = lambda s, *shape: r.normal(0, s, shape).astype(np.float32)
        zero = lambda *shape: np.zeros(shape, np.float32)
        own = {"emb": normal(0.5, rows, d), "q": normal(d**-0.5, d, d), "k": normal(d**-0.5, d, d), "v": normal(d**-0.5, d, d), "near": zero(WINDOW), "a": normal(d**-0.5, d, h), "ab": zero(h), "b": normal(0.5 * h**-0.5, h, d)}
        self.w = own | {"one": normal(0.02, d, GROUPS + 1), "one_b": kinds.first.copy(), "two": normal(0.02, GROUPS, d, GROUP), "two_b": kinds.second.copy()}

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.w.values()])

    def load(self, flat: np.ndarray) -> Attention:
        at = 0
        for n, x in self.w.items():
            self.w[n] = flat[at : at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size
        return self

    def ready(self) -> Attention:
        """What scoring would compute again and again: query, the row itself and value of every input row, and additions to logits."""
        w = self.w
        self.table = np.concatenate([w["emb"] @ self.asked(), w["emb"], w["emb"] @ w["v"]], 1)
        self.bias = self.near(np.arange(STRIDE))[0]
        return self

    def asked(self) -> np.ndarray:
        """Query and key in one: makes queries that meet the input rows themselves, which spares the keys."""
        return (self.w["q"] @ self.w["k"].T) * np.float32(WIDTH**-0.5)

    def near(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Addition to logits of target positions `at` of the later half: by distance; nothing comes later."""
        dist = (STRIDE + at)[:, None] - np.arange(WINDOW)[None, :]
        return np.where(dist >= 0, self.w["near"][np.maximum(dist, 0)], np.float32(-1e4)), dist

    def attend(self, q: np.ndarray, kv: np.ndarray, bias: np.ndarray, opens: np.ndarray, step: int = 1, out: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Attention (in out, if given), not yet divided by its sums, with the sums; keys and values of each window (the same if kv has one WIDTH only). A
        window begins every `step` blocks."""
        n = len(q)
        win = as_strided(kv, (n, WINDOW, kv.shape[2]), (step * STRIDE * kv.strides[1], kv.strides[1], kv.strides[2]))
        key, value = win[:, :, :WIDTH], win[:, :, -WIDTH:]
        e = np.matmul(q, key.transpose(0, 2, 1), out=out)
        e += bias
        e[opens, :, :STRIDE] = -1e4
        np.exp(level(e, STRIDE), out=e)
        return e, e @ ONES[:WINDOW], key, value

    def up(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The feed-forward step: its inner values, and what it makes of z."""
        w = self.w
        f = z @ w["a"]
        f += w["ab"]
        np.maximum(f, 0, out=f)
        u = f @ w["b"]
        u += z
        return f, u

    def heads(self, u: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of rows in the order of their classes: u with a column of ones, the weights that it meets, the logits of the class and (of rows whose class has
        places) of the place, and each class with its rows."""
        w = self.w
        u = np.concatenate([u, np.ones((len(u), 1), u.dtype)], 1)
        w1, w2 = np.vstack([w["one"], w["one_b"]]), np.concatenate([w["two"], w["two_b"][:, None]], 1)
        cut = np.append(0, np.bincount(of, minlength=GROUPS + 1).cumsum()).tolist()
        parts = [(k, slice(cut[k], cut[k + 1])) for k in range(GROUPS) if cut[k] < cut[k + 1]]
        two = np.empty((cut[GROUPS], GROUP), u.dtype)
        for k, part in parts:
            np.matmul(u[part], w2[k], out=two[part])
        return u, w1, w2, level(u @ w1), level(two), parts

    def log_prob(self, rows: np.ndarray, opens: np.ndarray, cls: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Log-probability of the target at each place of the later blocks; rows: blocks + 1."""
        g = self.table.take(rows, 0)
        e, total, _, value = self.attend(g[1:, :, :WIDTH], g[:, :, WIDTH:], self.bias, opens)
        z = e @ value
        z /= total[:, :, None]
        z += g[1:, :, WIDTH : 2 * WIDTH]
        order = np.argsort(cls, kind="stable")
        of = cls.take(order)
        _, u = self.up(z.reshape(-1, WIDTH).take(order, 0))
        _, _, _, one, two, _ = self.heads(u, of)
        log = one.ravel().take(np.arange(0, one.size, GROUPS + 1) + of)
        log -= np.log(np.exp(one, out=one) @ ONES[: GROUPS + 1])
        m = len(two)
        log[:m] += two.ravel().take(np.arange(0, two.size, GROUP) + place.take(order[:m]))
        log[:m] -= np.log(np.exp(two, out=two) @ ONES[:GROUP])
        out = np.empty_like(log)
        out[order] = log
        return out

    def gradient(self, rows: np.ndarray, opens: np.ndarray, real: np.ndarray, cls: np.ndarray, place: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-likelihood. Windows of two blocks each, one after the other: rows (2 * windows x STRIDE) of inputs; of the later
        blocks (windows x STRIDE) whether they open a text, targets that are real, their classes and places; at: the places that are targets now."""
        w, d, scale = self.w, WIDTH, np.float32(WIDTH**-0.5)
        n, t = len(real), len(at)
        (bias, dist), asked = self.near(at), self.asked()
        at = slice(None) if t == STRIDE else at
        x = w["emb"].take(rows, 0)
        late = x[1::2, at].reshape(-1, d)
        # what goes back to a window's rows is one product: by the change of logits from the queries, by attention from the change of values
        by, of = np.empty((n, 2 * t, WINDOW), x.dtype), np.empty((n, 2 * t, d), x.dtype)
        q, own, dp = of[:, :t], of[:, t:], by[:, :t]
        q[:] = (late @ asked).reshape(n, t, d)
        e, total, key, _ = self.attend(q, x, bias, opens, 2, by[:, t:])
        part_of = 1 / total[:, :, None]
        met = e @ key  # the input rows that each target attends to, before they are values
        met *= part_of
        c = cls[:, at].ravel()
        order = np.argsort(c, kind="stable")
        c, p, ok = c.take(order), place[:, at].ravel().take(order), real[:, at].ravel().take(order).astype(x.dtype)
        ok /= max(ok.sum(), 1)
        z = met.reshape(-1, d) @ w["v"]
        z += late
        z = z.take(order, 0)
        f, u = self.up(z)
        u, w1, w2, one, two, parts = self.heads(u, c)
        m = len(two)
        for s, target in ((one, c), (two, p[:m])):
            np.exp(s, out=s)
            s *= (ok[: len(s)] / (s @ ONES[: s.shape[1]]))[:, None]
            s.reshape(-1)[np.arange(0, s.size, s.shape[1]) + target] -= ok[: len(s)]
        g1, g2 = (one.T @ u).T, np.zeros((GROUPS, GROUP, d + 1), x.dtype)  # the wider factor first: BLAS is faster so
        du, ds = one @ w1[:d].T, np.empty((m, d), x.dtype)
        for k, part in parts:
            np.matmul(two[part].T, u[part], out=g2[k])
            np.matmul(two[part], w2[k, :d].T, out=ds[part])
        du[:m] += ds
        g = {"one": g1[:d], "one_b": g1[d], "two": g2[:, :, :d].transpose(0, 2, 1), "two_b": g2[:, :, d], "b": (du.T @ f).T}
        df = du @ w["b"].T
        df *= f > 0
        g["a"], g["ab"] = z.T @ df, np.ones(len(df), x.dtype) @ df
        du += df @ w["a"].T
        dz = np.empty_like(du)
        dz[order] = du
        g["v"] = met.reshape(-1, d).T @ dz
        np.multiply((dz @ w["v"].T).reshape(n, t, d), part_of, out=own)
        np.matmul(own, key.transpose(0, 2, 1), out=dp)
        dp -= ((own * met) @ ONES[:d])[:, :, None]
        dp *= e
        g["near"] = np.bincount(np.maximum(dist, 0).ravel(), np.where(dist >= 0, dp.sum(0), 0).ravel(), WINDOW).astype(np.float32)
        dq = (dp @ key).reshape(-1, d)
        dx = (by.transpose(0, 2, 1) @ of).reshape(x.shape)
        dz += dq @ asked.T
        dx[1::2, at] += dz.reshape(n, t, d)
        g["emb"] = scatter(rows.ravel(), dx.reshape(-1, d), len(w["emb"]))
        dm = (late.T @ dq) * scale
        g["q"], g["k"] = dm @ w["k"], dm.T @ w["q"]
        return g


def level(x: np.ndarray, sure: int = 0) -> np.ndarray:
    """Logits, less the largest of each row where any exp could overflow or a row's could all vanish; sure: a place where each row's logit is not masked."""
    if x.size and not (x.max() < SAFE and x[..., sure].min() > -SAFE):
        x -= x.max(-1, keepdims=True)
    return x


def scatter(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by at."""
    order = np.argsort(at.astype(np.int16), kind="stable")
    key = at[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[key[new]] = np.add.reduceat(rows.take(order, 0), new, 0)
    return out


class Adam:
    def __init__(self, model: Attention, rate: float):
        self.model, self.rate, self.t = model, rate, 0
        self.m, self.s, self.by = ({k: np.zeros_like(v) for k, v in model.w.items()} for _ in range(3))

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        c1, c2 = 1 / (1 - 0.9**self.t), 1 / (1 - 0.98**self.t)
        for k, x in g.items():
            m, s, by = self.m[k], self.s[k], self.by[k]
            np.subtract(x, m, out=by)
            by *= np.float32(0.1)
            m += by
            np.multiply(x, x, out=by)
            by -= s
            by *= np.float32(0.02)
            s += by
            np.sqrt(s, out=by)
            by += np.float32(1e-8 / math.sqrt(c2))
            np.divide(m, by, out=by)
            by *= np.float32(self.rate * c1 / math.sqrt(c2))
            self.model.w[k] -= by


def blocks(kinds: Classes, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts in a row, each with its end, as blocks of STRIDE inputs, with one of nothing before each text; a window is two blocks. Rows of the input
    table and ids of the targets (blocks x STRIDE; -1: none), the text of each block, and which blocks are a text's first with targets."""
    per = -(-size // STRIDE)
    begin = np.append(0, (per + 1).cumsum())[:-1]
    total = int((per + 1).sum())
    stop = size.cumsum()
    at = np.arange(len(ids)) + np.repeat((begin + 1) * STRIDE - (stop - size), size)
    target = np.full(total * STRIDE, -1, np.int32)
    target[at] = ids
    rows = np.full(total * STRIDE, Classes.NONE, np.int32)
    r = kinds.inputs[ids]
    rows[at[1:]] = r[:-1]
    rows[(begin + 1) * STRIDE] = Classes.START
    opens = np.zeros(total, bool)
    opens[begin + 1] = True
    return rows.reshape(-1, STRIDE), target.reshape(-1, STRIDE), np.repeat(np.arange(len(size)), per + 1), opens


def train_on(model: Attention, adam: Adam, kinds: Classes, ids: np.ndarray, size: np.ndarray, begin: int | None = None) -> int:
    """A step for each BATCH windows of these texts, all places of the later blocks targets; windows begin at this block (0 or 1; None: in turn). How many targets
    there were."""
    rows, target, _, opens = blocks(kinds, ids, size)
    lo = adam.t % 2 if begin is None else begin
    if (len(rows) - lo) % 2:  # the last block has nothing after it
        rows, target, opens = np.pad(rows, ((0, 1), (0, 0)), constant_values=Classes.NONE), np.pad(target, ((0, 1), (0, 0)), constant_values=-1), np.append(opens, False)
    cls, place = kinds.of.take(np.maximum(target, 0)), kinds.place.take(np.maximum(target, 0))
    real, seen, at = target >= 0, 0, np.arange(STRIDE)
    while lo + 2 <= len(rows):
        hi = lo + 2 * min(BATCH, (len(rows) - lo) // 2)
        late = slice(lo + 1, hi, 2)
        adam.step(model.gradient(rows[lo:hi], opens[late], real[late], cls[late], place[late], at))
        seen += int(real[late].sum())
        lo = hi
    return seen


def train_whole(model: Attention, adam: Adam, kinds: Classes, ids: np.ndarray, size: np.ndarray) -> int:
    """Every id of these texts, their ends included, is a target once: blocks take turns at being the later one of a window."""
    return sum(train_on(model, adam, kinds, ids, size, begin) for begin in (0, 1))


def score_of(model: Attention, kinds: Classes, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
    """log10 probability of each text."""
    rows, target, text, opens = blocks(kinds, ids, size)
    out = np.zeros(len(size))
    for lo in range(0, len(rows) - 1, CHUNK):
        hi = min(lo + CHUNK, len(rows) - 1)
        t = target[lo + 1 : hi + 1].ravel()
        some = np.maximum(t, 0)
        log = model.log_prob(rows[lo : hi + 1], opens[lo + 1 : hi + 1], kinds.of.take(some), kinds.place.take(some))
        log += kinds.share.take(some)
        log[t < 0] = 0
        out += np.bincount(text[lo + 1 : hi + 1], log.reshape(-1, STRIDE).sum(1, dtype=np.float64), len(size))
    return out / math.log(10)


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def begins_of(ranks: dict[bytes, int]) -> np.ndarray:
    """Which ids begin a word: each word is cut with the space before it. The last id is the end."""
    out = np.zeros(max(ranks.values()) + 2, bool)
    out[[i for b, i in ranks.items() if b[:1] == b" "]] = True
    out[-1] = True
    return out


class Words:
    """Ids of the words of texts; what a word is cut into is kept from text to text and told by the word's hash."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bpe = tiktoken.Encoding("subwords", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.clear()

    def clear(self) -> None:
        self.known = self.row = np.zeros(0, np.int64)
        self.flat, self.at, self.key = np.zeros(0, np.uint16), np.zeros(1, np.int64), np.zeros(0, np.uint64)

    def __call__(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, how many of each text; of every word the text it is in, and its key."""
        low = lower_bytes(data)
        start, end, first = word_ranges(low, at)
        hashes = range_hash(prefix_hash(low), start, end).view(np.int64)
        some, where, of = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > KEPT:
            self.clear()
        place = np.searchsorted(self.known, some)
        new = np.flatnonzero(self.known[np.minimum(place, len(self.known) - 1)] != some) if len(self.known) else np.arange(len(some))
        if len(new):
            body = low.tobytes()
            lists = [self.bpe.encode_ordinary(" " + body[start[i] : end[i]].decode("utf-8", "replace")) for i in where[new]]
            ids = np.fromiter((x for one in lists for x in one), np.uint16)
            cut = np.append(0, np.cumsum([*map(len, lists)]))
            self.key = np.append(self.key, range_hash(prefix_hash(ids, _ID), cut[:-1], cut[1:]))
            self.known, self.row = np.insert(self.known, place[new], some[new]), np.insert(self.row, place[new], len(self.at) - 1 + np.arange(len(new)))
            self.flat, self.at = np.append(self.flat, ids), np.append(self.at, self.at[-1] + cut[1:])
        row = self.row[np.searchsorted(self.known, some)][of]
        size = self.at[row + 1] - self.at[row]
        stop = size.cumsum()
        ids = self.flat[np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.at[row] - (stop - size), size)]
        return ids, np.diff(np.append(0, stop)[first]), np.repeat(np.arange(len(at) - 1), np.diff(first)), self.key[row]


#: A worker keeps its words from task to task, by vocabulary.
_KEPT: dict[int, Words] = {}


def words_of(ranks: dict[bytes, int]) -> Words:
    key = hash(frozenset(ranks.items()))
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Words(ranks)
    return _KEPT[key]


TOLD = "part int, key long, n double, doc_id long, ids binary"


def _told(part: int, key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(key), 100_000):
        k = np.ascontiguousarray(key[i : i + 100_000]).astype(np.uint64, copy=False)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), part, np.int32)), as_long(k), pa.array(n[i : i + 100_000].astype(np.float64)), pa.nulls(len(k), pa.int64()), pa.nulls(len(k), pa.binary())], names=["part", "key", "n", "doc_id", "ids"])


def _cut(texts: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """TOLD: the ids of every document, and counts of words and ids of the training documents."""

    def run(parts):
        words, ids_n = words_of(ranks), np.zeros(1 << 16)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return key, np.bincount(at, np.concatenate([n for _, n in held]))

        for b in parts:
            for i, j, data, at in pieces(b.column(2)):
                part = b.column(0).slice(i, j - i)
                train = part.to_numpy() >= ROUNDS
                ids, size, text, keys = words(data, at)
                stop = size.cumsum()
                lists = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((np.append(0, stop) * 2).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([part, pa.nulls(j - i, pa.int64()), pa.nulls(j - i, pa.float64()), b.column(1).slice(i, j - i), lists], names=["part", "key", "n", "doc_id", "ids"])
                key, n = np.unique(keys[train[text]], return_counts=True)
                held.append((np.append(key, END), np.append(n, train.sum())))
                ids_n += np.bincount(ids[np.repeat(train, size)], minlength=1 << 16)
                if sum(len(k) for k, _ in held) > 1_500_000:
                    held = [merged()]
                    if len(held[0][0]) > 700_000:
                        yield from _told(WORDS, *held.pop())
        if held:
            yield from _told(WORDS, *merged())
        some = np.flatnonzero(ids_n)
        yield from _told(IDS, some, ids_n[some])

    return texts.mapInArrow(run, TOLD)


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after, ids in a row, how many of each row; a text's end is not among them."""
    for i, j, data, at in pieces(column):
        yield i, j, data.view(np.uint16).astype(np.int32), np.diff(at) // 2


def _ended(ids: np.ndarray, size: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, size.cumsum(), end), size + 1


def _train(stored: DataFrame, kinds: Classes, start: np.ndarray, rate: float, end: int) -> tuple[np.ndarray, int]:
    """Weights of all tasks, averaged by the targets that each saw, and all targets."""

    def run(parts):
        model = Attention(kinds).load(start)
        adam, seen = Adam(model, rate), 0
        for b in parts:
            for _, _, ids, size in _texts(b.column(0)):
                seen += train_whole(model, adam, kinds, *_ended(ids, size, end))
        if seen:
            yield _sum(model.flat().astype(np.float64) * seen, seen)

    def add(parts):
        total, seen = np.zeros(len(start)), 0
        for b in parts:
            for n, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                total += np.frombuffer(blob.as_buffer(), np.float64)
                seen += n
        if seen:
            yield _sum(total, seen)

    told = stored.mapInArrow(run, "seen long, weights binary").repartition(ADDERS).mapInArrow(add, "seen long, weights binary").toPandas()
    seen = int(told["seen"].sum())
    return (sum(np.frombuffer(x, np.float64) for x in told["weights"]) / seen).astype(np.float32) if seen else start, seen


def _sum(weights: np.ndarray, seen: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([weights.tobytes()], pa.binary())], names=["seen", "weights"])


def _score(stored: DataFrame, begins: np.ndarray, kinds: Classes, weights: np.ndarray, head: np.ndarray, head_log: np.ndarray) -> DataFrame:
    """uid, doc_id, held_out, n_tokens, known and base (of words in the head), score, tail (other words)."""
    end = len(begins) - 1

    def run(parts):
        model = Attention(kinds).load(weights).ready()
        uid = TaskContext.get().partitionId() << 40
        for b in parts:
            for i, j, ids, size in _texts(b.column(2)):
                start = np.flatnonzero(begins[ids])
                keys = range_hash(prefix_hash(ids, _ID), start, np.append(start[1:], len(ids)))
                row = np.repeat(np.arange(j - i), size)[start]
                some, of = np.unique(keys, return_inverse=True)
                place = np.minimum(np.searchsorted(head, some), len(head) - 1)
                hit = (head[place] == some if len(head) else np.zeros(len(some), bool))[of]
                base = np.bincount(row[hit], head_log[place[of][hit]] if len(head) else None, j - i)
                n_tail = np.append(0, np.bincount(row[~hit], minlength=j - i).cumsum())
                columns = [pa.array(np.arange(uid, uid + j - i)), b.column(0).slice(i, j - i), pa.array(b.column(1).slice(i, j - i).to_numpy() == HELD), pa.array(np.bincount(row, minlength=j - i) + 1), pa.array(np.bincount(row[hit], minlength=j - i))]
                columns += [pa.array(base.astype(np.float64)), pa.array(score_of(model, kinds, *_ended(ids, size, end))), pa.ListArray.from_arrays(pa.array(n_tail, pa.int32()), as_long(keys[~hit]))]
                yield pa.RecordBatch.from_arrays(columns, names=["uid", "doc_id", "held_out", "n_tokens", "known", "base", "score", "tail"])
                uid += j - i

    return stored.mapInArrow(run, "uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, tail array<long>")


def score(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the text under the model)."""
    ranks = ranks_of(vocabulary)
    begins = begins_of(ranks)
    if len(begins) > 1 << 16:
        raise ValueError("ids of the vocabulary are stored in 16 bits")
    end = len(begins) - 1
    rounds = 1 + (docs.select("doc_id").count() // ROUND_DOCS).bit_length()
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    # a share of the documents that is uniform, cut at 1, 3, 7, ... of 2 ** rounds - 1
    share = F.pmod(F.xxhash64(F.lit(5), "doc_id", F.octet_length("text")), F.lit(1 << 30)) / (1 << 30)
    at = F.least(F.floor(F.log2(share * (2**rounds - 1) + 1)), F.lit(rounds - 1)).cast("int")
    texts = docs.select(F.when(held_out, F.lit(HELD)).otherwise(at + ROUNDS).alias("part"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    told = durable(_cut(texts, ranks), "part")

    counts = durable(told.where(F.col("part") == WORDS).groupBy("key").agg(F.sum("n").alias("n")))
    total, distinct, end_n = counts.agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("key") == 0, F.col("n"))), F.lit(0.0))).first()
    small = told.where(F.col("part") == IDS).groupBy("key").agg(F.sum("n").alias("n")).toPandas()  # as many rows as ids
    id_n = np.zeros(len(begins))
    id_n[small["key"].to_numpy()] = small["n"].to_numpy()
    id_n[end] = end_n
    kinds = classes(id_n, begins)
    weights = Attention(kinds).flat()
    for k in range(rounds):
        weights, _ = _train(told.where(F.col("part") == ROUNDS + k).select("ids"), kinds, weights, RATE / math.sqrt(1 + k), end)

    top = counts.orderBy(F.col("n").desc(), "key").limit(HEAD).toPandas()
    head, order = np.unique(top["key"].to_numpy().view(np.uint64), return_index=True)
    divisor = total + distinct + 1
    head_log = np.log10((top["n"].to_numpy()[order] + 1) / divisor)
    scored = durable(_score(told.where(F.col("part") >= HELD).select("doc_id", "part", "ids"), begins, kinds, weights, head, head_log))
    drop(told)
    rest = scored.select("uid", F.explode("tail").alias("key")).join(counts, "key", "left").groupBy("uid").agg(F.sum(F.log10((F.coalesce("n", F.lit(0.0)) + 1) / divisor)).alias("more"), F.count("n").alias("found"))
    return scored.drop("tail").join(rest, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("found", F.lit(0)) + F.lit(int(end_n > 0))).cast("bigint").alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + F.lit(float(np.log10((end_n + 1) / divisor)))).alias("base_score"),
        "score",
    )
