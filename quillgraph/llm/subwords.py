"""SentencePiece encoding and decoding by suffix-array matching.

The pieces and ranks come from a model file, read by the driver (the file bounds what is sent to the tasks). A batch's different
segments (a word with the spaces before it; no piece reaches across) stand in one text of code points with an enhanced order of its
suffixes, told apart up to the longest piece. Every piece is binary-searched for the range of suffixes that start with it: these ranges
are all occurrences, the edges of the segment lattices. Edges sorted by position make a table of (position, length) to
piece; then they are relaxed. The models at hand are BPE models, so relaxing follows their rule: of the edges that join two
neighbouring tokens of a segment, the best-ranked and leftmost is taken, until none is left, for all segments at once. What no
piece covers falls back to bytes. The ids are those of the sentencepiece library for such models.

Decoding gathers the bytes of the pieces, for all texts of a batch at once, and takes off the space put before each text.

Nulls, empties: a null text is empty; an empty text has no ids. U+2581 is the model's own sign for a space and decodes to one, as
with the library. Rows are encoded each for itself, repeated or not. Extra columns are not read. A text may be of any length; its longest stretch without
white space bounds what a task holds: 4 bytes for each of its code points and each length that pieces have (some 70 bytes a code point for the model at hand).
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Encoded, gather, pieces, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_MARK = SPACE.encode()
#: Code points of one suffix array, about; more segments are taken in turns.
TEXT = 400_000
#: Stands for the code point 0 in a suffix array; no text has it.
NUL = 2**21 - 1
#: Longer segments are merged with a heap, one by one.
LONG = 256


@dataclass(frozen=True)
class Model:
    """pieces: text, id and score of the ordinary pieces; byte_ids: ids of the 256 bytes; spelled: bytes of each id."""

    texts: list[str]
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    spelled: list[bytes]


def read_model(path: str = MODEL) -> Model:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
    of_byte = {int(i): bytes([b]) for b, i in enumerate(byte_ids)}
    spelled = [of_byte[i] if i in of_byte else b"" if sp.is_control(i) or sp.is_unknown(i) else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(n)]
    return Model([sp.id_to_piece(i) for i in plain], np.array(plain, np.int32), np.array([sp.get_score(i) for i in plain], np.float32), byte_ids, spelled)


def _rank(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    s = key[order]
    up = np.zeros(len(key), np.int64)
    up[1:] = np.cumsum(s[1:] != s[:-1])
    out = np.empty(len(key), np.int64)
    out[order] = up
    return out


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of their suffixes, told apart by `depth` code points (0 ends every segment and sorts first)."""
    n = len(text)
    rank = _rank(packed(text))
    step = 3
    while step < depth:
        second = np.zeros(n, np.uint64)
        second[: max(n - step, 0)] = rank[step:] + 1
        rank = _rank(rank.astype(np.uint64) << np.uint64(32) | second)
        step *= 2
    return np.argsort(rank, kind="stable")


def packed(text: np.ndarray) -> np.ndarray:
    """Three code points from each position in one word; 0 beyond the end."""
    n = len(text)
    padded = np.append(text, np.zeros(3, text.dtype)).astype(np.uint64)
    return padded[:n] << np.uint64(42) | padded[1 : n + 1] << np.uint64(21) | padded[2 : n + 2]


def occurrences(words: np.ndarray, order: np.ndarray, wanted: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of wanted (packed code points, as masks say how many count) the range of order whose suffixes start with it.

    words: packed() of the text. One binary search for all rows at once, for the first suffix that isn't before and the first that is after.
    """
    n, width = len(order), wanted.shape[1]
    padded = np.append(words, np.zeros(3 * width, np.uint64))

    def bound(after: bool) -> np.ndarray:
        lo, hi = np.zeros(len(wanted), np.int64), np.full(len(wanted), n)
        for _ in range(int(n).bit_length()):
            mid = (lo + hi) >> 1
            at = order[np.minimum(mid, n - 1)]
            up = (padded[at] & masks[:, 0]) < wanted[:, 0]
            tied = np.flatnonzero((padded[at] & masks[:, 0]) == wanted[:, 0])
            for k in range(1, width):
                tied = tied[masks[tied, k] != 0] if not after else tied
                here, there = padded[at[tied] + 3 * k] & masks[tied, k], wanted[tied, k]
                up[tied] = here < there
                tied = tied[here == there]
                if not len(tied):
                    break
            if after:
                up[tied] = True
            up &= lo < hi
            lo, hi = np.where(up, mid + 1, lo), np.where(up | (lo >= hi), hi, mid)
        return lo

    return bound(False), bound(True)


class Encoder:
    def __init__(self, model: Model):
        self.model = model
        self.size = np.array([*map(len, model.texts)])
        self.depth = int(self.size.max())
        points = np.zeros((len(model.texts), -(-self.depth // 3) * 3), np.uint64)
        for i, t in enumerate(model.texts):
            points[i, : len(t)] = [*map(ord, t)]
        there = np.where(np.arange(points.shape[1]) < self.size[:, None], np.uint64(2**21 - 1), np.uint64(0))
        self.wanted, self.masks = (x[:, 0::3] << np.uint64(42) | x[:, 1::3] << np.uint64(21) | x[:, 2::3] for x in (points, there))
        self.newline_apart = not any("\n" in t for t in model.texts if len(t) > 1)
        self.spaces_first = not any(SPACE in t.lstrip(SPACE) for t in model.texts)
        if not self.spaces_first:
            raise ValueError("pieces of this model reach across words")
        self.segments = Encoded(self.encode_segments)

    def split(self, text: bytes) -> list[bytes]:
        """Segments of a text, with the space put before it; their concatenation is the text that is encoded."""
        if not text:
            return []
        text = text.replace(_MARK, b" ")
        if b"  " in text or text[0] == 32 or not self.newline_apart:
            return [x.replace(b" ", _MARK) for x in re.findall(rb" *[^ \n]+| +|\n" if self.newline_apart else rb" *[^ ]+| +", b" " + text)]
        parts = text.replace(b"\n", b" \n").split(b" ")
        if parts[0] == b"":  # the text begins with a line end: the space before it stands alone
            return [_MARK, *parts[1:2], *self._marked(parts[2:])]
        return self._marked(parts)

    @staticmethod
    def _marked(parts: list[bytes]) -> list[bytes]:
        return [p if p[:1] == b"\n" else _MARK + p for p in parts]

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, how many of each)."""
        split = [*map(self.split, texts)]
        ids, of = self.segments([s for t in split for s in t])
        ends = np.append(0, of.cumsum())[np.cumsum([*map(len, split)])]
        return ids, np.diff(np.append(0, ends))

    def encode_segments(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all segments in a row, how many of each)."""
        words = [s.decode("utf-8", "replace") for s in segments]
        size = np.cumsum([len(w) + 1 for w in words])
        done, lo = [], 0
        while lo < len(words):
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + TEXT)))
            done.append(self._encode(words[lo:hi]))
            lo = hi
        return tuple(np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, length, piece) of every occurrence of every piece, by position."""
        order = suffix_order(text, self.depth)
        first, last = occurrences(packed(text), order, self.wanted, self.masks)
        hits = last - first
        piece = np.repeat(np.arange(len(hits)), hits)
        at = order[np.arange(hits.sum()) - np.repeat(hits.cumsum() - hits, hits) + np.repeat(first, hits)]
        by = np.argsort(at, kind="stable")
        return at[by], self.size[piece[by]], piece[by]

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        count = np.array([*map(len, words)])
        plain = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        text = np.insert(np.where(plain == 0, NUL, plain), count.cumsum(), 0)  # 0 ends each segment
        at, size, piece = self.edges(text)
        table = np.full((len(text), self.depth + 1), -1, np.int32)  # edges by position and length
        table[at, size] = piece
        begin = (count + 1).cumsum() - count - 1
        starts = self._relax(table, begin, count)
        # tokens of all words, in a row
        of = np.searchsorted(begin, starts, "right") - 1
        last = np.append(of[1:] != of[:-1], True)
        stop = np.where(last, (begin + count)[of], np.append(starts[1:], 0))
        found = table[starts, np.minimum(stop - starts, self.depth)]
        ids, size = self.model.ids[found], np.ones(len(found), np.int64)
        lost = np.flatnonzero(found < 0)  # no piece: the bytes of the code point
        if len(lost):
            spelled = [chr(c if c != NUL else 0).encode("utf-8", "surrogatepass") for c in text[starts[lost]].tolist()]
            size[lost] = [*map(len, spelled)]
            ids = np.repeat(ids, size)
            ids[np.repeat(found < 0, size)] = self.model.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        return ids, np.bincount(of, size, len(words)).astype(np.int64)

    def _relax(self, table: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Starts of the tokens that are left, in order."""
        score = np.append(self.model.scores, -np.inf).astype(np.float32)  # -1: no edge
        short = count <= LONG
        of = np.repeat(np.flatnonzero(short), count[short])
        start = np.arange(len(of)) - np.repeat(count[short].cumsum() - count[short], count[short]) + begin[of]
        stop = start + 1
        done = [self._heap(table, score, b, c) for b, c in zip(begin[~short], count[~short], strict=True)]
        while len(start):
            pair = np.full(len(start), -np.inf, np.float32)
            length = stop[1:] - start[:-1]
            ok = (of[1:] == of[:-1]) & (length <= self.depth)
            i = np.flatnonzero(ok)
            pair[i] = score[table[start[i], length[i]]]
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            best = np.maximum.reduceat(pair, first)
            span = np.diff(np.append(first, len(start)))
            live = np.repeat(best > -np.inf, span)
            done.append(start[~live])
            hit = np.flatnonzero(live & (pair == np.repeat(best, span)))
            hit = hit[np.append(True, of[hit[1:]] != of[hit[:-1]])] if len(hit) else hit  # the leftmost of each
            stop[hit] = stop[hit + 1]
            live[hit + 1] = False
            start, stop, of = start[live], stop[live], of[live]
        return np.sort(np.concatenate(done)) if done else np.zeros(0, np.int64)

    def _heap(self, table: np.ndarray, score: np.ndarray, begin: int, count: int) -> np.ndarray:
        """Token starts of one long segment: the same rule with a queue of pairs."""
        begin, n = int(begin), int(count)
        after, before, stop = [*range(1, n + 1)], [*range(-1, n - 1)], [*range(1, n + 1)]
        queue: list[tuple[float, int, int, int]] = []

        def add(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n and stop[j] - i <= self.depth and (e := table[begin + i, stop[j] - i]) >= 0:
                heapq.heappush(queue, (-float(score[e]), i, stop[i], stop[j]))

        for i in range(n - 1):
            add(i)
        gone = [False] * n
        while queue:
            _, i, middle, end = heapq.heappop(queue)
            j = after[i]
            if gone[i] or stop[i] != middle or j >= n or stop[j] != end:
                continue
            stop[i], after[i], gone[j] = end, after[j], True
            if after[j] < n:
                before[after[j]] = i
            add(i)
            if before[i] >= 0:
                add(before[i])
        return np.array([begin + i for i in range(n) if not gone[i]], np.int64)


#: A worker keeps its segments from task to task, for the last model.
_KEPT: dict[tuple, Encoder] = {}


def encoder_of(model: Model) -> Encoder:
    key = (len(model.texts), hash(tuple(model.texts)), model.scores.tobytes())
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Encoder(model)
    return _KEPT[key]


class Decoder:
    def __init__(self, model: Model):
        self.at = np.append(0, np.cumsum([*map(len, model.spelled)]))
        self.flat = np.frombuffer(b"".join(model.spelled), np.uint8)

    def __call__(self, ids: np.ndarray, size: np.ndarray) -> list[bytes]:
        """Texts of ids in a row, size of each; the space that encoding put before each text is off."""
        data, of = gather(self.flat, self.at, ids)
        body, ends = data.tobytes(), np.append(0, of.cumsum())[np.append(0, size.cumsum())]
        return [body[i:j].removeprefix(b" ") for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def encode(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_pieces, ids (array of int), decoded_same: whether decoding the ids gives the text again."""
    model = model or read_model()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the model file

    def run(parts):
        encoder, decoder = encoder_of(shared.value), Decoder(shared.value)
        for b in slices(parts):
            for i, j, data, at in pieces(b.column(1), 4_000_000):
                body = data.tobytes()
                texts = [body[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                ids, size = encoder(texts)
                same = [x.replace(_MARK, b" ") == y for x, y in zip(texts, decoder(ids, size), strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, size.cumsum()), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(size), lists, pa.array(same)], names=["doc_id", "n_pieces", "ids", "decoded_same"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, n_pieces long, ids array<int>, decoded_same boolean")


def decode(encoded: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id and ids to doc_id and text; null ids give an empty text."""
    model = model or read_model()
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(parts):
        decoder = Decoder(shared.value)
        for b in slices(parts):
            lists = b.column(1)
            texts = decoder(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t.decode("utf-8", "replace") for t in texts])], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
