"""SentencePiece encoding and decoding by suffix-array matching.

The distinct white-space segments of a batch are concatenated and indexed by a
suffix array. Every piece of the vocabulary is found by binary search as a range
of that array; the ranges give all edges (piece, place). Sorted by place, the
edges are relaxed from left to right for all segments at once.

The model merges pairs (BPE), so the best path is not the one with the largest
sum. What is relaxed instead is "the last token of the encoding of this prefix":
an edge continues a prefix when its piece and the last token before it are what
merging their joint text gives, which holds for exactly one edge at each place
that has an encoding. The outcome equals merging from the whole text; pairs that
were checked once are remembered. Segments can be told apart because no piece
has a space after another character. Characters without a piece become bytes.

Defined results: null and empty texts have no tokens; the dummy prefix of the
model is added and taken away; U+2581 in a text is a space, as the model sees
it, so such a text does not come back unchanged; repeated rows are rows; other
columns stay.
"""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from delaylake.llm import text as tx

SLICE = 4 << 20
SPACE = 32
MARK = "▁"
#: Segments remembered by a worker, beyond which new ones are indexed again.
REMEMBERED = 400_000


def default_model() -> str:
    """The model among the installed public tokenizers."""
    found = importlib.util.find_spec("public_tokenizers")
    if found is None:
        raise FileNotFoundError("give the path of a SentencePiece model")
    return os.path.join(os.path.dirname(found.origin), "piece_bpe_32k.model")


@dataclass
class Vocabulary:
    """Pieces of a BPE model as byte strings, space for the word mark."""

    raw: list[bytes]  # bytes of every token; empty for control tokens
    score: dict[str, tuple[float, int]]  # normal pieces
    ids: np.ndarray  # ids of normal pieces in byte order
    first_byte: int
    size: int

    @classmethod
    def load(cls, content: bytes) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        size = model.get_piece_size()
        raw, score, first_byte = [], {}, -1
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                first_byte = i if first_byte < 0 else first_byte
                raw.append(bytes([i - first_byte]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                raw.append(b"")
            else:
                plain = piece.replace(MARK, " ")
                if " " in plain.lstrip(" "):
                    raise ValueError("pieces with inner spaces are not supported")
                raw.append(plain.encode())
                score[plain] = (model.get_score(i), i)
        if first_byte < 0:
            raise ValueError("the model needs byte pieces")
        ids = np.array(sorted((i for _, i in score.values()), key=lambda i: raw[i]), np.int64)
        return cls(raw, score, ids, first_byte, size)

    def merged(self, body: str) -> list[str]:
        """Merge the best pair again and again, the leftmost among equals."""
        parts = list(body)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s[0] > best):
                    best, at = s[0], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their first ``depth`` bytes at least, and the first 8 bytes at each place."""
    n = len(data)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    head = np.zeros(n, np.uint64)
    for i in range(8):
        head = (head << np.uint64(8)) | padded[i : i + n]
    order = np.argsort(head, kind="stable")
    covered = 8
    rank = _ranks(head[order], order)
    while covered < depth and rank.max(initial=0) < n - 1:
        after = np.zeros(n, np.uint64)
        after[: max(0, n - covered)] = rank[covered:] + np.uint64(1)
        key = (rank << np.uint64(32)) | after
        order = np.argsort(key, kind="stable")
        rank = _ranks(key[order], order)
        covered *= 2
    return order, head


def _ranks(ordered: np.ndarray, order: np.ndarray) -> np.ndarray:
    step = np.zeros(len(order), np.uint64)
    step[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(len(order), np.uint64)
    rank[order] = np.cumsum(step)
    return rank


class Encoder:
    """Encodes slices of texts; keeps what it learnt about pairs and segments."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        self.length = np.array([len(r) for r in v.raw] + [0, 1, 2, 3, 4], np.int64)
        self.flat = np.frombuffer(b"".join(v.raw), np.uint8)
        self.at = np.cumsum(self.length[: v.size]) - self.length[: v.size]
        self.depth = int(self.length[v.ids].max(initial=1))
        width = -(-self.depth // 8) * 8
        table = np.zeros((len(v.ids), width), np.uint8)
        for k, i in enumerate(v.ids):
            table[k, : self.length[i]] = np.frombuffer(v.raw[i], np.uint8)
        self.keys = table.reshape(len(v.ids), -1, 8).astype(np.uint64) @ (
            np.uint64(256) ** np.arange(7, -1, -1, dtype=np.uint64)
        )
        self.whole = np.array([v.merged(v.raw[i].decode()) == [v.raw[i].decode()] for i in v.ids], bool)
        self.pairs = np.zeros(0, np.int64)
        self.allowed = np.zeros(0, bool)
        self.seen = np.zeros(0, np.uint64)
        self.seen_at = np.zeros(0, np.int64)
        self.seen_n = np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids, bounds of each text (n+1), and whether decoding gives the text back."""
        data, offsets, plain = _prefixed(data, offsets)
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64), np.ones(rows, bool)
        starts, ends, first = _segments(data, offsets)
        key, which, back = np.unique(tx.hashes(data, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.seen, key)
        place[place == len(self.seen)] = 0
        known = self.seen[place] == key if len(self.seen) else np.zeros(len(key), bool)
        count, at = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        count[known], at[known] = self.seen_n[place[known]], self.seen_at[place[known]]
        new = which[~known]
        tokens = self.tokens
        if len(new):
            fresh, n = self._indexed(data, starts[new], ends[new])
            count[~known], at[~known] = n, np.cumsum(n) - n + len(tokens)
            tokens = np.concatenate([tokens, fresh.astype(np.int32)])
            if len(self.seen) < REMEMBERED:
                self.tokens = tokens
                order = np.argsort(both := np.concatenate([self.seen, key[~known]]))
                self.seen = both[order]
                self.seen_at = np.concatenate([self.seen_at, at[~known]])[order]
                self.seen_n = np.concatenate([self.seen_n, count[~known]])[order]
        sizes = count[back]
        ids = tokens[tx.within(at[back], sizes)]
        total = np.concatenate(([0], np.cumsum(sizes)))
        bounds = total[first]
        return ids, bounds, plain & self._comes_back(ids, bounds, data, offsets)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a run of tokens, the dummy prefix included."""
        return self.flat[tx.within(self.at[ids], self.length[ids])]

    def _comes_back(self, ids, bounds, data, offsets) -> np.ndarray:
        out = self.decode(ids)
        size = np.concatenate(([0], np.cumsum(self.length[ids])))[bounds]
        if np.array_equal(out, data) and np.array_equal(size, offsets):
            return np.ones(len(bounds) - 1, bool)
        return np.array(
            [np.array_equal(out[a:b], data[c:d]) for a, b, c, d in zip(size, size[1:], offsets, offsets[1:])], bool
        )

    def _indexed(self, data, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of distinct segments, one after another, and their number for each."""
        lengths = ends - starts
        body = data[tx.within(starts, lengths)]
        bound = np.concatenate(([0], np.cumsum(lengths)))
        place, piece = self._edges(body)
        segment = np.searchsorted(bound, place, "right") - 1
        stop = place + self.length[piece]
        inside = stop <= bound[segment + 1]
        place, piece, stop, segment = place[inside], piece[inside], stop[inside], segment[inside]
        # Characters without a piece of their own.
        head = np.flatnonzero((body & 0xC0) != 0x80)
        size = np.diff(np.append(head, len(body)))
        single = np.zeros(len(body), bool)
        single[place[self.length[piece] == _char_length(body[place])]] = True
        lone = ~single[head]
        place = np.concatenate([place, head[lone]])
        piece = np.concatenate([piece, self.v.size + size[lone]])
        stop = np.concatenate([stop, head[lone] + size[lone]])
        segment = np.concatenate([segment, np.searchsorted(bound, head[lone], "right") - 1])
        last = self._relaxed(place, piece, stop, bound[segment], len(body))
        return self._path(last, bound, body)

    def _edges(self, body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (place, piece): each piece is a range of the suffix array."""
        order, head = suffix_array(body, self.depth)
        n = len(body)
        pieces, low = self.v.ids, np.zeros(len(self.v.ids), np.int64)
        size = self.length[pieces]

        def bound(upper: bool) -> np.ndarray:
            lo, hi = np.zeros(len(pieces), np.int64), np.full(len(pieces), n)
            while (live := lo < hi).any():
                mid = (lo + hi) // 2
                at = order[np.minimum(mid, n - 1)]
                less, equal = np.zeros(len(pieces), bool), np.ones(len(pieces), bool)
                for k in range(self.keys.shape[1]):
                    left = np.clip(size - 8 * k, 0, 8)
                    if not (equal & (left > 0)).any():
                        break
                    here = at + 8 * k
                    own = np.where(here < n, head[np.minimum(here, n - 1)], np.uint64(0))
                    cut = np.where(left >= 8, np.uint64(0), np.uint64(64) - np.uint64(8) * left.astype(np.uint64))
                    some = left > 0
                    cut = np.minimum(cut, np.uint64(63))
                    a, b = own >> cut, self.keys[:, k] >> cut
                    less |= equal & some & (a < b)
                    equal &= ~some | (a == b)
                right = less | equal if upper else less
                lo = np.where(live & right, mid + 1, lo)
                hi = np.where(live & ~right, mid, hi)
            return lo

        low, high = bound(False), bound(True)
        count = np.where(self.whole, high - low, 0)
        return order[tx.within(low, count)], np.repeat(pieces, count)

    def _relaxed(self, place, piece, stop, origin, n: int) -> np.ndarray:
        """The last token before each place, or -1. What ends before a segment's first place is the
        segment before it, so edges that begin there are told apart and never read it."""
        far = stop - origin
        order = np.argsort(far.astype(np.int32), kind="stable")
        place, piece, stop, begins = place[order], piece[order], stop[order], (place == origin)[order]
        cuts = np.flatnonzero(np.diff(far[order])) + 1
        last = np.full(n + 1, -1, np.int64)
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(place)], strict=True):
            p, q, s = place[a:b], piece[a:b], stop[a:b]
            before = last[p]
            start = begins[a:b]
            ok = start | (before >= 0)
            ask = np.flatnonzero(ok & ~start & (before < self.v.size) & (q < self.v.size))
            if len(ask):
                ok[ask] = self._compatible(before[ask] * self.v.size + q[ask])
            last[s[ok]] = q[ok]
        return last

    def _compatible(self, codes: np.ndarray) -> np.ndarray:
        unique, back = np.unique(codes, return_inverse=True)
        at = np.searchsorted(self.pairs, unique)
        at[at == len(self.pairs)] = 0
        missing = self.pairs[at] != unique if len(self.pairs) else np.ones(len(unique), bool)
        if missing.any():
            raw, size = self.v.raw, self.v.size
            new = unique[missing]
            said = []
            for code in new.tolist():
                a, b = raw[code // size].decode(), raw[code % size].decode()
                said.append(self.v.merged(a + b) == [a, b])
            order = np.argsort(both := np.concatenate([self.pairs, new]))
            self.pairs, self.allowed = both[order], np.concatenate([self.allowed, said])[order]
            at = np.searchsorted(self.pairs, unique)
        return self.allowed[at][back]

    def _path(self, last, bound, body) -> tuple[np.ndarray, np.ndarray]:
        """Tokens from the ends of the segments back to their starts, then in order; bytes spelt out."""
        n = len(bound) - 1
        cur, live = bound[1:].copy(), np.arange(n)
        steps = []
        while len(live):
            token = last[cur[live]]
            if (token < 0).any():
                raise RuntimeError("a segment has no encoding")
            steps.append((live, token, cur[live] - self.length[token]))
            cur[live] -= self.length[token]
            live = live[cur[live] > bound[live]]
        segment = np.concatenate([s for s, _, _ in steps])
        token = np.concatenate([t for _, t, _ in steps])
        place = np.concatenate([p for _, _, p in steps])
        order = np.argsort(place, kind="stable")
        segment, token, place = segment[order], token[order], place[order]
        width = np.where(token >= self.v.size, token - self.v.size, 1)
        out = np.repeat(token, width)
        spelt = out >= self.v.size
        out[spelt] = self.v.first_byte + body[tx.within(place, width)[spelt]]
        return out, np.bincount(segment, weights=width, minlength=n).astype(np.int64)


def _char_length(lead: np.ndarray) -> np.ndarray:
    return 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)


def _prefixed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A space before each text that is not empty; word marks become spaces. plain: had no mark."""
    lengths = np.diff(offsets)
    plain = np.ones(len(lengths), bool)
    mark = MARK.encode()
    if len(data) > 2:
        hit = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2]))
        if len(hit):
            plain[np.searchsorted(offsets, hit, "right") - 1] = False
            keep = np.ones(len(data), bool)
            keep[hit + 1] = keep[hit + 2] = False
            data = data.copy()
            data[hit] = SPACE
            lengths = np.add.reduceat(np.append(keep, False), offsets[:-1]) * (lengths > 0)
            data = data[keep]
            offsets = np.concatenate(([0], np.cumsum(lengths)))
    some = lengths > 0
    data = np.insert(data, offsets[:-1][some], SPACE)
    return data, np.concatenate(([0], np.cumsum(lengths + some))), plain


def _segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of spaces with the characters behind them, and the first segment of each text."""
    space = data == SPACE
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    edge = offsets[:-1][np.diff(offsets) > 0]
    begin[edge] = True
    starts = np.flatnonzero(begin)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(content: bytes) -> Encoder:
    key = hash(content)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Vocabulary.load(content))
    return _ENCODERS[key]


def encode(docs: DataFrame, model: str | None = None, text: str = "text") -> DataFrame:
    """All rows with ids (token ids) and round_trip (decoding gives the text back).

    The model file (half a megabyte) is read by the driver and travels with the
    task; its path is a parameter.
    """
    with open(model or default_model(), "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    kept = [c for c in docs.columns if c not in ("ids", "round_trip")]
    place = kept.index(text)
    schema = docs.select(*kept).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        for batch in batches:
            for a, b, data, offsets in tx.slices(batch.column(place), SLICE):
                ids, bounds, back = encoder.encode(data, offsets)
                columns = [c.slice(a, b - a) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(
                    [*columns, tx.lists(ids, bounds, pa.int32()), pa.array(back)], names=[*kept, "ids", "round_trip"]
                )

    out = schema.add("ids", ArrayType(IntegerType())).add("round_trip", "boolean")
    return docs.select(*kept).mapInArrow(run, out)


def decode(encoded: DataFrame, model: str | None = None, ids: str = "ids") -> DataFrame:
    """All rows with decoded: the text of the ids; null ids give an empty text."""
    with open(model or default_model(), "rb") as file:
        content = encoded.sparkSession.sparkContext.broadcast(file.read())
    kept = [c for c in encoded.columns if c != "decoded"]
    place = kept.index(ids)
    out = encoded.select(*kept).schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        for batch in batches:
            texts = []
            for row in batch.column(place).to_pylist():
                raw = encoder.decode(np.array(row or [], np.int64)).tobytes()
                texts.append(raw[1:].decode(errors="replace") if raw[:1] == b" " else raw.decode(errors="replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, "decoded"])

    return encoded.select(*kept).mapInArrow(run, out)


def digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, number of tokens, a hash of the ids, and round_trip."""
    encoded = encode(docs.select("doc_id", "text"), model)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        "round_trip",
    )
