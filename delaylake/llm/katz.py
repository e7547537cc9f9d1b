"""Katz backoff language model over words, Good-Turing discounts, exactly normalised.

Two exchanges of packed tables, and no row per token in either. A map task turns
some million tokens into distinct (word, history) pairs with the documents they
stand in, and sends each bucket of words one table. A bucket then holds all
there is about its words, and sends the counts of word and pair of each token
back to its document: they give the base score and, for seen pairs, the model's
terms. Logarithms split, so the count of the history is subtracted where the
history itself is a word. Only unseen pairs of held-out texts need the history's
backoff weight: they go to the bucket of their history in the second exchange,
together with the sums over its followers from which the weight is normalised
exactly.

    P(w|h) = r d(r) / c(h)          for pairs seen r times
           = alpha(h) P(w)          for others
    P(w)   = c d(c) / N             for known words, the rest of the mass for unknown ones

Counts up to ``K`` are discounted by Good-Turing in Katz's form; larger ones
keep all but ``KEPT_BACK``, so every history has mass left. Discounts depend on
counts of counts over all buckets; until those are known, tables carry numbers
of pairs by count instead of probabilities.

Words are told apart by 56-bit hashes. Words with more than 1/``HOT`` of all
tokens (at most ``HOT`` of them) are counted first and dealt by pair, so a word
that makes up a third of a corpus does not end in one bucket.

Defined results: null and empty texts consist of the end token; documents with
null ids are held out; repeated rows are rows; with no training texts every word
is unknown and every score follows from that; an empty table gives no rows.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylake.llm import text as tx
from delaylake.llm.store import stored

K = 5
KEPT_BACK = 0.1
HOT = 4000
FLUSH_TOKENS = 2_000_000
BUCKET_TOKENS = 1_000_000
END, START = np.uint64(1), np.uint64(2)
_MASK = np.uint64((1 << 56) - 1)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string, byte planes apart."""
    head = json.dumps([(a.dtype.str, len(a)) for a in arrays]).encode()
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"" for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<I", len(head)) + head + b"".join(planes))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    size = struct.unpack_from("<I", raw)[0]
    at, out = 4 + size, []
    for kind, n in json.loads(raw[4:at]):
        dtype = np.dtype(kind)
        planes = np.frombuffer(raw, np.uint8, n * dtype.itemsize, at).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).ravel())
        at += n * dtype.itemsize
    return out


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _sizes(cut: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(cut, n))


def _tokens(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple]:
    """(number, word hashes, document of each, doc_ids, train flags): whole documents, some million tokens."""
    held: list[tuple] = []
    size = number = 0

    def joined():
        words = np.concatenate([h[0] for h in held])
        counts = np.concatenate([h[1] for h in held])
        ids = pa.concat_arrays([h[2] for h in held])
        train = np.concatenate([h[3] for h in held])
        return number, words, np.repeat(np.arange(len(counts)), counts), ids, train

    for batch in batches:
        flags = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for a, b, data, offsets in tx.slices(batch.column(2)):
            low = tx.LOWER[data]
            starts, ends, first = tx.spans(low, offsets, tx.NOT_SPACE)
            own = (tx.hashes(low, starts, ends) & _MASK) | np.uint64(4)
            words = np.insert(own, first[1:], END)
            held.append((words, np.diff(first) + 1, batch.column(0).slice(a, b - a), flags[a:b]))
            size += len(words)
            if size >= most:
                yield joined()
                held, size, number = [], 0, number + 1
    if held:
        yield joined()


def _common(texts: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """All tokens; sorted hashes of the words with more than 1/HOT of them, and their training counts."""

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, _, _, _ in _tokens(batches, most):
            unique, count = np.unique(words, return_counts=True)
            often = 2 * HOT * count >= len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(unique[often].view(np.int64)), pa.array(count[often]), pa.array(np.full(often.sum(), 0))],
                names=["w", "n", "total"],
            )
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([len(words)])], names=["w", "n", "total"])

    counts = texts.mapInArrow(likely, "w long, n long, total long").groupBy("w").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    counts = stored(counts)
    total = counts.agg(F.sum("total")).first()[0] or 0
    rows = counts.where((F.col("w") != 0) & (F.col("n") * HOT >= total)).select("w").collect()
    hot = np.sort(np.array([r["w"] for r in rows], np.int64).view(np.uint64))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(hot), np.int64)
        for _, words, doc, _, train in _tokens(batches, most):
            words = words[train[doc]]
            at = np.minimum(np.searchsorted(hot, words), max(0, len(hot) - 1))
            if len(hot):
                sums += np.bincount(at[hot[at] == words], minlength=len(hot))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(hot))), pa.array(sums)], names=["i", "n"])

    count = np.zeros(len(hot), np.int64)
    for i, n in texts.mapInArrow(exact, "i long, n long").groupBy("i").agg(F.sum("n")).collect():
        count[i] = n
    return total, hot, count


ROW = "place long, flush long, blob binary"


def _sent(texts: DataFrame, hot: np.ndarray, buckets: int, most: int) -> DataFrame:
    """Packed tables of the distinct (word, history) pairs of some million tokens, one per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A partition of the input has the same documents whenever it is read again.
        part = TaskContext.get().partitionId()
        for number, w, doc, ids, train in _tokens(batches, most):
            flush = (part << 24) + number
            h = np.empty_like(w)
            h[1:], h[:1] = w[:-1], START
            h[1:][w[:-1] == END] = START
            to = w % np.uint64(buckets)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, w), len(hot) - 1)
                often = hot[at] == w
                to[often] = tx.mix(w[often] * np.uint64(31) + h[often]) % np.uint64(buckets)
            order = np.lexsort((h, w, to))
            w, h, doc, to = w[order], h[order], doc[order], to[order]
            bounds = np.searchsorted(to, np.arange(buckets + 1, dtype=np.uint64))
            bits = np.packbits(train)
            out = []
            for b in range(buckets):
                i, j = bounds[b], bounds[b + 1]
                if i == j:
                    continue
                pairs, words = _runs(w[i:j], h[i:j]), _runs(w[i:j])
                out.append(
                    (
                        b,
                        flush,
                        pack(
                            np.diff(w[i:j][words], prepend=np.uint64(0)),
                            _sizes(np.searchsorted(pairs, words), len(pairs)).astype(np.uint32),
                            h[i:j][pairs],
                            _sizes(pairs, j - i).astype(np.uint32),
                            doc[i:j].astype(np.uint32),
                            bits,
                            np.array([len(train)], np.uint32),
                        ),
                    )
                )
            known = np.array([x is not None for x in ids.to_pylist()])
            table = pack(ids.fill_null(0).to_numpy(), known, train, np.bincount(doc, minlength=len(train)).astype(np.int64))
            out.append((-1 - flush, flush, table))
            yield _rows(out)

    return texts.mapInArrow(run, ROW)


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    place, flush, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(place, pa.int64()), pa.array(flush, pa.int64()), pa.array(blob, pa.binary())],
        names=["place", "flush", "blob"],
    )


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Rows of one place after another, from a sorted partition."""
    now, held = None, []
    for batch in batches:
        for place, flush, blob in zip(*(batch.column(i) for i in range(3)), strict=True):
            if place.as_py() != now:
                if held:
                    yield now, held
                now, held = place.as_py(), []
            held.append((flush.as_py(), blob.as_py()))
    if held:
        yield now, held


def _by_place(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.repartition(buckets, "place").sortWithinPartitions("place", "flush")


#: Places of the second exchange: 0 for numbers of counts, odd ones for histories, negative ones for documents.
def _counted(rows: DataFrame, hot: np.ndarray, hot_count: np.ndarray, buckets: int) -> DataFrame:
    """From the tables of each bucket of words: terms of documents, followers of histories, unseen pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, tables in _grouped(batches):
            if place < 0:
                yield _rows([(place, flush, b"D" + blob) for flush, blob in tables])
            else:
                yield from _bucket(tables, hot, hot_count, buckets)

    return rows.mapInArrow(run, ROW)


def _bucket(tables, hot, hot_count, buckets) -> Iterator[pa.RecordBatch]:
    pw, ph, ps, pt, docs, sizes = [], [], [], [], [], []
    for _, blob in tables:
        dw, pairs, h, count, doc, bits, n = unpack(blob)
        train = np.unpackbits(bits, count=int(n[0])).astype(bool)
        start = np.cumsum(count.astype(np.int64)) - count
        pw.append(np.repeat(np.cumsum(dw, dtype=np.uint64), pairs))
        ph.append(h)
        ps.append(count.astype(np.int64))
        pt.append(np.add.reduceat(train[doc].astype(np.int64), start))
        docs.append(doc)
        sizes.append(len(h))
    w, h, n, t = (np.concatenate(x) for x in (pw, ph, ps, pt))
    order = np.lexsort((h, w))
    sw, sh, st = w[order], h[order], t[order]
    pairs, words = _runs(sw, sh), _runs(sw)
    pair_count = np.add.reduceat(st, pairs)
    word_count = np.add.reduceat(st, words)
    word = sw[words]
    cold = np.ones(len(word), bool)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, word), len(hot) - 1)
        cold = hot[at] != word
        word_count = np.where(cold, word_count, hot_count[at])
    r, c = np.empty(len(w), np.int64), np.empty(len(w), np.int64)
    r[order] = np.repeat(pair_count, _sizes(pairs, len(sw)))
    c[order] = np.repeat(word_count, _sizes(words, len(sw)))
    yield _rows([(0, 0, pack(_numbers(pair_count), _numbers(word_count[cold])))])
    # Followers of each history, by their counts.
    seen = np.flatnonzero(pair_count > 0)
    follower = _Followers(sh[pairs][seen], pair_count[seen], c[order][pairs][seen])
    for b, blob in follower.tables(buckets):
        yield _rows([(2 * b + 1, 0, b"F" + blob)])
    # Terms of the documents of each table.
    at = 0
    asked = []
    for (flush, _), doc, m in zip(tables, docs, sizes, strict=True):
        own = slice(at, at + m)
        at += m
        rr, cc, hh = (np.repeat(x[own], n[own]) for x in (r, c, h))
        by = np.argsort(doc, kind="stable")
        blob = pack(_narrow(np.diff(doc[by].astype(np.int64), prepend=0)), _narrow(cc[by]), _narrow(rr[by]))
        yield _rows([(-1 - flush, flush, b"T" + blob)])
        new = np.flatnonzero(rr == 0)
        if len(new):
            asked.append((hh[new], np.full(len(new), flush), doc[new], cc[new]))
    if asked:
        h, flush, doc, count = (np.concatenate(x) for x in zip(*asked, strict=True))
        to = h % np.uint64(buckets)
        order = np.lexsort((h, to))
        bounds = np.searchsorted(to[order], np.arange(buckets + 1, dtype=np.uint64))
        for b in range(buckets):
            part = order[bounds[b] : bounds[b + 1]]
            if len(part):
                blob = pack(np.diff(h[part], prepend=np.uint64(0)), flush[part], doc[part].astype(np.uint32), count[part])
                yield _rows([(2 * b + 1, 0, b"Q" + blob)])


def _numbers(count: np.ndarray) -> np.ndarray:
    """How many counts are 1 .. K+1, how many exceed K and their sum, and how many there are."""
    large = count > K
    few = [np.count_nonzero(count == i) for i in range(1, K + 2)]
    return np.array([*few, np.count_nonzero(large), count[large].sum(), np.count_nonzero(count)], np.int64)


class _Followers:
    """For each history: its count, and numbers and sums of its followers by pair count and word count."""

    def __init__(self, h: np.ndarray, r: np.ndarray, c: np.ndarray):
        order = np.argsort(h, kind="stable")
        h, r, c = h[order], r[order], c[order]
        cut = _runs(h)
        self.h = h[cut]
        columns = [r]
        for x in (r, c):
            large = x > K
            columns += [(x == i).astype(np.int64) for i in range(1, K + 1)]
            columns += [large.astype(np.int64), np.where(large, x, 0)]
        self.columns = [np.add.reduceat(x, cut) if len(cut) else x for x in columns]

    @classmethod
    def merged(cls, blobs: list[bytes]) -> _Followers:
        parts = [unpack(b) for b in blobs]
        out = cls.__new__(cls)
        h = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]) if parts else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        h = h[order]
        cut = _runs(h)
        out.h = h[cut]
        out.columns = [
            np.add.reduceat(np.concatenate([p[i] for p in parts]).astype(np.int64)[order], cut)
            for i in range(1, len(parts[0]))
        ] if parts else [np.zeros(0, np.int64)] * (5 + 2 * K)
        return out

    def tables(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        to = self.h % np.uint64(buckets)
        order = np.argsort(to, kind="stable")
        bounds = np.searchsorted(to[order], np.arange(buckets + 1, dtype=np.uint64))
        for b in range(buckets):
            part = order[bounds[b] : bounds[b + 1]]
            if len(part):
                yield b, pack(np.diff(self.h[part], prepend=np.uint64(0)), *(_narrow(x[part]) for x in self.columns))


def _narrow(x: np.ndarray) -> np.ndarray:
    for kind in (np.uint8, np.uint16, np.uint32):
        if not len(x) or int(x.max()) <= np.iinfo(kind).max:
            return x.astype(kind)
    return x


GATHERED = (
    "kind string, flush long, doc int, doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
    "sums double, few array<long>, numbers array<long>, blob binary"
)


def _gathered(rows: DataFrame) -> DataFrame:
    """Sums of each document; numbers of counts; histories of unseen pairs with what their weight needs."""
    names = [x.split()[0] for x in GATHERED.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64()}
    kinds |= {"array<long>": pa.list_(pa.int64()), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in GATHERED.split(", ")])

    def batch(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns.get(c, pa.nulls(n, schema.field(c).type)) for c in names], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, tables in _grouped(batches):
            if place == 0:
                numbers = sum(np.concatenate(unpack(b)) for _, b in tables)
                yield batch(1, kind=pa.array(["numbers"]), numbers=pa.array([numbers.tolist()], pa.list_(pa.int64())))
            elif place < 0:
                ids, known, train, tokens = next(unpack(b[1:]) for _, b in tables if b[:1] == b"D")
                n = len(ids)
                base, sums, seen, few = np.zeros(n), np.zeros(n), np.zeros(n, np.int64), np.zeros((n, K), np.int64)
                for step, c, r in (unpack(b[1:]) for _, b in tables if b[:1] == b"T"):
                    doc = np.cumsum(step, dtype=np.int64)
                    c, r = c.astype(np.int64), r.astype(np.int64)
                    base += np.bincount(doc, np.log10(c + 0.1), n)
                    seen += np.bincount(doc[c > 0], minlength=n)
                    # Each word is the history of the next token. The end token stands for the start
                    # of the text here: both occur once a document.
                    sums -= np.bincount(doc[c > 0], np.log10(c[c > 0]), n)
                    large = r > K
                    sums += np.bincount(doc[large], np.log10(r[large] - KEPT_BACK), n)
                    for i in range(1, K + 1):
                        few[:, i - 1] += np.bincount(doc[r == i], minlength=n)
                yield batch(
                    n,
                    kind=pa.array(["document"] * n),
                    flush=pa.array(np.full(n, -1 - place)),
                    doc=pa.array(np.arange(n, dtype=np.int32)),
                    doc_id=pa.array(ids, mask=~known),
                    held_out=pa.array(~train),
                    n_tokens=pa.array(tokens),
                    n_known=pa.array(seen),
                    base=pa.array(base),
                    sums=pa.array(sums),
                    few=tx.lists(few.ravel(), np.arange(n + 1) * K, pa.int64()),
                )
            else:
                asked = [unpack(b[1:]) for _, b in tables if b[:1] == b"Q"]
                if not asked:
                    continue
                h = np.concatenate([np.cumsum(q[0], dtype=np.uint64) for q in asked])
                flush, doc, count = (np.concatenate([q[i] for q in asked]) for i in (1, 2, 3))
                table = _Followers.merged([b[1:] for _, b in tables if b[:1] == b"F"])
                at = np.searchsorted(table.h, h)
                at[at == len(table.h)] = 0
                hit = table.h[at] == h if len(table.h) else np.zeros(len(h), bool)
                used, own = np.unique(at[hit], return_inverse=True)
                index = np.full(len(h), -1, np.int32)
                index[hit] = own
                blob = pack(index, flush, doc, count, *(x[used] for x in table.columns))
                yield batch(1, kind=pa.array(["unseen"]), blob=pa.array([blob], pa.binary()))

    return rows.mapInArrow(run, GATHERED)


def katz_counts(numbers: list[int]) -> np.ndarray:
    """r d(r) for r = 1..K from the numbers of counts 1..K+1; absolute discounts where Good-Turing fails."""
    n = [0, *numbers[: K + 1]]
    fallback = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    out = []
    rest = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        d = 0.0
        if n[r] and rest < 1:
            d = ((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest)
        out.append(r * d if 0 < d < 1 else r - min(fallback, 0.9))
    return np.array(out)


class Model:
    """Discounted counts, known once the numbers of counts are."""

    def __init__(self, pairs: list[int], words: list[int], tokens: int):
        self.pair, self.word = katz_counts(pairs), katz_counts(words)
        self.tokens, self.vocabulary = tokens, words[-1]
        known = float(self.word @ np.array(words[:K])) + words[K + 2] - KEPT_BACK * words[K + 1]
        self.unknown = 1 - known / tokens if tokens else 1.0

    def word_mass(self, few: list[np.ndarray], many: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Summed P(w) of numbers of words with counts 1..K, and of those above with their summed count."""
        if not self.tokens:
            return np.zeros(len(many))
        return (sum(x * v for x, v in zip(few, self.word, strict=True)) + total - KEPT_BACK * many) / self.tokens

    def log_word(self, count: np.ndarray) -> np.ndarray:
        value = np.where(count > K, count - KEPT_BACK, np.concatenate(([0.0], self.word))[np.minimum(count, K)])
        return np.log10(np.where(count > 0, value / max(1, self.tokens), self.unknown))

    def log_alpha(self, columns: list[np.ndarray]) -> np.ndarray:
        """log10 alpha(h) from what ``_Followers`` holds."""
        c = columns[0]
        few, many, total = columns[1 : K + 1], columns[K + 1], columns[K + 2]
        seen = (sum(x * v for x, v in zip(few, self.pair, strict=True)) + total - KEPT_BACK * many) / c
        lower = self.word_mass(columns[K + 3 : 2 * K + 3], columns[2 * K + 3], columns[2 * K + 4])
        return np.log10(np.maximum(1 - seen, 1e-12)) - np.log10(np.maximum(1 - lower, 1e-12))


def score(
    docs: DataFrame,
    train: Column,
    bucket_tokens: int = BUCKET_TOKENS,
    flush_tokens: int = FLUSH_TOKENS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    ``train`` tells the training texts. There are as many buckets as keep each
    near ``bucket_tokens`` tokens, which bounds the memory of a task.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(train, F.lit(False)).alias("train"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    total, hot, hot_count = _common(texts, flush_tokens)
    buckets = max(1, -(-total // bucket_tokens))
    sent = _by_place(_sent(texts, hot, buckets, flush_tokens), buckets)
    counted = _by_place(_counted(sent, hot, hot_count, buckets), buckets)
    found = stored(_gathered(counted))
    model = _model(found, hot_count)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                index, flush, doc, count, *columns = unpack(blob.as_py())
                value = model.log_word(count)
                if len(columns[0]):
                    # The count of a known history was taken off as if the pair had been seen.
                    more = model.log_alpha(columns) + np.log10(columns[0])
                    value += np.where(index >= 0, more[np.maximum(index, 0)], 0.0)
                key = np.lexsort((doc, flush))
                flush, doc, value = flush[key], doc[key], value[key]
                cut = _runs(flush, doc)
                flush, doc, value = flush[cut], doc[cut], np.add.reduceat(value, cut)
                cut = _runs(flush)
                ends = np.append(cut[1:], len(flush))
                yield _rows([(int(flush[a]), 0, pack(doc[a:b], value[a:b])) for a, b in zip(cut, ends)])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flush, tables in _grouped(batches):
            doc, value = (np.concatenate(x) for x in zip(*(unpack(b) for _, b in tables), strict=True))
            key, own = np.unique(doc, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(key), flush)),
                    pa.array(key.astype(np.int32)),
                    pa.array(np.bincount(own, value, len(key))),
                ],
                names=["flush", "doc", "more"],
            )

    parts = found.where("kind = 'unseen'").select("blob").mapInArrow(weighed, ROW)
    more = _by_place(parts, buckets).mapInArrow(summed, "flush long, doc int, more double")
    few = sum(F.get("few", F.lit(i)) * float(np.log10(v)) for i, v in enumerate(model.pair))
    scale = float(np.log10(model.tokens + 0.1 * (model.vocabulary + 1)))
    return (
        found.where("kind = 'document'")
        .join(more, ["flush", "doc"], "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(model.tokens).cast("long").alias("train_tokens"),
            (F.col("base") - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
            (F.col("sums") + few + F.coalesce("more", F.lit(0.0))).alias("score"),
        )
    )


def _model(found: DataFrame, hot_count: np.ndarray) -> Model:
    width = K + 4
    numbers = found.where("kind = 'numbers'").agg(*(F.sum(F.get("numbers", F.lit(i))) for i in range(2 * width))).first()
    values = np.array([x or 0 for x in numbers], np.int64)
    words = values[width:] + _numbers(hot_count)
    size = found.where("kind = 'document' and not held_out").agg(F.sum("n_tokens")).first()
    return Model(values[:width].tolist(), words.tolist(), size[0] or 0)


def training(doc_id: str = "doc_id") -> Column:
    """Documents whose CRC-32 of the id's digits leaves no remainder by ten are held out."""
    return F.crc32(F.col(doc_id).cast("string")) % 10 != 0
