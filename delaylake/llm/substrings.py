"""Removal of byte strings that occur more than once, by hash-compared suffix sorting.

Every window of ``length`` bytes has one anchor: the leftmost of its ``GRAM``-byte
strings with the least hash. Equal windows have equal anchors at equal places, so
only suffixes behind equal anchors can meet. One row per anchor (about one in
150 bytes) states which consecutive windows it serves; anchors whose string
occurs once leave first.

The windows of an anchor are dealt to fixed ranges of distance to it. All windows
of a range share a core of bytes; rows with equal cores form a group. Equal
fragments (all bytes of a row's windows) are removed whole. Where a group has
several fragments, its suffixes are sorted: a merge sort whose comparisons find
the common extension by binary search over prefix polynomial hashes, so each
costs the logarithm of the length; neighbours with a common extension of
``length`` bytes are repeats, and the outermost ones of each fragment are
compared byte by byte. Groups with more than ``GROUP`` fragments are dealt to
half the range, down to single windows, where equal cores alone decide; so no
task gets an unbounded group.

Defined results: null text is empty; texts shorter than ``length`` keep all;
repeated rows (same doc_id and text) are copies of each other and vanish
entirely if long enough; null doc_ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm import text as tx
from delaylake.llm.store import stored

LENGTH = 400
GRAM = 100
GROUP = 3000
BATCH_SUFFIXES = 300_000
BLOCK = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 2**64))
_LOW = np.uint64((1 << 24) - 1)
_INV = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _INV
    if len(_INV) < n:
        factors = np.full(n, _INVERSE)
        factors[0] = 1
        _INV = np.cumprod(factors, dtype=np.uint64)
    return _INV[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums of byte * base^place before each place, modulo 2^64; words come as their hashes."""
    out = np.zeros(len(data) + 1, np.uint64)
    values = tx._BYTE[data] if data.dtype == np.uint8 else data
    np.cumsum(values * tx.powers(len(data)), out=out[1:])
    return out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor, hash) of a slice of texts; places in the slice."""
    n, w = len(data), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.view(np.uint64)
    sums = prefix_hashes(data)
    m = n - gram + 1
    h = tx.mix((sums[gram:] - sums[:m]) * _inverse_powers(n)[:m])
    packed = (h & ~_LOW) | np.arange(m, dtype=np.uint64)
    rows = -(-m // w)
    grid = np.full(rows * w, np.uint64(2**64 - 1))
    grid[:m] = packed
    grid = grid.reshape(rows, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    best = (np.minimum(behind[:windows], ahead[w - 1 : w - 1 + windows]) & _LOW).astype(np.int64)
    change = np.zeros(n + 1, np.int64)
    long = np.diff(offsets) >= length
    change[offsets[:-1][long]] += 1
    change[offsets[1:][long] - length + 1] -= 1
    at = np.flatnonzero(np.cumsum(change)[:windows] > 0)
    if not len(at):
        return none, none, none, none.view(np.uint64)
    own = best[at]
    cut = np.flatnonzero((np.diff(own) != 0) | (np.diff(at) != 1)) + 1
    first = at[np.concatenate(([0], cut))]
    last = at[np.concatenate((cut - 1, [len(at) - 1]))]
    place = own[np.concatenate(([0], cut))]
    return first, last, place, h[place]


def blocks(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, bytes before, data, offsets): a text over one block goes in overlapping parts."""
    if len(data) <= 2 * BLOCK:
        yield 0, 0, data, offsets
        return
    for row in range(len(offsets) - 1):
        a, b = int(offsets[row]), int(offsets[row + 1])
        for at in range(a, max(a + 1, b - length + 1), BLOCK):
            part = data[at : min(b, at + BLOCK + length - 1)]
            yield row, at - a, part, np.array([0, len(part)])


ANCHOR = "doc_id long, th long, a int, m int, off int, key long"


def anchor_rows(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per anchor: first window ``a``, ``m`` further windows, distance of the anchor, its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ths = batch.column(0), batch.column(1)
            for i, _, data, offsets in tx.slices(batch.column(2), BLOCK):
                for row, before, part, cuts in blocks(data, offsets, length):
                    first, last, place, h = anchors(part, cuts, length, gram)
                    text_of = np.searchsorted(cuts, first, "right") - 1
                    take = pa.array(i + row + text_of)
                    a = first - cuts[text_of] + before
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(take),
                            ths.take(take),
                            pa.array(a.astype(np.int32)),
                            pa.array((last - first).astype(np.int32)),
                            pa.array((place - first).astype(np.int32)),
                            pa.array(h.view(np.int64)),
                        ],
                        names=[x.split()[0] for x in ANCHOR.split(", ")],
                    )

    return texts.select("doc_id", "th", "text").mapInArrow(run, ANCHOR)


PART = "doc_id long, th long, a int, m int, off int, x int, y int, core long, d1 long, d2 long"


def _part_rows(held: DataFrame, length: int) -> DataFrame:
    """Core and fragment digests of every (a, m, off, x, y) of the texts: windows at distances x to y."""
    names = [c.split()[0] for c in PART.split(", ")]
    types = [{"int": pa.int32(), "long": pa.int64()}[c.split()[1]] for c in PART.split(", ")]
    schema = pa.schema(list(zip(names, types, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, th, text, parts in zip(*(batch.column(i) for i in range(4)), strict=True):
                raw = text.as_py().encode()
                for p in parts.as_py():
                    a, m, off, x, y = p["a"], p["m"], p["off"], p["x"], p["y"]
                    place = a + off
                    core = raw[place - x : place - y + length]
                    digest = xxhash.xxh3_128_intdigest(raw[a : a + m + length])
                    low, high = digest & (2**64 - 1), digest >> 64
                    row = (doc_id.as_py(), th.as_py(), a, m, off, x, y, xxhash.xxh64_intdigest(core, x), low, high)
                    for c, v in zip(out, row, strict=True):
                        c.append(v)
                if len(out[0]) > 20_000:
                    yield _batch(out, schema)
                    out = [[] for _ in names]
            yield _batch(out, schema)

    return held.select("doc_id", "th", "text", "parts").mapInArrow(run, PART)


def _batch(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [
        pa.array(np.array(c, np.uint64).view(np.int64)) if f.name in ("core", "d1", "d2") else pa.array(c, f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _ranged(rows: DataFrame, ranges: list[tuple[int, int]]) -> DataFrame:
    """The windows of each row (a, m, off) cut to distance ranges x..y; distances are off down to off-m."""
    parts = []
    for x, y in ranges:
        first = F.greatest(F.col("a"), F.col("a") + F.col("off") - y)
        last = F.least(F.col("a") + F.col("m"), F.col("a") + F.col("off") - x)
        part = F.struct(
            first.cast("int").alias("a"),
            (last - first).cast("int").alias("m"),
            (F.col("a") + F.col("off") - first).cast("int").alias("off"),
            F.lit(x).alias("x"),
            F.lit(y).alias("y"),
        )
        parts.append(F.when(first <= last, part))
    return rows.select("doc_id", "th", F.explode(F.array_compact(F.array(*parts))).alias("p"))


def _halves(x: int, y: int) -> list[tuple[int, int]]:
    middle = (x + y) // 2
    return [(x, middle), (middle + 1, y)]


class SuffixSorter:
    """Sorts the suffixes of a text within classes; compares up to ``length`` bytes by hashes."""

    def __init__(self, data: np.ndarray, length: int):
        self.length = length
        self.sums = prefix_hashes(data)
        self.inverse = _inverse_powers(len(data) + 1)
        self.data = data

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common bytes of the suffixes at i and j, at most ``length``: a binary search for all pairs."""
        low, high = np.zeros(len(i), np.int64), np.full(len(i), self.length)
        fi, fj = self.inverse[i], self.inverse[j]
        si, sj = self.sums[i], self.sums[j]
        step = high
        while (low < high).any():
            step = (low + high + 1) // 2
            same = (self.sums[i + step] - si) * fi == (self.sums[j + step] - sj) * fj
            low = np.where(same, step, low)
            high = np.where(same, high, step - 1)
        return low

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n = self.extension(i, j)
        inside = n < self.length
        last = len(self.data) - 1
        return inside & (self.data[np.minimum(i + n, last)] < self.data[np.minimum(j + n, last)])

    def sort(self, suffix: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The order of suffixes within their class: ``begin`` and ``size`` of the class of each.

        A bottom-up merge sort of all classes at once. An element's place in the
        merged run is its place in its own run plus its rank in the other one.
        """
        order = np.arange(len(suffix))
        width = 1
        most = int(size.max(initial=0))
        while width < most:
            live = np.flatnonzero(size > width)
            b, s = begin[live], size[live]
            at = live - b
            own = at // width
            other = own ^ 1
            low = b + np.minimum(other * width, s)
            stop = b + np.minimum((other + 1) * width, s)
            start = low.copy()
            mine = suffix[order[live]]
            right = (own & 1) == 1
            while (open_ := low < stop).any():
                pick = np.flatnonzero(open_)
                mid = (low[pick] + stop[pick]) // 2
                theirs = suffix[order[mid]]
                # Left elements go before equal right ones.
                swap = right[pick]
                first = np.where(swap, mine[pick], theirs)
                second = np.where(swap, theirs, mine[pick])
                said = self.less(first, second)
                before = np.where(swap, ~said, said)
                low[pick] = np.where(before, mid + 1, low[pick])
                stop[pick] = np.where(before, stop[pick], mid)
            place = b + (own // 2) * 2 * width + (at - own * width) + (low - start)
            moved = order.copy()
            moved[place] = order[live]
            order = moved
            width *= 2
        return order


def repeated_windows(
    group: np.ndarray, far: np.ndarray, m: np.ndarray, bodies: list[bytes], length: int
) -> tuple[np.ndarray, np.ndarray]:
    """First and last repeated window of each fragment, -1 if none.

    ``group`` tells groups apart, ``far`` is the distance of a fragment's first
    window to the anchor: windows meet in a class of equal group and distance.
    """
    data = np.frombuffer(b"".join(bodies), np.uint8)
    base = np.cumsum([0, *map(len, bodies)])[:-1]
    count = m + 1
    fragment = np.repeat(np.arange(len(m)), count)
    index = tx.within(np.zeros(len(m), np.int64), count)
    distance = far[fragment] - index
    by = np.lexsort((distance, group[fragment]))
    g, d = group[fragment][by], distance[by]
    cut = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (d[1:] != d[:-1]))))
    size = np.diff(np.append(cut, len(by)))
    begin, size = np.repeat(cut, size), np.repeat(size, size)
    many = size > 1
    by = by[many]
    low, high = np.full(len(m), -1), np.full(len(m), -1)
    if not len(by):
        return low, high
    size = size[many]
    begin = np.repeat(
        np.flatnonzero(np.concatenate(([True], begin[many][1:] != begin[many][:-1]))),
        size[np.concatenate(([True], begin[many][1:] != begin[many][:-1]))],
    )
    suffix = base[fragment[by]] + index[by]
    sorter = SuffixSorter(data, length)
    order = sorter.sort(suffix, begin, size)
    a, b = order[:-1], order[1:]
    next_to = np.flatnonzero(begin[:-1] == begin[1:])
    same = next_to[sorter.extension(suffix[a[next_to]], suffix[b[next_to]]) >= length]
    partner = np.full(len(by), -1)
    partner[a[same]] = b[same]
    partner[b[same]] = a[same]
    hit = np.flatnonzero(partner >= 0)
    own = fragment[by[hit]]
    place = index[by[hit]]
    if len(hit):
        sort = np.lexsort((place, own))
        first = np.flatnonzero(np.concatenate(([True], own[sort][1:] != own[sort][:-1])))
        last = np.append(first[1:], len(sort)) - 1
        for at, out in ((sort[first], low), (sort[last], high)):
            x, y = suffix[hit[at]], suffix[partner[hit[at]]]
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                if data[i : i + length].tobytes() != data[j : j + length].tobytes():
                    raise RuntimeError("two different windows have equal hashes")
            out[own[at]] = place[at]
    return low, high


FRAGMENT = "core long, doc_id long, th long, a int, m int, off int, n long, body binary"
SPAN = "doc_id long, th long, start int, stop int"


def _fragment_rows(held: DataFrame, length: int) -> DataFrame:
    names = [c.split()[0] for c in FRAGMENT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("core", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64())]
            + [(c, pa.int32()) for c in ("a", "m", "off")]
            + [("n", pa.int64()), ("body", pa.binary())]
        )
        for batch in batches:
            out, size = [], 0
            for doc_id, th, text, parts in zip(*(batch.column(i) for i in range(4)), strict=True):
                raw = text.as_py().encode()
                for p in parts.as_py():
                    body = raw[p["a"] : p["a"] + p["m"] + length]
                    size += len(body)
                    out.append({k: p[k] for k in ("core", "a", "m", "off", "n")} | {"doc_id": doc_id.as_py(), "th": th.as_py(), "body": body})
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return held.select("doc_id", "th", "text", "parts").mapInArrow(run, FRAGMENT).select(*names)


def _sorted_spans(fragments: DataFrame, length: int) -> DataFrame:
    """Spans of the fragments that occur once (n = 1) but share windows with others of their group."""

    def flush(held: dict[str, list]) -> pa.RecordBatch:
        ids = np.array(held["core"], np.int64)
        m, off = np.array(held["m"], np.int64), np.array(held["off"], np.int64)
        low, high = repeated_windows(ids, off, m, held["body"], length)
        take = np.flatnonzero((low >= 0) & (np.array(held["n"]) == 1))
        a = np.array(held["a"], np.int64)[take]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([held["doc_id"][i] for i in take], pa.int64()),
                pa.array([held["th"][i] for i in take], pa.int64()),
                pa.array((a + low[take]).astype(np.int32)),
                pa.array((a + high[take] + length).astype(np.int32)),
            ],
            names=[x.split()[0] for x in SPAN.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FRAGMENT.split(", ")]
        held: dict[str, list] = {c: [] for c in names}
        suffixes = 0
        for batch in batches:
            rows = {c: batch.column(i).to_pylist() for i, c in enumerate(names)}
            for i, core in enumerate(rows["core"]):
                if suffixes >= BATCH_SUFFIXES and core != held["core"][-1]:
                    yield flush(held)
                    held, suffixes = {c: [] for c in names}, 0
                for c in names:
                    held[c].append(rows[c][i])
                suffixes += rows["m"][i] + 1
        if held["core"]:
            yield flush(held)

    return fragments.repartition("core").sortWithinPartitions("core").mapInArrow(run, SPAN)


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(spans, held): byte spans (start, stop) of repeats, and the texts that may have some.

    ``texts`` has doc_id, th (hash of the text) and text, one row per pair of the first two.
    """
    marks = stored(anchor_rows(texts, length, gram))
    place = F.xxhash64("doc_id", "th", F.col("a") + F.col("off"))
    keys = marks.groupBy("key").agg(F.min(place).alias("p"), F.max(place).alias("q")).where("p <> q").select("key")
    # Written, so both sides of the join are plain exchanges and a frequent key can be split.
    met = marks.join(stored(keys), "key")
    lists = met.groupBy("doc_id", "th").agg(F.collect_list(F.struct("a", "m", "off")).alias("marks"))
    held = stored(
        texts.alias("t")
        .join(lists.alias("l"), F.expr("t.doc_id <=> l.doc_id and t.th = l.th"))
        .select("t.doc_id", "t.th", "t.text", "l.marks")
    )
    span = length - gram
    rows = held.select("doc_id", "th", F.inline("marks"))
    spans: list[DataFrame] = []
    ranges = _halves(0, span)
    while True:
        cut = _ranged(rows, ranges).groupBy("doc_id", "th").agg(F.collect_list("p").alias("parts"))
        parts = stored(_part_rows(_with_text(held, cut), length))
        one = ["core", "x", "y", "m", "off", "d1", "d2"]
        kinds = stored(
            parts.groupBy(*one).agg(
                F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "th", "a")).alias("first")
            )
        )
        copies = parts.join(kinds.where("n > 1").select(*one), one)
        spans.append(copies.select("doc_id", "th", F.col("a").alias("start"), (F.col("a") + F.col("m") + length).alias("stop")))
        single = all(x == y for x, y in ranges)
        if single:
            break
        many = stored(
            kinds.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1").select("core", "kinds")
        )
        mixed = kinds.join(many, "core")
        sorted_ = mixed.where(F.col("kinds") <= group).groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.th").alias("th")).agg(
            F.collect_list(F.struct("core", F.col("first.a").alias("a"), "m", "off", "n")).alias("parts")
        )
        spans.append(stored(_sorted_spans(_fragment_rows(_with_text(held, sorted_), length), length)))
        large = many.where(F.col("kinds") > group).select("core")
        if large.isEmpty():
            break
        # A fragment that occurs more than once is settled; it is dealt on as a partner of others.
        rows = stored(parts.join(large, "core").select("doc_id", "th", "a", "m", "off"))
        ranges = [r for x, y in ranges for r in (_halves(x, y) if x < y else [(x, y)])]
    out = spans[0].select("doc_id", "th", "start", "stop")
    for more in spans[1:]:
        out = out.unionByName(more)
    return out, held


def _with_text(held: DataFrame, lists: DataFrame) -> DataFrame:
    return (
        held.alias("h")
        .join(lists.alias("l"), F.expr("h.doc_id <=> l.doc_id and h.th = l.th"))
        .select("h.doc_id", "h.th", "h.text", "l.parts")
    )


RESULT = "doc_id long, th long, n_removed long, n_spans long, kept_sha256 string, kept_text binary"


def _cut(held: DataFrame, keep_text: bool) -> DataFrame:
    """What is left of each text without its spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc_id", pa.int64()), ("th", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.binary())]
        )
        for batch in batches:
            out = []
            for doc_id, th, text, spans in zip(*(batch.column(i) for i in range(4)), strict=True):
                raw = text.as_py().encode()
                kept, at, runs, stop = [], 0, 0, -1
                for s in sorted((p["start"], p["stop"]) for p in spans.as_py()):
                    if s[0] > stop:
                        runs += 1
                        kept.append(raw[at : s[0]])
                    at = stop = max(stop, s[1])
                kept.append(raw[at:])
                left = b"".join(kept)
                out.append(
                    {
                        "doc_id": doc_id.as_py(),
                        "th": th.as_py(),
                        "n_removed": len(raw) - len(left),
                        "n_spans": runs,
                        "kept_sha256": hashlib.sha256(left).hexdigest(),
                        "kept_text": left.decode(errors="ignore").encode() if keep_text else None,
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return held.select("doc_id", "th", "text", "spans").mapInArrow(run, RESULT)


def keyed(docs: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("th"))


def removed(base: DataFrame, length: int, keep_text: bool) -> DataFrame:
    """n_removed, n_spans, kept_sha256 and kept_text of the keyed texts that have repeats, per row."""
    spans, held = repeated_spans(base, length)
    lists = spans.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = (
        held.alias("h")
        .join(lists.alias("l"), F.expr("h.doc_id <=> l.doc_id and h.th = l.th"))
        .select("h.doc_id", "h.th", "h.text", "l.spans")
    )
    return _cut(joined, keep_text)


def deduplicated(docs: DataFrame, length: int = LENGTH, shared: DataFrame | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    ``shared`` (th, sha, n_passage_words; see ``passages``) adds n_passage_words, which removes nothing.
    """
    base = keyed(docs)
    # Repeated rows bring equal results.
    cut = removed(base, length, keep_text=False).drop("kept_text").distinct()
    rows = base.select(
        "doc_id", "th", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")
    )
    times = rows.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("times"))
    known = times.alias("t").join(cut.alias("c"), F.expr("t.doc_id <=> c.doc_id and t.th = c.th"), "left").select(
        "t.*", "c.n_removed", "c.n_spans", "c.kept_sha256"
    )
    gone = (F.col("k.times") > 1) & (F.col("r.n_bytes") >= length)
    joined = rows.alias("r").join(known.alias("k"), F.expr("r.doc_id <=> k.doc_id and r.th = k.th"))
    more = []
    if shared is not None:
        joined = joined.join(shared.alias("s"), F.expr("r.th = s.th and r.sha = s.sha"), "left")
        more = [F.coalesce("s.n_passage_words", F.lit(0).cast("long")).alias("n_passage_words")]
    return joined.select(
        "r.doc_id",
        "r.n_bytes",
        F.when(gone, F.col("r.n_bytes")).otherwise(F.coalesce("k.n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("k.n_spans", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("k.kept_sha256", "r.sha")).alias("kept_sha256"),
        *more,
    )


def clean(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of ``docs`` without their repeated strings; n_chars, where there is one, follows the text.

    Bytes of a character that was cut in two go as well.
    """
    base = keyed(docs)
    copies = base.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("size"))
    # Of repeated rows everything goes; no other row comes twice below.
    copies = stored(copies.where((F.col("n") > 1) & (F.col("size") >= length)).select("doc_id", "th"))
    cut = removed(base, length, keep_text=True).select("doc_id", "th", F.col("kept_text").alias("left")).alias("c")
    cut = cut.join(copies.alias("k"), F.expr("c.doc_id <=> k.doc_id and c.th = k.th"), "left_anti")
    changed = stored(cut.unionByName(copies.withColumn("left", F.lit("").cast("binary"))))
    body = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(F.struct("*").alias("doc"), body.alias("th")).alias("d")
    on = F.expr("cast(d.doc.doc_id as long) <=> c.doc_id and d.th = c.th")
    text = F.when(F.col("c.left").isNotNull(), F.decode(F.col("c.left"), "utf-8")).otherwise(F.col("d.doc.text"))
    out = []
    for c in docs.columns:
        kept = F.col(f"d.doc.`{c}`")
        if c == "text":
            kept = text
        elif c == "n_chars":
            kept = F.when(F.col("c.left").isNotNull(), F.char_length(text)).otherwise(kept).cast(dict(docs.dtypes)[c])
        out.append(kept.alias(c))
    return rows.join(changed.alias("c"), on, "left").select(*out)
