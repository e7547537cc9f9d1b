"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are distinct before anything is paired. If two differ in at most
``budget`` bits, one of budget+1 equal blocks of bits agrees, so fingerprints are
dealt by (block, value); each group is then a binary trie below that block.
Pairs of nodes go down together: the errors of a pair of nodes are the bits
their paths differ in, and a pair over the budget is dropped with all below it.
The pairs of a level are numpy arrays, and deep levels go in portions, so
memory is bounded. Links join fingerprints, not documents, so copies cost
nothing; classes come from alternating stars, with a written table each round.

Defined results: texts without words have fingerprint zero and link like any
other; fewer words than a shingle has make one shingle; null text counts as
empty; null doc_ids never name a class unless all its ids are null; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm import text as tx
from delaylake.llm.store import stored

BITS = 64
SEED = 42
FRONTIER = 1 << 18
BUFFER = 1 << 16


def shingles(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the shingles of a slice, text by text, and their number in each text."""
    low = tx.LOWER[data]
    starts, ends, first = tx.spans(low, offsets, tx.NOT_SPACE)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    lengths = ends - starts
    at = tx.within(starts, lengths + 1)
    joined = low[np.minimum(at, len(low) - 1)]
    end = np.cumsum(lengths + 1) - 1
    joined[end] = 32
    begin = end - lengths
    words = np.diff(first)
    count = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    head = tx.within(first[:-1], count)
    span = np.repeat(np.minimum(words, shingle), count)
    raw = joined.tobytes()
    take = xxhash.xxh64_intdigest
    h = np.fromiter(
        (take(raw[a:b], SEED) for a, b in zip(begin[head].tolist(), end[head + span - 1].tolist(), strict=True)),
        np.uint64,
        len(head),
    )
    return h, count


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text in order of their hashes, and their number."""
    h, count = shingles(data, offsets, shingle)
    owner = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.bincount(owner[new], minlength=len(count))


def fingerprint_slice(data: np.ndarray, offsets: np.ndarray, shingle: int) -> np.ndarray:
    """Fingerprints of each text of a slice, from all its shingles."""
    return _majority(*shingles(data, offsets, shingle), 1)


def _majority(h: np.ndarray, count: np.ndarray, words64: int) -> np.ndarray:
    """A column of 64 bits for each of ``words64`` hash functions; further ones are bijections of the first."""
    rows = len(count)
    if not len(h):
        return np.zeros((rows, words64), np.uint64)
    owner = np.repeat(np.arange(rows), count)
    out = np.empty((rows, words64), np.uint64)
    for k in range(words64):
        own = tx.mix(h + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)) if k else h
        ones = np.zeros((rows, BITS), np.int64)
        for i in range(0, len(h), 1 << 17):
            part, who = own[i : i + (1 << 17)], owner[i : i + (1 << 17)]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            cut = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
            ones[who[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
        over = (2 * ones > count[:, None]).astype(np.uint8)
        out[:, k] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and fp (a long with the 64 bits)."""
    types = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [fingerprint_slice(d, o, shingle)[:, 0] for _, _, d, o in tx.slices(batch.column(len(keep)))]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fp.view(np.int64))], names=[*keep, "fp"])

    schema = ", ".join(f"`{c}` {types[c]}" for c in keep) + ", fp long"
    return docs.select(*keep, text).mapInArrow(run, schema)


def trie_pairs(values: np.ndarray, budget: int, fixed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct 64-bit values that differ in at most ``budget`` bits, none of
    them among the first ``fixed``; in portions."""
    n = len(values)
    stack = list(_roots(values, fixed)) if n > 1 else []
    while stack:
        depth, a, b, errors = stack.pop()
        if len(a[0]) > FRONTIER:
            half = len(a[0]) // 2
            for cut in (slice(None, half), slice(half, None)):
                stack.append((depth, (a[0][cut], a[1][cut]), (b[0][cut], b[1][cut]), errors[cut]))
            continue
        small = (a[1] - a[0]) * (b[1] - b[0]) <= 16
        if depth >= BITS:
            small[:] = True
        if small.any():
            yield _met(values, (a[0][small], a[1][small]), (b[0][small], b[1][small]), budget)
            a, b, errors = (a[0][~small], a[1][~small]), (b[0][~small], b[1][~small]), errors[~small]
        if not len(errors):
            continue
        a_mid, b_mid = _middle(values, a, depth), _middle(values, b, depth)
        same = a[0] == b[0]
        parts = [
            ((a[0], a_mid), (b[0], b_mid), errors, None),
            ((a_mid, a[1]), (b_mid, b[1]), errors, None),
            ((a[0], a_mid), (b_mid, b[1]), errors + 1, None),
            ((a_mid, a[1]), (b[0], b_mid), errors + 1, ~same),
        ]
        lows, highs, lows2, highs2, total = [], [], [], [], []
        for (al, ah), (bl, bh), e, extra in parts:
            ok = (ah > al) & (bh > bl) & (e <= budget)
            if extra is not None:
                ok &= extra
            lone = ok & (al == bl) & (ah - al == 1)
            ok &= ~lone
            lows.append(al[ok]), highs.append(ah[ok]), lows2.append(bl[ok]), highs2.append(bh[ok]), total.append(e[ok])
        if sum(map(len, total)):
            cat = np.concatenate
            stack.append((depth + 1, (cat(lows), cat(highs)), (cat(lows2), cat(highs2)), cat(total)))


def _roots(values: np.ndarray, fixed: int):
    """One node for each value of the first ``fixed`` bits, paired with itself."""
    top = values >> np.uint64(BITS - fixed) if fixed else np.zeros(len(values), np.uint64)
    low = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1])))
    high = np.append(low[1:], len(values))
    many = high - low > 1
    low, high = low[many], high[many]
    if len(low):
        yield fixed, (low, high), (low, high), np.zeros(len(low), np.int64)


def _middle(values: np.ndarray, node: tuple[np.ndarray, np.ndarray], depth: int) -> np.ndarray:
    """Where the bit at ``depth`` turns to one inside each node: a binary search for all at once."""
    low, high = node[0].copy(), node[1].copy()
    bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        one = (values[np.minimum(mid, len(values) - 1)] & bit) != 0
        high = np.where(open_ & one, mid, high)
        low = np.where(open_ & ~one, mid + 1, low)
    return low


def _met(values, a, b, budget) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of leaves below small pairs of nodes that are within the budget."""
    width = (a[1] - a[0]) * (b[1] - b[0])
    pair = np.repeat(np.arange(len(width)), width)
    k = tx.within(np.zeros(len(width), np.int64), width)
    other = (b[1] - b[0])[pair]
    i, j = a[0][pair] + k // other, b[0][pair] + k % other
    ok = (i < j) | (a[0] != b[0])[pair]
    i, j = i[ok], j[ok]
    near = np.bitwise_count(values[i] ^ values[j]) <= budget
    return i[near], j[near]


def _rotated(values: np.ndarray, block: int, width: int) -> np.ndarray:
    turn = np.uint64(block * width)
    return values if not block else (values << turn) | (values >> np.uint64(BITS - block * width))


def links(distinct: DataFrame, budget: int = 3) -> DataFrame:
    """(a, b) with a < b as unsigned bits order in the trie: all distinct fingerprints at most ``budget`` bits apart."""
    blocks = budget + 1
    width = BITS // blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            held.append(rows)
            if sum(x.shape[1] for x in held) >= BUFFER:
                rows = np.concatenate(held, axis=1)
                stop = int(np.searchsorted(rows[0], rows[0][-1]))  # the last key may go on
                if stop:
                    yield from _linked(rows[:, :stop], budget, blocks, width)
                held = [rows[:, stop:]]
        if held:
            yield from _linked(np.concatenate(held, axis=1), budget, blocks, width)

    mask = F.lit((1 << width) - 1).cast("long")
    keys = F.array(
        *(
            (
                F.shiftrightunsigned("fp", BITS - width * (i + 1)).bitwiseAND(mask)
                + F.lit(i << width).cast("long")
            )
            for i in range(blocks)
        )
    )
    return (
        distinct.select("fp", F.explode(keys).alias("key"))
        .select("key", "fp")
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(run, "a long, b long")
    )


def _linked(rows: np.ndarray, budget: int, blocks: int, width: int) -> Iterator[pa.RecordBatch]:
    for block in range(blocks):
        own = np.unique(rows[1][rows[0] >> width == block].view(np.uint64))
        turned = _rotated(own, block, width)
        order = np.argsort(turned)
        for i, j in trie_pairs(turned[order], budget, width):
            a, b = own[order[i]], own[order[j]]
            # A pair counts in the first block in which it agrees.
            first = np.ones(len(a), bool)
            for earlier in range(block):
                first &= ((a ^ b) << np.uint64(earlier * width)) >> np.uint64(BITS - width) != 0
            a, b = a[first], b[first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b).view(np.int64)), pa.array(np.maximum(a, b).view(np.int64))],
                names=["a", "b"],
            )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of an edge: root is the least node that it reaches.

    Alternating stars: each node hands its least neighbour to the larger, then
    to the smaller ones, until nothing changes. Rounds grow with the logarithm
    of the largest class.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = stored(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == state:
            break
        state = after
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return ends.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def classes(prints: DataFrame, budget: int = 3) -> DataFrame:
    """The rows of ``prints`` (doc_id, fp) with component_id, the least doc_id of the class."""
    prints = stored(prints)
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(distinct.select("fp"), budget))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    label = stored(named.join(least, "root").select("fp", "component_id"))
    return prints.join(label, "fp")


def dedup_classes(docs: DataFrame, shingle: int = 3, budget: int = 3) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every document."""
    prints = fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle)
    return classes(prints, budget).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: Wide fingerprints for documents that share four fifths of their shingles: such pairs differ in
#: about 15 of 100 bits, too many for the blocks of a short fingerprint.
WIDE = 7
KEY = 32
KEY_ERRORS = 3
PREFIX = 8
#: Groups are dealt in parts from this size on, if they are also above twice the mean.
LEAST_PART = 1000
#: Of 448 bits. Pairs with a similarity of 0.8 differ in 68 on average, with a deviation of 7.6.
WIDE_BUDGET = 84
#: Keys whose links come before those of the others.
FIRST_KEYS = 4
#: Shingles are ordered by how often these bits of their hash occur: at most 2^18 counts.
ORDER_BITS = 18
#: Least similarity of two sets of shingles, as a fraction.
SIMILAR = (4, 5)


def _crossed(a: np.ndarray, b: np.ndarray, first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a member of run ``a`` with one of run ``b`` (once, if they are the same run), in portions."""
    width = size[a] * size[b]
    wide = width > FRONTIER
    for x, y in zip(a[wide].tolist(), b[wide].tolist(), strict=True):
        step = max(1, FRONTIER // int(size[y]))
        for at in range(0, int(size[x]), step):
            n = min(step, int(size[x]) - at)
            i = np.repeat(first[x] + at + np.arange(n), size[y])
            j = np.tile(first[y] + np.arange(size[y]), n)
            yield (i[i < j], j[i < j]) if x == y else (i, j)
    a, b, width = a[~wide], b[~wide], width[~wide]
    up_to = np.cumsum(width)
    at = 0
    while at < len(a):
        past = max(at + 1, int(np.searchsorted(up_to, (up_to[at - 1] if at else 0) + FRONTIER, "right")))
        cut = slice(at, past)
        pair = np.repeat(np.arange(at, past), width[cut])
        k = tx.within(np.zeros(past - at, np.int64), width[cut])
        other = size[b[pair]]
        i, j = first[a[pair]] + k // other, first[b[pair]] + k % other
        ok = (i < j) | (a[pair] != b[pair])
        yield i[ok], j[ok]
        at = past


def _candidates(key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of sorted keys with an equal prefix and at most ``KEY_ERRORS`` different bits, in portions."""
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(first, len(key)))
    many = np.flatnonzero(size > 1)
    yield from _crossed(many, many, first, size)
    for i, j in trie_pairs(key[first].astype(np.uint64) << np.uint64(BITS - KEY), KEY_ERRORS, PREFIX):
        yield from _crossed(i, j, first, size)


def _sizes_fit(sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sets of these sizes can be similar enough."""
    return SIMILAR[1] * np.minimum(sizes[i], sizes[j]) >= SIMILAR[0] * np.maximum(sizes[i], sizes[j])


def _wide_edges(
    group: int,
    ids: np.ndarray,
    fps: np.ndarray,
    budget: int,
    side: np.ndarray | None = None,
    sizes: np.ndarray | None = None,
    named: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in one group: fingerprints with an equal prefix of one key.

    With ``side``, only links between its two values count; with ``sizes``, only
    those whose sets can be similar enough; with ``named``, equal names count as
    joined. A pair is passed over only when links found before join it already.
    """
    key = _wide_key(fps, group >> PREFIX)
    order = np.argsort(key, kind="stable")
    key, ids, fps = key[order], ids[order], fps[order]
    side = None if side is None else side[order]
    sizes = np.ones(len(ids), np.int64) if sizes is None else sizes[order]
    label = np.arange(len(ids))
    if named is not None:
        _, first, back = np.unique(named[order], return_index=True, return_inverse=True)
        label = first[back]
    start = label

    def join(i: np.ndarray, j: np.ndarray) -> None:
        nonlocal label
        apart = (label[i] != label[j]) & _sizes_fit(sizes, i, j)
        if side is not None:
            apart &= side[i] != side[j]
        i, j = i[apart], j[apart]
        near = np.bitwise_count(fps[i] ^ fps[j]).sum(axis=1) <= budget
        pairs = np.unique(np.stack([label[i[near]], label[j[near]]], axis=1), axis=0)
        if not len(pairs):
            return
        root = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        for a, b in pairs.tolist():
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        table = np.arange(len(ids))
        for x in list(root):
            table[x] = find(x)
        label = table[label]

    for i, j in _candidates(key):
        join(i, j)
    # One edge for every name that was joined to another one.
    member = np.flatnonzero((label != start) & (start == np.arange(len(ids))))
    return ids[label[member]], ids[member]


def _wide_key(fps: np.ndarray, number: int) -> np.ndarray:
    """32 bits of the fingerprint from bit 16 * number on, around the end."""
    word, part = divmod(number, 4)
    here, after = fps[:, word], fps[:, (word + 1) % fps.shape[1]]
    shift = np.uint64(16 * part)
    both = here >> shift
    if part == 3:
        both = both | (after << np.uint64(16))
    return (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _groups(raw: pa.Array, keys: range) -> Iterator[np.ndarray]:
    """Key by key, the group of each fingerprint of a column."""
    fps = np.frombuffer(b"".join(raw.to_pylist()), np.uint64).reshape(-1, WIDE)
    return ((n << PREFIX) + (_wide_key(fps, n) >> np.uint32(KEY - PREFIX)).astype(np.int64) for n in keys)


def _hot_groups(distinct: DataFrame, keys: range) -> dict[int, int]:
    """The parts of each group that is much larger than the mean, at most one entry a group."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4 * WIDE << PREFIX, np.int64)
        for batch in batches:
            for group in _groups(batch.column(0), keys):
                total += np.bincount(group, minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["group", "n"])

    sizes = distinct.select("fp").mapInArrow(counted, "group long, n long").groupBy("group").agg(F.sum("n").alias("n"))
    most = {r["group"]: r["n"] for r in sizes.collect()}
    part = max(LEAST_PART, 2 * sum(most.values()) // (len(keys) << PREFIX))
    return {g: -(-n // part) for g, n in most.items() if n > part}


def _wide_links(distinct: DataFrame, budget: int, keys: range = range(4 * WIDE)) -> DataFrame:
    """(a, b): links of distinct wide fingerprints (fp, first, size, named) in the groups of some keys.

    They span, together with equal names, the same classes as all links of these groups.

    A hot group is dealt as pairs of its parts, so that every two members meet
    in some task and none has the whole group.
    """
    hot = _hot_groups(distinct, keys)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.ones(4 * WIDE << PREFIX, np.int64)
        for g, n in hot.items():
            parts[g] = n
        for batch in batches:
            raw, first = batch.column(0), batch.column(1).to_numpy()
            size, named = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for group in _groups(raw, keys):
                times = parts[group]
                row = np.repeat(np.arange(len(group)), times)
                own = (tx.mix(first.view(np.uint64)) % times.astype(np.uint64)).astype(np.int64)[row]
                other = tx.within(np.zeros(len(group), np.int64), times)
                cell = (group[row] << 40) | (np.minimum(own, other) << 20) | np.maximum(own, other)
                for at in range(0, len(row), BUFFER):
                    cut = slice(at, at + BUFFER)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cell[cut]),
                            pa.array(own[cut] < other[cut]),
                            pa.array(first[row[cut]]),
                            raw.take(pa.array(row[cut])),
                            pa.array(size[row[cut]]),
                            pa.array(named[row[cut]]),
                        ],
                        names=["cell", "side", "first", "fp", "size", "named"],
                    )

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            side, ids, fps, sizes, named = zip(*held, strict=True)
            one = (now >> 20 & 0xFFFFF) == (now & 0xFFFFF)
            whole = np.frombuffer(b"".join(fps), np.uint64).reshape(-1, WIDE)
            a, b = _wide_edges(now >> 40, np.array(ids), whole, budget, None if one else np.array(side), np.array(sizes), np.array(named))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for cell, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if cell != now:
                    if len(held) > 1:
                        yield from flush()
                    now, held = cell, []
                held.append(row)
        if len(held) > 1:
            yield from flush()

    return (
        distinct.select("fp", "first", "size", "named")
        .mapInArrow(dealt, "cell long, side boolean, first long, fp binary, size long, named long")
        .repartition("cell")
        .sortWithinPartitions("cell")
        .mapInArrow(linked, "a long, b long")
    )


def _compared(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """The pairs (a, b) with whether the exact similarity of their sets of shingles reaches ``SIMILAR``; written."""
    pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for row in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[row].as_buffer(), np.uint64) for c in (2, 3))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok[row] = SIMILAR[1] * both >= SIMILAR[0] * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok)], names=["a", "b", "ok"])

    sets = stored(_shingle_sets(texts.join(ends, "id", "left_semi").select("id", "text"), shingle))
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    asked = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return stored(asked.mapInArrow(similar, "a long, b long, ok boolean"))


def _rarity(sets: DataFrame) -> np.ndarray:
    """How often shingles occur, by ORDER_BITS bits of their hash."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                h = np.frombuffer(raw.as_buffer(), np.uint64)
                total += np.bincount((h >> np.uint64(64 - ORDER_BITS)).astype(np.int64), minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["part", "n"])

    sums = sets.select("shingles").mapInArrow(counted, "part long, n long").groupBy("part").agg(F.sum("n").alias("n"))
    rarity = np.zeros(1 << ORDER_BITS, np.int64)
    for part, n in sums.collect():  # at most one row per value of ORDER_BITS bits
        rarity[part] = n
    return rarity


def _prefix_pairs(sets: DataFrame, rarity: np.ndarray) -> DataFrame:
    """(a, b) with different names, among them all pairs of sets that are similar enough.

    Shingles are put in one order for all sets, about the rarest first. Of two
    similar sets the smaller one has a common shingle among its first 1/9, the
    larger one among its first 1/5, and behind the first common one enough are
    left for the overlap. What all members of a template share comes late, so
    members that are not similar seldom meet.
    """
    num, den = SIMILAR

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                h = np.frombuffer(batch.column(2)[row].as_buffer(), np.uint64)
                n = len(h)
                order = np.lexsort((h, rarity[(h >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]))
                probe = n - -(-num * n // den) + 1
                index = n - -(-2 * num * n // (num + den)) + 1
                first = h[order[: min(probe, n)]].view(np.int64)
                place = np.arange(len(first))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first),
                        pa.array(np.full(len(first), batch.column(0)[row].as_py())),
                        pa.array(np.full(len(first), batch.column(1)[row].as_py())),
                        pa.array(np.full(len(first), n)),
                        pa.array(place),
                        pa.array(place < index),
                    ],
                    names=["h", "id", "named", "size", "place", "early"],
                )

    heads = stored(sets.select("id", "named", "shingles").mapInArrow(cut, "h long, id long, named long, size long, place long, early boolean"))
    shared = heads.groupBy("h").agg(F.min("named").alias("low"), F.max("named").alias("high")).where("low <> high").select("h")
    heads = stored(heads.join(shared, "h", "left_semi"))
    x, y = heads.where("early").alias("x"), heads.alias("y")
    meets = (
        "x.h = y.h and x.named <> y.named and x.size <= y.size and (x.size < y.size or x.id < y.id) "
        f"and {den} * x.size >= {num} * y.size "
        f"and {num + den} * least(x.size - x.place, y.size - y.place) >= {num} * (x.size + y.size)"
    )
    pairs = x.join(y, F.expr(meets)).selectExpr("x.id as a", "y.id as b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles): the sorted 64-bit hashes of each text's set of shingles, with what else ``texts`` has."""
    extra = [c for c in texts.columns if c not in ("id", "text")]

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tx.slices(batch.column(1)):
                h, count = shingle_sets(data, offsets, shingle)
                raw = [x.tobytes() for x in np.split(h, np.cumsum(count)[:-1])]
                rest = [batch.column(i).slice(a, b - a) for i in range(2, batch.num_columns)]
                columns = [batch.column(0).slice(a, b - a), pa.array(raw, pa.binary()), *rest]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "shingles", *extra])

    kinds = "".join(f", {c} long" for c in extra)
    return texts.select("id", "text", *extra).mapInArrow(gathered, f"id long, shingles binary{kinds}")


def _similar_roots(distinct: DataFrame, texts: DataFrame, shingle: int, budget: int) -> DataFrame:
    """(node, root) of the classes that links of similar sets form.

    Links of a few keys come first; those of the other keys only join classes
    that the former left apart. Of the links of near fingerprints one per
    document is confirmed. Where that does not join a whole class of near
    fingerprints, its members are compared with the one nearest to the middle,
    and then all pairs of its sets that still have to be joined and can be similar.
    """
    few = _wide_links(distinct.withColumn("named", F.col("first")), budget, range(FIRST_KEYS))
    few = stored(few.distinct())
    named = distinct.join(components(few).withColumnRenamed("node", "first"), "first", "left")
    named = stored(named.select("fp", "first", "size", F.coalesce("root", "first").alias("named")))
    links_ = stored(few.unionByName(_wide_links(named, budget, range(FIRST_KEYS, 4 * WIDE))).distinct())
    near = stored(components(links_))
    one = links_.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")).groupBy("b").agg(F.min("a").alias("a"))
    sure = _compared(one, texts, shingle).where("ok").select("a", "b")
    roots = stored(components(sure))
    left = _open_members(near, roots)
    if left.isEmpty():
        return roots
    sets = stored(_shingle_sets(texts.join(left, "id"), shingle))
    rarity = _rarity(sets)
    hubs = _hubs(sets, rarity)
    pairs = left.join(hubs, "class").where("named <> hub_named").select(F.col("id").alias("a"), F.col("hub").alias("b"))
    sure = stored(sure.unionByName(_compared(pairs, texts, shingle).where("ok").select("a", "b")))
    roots = stored(components(sure))
    left = _open_members(near, roots)
    if left.isEmpty():
        return roots
    sets = sets.select("id", "shingles").join(left.select("id", "named"), "id")
    second = _compared(_prefix_pairs(sets, rarity), texts, shingle)
    return components(sure.unionByName(second.where("ok").select("a", "b")))


def _open_members(near: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, class, named) of the classes of near fingerprints whose members have different confirmed roots."""
    members = near.withColumnRenamed("root", "class").join(roots, "node", "left")
    members = stored(members.select(F.col("node").alias("id"), "class", F.coalesce("root", "node").alias("named")))
    apart = members.groupBy("class").agg(F.min("named").alias("low"), F.max("named").alias("high")).where("low <> high")
    return stored(members.join(apart.select("class"), "class", "left_semi"))


def _hubs(sets: DataFrame, rarity: np.ndarray) -> DataFrame:
    """(class, hub, hub_named): the member of each class whose shingles are the commonest, so near to most others."""

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for row in range(batch.num_rows):
                h = np.frombuffer(batch.column(3)[row].as_buffer(), np.uint64)
                score[row] = rarity[(h >> np.uint64(64 - ORDER_BITS)).astype(np.int64)].sum() / max(1, len(h))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score)], names=["id", "class", "named", "score"])

    scores = sets.select("id", "class", "named", "shingles").mapInArrow(weighed, "id long, class long, named long, score double")
    best = scores.groupBy("class").agg(F.max(F.struct("score", "id", "named")).alias("best"))
    return best.select("class", F.col("best.id").alias("hub"), F.col("best.named").alias("hub_named"))


def without_near_duplicates(docs: DataFrame, shingle: int = 5, budget: int = WIDE_BUDGET) -> DataFrame:
    """One row of ``docs`` for each class of near-duplicates.

    Wide fingerprints of the sets of shingles are dealt by 28 keys of 32 bits
    each; in a group, tries over the keys and the whole fingerprint give the
    candidates. A link needs ``SIMILAR`` sets of shingles, compared exactly (as
    64-bit hashes); a class is all that links join. The row with the least doc_id stays; null ids come last.
    """
    rows = stored(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("id")))

    def wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tx.slices(batch.column(1)):
                h, count = shingle_sets(data, offsets, shingle)
                raw = [fp.tobytes() for fp in _majority(h, count, WIDE)]
                own = [xxhash.xxh3_128_digest(x.tobytes()) for x in np.split(h, np.cumsum(count)[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(raw, pa.binary()), pa.array(own, pa.binary()), pa.array(count.astype(np.int64))],
                    names=["id", "fp", "own", "size"],
                )

    texts = rows.select("id", "doc.text")
    prints = stored(texts.mapInArrow(wide, "id long, fp binary, own binary, size long"))
    distinct = stored(prints.groupBy("own").agg(F.min("id").alias("first"), F.first("fp").alias("fp"), F.first("size").alias("size")))

    roots = _similar_roots(distinct, texts, shingle, budget)
    named = distinct.join(roots, F.col("first") == F.col("node"), "left").select(
        "own", F.coalesce("root", "first").alias("root")
    )
    order = F.struct(F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").alias("doc_id"), "id")
    owned = stored(prints.join(named, "own").select("id", "root").join(rows.select("id", order.alias("o")), "id"))
    kept = owned.groupBy("root").agg(F.min("o").alias("o")).select(F.col("o.id").alias("id"))
    # Those that go are fewer than those that stay.
    gone = stored(owned.select("id").join(kept, "id", "left_anti"))
    return rows.join(gone, "id", "left_anti").select("doc.*")
