"""Benchmark decontamination over canonical templates.

Numbers, names and units become typed placeholders in texts and in benchmark
items, so a question asked again with other values keeps its windows. Windows
with too few literal words are no evidence and are left out of the item side.
Windows of the lower-cased words as they are stand beside them, all of an item's,
so a copy of an item made of numbers, names and units is found as well. Votes
are measured against the windows with placeholders that an item has.
Diagonal voting (see ``diagonals``) finds candidate spans; their texts are read
again, aligned word by word, and a leak needs ``MIN_SHARE`` of the item in order
and slots that are filled consistently: equal values of the item by equal values
of the text, different ones by different ones.

Names are capitalised words inside a sentence; a word that starts a sentence is
lower-cased instead. Words that start with a digit are numbers.

Defined results: null or empty texts and items leak nothing; items with fewer
words than a window use one window of their own length, also if it is a single
word or number; repeated rows of one
text and id give one leak; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm import diagonals
from delaylake.llm import text as tx
from delaylake.llm.store import stored

#: Units of measure.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams lb lbs pound pounds ounce ounces "
    "ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes hour hours day days "
    "week weeks month months year years percent dollar dollars euro euros cent cents degree degrees celsius "
    "fahrenheit mph kmh watt watts volt volts byte bytes kb mb gb"
).split()

WINDOW = 5
MIN_SHARE = 0.6
MIN_CONSISTENT = 0.8
LITERAL, NUMBER, NAME, UNIT = range(4)
#: Hashes that stand for the placeholders.
SLOTS = np.array([0, 11, 12, 13], np.uint64)

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_POINT = np.zeros(256, bool)
_POINT[[44, 46]] = True
_STOP = np.zeros(256, bool)
_STOP[[10, 13, 33, 46, 58, 63]] = True


def _lowered(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A-Z and Latin-1 capitals lower-cased, and where a capital begins."""
    low = tx.LOWER[data]
    capital = low != data
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    low[second] += 32
    capital[:-1] |= second[1:]
    return low, capital


def canonical(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each lower-cased word, its kind, its placeholder or hash, and first words of the texts."""
    low, capital = _lowered(data)
    n = len(low)
    digit = _DIGIT[low]
    byte = low
    if n > 2:
        joint = np.zeros(n, bool)
        joint[1:-1] = _POINT[low[1:-1]] & digit[:-2] & digit[2:]
        byte = np.where(joint, 48, low).astype(np.uint8)
    starts, ends, first = tx.spans(byte, offsets, tx.ALNUM)
    own = tx.hashes(low, starts, ends)
    kind = np.zeros(len(starts), np.int8)
    if len(starts):
        text_start = np.repeat(offsets[:-1], np.diff(first))
        inner = starts - text_start >= 2
        before, two = low[np.maximum(starts - 1, 0)], low[np.maximum(starts - 2, 0)]
        kind[np.isin(own, _unit_hashes())] = UNIT
        kind[inner & capital[starts] & (before == 32) & ~_STOP[two]] = NAME
        kind[digit[starts]] = NUMBER
    return own, kind, np.where(kind > 0, SLOTS[kind], own), first


def _unit_hashes() -> np.ndarray:
    global _UNIT_HASHES
    if _UNIT_HASHES is None:
        raw = [u.encode() for u in UNITS]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(u) for u in raw])
        _UNIT_HASHES = np.sort(tx.hashes(data, ends - [len(u) for u in raw], ends))
    return _UNIT_HASHES


_UNIT_HASHES: np.ndarray | None = None


def canon(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, _, words, first = canonical(data, offsets)
    return words, first


def literal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, _, _, first = canonical(data, offsets)
    return own, first


def _literal_enough(k: int):
    """At least three words in five of a window are no placeholders."""

    def least(words: np.ndarray, at: np.ndarray) -> np.ndarray:
        slot = np.concatenate(([0], np.cumsum(np.isin(words, SLOTS[1:]))))
        return 5 * (slot[at + k] - slot[at]) <= 2 * k

    return least


LEAK = "doc_id long, th long, item_id long, start_word long, stop_word long, share double, kind string"


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has no leak."""
    body = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    found = stored(_leaks(docs, benchmark, WINDOW, MIN_SHARE, MIN_CONSISTENT).select("doc_id", "th").distinct())
    rows = docs.select(F.struct("*").alias("doc"), body.alias("th")).alias("d")
    on = F.expr("cast(d.doc.doc_id as long) <=> l.doc_id and d.th = l.th")
    return rows.join(found.alias("l"), on, "left_anti").select("doc.*")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    least: float = MIN_SHARE,
    consistent: float = MIN_CONSISTENT,
) -> DataFrame:
    """(doc_id, item_id, start_word, stop_word, share, kind) of every leak; kind is verbatim or changed."""
    best = F.max(F.struct("share", "start_word", "stop_word", "kind"))
    return (
        _leaks(docs, benchmark, window, least, consistent)
        .groupBy("doc_id", "item_id")
        .agg(best.alias("b"))
        .select("doc_id", "item_id", "b.start_word", "b.stop_word", "b.share", "b.kind")
    )


def _leaks(docs: DataFrame, benchmark: DataFrame, window: int, least: float, consistent: float) -> DataFrame:
    texts = diagonals.keyed(docs)
    items = stored(
        diagonals.keyed(benchmark.select(F.col("item_id").alias("doc_id"), "text")).where("doc_id is not null").distinct()
    )
    sized = stored(_sizes(items, window))
    wanted = None
    for row in sized.select(F.least("size", F.lit(window)).alias("k")).where("k > 0").distinct().collect():
        k = row["k"]
        same = sized.where(F.least("size", F.lit(window)) == k)
        own = items.join(same.select("doc_id", "th"), ["doc_id", "th"])
        shaped = diagonals.template_windows(own, canon, k, _literal_enough(k))
        table = stored(shaped.unionByName(diagonals.template_windows(own, literal, k)))
        both = diagonals.windows(texts, canon, k).unionByName(diagonals.windows(texts, literal, k))
        spans = diagonals.voted(both, table, k)
        wanted = spans if wanted is None else wanted.unionByName(spans)
    if wanted is None:
        return docs.sparkSession.createDataFrame([], LEAK)
    reach = F.least("size", F.col("shaped") + window - 1)
    likely = wanted.join(sized.select(F.col("doc_id").alias("item"), "size", "shaped").distinct(), "item").where(
        F.col("votes") + window - 1 >= F.ceil(F.lit(least / 2) * reach)
    )
    asked = likely.join(items.select(F.col("doc_id").alias("item"), F.col("text").alias("asked")), "item")
    found = stored(
        asked.groupBy("doc_id", "th").agg(F.collect_list(F.struct("item", "asked", "start", "stop")).alias("spans"))
    )
    again = texts.alias("d").join(found.alias("w"), F.expr("d.doc_id <=> w.doc_id and d.th = w.th"))
    return again.select("d.doc_id", "d.th", "d.text", "w.spans").mapInArrow(_aligned(least, consistent), LEAK)


def _sizes(items: DataFrame, window: int) -> DataFrame:
    """The words of each item, and how many of its windows with placeholders say enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tx.slices(batch.column(2)):
                words, first = canon(data, offsets)
                size = np.diff(first)
                shaped = np.zeros(b - a, np.int64)
                for k in np.unique(np.minimum(size, window)).tolist():
                    if k:
                        _, at = tx.grams(words, first, k)
                        n = np.diff(tx.per_text(at[_literal_enough(k)(words, at)], first))
                        shaped = np.where(np.minimum(size, window) == k, n, shaped)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(size.astype(np.int32)),
                        pa.array(shaped.astype(np.int32)),
                    ],
                    names=["doc_id", "th", "size", "shaped"],
                )

    return items.select("doc_id", "th", "text").mapInArrow(run, "doc_id long, th long, size int, shaped int")


def _one(body: str) -> tuple[list[int], list[int], list[int]]:
    data = np.frombuffer(body.encode(), np.uint8)
    own, kind, words, _ = canonical(data, np.array([0, len(data)]))
    return own.tolist(), kind.tolist(), words.tolist()


def _aligned(least: float, consistent: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("th", pa.int64()),
                ("item_id", pa.int64()),
                ("start_word", pa.int64()),
                ("stop_word", pa.int64()),
                ("share", pa.float64()),
                ("kind", pa.string()),
            ]
        )
        known: dict[str, tuple] = {}
        for batch in batches:
            out = []
            for doc_id, th, body, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = _one(body)
                for s in spans:
                    if len(known) > 10_000:
                        known.clear()
                    item = known.get(s["asked"]) or known.setdefault(s["asked"], _one(s["asked"]))
                    row = _compared(item, text, s["start"], s["stop"], least, consistent)
                    if row:
                        out.append({"doc_id": doc_id, "th": th, "item_id": s["item"]} | row)
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _compared(item, text, start: int, stop: int, least: float, consistent: float) -> dict | None:
    """The leak that a candidate span is, or None: by placeholders, or else all words as they are."""
    size = len(item[0])
    begin, end = max(0, start - size), min(len(text[0]), stop + size)
    for part, share in ((2, least), (0, 1)):
        blocks = SequenceMatcher(None, item[part], text[part][begin:end], False).get_matching_blocks()
        blocks = [b for b in blocks if b.size]
        pairs = [(b.a + i, begin + b.b + i) for b in blocks for i in range(b.size)]
        if not pairs or len(pairs) / size < share or pairs[-1][1] - pairs[0][1] >= 2 * size:
            continue
        slots = [(item[1][i], item[0][i], text[0][j]) for i, j in pairs if item[1][i] != LITERAL]
        if slots and min(_steady(slots, 1), _steady(slots, 2)) < consistent:
            continue
        same = all(item[0][i] == text[0][j] for i, j in pairs)
        return {
            "start_word": pairs[0][1],
            "stop_word": pairs[-1][1] + 1,
            "share": len(pairs) / size,
            "kind": "verbatim" if same else "changed",
        }
    return None


def _steady(slots: list[tuple[int, int, int]], key: int) -> float:
    """The share of slots that agree with the most frequent partner of their value."""
    by: dict[tuple[int, int], Counter] = defaultdict(Counter)
    for s in slots:
        by[s[0], s[key]][s[3 - key]] += 1
    return sum(max(c.values()) for c in by.values()) / len(slots)
