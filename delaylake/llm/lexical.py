"""Ranked lexical search: the best documents for each item, with term counts taken from the text itself.

Terms are the maximal runs of digits, letters A-Z and a-z and characters beyond
ASCII; only A-Z are lower-cased. N documents hold a term; L is the number of all
terms. A term that df documents hold weighs floor(1000 ln((2N+2) / (2df+1))); a
document of n terms has m = 25 + (75 n N) div L and gets, for every term of the
item (repeats included), weight * ((10^9 tf) div (1000 tf + 8 m)).

**Method.** An Aho-Corasick automaton of all terms of the items, each between two
guards, is broadcast. A document's separators become guards, so the automaton
meets exactly the whole terms, and its outputs are the term numbers; these lead
to the items that hold them. No index of the documents is built: one pass counts
tf and n, and the counts give df, N and L before a second pass over them scores.

**On Spark.** Items with equal texts are ranked once. Item texts are dealt to
blocks by hash until each holds at most BLOCK_BYTES (or one text), and each block
has its own automaton, so what is broadcast and what the driver sees is bounded;
every block is a pass over all documents. Tasks score in portions of CELLS cells
and keep the best ``top`` of each item only, exactly (ties by document), so the
last step sorts at most top rows per item and task.

**Defined results.** A null or empty text has no terms; a null document id sorts
first among equal scores. Repeated documents are documents each of their own. A
null or empty item and an item without a match give no rows; repeated items get
their rows each (with their rank). Empty tables give no rows. Other columns are
ignored. Whole texts are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylake.llm import text as T
from delaylake.llm.store import stored

TOP = 10
#: Bytes of item texts behind one automaton.
BLOCK_BYTES = 4 << 20
#: Scores that a task holds at once.
CELLS = 1 << 20
GUARD = " "

#: The characters of terms, and their bytes.
TERM = T.ALNUM.copy()
TERM[0x41:0x5B] = True
HAS_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Term bytes in lower case, all others to the guard.
GUARDED = np.where(TERM, T.LOWER, ord(GUARD)).astype(np.uint8).tobytes()

COUNTS = "doc_id {kind}, n long, terms array<int>, tfs array<int>"
FOUND = "item int, doc_id {kind}, score long"


def _terms(raw: bytes) -> list[str]:
    return raw.translate(GUARDED).decode("utf-8", "surrogateescape").split(GUARD)


class Block:
    """The automaton of some item texts, and for each of its terms the items that hold it."""

    def __init__(self, texts: list[bytes]):
        self.items = len(texts)
        self.numbers: dict[str, int] = {}
        holders: list[list[tuple[int, int]]] = []
        for item, raw in enumerate(texts):
            for term, times in Counter(filter(None, _terms(raw))).items():
                number = self.numbers.setdefault(term, len(self.numbers))
                if number == len(holders):
                    holders.append([])
                holders[number].append((item, times))
        self.automaton = ahocorasick.Automaton()
        for term, number in self.numbers.items():
            self.automaton.add_word(GUARD + term + GUARD, number)
        self.automaton.make_automaton()
        self.sizes = np.array([len(h) for h in holders], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        pairs = np.array([p for h in holders for p in h], np.int64).reshape(-1, 2)
        self.held, self.times = pairs[:, 0].copy(), pairs[:, 1].copy()


def _lengths(column: pa.Array) -> np.ndarray:
    """The number of terms of every text of a column."""
    found = np.zeros(len(column), np.int64)
    for first, past, data, offsets in T.slices(column):
        _, _, bounds = T.spans(data, offsets, TERM)
        found[first:past] = np.diff(bounds)
    return found


def _counting(block):
    """Documents to their number of terms and the counts of the block's terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, number = block.value.automaton, itemgetter(1)
        for batch in batches:
            lengths = _lengths(batch["text"])
            terms, tfs = [], []
            for raw, n in zip(batch["text"].to_pylist(), lengths, strict=True):
                met: Counter = Counter()
                if n:
                    guarded = raw.translate(GUARDED).decode("utf-8", "surrogateescape")
                    met.update(map(number, automaton.iter(GUARD + guarded + GUARD)))
                terms.append(list(met))
                tfs.append(list(met.values()))
            kind = pa.list_(pa.int32())
            columns = [batch["doc_id"], pa.array(lengths), pa.array(terms, kind), pa.array(tfs, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])

    return count


def _holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the documents that hold each term, one row per term and task."""
    held = np.zeros(0, np.int64)
    for batch in batches:
        new = np.bincount(batch["terms"].flatten().to_numpy(zero_copy_only=False), minlength=len(held))
        new[: len(held)] += held
        held = new
    term = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int32)), pa.array(held[term])], ["term", "df"])


def _scores(block: Block, weights: np.ndarray, batch: pa.RecordBatch, documents: int, total: int) -> np.ndarray:
    """Scores of every document of the batch (rows) for every item (columns)."""
    sizes = batch["terms"].value_lengths().to_numpy(zero_copy_only=False)
    term = batch["terms"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    tf = batch["tfs"].flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    m = 25 + (75 * batch["n"].to_numpy(zero_copy_only=False) * documents) // total
    row = np.repeat(np.arange(batch.num_rows), sizes)
    part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
    fans = block.sizes[term]
    at = T.within(block.begin[term], fans)
    cells = np.zeros(batch.num_rows * block.items, np.int64)
    np.add.at(cells, np.repeat(row, fans) * block.items + block.held[at], np.repeat(part, fans) * block.times[at])
    return cells.reshape(batch.num_rows, block.items)


def _ranking(shared, top: int):
    """The best ``top`` documents of each item among the documents of a task."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights, documents, total = shared.value
        kind = None
        floor = np.zeros(block.items, np.int64)  # a score below it cannot be among the best
        items, scores, ids, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def reduced():
            """Sort by item, falling score, rising id (null first); keep the first of each item."""
            nonlocal items, scores, ids, waiting
            order = sorted(range(len(ids)), key=lambda i: (items[i], -scores[i], ids[i] is not None, ids[i]))
            chosen = np.array(order, np.int64)
            place = np.arange(len(chosen)) - np.searchsorted(items[chosen], items[chosen])
            chosen = chosen[place < top]
            items, scores, ids = items[chosen], scores[chosen], [ids[i] for i in chosen]
            last = np.flatnonzero(place[place < top] == top - 1)
            floor[items[last]] = scores[last]
            waiting = 0

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            step = max(1, CELLS // max(1, block.items))
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                cells = _scores(block, weights, part, documents, total)
                row, item = np.nonzero((cells > 0) & (cells >= floor))
                if not len(row):
                    continue
                # Of one portion, too, only the best scores of an item can stay.
                order = np.lexsort((-cells[row, item], item))
                row, item = row[order], item[order]
                value = cells[row, item]
                begin = np.searchsorted(item, item)
                nth = value[np.minimum(begin + top - 1, len(value) - 1)]
                fits = (np.arange(len(item)) - begin < top) | ((item[np.minimum(begin + top - 1, len(item) - 1)] == item) & (value == nth))
                row, item, value = row[fits], item[fits], value[fits]
                names = part["doc_id"].to_pylist()
                items, scores = np.concatenate([items, item]), np.concatenate([scores, value])
                ids += [names[i] for i in row]
                waiting += len(row)
                if waiting >= max(4096, 2 * top * block.items):
                    reduced()
        if len(ids):
            reduced()
            columns = [pa.array(items.astype(np.int32)), pa.array(ids, kind), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return best


def _blocks(texts: DataFrame) -> DataFrame:
    """Texts with the number of their block: more blocks until none of several texts exceeds BLOCK_BYTES."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / BLOCK_BYTES))
    while True:
        dealt = texts.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(count)).cast("int"))
        sizes = dealt.groupBy("block").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n"))
        if sizes.where(f"bytes > {BLOCK_BYTES} and n > 1").isEmpty():
            return dealt
        count *= 2


def _ranked_block(docs: DataFrame, texts: list[str], top: int) -> DataFrame:
    """The best documents of some texts: item (place in ``texts``), doc_id, score, rank."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    block = Block([t.encode("utf-8", "surrogateescape") for t in texts])
    shared = spark.sparkContext.broadcast(block)
    counts = docs.select("doc_id", F.encode("text", "utf-8").alias("text")).where("text is not null")
    counts = stored(counts.mapInArrow(_counting(shared), COUNTS.format(kind=kind)).where("n > 0"))
    documents, total = counts.agg(F.count("*"), F.sum("n")).first()
    held = counts.select("terms").mapInArrow(_holding, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weights = np.zeros(len(block.numbers), np.int64)
    for term, df in held.collect():  # at most one row per term of the block
        weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    scored = counts.where(F.size("terms") > 0).mapInArrow(
        _ranking(spark.sparkContext.broadcast((block, weights, documents, total)), top), FOUND.format(kind=kind)
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank (from 1), doc_id, score."""
    spark = docs.sparkSession
    texts = stored(_blocks(items.where(F.col("text").rlike(HAS_TERM)).select("text").distinct()))
    found = None
    for (number,) in texts.select("block").distinct().orderBy("block").collect():
        block = [r["text"] for r in texts.where(F.col("block") == number).orderBy("text").collect()]
        names = spark.createDataFrame(list(enumerate(block)), "item int, text string")
        best = _ranked_block(docs, block, top).join(names, "item").select("text", "rank", "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        kind = docs.schema["doc_id"].dataType.simpleString()
        found = spark.createDataFrame([], f"text string, rank int, doc_id {kind}, score long")
    return items.select("item_id", "text").join(found, "text").select("item_id", "rank", "doc_id", "score")
