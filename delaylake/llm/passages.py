"""Words of passages that another document holds too, for passages of at least ``length`` words.

Words are ``[^\\x20\\x09-\\x0D]+`` as they are; what separates them does not count.
Every window of ``length`` words has one anchor, as in ``substrings``: the leftmost
of its ``gram``-word strings with the least hash. Only windows behind anchors that
two different texts have can be equal. The windows of an anchor form a fragment;
one that occurs in several texts is shared whole and goes on once, as a partner of
others. The windows of those fragments are compared by 128-bit digests of their words.

Defined results: null text is empty; a text of several rows shares all its words,
if it has ``length``; null doc_ids are kept; strings that repeat in one text only
do not count; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm import substrings
from delaylake.llm import text as tx
from delaylake.llm.store import stored

#: Passages of more than 50 words; words of an anchor.
LENGTH = 51
GRAM = 17
BATCH_ROWS = 20_000

MARK = "doc_id long, th long, a int, m int, key long"


def mark_rows(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per anchor: first window ``a`` (number of its first word), ``m`` further windows, hash of the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ths = batch.column(0), batch.column(1)
            for i, _, data, offsets in tx.slices(batch.column(2)):
                starts, ends, firsts = tx.spans(data, offsets, tx.NOT_SPACE)
                words = tx.hashes(data, starts, ends)
                for row, before, part, cuts in substrings.blocks(words, firsts, length):
                    first, last, _, h = substrings.anchors(part, cuts, length, gram)
                    text_of = np.searchsorted(cuts, first, "right") - 1
                    take = pa.array(i + row + text_of)
                    a = first - cuts[text_of] + before
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(take),
                            ths.take(take),
                            pa.array(a.astype(np.int32)),
                            pa.array((last - first).astype(np.int32)),
                            pa.array(h.view(np.int64)),
                        ],
                        names=[x.split()[0] for x in MARK.split(", ")],
                    )

    return texts.select("doc_id", "th", "text").mapInArrow(run, MARK)


PIECE = "doc_id long, th long, a int, m int, settled boolean, d1 long, d2 long"


def _digests(held: DataFrame, length: int, single: bool) -> DataFrame:
    """Digests of the words of every fragment (a, m, settled), or of each of its windows (then m is 0)."""
    names = [c.split()[0] for c in PIECE.split(", ")]
    types = [{"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}[c.split()[1]] for c in PIECE.split(", ")]
    schema = pa.schema(list(zip(names, types, strict=True)))

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        arrays = [
            pa.array(np.array(c, np.uint64).view(np.int64)) if f.name in ("d1", "d2") else pa.array(c, f.type)
            for c, f in zip(columns, schema, strict=True)
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for doc_id, th, text, marks in zip(*(batch.column(i) for i in range(4)), strict=True):
                words = text.as_py().encode().split()
                plain = b" ".join(words)
                starts = np.cumsum([0] + [len(w) + 1 for w in words]).tolist()
                doc_id, th = doc_id.as_py(), th.as_py()
                for p in marks.as_py():
                    a, m = p["a"], p["m"]
                    for first, more in [(w, 0) for w in range(a, a + m + 1)] if single else [(a, m)]:
                        digest = xxhash.xxh3_128_intdigest(plain[starts[first] : starts[first + more + length] - 1])
                        out.append((doc_id, th, first, more, p["settled"], digest & (2**64 - 1), digest >> 64))
                if len(out) > BATCH_ROWS:
                    yield batch_of(out)
                    out = []
        yield batch_of(out)

    return held.select("doc_id", "th", "text", "marks").mapInArrow(run, PIECE)


def _with_text(texts: DataFrame, lists: DataFrame) -> DataFrame:
    return (
        texts.alias("t")
        .join(lists.alias("l"), F.expr("t.doc_id <=> l.doc_id and t.th = l.th"))
        .select("t.doc_id", "t.th", "t.text", "l.marks")
    )


def shared_windows(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """th, a, m: the windows a to a + m of a text that a different text has too.

    ``texts`` has doc_id, th (hash of the text) and text.
    """
    marks = stored(mark_rows(texts, length, gram))
    keys = marks.groupBy("key").agg(F.min("th").alias("p"), F.max("th").alias("q")).where("p <> q").select("key")
    # Written, so both sides of the join are plain exchanges and a frequent key can be split.
    met = marks.join(stored(keys), "key").withColumn("settled", F.lit(False))
    # Of texts that equal each other, one goes on. Written, or all copies of a text would be dealt to the task of its th.
    lists = stored(
        met.groupBy("th").agg(
            F.min("doc_id").alias("doc_id"), F.collect_set(F.struct("a", "m", "settled")).alias("marks")
        )
    )
    held = stored(_with_text(texts, lists))
    fragments = stored(_digests(held, length, single=False))
    same = ["m", "d1", "d2"]
    kinds = stored(
        fragments.groupBy(*same).agg(F.min(F.struct("th", "doc_id", "a")).alias("first"), F.max("th").alias("q"))
    ).withColumn("settled", F.expr("first.th <> q"))
    whole = fragments.drop("settled").join(stored(kinds.where("settled").select(*same)), same).select("th", "a", "m")
    # A fragment that several texts have is settled; it goes on once, as a partner of others.
    lists = kinds.groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.th").alias("th")).agg(
        F.collect_list(F.struct(F.col("first.a").alias("a"), "m", "settled")).alias("marks")
    )
    windows = stored(_digests(_with_text(held, lists), length, single=True))
    common = windows.groupBy("d1", "d2").agg(
        F.min("th").alias("p"), F.max("th").alias("q"), F.max("settled").alias("settled")
    )
    common = stored(common.where("p <> q or settled").select("d1", "d2"))
    parts = windows.where("not settled").join(common, ["d1", "d2"]).select("th", "a", "m")
    return whole.unionByName(parts)


def shared_words(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """th, sha and n_passage_words of the texts that share words; th and sha as in ``substrings.deduplicated``."""
    base = substrings.keyed(docs)
    spans = shared_windows(base, length, gram).select("th", F.struct("a", (F.col("a") + F.col("m") + length).alias("stop")).alias("s"))
    covered = (
        spans.groupBy("th")
        .agg(F.sort_array(F.collect_set("s")).alias("s"))
        .selectExpr(
            "th",
            """aggregate(s, struct(0L as n, 0 as stop), (x, y) -> struct(
                x.n + greatest(0, y.stop - greatest(y.a, x.stop)) as n, greatest(x.stop, y.stop) as stop), x -> x.n) as n""",
        )
    )
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    texts = base.select("th", F.sha2("text", 256).alias("sha"), words.alias("words"))
    texts = texts.groupBy("th", "sha").agg(F.count(F.lit(1)).alias("times"), F.max("words").alias("words"))
    whole = (F.col("times") > 1) & (F.col("words") >= length)
    n = F.when(whole, F.col("words")).otherwise(F.col("n"))
    # Written, so a text of many rows can be split in a join.
    return stored(texts.join(covered, "th", "left").select("th", "sha", n.alias("n_passage_words")).where("n_passage_words > 0"))
