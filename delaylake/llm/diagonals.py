"""Window matches between texts and a bounded set of templates, by diagonal voting.

All rolling k-word windows of every text are exploded and joined to the template
windows. Hits of one text and template are counted by diagonal (place in the
text minus place in the template) before anything is sorted; neighbouring
diagonals that follow each other merge into one span, so insertions and
deletions of a few words do not cut it.

Texts are told apart by (doc_id, hash of the text): repeated rows give one
result, which both rows get back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from delaylake.llm import text as tx
from delaylake.llm.store import stored

#: canon(bytes, offsets) -> (word hashes, first word of each text)
Canon = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]

#: least(word hashes, first words of windows) -> which windows say enough
Least = Callable[[np.ndarray, np.ndarray], np.ndarray]


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, the text (null: empty) and its hash."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("th")
    )


def windows(docs: DataFrame, canon: Canon, k: int, least: Least | None = None) -> DataFrame:
    """(doc_id, th, pos, gram) of all k-word windows of keyed texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tx.slices(batch.column(2)):
                words, first = canon(data, offsets)
                grams, at = tx.grams(words, first, k)
                if least is not None:
                    said = least(words, at)
                    grams, at = grams[said], at[said]
                bounds = tx.per_text(at, first)
                place = at - np.repeat(first[:-1], np.diff(bounds))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        tx.lists(grams.view(np.int64), bounds, pa.int64()),
                        tx.lists(place.astype(np.int32), bounds, pa.int32()),
                    ],
                    names=["doc_id", "th", "grams", "places"],
                )

    return (
        docs.select("doc_id", "th", "text")
        .mapInArrow(run, "doc_id long, th long, grams array<long>, places array<int>")
        .select("doc_id", "th", F.inline(F.arrays_zip("places", "grams")).alias("pos", "gram"))
    )


def template_windows(templates: DataFrame, canon: Canon, k: int, least: Least | None = None) -> DataFrame:
    """(item, tpos, gram) of keyed templates, their id in doc_id.

    Written, so the planner knows the size: it broadcasts a small table and
    joins a large one by shuffle.
    """
    found = windows(templates, canon, k, least)
    return stored(found.select(F.col("doc_id").alias("item"), F.col("pos").alias("tpos"), "gram"))


def voted(grams: DataFrame, templates: DataFrame, k: int, slack: int = 4, gap: int = 12) -> DataFrame:
    """(doc_id, th, item, start, stop, votes): merged spans of words, ``stop`` past the last."""
    hits = grams.join(templates, "gram").select(
        "doc_id", "th", "item", "pos", (F.col("pos") - F.col("tpos")).alias("diagonal")
    )
    doc = ["doc_id", "th", "item"]
    on = Window.partitionBy(*doc, "diagonal").orderBy("pos")
    runs = (
        hits.distinct()
        .withColumn("new", F.coalesce((F.col("pos") - F.lag("pos").over(on) > gap).cast("int"), F.lit(1)))
        .withColumn("run", F.sum("new").over(on))
        .groupBy(*doc, "diagonal", "run")
        .agg(
            F.min("pos").alias("start"),
            (F.max("pos") + k).alias("stop"),
            F.count(F.lit(1)).alias("votes"),
        )
    )
    along = Window.partitionBy(*doc).orderBy("start", "stop", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(along)) > slack) | (
        F.col("start") - F.lag("stop").over(along) > gap
    )
    return (
        runs.withColumn("new", F.coalesce(apart.cast("int"), F.lit(1)))
        .withColumn("span", F.sum("new").over(along))
        .groupBy(*doc, "span")
        .agg(
            F.min("start").alias("start"),
            F.max("stop").alias("stop"),
            F.sum("votes").alias("votes"),
        )
        .drop("span")
    )
