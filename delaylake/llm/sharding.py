"""Byte-balanced shards by Karmarkar-Karp differencing.

Rows with equal text form one indivisible unit. Units are dealt to blocks of
some thousand; each block is one task that differences its units: the two
partial partitions with the largest spread are joined, one of them in opposite
order, until one partition into ``shards`` parts is left. Blocks are then
partial partitions themselves and are differenced level by level, so no task
and no driver ever holds all units. Only shard labels travel back.

A unit larger than one shard's mean cannot be balanced whole: it is dealt by
row hash into the fewest pieces that fit. There are fewer such units than shards,
which bounds the table that is broadcast.

Defined results: null text counts as empty (8 bytes a row for itself), repeated
rows are rows, an empty table gives no rows, other columns stay and clashing
ones are replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from delaylake.llm.store import stored

ROW_BYTES = 8
BLOCK_UNITS = 4096
CELL_ROWS = 20_000


def difference(vectors: np.ndarray) -> np.ndarray:
    """For each partial partition (a row of part sums) the final part of each of its parts.

    Ties fall to the earlier row, so the result is a function of the input order.
    """
    n, k = vectors.shape
    order = np.argsort(-vectors, axis=1, kind="stable")
    sums = list(np.take_along_axis(vectors, order, axis=1))
    heap = [(-(int(s[0]) - int(s[-1])), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    parents: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        joined = sums[a] + sums[b][::-1]
        by = np.argsort(-joined, kind="stable")
        parents.append((a, b, by))
        joined = joined[by]
        sums[a] = sums[b] = None
        sums.append(joined)
        heapq.heappush(heap, (-(int(joined[0]) - int(joined[-1])), len(sums) - 1))
    final: list[np.ndarray | None] = [None] * len(sums)
    if sums:
        final[-1] = np.arange(k)
    for node in range(len(sums) - 1, n - 1, -1):
        a, b, by = parents[node - n]
        place = np.empty(k, np.int64)
        place[by] = final[node]
        final[a], final[b] = place, place[::-1]
    out = np.empty((n, k), np.int64)
    for i in range(n):
        out[i, order[i]] = final[i]
    return out


def _units(shards: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["bytes", "digest", "piece"], ascending=[False, True, True])
        vectors = np.zeros((len(block), shards), np.int64)
        vectors[:, 0] = block["bytes"]
        return block.assign(label=difference(vectors)[:, 0].astype("int32"))[
            ["digest", "piece", "bytes", "block", "label"]
        ]

    return run


def _partitions(shards: int):
    def run(level: pd.DataFrame) -> pd.DataFrame:
        level = level.sort_values("block")
        labels = difference(np.stack(level["sums"].to_numpy()).astype(np.int64))
        return pd.DataFrame(
            {
                "block": np.repeat(level["block"].to_numpy(), shards),
                "label": np.tile(np.arange(shards, dtype=np.int32), len(level)),
                "parent": np.repeat(level["parent"].to_numpy(), shards),
                "to": labels.ravel().astype(np.int32),
            }
        )

    return run


def shard(
    docs: DataFrame,
    shards: int,
    text: str = "text",
    block_units: int = BLOCK_UNITS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """All rows with size, text_crc32, law, shard and slot (gapless from 0 in each shard)."""
    added = ("size", "text_crc32", "law", "shard", "slot", text)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = stored(
        docs.select(
            F.struct(*kept).alias("kept"),
            (F.octet_length(body) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.unhex(F.sha2(body, 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    units, rows = _placed(keyed, shards, block_units)
    placed = rows.join(units, ["digest", "piece"]).drop("digest", "piece")
    return _numbered(placed, keyed.count(), cell_rows).select(
        "kept.*", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot"
    )


def _placed(keyed: DataFrame, shards: int, block_units: int) -> tuple[DataFrame, DataFrame]:
    total = keyed.agg(F.sum("size")).first()[0] or 0
    mean = max(1, total // shards)
    large = (
        keyed.groupBy("digest")
        .agg(F.sum("size").alias("bytes"))
        .where(F.col("bytes") > mean)
        .select("digest", F.ceil(F.col("bytes") / mean).alias("pieces"))
    )
    rows = keyed.join(F.broadcast(large), "digest", "left").withColumn(
        "piece", F.coalesce(F.pmod(F.xxhash64("row"), "pieces"), F.lit(0)).cast("long")
    ).drop("pieces")
    units = stored(rows.groupBy("digest", "piece").agg(F.sum("size").alias("bytes")))
    blocks = max(1, -(-units.count() // block_units))
    block = F.pmod(F.xxhash64("digest", "piece"), F.lit(blocks)).alias("block")
    labelled = stored(
        units.select("*", block)
        .groupBy("block")
        .applyInPandas(_units(shards), "digest binary, piece long, bytes long, block long, label int")
    )
    sums = _vectors(labelled, shards)
    steps = []
    while blocks > 1:
        blocks = -(-blocks // block_units)
        step = stored(
            sums.withColumn("parent", F.pmod(F.xxhash64("block"), F.lit(blocks)))
            .groupBy("parent")
            .applyInPandas(_partitions(shards), "block long, label int, parent long, to int")
        )
        steps.append(step)
        moved = sums.select("block", F.posexplode("sums").alias("label", "bytes")).join(
            step, ["block", "label"]
        )
        sums = stored(
            _vectors(moved.select(F.col("parent").alias("block"), F.col("to").alias("label"), "bytes"), shards)
        )
    out = labelled.select("digest", "piece", "block", "label")
    for step in steps:
        out = out.join(step, ["block", "label"]).select(
            "digest", "piece", F.col("parent").alias("block"), F.col("to").alias("label")
        )
    return out.select("digest", "piece", F.col("label").alias("shard")), rows


def _vectors(labelled: DataFrame, shards: int) -> DataFrame:
    """(block, sums): the bytes of each label of a block."""
    return labelled.groupBy("block").agg(
        F.array(
            *(
                F.coalesce(F.sum(F.when(F.col("label") == i, F.col("bytes"))), F.lit(0).cast("long"))
                for i in range(shards)
            )
        ).alias("sums")
    )


def _numbered(placed: DataFrame, n: int, cell_rows: int) -> DataFrame:
    """Slots in two steps: numbers within small cells, plus the rows of the cells before."""
    cells = max(1, n // cell_rows)
    celled = placed.withColumn("cell", F.pmod(F.xxhash64("row"), F.lit(cells)))
    before = (
        celled.groupBy("shard", "cell")
        .count()
        .withColumn(
            "base",
            F.coalesce(
                F.sum("count").over(
                    Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("count")
    )
    own = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("row"))
    return (
        celled.withColumn("own", own)
        .join(before, ["shard", "cell"])
        .withColumn("slot", (F.col("base") + F.col("own") - 1).cast("long"))
    )
