"""License scan: base phrases by word match, notices by diagonal voting.

Words are lower-cased runs of digits, letters and non-ASCII characters. Phrases
count wherever their words stand consecutively. Notices are templates: their
4-word and 2-word windows vote for diagonals (see ``diagonals``). A merged span is
read again and verified word by word if it has a vote of four words, or as many
of two words as are left when all words that ``MIN_SHARE`` spares are changed: a
changed word takes two of them, an inserted one takes one. A span's share is the
part of the template's words found in it in order.

Defined results: null and empty texts have no words, no labels and score 0;
repeated rows get equal results; an empty table gives no rows; null doc_ids are
kept; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylake.llm import diagonals
from delaylake.llm import text as tx
from delaylake.llm.store import stored

#: Base phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Wording of public license notices, and the label of each.
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("mit", "Released under the MIT License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
]
WINDOWS = (4, 2)
MIN_SHARE = 0.7


def canon(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = tx.LOWER[data]
    starts, ends, first = tx.spans(low, offsets, tx.ALNUM)
    return tx.hashes(low, starts, ends), first


def _words(body: str) -> list[bytes]:
    data = np.frombuffer(body.encode(), np.uint8)
    low = tx.LOWER[data]
    starts, ends, _ = tx.spans(low, np.array([0, len(data)]), tx.ALNUM)
    raw = low.tobytes()
    return [raw[a:b] for a, b in zip(starts, ends, strict=True)]


BASE = "doc_id long, th long, n_words long, n_base long, first_word long, last_word long, found array<string>"


def base(docs: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """Counts and places of the phrases in keyed texts."""
    wanted = [(_words(p), label) for p, label in phrases.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tx.slices(batch.column(2)):
                low = tx.LOWER[data]
                starts, ends, first = tx.spans(low, offsets, tx.ALNUM)
                places = [_places(low, starts, ends, first, words) for words, _ in wanted]
                labels = [label for _, label in wanted]
                text_of = [np.searchsorted(first, at, "right") - 1 for at in places]
                n = b - a
                count = sum(np.bincount(t, minlength=n) for t in text_of)
                low_at = np.full(n, np.iinfo(np.int64).max)
                high_at = np.full(n, -1)
                found: list[list[str]] = [[] for _ in range(n)]
                for t, at, label in zip(text_of, places, labels, strict=True):
                    np.minimum.at(low_at, t, at - first[t])
                    np.maximum.at(high_at, t, at - first[t])
                    for i in np.unique(t).tolist():
                        found[i].append(label)
                none = count == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, n),
                        batch.column(1).slice(a, n),
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.array(count.astype(np.int64)),
                        pa.array(low_at, mask=none),
                        pa.array(high_at.astype(np.int64), mask=none),
                        pa.array(found, type=pa.list_(pa.string())),
                    ],
                    names=[x.split()[0] for x in BASE.split(", ")],
                )

    return docs.select("doc_id", "th", "text").mapInArrow(run, BASE)


def _places(low, starts, ends, first, words: list[bytes]) -> np.ndarray:
    """Word numbers where the words stand consecutively in one text."""
    at = np.arange(max(0, len(starts) - len(words) + 1))
    for i, word in enumerate(words):
        at = at[(ends - starts)[at + i] == len(word)]
        for j, byte in enumerate(word):
            at = at[low[starts[at + i] + j] == byte]
    text_of = np.searchsorted(first, at, "right")
    return at[at + len(words) <= first[text_of]]


def notices(docs: DataFrame, templates: list[tuple[str, str]], least: float = MIN_SHARE) -> DataFrame:
    """Verified spans: doc_id, th, label, start, stop (words), share of the template found."""
    spark = docs.sparkSession
    frame = spark.createDataFrame(
        [(i, body) for i, (_, body) in enumerate(templates)], "doc_id long, text string"
    )
    sizes = spark.createDataFrame(
        [(i, len(_words(body))) for i, (_, body) in enumerate(templates)], "item long, size int"
    )
    likely = None
    for k in WINDOWS:
        table = diagonals.template_windows(diagonals.keyed(frame), canon, k)
        spared = F.col("size") - F.ceil(least * F.col("size"))
        votes = F.greatest(F.lit(1), F.col("size") - k + 1 - k * spared)
        spans = diagonals.voted(diagonals.windows(docs, canon, k), table, k).join(sizes, "item").where(F.col("votes") >= votes)
        spans = spans.select("doc_id", "th", "item", "start", "stop", "size")
        likely = spans if likely is None else likely.unionByName(spans)
    wanted = stored(
        likely.groupBy("doc_id", "th").agg(F.collect_list(F.struct("item", "start", "stop", "size")).alias("spans"))
    )
    texts = docs.alias("d").join(
        wanted.alias("w"), F.expr("d.doc_id <=> w.doc_id and d.th = w.th")
    ).select("d.doc_id", "d.th", "d.text", "w.spans")
    words = [_words(body) for _, body in templates]
    names = [label for label, _ in templates]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, th, body, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = _words(body)
                for s in spans:
                    item = words[s["item"]]
                    begin, end = max(0, s["start"] - len(item)), s["stop"] + len(item)
                    blocks = SequenceMatcher(None, item, own[begin:end], False).get_matching_blocks()
                    blocks = [m for m in blocks if m.size]
                    share = sum(m.size for m in blocks) / len(item)
                    width = blocks[-1].b + blocks[-1].size - blocks[0].b if blocks else 0
                    if share >= least and width <= 2 * len(item):
                        start = begin + blocks[0].b
                        out.append((doc_id, th, names[s["item"]], start, start + width, share))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(FOUND, row, strict=True)) for row in out], schema=FOUND_SCHEMA
            )

    return texts.mapInArrow(run, "doc_id long, th long, label string, start long, stop long, share double")


FOUND = ("doc_id", "th", "label", "start", "stop", "share")
FOUND_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("th", pa.int64()),
        ("label", pa.string()),
        ("start", pa.int64()),
        ("stop", pa.int64()),
        ("share", pa.float64()),
    ]
)


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=NOTICES) -> DataFrame:
    """One row per document: phrase counts and places, labels, score, and the verified spans."""
    texts = diagonals.keyed(docs)
    found = (
        notices(texts, templates)
        .distinct()
        .groupBy("doc_id", "th")
        .agg(
            F.collect_set("label").alias("more"),
            F.max("share").alias("share"),
            F.sort_array(F.collect_list(F.struct("start", "stop", "label", "share"))).alias("spans"),
        )
    )
    own = base(texts, phrases)
    base_labels = F.array_sort(F.array_distinct("b.found"))
    labels = F.array_sort(F.array_distinct(F.concat("b.found", F.coalesce("f.more", F.array().cast("array<string>")))))
    return own.alias("b").join(found.alias("f"), F.expr("b.doc_id <=> f.doc_id and b.th = f.th"), "left").select(
        "b.doc_id",
        "b.n_words",
        "b.n_base",
        "b.first_word",
        "b.last_word",
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("b.n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("f.share", F.lit(0.0))).alias("score"),
        "f.spans",
    )
