"""Ranked search against a plain scan, on odd rows, in small blocks and portions."""

import math
import re
from collections import Counter

import pytest
from llm_world import SF, docs, document_list, lowered, no_docs  # noqa: F401

from delaylake.llm import catalogue, lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id long, score long, block int"


def terms(text):
    return TERM.findall(lowered(text or ""))


def plain(documents, items, top=lexical.TOP):
    """Counter of (item_id, rank, doc_id, score)."""
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in documents]
    counts = [(d, c, c.total()) for d, c in counts if c]
    n, total = len(counts), sum(c[2] for c in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = Counter()
    for item_id, text in items:
        scores = []
        for doc_id, c, size in counts:
            m = 25 + (75 * size * n) // total
            score = 0
            for t in terms(text):
                if c[t]:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:top], 1):
            out[item_id, rank, doc_id, -score] += 1
    return out


def odd_items(document_list):
    given = [(i, " ".join(terms(r[1])[:30])) for i, r in enumerate(document_list[:12])]
    odd = [None, "", " .;\n", "A a A", "SHARED passage, number!", "日本語 😀", "é" * 700, "line\x00line", "w1x1 w2x2 w1x1", "zzzznowhere", "x" * 3000]
    return given + [(100 + i, t) for i, t in enumerate(odd)] + [(103, "A a A"), (None, "line other"), (7, "line other")]


@pytest.mark.parametrize(("block", "cells", "top"), [(lexical.BLOCK_BYTES, lexical.CELLS, 10), (300, 40, 3)])
def test_ranks_equal_a_plain_scan(spark, docs, document_list, monkeypatch, block, cells, top):  # noqa: F811
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical, "CELLS", cells)
    items = odd_items(document_list)
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in items], ITEMS)
    got = Counter(tuple(r) for r in lexical.ranked(docs, frame, top).collect())
    assert got == plain([r[:2] for r in document_list], items, top)


def test_given_tables(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    got = Counter(tuple(r) for r in catalogue.QUERIES["op12_lexical_search"](spark, SF).collect())
    assert got == plain(rows, items)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, "same words here") for i in range(60, 0, -1)] + [(None, "same words here"), (100, "other")]
    got = lexical.ranked(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5),
        spark.createDataFrame([(1, "words")], "item_id long, text string"),
    )
    assert [r["doc_id"] for r in got.orderBy("rank").collect()] == [None, *range(1, 10)]


def test_empty_tables(spark, no_docs, docs):  # noqa: F811
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.ranked(no_docs, items).count() == 0
    assert lexical.ranked(docs, items.where("false")).count() == 0


def test_every_whole_term_is_met_once():
    block = lexical.Block([b"a ab abc", b"b"])
    text = b"ab,a ab;abc abcd  A".translate(lexical.GUARDED).decode()
    found = Counter(n for _, n in block.automaton.iter(f" {text} "))
    assert {t: found[n] for t, n in block.numbers.items()} == {"a": 2, "ab": 2, "abc": 1, "b": 0}


