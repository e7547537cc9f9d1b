"""Confirmation of near-duplicates: exact, and without all pairs of a template; scratch tables of stages."""

import numpy as np
import pytest
from llm_world import SF, words

from delaylake.llm import simhash, store


def template_rows(n, changes, seed=4):
    """Texts of one template, each with words of its own in a few places."""
    rng = np.random.default_rng(seed)
    own = [f"t{i}" for i in range(200)]
    texts = []
    for _ in range(n):
        changed = list(own)
        for at in rng.choice(np.arange(2, 198, 6), changes, replace=False):
            changed[at] = f"z{rng.integers(10**9)}"
        texts.append(" ".join(changed))
    return texts


def shingle_set(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}


def similar_pairs(texts):
    sets = [shingle_set(t) for t in texts]
    return {(i, j) for j in range(len(sets)) for i in range(j) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}


def prefix_pairs(spark, texts):
    frame = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "id long, text string, named long")
    sets = store.stored(simhash._shingle_sets(frame, 5))
    found = simhash._prefix_pairs(sets, simhash._rarity(sets)).collect()
    return {(r["a"], r["b"]) for r in found}


@pytest.mark.parametrize("changes", [2, 4, 5])
def test_prefixes_miss_no_similar_pair(spark, changes):
    texts = template_rows(40, changes) + ["", "one", "one two", "t0 t1 t2 t3 t4 t5 t6"] + template_rows(10, changes, 9)
    assert similar_pairs(texts) <= prefix_pairs(spark, texts)


def test_a_template_just_below_the_bound_gives_few_candidates(spark):
    """400 texts, each pair at a similarity of about 0.76: 79,800 pairs, of which hardly any is compared."""
    texts = template_rows(400, 6)
    assert not similar_pairs(texts[:60])
    assert len(prefix_pairs(spark, texts)) < 400
    kept = simhash.without_near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert kept.count() == 400


def test_given_documents_equal_the_exact_join(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    root = list(range(len(rows)))
    for i, j in sorted(similar_pairs([r["text"] or "" for r in rows])):
        a, b = root[i], root[j]
        root = [min(a, b) if r in (a, b) else r for r in root]
    want = {rows[r]["doc_id"] for r in set(root)}
    kept = simhash.without_near_duplicates(spark.read.parquet(f"{SF}/documents.parquet"))
    assert {r["doc_id"] for r in kept.collect()} == want


def test_scratch_of_a_stage_goes_with_the_next_one(spark, tmp_path):
    def tables(paths):
        return [p for p in paths if spark._jvm.java.io.File(p).exists()]

    with store.stage(spark.range(3)):
        first = store.stored(spark.range(5))
    (path,) = store._LEFT[spark.sparkContext.applicationId]
    first.write.parquet(str(tmp_path / "out"))
    # Read lazily by the next stage: it stays.
    with store.stage(first):
        second = store.stored(first.where("id > 1"))
    assert tables([path]) and second.count() == 3
    # Written and read again: both go.
    left = list(store._LEFT[spark.sparkContext.applicationId])
    with store.stage(spark.read.parquet(str(tmp_path / "out"))):
        pass
    assert len(left) == 2 and not tables(left)
