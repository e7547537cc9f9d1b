"""Operators on documents against plain Python, on odd rows."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from llm_world import SF, docs, document_list, lowered, no_docs, words  # noqa: F401

import corpus_pipeline
from delaylake.llm import decontamination, katz, licenses, passages, pieces, quality, sharding, simhash, substrings
from delaylake.llm import text as tx


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# ---- shared text helpers ---------------------------------------------------


def test_words_and_hashes_follow_the_pattern():
    texts = ["", "a bc  d", " x", "y\nz ", None, "bc"]
    data, offsets = tx.buffers(pa.array(texts))
    starts, ends, first = tx.spans(data, offsets, tx.NOT_SPACE)
    got = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert got == ["a", "bc", "d", "x", "y", "z", "bc"]
    assert np.diff(first).tolist() == [0, 3, 1, 2, 0, 1]
    h = tx.hashes(data, starts, ends)
    assert h[1] == h[6] and len(set(h.tolist())) == 6
    assert tx.hashes(np.frombuffer(b"ab" * 9 + b"ba" * 9, np.uint8), np.array([0, 18]), np.array([18, 36])).tolist()[0] != 0


def test_slices_hold_whole_texts():
    parts = list(tx.slices(pa.array(["ab", None, "c" * 10, "d"]), 4))
    assert [(a, b) for a, b, _, _ in parts] == [(0, 2), (2, 3), (3, 4)]


# ---- 1: SentencePiece ------------------------------------------------------


def test_encoding_equals_the_library(spark, docs, document_list, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    encoded = pieces.encode(docs)
    got = {(r["doc_id"], r["text"]): r for r in encoded.collect()}
    for row in document_list:
        ids = model.encode(row[1] or "")
        mine = got[row[0], row[1]]
        assert mine["ids"] == ids and mine["round_trip"] == (model.decode(ids) == (row[1] or ""))
    back = pieces.decode(encoded).select("text", "decoded").collect()
    assert all((r["text"] or "") == r["decoded"] for r in back)
    assert pieces.digest(no_docs).count() == 0 and encoded.count() == len(document_list)


@pytest.mark.parametrize("text", ["▁a", "a▁▁b", "   a   b   ", "aaaaaaa======", "\U0010ffff\u0301e"])
def test_encoding_of_marks_and_runs(text):
    path = pieces.default_model()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    encoder = pieces.Encoder(pieces.Vocabulary.load(open(path, "rb").read()))
    for _ in range(2):  # the second time from memory
        data, offsets = tx.buffers(pa.array([text]))
        ids, _, back = encoder.encode(data, offsets)
        assert ids.tolist() == model.encode(text)
        assert back.tolist() == ["▁" not in text]


def test_suffix_array_is_sorted():
    data = np.random.default_rng(1).integers(97, 100, 3000).astype(np.uint8)
    order, _ = pieces.suffix_array(data, 48)
    raw = data.tobytes()
    heads = [raw[i : i + 48] for i in order]
    assert heads == sorted(heads) and sorted(order) == list(range(3000))


# ---- 2: licenses -----------------------------------------------------------


def test_license_scan(docs, document_list, no_docs):
    import re

    rows = licenses.scan(docs).collect()
    assert len(rows) == len(document_list)
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    for doc_id, text, *_ in document_list:
        if doc_id is None:
            continue
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text or ""))
        at, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            here = [i for i in range(len(own) - len(p) + 1) if own[i : i + len(p)] == p]
            at += here
            labels |= {label} if here else set()
        r = got[doc_id]
        assert (r["n_words"], r["n_base"]) == (len(own), len(at))
        assert (r["first_word"], r["last_word"]) == (min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted(labels)) and labels <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1
    assert licenses.scan(no_docs).count() == 0


def test_edited_short_notices_are_found(spark):
    rows = [
        (1, "Words before. Licensed under the Apache Software License, Version 2.0 and words behind."),
        (2, "Words before. Licensed under a Creative Commons Attribution 3.0 International License and more."),
        (3, "Here this work is licensed under the GNU Universal Public License, version 3 as it stands."),
        (4, "Words before. Licensed under any Apache License, Edition 2.0 and words behind."),
        (5, "The apache tribe was licensed under the crown to trade in furs."),
    ]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "apache-2.0" in got[1]["labels"].split(",") and got[1]["score"] == 1.0
    assert "cc-by" in got[2]["labels"].split(",") and got[2]["score"] == pytest.approx(0.9)
    assert "gpl-3" in got[3]["labels"].split(",")
    assert "apache-2.0" in got[4]["labels"].split(",") and got[4]["score"] == 0.75
    assert got[5]["labels"] == "" and got[5]["score"] == 0


def test_notices_with_changes_are_found(spark):
    mit = licenses.NOTICES[7][1]
    changed = mit.replace("free of charge, ", "").replace("any person", "each person")
    rows = [(1, "x y z " + changed + " tail"), (2, "permission is hereby granted"), (3, mit + " " + mit)]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["labels"] == "mit" and 0.7 <= got[1]["score"] < 1
    assert got[2]["labels"] == "" and got[2]["score"] == 0
    assert got[3]["labels"] == "mit" and got[3]["score"] == 1


# ---- 4: quality ------------------------------------------------------------


def quality_counts(text):
    import re

    own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    grams = Counter(zip(own, own[1:], own[2:]))
    covered = set()
    for i in range(len(own) - 2):
        if grams[own[i], own[i + 1], own[i + 2]] > 1:
            covered |= {i, i + 1, i + 2}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(own), sum(map(len, own)), symbols, lines, len(covered)


def test_quality_counts(docs, document_list, no_docs):
    rows = quality.judged(docs).collect()
    assert len(rows) == len(document_list)
    got = defaultdict(set)
    for r in rows:
        got[r["doc_id"]].add((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]))
    for doc_id, text, *_ in document_list:
        n = quality_counts(text)
        assert (*n, n[0] < 50 or 100 * n[4] > 50 * n[0]) in got[doc_id]
    assert all(not (r["base_failed"] and r["kept"]) for r in rows)
    assert quality.judged(no_docs).count() == 0
    assert quality.clean(docs).columns == docs.columns


def test_outliers_of_a_group_go(spark):
    rng = np.random.default_rng(5)

    def text(junk):
        own = ["".join(rng.choice(list("abcdefgh"), rng.integers(3, 8))) for _ in range(rng.integers(80, 200))]
        return " ".join(w + "$$$" if junk else w for w in own)

    rows = [(i, text(i % 5 == 0), "en", "s") for i in range(200)]
    rows += [(1000 + i, text(i == 0), "en", "small") for i in range(16)]
    rows += [(2000 + i, text(i == 0), "xx", "alone") for i in range(3)]
    found = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    kept = {r["doc_id"]: r["kept"] for r in found.collect()}
    assert all(kept[i] == (i % 5 != 0) for i in range(200))
    # Too few for a model of their own: judged by their language, or by all rows.
    assert all(kept[1000 + i] == (i != 0) for i in range(16))
    assert all(kept[2000 + i] == (i != 0) for i in range(3))
    again = {r["doc_id"]: r["distance"] for r in found.collect()}
    other = quality.judged(
        spark.createDataFrame(rows[::-1], "doc_id long, text string, lang string, source string").repartition(7)
    )
    assert again == {r["doc_id"]: r["distance"] for r in other.collect()}


def plain_determinant(x):
    """The least determinant over all subsets of the nearest share, by trying all of them: (log, centre, scatter)."""
    floor = np.diag([quality.FLOOR[c] ** 2 for c in quality.STATS])
    best = None
    for subset in itertools.combinations(range(len(x)), -(-3 * len(x) // 4)):
        part = x[list(subset)]
        scatter = quality.CONSISTENT * np.cov(part.T, bias=True) + floor
        size = np.linalg.slogdet(scatter)[1]
        if best is None or size < best[0]:
            best = size, part.mean(axis=0), scatter
    return best


def test_least_determinant_equals_trying_all_subsets(spark):
    """Groups of 20: correlated with outliers that share a direction, mostly constant, and one far cluster."""
    rng = np.random.default_rng(11)
    groups = []
    for g in range(4):
        x = rng.normal(size=(20, 4)) @ np.array([[0.4, 0.1, 0, 0], [0.3, 0.2, 0, 0.1], [0, 0, 0.3, 0.2], [0, 0, 0, 0.2]])
        if g % 2:
            x[:, 1:3] = 0
        x[:4] += [[0, 2, 0, 0], [1.5, 0, 1, 0], [1, 1, 1, 1], [0.3, 0.9, 0.5, 0.2]][g]
        groups.append(np.round(x * quality.SCALE) / quality.SCALE)
    rows = [(g, *(int(round(v * quality.SCALE)) for v in r)) for g, x in enumerate(groups) for r in x]
    fit = spark.createDataFrame(rows, "g long, " + ", ".join(f"{c} long" for c in quality.STATS)).repartition(3)
    models = quality._models(fit)
    got = {r["g"]: r["logdet"] for r in models.collect()}
    d2 = Counter()
    for r in quality._distance(fit, models).collect():
        d2[r["g"], tuple(r[c] for c in quality.STATS)] = r["d2"]
    for g, x in enumerate(groups):
        size, centre, scatter = plain_determinant(x)
        assert got[g] == pytest.approx(size, abs=1e-6)
        want = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
        for row, value in zip(rows[20 * g : 20 * g + 20], want):
            assert d2[row[0], row[1:]] == pytest.approx(value, rel=1e-4, abs=1e-4)


@pytest.mark.parametrize("statistic", range(4))
def test_one_statistic_alone_can_reject(spark, statistic):
    most = {"x_length": 1.0, "x_symbols": 0.69, "x_lines": 0.69, "x_repeats": 0.49}
    rows = [(1, 1_600_000 + 1000 * (i % 40), 0, 0, 0) for i in range(60)]
    far = list(rows[0])
    far[1 + statistic] += int(list(most.values())[statistic] * quality.SCALE)
    fit = spark.createDataFrame([*rows, tuple(far)], "g long, " + ", ".join(f"{c} long" for c in quality.STATS))
    out = quality._distance(fit, quality._models(fit)).where(F.col("d2") > quality.CUTOFF).collect()
    assert [tuple(r)[:5] for r in out] == [tuple(far)]


def test_factor_is_the_cholesky_factor(spark):
    a = np.random.default_rng(2).normal(size=(9, 4))
    s = a.T @ a
    row = {f"m{i}": 0.0 for i in range(4)} | {f"s{i}{j}": float(s[i, j]) for i in range(4) for j in range(i + 1)}
    got = quality._factored(spark.createDataFrame([{"g": 1, "start": "s", "n": 9} | row])).first()
    want = np.linalg.cholesky(s)
    assert all(got[f"l{i}{j}"] == pytest.approx(want[i, j]) for i in range(4) for j in range(i + 1))


# ---- 5: language model -----------------------------------------------------


@pytest.mark.parametrize("bucket_tokens, flush_tokens", [(katz.BUCKET_TOKENS, katz.FLUSH_TOKENS), (9000, 5000)])
def test_katz_equals_the_plain_form(docs, document_list, no_docs, bucket_tokens, flush_tokens):
    found = katz.score(docs, katz.training(), bucket_tokens, flush_tokens).collect()
    assert len(found) == len(document_list)
    rows = [(i, [*words(t), "</s>"]) for i, t, *_ in document_list]
    train = [i is not None and zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    one, two = Counter(), Counter()
    for (_, t), used in zip(rows, train):
        if used:
            one.update(t)
            two.update(zip(["<s>", *t], t))
    n, texts = sum(one.values()), sum(train)
    numbers = lambda c: [sum(v == i for v in c.values()) for i in range(1, 7)]
    pd, wd = katz.katz_counts(numbers(two)), katz.katz_counts(numbers(one))
    kept = lambda r, d: d[r - 1] if r <= katz.K else r - katz.KEPT_BACK
    unknown = 1 - sum(kept(v, wd) for v in one.values()) / n
    p1 = lambda w: kept(one[w], wd) / n if one[w] else unknown
    after = defaultdict(list)
    for (h, w), r in two.items():
        after[h].append((w, r))
    size = lambda h: texts if h == "<s>" else one[h]
    alphas = {}

    def alpha(h):
        if h not in alphas:
            seen = sum(kept(r, pd) for _, r in after[h]) / size(h) if after[h] else 0
            alphas[h] = (1 - seen) / (1 - sum(p1(w) for w, _ in after[h]))
        return alphas[h]

    def p2(h, w):
        return kept(two[h, w], pd) / size(h) if two[h, w] else alpha(h) * p1(w)

    for h in ("<s>", words(document_list[0][1])[0]):
        assert sum(p2(h, w) for w in one) + alpha(h) * unknown == pytest.approx(1)
    got = defaultdict(list)
    for r in found:
        got[r["doc_id"]].append((r["n_tokens"], r["n_known"], r["held_out"], r["train_tokens"], r["base_score"], r["score"]))
    for (i, t), used in zip(rows, train):
        base = sum(math.log10((one[w] + 0.1) / (n + 0.1 * (len(one) + 1))) for w in t)
        score = sum(math.log10(p2(h, w)) for h, w in zip(["<s>", *t], t))
        want = (len(t), sum(one[w] > 0 for w in t), not used, n)
        assert any(g[:4] == want and g[4:] == pytest.approx((base, score)) for g in got[i])
    assert katz.score(no_docs, katz.training()).count() == 0


def test_nothing_to_learn_from(spark):
    only = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    rows = katz.score(only, katz.training()).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in rows] == [(0, 0), (0, 0)]
    assert all(r["base_score"] == pytest.approx(0) and r["score"] == 0 for r in rows)


def test_packed_arrays_come_back():
    arrays = [np.arange(5, dtype=np.uint16), np.zeros(0, np.int64), np.array([1.5, -2.0])]
    for a, b in zip(arrays, katz.unpack(katz.pack(*arrays)), strict=True):
        assert a.dtype == b.dtype and np.array_equal(a, b)


# ---- 6: SimHash ------------------------------------------------------------


def plain_fingerprint(text, k=3):
    own = words(text)
    shingles = [" ".join(own[i : i + k]) for i in range(len(own) - k + 1)] or ([" ".join(own)] if own else [])
    h = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0) if len(h) else np.zeros(64)
    return sum(1 << i for i in range(64) if 2 * int(bits[i]) > len(h))


def components(fps, ids, budget=3):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    v = np.array(fps, np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1 :] ^ v[i]) <= budget) + i + 1:
            root[find(int(j))] = find(i)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(v))]


def test_simhash_classes(docs, document_list, no_docs):
    fps = [plain_fingerprint(t) for _, t, *_ in document_list]
    want = Counter(
        (d[0], f"{fp:016x}", c)
        for d, fp, c in zip(document_list, fps, components(fps, [d[0] for d in document_list]))
    )
    assert bag(simhash.dedup_classes(docs), "doc_id", "fingerprint", "component_id") == want
    assert simhash.dedup_classes(no_docs).count() == 0


def test_trie_join_equals_all_pairs(spark):
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = [int(c) for c in centres]
    for c in centres:
        for _ in range(6):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            values.append(int(c) ^ sum(1 << int(f) for f in flips))
    values = sorted(set(values))
    v = np.array(values, np.uint64)
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 3}
    frame = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long")
    got = [tuple(int(np.int64(x).view(np.uint64)) for x in r) for r in simhash.links(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    i, j = (np.concatenate(x) for x in zip(*simhash.trie_pairs(v, 3, 0)))
    assert {(values[a], values[b]) for a, b in zip(i, j)} | {(values[b], values[a]) for a, b in zip(i, j)} >= want


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[100] == got[101] == 100
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_five_word_shingles(spark, docs, document_list, no_docs):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(30):
        own = [f"{'abcdefgh'[rng.integers(8)]}{rng.integers(10**6)}" for _ in range(200)]
        for c in range(1 + g % 4):
            changed = list(own)
            for at in rng.choice(200, c, replace=False):
                changed[at] = f"z{rng.integers(10**6)}"
            rows.append((100 * g + c, " ".join(changed), "en"))
    kept = simhash.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, keep string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [100 * g for g in range(30)]
    left = simhash.without_near_duplicates(docs)
    assert left.columns == docs.columns
    texts = Counter(r["text"] for r in left.collect())
    assert max(texts.values()) == 1
    assert simhash.without_near_duplicates(no_docs).count() == 0


def test_all_members_of_a_key_are_compared(spark, monkeypatch):
    """Clusters with one key in turn: a link must not depend on the neighbours in arrival order."""
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 2**64, (40, simhash.WIDE), dtype=np.uint64)
    fps = np.concatenate([centre] * 3)
    for row in fps:
        row[rng.integers(1, simhash.WIDE)] ^= np.uint64(rng.integers(1, 2**20))
    fps[:, 0] = np.uint64(7 | 9 << 32)
    fps[80:, 0] ^= np.uint64(1)
    group = int(simhash._wide_key(fps[:1], 0)[0]) >> (simhash.KEY - simhash.PREFIX)
    want = {frozenset((i, i + 40, i + 80)) for i in range(40)}

    def named(edges):
        out = defaultdict(set)
        table = components_of(edges, 120)
        for i, root in enumerate(table):
            out[root].add(i)
        return set(map(frozenset, out.values()))

    a, b = simhash._wide_edges(group, np.arange(120), fps, simhash.WIDE_BUDGET)
    assert named(zip(a.tolist(), b.tolist())) == want
    monkeypatch.setattr(simhash, "LEAST_PART", 16)
    rows = [(bytes(fp), i, 1, i) for i, fp in enumerate(fps)]
    frame = spark.createDataFrame(rows, "fp binary, first long, size long, named long")
    assert named((r["a"], r["b"]) for r in simhash._wide_links(frame, simhash.WIDE_BUDGET).collect()) == want


def components_of(edges, n):
    root = list(range(n))
    for a, b in edges:
        old, new = root[a], root[b]
        root = [new if r == old else r for r in root]
    return root


def test_only_similar_texts_go(spark):
    """Against all pairs: similarities from 0.6 to 0.9, chains of them, and one text with a line many times."""
    rng = np.random.default_rng(8)
    texts = []
    for g in range(12):
        own = [f"w{rng.integers(10**6)}" for _ in range(200)]
        for c in (0, 3, 5, 8, 9, 10):
            changed = list(own)
            for at in rng.choice(200, c, replace=False):
                changed[at] = f"z{rng.integers(10**6)}"
            texts.append(" ".join(changed))
    texts += [" ".join(["one line that is said again"] * 40 + [f"own{i}x{k}" for k in range(30)]) for i in range(3)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    edges = [
        (i, j)
        for i in range(len(texts))
        for j in range(i)
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    ]
    root = components_of(edges, len(texts))
    want = {min(i for i in range(len(texts)) if root[i] == r) for r in root}
    kept = simhash.without_near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == want


# ---- 7: repeated strings ---------------------------------------------------


def plain_removal(texts, length=400):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        covered, end = bytearray(len(t)), 0
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                a = max(end, i)
                covered[a : i + length] = b"\1" * (i + length - a)
                end = i + length
        kept = bytes(b for b, c in zip(t, covered) if not c)
        runs = sum(covered[j] and (j == 0 or not covered[j - 1]) for j in range(len(t)))
        out.append((len(t), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeated_strings_go(docs, document_list, no_docs):
    want = Counter(
        (d[0], *w) for d, w in zip(document_list, plain_removal([(d[1] or "").encode() for d in document_list]))
    )
    got = bag(substrings.deduplicated(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == want
    assert substrings.deduplicated(no_docs).count() == 0
    clean = substrings.clean(docs)
    assert clean.columns == docs.columns and clean.count() == len(document_list)


def plain_passage_words(texts, length=51):
    holders = defaultdict(set)
    split = [re.findall(rb"[^\x20\x09-\x0D]+", t) for t in texts]
    for row, w in enumerate(split):
        for i in range(len(w) - length + 1):
            holders[tuple(w[i : i + length])].add(row)
    out = []
    for w in split:
        covered = set()
        for i in range(len(w) - length + 1):
            if len(holders[tuple(w[i : i + length])]) > 1:
                covered |= set(range(i, i + length))
        out.append(len(covered))
    return out


def passage_texts():
    rng = np.random.default_rng(13)
    words = lambda n: [f"{'abcdefgh'[rng.integers(8)]}{rng.integers(10**4)}" for _ in range(n)]
    texts = []
    for n in (50, 51, 52, 60, 140):
        passage = words(n)
        texts += [" ".join(words(rng.integers(0, 90)) + passage + words(rng.integers(0, 90))) for _ in range(3)]
    inner = words(70)
    texts += [" ".join(inner + words(9) + inner), texts[4].replace(" ", " \t\n"), texts[13], "é " * 51, "a " * 300]
    # A fragment that several texts share whole, and a second place of it in one of them.
    twice = words(400)
    texts += [" ".join(twice), " ".join(twice + words(20)), " ".join(words(5) + twice + words(8) + twice[30:110])]
    return texts


@pytest.mark.parametrize("gram", [1, 17, 51])
def test_passages_of_over_fifty_words_are_counted(spark, gram):
    texts = passage_texts()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in substrings.deduplicated(frame, shared=passages.shared_words(frame, gram=gram)).collect()}
    want = plain_passage_words([t.encode() for t in texts])
    assert [got[i]["n_passage_words"] for i in range(len(texts))] == want
    assert want[:3] == [0, 0, 0] and min(want[3:6]) >= 51
    # Below 400 bytes nothing goes, yet the passage shows.
    assert got[3]["n_removed"] == 0


def test_passages_of_odd_rows(spark, docs, document_list, no_docs):
    want = Counter((d[0], n) for d, n in zip(document_list, plain_passage_words([(d[1] or "").encode() for d in document_list])))
    got = substrings.deduplicated(docs, shared=passages.shared_words(docs))
    assert bag(got, "doc_id", "n_passage_words") == want
    assert bag(got.drop("n_passage_words"), "*") == bag(substrings.deduplicated(docs), "*")
    assert passages.shared_words(no_docs).count() == 0


def test_the_pipeline_removes_passages_of_fifty_words(spark):
    rng = np.random.default_rng(12)
    noise = lambda n: " ".join(f"{'abcdefgh'[rng.integers(8)]}{rng.integers(10**5)}" for _ in range(n))
    passage = " ".join(f"{'klmnop'[rng.integers(6)]}{rng.integers(1000, 9999)}" for _ in range(51))
    assert 250 < len(passage) < 400
    texts = [f"{noise(80)} {passage} {noise(80)}" for _ in range(2)] + [noise(100)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_strings(spark, frame, SF).collect()}
    assert left[2] == texts[2]
    for i in (0, 1):
        assert passage not in left[i] and len(left[i]) <= len(texts[i]) - len(passage)


@pytest.mark.parametrize("group", [1, substrings.GROUP])
def test_large_groups_are_dealt_on(spark, group):
    """Passages with other words around, for ranges down to single windows."""
    rng = np.random.default_rng(11)
    noise = lambda n: "".join(rng.choice(list("abcdefghij "), n))
    passages = [noise(n) for n in (399, 400, 401, 520, 900)]
    texts = [noise(rng.integers(0, 300)) + p + noise(rng.integers(0, 300)) for p in passages for _ in range(4)]
    texts += [noise(500) for _ in range(5)] + ["ab" * 900, "c" * 450, texts[0]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    from pyspark.sql import functions as F

    base = frame.withColumn("th", F.xxhash64("text"))
    spans, _ = substrings.repeated_spans(base, group=group)
    covered = defaultdict(set)
    for r in spans.collect():
        covered[r["doc_id"]] |= set(range(r["start"], r["stop"]))
    want = plain_removal([t.encode() for t in texts])
    assert [len(covered[i]) for i in range(len(texts))] == [w[1] for w in want]


def test_suffix_sort_by_hashes():
    data = np.frombuffer(b"".join(bytes([97 + (i * i) % 3]) for i in range(600)) * 2, np.uint8)
    sorter = substrings.SuffixSorter(np.concatenate([data, np.zeros(50, np.uint8)]), 50)
    suffix = np.arange(0, 1200, 3)
    begin = np.repeat([0, 150], [150, 250])
    size = np.repeat([150, 250], [150, 250])
    order = sorter.sort(suffix, begin, size)
    raw = sorter.data.tobytes()
    for a, b in ((0, 150), (150, 400)):
        heads = [raw[i : i + 50] for i in suffix[order[a:b]]]
        assert heads == sorted(heads) and sorted(order[a:b]) == list(range(a, b))


# ---- 9: decontamination ----------------------------------------------------

ITEM = (
    "Anna bought 12 apples for 3 dollars each and then Anna gave 5 apples to her brother who lives 40 km "
    "away from the market in the old town near the river"
)


def test_leaks_are_found_again(spark, docs, no_docs):
    again = ITEM.replace("Anna", "Peter").replace("12", "77").replace("40 km", "9 miles").replace("5", "31")
    mixed = ITEM.replace("Anna", "Peter", 1).replace("12 apples", "12 pears")
    rows = [
        (1, "Some words before it. " + ITEM + " and some behind."),
        (2, "Other words here, all clean and of no use to anyone at all in this place."),
        (3, "First line.\n" + again + " tail words"),
        (4, ITEM.replace("apples to her brother who", "of them to somebody that")),
        (None, ITEM),
        (5, None),
        (6, mixed),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(10, ITEM), (11, None), (12, ""), (13, "only three words"), (None, ITEM)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontamination.leaks(frame, bench).collect()}
    assert {k for k in got if k[1] == 10} == {(1, 10), (3, 10), (4, 10), (None, 10), (6, 10)}
    assert got[1, 10]["kind"] == "verbatim" and got[1, 10]["share"] == 1
    assert got[3, 10]["kind"] == "changed" and got[3, 10]["share"] >= 0.9
    assert {r["doc_id"] for r in decontamination.clean(frame, bench).collect()} == {2, 5}
    empty = bench.where("false")
    assert decontamination.leaks(frame, empty).count() == 0 and decontamination.leaks(no_docs, bench).count() == 0
    assert decontamination.clean(docs, empty).count() == docs.count()


def test_items_of_numbers_names_and_units_are_found(spark):
    sum_ = "What is 12 + 7 * 3 - 5?"
    heavy = "List: 3 kg 14 cm 15 min 92 km 65 mg and 35 ml, 89 kg or 79 cm for Anna Berta Carl Dora"
    rows = [
        (1, "Some words before it. " + sum_ + " And some behind."),
        (2, "Some words before it. What was 3 + 4 * 9 - 1? And some behind."),
        (3, "Words in front, then " + heavy + " and some behind."),
        (4, "in front of it what is 12 7 3 5 and some behind"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(10, sum_), (11, heavy)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontamination.leaks(frame, bench).collect()}
    assert got == {(1, 10): "verbatim", (3, 11): "verbatim", (4, 10): "verbatim"}


def test_slots_must_be_filled_consistently():
    item = decontamination._one("the teacher Anna gave Berta the key and Anna told Berta to lock the blue door")
    good = decontamination._one("the teacher Carl gave Dora the key and Carl told Dora to lock the blue door")
    bad = decontamination._one("the teacher Carl gave Dora the key and Emil told Fred to lock the blue door")
    compare = lambda text: decontamination._compared(item, text, 0, len(text[0]), 0.6, 0.8)
    assert compare(good)["kind"] == "changed" and compare(bad) is None


def test_leaks_of_the_given_tables(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(rows, bench).collect()}
    want = {(d["doc_id"], b["item_id"]) for d in rows.collect() for b in bench.collect() if b["text"] in (d["text"] or "")}
    assert want <= got


# ---- 10: sharding ----------------------------------------------------------


@pytest.mark.parametrize("block_units", [sharding.BLOCK_UNITS, 16])
def test_shards(docs, document_list, no_docs, block_units):
    found = sharding.shard(docs, 24, block_units=block_units, cell_rows=10)
    rows = found.collect()
    want = Counter((d[0], len((d[1] or "").encode()) + 8, zlib.crc32((d[1] or "").encode())) for d in document_list)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
    assert sharding.shard(no_docs, 24).count() == 0


def test_equal_texts_stay_together_and_sizes_are_near(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "t%d " % (i // 2) * int(rng.integers(1, 400))) for i in range(2000)]
    rows = [(i, rows[i - i % 2][1]) for i, _ in rows]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 24, block_units=300).collect()
    by_text, sizes = defaultdict(set), Counter()
    for r in found:
        by_text[r["text_crc32"], r["size"]].add(r["shard"])
        sizes[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in by_text.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * sum(sizes.values()) / 24


def test_a_text_larger_than_a_shard_is_split(spark):
    rows = [(i, "same text " * 30) for i in range(3000)] + [(9000 + i, f"text {i} " * 20) for i in range(3000)]
    sizes = Counter()
    for r in sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 24).collect():
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) < 1.2 * sum(sizes.values()) / 24


def test_differencing_of_numbers():
    parts = sharding.difference(np.array([[v, 0] for v in (8, 7, 6, 5, 4)]))[:, 0]
    sums = [sum(v for v, p in zip((8, 7, 6, 5, 4), parts) if p == i) for i in (0, 1)]
    assert abs(sums[0] - sums[1]) == 2
