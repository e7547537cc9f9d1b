"""Leaks of the given tables against every text compared with every item at every place."""

import re
from collections import Counter, defaultdict
from difflib import SequenceMatcher

from llm_world import SF

from delaylake.llm import decontamination

WORD = re.compile(r"(?:[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]|(?<=[0-9])[.,](?=[0-9]))+")
CAPITALS = {*map(chr, range(65, 91)), *map(chr, range(0xC0, 0xDF))} - {"\xd7"}


def plain_words(text):
    """(word, kind, word or placeholder) of a text, by the rules of the module's docstring."""
    out = []
    for m in WORD.finditer(text or ""):
        at, word = m.start(), "".join(chr(ord(c) + 32) if c in CAPITALS else c for c in m.group())
        kind = "unit" if word in decontamination.UNITS else None
        if at >= 2 and text[at] in CAPITALS and text[at - 1] == " " and text[at - 2] not in "\n\r!.:?":
            kind = "name"
        if "0" <= word[0] <= "9":
            kind = "number"
        out.append((word, kind, f"<{kind}>" if kind else word))
    return out


def steady(slots):
    """Equal values filled by equal ones: the least share of slots that agree, seen from either side."""
    shares = []
    for a, b in ((0, 1), (1, 0)):
        partners = defaultdict(Counter)
        for slot in slots:
            partners[slot[2], slot[a]][slot[b]] += 1
        shares.append(sum(max(c.values()) for c in partners.values()) / len(slots))
    return min(shares)


def is_leak(item, text):
    """Do 0.6 of the item's words stand in order, with steady slots, or all words as they are?"""
    size = len(item)
    for part, share in ((2, 0.6), (0, 1)):
        asked, given = [w[part] for w in item], [w[part] for w in text]
        blocks = SequenceMatcher(None, asked, given, False).get_matching_blocks()
        pairs = [(b.a + i, b.b + i) for b in blocks for i in range(b.size)]
        if len(pairs) < share * size or pairs[-1][1] - pairs[0][1] >= 2 * size:
            continue
        slots = [(item[i][0], text[j][0], item[i][1]) for i, j in pairs if item[i][1]]
        if not slots or steady(slots) >= 0.8:
            return True
    return False


def places(item, text):
    """Begin of each stretch of three times the item that holds enough of its words, in any order."""
    size, need = len(item), Counter(w[2] for w in item)
    held, common = Counter(), 0
    for end in range(len(text) + 2 * size):
        if end < len(text):
            word = text[end][2]
            held[word] += 1
            common += held[word] <= need[word]
        if end >= 3 * size and end - 3 * size < len(text):
            word = text[end - 3 * size][2]
            common -= held[word] <= need[word]
            held[word] -= 1
        if common >= 0.6 * size:
            yield max(0, end + 1 - 3 * size)


def brute_force(docs, items):
    texts = {d: plain_words(t) for d, t in docs}
    bags = {d: Counter(w[2] for w in words) for d, words in texts.items()}
    found = set()
    for item_id, body in items:
        item = plain_words(body)
        need, size = Counter(w[2] for w in item), len(item)
        for doc_id, text in texts.items():
            if not size or sum((need & bags[doc_id]).values()) < 0.6 * size:
                continue
            starts = set(places(item, text))
            if any(is_leak(item, text[s : s + 3 * size]) for s in sorted(starts)):
                found.add((doc_id, item_id))
    return found


def test_words_and_placeholders_are_the_same():
    for text in ("The shop sold 1,200.5 kg to Anna. Then Bert (Carl) left: Dora \xc4nne \xd7 km", "A", "", "Z\xdcrich 3x a.b 4.c"):
        own, kind, _ = decontamination._one(text)
        plain = plain_words(text)
        names = {None: 0, "number": 1, "name": 2, "unit": 3}
        assert [names[k] for _, k, _ in plain] == kind and len(own) == len(plain), text
        assert len(set(own)) == len({w for w, _, _ in plain})


def test_leaks_equal_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, items).collect()}
    plain = [[(r[0], r[1]) for r in df.select(key, "text").collect()] for df, key in ((docs, "doc_id"), (items, "item_id"))]
    want = brute_force(*plain)
    assert want and got == want
