"""Conversation repair against a search over all edits, on odd rows and in runs of a few rows."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from llm_world import SF

from delaylake.llm import catalogue, conversations

ROWS = "conv_id long, turn long, role string, text string, place long, edit string, c long, seen string"


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv_id, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def cheapest(rows):
    """Uniform-cost search over (cost, audit): the first finished one is the least. rows: (role, dead, truncated)."""
    heap, done = [(0, "", 0, "^", ())], set()
    while heap:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in "^a":
            return cost, audit, list(lines)
        for role in ("user", "assistant"):
            if last + role[0] in ("^u", "su", "ua", "au"):
                heapq.heappush(heap, (cost + 2, audit + "I", i, role[0], (*lines, role + ":")))
        if i < len(rows):
            role, text, dead, truncated = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, lines))
            if not dead:
                for new, name, price in ((role, "K", 0), ("user", "R", 2), ("assistant", "R", 2)):
                    if last + new[:1] in ("^s", "^u", "su", "ua", "au"):
                        if name == "R" and new[0] == "s":
                            continue
                        heapq.heappush(heap, (cost + price + truncated, audit + name, i + 1, new[0], (*lines, f"{new}:{text}")))
    raise AssertionError


def plain_audit(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    turns = {r[1] for r in rows} - {None}
    seen, judged, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, role, text in rows:
        stripped = text.strip(" \t\n\x0b\x0c\r")
        fault = None
        if not stripped:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif stripped[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, lines = cheapest(judged)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain(rows):
    groups = {r[0]: [] for r in rows}
    for row in plain_damage(rows):
        groups[row[0]].append(row)
    return {k: plain_audit(v) for k, v in groups.items()}


def odd_rows():
    rnd = random.Random(7)
    texts = ["Fine.", "Fine!", "cut off", "Same.", "", " \n\t\x0b", None, "é?", "é.", "Who?  \r\n", "\x85", "a\nb:c."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "u", "ässistant"]
    rows = []
    for conv in range(150):
        for turn in range(rnd.randrange(0, 12)):
            odd = rnd.random() < 0.3
            role = rnd.choice(roles if odd else ["user", "assistant"])
            when = rnd.choice([None, turn * 3, 2, -5]) if odd else turn
            rows.append((conv, when, role, rnd.choice(texts) if odd else f"Text {rnd.randrange(6)}."))
    rows += [(500, t, ["user", "assistant"][t % 2], f"Turn {t // 2 * 2}.") for t in range(300)]
    rows += [(None, t % 40, "user", "No conversation") for t in range(90)]
    rows += [(501, 1, "user", "x" * 200_000 + "."), (501, 2, "assistant", "y" * 200_000)]
    rows += rows[10:30] + [(502, None, None, None)] * 70
    return rows


def compare(spark, rows, frame):
    got = {r[0]: tuple(r)[1:] for r in conversations.audit_of_damage(frame).collect()}
    assert got == plain(rows)


@pytest.mark.parametrize("bits", [1, 3, conversations.BLOCK_BITS])
def test_audit_equals_a_search_over_all_edits(spark, monkeypatch, bits):
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rows = odd_rows()
    compare(spark, rows, spark.createDataFrame([(*r, 1, "K", 2, "s") for r in rows], ROWS).repartition(3))


def test_given_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in catalogue.QUERIES["op11_conversations"](spark, SF).collect()}
    assert got == plain([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()])


def test_empty_table(spark):
    frame = spark.createDataFrame([], ROWS)
    assert conversations.audit_of_damage(frame).count() == 0
    assert conversations.repaired(frame).count() == 0


def test_repaired_rows_follow_the_pattern(spark):
    rows = odd_rows()
    out = conversations.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    groups = defaultdict(list)
    for r in out.orderBy("conv_id", "place", "step").collect():
        groups[r["conv_id"]].append(r)
    assert len(groups) > 100
    for lines in groups.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][:1] for r in lines))


def test_checkpoints_give_what_all_vectors_give():
    rnd = random.Random(3)
    for n in (1, 2, 3, 10, 100, 257):
        codes = "".join(rnd.choice("suaoSUAOxuaua") for _ in range(n))
        vectors = [conversations.END]
        for code in reversed(codes):
            vectors.append(conversations._back(code, vectors[-1]))
        _, edits = conversations._walk(codes, conversations.START, conversations.END, True)
        cost = sum(2 * len(e[:-1]) for e in edits[:-1]) + 2 * len(edits[-1])
        for code, edit in zip(codes, edits, strict=False):
            cost += 0 if code == "x" else 3 if edit[-1] == "D" else (2 if edit[-1] in "UA" else 0) + code.isupper()
        assert len(edits) == n + 1 and cost == vectors[-1][0]
