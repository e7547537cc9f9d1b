"""Repair of the turn structure of conversations: the cheapest edits to ``(s?(ua)+)?``.

The rows of a conversation are put in order of turn (nulls first), then role,
then text. A row is *blank* without a character other than space, tab, \\n, \\v,
\\f, \\r; else *duplicate* if role and text were seen earlier in the conversation;
else *truncated* if its last such character is not one of ``.!?``. Edits: Keep
(0), Rerole to user or assistant (2), Delete (3, required for blank and
duplicate), Insert an empty user or assistant row (2); a truncated row that stays
adds 1. The cheapest edits are taken, among them those whose initials are least
in ASCII, so that the initials of the roles match the pattern.

**Method.** Square-root checkpointed dynamic programme. The state is what the
last kept role was (start, s, u, a); the backward vector of a row holds the least
cost from there to the end, by state. A run of n rows keeps the vectors of every
sqrt(n)-th row only; the walk forward recomputes one block of vectors at a time
and takes the least letter that is tight.

**On Spark.** Equal rows are counted before they move; copies beyond the first
are deletions, carried as a count. The distinct rows are sorted by range of
(conversation, turn, role, first characters), so a conversation of any length is
spread over many tasks, and numbered. Every 2^BLOCK_BITS numbers form a run, of which
only one code per row is gathered. For conversations of several runs, each run
gives its 4 x 4 costs; these are chained from the end (the checkpoints between
runs), then each run gives its exits, which are chained from the start. What one
task holds of a conversation is one run of codes, or 20 numbers per run.

**Defined results.** A null role or text counts as one space, a null turn comes
first, a null conversation id is a conversation. An empty role has no fitting
initial. Further columns are ignored; an empty table gives no rows. Texts are
never cut. Equal rows are copies: the first is judged, the others are duplicates.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylake.llm.store import stored

#: A run of rows has 2^BLOCK_BITS numbers; one task holds it, as one character and one number per row.
BLOCK_BITS = 16
#: Characters of a text that take part in dealing rows to ranges; ranges are sorted by whole texts.
DEALT = 64

#: Costs, and the states start, after s, after u, after a.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEVER = 1 << 60
END = (0, 4, 2, 0)
#: State after a role's initial, by state; None where the pattern forbids it.
AFTER = {
    "s": (AFTER_S, None, None, None),
    "u": (AFTER_U, AFTER_U, None, AFTER_U),
    "a": (None, None, AFTER_A, None),
}
#: The only role that can be put in at a state.
FREE = ("u", "u", "a", "u")
NAMES = {"u": "user", "a": "assistant"}

#: Codes: s u a o as the initial of a fine row, upper case of a truncated one, x of a row that must go.
DEAD = "x"


def _back(code: str, nxt: tuple) -> tuple:
    """The vector of a row from the vector of the next one; a row that must go costs nothing here."""
    if code == DEAD:
        base = nxt
    else:
        extra = TRUNCATED if code.isupper() else 0
        keep = AFTER.get(code.lower())
        base = []
        for state in range(4):
            cost = DELETE + nxt[state]
            if keep and keep[state] is not None:
                cost = min(cost, extra + nxt[keep[state]])
            base.append(min(cost, REROLE + extra + nxt[AFTER[FREE[state]][state]]))
    after_u = min(base[AFTER_U], INSERT + base[AFTER_A])
    after_a = min(base[AFTER_A], INSERT + base[AFTER_U])
    return (
        min(base[START], INSERT + after_u),
        min(base[AFTER_S], INSERT + after_u),
        after_u,
        after_a,
    )


def _walk(codes: str, state: int, last: tuple, final: bool) -> tuple[int, list[str]]:
    """State behind a run of rows and its edits: per row the letters of inserted roles (u, a), then K, D, or U, A for a new role.

    ``last`` is the vector behind the run. With ``final`` the walk goes on to the
    end of the conversation; the roles put in there are one more entry.
    """
    n = len(codes)
    step = max(1, math.isqrt(n))
    marks = [last]
    vector = last
    for i in range(n - 1, -1, -1):
        vector = _back(codes[i], vector)
        if i % step == 0:
            marks.append(vector)
    marks.reverse()  # marks[k] is the vector of row k * step, the last one that behind the run
    edits = []
    for k, first in enumerate(range(0, n, step)):
        past = min(first + step, n)
        block = [marks[k + 1]]
        for i in range(past - 1, first, -1):
            block.append(_back(codes[i], block[-1]))
        block.append(marks[k])
        block.reverse()
        for i in range(first, past):
            code, here, nxt, put = codes[i], block[i - first], block[i - first + 1], ""
            while True:
                cost = here[state]
                if cost == nxt[state] + (0 if code == DEAD else DELETE):
                    edits.append(put + "D")
                    break
                role = FREE[state]
                behind = AFTER[role][state]
                if cost == INSERT + here[behind]:
                    put, state = put + role, behind
                    continue
                extra = TRUNCATED if code.isupper() else 0
                kept = AFTER.get(code.lower(), (None,) * 4)[state]
                if kept is not None and cost == extra + nxt[kept]:
                    edits.append(put + "K")
                    state = kept
                else:
                    edits.append(put + role.upper())
                    state = behind
                break
    if final:
        put = ""
        while last[state]:
            put += FREE[state]
            state = AFTER[FREE[state]][state]
        edits.append(put)
    return state, edits


@lru_cache(maxsize=1 << 14)
def _short(codes: str) -> tuple[int, list[str]]:
    return _walk(codes, START, END, True)


def _costs(codes: str) -> list[int]:
    """Sixteen costs: from every state before a run to every state behind it."""
    out = []
    for target in range(4):
        vector = tuple(0 if s == target else NEVER for s in range(4))
        for code in reversed(codes):
            vector = _back(code, vector)
        out += vector
    return out


def prepared(rows: DataFrame) -> DataFrame:
    """Columns conv_id, turn, role, text; nulls of role and text are one space."""
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )


def _blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def lined(rows: DataFrame) -> DataFrame:
    """Distinct rows of conversations in order, numbered, with their fault and their copies; written.

    ``fault`` is blank, duplicate, truncated or null; of several copies it is that
    of the first, the others are duplicates (of a blank row: blank).
    """
    distinct = prepared(rows).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    distinct = stored(distinct.withColumn("seen", F.sha2("text", 256)))
    # Where the text was first seen: null turns come first, and min() leaves nulls out.
    first = (
        distinct.groupBy("conv_id", "role", "seen")
        .agg(F.min("turn").alias("early"), F.bool_or(F.col("turn").isNull()).alias("at_null"))
        .select(
            F.col("conv_id").alias("c"),
            F.col("role").alias("r"),
            F.col("seen").alias("s"),
            F.when(~F.col("at_null"), F.col("early")).alias("first_turn"),
        )
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("seen") == F.col("s"))
    end = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*+\z", 1)
    fault = (
        F.when(_blank(F.col("text")), "blank")
        .when(~F.col("turn").eqNullSafe(F.col("first_turn")), "duplicate")
        .when(~end.isin(".", "!", "?"), "truncated")
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    return stored(
        distinct.join(first, same)
        .select("conv_id", "turn", "role", "text", fault.alias("fault"), "copies")
        .repartitionByRange(*order, F.substring("text", 1, DEALT))
        .sortWithinPartitions(*order, "text")
        .withColumn("place", F.monotonically_increasing_id())
    )


def _runs(rows: DataFrame) -> DataFrame:
    """A row per run: conv_id, block, its first place, its codes in order, its places."""
    initial = F.substring("role", 1, 1)
    live = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = (
        F.when(F.col("fault").isin("blank", "duplicate"), DEAD)
        .when(F.col("fault") == "truncated", F.upper(live))
        .otherwise(live)
    )
    entry = F.struct("place", code.alias("code"))
    return (
        rows.groupBy("conv_id", F.shiftright("place", BLOCK_BITS).alias("block"))
        .agg(F.array_sort(F.collect_list(entry)).alias("rows"))
        .select(
            "conv_id",
            "block",
            F.concat_ws("", F.col("rows.code")).alias("codes"),
            F.col("rows.place").alias("places"),
        )
    )


def _with_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs = [_costs(c) for c in batch["codes"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["conv_id"], batch["block"], pa.array(costs, pa.list_(pa.int64()))], ["conv_id", "block", "costs"]
        )


def _ends(group: pd.DataFrame) -> pd.DataFrame:
    """The vector behind each run of a conversation, from the last run to the first."""
    group = group.sort_values("block", ascending=False)
    vector, found = END, []
    for costs in group["costs"]:
        found.append(list(vector))
        vector = tuple(min(int(costs[4 * t + s]) + vector[t] for t in range(4)) for s in range(4))
    return group[["conv_id", "block"]].assign(last=found)


def _with_exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch["codes"].to_pylist(), batch["last"].to_pylist(), strict=True)
        exits = [[_walk(codes, s, tuple(last), False)[0] for s in range(4)] for codes, last in pairs]
        columns = [batch["conv_id"], batch["block"], batch["last"], pa.array(exits, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "block", "last", "exits"])


def _entries(group: pd.DataFrame) -> pd.DataFrame:
    """The state before each run of a conversation, from the first run to the last."""
    group = group.sort_values("block")
    state, found = START, []
    for exits in group["exits"]:
        found.append(state)
        state = int(exits[state])
    final = [False] * (len(group) - 1) + [True]
    return group[["conv_id", "block", "last"]].assign(state=found, final=final)


def _with_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        edits = []
        states, lasts = batch["state"].to_pylist(), batch["last"].to_pylist()
        finals = batch["final"].to_pylist()
        for codes, state, last, final in zip(batch["codes"].to_pylist(), states, lasts, finals, strict=True):
            if state is None:
                found = _short(codes)[1] if len(codes) <= 32 else _walk(codes, START, END, True)[1]
                final = True
            else:
                found = _walk(codes, state, tuple(last), final)[1]
            edits.append(found if final else [*found, ""])
        yield pa.RecordBatch.from_arrays(
            [batch["places"], pa.array(edits, pa.list_(pa.string()))], ["places", "edits"]
        )


def edited(rows: DataFrame) -> DataFrame:
    """Numbered rows with ``edit`` (roles put in before, then K, D, U or A) and ``tail`` (roles put in behind).

    Columns conv_id, place, turn, role, text, fault, copies, edit, tail. Only the
    first copy has the edit; the others are deleted. Roles put in are letters u, a.
    """
    rows = lined(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    runs = stored(_runs(rows))
    many = runs.groupBy(F.col("conv_id").alias("c")).agg(F.count("*").alias("n")).where("n > 1").select("c")
    long = runs.join(many, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    costs = long.select("conv_id", "block", "codes").mapInArrow(_with_costs, f"conv_id {kind}, block long, costs array<long>")
    ends = costs.groupBy("conv_id").applyInPandas(_ends, f"conv_id {kind}, block long, last array<long>")
    ends = ends.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "last")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    exits = (
        long.join(ends, same)
        .select("conv_id", "block", "codes", "last")
        .mapInArrow(_with_exits, f"conv_id {kind}, block long, last array<long>, exits array<long>")
    )
    entries = exits.groupBy("conv_id").applyInPandas(
        _entries, f"conv_id {kind}, block long, last array<long>, state long, final boolean"
    )
    entries = stored(entries.withColumnsRenamed({"conv_id": "c", "block": "b"}))
    edits = (
        runs.join(entries, same, "left")
        .select("codes", "places", "last", "state", "final")
        .mapInArrow(_with_edits, "places array<long>, edits array<string>")
        .select("places", "edits", F.posexplode("places").alias("i", "at"))
        .select(
            "at",
            F.expr("edits[i]").alias("edit"),
            F.expr("if(i = size(places) - 1, edits[i + 1], '')").alias("tail"),
        )
    )
    return rows.join(edits, F.col("place") == F.col("at")).drop("at")


def _put(letters: str) -> str:
    roles = "if(r = 'u', 'user', 'assistant')"
    return f"transform(regexp_extract_all({letters}, '[ua]', 0), r -> struct({roles} as role, '' as text))"


def repaired(rows: DataFrame) -> DataFrame:
    """The rows that stand after the repair: conv_id, place, step, role, text.

    Order within a conversation is (place, step). Rows put in have an empty text.
    """
    own = (
        "case right(edit, 1) when 'K' then array(struct(role, text)) when 'U' then array(struct('user' as role, text)) "
        "when 'A' then array(struct('assistant' as role, text)) else array() end"
    )
    lines = edited(rows).withColumn("lines", F.expr(f"concat({_put('edit')}, {own}, {_put('tail')})"))
    return lines.select("conv_id", "place", F.posexplode("lines").alias("step", "line")).select(
        "conv_id", "place", "step", "line.role", "line.text"
    )


class _Audit:
    """The figures of one conversation, fed row by row in order."""

    def __init__(self):
        self.low = self.high = self.turn = self.initial = None
        self.turns = self.illegal = self.cost = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.letters, self.hash, self.lines = [], hashlib.sha256(), 0

    def _line(self, role: bytes, text: bytes) -> None:
        if self.lines:
            self.hash.update(b"\n")
        self.lines += 1
        self.hash.update(role)
        self.hash.update(b":")
        self.hash.update(text)

    def _insert(self, roles: str) -> None:
        for letter in roles:
            self._line(NAMES[letter].encode(), b"")
            self.letters.append("I")
        self.cost += INSERT * len(roles)

    def row(self, turn, role: bytes, text: bytes, fault, copies: int, edit: str, tail: str) -> None:
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.turns += turn != self.turn
            self.high = self.turn = turn
        initial = role.decode("utf-8", "replace")[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.illegal += copies - 1
        if fault:
            self.faults[fault] += 1
        self.faults["blank" if fault == "blank" else "duplicate"] += copies - 1
        self._insert(edit[:-1])
        kind = edit[-1]
        if kind == "D":
            self.cost += DELETE
            self.letters.append("D")
        else:
            self.cost += (REROLE if kind in "UA" else 0) + (TRUNCATED if fault == "truncated" else 0)
            self.letters.append("R" if kind in "UA" else "K")
            self._line(NAMES[kind.lower()].encode() if kind in "UA" else role, text)
        self.cost += DELETE * (copies - 1)
        self.letters.append("D" * (copies - 1))
        self._insert(tail)

    def figures(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = (gaps, *self.faults.values(), self.illegal, self.cost)
        return (*counts, "".join(self.letters), self.hash.hexdigest())


FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come conversation by conversation, in order; of a conversation only its figures are held."""
    names = ["conv_id", *(c.split()[0] for c in FIGURES.split(", "))]
    current, open_id, kind = None, None, None
    for batch in batches:
        done = []
        kind = batch.schema.field("conv_id").type
        for conv_id, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if current is None or conv_id != open_id:
                if current is not None:
                    done.append((open_id, *current.figures()))
                current, open_id = _Audit(), conv_id
            current.row(*row)
        yield _figures(done, names, kind)
    if current is not None:
        yield _figures([(open_id, *current.figures())], names, kind)


def _figures(done: list[tuple], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
    columns = list(zip(*done, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def audited(rows: DataFrame) -> DataFrame:
    """Per conversation its gaps, faults, illegal neighbours, least cost, edits and the hash of what is left.

    A conversation's rows pass one task in order, as a hash of them all must; that
    task holds no rows, only the audit, one letter per edit.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    fed = (
        edited(rows)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "place")
        .select("conv_id", "turn", F.encode("role", "utf-8"), F.encode("text", "utf-8"), "fault", "copies", "edit", "tail")
    )
    return fed.mapInArrow(_audited, f"conv_id {kind}, {FIGURES}")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space).

    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    fate = F.crc32(key.cast("binary")) % 20
    text, role = F.col("text"), F.col("role")
    return (
        prepared(rows)
        .withColumn("fate", fate)
        .where("fate <> 0")
        .withColumn("text", F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text))
        .withColumn("role", F.when(F.col("fate") == 4, "user").otherwise(role))
        .select("conv_id", "turn", "role", "text", F.explode(F.expr("if(fate = 3, array(1, 2), array(1))")).alias("copy"))
        .drop("copy")
    )


def audit_of_damage(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table with the audit of its damaged rows; zeros where no row is left."""
    ids = conversations.select("conv_id").distinct()
    found = audited(damaged(conversations)).withColumnRenamed("conv_id", "c")
    counts = [c.split()[0] for c in FIGURES.split(", ")][:6]
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
