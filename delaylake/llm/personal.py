"""Personal data in texts: regular expressions propose, checksums confirm, nearby words adjust the score.

Per kind the leftmost non-overlapping matches are proposals; a proposal that its
validator refuses is dropped, without another try. ``email``, ``ip`` (parts up to
255), ``card`` (14 to 19 digits, Luhn) and ``phone`` (10 to 15 digits) stay
whenever they are confirmed. ``iban`` (length of its country, mod 97), ``ssn`` (areas,
groups and serials in use) and ``tel`` (national form) also need a score of LEAST:
their prior, RAISE more with a word of the kind within NEAR characters, LOWER less
with a word that speaks against it. The characters looked at lie between the
match and its neighbours of the same kind.

**On Spark.** Built-in functions only and no exchange: every row is judged where
it is read. The pieces between the matches give the positions: their lengths are
summed up, in parts of PART so that a text with very many matches costs little
more. The patterns are forms of the kinds' definitions that give the same matches
in linear time: a run of characters is tried once, from its start or from the end
of the match before it, and never given back.

**Defined results.** A null text is an empty one and has no spans. Positions are
code points, from 0, the end not included. Spans of different kinds may overlap.
Repeated rows are judged each; other columns are left as they are (a column
``spans`` is replaced); an empty table gives no rows. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAR, RAISE, LOWER, LEAST = 40, 30, 30, 50
PART = 256

#: Length of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE LT LU XK", 21: "CH HR LI LV", 22: "BG DE GB GE IE ME RS",
    23: "AE GI IL", 24: "AD CZ ES RO SA SE SK TN", 25: "PT", 26: "IS", 27: "FR GR IT MC SM", 28: "AL AZ CY DO HU LB PL", 31: "MT",
}
IBAN = "|".join(
    f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{length - 4}}}" for length, names in IBAN_LENGTHS.items()
)
AGAINST = "example sample dummy test version order isbn invoice serial".split()
CALL = "phone telephone tel call mobile cell fax contact".split()


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _ip(value: Column, _before: Column, _after: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))


def _card(value: Column, _before: Column, _after: Column) -> Column:
    return F.call_function("luhn_check", digits(value))


def _phone(value: Column, _before: Column, _after: Column) -> Column:
    return F.length(digits(value)).between(10, 15)


def _stands_alone(before: Column, after: Column, joined: str) -> Column:
    return ~before.rlike(f"{joined}\\z") & ~after.rlike(f"^{joined}")


def mod_97(value: Column) -> Column:
    """The remainder of an account number with its head moved to the end and letters as 10 to 35."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    return F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda rest, c: F.when(c.rlike("[0-9]"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97),
    )


def _iban(value: Column, before: Column, after: Column) -> Column:
    return _stands_alone(before, after, "[A-Za-z0-9]") & (mod_97(value) == 1)


def _ssn(value: Column, before: Column, after: Column) -> Column:
    in_use = ~value.rlike("^(?:000|666|9..)-|-00-|-0000$")
    return _stands_alone(before, after, "[0-9-]") & in_use


def _tel(value: Column, before: Column, after: Column) -> Column:
    # Behind a country code it is a part of a phone number of the international form.
    return _stands_alone(before, after, "[0-9(]") & ~before.rlike(r"[+.-]\z|\+[0-9]{1,3}[ .-]?\z") & ~after.rlike("^[.-][0-9]")


class Kind(NamedTuple):
    """``plain`` defines the matches; ``pattern`` finds the same ones in linear time."""

    name: str
    plain: str
    pattern: str
    confirmed: Callable[[Column, Column, Column], Column] | None
    prior: int
    words: list[str]
    base: bool = False


LOCAL = "[A-Za-z0-9._%+-]"
LABEL = "[A-Za-z0-9-]"
KINDS = [
    Kind("email", rf"{LOCAL}+@{LABEL}+(?:\.{LABEL}+)+", rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++", None, 70, "mail email contact write".split(), True),
    Kind("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip, 50, "ip host server address login".split(), True),
    Kind("card", "[0-9](?:[ -]?[0-9])+", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])", _card, 60, "card visa mastercard credit debit payment".split(), True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 60, CALL, True),
    Kind("iban", IBAN, f"(?=[A-Z]{{2}}[0-9]{{2}})(?:{IBAN})", _iban, 60, "iban account bank transfer".split()),
    Kind("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}", "[0-9]{3}-[0-9]{2}-[0-9]{4}", _ssn, 30, "ssn social security".split()),
    Kind("tel", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", _tel, 30, CALL),
]
BASE = [k.name for k in KINDS if k.base]
SPAN = "struct<start:bigint,no:int,end:bigint,kind:string,value:string,score:int>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def running(sizes: Column) -> Column:
    """Sums of the first 1, 2, ... entries of a non-empty array."""

    def summed(values: Column) -> Column:
        return F.aggregate(
            values, F.array(F.lit(0).cast("bigint")), lambda sums, x: F.array_append(sums, F.element_at(sums, -1) + x)
        )

    firsts = F.sequence(F.lit(1), F.size(sizes), F.lit(PART))
    parts = F.transform(firsts, lambda first: summed(F.slice(sizes, first, PART)))

    def joined(parts: Column) -> Column:
        ahead = F.slice(summed(F.transform(parts, lambda sums: F.element_at(sums, -1))), F.lit(1), F.size(parts))
        return F.flatten(F.zip_with(parts, ahead, lambda sums, add: F.transform(F.slice(sums, 2, PART), lambda x: x + add)))

    return _let(parts, joined)


def _near(kind_words: list[str], context: Column) -> Column:
    return context.rlike(f"(?:^|[^a-z])(?:{'|'.join(kind_words)})(?:[^a-z]|$)")


def _lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _spans(no: int, kind: Kind, text: Column) -> Column:
    """The confirmed spans of one kind."""

    def span(value: Column, end: Column, before: Column, after: Column) -> Column:
        context = _lowered(F.concat(before, F.lit(" "), after))
        score = kind.prior + F.when(_near(kind.words, context), RAISE).otherwise(0) - F.when(_near(AGAINST, context), LOWER).otherwise(0)
        fits = F.lit(True) if kind.confirmed is None else kind.confirmed(value, before, after)
        whole = F.struct(
            (end - F.length(value)).alias("start"), F.lit(no).alias("no"), end.alias("end"),
            F.lit(kind.name).alias("kind"), value.alias("value"), score.alias("score"),
        )
        return F.when(fits & (F.lit(kind.base) | (score >= LEAST)), whole)

    def found(matches: Column, pieces: Column, ends: Column) -> Column:
        each = F.transform(
            matches,
            lambda value, i: span(value, F.get(ends, i), F.right(F.get(pieces, i), F.lit(NEAR)), F.left(F.get(pieces, i + 1), F.lit(NEAR))),
        )
        return F.filter(each, lambda s: s.isNotNull())

    def placed(matches: Column, pieces: Column) -> Column:
        sizes = F.transform(matches, lambda value, i: F.length(F.get(pieces, i)) + F.length(value))
        return _let(running(sizes), lambda ends: found(matches, pieces, ends))

    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    nothing = F.array().cast(f"array<{SPAN}>")
    return _let(
        matches,
        lambda m: F.when(F.size(m) > 0, _let(F.split(text, kind.pattern, -1), lambda p: placed(m, p))).otherwise(nothing),
    )


def find(docs: DataFrame) -> DataFrame:
    """The documents with ``spans``: structs of start, no (of the kind), end, kind, value, score (of 100), in order."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("spans", F.array_sort(F.concat(*(_spans(i, k, text) for i, k in enumerate(KINDS)))))


def digest(docs: DataFrame) -> DataFrame:
    """Per document its counts and hash of the base kinds, and all spans as text with their scores."""

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    spans = F.col("spans")
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint) as n_{k}") for k in BASE]
    return find(docs.select("doc_id", "text")).select(
        "doc_id",
        *counts,
        F.sha2(written(F.filter(spans, lambda s: s["no"] < len(BASE))).cast("binary"), 256).alias("base_sha256"),
        written(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def sql() -> str:
    """The same as ``digest`` in the SQL of the checks, from the plain patterns."""

    def near(words: list[str]) -> str:
        return f"regexp_matches(context, '(?:^|[^a-z])(?:{'|'.join(words)})(?:[^a-z]|$)')"

    figures = "regexp_replace(value, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(string_split(reverse({figures}), ''), lambda c, i: "
        "case when i % 2 = 1 then cast(c as integer) when cast(c as integer) > 4 then 2 * cast(c as integer) - 9 else 2 * cast(c as integer) end))"
    )
    bare = "replace(value, ' ', '')"
    mod = (
        f"list_reduce(list_transform(string_split(substr({bare}, 5) || substr({bare}, 1, 4), ''), "
        "lambda c: case when c between '0' and '9' then ascii(c) - 48 else ascii(c) - 55 end), "
        "lambda rest, v: (rest * case when v > 9 then 100 else 10 end + v) % 97, 0)"
    )
    confirmed = {
        "email": "true",
        "ip": r"list_bool_and(list_transform(string_split(value, '.'), lambda p: length(ltrim(p, '0')) <= 3 and coalesce(try_cast(ltrim(p, '0') as integer), 0) <= 255))",
        "card": f"case when length({figures}) between 14 and 19 then {luhn} % 10 = 0 else false end",
        "phone": f"length({figures}) between 10 and 15",
        "iban": f"not regexp_matches(before, '[A-Za-z0-9]$') and not regexp_matches(after, '^[A-Za-z0-9]') and {mod} = 1",
        "ssn": "not regexp_matches(before, '[0-9-]$') and not regexp_matches(after, '^[0-9-]') and not regexp_matches(value, '^(?:000|666|9..)-|-00-|-0000$')",
        "tel": r"not regexp_matches(before, '[0-9(]$|[+.-]$|\+[0-9]{1,3}[ .-]?$') and not regexp_matches(after, '^[0-9(]|^[.-][0-9]')",
    }
    lowered = "translate(before || ' ' || after, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps, all_kinds = [], []
    for no, kind in enumerate(KINDS):
        name = kind.name
        steps.append(
            f"{name}_lists as (select row_no, regexp_extract_all(text, '{kind.plain}') as m, string_split_regex(text, '{kind.plain}') as p from given),\n"
            f"{name}_rows as (select row_no, unnest(m) as value, generate_subscripts(m, 1) as i, p from {name}_lists),\n"
            f"{name}_placed as (select row_no, value, right(p[i], {NEAR}) as before, left(p[i + 1], {NEAR}) as after,\n"
            f"  cast(sum(length(p[i]) + length(value)) over (partition by row_no order by i) as bigint) as stop from {name}_rows),\n"
            f"{name}_scored as (select *, {lowered} as context,\n"
            f"  {kind.prior} + case when {near(kind.words)} then {RAISE} else 0 end - case when {near(AGAINST)} then {LOWER} else 0 end as score\n"
            f"  from {name}_placed where {confirmed[name]})"
        )
        kept = "" if kind.base else f" where score >= {LEAST}"
        all_kinds.append(
            f"select row_no, {no} as no, '{name}' as kind, stop - length(value) as start, stop, score from {name}_scored{kept}"
        )
    counts = ", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in BASE)
    mark, order = "kind || ':' || start || ':' || stop", "order by start, no, stop"
    return (
        "with given as (select row_number() over () as row_no, doc_id, coalesce(text, '') as text from documents),\n"
        + ",\n".join(steps)
        + ",\nspans as (\n"
        + "\nunion all ".join(all_kinds)
        + f")\nselect any_value(doc_id) as doc_id, {counts},\n"
        f"  sha256(coalesce(string_agg({mark}, ',' {order}) filter (no < {len(BASE)}), '')) as base_sha256,\n"
        f"  coalesce(string_agg({mark}, ',' {order}) filter (no is not null), '') as spans,\n"
        f"  coalesce(string_agg(cast(score as varchar), ',' {order}) filter (no is not null), '') as scores\n"
        "from given left join spans using (row_no) group by row_no"
    )
