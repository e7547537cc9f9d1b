"""Personal data against the plain patterns of Python's ``re``, on odd rows and random strings."""

import hashlib
import random
import re
import time

import check
from llm_world import SF, docs, document_list, lowered, no_docs  # noqa: F401

from delaylake.llm import catalogue, personal

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def confirmed(kind, value, before, after):
    figures = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(figures) <= 19 and luhn(figures)
    if kind == "phone":
        return 10 <= len(figures) <= 15
    if kind == "iban":
        plain = value.replace(" ", "")
        number = int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4]))
        return not re.search("[A-Za-z0-9]$", before) and not re.match("[A-Za-z0-9]", after) and number % 97 == 1
    if kind == "ssn":
        area, group, serial = value.split("-")
        alone = not re.search("[0-9-]$", before) and not re.match("[0-9-]", after)
        return alone and area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"
    if kind == "tel":
        return not re.search(r"(?:[0-9(+.-]|\+[0-9]{1,3}[ .-]?)$", before) and not re.match(r"[0-9(]|[.-][0-9]", after)
    return True


def plain(text):
    """(start, no, end, kind, value, score) of a text in order."""
    text, out = text or "", []
    for no, kind in enumerate(personal.KINDS):
        matches = list(re.finditer(BASE.get(kind.name, kind.plain), text))
        edges = [0, *(m.end() for m in matches)], [*(m.start() for m in matches), len(text)]
        for i, m in enumerate(matches):
            before, after = text[edges[0][i] : m.start()][-personal.NEAR :], text[m.end() : edges[1][i + 1]][: personal.NEAR]
            context = lowered(before + " " + after)
            score = kind.prior
            for words, change in ((kind.words, personal.RAISE), (personal.AGAINST, -personal.LOWER)):
                score += change * any(re.search(rf"(?:^|[^a-z]){w}(?:[^a-z]|$)", context) for w in words)
            if confirmed(kind.name, m[0], before, after) and (kind.name in BASE or score >= personal.LEAST):
                out.append((m.start(), no, m.end(), kind.name, m[0], score))
    return sorted(out)


ODD = [
    "a@b.co_x@y.zz a@b a@.b x@y.z.w@q.r", "@a.b a@b.c.", "é.ü@mail.example.com", "x" * 60_000, "a@" + "b." * 20_000 + "c", "1" * 60_000,
    "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.256 255.255.255.255 0001.02.3.4 1.2.3", "9" * 30 + ".1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111  1111", "1 4111111111111111", "4111111111111111 1", "41111111111111112", "0" * 14, "0" * 19, "0" * 20,
    "+1 (017) 555-7713", "+49 30 1234567890 +1", "+12", "+1((((((((((2", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "iban DE89 3704 0044 0532 0130 00 BIC", "GB82WEST12345698765432", "XGB82WEST12345698765432", "ES9121000418450200051332 X", "DE89370400440532013001", "NL91ABNA0417164300", "example IBAN NL91ABNA0417164300",
    "My SSN: 123-45-6789", "123-45-6789", "social 000-45-6789 social 123-00-6789", "ssn 1123-45-6789", "call (555) 123-4567 now", "tel. 555-123-4567", "call +1 555 123 4567",
    "😀 mail: a@b.co 😀 ip 1.2.3.4 card 4111 1111 1111 1111", "a@b.co,a@b.co," * 3000, "card \n4111111111111111\n" * 700, "Card 4111111111111111 (test)",
]


def found(frame):
    return [tuple(tuple(s) for s in r["spans"]) for r in personal.find(frame).orderBy("i").collect()]


def test_spans_equal_the_plain_patterns(spark):
    rnd = random.Random(11)
    mixed = ["".join(rnd.choice("0123456789..  --+()@@ab_%é") for _ in range(rnd.randrange(60))) for _ in range(1500)]
    mixed += ["".join(rnd.choice(["4111", "1111", " ", "-", "1.2", ".3.4", "@", "a.b", "+1", "é", "\n", "tel ", "55", "DE89", "0532 "]) for _ in range(25)) for _ in range(800)]
    texts = [None, "", *ODD, *mixed]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "i long, text string, spans string").repartition(4)
    for text, got in zip(texts, found(frame), strict=True):
        assert got == tuple(plain(text)), (text or "")[:200]


def test_digest_of_odd_documents(spark, docs, document_list, no_docs):  # noqa: F811
    got = sorted((str(r[0]), *r[1:]) for r in personal.digest(docs).collect())
    want = []
    for doc_id, text, *_ in document_list:
        spans = plain(text)
        names = [(s[3], f"{s[3]}:{s[0]}:{s[2]}") for s in spans]
        base = ",".join(n for k, n in names if k in BASE)
        counts = [sum(k == b for k, _ in names) for b in BASE]
        scores = ",".join(str(s[5]) for s in spans)
        want.append((str(doc_id), *counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(n for _, n in names), scores))
    assert got == sorted(want)
    assert personal.digest(no_docs).count() == 0


def test_sql_on_odd_texts(spark):
    con = check.duckdb.connect()
    texts = [None, "", *(t for t in ODD if len(t) < 1000)]
    table = check.pa.table({"doc_id": list(range(len(texts))), "text": check.pa.array(texts, check.pa.string())})
    con.register("documents", table)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert check.differences(personal.digest(frame).toArrow(), check.arrow(con.sql(personal.sql()))) == []


def test_long_runs_take_linear_time(spark):
    texts = [c * 300_000 for c in ("a", "1", "a.", "1.", "+", "+1", "1 ", "-")] + ["1 2-" * 80_000, "4111111111111111 " * 20_000]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    began = time.time()
    assert personal.find(frame).selectExpr("size(spans) as n").agg({"n": "max"}).first()[0] is not None
    assert time.time() - began < 120


def test_plan_has_no_exchange_and_no_python(spark):
    plan = catalogue.QUERIES["op13_personal_data"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
