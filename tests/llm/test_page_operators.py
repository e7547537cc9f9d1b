"""URL rules and WARC archives on odd rows; queries against SQL; the pipeline."""

import hashlib
from collections import Counter

import check
import pytest
from llm_world import SF, docs, document_list, no_docs  # noqa: F401

import corpus_pipeline
from delaylake.llm import catalogue, urls, warc
from delaylake.llm.store import folder

PAGES = "page_id long, url string, html string, host string, digest string"


@pytest.fixture(scope="module")
def duck():
    return check.duck(SF)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    ours = catalogue.QUERIES[name](spark, SF).toArrow()
    assert check.differences(ours, check.arrow(duck.sql(catalogue.ORACLE_SQL[name]))) == []


@pytest.mark.parametrize("n", range(1, 14))
def test_each_operator_has_its_query(n):
    assert sum(name.startswith(f"op{n}_") for name in catalogue.QUERIES) == 1


def plain_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    best = None
    for verdict, rule in rules:
        h, p = rule.split("/", 1) if "/" in rule else (rule, None)
        p = "" if p is None else "/" + p
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or (len(rule), verdict) > (len(best[1]), best[0]):
                best = (verdict, rule)
    return host, path, best and best[1], best[0] if best else "allow"


def test_url_rules(spark):
    rules = [*catalogue.URL_RULES, ("block", "a.b.c.d/x"), ("allow", "org"), ("block", "org"), ("block", "com/")]
    given = [
        None, "", "no scheme", "http://", "https://Example.COM/EN/", "http://www.example.com/en/1", "x://net", "x://net/es",
        "x://m.net/es/9?q#f", "x://net?/es/", "http://a://b/c", "http://z.a.b.c.d/xyz", "http://org#x", "http://é.com/ü", "http://.com/", "http://com./en/",
        "http://www.example.com/en/1",
    ]
    rows = [(i if i % 5 else None, u, None, "clash", "clash") for i, u in enumerate(given)]
    table = spark.createDataFrame(rules, "verdict string, rule string")
    found = urls.judge(spark.createDataFrame(rows, PAGES), table).collect()
    got = Counter((r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found)
    assert got == Counter((u, *plain_verdict(u, rules)) for u in given)
    nothing = spark.createDataFrame([], PAGES)
    assert urls.judge(nothing, table).count() == 0
    assert urls.judge(spark.createDataFrame(rows, PAGES), table.where("false")).where("rule is not null").count() == 0


def pages(spark):
    big = "<p>ü" * 60_000
    rows = [
        (1, "http://a/", "x" * 1500), (2, "http://b/", "x" * 1500), (7, None, "x" * 1500), (3, "u\r\nX: 1", "short"),
        (4, "http://c/", "short"), (5, "http://d/", None), (6, "http://e/", ""), (8, "http://f/", big), (9, "http://g/", "a\r\n\r\nb\r\n0\r\n\r\n" * 9),
        (None, "http://h/", "n" * 2000), (10, "http://i/", "n" * 2000), (11, "http://j/", "r" * 1200), (11, "http://j/", "r" * 1200), (None, None, None),
    ]
    return rows, spark.createDataFrame([(*r, "h", "d") for r in rows], PAGES)


@pytest.mark.parametrize("segment_bytes", [1000, warc.SEGMENT_BYTES])
def test_archives_come_back(spark, segment_bytes):
    rows, frame = pages(spark)
    got = Counter(tuple(r) for r in warc.round_trip(frame, segment_bytes).collect())
    want = Counter()
    for page_id, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "").encode() == raw]
        keeper = max(same, default=None) if len(raw) >= 1000 else None
        refers = keeper if keeper is not None and keeper != page_id else None
        want[page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if refers else "response", refers] += 1
    assert got == want
    assert warc.round_trip(frame.where("false")).count() == 0


def test_payloads_survive_segments(spark):
    rows, frame = pages(spark)
    path = folder(spark)
    warc.write(frame, path, 700)
    back = warc.read(spark, path).collect()
    assert all(r["complete"] for r in back)
    whole = Counter(bytes(r["payload"]) for r in back if r["record_type"] == "response")
    assert whole[("<p>ü" * 60_000).encode()] == 1 and whole[("a\r\n\r\nb\r\n0\r\n\r\n" * 9).encode()] == 1


def test_broken_segments_give_no_payload():
    import pandas as pd

    columns = [c.split()[0] for c in warc.RECORD.split(", ")]
    block = warc.HTTP + warc.chunked(b"payload" * 50)
    rows = [("r", "response", 1, None, None, "r", 1, None, block[:200]), ("c", "continuation", None, None, None, "r", 2, len(block), block[200:])]
    frame = pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in ("page_id", "refers_to", "number", "total")})
    assert warc._reassembled(frame[::-1])["body"][0] == b"payload" * 50
    assert warc._reassembled(frame[:1])["body"][0] is None
    short = frame.assign(total=[None, 5]).astype({"total": "Int64"})
    assert warc._reassembled(short)["body"][0] is None
    assert warc.dechunked(b"zz\r\n") is None and warc.dechunked(b"5\r\nab") is None and warc.dechunked(b"0\r\n\r\n") == b""


def test_pipeline_stages(spark, docs, document_list, no_docs):
    kept, counts = docs, [len(document_list)]
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = stage(spark, kept, SF)
        if name != "tokens":
            assert kept.columns == before.columns and kept.dtypes == before.dtypes
        counts.append(kept.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    assert "round_trip" in kept.columns and kept.where("not round_trip").count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0


def test_pipeline_of_the_given_tables(spark):
    rows = corpus_pipeline.run(spark, SF)
    found = rows.select("doc_id", "text").collect()
    assert 0 < len(found) == len({r["doc_id"] for r in found})
