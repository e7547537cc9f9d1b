"""Documents with everything that a corpus should not have, and plain Python forms of the operators."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF = "/root/testdata/sf0.001"
SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, th long, id long, "
    "digest string, size long, ids string, base long, fp string"
)


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text) -> list[str]:
    return SPACE_WORDS.findall(lowered(text or ""))


def odd_texts() -> list:
    long = " ".join(f"w{i % 4000}x{i}" for i in range(40_000))
    passage = "shared passage number " + " ".join(f"p{i}" for i in range(120))
    return [
        None,
        "",
        " \n\t ",
        "a",
        "A a A a A a A a A a",
        "é" * 700,
        "x" * 3000,
        long,
        "Ünïcode 日本語 😀 \x00 text\r\nwith\x0bodd\x0cspace",
        "before one " + passage + " after one",
        "before two " + passage + " after two",
        "line\nline\nline\nother line\nline",
        "CC BY-NC 4.0 and cc by; General Public License. ALL RIGHTS RESERVED",
    ]


def document_rows(spark) -> list[tuple]:
    given = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120).collect()
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in given]
    for i, text in enumerate(odd_texts()):
        rows.append((1000 + i, text, None if i % 3 else "en", None if i % 2 else "src0", None))
    rows += [rows[0], rows[0], rows[5], (None, rows[7][1], "en", "src1", 1), (None, None, None, None, None)]
    clash = (True, 1, 2, "d", 3, "i", 4, "f")
    return [(*r, *clash) for r in rows]


@pytest.fixture(scope="session")
def document_list(spark):
    return document_rows(spark)


@pytest.fixture(scope="session")
def docs(spark, document_list):
    return spark.createDataFrame(document_list, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
