"""Inferred types and the quarantine of lines that do not fit."""

import pytest
from conftest import rows

from delaylake.sources import files


@pytest.fixture
def lines(tmp_path):
    def save(*text):
        path = tmp_path / "in.csv"
        path.write_text("".join(f"{t}\n" for t in text))
        return [str(path)]

    return save


def types(df):
    return dict(df.dtypes)


def test_narrowest_type_that_all_values_fit(spark, lines):
    path = lines("a,b,c,d,e,f,g", "1,9999999999,1,true,2012-01-15,2012-01-15 10:00:00,x", "-2,2,0.5,false,2012-02-01,2012-01-15 11:00:00,", ",,,,,,")
    typed, bad = files.read_typed(spark, path)
    assert types(typed) == {"a": "int", "b": "bigint", "c": "double", "d": "boolean", "e": "date", "f": "timestamp", "g": "string"}
    assert typed.count() == 3 and bad.count() == 0
    assert [r["a"] for r in typed.collect()] == [1, -2, None]


def test_misfits_within_the_tolerance_are_set_aside(spark, lines):
    good = [f"{i},2012-01-{i:02d}" for i in range(1, 20)]
    path = lines("n,day", *good, "x,2012-01-20")
    typed, bad = files.read_typed(spark, path, tolerance=0.05)
    assert types(typed) == {"n": "int", "day": "date"} and typed.count() == 19
    assert rows(bad) == [("x", "2012-01-20", None, ["n"])]
    strict, none = files.read_typed(spark, path)
    assert types(strict)["n"] == "string" and strict.count() == 20 and none.count() == 0


def test_lines_with_too_few_or_too_many_values(spark, lines):
    path = lines("1|2|3", "4|5", "6|7|8|9", "1|x|3")
    typed, bad = files.read_typed(spark, path, sep="|", columns=["a", "b", "c"], types={"a": "int", "b": "int"})
    assert rows(typed) == [(1, 2, "3")]
    assert {r["_line"]: r["_misfits"] for r in bad.collect()} == {"4|5": [], "6|7|8|9": [], None: ["b"]}
    # Whatever is asked of the frames, a line is in one of them.
    for names in (["a"], ["a", "b"], ["c"]):
        assert typed.select(*names).count() + bad.select(*names).count() == 4
        assert len(typed.select(*names).collect()) + len(bad.select(*names).collect()) == 4


def test_no_lines_and_odd_names(spark, lines):
    typed, bad = files.read_typed(spark, lines("a b,c.d"))
    assert types(typed) == {"a b": "string", "c.d": "string"} and typed.count() == bad.count() == 0
    typed, bad = files.read_typed(spark, lines("a b,c.d", "1,2"))
    assert rows(typed) == [(1, 2)] and bad.count() == 0
