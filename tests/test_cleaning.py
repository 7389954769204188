import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.conftest import rows
from tiersmith.functions.text import snake_case, unique_names
from tiersmith.operators import cleaning

NAMES = [
    ("userName", "user_name"), ("UserName", "user_name"), ("User Name", "user_name"),
    ("user-name", "user_name"), ("UserID", "user_id"), ("HTTPResponse", "http_response"),
    ("getHTTPResponse", "get_http_response"), ("already_snake_case", "already_snake_case"), ("", ""),
    ("ALLCAPS", "allcaps"), ("with.dots", "with_dots"), ("col1Name", "col1_name"), ("_batch_id", "_batch_id"),
    ("a__b_", "a_b"),
]


@pytest.mark.parametrize("given_name, expected", NAMES)
def test_snake_case(given_name, expected):
    assert snake_case(given_name) == expected


@given(st.text(alphabet="abcXYZ019_ -.", max_size=20))
def test_snake_case_is_idempotent(name):
    once = snake_case(name)
    assert snake_case(once) == once


def test_unique_names():
    assert unique_names(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]


def test_trim_keeps_nulls_and_arrays(spark):
    df = spark.createDataFrame([("  x\t", None, [" a "]), (None, " ", None)], "s string, t string, l array<string>")
    assert rows(cleaning.trim_strings(df)) == sorted([("x", None, [" a "]), (None, "", None)], key=repr)


def test_cast_types(spark):
    df = spark.createDataFrame([("12.0", "x", "2024-01-05", "true"), ("bad", "1.5", "no", "maybe")], "a string, b string, c string, d string")
    out = cleaning.cast_types(df, {"a": "integer", "b": "float", "c": "date", "d": "boolean", "gone": "integer"})
    assert [r.a for r in out.collect()] == [12, None]
    assert [r.b for r in out.collect()] == [None, 1.5]
    assert [str(r.c) for r in out.collect()] == ["2024-01-05", "None"]
    assert [r.d for r in out.collect()] == [True, None]
    with pytest.raises(ValueError):
        cleaning.cast_types(df, {"a": "complex"})


DUPES = [("a", 1, 10), ("a", 2, 20), ("b", 1, 30), ("a", 3, 5)]


@pytest.mark.parametrize(
    "keep, expected", [("last", [("a", 3, 5), ("b", 1, 30)]), ("first", [("a", 1, 10), ("b", 1, 30)]), (False, [("b", 1, 30)])]
)
def test_deduplicate(spark, keep, expected):
    df = spark.createDataFrame(DUPES, "k string, version int, v int")
    assert rows(cleaning.deduplicate(df, ["k"], keep, ["version"])) == expected


def test_deduplicate_ignores_metadata(spark):
    df = spark.createDataFrame([(1, "b1"), (1, "b2"), (2, "b1")], "v int, _batch string")
    out = cleaning.deduplicate(df)
    assert rows(out) == [(1, "b2"), (2, "b1")]
    assert rows(cleaning.deduplicate(out)) == rows(out)


def test_fill_nulls_by_type(spark):
    df = spark.createDataFrame([(None, None), (1, "x")], "n int, s string")
    assert rows(cleaning.fill_nulls(df, 0, "?")) == [(0, "?"), (1, "x")]
    assert rows(cleaning.fill_nulls(df)) == rows(df)


def test_clean_twice_is_clean_once(spark):
    df = spark.createDataFrame([(" a ", "1"), ("a", "1"), ("b", "x")], "`User Name` string, someValue string")
    once = cleaning.clean(df, {"some_value": "integer"})
    assert once.columns == ["user_name", "some_value"]
    assert rows(once) == rows(cleaning.clean(once, {"some_value": "integer"})) == [("a", 1), ("b", None)]


@pytest.mark.parametrize("few", [cleaning.FEW_REPEATS, 0])
def test_only_rows_that_may_repeat_are_shuffled_whole(spark, monkeypatch, few):
    monkeypatch.setattr(cleaning, "FEW_REPEATS", few)
    schema = "k string, v double, m string, _src string"
    unique = spark.createDataFrame([("a", 0.0, None, "f"), ("b", -0.0, None, "f"), (None, None, None, "f"), (None, None, "x", "f")], schema)
    said = lambda df: [repr(r) for r in rows(df)]  # noqa: E731  NaN is not itself, -0.0 is 0.0
    same = cleaning.deduplicate_stored(unique)
    assert said(same) == said(cleaning.deduplicate(unique))
    assert "Exchange" not in same._jdf.queryExecution().executedPlan().toString()
    mixed = unique.unionByName(spark.createDataFrame([("a", -0.0, None, "g"), (None, None, None, "e"), ("c", float("nan"), "", "g"), ("c", float("nan"), "", "h")], schema))
    for keep, order in (("last", None), ("first", None), ("last", ["v", "_src"]), (False, None)):
        assert said(cleaning.deduplicate_stored(mixed, None, keep, order)) == said(cleaning.deduplicate(mixed, None, keep, order)), keep
    assert said(cleaning.deduplicate_stored(mixed, ["k"], "last", ["_src"])) == said(cleaning.deduplicate(mixed, ["k"], "last", ["_src"]))


def test_a_row_is_in_its_own_order_once(spark):
    df = spark.createDataFrame([(1, "b1", "x")], "v int, _batch string, _file string")
    plan = cleaning.deduplicate(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan and "max(" in plan
