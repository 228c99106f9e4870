import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landfall.functions import (as_text, decode_typed, derby_date_literal, pascal_to_snake,
                                render_filter, snake_case, split_list, spark_date_literal,
                                sqlserver_date_literal, staging_key, staging_key_col,
                                start_date)
from landfall.functions.naming import _WORD_END


@pytest.mark.parametrize("name,expected", [
    ("SalesOrderID", "sales_order_id"),
    ("XMLData", "xmldata"),
    ("Line2Text", "line2_text"),
    ("rowguid", "rowguid"),
    ("aBC", "a_bc"),
    ("BusinessEntityID", "business_entity_id"),
    ("ModifiedDate", "modified_date"),
    ("already_snake", "already_snake"),
    ("", ""),
])
def test_pascal_to_snake(name, expected):
    assert pascal_to_snake(name) == expected


_names = st.text(alphabet="aB1_zQ", max_size=12)


@given(_names)
def test_snake_case_is_idempotent(name):
    once = pascal_to_snake(name)
    assert pascal_to_snake(once) == once


@given(st.text(alphabet="aB1_", max_size=7))
def test_second_rule_changes_nothing_after_the_first(name):
    """A rule for runs of capitals after a lower-case letter has nothing left to match."""
    after_first = re.sub(_WORD_END, r"\1_\2", name)
    assert re.sub(r"([a-z])([A-Z]{2,})", r"\1_\2", after_first) == after_first


@settings(max_examples=1, deadline=None)
@given(st.lists(_names, min_size=30, max_size=30))
def test_column_snake_case_matches_python(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "x string")
    got = [r["s"] for r in df.select(snake_case("x").alias("s")).collect()]
    assert got == [pascal_to_snake(n) for n in names]


def test_run_window_and_literals():
    assert start_date("2024-03-01") == dt.date(2024, 2, 29)
    d = dt.date(1999, 12, 31)
    assert spark_date_literal(d) == "TO_DATE('1999-12-31', 'yyyy-MM-dd')"
    assert sqlserver_date_literal(d) == "CONVERT(DATETIME, '1999-12-31', 120)"
    assert derby_date_literal(d) == "TIMESTAMP('1999-12-31 00:00:00')"
    assert render_filter("ModifiedDate >= :start_date", "2000-01-01") == \
        "ModifiedDate >= TO_DATE('1999-12-31', 'yyyy-MM-dd')"
    assert render_filter(None, "2000-01-01") is None


def test_lists_and_staging_key(spark):
    assert split_list("A, B,C") == ["A", "B", "C"]
    assert split_list(None) is None
    assert staging_key("SalesOrderID, SalesReasonID", None) == ["sales_order_id", "sales_reason_id"]
    assert staging_key("TerritoryID", "id") == ["id"]
    df = spark.createDataFrame([("OrderKey, LineNumber", None), ("CustKey", "Id")],
                               "primary_key string, stg_primary_key string")
    got = [r[0] for r in df.select(staging_key_col()).collect()]
    assert got == [["order_key", "line_number"], ["id"]]


def test_decode_typed(spark):
    df = spark.createDataFrame([(1, "x", True, 2.5), (None, None, False, None)],
                               "a int, b string, c boolean, d double")
    text, declared = as_text(df)
    assert declared == {"a": "INT", "b": "STRING", "c": "BOOLEAN", "d": "DOUBLE"}
    out = decode_typed(text, declared)
    assert [f.dataType.simpleString() for f in out.schema.fields] == \
        ["int", "string", "boolean", "string"]
    assert sorted(out.collect(), key=repr) == sorted(
        [(1, "x", True, "2.5"), (None, None, False, None)], key=repr)


def test_decode_boolean_is_exact_text(spark):
    df = spark.createDataFrame([("true",), ("TRUE",), ("false",), (None,)], "c string")
    got = [r[0] for r in decode_typed(df, {"c": "BOOLEAN"}).collect()]
    assert got == [True, False, False, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_decode_bad_int_raises(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("12",), ("x",)], "a string")
        with pytest.raises(Exception, match="not an INT"):
            decode_typed(df, {"a": "INT"}).collect()
        ok = spark.createDataFrame([(" 12 ",), (None,)], "a string")
        assert [r[0] for r in decode_typed(ok, {"a": "INT"}).collect()] == [12, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_column_decode_keeps_other_types_as_text(spark):
    df = spark.createDataFrame([("7",)], "a string")
    assert decode_typed(df, {"a": "BIGINT"}).schema["a"].dataType.simpleString() == "string"
    assert decode_typed(df, {}).first()[0] == "7"


def test_filter_column():
    from landfall.functions import filter_column
    assert filter_column("ModifiedDate >= :start_date") == "ModifiedDate"
    assert filter_column('"o_orderdate" >= :start_date') == "o_orderdate"
    assert filter_column("[ModifiedDate] > :start_date") == "ModifiedDate"
    assert filter_column("a >= :start_date AND b = 1") is None
    assert filter_column(None) is None
