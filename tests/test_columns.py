import pytest
from pyspark.sql import functions as F

from landfall.operators import (apply, chain, drop_column, rename_columns, rename_positional, scan,
                                select_listed, snake_case_columns, where_filter)
from landfall.plans import stage_frame


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20)],
                                 "SalesOrderID int, OrderQty string, TaxAmt int")


def test_select_and_filter(df):
    assert select_listed(df, None) is df
    assert select_listed(df, ["TaxAmt", "SalesOrderID"]).columns == ["TaxAmt", "SalesOrderID"]
    assert where_filter(df, None) is df
    assert where_filter(df, "TaxAmt > 10").count() == 1
    assert where_filter(df, F.col("TaxAmt") > 10).count() == 1


def test_scan_filters_on_a_column_it_does_not_select(df):
    out = scan(df, ["SalesOrderID"], "TaxAmt > 10")
    assert out.columns == ["SalesOrderID"]
    assert [r[0] for r in out.collect()] == [2]


def test_drop_keeps_order(df):
    assert drop_column(df, "OrderQty").columns == ["SalesOrderID", "TaxAmt"]


def test_rename_by_map_ignores_missing(df):
    out = rename_columns(df, {"OrderQty": "order_quantity", "Nope": "x"})
    assert out.columns == ["SalesOrderID", "order_quantity", "TaxAmt"]


def test_snake_case_columns(df):
    assert snake_case_columns(df).columns == ["sales_order_id", "order_qty", "tax_amt"]


def test_snake_case_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "fooBar int, foo_bar int")
    with pytest.raises(ValueError):
        snake_case_columns(df)


def test_rename_positional(df):
    assert rename_positional(df, ["SalesOrderID"], None) is df
    out = rename_positional(df, ["SalesOrderID", "TaxAmt"], ["id", "tax"])
    assert out.columns == ["id", "OrderQty", "tax"]
    with pytest.raises(ValueError):
        rename_positional(df, ["SalesOrderID"], ["a", "b"])


def test_apply_and_chain(df):
    assert apply(df, None) is df
    with pytest.raises(ValueError, match="no frame to transform"):
        apply(None, lambda d: d)
    f = chain(None, lambda d: d.where("TaxAmt > 10"), snake_case_columns)
    assert f(df).columns == ["sales_order_id", "order_qty", "tax_amt"]


def test_stage_frame_order_custom_rename_then_snake_then_key(df):
    out = stage_frame(df, lambda d: rename_columns(d, {"OrderQty": "order_quantity"}),
                      ["sales_order_id"], ["id"])
    assert out.columns == ["id", "order_quantity", "tax_amt"]
