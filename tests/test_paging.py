import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfall.operators import page, page_info, paging

from .conftest import SF01


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF01}/events.parquet")


def test_bad_arguments(events):
    with pytest.raises(ValueError):
        page(events, None, -1, 10)
    with pytest.raises(ValueError):
        page(events, None, 0, -1)
    with pytest.raises(ValueError):
        page_info(events, -1, 10)


def test_page_length_zero_is_all_rows(events):
    assert page(events, ["event_id"], 5, 0).count() == events.count()
    info = page_info(events, 0, 0).first()
    assert info["total_pages"] == 1


def test_page_info_rounds_up(spark):
    df = spark.range(5)
    assert page_info(df, 0, 10).first().asDict() == \
        {"page": 0, "page_length": 10, "total_pages": 1, "total_results": 5}
    assert page_info(spark.range(19), 0, 10).first()["total_pages"] == 2
    assert page_info(spark.range(0), 0, 10).first()["total_pages"] == 0


def test_default_order_is_first_column(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    assert [r[0] for r in page(df, None, 0, 2).collect()] == [1, 2]


def test_past_the_end_is_empty(events):
    assert page(events, ["event_id"], 10_000, 25).count() == 0


@pytest.fixture()
def small_steps(monkeypatch):
    """No early pages and few stretches, so that small tables are split as large ones are."""
    monkeypatch.setattr(paging, "EARLY", 3)
    monkeypatch.setattr(paging, "STRETCHES", 6)


@pytest.mark.parametrize("early", [0, 50, 10_000])
@pytest.mark.parametrize("page_no,length", [(0, 7), (123, 13), (1, 6000)])
def test_pages_are_those_of_a_whole_sort(events, page_no, length, early, monkeypatch):
    monkeypatch.setattr(paging, "EARLY", early)
    want = [tuple(r) for r in events.orderBy(F.col("ts").desc(), "event_id").offset(page_no * length).limit(length).collect()]
    assert [tuple(r) for r in page(events, ["ts DESC", "event_id"], page_no, length).collect()] == want


def test_both_plans_give_the_same_rows_over_ties(events, monkeypatch):
    rows = [[tuple(r) for r in page(events, ["event_type DESC"], 3, 700).collect()]]
    for early in (0, 1000):
        monkeypatch.setattr(paging, "EARLY", early)
        rows.append([tuple(r) for r in page(events, ["event_type DESC"], 3, 700).collect()])
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 700


def jobs(spark, run):
    """Jobs that ``run`` starts."""
    group = "paging-jobs"
    spark.sparkContext.setJobGroup(group, "")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_early_pages_are_a_top_k_and_deep_ones_take_few_jobs(spark, events, monkeypatch):
    early = page(events, ["ts DESC", "event_id"], 2, 25)
    assert jobs(spark, lambda: page(events, ["ts DESC", "event_id"], 2, 25)) == 0
    assert "TakeOrderedAndProject" in early._jdf.queryExecution().executedPlan().toString()
    assert jobs(spark, lambda: early.collect()) <= 2
    monkeypatch.setattr(paging, "EARLY", 1000)
    deep: list = []
    assert jobs(spark, lambda: deep.append(page(events, ["ts DESC", "event_id"], 300, 10))) <= 6   # two or three aggregates; AQE runs a shuffle as a job of its own
    assert "TakeOrderedAndProject" in deep[0]._jdf.queryExecution().executedPlan().toString()


def all_pages(df, order, length, **options):
    n, out = df.count(), []
    for k in range(-(-n // length)):
        out += [tuple(r) for r in page(df, order, k, length, **options).collect()]
    return out


def test_pages_over_long_ties_are_the_table(spark, small_steps):
    df = spark.createDataFrame([(i, i % 3 if i % 5 else None, "x" * (i % 4)) for i in range(40)], "id int, v int, s string").repartition(7)
    for order in (["v"], ["s", "v DESC"]):
        got = all_pages(df, order, 14)
        assert sorted(got, key=repr) == sorted((tuple(r) for r in df.collect()), key=repr)


def test_repeated_rows_come_as_often_as_they_are(spark, small_steps):
    df = spark.createDataFrame([(1, "a")] * 20 + [(2, "b")] * 3 + [(None, None)] * 9, "k int, v string").repartition(5)
    got = all_pages(df, ["k DESC"], 11)
    assert got == [(2, "b")] * 3 + [(1, "a")] * 20 + [(None, None)] * 9


def test_every_kind_of_column_orders(spark, monkeypatch):
    monkeypatch.setattr(paging, "EARLY", 3)
    monkeypatch.setattr(paging, "STRETCHES", 6)
    df = spark.sql("""SELECT id, CAST(id % 7 AS DOUBLE) / CASE WHEN id % 3 = 0 THEN 0 ELSE 2 END AS d, timestamp_micros(id * 1000003 % 977) AS t,
      CAST(timestamp_micros(id * 7919 % 1013) AS TIMESTAMP_NTZ) AS n, date_add(DATE'2000-01-01', CAST(id % 11 AS INT)) AS y, CAST(id % 13 AS DECIMAL(20,4)) AS c,
      id % 2 = 0 AS b, array(id % 4, id) AS a, struct(id % 5 AS x) AS r FROM range(30)""" .replace("/ CASE WHEN id % 3 = 0 THEN 0 ELSE 2 END", "* IF(id % 9 = 0, CAST('NaN' AS DOUBLE), -1)"))
    for item in ("d", "t DESC", "n", "c"):
        key = item.split()[0]
        want = [repr(r[key]) for r in df.orderBy(F.col(key).desc() if item.endswith("DESC") else F.col(key)).collect()]
        got = all_pages(df, [item], 16)
        assert [repr(r[df.columns.index(key)]) for r in got] == want and len({r[0] for r in got}) == 30


def test_a_large_page_stays_off_the_driver_and_one_task(spark):
    df = spark.range(0, 250_000, 1, 8).select("id", (F.col("id") % 4).alias("v"), F.lit("x" * 50).alias("s"))
    rows = page(df, ["v"], 1, 150_000)
    assert rows.count() == 100_000
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "LocalTableScan" not in plan and "TakeOrdered" not in plan and "SinglePartition" not in plan
    assert [r["id"] for r in page(df, ["v", "id"], 5, 30_000).select("id").collect()] == [4 * i + 2 + k for k in (0, 1) for i in range(62_500)][25_000:55_000]


def test_the_page_filter_reaches_the_scan(events, monkeypatch):
    monkeypatch.setattr(paging, "EARLY", 1000)
    plan = page(events, ["ts DESC", "event_id"], 300, 10)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", plan)


def test_strings_that_share_a_beginning(spark, small_steps):
    df = spark.createDataFrame([(f"tables/part-{i:04d}{'é' * (i % 3)}" if i % 11 else None, i) for i in range(60)], "k string, v int").repartition(4)
    for order in (["k"], ["k DESC"]):
        want = [tuple(r) for r in df.orderBy(F.col("k").desc() if "DESC" in order[0] else F.col("k"), "v").collect()]
        assert all_pages(df, order, 7) == want


def test_order_items(events):
    first = page(events, ["ts DESC"], 0, 1).first()
    assert first["ts"] == events.agg(F.max("ts")).first()[0]
    with pytest.raises(ValueError):
        page(events, ["ts DESC NULLS"], 0, 1)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=0, max_size=60), page_no=st.integers(0, 8), length=st.integers(1, 9), desc=st.booleans())
def test_page_property(spark, small_steps, values, page_no, length, desc):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    rows = sorted(((i, v) for i, v in enumerate(values)), key=lambda r: (r[1] is not None, r[1] or 0, 0))
    if desc:
        rows.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    got = [tuple(r) for r in page(df, ["v DESC" if desc else "v"], page_no, length).collect()]
    assert got == rows[page_no * length:(page_no + 1) * length]


def test_order_by_a_column_that_is_not_selected(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    got = page(df, ["k DESC"], 0, 2, select=["v"])
    assert got.columns == ["v"] and [r[0] for r in got.collect()] == ["c", "b"]
    assert [r[0] for r in page(df, [(F.col("k") % 2, True), F.col("v")], 1, 2).select("v").collect()] == ["b"]
    assert [r[0] for r in page(df, None, 0, 3, select=["v"]).collect()] == ["a", "b", "c"]
