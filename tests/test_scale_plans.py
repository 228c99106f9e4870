"""Plan-shape checks for the properties that matter at scale, and the
reference's edge-case decisions that the pipeline must keep."""

import uuid

import pytest
from pyspark.sql import functions as F

from landfall.operators import duplicate_keys, merge_actions, upsert
from landfall.plans import (control_frame, land, load_into, stage)
from landfall.sources import JdbcConnection, Zones, qualified

from .conftest import rows


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_batch_never_shuffles_the_target(spark):
    target = spark.range(0, 200_000, numPartitions=8).selectExpr("id AS k", "id % 7 AS v")
    batch = spark.range(0, 50).selectExpr("id * 3 AS k", "-1L AS v")
    out = upsert(target, batch, ["k"], source_rows=50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning(k" not in plan  # neither side is hash-shuffled
    assert out.count() == 200_000


def test_merge_actions_probe_is_broadcast(spark):
    target = spark.range(0, 100_000).selectExpr("id AS k", "'x' AS v")
    batch = spark.range(99_990, 100_010).selectExpr("id AS k", "'y' AS v")
    m = merge_actions(target, batch, ["k"], source_rows=20)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows(m.groupBy("action").count()) == [("insert", 10), ("update", 10)]


def test_null_key_third_of_target_bypasses_the_join(spark):
    n = 30_000
    target = spark.range(0, n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS k", "id AS v")
    batch = spark.range(0, 100).selectExpr("id AS k", "-1L AS v")
    old = spark.conf.get("landfall.upsert.broadcastMaxBytes", None)
    spark.conf.set("landfall.upsert.broadcastMaxBytes", "1")  # force the shuffle join
    try:
        out = upsert(target, batch, ["k"], source_rows=100)
        assert out.count() == n - (100 - 34) + 100
        assert out.where("k IS NULL").count() == n // 3
    finally:
        if old is None:
            spark.conf.unset("landfall.upsert.broadcastMaxBytes")
        else:
            spark.conf.set("landfall.upsert.broadcastMaxBytes", old)


def test_hot_key_is_collapsed_before_the_shuffle(spark):
    df = spark.range(0, 60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k")
    dups = duplicate_keys(df, ["k"])
    plan = _executed(dups)
    assert "partial_count" in plan  # map-side partial aggregation
    assert rows(dups) == [(1, 20_001)]


def test_land_with_null_filter_is_a_full_upsert(spark, root):
    url = f"jdbc:derby:memory:nf{uuid.uuid4().hex[:8]};create=true"
    src = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    src.write.format("jdbc").option("url", url).option("dbtable", "APP.t").mode("overwrite").save()
    zones = Zones(raw=f"r{uuid.uuid4().hex[:6]}")
    ctl = control_frame(spark, [{"schema_name": "APP", "table_name": "t", "primary_key": "k",
                                 "active": True, "filter": None}])
    land(spark, ctl, JdbcConnection(url), "2024-01-02", zones=zones, root=root)
    src2 = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    src2.write.format("jdbc").option("url", url).option("dbtable", "APP.t").mode("overwrite").save()
    recs = land(spark, ctl, JdbcConnection(url), "2024-01-03", zones=zones, root=root)
    assert recs[0].movements == 2
    assert rows(spark.table(qualified(zones.raw, "APP", "t"))) == [(1, "a"), (2, "B"), (3, "c")]


def test_bad_key_lists_fail_only_their_route(spark, root):
    zones = Zones(raw=f"r{uuid.uuid4().hex[:6]}", stg=f"s{uuid.uuid4().hex[:6]}")
    for t in ("Good", "Bad"):
        load_into(spark, spark.createDataFrame([(1, 2, "x")], "AId int, BId int, Val string"),
                  qualified(zones.raw, "S", t), ["AId", "BId"], root=root)
    ctl = control_frame(spark, [
        {"schema_name": "S", "table_name": "Good", "primary_key": "AId, BId",
         "stg_primary_key": "a, b", "active": True},
        {"schema_name": "S", "table_name": "Bad", "primary_key": "AId, BId",
         "stg_primary_key": "id", "active": True},
        {"schema_name": "S", "table_name": "Unrouted", "primary_key": "x", "active": True},
    ])
    routes = {("S", "Good"): [("good", None)], ("S", "Bad"): [("bad", None)]}
    recs = stage(spark, ctl, routes, "2024-01-02", zones=zones, root=root,
                 raise_on_failure=False)
    by = {r.target.table_name: r for r in recs}
    assert set(by) == {"good", "bad"}  # tables without a route are not staged
    assert by["good"].movements == 1 and by["good"].error is None
    assert "same length" in by["bad"].error
    assert spark.table(qualified(zones.stg, "s", "good")).columns == ["a", "b", "val"]
    with pytest.raises(Exception):
        stage(spark, ctl, routes, "2024-01-02", zones=zones, root=root)


def test_page_select_and_first_column_default(spark):
    from landfall.operators import page
    df = spark.createDataFrame([(2, "b", 1.0), (1, "a", 2.0)], "k int, v string, w double")
    assert page(df, None, 0, 1, select=["v", "k"]).collect()[0]["v"] == "a"


def test_duplicate_control_rows_are_refused(spark, root):
    from landfall.operators import KeyViolation
    row = {"schema_name": "S", "table_name": "T", "primary_key": "k", "active": True}
    ctl = control_frame(spark, [row, dict(row)])
    with pytest.raises(KeyViolation):
        stage(spark, ctl, {("S", "T"): [("t", None)]}, "2024-01-02", root=root)


def test_dotted_column_names(spark):
    t = spark.createDataFrame([(1, "a")], "`k.id` int, v string")
    s = spark.createDataFrame([(1, "b"), (2, "c")], "`k.id` int, v string")
    assert rows(upsert(t, s, ["k.id"], source_rows=2)) == [(1, "b"), (2, "c")]
    assert rows(merge_actions(t, s, ["k.id"])) == [(1, "update"), (2, "insert")]


def test_hot_sort_value_is_spread_over_ranges(spark):
    from landfall.operators import page
    n = 30_000
    df = spark.range(0, n, numPartitions=8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS ts", "id")
    every = page(df, ["ts"], 0, 0)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")  # small test data would otherwise be merged into one task
    try:
        sizes = every.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set(key, old)
    assert max(r["count"] for r in sizes) < n // 3  # the hot value did not land in one task
    got = [r["ts"] for r in every.collect()]
    assert got == sorted(got)
    deep = page(df, ["ts"], 500, 20)
    assert [r["ts"] for r in deep.collect()] == got[10_000:10_020]


def test_land_selected_without_the_filter_column(spark, root):
    import datetime as dt
    url = f"jdbc:derby:memory:sel{uuid.uuid4().hex[:8]};create=true"
    old, new = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 2, 8)
    src = spark.createDataFrame([(1, "a", old), (2, "b", old)], "k int, v string, ts timestamp")
    src.write.format("jdbc").option("url", url).option("dbtable", "APP.s").mode("overwrite").save()
    zones = Zones(raw=f"r{uuid.uuid4().hex[:6]}")
    ctl = control_frame(spark, [{"schema_name": "APP", "table_name": "s", "primary_key": "k",
                                 "active": True, "filter": '"ts" >= :start_date',
                                 "selected": "k, v", "partition_column": "k",
                                 "num_partitions": None}])
    land(spark, ctl, JdbcConnection(url), "2024-01-02", zones=zones, root=root)
    src2 = spark.createDataFrame([(1, "a", old), (2, "B", new), (3, "c", new)],
                                 "k int, v string, ts timestamp")
    src2.write.format("jdbc").option("url", url).option("dbtable", "APP.s").mode("overwrite").save()
    recs = land(spark, ctl, JdbcConnection(url), "2024-01-03", zones=zones, root=root)
    assert recs[0].movements == 2
    raw = spark.table(qualified(zones.raw, "APP", "s"))
    assert raw.columns == ["k", "v"]
    assert rows(raw) == [(1, "a"), (2, "B"), (3, "c")]


def test_land_split_by_key(spark, root):
    import datetime as dt
    url = f"jdbc:derby:memory:sk{uuid.uuid4().hex[:8]};create=true"
    day = dt.datetime(2024, 1, 2, 8)
    ints = spark.createDataFrame([(i, "v", day) for i in range(200)], "k int, v string, ts timestamp")
    strs = spark.createDataFrame([("a", "v", day), ("b", "w", day)], "c string, v string, ts timestamp")
    for name, df in (("ints", ints), ("strs", strs)):
        df.write.format("jdbc").option("url", url).option("dbtable", f"APP.{name}") \
            .mode("overwrite").save()
    zones = Zones(raw=f"r{uuid.uuid4().hex[:6]}")
    ctl = control_frame(spark, [
        {"schema_name": "APP", "table_name": "ints", "primary_key": "k", "active": True,
         "filter": '"ts" >= :start_date', "partition_column": "ts", "num_partitions": 4},
        {"schema_name": "APP", "table_name": "strs", "primary_key": "c", "active": True,
         "filter": '"ts" >= :start_date', "partition_column": "ts", "num_partitions": 4}])
    for run in ("2024-01-02", "2024-01-03"):  # full, then incremental (same rows again)
        recs = land(spark, ctl, JdbcConnection(url), run, zones=zones, root=root,
                    split_by_key=True)
        assert {r.target.table_name: r.movements for r in recs} == {"ints": 200, "strs": 2}
    assert spark.table(qualified(zones.raw, "APP", "ints")).count() == 200
    assert spark.table(qualified(zones.raw, "APP", "strs")).count() == 2


def test_load_into_with_mapped_keys(spark, root, tag):
    t = f"mk_{tag}.t"
    load_into(spark, spark.createDataFrame([(1, "a")], "SrcK int, v string"), t, {"SrcK": "k"},
              root=root)
    assert spark.table(t).columns == ["k", "v"]
    load_into(spark, spark.createDataFrame([(1, "b"), (2, "c")], "SrcK int, v string"), t,
              {"SrcK": "k"}, root=root)
    assert rows(spark.table(t)) == [(1, "b"), (2, "c")]


def test_upsert_matches_column_names_case_insensitively(spark):
    t = spark.createDataFrame([(1, "a")], "Key int, Val string")
    s = spark.createDataFrame([(1, "b"), (2, "c")], "key int, val string")
    out = upsert(t, s, ["KEY"])
    assert out.columns == ["Key", "Val"]
    assert rows(out) == [(1, "b"), (2, "c")]


def test_stage_with_selected_columns(spark, root):
    zones = Zones(raw=f"r{uuid.uuid4().hex[:6]}", stg=f"s{uuid.uuid4().hex[:6]}")
    load_into(spark, spark.createDataFrame([(1, "x", 5)], "OrderID int, Note string, Qty int"),
              qualified(zones.raw, "S", "Orders"), ["OrderID"], root=root)
    ctl = control_frame(spark, [{"schema_name": "S", "table_name": "Orders",
                                 "primary_key": "OrderID", "stg_primary_key": "id",
                                 "active": True, "selected": "OrderID, Qty"}])
    stage(spark, ctl, {("S", "Orders"): [("orders", None)]}, "2024-01-02", zones=zones, root=root)
    out = spark.table(qualified(zones.stg, "s", "orders"))
    assert out.columns == ["id", "qty"] and rows(out) == [(1, 5)]


def test_rerunning_a_day_changes_nothing(spark, root):
    import datetime as dt
    url = f"jdbc:derby:memory:rr{uuid.uuid4().hex[:8]};create=true"
    old, new = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 2, 9)
    spark.createDataFrame([(1, "a", old), (2, "b", old)], "k int, v string, ts timestamp") \
        .write.format("jdbc").option("url", url).option("dbtable", "APP.r").mode("overwrite").save()
    zones = Zones(raw=f"r{uuid.uuid4().hex[:6]}")
    ctl = control_frame(spark, [{"schema_name": "APP", "table_name": "r", "primary_key": "k",
                                 "active": True, "filter": '"ts" >= :start_date',
                                 "partition_column": "k", "num_partitions": 2}])
    land(spark, ctl, JdbcConnection(url), "2024-01-02", zones=zones, root=root)
    spark.createDataFrame([(1, "a", old), (2, "B", new), (3, "c", new)],
                          "k int, v string, ts timestamp") \
        .write.format("jdbc").option("url", url).option("dbtable", "APP.r").mode("overwrite").save()
    raw = qualified(zones.raw, "APP", "r")
    land(spark, ctl, JdbcConnection(url), "2024-01-03", zones=zones, root=root)
    once = rows(spark.table(raw))
    land(spark, ctl, JdbcConnection(url), "2024-01-03", zones=zones, root=root)
    assert rows(spark.table(raw)) == once
    assert [r[:2] for r in once] == [(1, "a"), (2, "B"), (3, "c")]
