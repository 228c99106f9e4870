"""Targets laid out in ranges of their key: a batch reads and rewrites only the
ranges that it touches, and a range that grows is split."""

import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfall.operators import KeyViolation
from landfall.plans import load_into
from landfall.sources import key_ranges, read_table
from landfall.sources.key_ranges import RANGE_COLUMN, KeyRanges
from landfall.sources.tables import delete_path

from .conftest import rows

SCHEMA = "k bigint, v string"


def _location(spark, table, i):
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({RANGE_COLUMN} = {i})").collect()
    return [r["data_type"] for r in info if r["col_name"] == "Location"][0]


def _ids(spark, table):
    return sorted(int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def _table(spark, root, tag, n=1000, size=100):
    t = f"kr_{tag}.t"
    first = spark.range(n).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    assert load_into(spark, first, t, ["k"], root=root, range_rows=size).mode == "created"
    return t


def test_rows_are_dealt_by_their_keys(spark, root, tag):
    t = _table(spark, root, tag)
    got = spark.table(t).groupBy(RANGE_COLUMN).agg(F.count("*").alias("n"), F.min("k").alias("a"), F.max("k").alias("b")).orderBy("a").collect()
    assert len(got) == 10 and all(60 <= r["n"] <= 140 for r in got)
    assert all(x["b"] < y["a"] for x, y in zip(got, got[1:]))
    assert read_table(spark, t).columns == ["k", "v"] and read_table(spark, t).count() == 1000


def test_untouched_ranges_are_neither_read_nor_rewritten(spark, root, tag):
    t = _table(spark, root, tag)
    before = {i: _location(spark, t, i) for i in _ids(spark, t)}
    batch = spark.createDataFrame([(5, "new"), (7, "new"), (905, "new"), (-3, "ins"), (5000, "ins")], SCHEMA)
    touched = {r[0] for r in key_ranges.ranges_of(spark, t).assign(batch).select(RANGE_COLUMN).distinct().collect()}
    assert len(touched) <= 3
    for i, path in before.items():   # the files of all others are gone: a load that read them would fail
        if i not in touched:
            delete_path(spark, path)
    assert load_into(spark, batch, t, ["k"], root=root).mode == "merged"
    after = {i: _location(spark, t, i) for i in _ids(spark, t)}
    assert {i for i in before if before[i] != after[i]} == touched
    held = spark.table(t).where(F.col(RANGE_COLUMN).isin(*touched))
    assert held.where("v <> 'old'").count() == 5 and held.where("k = 5").first()["v"] == "new"


def test_the_scan_is_pruned(spark, root, tag):
    t = _table(spark, root, tag)
    plan = spark.table(t).where(F.col(RANGE_COLUMN).isin(1, 2))._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{RANGE_COLUMN}" in plan.replace("#", "").replace("  ", " ") or RANGE_COLUMN in plan.split("PartitionFilters")[1][:60]


def test_a_range_that_grows_is_split(spark, root, tag):
    t = _table(spark, root, tag)
    more = spark.range(2000, 2900).select(F.col("id").alias("k"), F.lit("ins").alias("v"))
    before = key_ranges.ranges_of(spark, t)
    load_into(spark, more, t, ["k"], root=root)
    after = key_ranges.ranges_of(spark, t)
    assert len(after.ids) > len(before.ids) + 6 and len(set(after.ids)) == len(after.ids) and not after.leaving
    assert list(map(int, after.starts)) == sorted(map(int, after.starts)) and before.ids[-1] not in after.ids
    sizes = {r[0]: r["count"] for r in spark.table(t).groupBy(RANGE_COLUMN).count().collect()}
    assert max(sizes.values()) <= 2 * 100 and sum(sizes.values()) == 1900
    placed = after.assign(read_table(spark, t)).select("k", RANGE_COLUMN)
    assert rows(placed) == rows(spark.table(t), "k", RANGE_COLUMN)


def test_a_split_that_died_is_finished(spark, root, tag, monkeypatch):
    t = _table(spark, root, tag, n=100, size=100)
    more = spark.range(100, 600).select(F.col("id").alias("k"), F.lit("ins").alias("v"))
    with monkeypatch.context() as m:
        m.setattr(key_ranges, "finish_split", lambda *a: None)   # the property is set, no row has moved
        load_into(spark, more, t, ["k"], root=root)
    assert key_ranges.ranges_of(spark, t).leaving and len(_ids(spark, t)) == 1
    load_into(spark, spark.createDataFrame([(50, "new"), (400, "new"), (601, "new")], SCHEMA), t, ["k"], root=root)
    assert not key_ranges.ranges_of(spark, t).leaving
    got = dict(rows(read_table(spark, t)))
    assert len(got) == 601 and [got[k] for k in (50, 400, 601)] == ["new"] * 3 and read_table(spark, t).count() == 601


def test_a_range_of_one_key_stays_whole(spark, root, tag):
    t = f"kr_{tag}.t"
    first = spark.range(300).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("line"), F.lit("v").alias("v"))
    load_into(spark, first, t, ["k", "line"], root=root, range_rows=20)
    load_into(spark, first.withColumn("line", F.col("line") + 200), t, ["k", "line"], root=root)
    assert read_table(spark, t).count() == 500


def test_long_properties_come_back(spark, root, tag):
    t = _table(spark, root, tag, n=20_000, size=10)
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {t}").collect() if r["key"].startswith("landfall.")}
    assert len(held) > 3 and max(map(len, held.values())) <= 3500
    ranges = key_ranges.ranges_of(spark, t)
    assert len(ranges.ids) > 1500 and KeyRanges.from_text(json.dumps(json.loads(ranges.to_text()))) == ranges


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz", "decimal(20,2)", "double", "int"])
def test_every_kind_of_key(spark, root, tag, kind):
    t = f"kr_{tag}.t"
    made = {"string": "concat('k', lpad(id, 4, '0'))", "date": "date_add(DATE'2000-01-01', CAST(id AS INT))", "timestamp": "timestamp_micros(id * 1000003)",
            "timestamp_ntz": "CAST(timestamp_micros(id * 1000003) AS TIMESTAMP_NTZ)"}.get(kind, f"CAST(id AS {kind})")
    first = spark.range(200).selectExpr(f"{made} AS k", "id AS v").unionByName(spark.sql(f"SELECT CAST(NULL AS {kind}) AS k, -1L AS v"))
    load_into(spark, first, t, ["k"], root=root, range_rows=20)
    assert len(_ids(spark, t)) > 5 and key_ranges.NULL_RANGE in _ids(spark, t)
    load_into(spark, first.withColumn("v", F.col("v") + 1000).where("v % 2 = 0 OR k IS NULL"), t, ["k"], root=root)
    got = sorted(r["v"] for r in read_table(spark, t).collect())
    assert got == sorted([v for v in range(200) if v % 2] + [v + 1000 for v in range(200) if v % 2 == 0] + [-1, 999])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.dictionaries(st.integers(-20, 120), st.integers(0, 9), min_size=1, max_size=25), min_size=1, max_size=3))
def test_loads_are_upserts(spark, root, tag, batches):
    t = f"kr_{tag}_{abs(hash(str(batches)))}.t"
    want: dict = {}
    for b in batches:
        load_into(spark, spark.createDataFrame(list(b.items()), "k bigint, v bigint"), t, ["k"], root=root, range_rows=5)
        want |= b
    assert dict(rows(read_table(spark, t))) == want and read_table(spark, t).count() == len(want)


def test_a_load_leaves_no_copy_behind(spark, root, tag):
    from landfall.session import ensure_checkpoint_dir
    held = ensure_checkpoint_dir(spark).removeprefix("file:") + "/landfall/batches"
    before = set(os.listdir(held)) if os.path.isdir(held) else set()
    _table(spark, root, tag)
    with pytest.raises(KeyViolation):
        load_into(spark, spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA), f"kr_{tag}.u", ["k"], root=root, range_rows=5)
    assert load_into(spark, spark.createDataFrame([], SCHEMA), f"kr_{tag}.v", ["k"], root=root, range_rows=5).mode == "skipped"
    assert not spark.catalog.tableExists(f"kr_{tag}.u") and not spark.catalog.tableExists(f"kr_{tag}.v")
    assert (set(os.listdir(held)) if os.path.isdir(held) else set()) == before


def test_the_session_may_ask_for_ranges(spark, root, tag):
    first = spark.range(100).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    spark.conf.set("landfall.load.rangeRows", "20")
    try:
        load_into(spark, first, f"kr_{tag}.a", ["k"], root=root)
        load_into(spark, first, f"kr_{tag}.b", ["k"], root=root, range_rows=0)
        load_into(spark, first, f"kr_{tag}.c", ["k"], root=root, partition_by=["v"])
    finally:
        spark.conf.unset("landfall.load.rangeRows")
    assert [key_ranges.ranges_of(spark, f"kr_{tag}.{t}") is not None for t in "abc"] == [True, False, False]


def test_own_column_of_that_name(spark, root, tag):
    with pytest.raises(ValueError):
        load_into(spark, spark.createDataFrame([(1, 2)], f"k bigint, {RANGE_COLUMN} int"), f"kr_{tag}.t", ["k"], root=root, range_rows=5)


def test_an_existing_table_is_laid_out(spark, root, tag):
    t = f"kr_{tag}.t"
    load_into(spark, spark.range(500).select(F.col("id").alias("k"), F.lit("old").alias("v")), t, ["k"], root=root)
    ranges = key_ranges.lay_out(spark, t, "k", 50, root)
    assert len(ranges.ids) == 10 and key_ranges.ranges_of(spark, t) == ranges and read_table(spark, t).count() == 500
    before = {i: _location(spark, t, i) for i in _ids(spark, t)}
    load_into(spark, spark.createDataFrame([(7, "new"), (900, "new")], SCHEMA), t, ["k"], root=root)
    assert sum(_location(spark, t, i) != p for i, p in before.items()) == 2
    got = dict(rows(read_table(spark, t)))
    assert len(got) == 501 and got[7] == got[900] == "new" and got[8] == "old"
    with pytest.raises(ValueError):
        key_ranges.lay_out(spark, t, "k", 50, root)


def test_a_layout_that_died_is_finished(spark, root, tag, monkeypatch):
    t = f"kr_{tag}.t"
    load_into(spark, spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v")), t, ["k"], root=root)
    with monkeypatch.context() as m:
        m.setattr(key_ranges, "_take_name", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            key_ranges.lay_out(spark, t, "k", 20, root)
    assert not spark.catalog.tableExists(t)
    key_ranges.lay_out(spark, t, "k", 20, root)
    assert read_table(spark, t).count() == 100 and len(_ids(spark, t)) == 5
