"""Partition-scoped upsert: only touched partitions are read and rewritten."""

import threading

from hypothesis import given, settings
from hypothesis import strategies as st

from landfall.operators import upsert
from landfall.plans import load, load_into
from landfall.sources import tables

from .conftest import rows

SCHEMA = "k bigint, v string, p string"


def _location(spark, table, p):
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (p = '{p}')").collect()
    return [r["data_type"] for r in info if r["col_name"] == "Location"][0]


def _partitions(spark, table):
    return sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def test_first_load_keeps_declared_types(spark, root, tag):
    t = f"pt_{tag}.t"
    df = spark.createDataFrame([(1, "a", "007"), (2, "b", "010")], SCHEMA)
    assert load_into(spark, df, t, ["k"], root=root, partition_by=["p"]).mode == "created"
    assert spark.table(t).schema["p"].dataType.simpleString() == "string"
    assert _partitions(spark, t) == ["p=007", "p=010"]
    assert rows(spark.table(t), "k", "v", "p") == [(1, "a", "007"), (2, "b", "010")]


def test_only_touched_partitions_are_rewritten(spark, root, tag):
    t = f"pt_{tag}.t"
    first = spark.createDataFrame([(i, "v", f"p{i % 4}") for i in range(40)], SCHEMA)
    load_into(spark, first, t, ["k"], root=root, partition_by=["p"])
    before = {p: _location(spark, t, p) for p in ("p0", "p1", "p2", "p3")}
    batch = spark.createDataFrame([(1, "new", "p1"), (100, "ins", "p1"), (200, "ins", "p9")],
                                  SCHEMA)
    r = load_into(spark, batch, t, ["k"], root=root)
    assert (r.mode, r.movements) == ("merged", 3)
    after = {p: _location(spark, t, p) for p in ("p0", "p1", "p2", "p3")}
    assert after["p0"] == before["p0"] and after["p2"] == before["p2"]
    assert after["p3"] == before["p3"] and after["p1"] != before["p1"]
    assert _partitions(spark, t) == ["p=p0", "p=p1", "p=p2", "p=p3", "p=p9"]
    got = {k: (v, p) for k, v, p in rows(spark.table(t), "k", "v", "p")}
    assert len(got) == 42 and got[1] == ("new", "p1") and got[200] == ("ins", "p9")


def test_moved_key_leaves_no_copy_and_empty_partitions_go(spark, root, tag):
    t = f"pt_{tag}.t"
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "y")], SCHEMA)
    load_into(spark, first, t, ["k"], root=root, partition_by=["p"])
    load_into(spark, spark.createDataFrame([(1, "a2", "y")], SCHEMA), t, ["k"], root=root)
    assert rows(spark.table(t), "k", "v", "p") == [(1, "a2", "y"), (2, "b", "y"), (3, "c", "y")]
    assert _partitions(spark, t) == ["p=y"]


_rows = st.lists(st.tuples(st.integers(0, 15), st.sampled_from(["a", "b"]),
                           st.sampled_from(["p", "q", "r", "s"])),
                 max_size=10, unique_by=lambda x: x[0])


@settings(max_examples=6, deadline=None)
@given(target=_rows, batch=_rows)
def test_partitioned_equals_plain_upsert(spark, target, batch):
    import uuid

    from landfall.session import scratch_path
    root = scratch_path(spark, "test-warehouse")
    t = f"pt_{uuid.uuid4().hex[:8]}.t"
    tdf = spark.createDataFrame(target, SCHEMA)
    bdf = spark.createDataFrame(batch, SCHEMA)
    expected = rows(upsert(tdf, bdf, ["k"]), "k", "v", "p")
    load_into(spark, tdf, t, ["k"], root=root, partition_by=["p"])
    load_into(spark, bdf, t, ["k"], root=root)
    if target:
        assert rows(spark.table(t), "k", "v", "p") == expected


def test_two_partition_columns_null_and_escaped_values(spark, root, tag):
    t = f"pt_{tag}.m"
    schema = "k bigint, v string, a string, b int"
    first = spark.createDataFrame([(1, "x", "a/b", 1), (2, "y", None, 2), (3, "z", "c=d", None)],
                                  schema)
    load_into(spark, first, t, ["k"], root=root, partition_by=["a", "b"])
    batch = spark.createDataFrame([(2, "Y", None, 2), (3, "Z", "c=d", None), (4, "w", "a/b", 1),
                                   (1, "X", "e f", 5)], schema)
    load_into(spark, batch, t, ["k"], root=root)
    assert rows(spark.table(t), "k", "v", "a", "b") == sorted(
        [(1, "X", "e f", 5), (2, "Y", None, 2), (3, "Z", "c=d", None), (4, "w", "a/b", 1)],
        key=repr)


def test_mixed_case_partition_column(spark, root, tag):
    t = f"pt_{tag}.mc"
    schema = "OrderKey bigint, OrderStatus string, Qty int"
    load_into(spark, spark.createDataFrame([(1, "O", 1), (2, "F", 2)], schema), t, ["OrderKey"],
              root=root, partition_by=["OrderStatus"])
    load_into(spark, spark.createDataFrame([(1, "F", 5), (3, "P", 1)], schema), t, ["OrderKey"],
              root=root)
    assert rows(spark.table(t), "OrderKey", "OrderStatus", "Qty") == [
        (1, "F", 5), (2, "F", 2), (3, "P", 1)]
    assert _partitions(spark, t) == ["OrderStatus=F", "OrderStatus=P"]


def test_whole_table_snapshot_refused_on_partitioned_tables(spark, root, tag):
    import pytest

    from landfall.sources import write_snapshot
    t = f"pt_{tag}.w"
    df = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    load_into(spark, df, t, ["k"], root=root, partition_by=["p"])
    with pytest.raises(ValueError, match="partitioned"):
        write_snapshot(spark, df, t, root)


@settings(max_examples=6, deadline=None)
@given(target=_rows, batch=_rows)
def test_unpartitioned_load_equals_plain_upsert(spark, target, batch):
    import uuid

    from landfall.session import scratch_path
    root = scratch_path(spark, "test-warehouse")
    t = f"up_{uuid.uuid4().hex[:8]}.t"
    tdf = spark.createDataFrame(target, SCHEMA)
    bdf = spark.createDataFrame(batch, SCHEMA)
    expected = rows(upsert(tdf, bdf, ["k"]), "k", "v", "p")
    load_into(spark, tdf, t, ["k"], root=root)
    load_into(spark, bdf, t, ["k"], root=root, cluster_by=["p"])
    if target:
        assert rows(spark.table(t), "k", "v", "p") == expected


def test_empty_partition_values_are_refused(spark, root, tag):
    import os

    import pytest
    t = f"pt_{tag}.e"
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "")], SCHEMA)
    with pytest.raises(ValueError, match="empty strings"):
        load_into(spark, df, t, ["k"], root=root, partition_by=["p"])
    base = f"{root}/pt_{tag}.db/e".removeprefix("file:")
    assert not spark.catalog.tableExists(t) and not [d for d in os.listdir(base) if d.startswith("snapshot")]


def test_untouched_partitions_are_not_read(spark, root, tag):
    import shutil

    t = f"pt_{tag}.u"
    load_into(spark, spark.createDataFrame([(i, "v", f"p{i % 4}") for i in range(8)], SCHEMA), t, ["k"], root=root, partition_by=["p"])
    for p in ("p0", "p2"):   # reading one of these would fail
        shutil.rmtree(_location(spark, t, p).removeprefix("file:"))
    load_into(spark, spark.createDataFrame([(1, "new", "p1")], SCHEMA), t, ["k"], root=root, stable_partitions=True)
    assert rows(spark.table(t).where("p = 'p1'"), "k", "v") == [(1, "new"), (5, "v")]


def test_retention_works_on_each_partition(spark, root, tag):
    import glob

    t = f"pt_{tag}.r"
    base = f"{root}/pt_{tag}.db/r".removeprefix("file:")
    load = lambda data, **o: load_into(spark, spark.createDataFrame(data, SCHEMA), t, ["k"], root=root, **o)
    load([(1, "a", "x"), (2, "b", "y")], partition_by=["p"])
    for i in range(4):
        load([(1, f"a{i}", "x")], retain_snapshots=2)
    assert len(glob.glob(f"{base}/snapshot-*/p=x")) == 2 and len(glob.glob(f"{base}/snapshot-*/p=y")) == 1
    assert rows(spark.table(t), "k", "v", "p") == [(1, "a3", "x"), (2, "b", "y")]


def test_a_switch_cut_off_half_way_is_healed_by_the_same_batch(spark, root, tag, monkeypatch):
    """Keys that all move partition, the writer gone after the first catalog call."""
    import pytest

    t = f"pt_{tag}.f"
    load_into(spark, spark.createDataFrame([(i, "old", "x" if i < 5 else "y") for i in range(10)], SCHEMA), t, ["k"], root=root, partition_by=["p"])
    batch = spark.createDataFrame([(i, "new", "y" if i < 5 else "x") for i in range(10)], SCHEMA)
    plain, seen = type(spark).sql, []

    def failing(self, query, *args, **kwargs):
        if "SET LOCATION" in query:
            seen.append(query)
            if len(seen) == 2:
                raise RuntimeError("the writer died")
        return plain(self, query, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError, match="died"):
        load_into(spark, batch, t, ["k"], root=root)
    monkeypatch.setattr(type(spark), "sql", plain)
    load_into(spark, batch, t, ["k"], root=root)
    assert rows(spark.table(t), "k", "v", "p") == [(i, "new", "y" if i < 5 else "x") for i in range(10)]


def test_several_partition_columns_are_told_apart(spark, root, tag):
    """Values that would run into each other side by side, and nulls."""
    t = f"pt_{tag}.m"
    pairs = [("a", "b-c"), ("a-b", "c"), ("1:a", None), (None, "1:a"), ("-", "x"), (None, None), ("é漢", "2")]
    first = spark.createDataFrame([(i, "old", a, b) for i, (a, b) in enumerate(pairs)], "k bigint, v string, p string, q string")
    load_into(spark, first, t, ["k"], root=root, partition_by=["p", "q"])
    batch = spark.createDataFrame([(0, "new", "a", "b-c"), (2, "new", "1:a", None), (9, "new", None, None)], first.schema)
    load_into(spark, batch, t, ["k"], root=root)
    want = {i: ("old", a, b) for i, (a, b) in enumerate(pairs)} | {0: ("new", "a", "b-c"), 2: ("new", "1:a", None), 9: ("new", None, None)}
    assert {r["k"]: (r["v"], r["p"], r["q"]) for r in spark.table(t).collect()} == want


def test_partitions_are_repointed_side_by_side(spark, root, tag, monkeypatch):
    t = f"pt_{tag}.t"
    load_into(spark, spark.createDataFrame([(i, "a", f"p{i}") for i in range(4)], SCHEMA), t, ["k"], root=root, partition_by=["p"])
    meet, run = threading.Barrier(4, timeout=30), type(spark).sql

    def sql(self, text, *args, **kw):
        if "SET LOCATION" in text:
            meet.wait()   # one after the other, they would wait for ever
        return run(self, text, *args, **kw)

    monkeypatch.setattr(type(spark), "sql", sql)
    load_into(spark, spark.createDataFrame([(i, "b", f"p{i}") for i in range(4)], SCHEMA), t, ["k"], root=root)
    monkeypatch.undo()
    assert rows(spark.table(t), "k", "v", "p") == [(i, "b", f"p{i}") for i in range(4)]


def test_a_load_lists_folders_in_few_tasks_and_restores_the_session(spark, root, tag, monkeypatch):
    t, seen, write = f"pt_{tag}.t", [], load.write_batch_observed

    def observed(*args):
        seen.append(spark.conf.get(tables._CONF_LISTING))
        return write(*args)

    monkeypatch.setattr(load, "write_batch_observed", observed)
    df = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    before = spark.conf.get(tables._CONF_LISTING)
    load_into(spark, df, t, ["k"], root=root, partition_by=["p"])
    with tables.few_listing_tasks(spark):
        load_into(spark, df, t, ["k"], root=root)
        assert spark.conf.get(tables._CONF_LISTING) == str(tables.LISTING_TASKS)
    assert seen == [str(tables.LISTING_TASKS)] * 2 and spark.conf.get(tables._CONF_LISTING) == before
