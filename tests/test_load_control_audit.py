import pytest
from pyspark.sql import functions as F

from landfall.domains import sales
from landfall.operators import KeyViolation
from landfall.plans import (CONTROL_SCHEMA, LogRecord, Place, active_for_land, active_for_stage,
                            active_schemas, append_log, control_frame, control_problems,
                            key_lists, load_into, seed_control, set_active, set_flag)
from landfall.sources import Zones, qualified, stage_batch, write_snapshot

from .conftest import rows

SCHEMA = "k bigint, v string"


def test_load_dispatch(spark, root, tag):
    target = f"t_{tag}.x"
    with pytest.raises(ValueError, match="source was not read"):
        load_into(spark, None, target, ["k"], root=root)
    empty = spark.createDataFrame([], SCHEMA)
    assert load_into(spark, empty, target, ["k"], root=root).mode == "skipped"
    assert not spark.catalog.tableExists(target)
    first = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    r = load_into(spark, first, target, ["k"], root=root)
    assert (r.mode, r.movements) == ("created", 2)
    r = load_into(spark, spark.createDataFrame([(2, "B"), (3, "c")], SCHEMA), target, ["k"],
                  root=root)
    assert (r.mode, r.movements) == ("merged", 2)
    assert rows(spark.table(target)) == [(1, "a"), (2, "B"), (3, "c")]
    assert load_into(spark, empty, target, ["k"], root=root).mode == "skipped"
    assert spark.table(target).count() == 3


def test_first_load_rejects_duplicates_unless_allowed(spark, root, tag):
    dup = spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA)
    with pytest.raises(KeyViolation):
        load_into(spark, dup, f"t_{tag}.d", ["k"], root=root)
    assert load_into(spark, dup, f"t_{tag}.d", ["k"], root=root, check_unique=False).movements == 2


def test_snapshot_swap_keeps_old_readers(spark, root, tag):
    name = f"t_{tag}.s"
    write_snapshot(spark, spark.createDataFrame([(1, "a")], SCHEMA), name, root)
    old = spark.table(name)
    old_rows = rows(old)
    write_snapshot(spark, spark.createDataFrame([(2, "b"), (3, "c")], SCHEMA), name, root)
    assert rows(spark.table(name)) == [(2, "b"), (3, "c")]
    assert old_rows == [(1, "a")]


def test_stage_batch_counts_in_one_pass(spark):
    df = spark.range(0, 1234).selectExpr("id AS k", "'v' AS v")
    staged, n = stage_batch(df)
    assert n == 1234 and staged.count() == 1234


def test_seed_control(spark, root, tag):
    name = f"c_{tag}.data_ingestion"
    assert seed_control(spark, name, sales.seed_dicts(), root) == 19
    ctl = spark.table(name)
    assert ctl.columns == CONTROL_SCHEMA.fieldNames()
    assert ctl.where("active").count() == 19
    r = ctl.where("table_name = 'CountryRegionCurrency'").first()
    assert r["partition_column"] is None and r["num_partitions"] is None
    # repeat: nothing new; a switched-off row stays off
    set_active(spark, name, "Sales", "Store", False, root)
    assert seed_control(spark, name, sales.seed_dicts(), root) == 0
    assert spark.table(name).where("table_name = 'Store'").first()["active"] is False
    assert spark.table(name).count() == 19


def test_set_active_with_no_match_is_fine(spark, root, tag):
    name = f"c_{tag}.data_ingestion"
    seed_control(spark, name, sales.seed_dicts()[:2], root)
    set_active(spark, name, "Sales", "Nope", False, root)
    assert spark.table(name).where("active").count() == 2


def test_active_projections(spark):
    ctl = control_frame(spark, sales.seed_dicts())
    assert active_for_land(ctl).columns == ["schema_name", "table_name", "primary_key", "filter",
                                            "selected", "partition_column", "num_partitions"]
    assert active_for_stage(ctl).columns == ["schema_name", "table_name", "primary_key",
                                             "stg_primary_key", "filter", "selected"]
    off = set_flag(ctl, {"schema_name": "Sales", "table_name": "Store"}, "active", False)
    assert active_for_land(off).count() == 18


def test_active_schemas_keeps_mixed_schema(spark):
    ctl = control_frame(spark, [
        {"schema_name": "Mixed", "table_name": "A", "primary_key": "id", "active": False},
        {"schema_name": "Mixed", "table_name": "B", "primary_key": "id", "active": True},
        {"schema_name": "Off", "table_name": "C", "primary_key": "id", "active": False},
    ] * 1)
    assert rows(active_schemas(ctl)) == [("Mixed",)]


def test_key_lists_and_length_check(spark):
    ctl = control_frame(spark, [
        {"schema_name": "S", "table_name": "A", "primary_key": "A, B", "stg_primary_key": "x",
         "active": True},
        {"schema_name": "S", "table_name": "B", "primary_key": "OrderID",
         "stg_primary_key": None, "active": True, "selected": "OrderID, Qty"},
    ])
    kl = {r["table_name"]: r for r in key_lists(ctl).collect()}
    assert kl["A"]["primary_key_list"] == ["A", "B"] and kl["A"]["staging_key"] == ["x"]
    assert kl["B"]["staging_key"] == ["order_id"] and kl["B"]["selected_list"] == ["OrderID", "Qty"]
    assert [r["table_name"] for r in control_problems(ctl).collect()] == ["A"]


def test_append_log_by_name(spark, root, tag):
    name = f"c_{tag}.data_ingestion_log"
    recs = [LogRecord(Place(None, "Sales", "Store"), Place("raw", "Sales", "Store"), movements=3),
            LogRecord(Place(None, "Sales", "Bad"), Place("raw", "Sales", "Bad"), error="ValueError('x')")]
    append_log(spark, name, recs, root)
    append_log(spark, name, recs[:1], root)
    log = spark.table(name)
    assert len(log.inputFiles()) <= 3   # one file for each run, and the empty one of its creation
    assert log.columns[0] == "ingestion_date" and log.columns[-1] == "error"
    assert log.count() == 3
    assert log.where(F.col("ingestion_date").isNull()).count() == 0
    assert rows(log, "target_table_name", "movements", "error") == [
        ("Bad", None, "ValueError('x')"), ("Store", 3, None), ("Store", 3, None)]


def test_expire_snapshots_keeps_current_and_recent(spark, root, tag):
    import os

    from landfall.sources import expire_snapshots
    name = f"t_{tag}.e"
    for i in range(4):
        load_into(spark, spark.createDataFrame([(i, str(i))], SCHEMA), name, ["k"], root=root)
    base = f"{root}/t_{tag}.db/e".removeprefix("file:")
    assert len([d for d in os.listdir(base) if d.startswith("snapshot-")]) == 4
    deleted = expire_snapshots(spark, name, retain=2)
    assert len(deleted) == 2
    assert len([d for d in os.listdir(base) if d.startswith("snapshot-")]) == 2
    spark.catalog.refreshTable(name)
    assert rows(spark.table(name)) == [(0, "0"), (1, "1"), (2, "2"), (3, "3")]


def test_expire_snapshots_keeps_partition_folders_in_use(spark, root, tag):
    from landfall.sources import expire_snapshots
    name = f"t_{tag}.pe"
    schema = "k bigint, v string, p string"
    load_into(spark, spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], schema), name, ["k"],
              root=root, partition_by=["p"])
    load_into(spark, spark.createDataFrame([(1, "A", "x")], schema), name, ["k"], root=root)
    load_into(spark, spark.createDataFrame([(3, "c", "z")], schema), name, ["k"], root=root)
    expire_snapshots(spark, name, retain=1)
    spark.catalog.refreshTable(name)
    # partition y still lives in the first snapshot folder, which is kept
    assert rows(spark.table(name), "k", "v", "p") == [(1, "A", "x"), (2, "b", "y"), (3, "c", "z")]


def test_merges_leave_nothing_in_the_scratch_folder(spark, root, tag):
    import os

    from landfall.session import ensure_checkpoint_dir
    batches = ensure_checkpoint_dir(spark).removeprefix("file:") + "/landfall/batches"
    name = f"t_{tag}.sb"
    load_into(spark, spark.createDataFrame([(1, "a")], SCHEMA), name, ["k"], root=root)
    before = set(os.listdir(batches)) if os.path.isdir(batches) else set()
    load_into(spark, spark.createDataFrame([(1, "b")], SCHEMA), name, ["k"], root=root)
    after = set(os.listdir(batches)) if os.path.isdir(batches) else set()
    assert after <= before
    assert rows(spark.table(name)) == [(1, "b")]


def test_log_holds_counts_beyond_32_bits(spark, root, tag):
    name = f"c_{tag}.big_log"
    append_log(spark, name, [LogRecord(Place(None, "S", "Big"), Place("raw", "S", "Big"), movements=3_000_000_000)], root)
    assert spark.table(name).first()["movements"] == 3_000_000_000


def test_load_into_keeps_only_the_retained_snapshots(spark, root, tag):
    import os
    name = f"t_{tag}.rt"
    for i in range(5):
        load_into(spark, spark.createDataFrame([(i, str(i))], SCHEMA), name, ["k"], root=root,
                  retain_snapshots=2)
    base = f"{root}/t_{tag}.db/rt".removeprefix("file:")
    assert len([d for d in os.listdir(base) if d.startswith("snapshot-")]) == 2
    assert rows(spark.table(name)) == [(i, str(i)) for i in range(5)]


def test_rejected_and_failed_loads_leave_nothing_and_displace_nothing(spark, root, tag):
    import os

    name = f"t_{tag}.rj"
    base = f"{root}/t_{tag}.db/rj".removeprefix("file:")
    load = lambda data, **o: load_into(spark, spark.createDataFrame(data, SCHEMA), name, ["k"], root=root, **o)
    folders = lambda: sorted(d for d in os.listdir(base) if d.startswith("snapshot-"))
    assert load([]).mode == "skipped" and (not os.path.isdir(base) or folders() == [])
    load([(1, "a")])
    load([(2, "b")])
    before = folders()
    for _ in range(2):
        with pytest.raises(KeyViolation):
            load([(3, "x"), (3, "y")])
    assert load([]).mode == "skipped" and folders() == before
    previous = spark.table(name)
    previous_rows = previous.inputFiles()
    load([(4, "d")], retain_snapshots=2)
    assert len(folders()) == 2 and before[-1] in folders()   # the snapshot that stood before is still there
    assert all(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in previous_rows)
    assert rows(spark.table(name)) == [(1, "a"), (2, "b"), (4, "d")]


def test_folders_of_dead_writers_are_no_versions(spark, root, tag):
    import os

    from landfall.sources import expire_snapshots
    name = f"t_{tag}.dw"
    for i in range(3):
        load_into(spark, spark.createDataFrame([(i, str(i))], SCHEMA), name, ["k"], root=root)
    base = f"{root}/t_{tag}.db/dw".removeprefix("file:")
    os.makedirs(f"{base}/snapshot-999999999999999-dead")
    expire_snapshots(spark, name, 2)
    left = [d for d in os.listdir(base) if d.startswith("snapshot-")]
    assert len(left) == 2 and not any("dead" in d for d in left) and spark.table(name).count() == 3


def test_a_source_that_grows_a_column_keeps_loading(spark, root, tag, caplog):
    name = f"t_{tag}.gr"
    load_into(spark, spark.createDataFrame([(1, "a")], SCHEMA), name, ["k"], root=root)
    wide = spark.createDataFrame([(1, "A", 5), (2, "b", 6)], SCHEMA + ", more int")
    got = load_into(spark, wide, name, ["k"], root=root)
    assert got.ignored == ("more",) and "more" in caplog.text
    assert rows(spark.table(name)) == [(1, "A"), (2, "b")]


def _store_control(spark):
    names = CONTROL_SCHEMA.fieldNames()
    row = dict.fromkeys(names) | {"schema_name": "Sales", "table_name": "Store", "primary_key": "Id", "active": True, "filter": "Changed"}
    return spark.createDataFrame([tuple(row[n] for n in names)], CONTROL_SCHEMA)


def test_a_window_of_several_targets_is_read_once(spark, root, tag, monkeypatch):
    """Two routes of one raw table: each load of a window reads the raw table once, and staging the
    window fails for both routes if the raw table is gone."""
    from landfall.plans import stage as stage_task
    import sys
    module = sys.modules["landfall.plans.stage"]
    zones = Zones(ctr=f"c{tag}", raw=f"r{tag}", stg=f"s{tag}")
    raw = qualified(zones.raw, "Sales", "Store")
    write_snapshot(spark, spark.createDataFrame([(i, f"n{i}", i % 4 == 0) for i in range(20)], "Id int, Name string, Changed boolean"), raw, root)
    routes = {("Sales", "Store"): [("names", lambda df: df.drop("Changed")), ("loud", lambda df: df.withColumn("Name", F.upper("Name")).drop("Changed"))]}
    read, real = [], module.read_table
    monkeypatch.setattr(module, "read_table", lambda *a, **k: read.append(a[1]) or real(*a, **k))
    first = stage_task(spark, _store_control(spark), routes, "2000-01-01", zones=zones, root=root)
    assert read.count(raw) == 2 and [r.movements for r in first] == [20, 20]
    write_snapshot(spark, spark.createDataFrame([(i, f"m{i}", i % 4 == 0) for i in range(24)], "Id int, Name string, Changed boolean"), raw, root)
    read.clear()
    plans: list = []
    real_load = module.load_into
    monkeypatch.setattr(module, "load_into", lambda s, df, *a, **k: plans.extend(df.inputFiles()) or real_load(s, df, *a, **k))
    later = stage_task(spark, _store_control(spark), routes, "2000-01-01", zones=zones, root=root)
    assert read == [raw] and [r.movements for r in later] == [6, 6]
    assert plans and all("/batches/" in p for p in plans)   # both read the staged window
    assert rows(spark.table(qualified(zones.stg, "sales", "loud"))) == sorted([(i, f"M{i}" if i % 4 == 0 else f"N{i}") for i in range(21) if i < 20 or i % 4 == 0], key=repr)
    spark.sql(f"DROP TABLE {raw}")
    gone = stage_task(spark, _store_control(spark), routes, "2000-01-01", zones=zones, root=root, raise_on_failure=False)
    assert len(gone) == 2 and all(r.error for r in gone)


def test_counts_and_bounds_come_from_the_footers(spark, root, tag):
    from landfall.plans import table_info
    from landfall.sources.tables import footer_table, table_bounds
    name = f"ft_{tag}.t"
    df = spark.range(1000).select("id", (F.col("id") / 8).alias("x"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("d"), F.concat(F.lit("s"), "id").alias("s"))
    write_snapshot(spark, df, name, root)
    info = table_info(spark, name, 3, 30)
    assert info.first().asDict() == {"page": 3, "page_length": 30, "total_pages": 34, "total_results": 1000}
    assert "PushedAggregation: [COUNT(*)]" in info._jdf.queryExecution().executedPlan().toString()
    both = footer_table(spark, name).agg(F.min("id"), F.max("d"))
    assert "PushedAggregation: [MIN(id), MAX(d)]" in both._jdf.queryExecution().executedPlan().toString()
    assert table_bounds(spark, name, "id") == (0, 999) and table_bounds(spark, name, "s") == ("s0", "s999")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""   # the caller's session is as it was
    write_snapshot(spark, df.limit(10), name, root)
    assert table_info(spark, name, 0, 0).first()["total_results"] == 10
    parted = f"ft_{tag}.p"
    load_into(spark, df.limit(40), parted, ["id"], root=root, partition_by=["d"])
    assert footer_table(spark, parted) is None and table_info(spark, parted, 0, 7).first()["total_pages"] == 6
