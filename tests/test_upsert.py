import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landfall.operators import (KeyViolation, duplicate_keys, merge_action_counts, merge_actions,
                                null_violations, upsert)
from landfall.operators.upsert import CONF_BROADCAST_BYTES

from .conftest import rows

SCHEMA = "k bigint, v string"


def test_single_key(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    s = spark.createDataFrame([(2, "B"), (3, "C")], SCHEMA)
    assert rows(upsert(t, s, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]


def test_composite_key_and_column_order(spark):
    t = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "a int, b int, v string")
    s = spark.createDataFrame([("B", 2, 1), ("C", 3, 1)], "v string, b int, a int")
    out = upsert(t, s, ["a", "b"])
    assert out.columns == ["a", "b", "v"]
    assert rows(out) == [(1, 1, "a"), (1, 2, "B"), (1, 3, "C")]


def test_mapped_key(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    s = spark.createDataFrame([(2, "B")], "SrcKey bigint, v string")
    assert rows(upsert(t, s, {"SrcKey": "k"})) == [(1, "a"), (2, "B")]


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, "old"), (1, "a")], SCHEMA)
    s = spark.createDataFrame([(None, "new"), (1, "A")], SCHEMA)
    assert rows(upsert(t, s, ["k"])) == [(1, "A"), (None, "new"), (None, "old")]


def test_duplicate_source_keys_raise(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([(2, "x"), (2, "y")], SCHEMA)
    with pytest.raises(KeyViolation):
        upsert(t, s, ["k"], check_unique=True)
    # NULL keys are not duplicates of each other
    s2 = spark.createDataFrame([(None, "x"), (None, "y")], SCHEMA)
    assert upsert(t, s2, ["k"], check_unique=True).count() == 3


def test_extra_columns_are_left_out_and_missing_ones_raise(spark):
    t = spark.createDataFrame([(1, "a"), (3, "c")], SCHEMA)
    s = spark.createDataFrame([(1, "A", 1), (2, "b", 2)], "k bigint, v string, extra int")
    assert rows(upsert(t, s, ["k"])) == [(1, "A"), (2, "b"), (3, "c")]
    with pytest.raises(ValueError, match="lacks"):
        upsert(t, spark.createDataFrame([(1,)], "k bigint"), ["k"])


def test_source_is_cast_to_target_types(spark):
    t = spark.createDataFrame([(1, "a")], SCHEMA)
    s = spark.createDataFrame([(2, "b")], "k int, v string")
    out = upsert(t, s, ["k"])
    assert out.schema["k"].dataType.simpleString() == "bigint"
    assert rows(out) == [(1, "a"), (2, "b")]


def test_merge_actions(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "n")], SCHEMA)
    assert rows(merge_actions(t, s, ["k"])) == [(2, "update"), (3, "insert"), (None, "insert")]
    assert rows(merge_action_counts(t, s, ["k"], source_rows=3)) == [("insert", 2), ("update", 1)]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_batch_keys_broadcast_only_within_budget(spark):
    t = spark.range(0, 1000).selectExpr("id AS k", "cast(id AS string) AS v")
    s = spark.range(0, 10).selectExpr("id AS k", "'x' AS v")
    assert "BroadcastHashJoin" in _plan(upsert(t, s, ["k"], source_rows=10))
    old = spark.conf.get(CONF_BROADCAST_BYTES, None)
    spark.conf.set(CONF_BROADCAST_BYTES, "8")
    try:
        plan = _plan(upsert(t, s, ["k"], source_rows=10))
        assert "ResolvedHint" not in plan
        assert rows(upsert(t, s, ["k"], source_rows=10)) == rows(upsert(t, s, ["k"]))
    finally:
        if old is None:
            spark.conf.unset(CONF_BROADCAST_BYTES)
        else:
            spark.conf.set(CONF_BROADCAST_BYTES, old)


def test_string_keys_are_measured(spark):
    from landfall.operators.upsert import key_bytes
    df = spark.createDataFrame([("abcd",), ("ef",)], "k string")
    assert key_bytes(df, 2) == 2 * (16 + 16) + 6


def test_duplicate_keys_and_null_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a int, b int")
    assert rows(duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]
    assert null_violations(df, ["a", "b"]).first().asDict() == {"null_a": 2, "null_b": 0}


_batch = st.lists(st.tuples(st.integers(0, 12), st.sampled_from(["p", "q", "r"])),
                  max_size=12, unique_by=lambda x: x[0])


@settings(max_examples=8, deadline=None)
@given(target=_batch, batch=_batch)
def test_upsert_properties(spark, target, batch):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(batch, SCHEMA)
    once = upsert(t, s, ["k"], source_rows=len(batch))
    twice = upsert(once, s, ["k"], source_rows=len(batch))
    assert rows(once) == rows(twice)  # idempotent
    inserts = len({k for k, _ in batch} - {k for k, _ in target})
    assert once.count() == len(target) + inserts
    expected = dict(target)
    expected.update(dict(batch))
    assert rows(once) == sorted(expected.items(), key=repr)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unconvertible_source_values_raise(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        t = spark.createDataFrame([(1, 10)], "k bigint, n int")
        bad = spark.createDataFrame([(2, "x")], "k bigint, n string")
        with pytest.raises(Exception, match="cannot store as int"):
            upsert(t, bad, ["k"]).collect()
        good = spark.createDataFrame([(2, "20")], "k bigint, n string")
        assert rows(upsert(t, good, ["k"])) == [(1, 10), (2, 20)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_observed_key_bytes_match_the_aggregate(spark):
    from landfall.operators.upsert import key_bytes, variable_key_bytes
    from landfall.session import scratch_path
    from landfall.sources.tables import write_batch_observed
    df = spark.createDataFrame([("abcd", 1), ("ef", 2), (None, 3)], "c string, n bigint")
    keys = df.select("c", "n")
    _, rows_written, measured = write_batch_observed(df, scratch_path(spark, "t"),
                                                     metrics=variable_key_bytes(keys))
    assert rows_written == 3 and measured == {"bytes_c": 6}
    assert key_bytes(keys, 3, measured) == key_bytes(keys, 3)
