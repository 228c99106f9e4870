from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from landfall.llm import tries
from tests.conftest import SF01

SPEC = "conv_id long, turn long, role string, text string, `a.b` string, depth string, kids string"


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SPEC)


def brute_force(rows, tie=lambda r: ((r[2] or ""), (r[3] or ""))):
    """The contract's own words, by dictionaries."""
    convs: dict[int, list] = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, tie(r))):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        block = abs(c) % 100 * (1 if c >= 0 else -1)
        rebuilt[c] = convs.get(c - block, [])[:h] + own[h:]
    members: dict[tuple, list[int]] = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    kids: dict[tuple, int] = {}
    leaves: dict[tuple, int] = {}
    saved: dict[tuple, int] = {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in kids)
            saved[p[:d]] = saved.get(p[:d], 0) + ((len(m) - 1) * len(p[-1][1]) if p else 0)
    out = set()
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p))))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def check(spark, rows):
    got = tries.trie(make(spark, rows))
    assert got.columns == COLUMNS
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute_force(rows)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = tries.op13(spark, SF01)
    assert got.dtypes == [(c, "string" if c == "ends_sha256" else "bigint") for c in COLUMNS]
    assert {tuple(r) for r in got.collect()} == brute_force(rows)


def test_long_chains_copies_and_shared_beginnings(spark):
    r = random.Random(3)
    rows = []
    for c in range(0, 460):
        if c == 200:   # a block without its first conversation
            continue
        n = 150 if c in (7, 100, 250) else r.randint(1, 9)
        for t in range(n):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["hi", "yes", "no"]) if t < 3 or c % 3 == 0 else f"{c % 40}-{t}"))
    r.shuffle(rows)
    check(spark, rows)


def test_a_long_conversation_is_dealt_over_tasks(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(1, t, "user", f"turn {t % 7}") for t in range(400)] + [(c, t, "user", f"turn {t % 7}") for c in (2, 3, 150) for t in range(5)]
        found = tries.positions(make(spark, rows).repartition(4))
        assert sorted(x["pos"] for x in found.where("conv_id = 1").collect()) == list(range(400))
        order = [F.col("conv_id"), F.col("turn")]
        assert make(spark, rows).repartitionByRange(*order).where("conv_id = 1").select(F.spark_partition_id()).distinct().count() > 2
        check(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_members_in_several_chunks(spark):
    rows = spark.range(0, 3000).select((F.col("id") % 2).alias("conv_id"), F.lit(4).cast("long").alias("depth"), (F.col("id") * 7).alias("member"))
    want = {k: hashlib.sha256(",".join(str(7 * i) for i in range(k, 3000, 2)).encode()).hexdigest() for k in (0, 1)}
    for chunk in (1, 100, 1 << 20):
        assert {r["conv_id"]: r["digest"] for r in tries.end_digests(rows, chunk).collect()} == want


def test_edges(spark):
    check(spark, [])
    check(spark, [(None, 1, "user", "lost"), (None, None, None, None)])
    check(spark, [(5, None, None, None)])
    # nulls, empty and long texts, negative ids, no turn left, repeated rows
    rows = [(300, None, "user", "first"), (300, 0, None, "x" * 30_000), (300, 1, "user", None), (301, 0, "user", ""), (302, 0, "", None), (302, 1, None, ""),
            (-5, 0, "user", "under zero"), (-105, 0, "user", "é漢😀"), (-100, 2, "user", "é漢😀"), (303, 0, "user", "a"), (304, 0, "user", "a"), (305, 0, "user", "a"), (10**18, 0, "u", "far")]
    rows += [(306, t, "user", "same") for t in (1, 1, 1, 2, 2)] + [(c, 0, "user", "one turn") for c in range(400, 420)]
    check(spark, rows)


def test_equal_turns_have_one_order(spark):
    rows = [(1, 0, "user", f"text {i}") for i in range(6)]
    found = [sorted(tuple(r) for r in tries.trie(make(spark, x)).collect()) for x in (rows, rows[::-1])]
    assert found[0] == found[1]


def test_totals_of_any_tree(spark):
    """Random trees, among them a path and a star, against sums upwards."""
    r = random.Random(5)
    shapes = [[max(0, i - 1) for i in range(70)], [0] * 70, [r.randrange(max(1, i - 3), i + 1) - 1 if i else 0 for i in range(120)], [r.randrange(0, max(1, i)) for i in range(120)]]
    for up in shapes:
        depth = [0] * len(up)
        for i in range(1, len(up)):
            depth[i] = depth[up[i]] + 1
        weight = [r.randrange(1, 100) for _ in up]
        total = list(weight)
        for i in sorted(range(1, len(up)), key=lambda i: -depth[i]):
            total[up[i]] += total[i]
        nodes = spark.createDataFrame([(i, depth[i], up[i] if i else None, depth[i] - 1 if i else None, weight[i]) for i in range(len(up))], "conv_id long, depth long, up_conv long, up_depth long, w long")
        got = {x["conv_id"]: x["w"] for x in tries.subtree_totals(nodes, ["w"]).collect()}
        assert got == dict(enumerate(total))


def test_a_cycle_is_no_tree(spark):
    nodes = spark.createDataFrame([(1, 1, 2, 2, 1), (2, 2, 1, 1, 1)], "conv_id long, depth long, up_conv long, up_depth long, w long")
    old, tries.MOST_ROUNDS = tries.MOST_ROUNDS, 3
    try:
        with pytest.raises(RuntimeError):
            tries.subtree_totals(nodes, ["w"])
    finally:
        tries.MOST_ROUNDS = old
