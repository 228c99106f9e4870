from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landfall.llm import quality, sketches
from landfall.llm.common import text_slices
from tests.conftest import SF001, SF01
from tests.llm.conftest import edge_rows, make_docs, prose


# ------------------------------------------------------------ quality

def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = quality.op3(spark, SF01)
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in rows if r["held_out"]]
    right = np.mean([r["predicted"] == r["quality"] for r in held])
    poor = [r for r in held if r["quality"] == 0]
    assert len(held) > 80 and right > 0.95 and np.mean([r["predicted"] == 0 for r in poor]) > 0.8


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/labels.parquet")
    other = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = lambda x: sorted((r["doc_id"], round(r["score"], 9)) for r in quality.classify(docs, x).collect())
    assert scores(labels) == scores(other)


def test_statistics_of_a_text():
    texts = ["AB cd!! cd!! | é1", "", None, "a a\na a\n"]
    found = {}
    for s in text_slices(pa.array(texts)):
        found = [dict(zip(quality.STATISTICS, row)) for row in quality.statistics(s)]
    first, empty, null, lines = found
    assert first["words"] == pytest.approx(math.log1p(5)) and first["chars"] == pytest.approx(math.log1p(17))
    assert first["exclaimed"] == 0.4 and first["repeated_next"] == 0.2 and first["bare_marks"] == 0.2 and first["distinct_words"] == 0.8 and first["top_word"] == 0.4
    assert first["upper"] == pytest.approx(2 / 8, abs=0.05) and empty == null and set(empty.values()) == {0.0}
    assert lines["distinct_lines"] == 0.5 and lines["lines"] == pytest.approx(math.log1p(2)) and lines["distinct_words"] == 0.25


def test_paths_of_trees():
    printed = """RandomForestClassificationModel: uid=x, numTrees=2
  Tree 0 (weight 1.0):
    If (feature 3 <= 0.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 3 > 0.5)
     Predict: 1.0
  Tree 1 (weight 1.0):
    Predict: 1.0
"""
    c = quality.Condition
    low, high = c(3, False, 0.5), c(3, True, 0.5)
    assert set(quality.tree_paths(printed)) == {(low,), (high,), (c(1, False, 2.0), low), (c(1, True, 2.0), low)}


def test_scores_are_those_of_the_fitted_rules(spark):
    """Statistics and rules of every document once more, text by text, in Python."""
    docs, labels = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/labels.parquet")
    rows = docs.select("doc_id", "text")
    model = quality.train(quality.with_statistics(rows).drop("text").join(quality.known_labels(labels), "doc_id"))
    assert model.rules and all(w for w, _ in model.rules)
    got = {r["doc_id"]: r["score"] for r in quality.op3(spark, SF001).collect()}
    for r in rows.collect():
        statistics = quality.statistics(next(iter(text_slices(pa.array([r["text"]])))))[0]
        total = model.intercept
        for weight, rule in model.rules:
            if all(statistics[c.feature] > c.value if c.above else statistics[c.feature] <= c.value for c in rule):
                total += weight
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)


def test_compiled_rules(spark):
    m = quality.RuleModel(-1.0, [(2.0, (quality.Condition(0, True, 1.0), quality.Condition(1, False, 5.0))), (0.5, (quality.Condition(1, True, 5.0),))])
    rows = spark.createDataFrame([([2.0, 3.0],), ([0.0, 9.0],), ([0.0, 0.0],)], "_statistics array<double>")
    got = [r[0] for r in rows.select(m.score()).collect()]
    assert got == pytest.approx([1 / (1 + math.exp(-t)) for t in (1.0, -0.5, -1.0)])


def test_quality_edges(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(empty, none).collect() == []
    got = quality.classify(edge, none).collect()
    assert len(got) == len(edge_rows()) and {r["score"] for r in got} == {0.5}
    one = spark.createDataFrame([(i, 1, None) for i in (4, 6, 8)] + [(None, 0, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    assert all(r["predicted"] == 1 for r in quality.classify(edge, one).collect())
    left = quality.keep_good(edge, one)
    assert left.columns == edge.columns and left.count() == edge.count() and quality.keep_good(empty, none).columns == empty.columns


# ------------------------------------------------------------ sketches

def brute_shingles(text):
    w = [x for x in __import__("re").split("[\t-\r ]+", text) if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_fingerprints_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    ids = sorted(texts, reverse=True)
    after = dict(zip(ids, [*ids[1:], ids[0]]))
    got = sketches.op4(spark, SF001).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(ids)
    prints, off = {}, []
    for r in got:
        t = texts[r["doc_id"]]
        cut = len(t) // 3
        new = t[:len(t) - cut] + texts[after[r["doc_id"]]][:cut]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        a, b = brute_shingles(t), brute_shingles(new)
        off.append(abs(r["near_edited"] - (len(a & b) / len(a | b) if a | b else 1.0)))
        if len(a | b) <= sketches.K:
            assert off[-1] < 1e-9
    assert max(off) < 0.2 and np.mean(off) < 0.04


def test_neighbours_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(sketches, "ROWS_PER_RANGE", 3)
    ids = [*range(0, 40, 3), 10**15, 10**15 + 1, -5, 2**62]
    rows = [(i, f"text {i} of some words and more {i}") for i in ids]
    got = {r["doc_id"]: r["next_text"] for r in sketches.with_next(make_docs(spark, rows).select("doc_id", "text")).collect()}
    order = sorted(ids, reverse=True)
    assert got == {i: f"text {j} of some words and more {j}" for i, j in zip(order, [*order[1:], order[0]])}


def test_fingerprint_edges(spark, edge, empty):
    assert sketches.fingerprints(empty).collect() == []
    got = sketches.fingerprints(edge).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert {r["fingerprint"] for r in got if r["n_chars"] == 0} == {""}
    one = sketches.fingerprints(make_docs(spark, [(1, "abcdef")])).collect()[0]
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1.0


def test_sketches_merge(spark):
    parts = [prose(1, 900), prose(2, 700), prose(1, 900) + " " + prose(3, 500)]
    docs = spark.createDataFrame([(i % 2, t) for i, t in enumerate(parts)] + [(9, "")], "part long, text string")
    rows = sketches.with_sketch(docs, "text", "sketch")
    merged = {r["part"]: r for r in sketches.merge_all(rows, "sketch", ["part"]).select("part", "sketch", sketches.distinct_shingles(F.col("sketch")).alias("n")).collect()}
    want = len(brute_shingles(parts[0]) | brute_shingles(parts[2]))
    assert abs(merged[0]["n"] / want - 1) < 0.3 and len(merged[0]["sketch"]) == sketches.K and merged[9]["sketch"] == []
    both = rows.where("part = 0").orderBy(F.length("text")).collect()
    pair = spark.createDataFrame([(both[0]["sketch"], both[1]["sketch"])], "a array<bigint>, b array<bigint>")
    r = pair.select(sketches.merge(F.col("a"), F.col("b")).alias("m"), sketches.containment(F.col("a"), F.col("b")).alias("c")).first()
    assert r["m"] == merged[0]["sketch"] and r["c"] > 0.8
