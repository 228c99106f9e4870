from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landfall.llm import toxicity
from landfall.llm.common import text_slices
from tests.conftest import SF001, SF01
from tests.llm.conftest import CLASHING, edge_rows, make_docs


def grams(text: str) -> set[str]:
    text = " " + "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in (text or "").lower()) + " "
    return {text[i:i + n] for n in toxicity.SIZES for i in range(len(text) - n + 1)}


def bucket(gram: str) -> int:
    total = sum(ord(c) * int(toxicity._PLACE[j]) for j, c in enumerate(gram)) + int(toxicity._SIZE[len(gram) - 1])
    return int(toxicity.mix(np.array([total % (1 << 64)], np.uint64))[0] >> np.uint64(64 - toxicity.BITS))


def test_buckets_are_those_of_the_texts_own_ngrams():
    texts = ["Ab\tc", "", None, "ä漢😀 ab", "x" * 40, "İstanbul"]
    for s in text_slices(pa.array(texts)):
        text, found = toxicity.Grams(s).held()
        assert len(s) == len(texts)
        for i, t in enumerate(texts):
            assert set(found[text == i].tolist()) == {bucket(g) for g in grams(t)}


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = toxicity.op11(spark, SF01)
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == 1000 and got.columns == ["doc_id", "held_out", "score", "predicted"]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50 and np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.94
    assert np.mean([r["predicted"] for r in held if r["toxic"] == 0]) < 0.02


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/labels.parquet")
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = lambda x: sorted((r["doc_id"], round(r["score"], 9)) for r in toxicity.classify(docs, x).collect())
    assert scores(labels) == scores(other)


def test_counts_ratio_and_scores_by_brute_force(spark):
    """Counts of n-grams by class, and the scores that the fitted weights give, from Python sets."""
    texts = [(i, f"{'you moron, ' if i % 3 == 0 else 'good day, '}word{i % 7} and so on {i}") for i in range(120)]
    rows = spark.createDataFrame([(int(i % 3 == 0), t) for i, t in texts], "label int, text string")
    want: dict[int, list[int]] = {}
    for i, t in texts:
        for b in {bucket(g) for g in grams(t)}:
            want.setdefault(b, [0, 0])[int(i % 3 == 0)] += 1
    counts = {r["bucket"]: [r["other"], r["toxic"]] for r in toxicity.bucket_counts(rows).collect()}
    assert counts == want
    ratio = spark.createDataFrame([(3, 1)], "toxic long, other long").select(toxicity.log_ratio(40, 80)).first()[0]
    assert ratio == pytest.approx(math.log((4 / 42) / (2 / 82)))
    model = toxicity.fit(rows)
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist()))
    assert 0 < len(weight) < len(want)
    scored = model.score(make_docs(spark, [*texts, (500, "you moron, said they"), (501, "good day, said they"), (502, None)])).collect()
    for r in scored:
        total = model.intercept + sum(weight.get(b, 0.0) for b in {bucket(g) for g in grams(r["text"])})
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)))
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in scored if r["doc_id"] < 120)
    assert next(r["score"] for r in scored if r["doc_id"] == 500) > 0.5 > next(r["score"] for r in scored if r["doc_id"] == 501)


def test_the_sample_is_bounded(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") % 2).cast("int").alias("toxic"))
    assert 800 < toxicity.known_labels(labels, 1000).count() < 1200
    assert toxicity.known_labels(labels, 10_000).count() == labels.where(~toxicity.held_out(F.col("doc_id"))).count()


def test_edges(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.classify(empty, none).collect() == []
    got = toxicity.classify(edge, none).collect()
    assert len(got) == len(edge_rows()) and {r["score"] for r in got} == {0.5}
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}
    one = spark.createDataFrame([(6, 1, 1), (4, 1, 1), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    assert all(r["score"] > 0.9 for r in toxicity.classify(edge, one).collect())
    both = spark.createDataFrame([(6, 1, 1), (4, 1, 0), (4, 1, 1), (2, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(edge, both).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in got)


def test_drop_toxic_keeps_the_other_columns(spark):
    texts = [(i, f"{'a moron writes' if i % 2 else 'somebody writes'} line {i}") for i in range(80)] + [(None, "somebody writes line 500")]
    docs = make_docs(spark, texts, CLASHING)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(80)], "doc_id long, quality int, toxic int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} == {None, *range(0, 80, 2)}
