from __future__ import annotations

import inspect

import pytest

import corpus_pipeline
from landfall.llm import queries
from landfall.llm.common import staged
from tests.conftest import SF001, SF01
from tests.llm.test_dedup import brute_force, shingle_set, union_find
from tests.oracle_compare import compare, duck


def test_stages_do_their_work(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(staged(stage(spark, seen[-1], SF001), "t"))
    for frame in seen[1:-1]:
        assert frame.schema.simpleString() == docs.schema.simpleString()
    texts = [{r["doc_id"]: r["text"] for r in f.collect()} for f in seen[:-1]]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert len(texts[1]) < len(texts[0]) and sum(i in texts[1] for i in good) > 0.97 * len(good)
    assert texts[2] == {max(i for i, u in texts[1].items() if u == t): t for t in set(texts[1].values())}
    sets = {i: shingle_set(t) for i, t in texts[2].items()}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert set(texts[3]) == set(union_find(sets, links).values())
    split, gone = brute_force(texts[3])
    assert {i: "".join(t.split()) for i, t in texts[4].items()} == {i: "".join(x for k, x in enumerate(w) if k not in gone[i]) for i, w in split.items()}
    assert {r["doc_id"] for r in seen[-1].select("doc_id").distinct().collect()} == set(texts[4])


def test_registered(spark):
    names = list(queries.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert [list(inspect.signature(f).parameters) for _, f in corpus_pipeline.STAGES] == [["spark", "docs", "sf_dir"]] * 5
    assert set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    got = compare(spark, duck(SF01), name, queries.queries()[name], queries.oracle_sql()[name], SF01)
    assert got["status"] == "ok", got
