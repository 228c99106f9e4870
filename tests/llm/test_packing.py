from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from landfall.llm.packing import Windows, pack
from tests.conftest import SF001
from tests.llm.conftest import make_docs, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(docs, capacity=2048, **options):
    """Every id of every document in one piece, sequences gapless."""
    tok = Tokenizer.from_file(PATH)
    rows = pack(docs, PATH, capacity=capacity, **options).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = defaultdict(list)
    for i, t in texts:
        want[i].append(tok.encode(t or "", add_special_tokens=False).ids + [1])
    assert sum(r["length"] for r in rows) == sum(len(x) for v in want.values() for x in v)
    for r in rows:
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(np.array(x[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"] for x in want[r["doc_id"]])
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert 0 < at <= capacity
    return rows, by


def test_documents_of_a_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows, by = check(docs)
    assert sum(r["length"] for r in rows) / (2048 * len(by)) > 0.95


def test_many_partitions_merge_their_leftovers(spark):
    docs = make_docs(spark, [(i, prose(i, 5 + i % 20)) for i in range(300)]).repartition(40)
    rows, by = check(docs, capacity=256, windows=4, fan_in=3)
    assert sum(r["length"] for r in rows) / (256 * len(by)) > 0.9


def test_edge_cases(spark, edge, empty):
    check(edge)
    assert pack(empty, PATH).collect() == []


def test_ids_of_pieces(spark):
    tok = Tokenizer.from_file(PATH)
    text = prose(5, 400)
    rows = pack(make_docs(spark, [(1, text)]), PATH, capacity=100, with_ids=True).collect()
    ids = [i for r in sorted(rows, key=lambda r: r["start"]) for i in r["ids"]]
    assert ids == tok.encode(text, add_special_tokens=False).ids + [1]


def test_windows_stay_bounded_and_the_fullest_goes():
    w = Windows(10, 2)
    assert list(w.put(["a"], 6)) == [] and list(w.put(["b"], 7)) == []
    assert list(w.put(["c"], 8)) == [["b"]]      # fits nowhere: the fullest of two goes
    assert list(w.put(["d"], 2)) == [["c", "d"]]  # best fit fills it
    assert list(w.rest()) == [["a"]]


def test_parameters(empty):
    with pytest.raises(ValueError):
        pack(empty, PATH, capacity=0)
