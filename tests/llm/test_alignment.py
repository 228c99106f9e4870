from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landfall.llm import alignment, segments
from landfall.llm.common import text_slices
from landfall.llm.prefixes import byte_alphabet
from tests.conftest import SF001
from tests.llm.conftest import edge_rows, make_docs
from tests.llm.test_segments import texts

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = Tokenizer.from_file(A)
TOKENIZER.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=B)
BYTE = {c: i for i, c in enumerate(byte_alphabet())}


def both(text):
    """Ids and bytes of each token, by the libraries on the whole text; None where one doesn't give it back."""
    a = [(i, bytes(BYTE[c] for c in TOKENIZER.id_to_token(i))) for i in TOKENIZER.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(PIECES.id_to_piece(i)[3:5], 16)]) if PIECES.is_byte(i) else PIECES.id_to_piece(i).replace("▁", " ").encode()) for i in PIECES.encode(text)]
    raw = (" " + text).encode()
    return (a, b) if text and all(b"".join(p for _, p in x) == raw for x in (a, b)) else None


def aligned(text):
    """Links and groups of a text, one byte after the other."""
    found = both(text or "")
    if found is None:
        return [], [], 0, 0
    spans = []
    for tokens in found:
        at, out = 0, []
        for i, raw in tokens:
            out.append((i, at, at + len(raw)))
            at += len(raw)
        spans.append(out)
    a, b = spans
    links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) * len(b) < 10_000 else None
    if links is None:
        links, j = [], 0
        for i, start, stop in a:
            while b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < stop:
                links.append((i, b[k][0]))
                k += 1
    groups, x, y = [], 0, 0
    for end in sorted({s for _, _, s in a} & {s for _, _, s in b}):
        p, q = x, y
        while p < len(a) and a[p][2] <= end:
            p += 1
        while q < len(b) and b[q][2] <= end:
            q += 1
        groups.append(",".join(str(t[0]) for t in a[x:p]) + "|" + ",".join(str(t[0]) for t in b[y:q]))
        x, y = p, q
    return links, groups, len(a), len(b)


def brute_force(rows):
    found = [(i, *aligned(t)) for i, t in rows]
    counts = collections.Counter(p for _, links, *_ in found for p in links)
    best: dict[int, int] = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return collections.Counter((i, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                                hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for i, links, groups, n_a, n_b in found)


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = alignment.op12(spark, SF001)
    assert got.dtypes == [("doc_id", "bigint"), *((n, "bigint") for n in alignment.NUMBERS), ("groups_sha256", "string")]
    assert collections.Counter(tuple(r) for r in got.collect()) == brute_force(rows)


def test_edges_in_several_blocks(spark, edge, empty, monkeypatch):
    """Tables split into many blocks of shards give the same rows, as does a store that starts anew."""
    rows = [*edge_rows(), (20, "<|endoftext|> and ▁ here"), (21, "<|endoftext|> alone"), (22, "▁"), (23, " leading"), (24, "\n\n x \t y"), (25, "\x00 nul"), (26, "two words"), (None, "two words")]
    docs = make_docs(spark, rows)
    want = brute_force(rows)
    assert collections.Counter(tuple(r) for r in alignment.align(docs, A, B).collect()) == want
    monkeypatch.setattr(alignment, "SHARD_PAIRS", 500)
    small = alignment.align(docs, A, B, table_bytes=500 * alignment._PAIR_BYTES * 3)
    assert collections.Counter(tuple(r) for r in small.collect()) == want
    assert alignment.align(empty, A, B).collect() == []
    assert {tuple(r)[1:] for r in alignment.align(make_docs(spark, [(1, None), (2, ""), (3, "▁▁")]), A, B).collect()} == {(0,) * 6 + ("",)}
    assert alignment.align(edge, A, B).count() == len(edge_rows())


@settings(max_examples=150, deadline=None)
@given(texts)
def test_segments_give_what_the_libraries_give(items):
    held = alignment.aligner(A, B)
    for s in text_slices(pa.array([*items, None], pa.string())):
        numbers, first = held.look_up(s)
        head = held.heads(numbers)
        for i, t in enumerate([*items, ""]):
            mine = numbers[first[i]:first[i + 1]]
            links, groups, n_a, n_b = aligned(t)
            if head[first[i]:first[i + 1], 3].any():
                assert both(t) is None
                continue
            assert head[first[i]:first[i + 1], :3].sum(axis=0).tolist() == [n_a, n_b, len(groups)]
            assert sorted(held.links(mine)[0].tolist()) == sorted(x * held.n_b + y for x, y in links)
            assert held.printed(mine)[0].tobytes().decode() == "".join(";" + g for g in groups)


def test_a_store_that_starts_anew(spark, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(30).collect()]
    monkeypatch.setattr(segments, "STORE_SEGMENTS", 25)
    held = alignment.Aligner(A, B)
    answers = None
    for s in text_slices(pa.array([t for _, t in rows], pa.string()), 4096):
        numbers, first = held.look_up(s)
        for i, (_, t) in enumerate(rows[s.start:s.stop]):
            links = aligned(t)[0]
            if links:
                assert held.links(numbers[first[i]:first[i + 1]])[0].tolist() and answers is None
    assert held.store.count < 5000


def test_perfect_hash_of_shards():
    r = np.random.default_rng(1)
    pairs = np.unique(r.integers(0, 1 << 31, 30_000)).astype(np.uint32)
    shards = 7
    shard = alignment._shard_of(pairs, shards)
    assert np.bincount(shard).min() > 3000
    rows = []
    for k in range(shards):
        sizes, words, order = alignment.perfect_hash(pairs[shard == k])
        rows.append((k, sizes, words.tobytes(), order.astype("<u4").tobytes()))
        assert len(words) * 64 < 5 * len(order)
    index = alignment.PairIndex(rows[::-1], shards)
    assert sorted(index.find(pairs).tolist()) == list(range(len(pairs)))
    assert np.array_equal(index.pairs[index.find(pairs)], pairs)
    others = np.setdiff1d(r.integers(0, 1 << 31, 20_000).astype(np.uint32), pairs)
    assert (index.find(others) == -1).all()
    some = alignment.PairIndex(rows[2:5], shards)
    assert np.array_equal(some.find(pairs) >= 0, (shard >= 2) & (shard < 5))


def test_shards_are_those_of_the_column(spark):
    rows = [(p,) for p in [0, 1, 31_999, 32_000, (1 << 31) - 1, 1_608_000_000] + [random.Random(2).randrange(1 << 31) for _ in range(50)]]
    df = spark.createDataFrame(rows, "pair long").select("pair", alignment.shard_of(F.col("pair"), 211).alias("s"))
    got = df.collect()
    assert [r["s"] for r in got] == alignment._shard_of(np.array([r["pair"] for r in got]), 211).tolist()


def test_dense_counts_sum_as_a_tree(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    partial = spark.range(0, 40_000, 1, 7).select((F.col("id") % 900).alias("pair"), (F.col("id") % 5 + 1).alias("n"))
    hashes = alignment.build(partial.select("pair").distinct(), 4).cache()
    counts = {r["shard"]: np.frombuffer(r["counts"], "<i8") for r in alignment.dense_counts(partial, hashes, 4, [(0, 1), (2, 3)]).collect()}
    got = {p: n for r in hashes.collect() for p, n in zip(np.frombuffer(r["pairs"], "<u4").tolist(), counts[r["shard"]].tolist())}
    assert got == {r["pair"]: r["n"] for r in partial.groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    with pytest.raises(Exception, match="not in the index"):
        alignment.dense_counts(partial.unionAll(spark.createDataFrame([(77_777, 1)], "pair long, n long")), hashes, 4, [(0, 3)])
