from __future__ import annotations

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landfall.llm import pieces, prefixes, queries
from tests.conftest import SF001
from tests.llm.conftest import edge_rows

BPE = public_tokenizers.path("byte_bpe_50k.json")
SPM = public_tokenizers.path("piece_bpe_32k.model")


def test_op5_against_the_library(spark):
    tok = Tokenizer.from_file(BPE)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = queries.queries()["op5_prefix_counts"](spark, SF001).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r["doc_id"]]
        n = len(tok.encode(t, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 1024)
        if n > 1024:
            kept = t.encode()[:r["limit_bytes"]].decode()
            assert len(tok.encode(kept, add_special_tokens=False).ids) <= 1024 < len(tok.encode(t[:len(kept) + 12], add_special_tokens=False).ids)


def test_stored_counts_answer_questions(spark):
    docs = spark.createDataFrame([(1, "The quick brown fox's den"), (2, None)], "doc_id long, text string")
    rows = prefixes.prefix_counts(docs, BPE)
    got = rows.select("doc_id", prefixes.tokens_of(F.col("counts"), 9).alias("t"), prefixes.chars_within(F.col("counts"), 2).alias("c")).orderBy("doc_id").collect()
    tok = Tokenizer.from_file(BPE)
    assert [tuple(r) for r in got] == [(1, len(tok.encode("The quick").ids), len("The quick")), (2, 0, 0)]


def test_op5_reads_a_piece_once():
    """Tokens that end at a byte come from one pass, not from trying slices at each."""
    class Watched(str):
        slices = 0

        def __getitem__(self, key):
            Watched.slices += 1
            return str.__getitem__(self, key)

    tok = Tokenizer.from_file(BPE)
    word = "unpronounceablenessesxqzv" + "=" * 70
    assert prefixes.PrefixCounter(BPE).piece(Watched(word)) == [len(tok.model.tokenize(word[:n])) for n in range(1, len(word) + 1)]
    assert Watched.slices == 0


def test_edge_cases(spark, edge, empty):
    tok, sp = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=SPM)
    want = sorted((str(i), len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in edge_rows())
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in prefixes.count_tokens(edge, BPE).collect()) == want
    want = sorted((str(i), sp.encode(t or "")) for i, t in edge_rows())
    ids = pieces.encode(edge, SPM)
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in ids.collect()) == want
    assert sorted((str(r["doc_id"]), r["text"]) for r in pieces.decode(ids, SPM).collect()) == sorted((str(i), t or "") for i, t in edge_rows())
    for f in (lambda d: prefixes.count_tokens(d, BPE), lambda d: prefixes.prefix_counts(d, BPE), lambda d: pieces.encode(d, SPM), lambda d: pieces.round_trips(d, SPM)):
        assert f(empty).collect() == []


def test_op6_comes_back(spark):
    rows = queries.queries()["op6_sentencepiece"](spark, SF001)
    assert rows.where("NOT round_trip").count() == 0 and rows.count() == 200


def test_decode_of_other_ids(spark):
    rows = spark.createDataFrame([(1, [0, 1, 3 + 0xFF]), (2, None)], "doc_id long, ids array<int>")
    assert [r["text"] for r in pieces.decode(rows, SPM).orderBy("doc_id").collect()] == ["⁇ �", ""]


def test_op6_gives_the_ids(spark):
    want = {r["doc_id"]: r["ids"] for r in pieces.encode(spark.read.parquet(f"{SF001}/documents.parquet"), SPM).collect()}
    rows = queries.queries()["op6_sentencepiece"](spark, SF001).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == want and all(len(r["ids"]) == r["n_pieces"] for r in rows)
